import itertools
import re

import numpy as np
import pytest
from conftest_llm import CLASHES

from sitelens.llm import outliers as O

BLANK = "[\x20\x09-\x0D]"


def brute_statistics(text):
    text = text or ""
    words = [w for w in re.split(BLANK + "+", text) if w]
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def build(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)


def plain(i, seed, n=None):
    g = np.random.default_rng(seed * 100_003 + i)
    words = ["".join(chr(97 + c) for c in g.integers(0, 26, g.integers(3, 8))) for _ in range(n or g.integers(80, 600))]
    return "\n".join(" ".join(words[k:k + 12]) for k in range(0, len(words), 12))


def test_statistics_by_definition(spark, docs, odd_texts):
    texts = [t if t is None or len(t) < 3000 else t[:3000] for t in odd_texts] + [
        "a b c a b c a", "a a a a", "x\n\nx\n x\nx", "# * $ % & | < >", "A b C a b c A b C", "é é é", "l\r\nl\r\nl"]
    out = {r["doc_id"]: r for r in O.text_statistics(docs(texts, "n_words base_failed key").select("doc_id", "lang", "source", "text")).collect()}
    for i, t in enumerate(texts):
        r = out[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_statistics(t), t


def test_chi_square():
    assert O.chi_square_quantile(0.999, 5) == pytest.approx(20.515, abs=1e-3)
    assert O.chi_square_quantile(0.95, 7) == pytest.approx(14.067, abs=1e-3)


def vectors(n, seed, far=0):
    g = np.random.default_rng(seed)
    x = np.round(g.normal(size=(n, O.DIM)) @ g.normal(size=(O.DIM, O.DIM)) + 3, 6)
    x[:far] += 25
    return x


def points(spark, groups):
    rows = [(k, sum(1 for _ in x), *map(float, v), 1.0) for k, x in groups.items() for v in x]
    cols = "key string, size long, " + ", ".join(f"x{i} double" for i in range(O.DIM)) + ", w double"
    path = f"{spark.conf.get('spark.checkpoint.dir')}/points-{len(rows)}-{abs(hash(tuple(groups)))}"
    spark.createDataFrame(rows, cols).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def subset_logdet(x):
    return O._estimate(len(x), x.sum(axis=0), O._products(x).sum(axis=0))[2]


def test_determinant_is_that_of_the_best_subset(spark, docs):
    """Against all subsets of a small group; the edge bin is shared, so a hair's breadth is allowed."""
    groups = {"a": vectors(14, 1, far=3), "b": vectors(13, 2, far=2), "c": vectors(12, 3)}
    got = {r["key"]: r for r in O.fit(points(spark, groups), 39).collect()}
    for k, x in groups.items():
        h = int(np.ceil(O.SUPPORT * len(x)))
        best = min(subset_logdet(x[list(s)]) for s in itertools.combinations(range(len(x)), h))
        assert got[k]["logdet"] <= best + 0.02
    # the far points have no part in the estimate
    d = O.distances(groups["a"], np.array(got["a"]["mean"]), np.array(got["a"]["inverse"]).reshape(O.DIM, O.DIM))
    assert d[:3].min() > O.CUTOFF > d[3:].max() / 10 and set(np.argsort(d)[-3:]) == {0, 1, 2}


def test_steps_over_spark_equal_steps_in_memory(spark, docs):
    x = vectors(700, 5, far=60)
    got = O.fit(points(spark, {"g": x}), 700).first()
    mean, inverse, logdet = np.array(got["mean"]), np.array(got["inverse"]).reshape(O.DIM, O.DIM), got["logdet"]
    again = O._step(x, np.ones(len(x)), mean, inverse)       # stands still
    assert again[2] == pytest.approx(logdet, abs=1e-5)
    np.testing.assert_allclose(again[0], mean, atol=1e-2)


def test_copies_weigh_as_often_as_they_stand():
    x, w = vectors(40, 7), np.arange(1.0, 41.0)
    start = O._estimate(40, x.sum(axis=0), O._products(x).sum(axis=0))
    once = O._step(x, w, *start[:2])
    many = O._step(np.repeat(x, w.astype(int), axis=0), np.ones(int(w.sum())), *start[:2])
    np.testing.assert_allclose(once[0], many[0])
    assert once[2] == pytest.approx(many[2])


def test_planted_outliers_go_and_clean_texts_stay(spark):
    rows = [(i, plain(i, 1), "en", "a" if i % 3 else "b") for i in range(450)]
    rows += [(1000 + i, " ".join(w + "***" for w in plain(i, 2, 100).split()), "en", "a") for i in range(20)]
    rows += [(2000 + i, "\n".join([f"{plain(i, 3, 12)}"] * 4 + [plain(i, 4, 60)] * 2), "en", "a") for i in range(5)]   # fails the base rule
    rows += [(3000, plain(0, 9), "fr", "tiny"), (3001, None, None, None), (3002, "", "en", "a"), (3003, plain(1, 9), None, None)]
    rows += rows[:5]
    out = O.judge(build(spark, rows).selectExpr("*", *[f"'x' AS {c}" for c in CLASHES.split()])).collect()
    assert len(out) == len(rows)
    kept = {r["doc_id"]: r["kept"] for r in out}
    assert not any(kept[1000 + i] for i in range(20)) and not any(kept[2000 + i] for i in range(5))
    assert sum(kept[i] for i in range(450)) >= 440
    assert kept[3000] and kept[3003] and not kept[3001] and not kept[3002]
    assert {r["doc_id"] for r in out if r["base_failed"]} >= {3001, 3002, 2000}
    twice = [r for r in out if r["doc_id"] == 0]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_small_and_empty_tables(spark):
    few = [(i, plain(i, 1), "en", "a") for i in range(5)] + [(9, " ".join(w + "***" for w in plain(9, 2, 100).split()), "en", "a")]
    out = O.judge(build(spark, few)).collect()
    assert all(r["kept"] and r["distance"] is None for r in out)
    assert O.judge(build(spark, few).limit(0)).count() == 0


def test_group_of_copies(spark):
    """A third of a group being one text neither breaks the estimate nor costs clean texts."""
    rows = [(i, plain(i if i > 100 else 0, 1), "en", "a") for i in range(300)]
    out = O.judge(build(spark, rows)).collect()
    assert sum(r["kept"] for r in out) >= 290
