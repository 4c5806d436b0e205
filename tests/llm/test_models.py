import random
import zlib

import numpy as np
import pytest

from conftest_llm import CLASHES
from sitelens.llm import language_id, quality
from sitelens.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return table(spark, SF, "documents"), table(spark, SF, "labels")


@pytest.fixture(scope="module")
def model(tables):
    return quality.train(*tables)


def test_held_out_rows(spark, docs):
    rows = docs([(i, "t") for i in range(500)]).select("doc_id", quality.held_out("doc_id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_quality_on_held_out_rows(tables, model):
    docs, labels = tables
    rows = quality.score_documents(docs, model).join(labels, "doc_id").filter("held_out").select("quality", "predicted", "score").collect()
    good = [r for r in rows if r["quality"] == 1]
    bad = [r for r in rows if r["quality"] == 0]
    assert sum(r["predicted"] for r in good) / len(good) > 0.95
    assert np.mean([r["score"] for r in good]) > 0.9 > 0.4 > np.mean([r["score"] for r in bad])


def test_quality_never_learns_from_held_out_labels(spark, tables, model):
    docs, labels = tables
    flipped = labels.withColumn("quality", quality.F.when(quality.held_out("doc_id"), 1 - labels["quality"]).otherwise(labels["quality"]))
    assert quality.train(docs, flipped) == model


def test_quality_of_odd_rows(spark, docs, odd_texts, model):
    rows = [*enumerate(odd_texts), (None, "null id"), (3, "same text here")]
    df = docs(rows, CLASHES)
    got = quality.score_documents(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    empty = [r["score"] for r in got if r["doc_id"] in (0, 1)]
    assert empty == [model.prior] * 2
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(r["doc_id"] or -1 for r in got if r["predicted"])
    assert quality.score_documents(docs([]), model).count() == 0 and quality.keep_good(docs([]), model).count() == 0


def test_quality_without_enough_labels(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    df = docs([(1, "a"), (2, None)])
    assert quality.train(df, labels) is None
    assert quality.train(docs([]), labels.limit(0)) is None
    assert [r["predicted"] for r in quality.score_documents(df, None).collect()] == [1, 1]
    assert quality.keep_good(df, None).count() == 2


def test_language_on_held_out_rows(tables):
    docs, _ = tables
    rows = language_id.predict(docs, language_id.train(docs)).join(docs.select("doc_id", "lang"), "doc_id").filter(
        "held_out AND lang IS NOT NULL AND lang_pred <> 'und'").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98


def test_language_needs_only_the_text(tables):
    docs, _ = tables
    model = language_id.train(docs)
    some = docs.limit(50)
    blank = some.withColumn("lang", language_id.F.lit("xx")).withColumn("source", language_id.F.lit(None))
    a, b = (sorted(map(tuple, language_id.predict(d, model).collect())) for d in (some, blank))
    assert a == b


def test_language_of_odd_rows(spark, docs, odd_texts):
    train = spark.createDataFrame([(i, t, x) for i in range(12) for t, x in (("the cat and the dog", "en"), ("der hund und die katze", "de"))]
                                  + [(50, None, "en"), (51, "no language", None), (52, "123", "zz")], "doc_id long, text string, lang string")
    model = language_id.train(train)
    assert sorted(model) == ["de", "en"]
    rows = [*enumerate(odd_texts), (None, "the the"), (60, "123 !?")]
    got = language_id.predict(docs(rows, CLASHES), model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (0, 1, 2, 60))
    assert by[None]["lang_pred"] == "en" and not by[None]["held_out"]
    none = language_id.train(train.limit(0))
    assert none == {} and {r["lang_pred"] for r in language_id.predict(docs(["the cat"]), none).collect()} == {"und"}
    assert language_id.predict(docs([]), model).count() == 0


def test_bundles_equal_the_definition():
    """Binding by rotated products, bundling by addition, one n-gram at a time."""
    space = language_id.Space(256)
    text, rng = "Ab, ça va? ", random.Random(1)
    letters = " ab ça va "
    want = np.zeros(256)
    for i in range(len(letters) - 2):
        v = np.ones(256)
        for place, c in enumerate(letters[i:i + 3]):
            v = v * np.roll(space.letter(ord(c)), 2 - place)
        want += v
    got = space.bundle([text, "", "".join(rng.choice("xyz ") for _ in range(500))])
    assert np.allclose(got[0], want / np.linalg.norm(want), atol=1e-5)
    assert not got[1].any() and abs(np.linalg.norm(got[2]) - 1) < 1e-5
