"""The pipeline's stages on null, repeated and clashing ids, against brute force."""

import random

import pytest
from conftest_llm import brute_shingles

import corpus_pipeline
from sitelens.llm import decontam, exact_dedup, minhash_dedup, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, digest string, _row long, component_id long"


def words(seed, n):
    g = random.Random(seed)
    return [f"w{g.randrange(10_000)}" for _ in range(n)]


ITEM = " ".join(words("item", 30))
NEAR = words("near", 120)


def rows():
    plain = [" ".join(words(i, 90)) for i in range(12)]
    near = [" ".join(NEAR[:i] + ["changed"] + NEAR[i + 1:]) for i in (5, 60, 119)]
    leak = [" ".join(words(f"leak{i}", 40) + ITEM.split() + words(f"more{i}", 40)) for i in range(4)]
    ids = [
        (1, plain[0]), (1, near[0]), (1, leak[0]),              # namesakes: a plain text, a copy and a leak
        (2, near[1]), (None, near[2]), (2, plain[1]),
        (None, leak[1]), (None, plain[2]), (None, plain[2]), (None, plain[3]),     # null ids
        (3, plain[4]), (3, plain[4]), (4, plain[4]),            # equal rows and equal texts
        (5, None), (5, ""), (None, None), (6, " \t\n"), (6, "a b"), (7, "a b"), (8, ITEM), (9, leak[2] + " " + leak[3]),
        (10, " ".join(words("long", 30_000))), (None, " ".join(words("long", 30_000)))]
    return ids


@pytest.fixture()
def docs(spark):
    from sitelens.llm.common import prepare
    prepare(spark)
    full = [(i, t, "en", "s", 1, "clash", k, 7) for k, (i, t) in enumerate(rows())]
    return spark.createDataFrame(full, SCHEMA).repartition(4)


def kept(df):
    return sorted(r["_row"] for r in df.collect())


def groups(texts, percent):
    """Components over rows by brute force."""
    sets = [brute_shingles(t) for t in texts]
    comp = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = comp[a], comp[b]
                comp = [x if c == y else c for c in comp]
    return comp


def test_near_copies(docs):
    rs = rows()
    comp = groups([t for _, t in rs], 80)
    out = minhash_dedup.drop_near_copies(docs, 80)
    assert out.columns == docs.columns
    left = kept(out)
    for c in set(comp):
        members = [k for k in range(len(rs)) if comp[k] == c]
        stay = [k for k in members if k in left]
        assert len(stay) == 1
        known = [rs[k][0] for k in members if rs[k][0] is not None]
        assert rs[stay[0]][0] == (min(known) if known else None)


def test_leaks(spark, docs):
    items = spark.createDataFrame([(0, ITEM), (0, "not in any text of these at all"), (None, " ".join(words(4, 90)[10:40])), (2, None), (3, "")],
                                  "item_id long, text string")
    sets = [brute_shingles(t) for t in (ITEM, " ".join(words(4, 90)[10:40]))]
    want = [k for k, (_, t) in enumerate(rows()) if not any(100 * len(brute_shingles(t) & s) >= 80 * len(s) for s in sets)]
    out = decontam.drop_contaminated(docs, items)
    assert kept(out) == want and len(want) < len(rows()) and out.columns == docs.columns


def test_exact_copies(docs):
    out = exact_dedup.drop_copies(docs)
    left, rs = kept(out), rows()
    by_text = {}
    for k, (_, t) in enumerate(rs):
        by_text.setdefault(t or "", []).append(k)
    assert len(left) == len(by_text) and out.columns == docs.columns
    for members in by_text.values():
        (stay,) = [k for k in members if k in left]
        known = [rs[k][0] for k in members if rs[k][0] is not None]
        assert rs[stay][0] == (max(known) if known else None)


def test_quality_reads_one_text_per_id(spark, docs):
    """A labelled id that most rows repeat brings one text, and texts decide row by row."""
    many = docs.select("doc_id", "text").unionByName(spark.range(500).selectExpr("400L AS doc_id", "'same good text again' AS text"))
    good = [(1000 + i, " ".join(words(i, 60))) for i in range(80)]
    bad = [(2000 + i, "buy " * 60 + str(i)) for i in range(80)]
    many = many.unionByName(spark.createDataFrame(good + bad, "doc_id long, text string"))
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(400, 1)], "doc_id long, quality int")
    model = quality.train(many, labels)
    assert model is not None
    out = quality.keep_good(many, model)
    stay = {r["doc_id"] for r in out.collect()}
    assert not stay & {i for i, _ in bad} and len(stay & {i for i, _ in good}) >= 75


def test_all_stages_on_odd_ids(spark, docs, tmp_path):
    sf = str(tmp_path)
    docs.write.parquet(sf + "/documents.parquet")
    spark.createDataFrame([(0, ITEM)], "item_id long, text string").write.parquet(sf + "/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(sf + "/labels.parquet")
    now = spark.read.parquet(sf + "/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf)
        assert now.columns == docs.columns, name
    rs, left = rows(), kept(now)
    texts = [rs[k][1] for k in left]
    assert not any(t and ITEM in t for t in texts)
    filled = [t for t in texts if brute_shingles(t)]
    assert len(set(groups(filled, 80))) == len(filled)
    # every clean text is still there once, or a near copy of it
    for _, t in rs:
        if brute_shingles(t) and ITEM not in t:
            assert any(groups([t, u], 80)[0] == groups([t, u], 80)[1] for u in filled), t[:40]
    assert corpus_pipeline.run(spark, sf).count() == len(left)
