import hashlib
from collections import defaultdict

from conftest_llm import CLASHES, collect
from sitelens.llm import exact_dedup
from sitelens.session import scratch_path


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).digest()))
    return sorted(out, key=repr)


def answer(df):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["digest"])) for r in df.collect()), key=repr)


def test_groups_against_brute_force(docs, odd_texts):
    rows = list(enumerate(odd_texts)) + [(None, "same text here"), (None, "only null ids"), (7, "é" * 5000)]
    assert answer(exact_dedup.exact_dedup(docs(rows, CLASHES))) == brute(rows)


def test_hot_group_and_empty_table(docs):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i}") for i in range(3000)]
    assert answer(exact_dedup.exact_dedup(docs(rows))) == brute(rows)
    assert exact_dedup.exact_dedup(docs([])).count() == 0
    assert exact_dedup.drop_copies(docs([])).count() == 0


def test_index_persists_and_repeats(spark, docs):
    path = scratch_path(spark, "index-test")
    index = exact_dedup.DigestIndex(spark, path, 4)
    first = exact_dedup.ingest(index, docs([(1, "a"), (2, "a"), (3, "b")]), "one")
    assert collect(first, "doc_id", "kept") == [(1, False), (2, True), (3, True)]
    spark.sql(f"DROP TABLE {index.name}")        # another session knows only the path
    index = exact_dedup.DigestIndex(spark, path, 4)
    for _ in range(2):                            # a repeated batch gives the same answer
        second = exact_dedup.ingest(index, docs([(9, "a"), (10, "c"), (11, "c")]), "two")
        assert collect(second, "doc_id", "keep_id", "group_size", "kept") == [
            (9, 2, 3, False), (10, 11, 2, False), (11, 11, 2, True)]
    assert index.read().count() == 3


def test_index_side_of_the_anti_join_is_not_shuffled(spark, docs):
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "index-plan"), 4)
    new = exact_dedup.digests(docs(["a", "b"])).withColumn("keep_id", exact_dedup.F.lit(1))
    plan = index.unknown(new)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning(digest") == 1


def test_drop_copies_keeps_columns_and_one_of_each(docs):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, "b"), (4, None), (5, ""), (None, "a"), (None, "z"), (3, "c")]
    df = docs(rows, "digest")
    out = exact_dedup.drop_copies(df)
    assert out.columns == df.columns
    assert collect(out, "doc_id", "text") == [(2, "a"), (3, "b"), (3, "c"), (5, ""), (None, "z")]
    unique = exact_dedup.drop_copies(docs([(1, "a"), (2, "a"), (3, "b")]))
    assert collect(unique, "doc_id") == [(2,), (3,)]


def test_id_ranges_through_one_index(docs, odd_texts, monkeypatch):
    """As one batch, null and repeated ids included; later ranges bring
    texts that the index knows."""
    rows = [(i, t) for i, t in enumerate(odd_texts * 3)] + [(None, "one"), (None, "only null"), (None, "only null"), (3, "same text here"), (3, "b")]
    removed = []
    unknown = exact_dedup.DigestIndex.unknown

    def spy(self, groups):
        out = unknown(self, groups)
        removed.append(groups.count() - out.count())
        return out

    monkeypatch.setattr(exact_dedup.DigestIndex, "unknown", spy)

    def answer(batches):
        out = exact_dedup.exact_dedup(docs(rows), batches=batches)
        return sorted(((r["doc_id"], bytes(r["digest"]), r["keep_id"], r["group_size"], r["kept"]) for r in out.collect()), key=str)

    assert answer(4) == answer(1) and len(removed) == 5
    assert removed[0] == 0 and min(removed[1:4]) > 0 and removed[4] == 0
    for few in ([], [(None, "a"), (None, "a")], [(7, "a"), (7, "a"), (7, "b")]):
        got = exact_dedup.exact_dedup(docs(few), batches=4).collect()
        assert len(got) == len(few) and all(r["kept"] for r in got)


def test_op4_meets_an_index_that_knows_texts(spark, monkeypatch):
    from sitelens.llm import queries
    seen = []
    unknown = exact_dedup.DigestIndex.unknown
    monkeypatch.setattr(exact_dedup.DigestIndex, "unknown", lambda self, groups: seen.append(self.read().count()) or unknown(self, groups))
    queries.QUERIES["op4_exact_dedup"](spark, "/root/testdata/sf0.001").count()
    assert len(seen) == 4 and seen[0] == 0 and min(seen[1:]) > 0
