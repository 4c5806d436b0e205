import os
import shutil
import subprocess
import sys

import pytest

import corpus_pipeline
from sitelens.llm import bpe_codec, decontam, exact_dedup, minhash_dedup, queries, quality
from sitelens.llm.common import table

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_take_effect_in_order(spark):
    """The pipeline equals its operators applied one after the other."""
    docs = table(spark, SF, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    def rows(df):
        return {r["doc_id"] for r in df.collect()}

    def pick(ids):
        return docs.filter(docs["doc_id"].isin(sorted(ids)))

    model = quality.train(docs, table(spark, SF, "labels"))
    ids = rows(quality.score_documents(docs, model).filter("predicted = 1"))
    last = {}
    for i in sorted(ids):
        last[texts[i] or ""] = i
    ids = set(last.values())
    assert ids == rows(exact_dedup.drop_copies(pick(ids)))
    ids = rows(minhash_dedup.near_duplicates(pick(ids), 80).filter("kept"))
    ids -= rows(decontam.contained_items(pick(ids), table(spark, SF, "benchmark")))
    want = {tuple(r) for r in bpe_codec.encode_documents(pick(ids)).collect()}
    got = corpus_pipeline.run(spark, SF)
    assert {tuple(r) for r in got.collect()} == want and 0 < len(want) < len(texts)


def test_stages_keep_the_columns(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == table(spark, SF, "documents").columns


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    from oracle_harness import compare, duck_connect
    got = queries.QUERIES[name](spark, SF).toPandas()
    result = compare(got, duck_connect(SF).execute(queries.ORACLES[name]).df())
    assert result["rows_match"] and result["values_exact"], result


def test_every_query_covers_its_table(spark):
    for name, per in (("op2_bpe_codec", "documents"), ("op5_token_count", "documents"), ("op6_language_id", "documents"),
                      ("op8_url_filter", "pages"), ("op9_quality_classifier", "documents")):
        assert queries.QUERIES[name](spark, SF).count() == table(spark, SF, per).count()


def test_library_works_without_this_package(tmp_path):
    for name in ("sitelens", "__spark_entry__.py"):
        src = os.path.join(ROOT, name)
        if os.path.isdir(src):
            shutil.copytree(src, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(src, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 80 and not any(k.startswith('op1_') for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
