import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sitelens.llm.common import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture(scope="session")
def docs(spark):
    """Builds a documents table from texts, or (doc_id, text) pairs."""
    prepare(spark)

    def build(rows, extra=""):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        df = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)
        for name in extra.split():      # columns whose names the operators also use inside
            df = df.selectExpr("*", f"'x' AS {name}")
        return df.repartition(3)
    return build


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, tied, very long and non-ASCII texts."""
    words = [f"w{i % 977}x{i % 13}" for i in range(20_000)]
    return [None, "", " \t\n", "same text here", "same text here", " ".join(words), " ".join(words), "é" * 5000,
            "one", "a b c d e f g", "A B C D E F G", "中文 字符 没有 空格 的 文本", "x" * 30_000, "<|endoftext|> <s> ▁ \u0000 ﻿",
            " ".join(words[5:] + ["tail"])]
