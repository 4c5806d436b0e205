import re
from collections import Counter

import numpy as np
import pytest
from conftest_llm import CLASHES, collect

from sitelens.llm import phrases as P

COLS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(rows, least, top, cover=80):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0A-\x0D]", lower(text)):
            ws = [w for w in re.split("[\x20\x09]+", piece) if w]
            total[lang] += len(ws)
            for k in range(1, 5):
                counts.setdefault(lang, Counter()).update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, f in counts.items():
        cands = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        inner = Counter()
        for g, a in cands.items():
            for m in range(2, len(g)):
                for i in range(len(g) - m + 1):
                    inner[g[i:i + m]] = max(inner[g[i:i + m]], a)
        found = []
        for g, a in cands.items():
            if 100 * inner[g] >= cover * a:
                continue
            score, cut = min((2_000_000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), f[g[:cut]], f[g[cut:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, total[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out)


def rows(n, seed, vocabulary=12, lang=("en", "de", None)):
    g = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(vocabulary - 3)] + ["Ünlü", "a" * 40, "x" * 16]
    out = []
    for i in range(n):
        text = "".join(words[min(int(g.geometric(0.25)), vocabulary) - 1] + g.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "! "]) for _ in range(g.integers(0, 60)))
        out.append((i, text.upper() if i % 4 == 0 else text, lang[i % len(lang)]))
    return out


def table(spark, rs, extra=""):
    df = spark.createDataFrame(rs, "doc_id long, text string, lang string").repartition(4)
    return df.selectExpr("*", *[f"'x' AS {c}" for c in extra.split()])


@pytest.fixture(autouse=True)
def _prepared(spark):
    from sitelens.llm.common import prepare
    prepare(spark)


@pytest.mark.parametrize("least,top", [(4, 50), (9, 2000)])
def test_against_brute_force(spark, least, top):
    rs = rows(160, 1) + [(None, "w1 w2 w3 w4 w1 w2 w3 w4", "en")] * 9 + [(900, None, "en"), (901, "", None), (902, " .,;\n\t", "de")]
    got = collect(P.collocations(table(spark, rs, CLASHES + " k phrase a l r rank score piece"), least, top), *COLS)
    assert got == brute([(x[2], x[1]) for x in rs], least, top)


def test_sample_never_changes_the_result(spark):
    """No sample, a sample of all rows, and phrases of four words that the sample hasn't got."""
    rs = rows(60, 2) + [(5000 + i, "only here rarely seen. only here rarely seen", "en") for i in range(12)]
    docs = table(spark, rs)
    found = [collect(P.frequent_phrases(docs.filter("doc_id IS NOT NULL"), 5, sample, count), "lang", "k", "phrase", "n")
             for sample, count in ((1, 1), (3, 2), (10 ** 9, 2), (2, 10 ** 9))]
    assert all(f == found[0] for f in found) and ("en", 4, "only here rarely seen", 24) in found[0]


def test_border_failures_are_expanded(spark, monkeypatch):
    """With an empty sample all words fail; one expansion finds all levels."""
    seen = []
    real = P._counted
    monkeypatch.setattr(P, "_counted", lambda docs, bits, phrases, *shared: seen.append(phrases) or real(docs, bits, phrases, *shared))
    rs = [(i, "alpha beta gamma delta", "en") for i in range(30)]
    got = collect(P.frequent_phrases(table(spark, rs), 30, sample=10 ** 9), "k", "phrase", "n")
    assert (4, "alpha beta gamma delta", 30) in got and seen[3:] == [P._border, P._around]


def test_digests_that_meet(spark):
    """Phrases whose digests are equal are told apart and counted by their texts."""
    rs = rows(60, 5, lang=("en",))
    want = collect(P.frequent_phrases(table(spark, rs), 5), "lang", "k", "phrase", "n")
    assert len(want) > 60
    assert collect(P.frequent_phrases(table(spark, rs), 5, bits=4), "lang", "k", "phrase", "n") == want


def test_one_group_holds_most_rows(spark):
    rs = [(i, "the same words again and again, the same words", "en") for i in range(400)] + rows(40, 3, lang=("fr",))
    got = collect(P.collocations(table(spark, rs), 30), *COLS)
    assert got == brute([(x[2], x[1]) for x in rs], 30, 2000)


def test_empty(spark):
    assert P.collocations(table(spark, rows(3, 1)).limit(0)).count() == 0
    assert P.collocations(table(spark, [(1, None, None)])).count() == 0


def test_long_text_and_many_batches(spark, monkeypatch):
    text = " ".join(f"w{i % 7}" for i in range(60_000)) + " é " + "z" * 100_000
    rs = [(1, text, "en"), (2, text, "en"), (3, "w1 w2", "fr")]
    got = collect(P.collocations(table(spark, rs), 30), *COLS)
    assert got == brute([(x[2], x[1]) for x in rs], 30, 2000)
