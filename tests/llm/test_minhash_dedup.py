import random

import numpy as np
import pytest

from conftest_llm import CLASHES, brute_shingles
from sitelens.llm import minhash_dedup
from sitelens.llm.shingles import Hasher, overlap


def brute(rows, percent=85):
    sets = [brute_shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and None not in (rows[a][0], rows[b][0]):
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * len(sets[a] | sets[b]):
                    label[root(a)] = root(b)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[root(i)] = min(low.get(root(i), doc), doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        comp = None if doc is None else low[root(i)] if sets[i] else doc
        out.append((doc, len(sets[i]), comp, doc == comp))
    return sorted(out, key=repr)


def answer(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()), key=repr)


def corpus(seed, n, edits):
    rng = random.Random(seed)
    bases = [[f"v{rng.randrange(400)}" for _ in range(rng.choice([6, 12, 40, 150]))] for _ in range(6)]
    out = []
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(5)}"
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("percent", [80, 85])
def test_components_against_brute_force(docs, percent):
    rows = corpus(1, 220, 5)
    assert answer(minhash_dedup.near_duplicates(docs(rows), percent)) == brute(rows, percent)


def test_odd_texts_null_ids_and_clashing_columns(docs, odd_texts):
    rows = list(enumerate(odd_texts)) + [(None, "same text here"), (None, None)]
    assert answer(minhash_dedup.near_duplicates(docs(rows, CLASHES))) == brute(rows)
    assert minhash_dedup.near_duplicates(docs([])).count() == 0


def test_chain_is_one_component(docs):
    """Neighbours link, the ends don't."""
    words = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i:4 * i + 100])) for i in range(40)]
    got = answer(minhash_dedup.near_duplicates(docs(rows)))
    assert got == brute(rows) and {r[2] for r in got} == {0}


def test_large_group_of_near_copies(docs):
    """A third of all rows is one group of distinct near copies."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(900):
        w = list(base) if i % 3 == 0 else [f"r{rng.randrange(10 ** 6)}" for _ in range(30)]
        if i % 3 == 0:
            w[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(w)))
    assert answer(minhash_dedup.near_duplicates(docs(rows))) == brute(rows)


def test_stage_keeps_one_of_each_group(docs):
    rows = corpus(2, 80, 3)
    df = docs(rows, "rep bands")
    out = minhash_dedup.drop_near_copies(df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(r[0] for r in brute(rows) if r[3])


def test_shingle_digests_equal_shingles():
    rng = random.Random(5)
    hasher = Hasher()
    texts = ["", " ", "a", "A a", "a b c d", "a b c d e", "É é x", "\u0085 y \x1c z"]
    texts += ["".join(rng.choice("aB \t\n\x0b\x1cé中") for _ in range(rng.randrange(80))) for _ in range(300)]
    sets = [hasher.shingles(t.encode()) for t in texts]
    exact = [brute_shingles(t) for t in texts]
    for s, e in zip(sets, exact):
        assert len(s) == len(e)
    for i in range(0, len(texts) - 1):
        assert overlap(sets[i], sets[i + 1]) == len(exact[i] & exact[i + 1])


def test_signature_agreement_estimates_similarity():
    """Minimum and maximum of a permutation agree as often as the sets overlap."""
    rng = np.random.default_rng(1)
    both, a, b = (rng.integers(1, 2 ** 63, n, dtype=np.uint64) for n in (850, 75, 75))
    keys = [minhash_dedup.band_keys(np.unique(np.concatenate((both, x))), 600) for x in (a, b)]
    assert abs((keys[0][0] == keys[1][0]).mean() - 0.85 ** 6) < 0.08


def test_sketches_never_fall_short_at_the_threshold(spark):
    """Agreement at similarity 0.85 stays above the bound in many draws, and
    the column expression counts it right."""
    rng = np.random.default_rng(2)
    bands = minhash_dedup.bands_for(85)
    n, least = 6 * bands, minhash_dedup.least_agreement(85, bands)
    assert 0.6 * n < least < 0.85 * n
    rows, want = [], []
    for size in (17, 60, 400) * 40:
        both = rng.integers(1, 2 ** 63, round(size * 0.85), dtype=np.uint64)
        own = rng.integers(1, 2 ** 63, size - len(both), dtype=np.uint64)
        half = len(own) // 2
        x, y = (np.unique(np.concatenate((both, o))) for o in (own[:half], own[half:]))
        sx, sy = (minhash_dedup.band_keys(s, bands)[1] for s in (x, y))
        nibbles = [(s.view(np.uint64)[:, None] >> (np.arange(16, dtype=np.uint64) * np.uint64(4)) & np.uint64(15)).ravel()[:n] for s in (sx, sy)]
        want.append(int((nibbles[0] == nibbles[1]).sum()))
        rows.append(([int(v) for v in sx], [int(v) for v in sy]))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>").coalesce(1)
    got = [r["k"] - (-n % 16) for r in df.select(minhash_dedup._agreement("a", "b").alias("k")).collect()]
    assert got == want and min(want) >= least


def test_every_accepted_threshold_meets_the_miss_chance():
    assert [minhash_dedup.bands_for(p) for p in (80, 85, 100)] == [61, 39, 1]
    for percent in range(49, 100):
        assert (1 - (percent / 100) ** 6) ** minhash_dedup.bands_for(percent) <= minhash_dedup.MISS
    for percent in (0, 10, 40, 48):
        with pytest.raises(ValueError, match="bands"):
            minhash_dedup.bands_for(percent)
