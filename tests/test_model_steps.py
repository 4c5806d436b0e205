"""The model plans read the cleaned venues once; k-means steps and distance sums equal their definitions."""

import numpy as np
import pandas as pd
import pytest

from sitelens.operators import cluster as K
from sitelens.plans import common, io_plans, models
from tables import SF_SMALL


@pytest.mark.parametrize("query", [models.q_label_order, io_plans.q_model_roundtrip])
def test_venues_are_cleaned_once(spark, monkeypatch, query):
    cleaned, venues = [], common.venues
    monkeypatch.setattr(common, "venues", lambda *a: cleaned.append(a) or venues(*a))
    out = query(spark, SF_SMALL)
    assert len(cleaned) == 1
    assert "shawarma" not in out._jdf.queryExecution().toString()     # the rest starts at the checkpoint


def test_step_sums():
    g = np.random.default_rng(1)
    x = np.vstack([g.normal(size=(400, 3)), np.zeros((5, 3))])
    centers = {2: np.array([[1.0, 0, 0], [-1.0, 0, 0]]), 5: g.normal(size=(5, 3))}      # the zeros tie: the first wins
    got = pd.concat(K._step_sums(iter([pd.DataFrame(x[:100]), pd.DataFrame(x[100:])]), centers))
    for k, c in centers.items():
        near = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
        for j in range(len(c)):
            row = got[(got.k == k) & (got.j == j)].iloc[0]
            assert row.n == (near == j).sum() and np.allclose(row[["s0", "s1", "s2"]].to_numpy(float), x[near == j].sum(0))


@pytest.mark.parametrize("tile", [(128, 512), (7, 5)])
def test_distance_sums(monkeypatch, tile):
    g = np.random.default_rng(2)
    monkeypatch.setattr(K, "TILE", tile)
    x, labels = g.normal(size=(60, 2)), np.stack([g.integers(0, 3, 60), g.integers(0, 9, 60)], 1)
    sums = K._DistanceSums(np.arange(20), labels[:20], x[:20])
    sums.add(x[:33], labels[:33])
    sums.add(x[33:], labels[33:])
    d = np.sqrt(((x[:20, None] - x[None]) ** 2).sum(2))
    for (which, c), total in sums.sums.items():
        assert np.allclose(total, d[:, labels[:, which] == c].sum(1)) and sums.counts[which, c] == (labels[:, which] == c).sum()


@pytest.mark.parametrize("tile", [(128, 512), (7, 5)])
def test_blocks_meet_once_for_both(monkeypatch, tile):
    g = np.random.default_rng(3)
    monkeypatch.setattr(K, "TILE", tile)
    x, labels = g.normal(size=(60, 3)), np.stack([g.integers(0, 3, 60), g.integers(0, 9, 60)], 1)
    formed, distances = [], K._distances
    monkeypatch.setattr(K, "_distances", lambda a, b, *to: formed.append(a.shape[1] * b.shape[1]) or distances(a, b, *to))
    one, two = (K._DistanceSums(np.arange(60)[at], labels[at], x[at]) for at in (slice(0, 25), slice(25, 60)))
    one.meet(two)
    assert sum(formed) == 25 * 35
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    for sums, mine, theirs in ((one, slice(0, 25), slice(25, 60)), (two, slice(25, 60), slice(0, 25))):
        assert {s for s in sums.sums} == {(w, c) for w in (0, 1) for c in labels[theirs, w]}
        for (which, c), total in sums.sums.items():
            of = labels[theirs, which] == c
            assert np.allclose(total, d[mine, theirs][:, of].sum(1)) and sums.counts[which, c] == of.sum()


def test_exact_sums_cover_all_pairs_of_blocks(spark):
    g = np.random.default_rng(4)
    x, lab = g.normal(size=(90, 2)), g.integers(0, 4, 90)
    data = spark.createDataFrame([(i, int(c), float(a), float(b)) for i, ((a, b), c) in enumerate(zip(x, lab))], "_id long, _c0 long, _f0 double, _f1 double")
    assert K._blocks(90, 4, 20, 4) == 5
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    got = K._exact_sums(data, ["_f0", "_f1"], ["_c0"], 20).toPandas().groupby(["anchor", "cluster"])[["dsum", "cnt"]].sum()
    assert len(got) == 90 * 4
    for (i, c), row in got.iterrows():
        assert row.cnt == (lab == c).sum() and row.dsum == pytest.approx(d[i, lab == c].sum())
    # many clusters make the blocks smaller, few rows are not cut for the cores
    assert K._blocks(1_200_000, 6, 40_000, 12) == 30 and K._blocks(1_200_000, 4_000, 40_000, 12) == 1_200 and K._blocks(2_000, 6, 40_000, 12) == 1
