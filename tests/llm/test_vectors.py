"""Whitening, the flat graph and hard negatives against brute force, and their defined edge cases."""

from __future__ import annotations

import numpy as np
import pytest
from medallion.llm import flatgraph, gnat, whitening
from medallion.session import ship_package
from pyspark.sql import functions as F

ROWS = "vec_id long, embedding array<float>, label int, node string, cells int, n long, rank int, asks string, own int"
CLASH = ("x", 1, 2, 3, "y", 4)


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, *CLASH) for i, v, label in rows], ROWS)


def odd(dim):
    """Vectors that take no part."""
    nan, inf = float("nan"), float("inf")
    return [(900, None, 1), (901, [nan] * dim, 1), (902, [None] * dim, 1), (903, [inf] * dim, 1), (905, [], 1)]


def some(count, dim, seed=0):
    return np.random.default_rng(seed).normal(size=(count, dim)).astype(np.float32)


def as_rows(x, labels=3):
    return [(i, [float(c) for c in v], i % labels) for i, v in enumerate(x)]


# 11 whitening

def plain_whitening(x):
    x = np.floor(64 * x.astype(np.float64)) + 1e6
    c = x - x.mean(axis=0)
    e, v = np.linalg.eigh(c.T @ c / len(x))
    return x.astype(np.int64), c, e[::-1], v[:, ::-1]


@pytest.mark.parametrize("scales", [np.linspace(1, 3, 6), 10.0 ** np.arange(3, -3, -1)])
def test_whitening_equals_eigenvectors(spark, scales):
    given = some(500, 6) * scales.astype(np.float32) + 5
    df = vectors(spark, as_rows(given) + odd(6) + [(904, [1.0] * 3, 0)])
    found = whitening.whitened(df, 4).orderBy("vec_id", "component").toPandas()
    x, c, e, v = plain_whitening(given)
    assert len(found) == 2000 and set(found.n) == {500}
    expected = (c @ v[:, :4]) / np.sqrt(e[:4])
    mine = found.whitened.to_numpy().reshape(-1, 4)
    signs = np.sign((mine * expected).sum(axis=0))
    assert np.abs(mine * signs - expected).max() < 1e-7
    assert np.allclose(found.explained.to_numpy().reshape(-1, 4)[0], e[:4] / e.sum(), rtol=1e-6)
    assert found.identity_error.max() < 1e-9 and found.identity_error.nunique() == 1
    exact = [sum((500 * int(a) - int(s)) ** 2 for a, s in zip(r, x.sum(axis=0))) for r in x]
    assert found.deviation.to_numpy().reshape(-1, 4)[:, 0].tolist() == exact


def test_whitening_without_variance(spark):
    flat = some(50, 4)
    flat[:, 2] = 7
    flat[:, 3] = flat[:, 0]
    found = whitening.whitened(vectors(spark, as_rows(flat))).orderBy("vec_id", "component").toPandas()
    table = found.whitened.to_numpy().reshape(-1, 4)
    assert np.isfinite(table[:, :2]).all() and np.isnan(table[:, 2:]).all() and found.identity_error.max() < 1e-9
    assert found.explained.to_numpy()[:4].tolist()[2:] == [0.0, 0.0]
    same = whitening.whitened(vectors(spark, [(1, [1.0, 2.0], 0)] * 3 + [(None, [1.0, 2.0], 0)])).toPandas()
    assert len(same) == 8 and same.whitened.isna().all() and same.explained.isna().all() and (same.deviation == 0).all()
    assert same.vec_id.isna().sum() == 2
    assert whitening.whitened(vectors(spark, odd(3))).count() == whitening.whitened(vectors(spark, []).limit(0)).count() == 0


def test_whitening_keeps_large_numbers_exact(spark):
    found = whitening.whitened(vectors(spark, [(1, [1e30, 1.0], 0), (2, [-1e30, 2.0], 0)])).toPandas()
    assert set(found.deviation) == {whitening._LONG}
    model = whitening.Fit(3, (3 * 10**6, 9))
    x = np.array([[10**6 + 2**40, 3]])
    assert model.deviations(x).tolist() == [min((3 * 2**40) ** 2, whitening._LONG)]


# 12 flat graph

def plain_links(rows, least=0.9):
    """(vec_id, links, component) of every row."""
    units = {}
    for at, (_, v, _) in enumerate(rows):
        if v and all(c is not None and np.isfinite(c) for c in v) and any(v):
            a = np.array(v, dtype=np.float32).astype(float)
            units[at] = a / np.sqrt(a @ a)
    links = {at: [b for b in units if b != at and len(units[b]) == len(units[at]) and units[at] @ units[b] >= least] if at in units else [] for at in range(len(rows))}
    out = []
    for at, (vec_id, _, _) in enumerate(rows):
        seen, waiting = {at}, [at]
        while waiting:
            for b in links[waiting.pop()]:
                if b not in seen:
                    seen.add(b)
                    waiting.append(b)
        known = [rows[b][0] for b in seen if rows[b][0] is not None]
        out.append((vec_id, len(links[at]), min(known, default=None)))
    return out


def near_copies(count, dim, groups, seed=3):
    rng = np.random.default_rng(seed)
    x = some(count, dim, seed)
    for size in groups:
        base = rng.normal(size=dim)
        at = rng.choice(count, size, replace=False)
        x[at] = base + rng.normal(size=(size, dim)) * rng.choice([0.02, 0.1, 0.25])
    return x


def found_links(df, **how):
    out = flatgraph.near_duplicates(df, **how).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out if r.vec_id is not None and r.component_id is not None)
    key = lambda r: tuple((v is not None, v) for v in r)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=key)


def test_flat_graph_equals_brute_force(spark):
    rows = as_rows(near_copies(600, 16, (2, 2, 3, 9, 60, 120)))
    rows += [(700 + i, rows[0][1], 0) for i in range(40)] + [(5, rows[6][1], 0), (5, rows[5][1], 0)]
    rows += [*odd(16), (904, [0.0] * 16, 1), (905, [1.0, 0.0], 1), (906, [2.0, 0.1], 1)]
    rows += [(None, rows[1][1], 1), (None, [float(c) for c in some(1, 16, 8)[0]], 1), (None, None, 0)]
    rows += [(950, [3 * c for c in rows[2][1]], 1), (951, [-c for c in rows[2][1]], 1)]
    key = lambda r: tuple((v is not None, v) for v in r)
    assert found_links(vectors(spark, rows)) == sorted(plain_links(rows), key=key)
    assert flatgraph.near_duplicates(vectors(spark, []).limit(0)).count() == 0
    assert found_links(vectors(spark, odd(2))) == [(i, 0, i) for i, _, _ in odd(2)]


def test_flat_graph_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(flatgraph, "SHARD", 64)
    monkeypatch.setattr(flatgraph, "CENTRES", 8)
    x = near_copies(900, 16, (2, 3, 4, 5, 40, 300))
    expected = plain_links(as_rows(x))
    found = found_links(vectors(spark, as_rows(x)))
    links = sum(n for _, n, _ in expected)
    assert all(a[1] <= b[1] for a, b in zip(found, sorted(expected)))
    assert sum(n for _, n, _ in found) >= 0.95 * links
    assert np.mean([a == b for a, b in zip(found, sorted(expected))]) > 0.9


def test_too_little_overlap_is_raised_until_links_are_found(spark, monkeypatch):
    monkeypatch.setattr(flatgraph, "SHARD", 32)
    seen = []
    real = flatgraph.audited
    monkeypatch.setattr(flatgraph, "audited", lambda *a: seen.append(real(*a)) or seen[-1])
    rng = np.random.default_rng(1)
    base = some(300, 24)
    twins = base + rng.normal(size=base.shape).astype(np.float32) * 0.4
    rows = as_rows(np.concatenate([base, twins]))
    found = found_links(vectors(spark, rows), overlap=1)
    assert len(seen) > 1 and seen == sorted(seen)
    assert sum(n for _, n, _ in found) >= 0.9 * sum(n for _, n, _ in plain_links(rows))


def test_large_and_small_vectors_have_directions():
    x = flatgraph.unit(np.array([[3e300, 4e300], [3e-300, 4e-300]]))
    assert np.allclose(x, [[0.6, 0.8]] * 2)


def test_cells_of_two_levels_agree_with_all_sums():
    x = some(200, 5).astype(float)
    levels = [some(4, 5, 1).astype(float), some(3, 5, 2).astype(float) / 4]
    every = np.array([a + b for a in levels[0] for b in levels[1]])
    nearest = flatgraph._apart(x, every).argmin(axis=1)
    assert np.mean(flatgraph.nearest_cells(x, levels, 4)[:, 0] == nearest) > 0.95


# 13 hard negatives

def plain_negatives(rows, every=10, low=30, high=90):
    real = [(i, label, np.floor(256 * np.array(v, dtype=np.float32).astype(float)).astype(int)) for i, v, label in rows
            if i is not None and label is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    out, asked = [], set()
    for i, label, v in sorted(real, key=lambda r: (r[0], r[1], r[2].tolist())):
        if i % every or i in asked:
            continue
        asked.add(i)
        scored = sorted((-int(v @ w), j, other) for j, other, w in real if j != i and len(w) == len(v))
        for s, p, _ in [r for r in scored if r[2] == label][:5]:
            fits = [(n, -m) for m, n, other in scored if other != label and low * -s <= 100 * -m <= high * -s]
            out += [(i, p, rank, n, -s, m) for rank, (n, m) in enumerate(fits[:10], 1)]
    return sorted(out)


def mined(df, every=10):
    return sorted(tuple(r) for r in gnat.hard_negatives(df, F.expr(f"vec_id % {every} = 0")).collect())


@pytest.mark.parametrize("shard", [gnat.SHARD, 50])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(gnat, "SHARD", shard)
    monkeypatch.setattr(gnat, "QUERY_BLOCK", 40)
    x = near_copies(700, 6, (30, 200)).round(1)
    rows = as_rows(x) + [(1000 + i, as_rows(x)[0][1], i % 3) for i in range(150)]
    rows += [*odd(6), (910, [1.0] * 5, 1), (911, [1.0, 2.0, 1.0, 1.0, 1.0], 2), (920, as_rows(x)[1][1], None), (None, [1.0] * 6, 1)]
    assert mined(vectors(spark, rows)) == plain_negatives(rows)


def test_hard_negatives_edge_cases(spark):
    assert mined(vectors(spark, []).limit(0)) == [] and mined(vectors(spark, odd(3))) == []
    assert mined(vectors(spark, [(10, [0.0, 0.0], 1)])) == []
    rows = [(10, [1.0, 0.0], 1), (11, [0.0, 1.0], 1), (12, [0.0, 1.0], 2), (13, [-1.0, 0.0], 1), (14, [0.5, 0.0], 2)]
    assert mined(vectors(spark, rows)) == plain_negatives(rows) == [(10, 11, 1, 12, 0, 0)]
    twins = [(10, [1.0, 0.5], 1), (10, [1.0, 0.25], 1), (11, [1.0, 0.0], 1), (11, [1.0, 0.0], 1), (12, [0.5, 0.5], 2)]
    assert mined(vectors(spark, twins)) == plain_negatives(twins)


def test_tree_leaves_out_what_the_ring_misses(monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 8)) * 300
    x = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(size=(4000, 8)) * 10)
    space = gnat.Space(float(np.sqrt((x * x).sum(axis=1).max())))
    computed = []
    real = gnat.products
    monkeypatch.setattr(gnat, "products", lambda a, b: computed.append(len(a) * len(b)) or real(a, b))
    ask = gnat.Ask(x[::400], np.arange(0, 4000, 400), np.zeros(10, int), np.full(10, -2**40), np.full(10, 2**40))
    labels = np.zeros(4000, int)
    found = gnat.search(x, np.arange(4000), labels, space, ask, 5, True)
    assert sum(computed) < 0.6 * 10 * 4000
    for at, line in zip(range(0, 4000, 400), found):
        scores = x @ x[at]
        best = sorted((-int(s), i) for i, s in enumerate(scores) if i != at)[:5]
        assert [(-s, i) for s, i in line] == best
