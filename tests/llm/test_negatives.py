"""Hard negatives against all products, and the bounds that spare them."""

import random

import duckdb
import numpy as np
import pytest

from marketlens.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows):
    taken = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(c is None or not np.isfinite(c) for c in v):
            continue
        whole = [int(np.floor(256 * float(np.float32(c)))) for c in v]
        key = ((label + 1) % 10 if i % 7 == 0 else label, whole)
        taken[i] = min(taken.get(i, key), key)
    out = []
    for a, (label, v) in taken.items():
        if a % 50:
            continue
        others = [(-sum(x * y for x, y in zip(v, w, strict=False)), i, other == label) for i, (other, w) in taken.items() if i != a]
        for score, p, _ in sorted(o for o in others if o[2])[:5]:
            inside = sorted(o for o in others if not o[2] and 50 * -score <= 100 * -o[0] <= 95 * -score)[:3]
            out += [(a, p, k, n, -score, -s) for k, (s, n, _) in enumerate(inside, 1)]
    return sorted(out)


def found(df, **kw):
    return sorted(tuple(r) for r in negatives.mine(df, **kw).select(*NAMES).collect())


def clustered(seed, count, width=12, centres=6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, width))
    rows = []
    for i in range(count):
        c = int(rng.integers(centres))
        v = middle[c] + 0.15 * rng.normal(size=width)
        rows.append((i, (v / np.linalg.norm(v)).astype(np.float32).tolist(), c if rng.random() < 0.7 else int(rng.integers(10))))
    return rows


def test_clusters_equal_brute_force(spark):
    rows = clustered(1, 1500)
    want = brute(rows)
    assert len(want) > 100
    for block in (4, 256):
        assert found(spark.createDataFrame(rows, SCHEMA).repartition(3), block=block) == want


def test_odd_rows(spark):
    rng = random.Random(3)
    vector = lambda n=6: [rng.uniform(-1, 1) for _ in range(n)]
    rows = [(i, vector(), rng.randrange(3)) for i in range(300)]
    rows += [(300, None, 1), (350, vector(), None), (400, [1.0, None], 1), (450, [float("nan")] * 6, 1), (500, [float("inf")] * 6, 2), (None, vector(), 1)]
    rows += [(550, vector(3), 1), (551, [], 1), rows[50], rows[1], (100, vector(), 2), (-50, vector(), 0), (600, rows[0][1], 1), (601, rows[0][1], 2)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", score string, block int").repartition(4)
    assert found(df) == brute(rows)
    assert found(df.limit(0)) == []
    assert negatives.mine(df.filter("vec_id % 50 <> 0")).count() == 0
    assert negatives.mine(df).columns == NAMES


def test_large_components_are_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-3e5, 3e5) for _ in range(5)], i % 2) for i in range(120)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_tree_is_a_smallest_spanning_tree():
    rng = np.random.default_rng(5)
    v = rng.integers(-50, 50, (40, 6))
    parent, edge, depth = negatives.spanning_tree(v)
    apart = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1).astype(float))
    assert (parent == -1).sum() == 1 and (depth[parent[parent >= 0]] + 1 == depth[parent >= 0]).all()
    assert np.allclose(edge[parent >= 0], apart[np.flatnonzero(parent >= 0), parent[parent >= 0]])
    edges = sorted((apart[i, j], i, j) for i in range(40) for j in range(i))
    root, total = list(range(40)), 0.0
    for d, i, j in edges:
        if root[i] != root[j]:
            total += d
            root = [root[i] if r == root[j] else r for r in root]
    assert edge.sum() == pytest.approx(total)


def test_bounds_spare_products_and_lose_nothing():
    """Anchors close to each other: most candidates are decided by their parent's score."""
    rng = np.random.default_rng(6)
    anchors = rng.integers(-100, 100, 32) + rng.integers(-2, 3, (64, 32))
    x = rng.integers(-100, 100, (2000, 32))
    x[:20] = anchors[:20]
    parent, edge, depth = negatives.spanning_tree(anchors)
    low = np.full((64, 1), int(0.8 * (anchors[0] ** 2).sum()))
    block = negatives.Block(np.arange(64), np.zeros(64), anchors, parent, edge, depth, True, low, np.full((64, 1), 2**62), 5)
    scores, scored = negatives.bounded_scores(block, x, np.ones((2000, 64), bool))
    exact = x @ anchors.T
    assert (scores[exact >= low[0]] == exact[exact >= low[0]]).all()
    assert scored < 0.15 * exact.size


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, folder):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = sorted(con.sql(f"SELECT {', '.join(NAMES)} FROM ({negatives.SQL})").fetchall())
    assert sorted(tuple(r) for r in negatives.op11_hard_negatives(spark, folder).select(*NAMES).collect()) == want
