"""Hard negatives against all scores, and the walk along the tree."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlens.llm import negatives
from fieldlens.llm.negatives import Mining

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, m=Mining(), anchor=lambda i: i % 50 == 0):
    """Every score; rows are (id, vector, label)."""
    ok = [(i, [math.floor(m.scale * float(x)) for x in v], y) for i, v, y in rows if i is not None and v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v, y in ok:
        if not anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, w, z in ok if j != i and len(w) == len(v))
        for p, j, z in [s for s in scored if s[2] == y][: m.positives]:
            inside = [s for s in scored if s[2] != y and m.low * -p <= 100 * -s[0] <= m.high * -p]
            out += [(i, j, k + 1, n, -p, -s) for k, (s, n, _) in enumerate(inside[: m.negatives])]
    return sorted(out)


def found(spark, rows, m=None):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("own"), "block": F.lit(7), "v": F.lit(None).cast("string")})
    return sorted(tuple(r) for r in negatives.mine(df, F.col("id") % 50 == 0, F.col("label"), m).collect())


def some(n, dim, seed, spread=0.4, centres=6):
    r = np.random.default_rng(seed)
    c = r.normal(size=(centres, dim))
    return [(int(i), [float(x) for x in np.float32(c[i % centres] + spread * r.normal(size=dim))], int(i % 3)) for i in range(n)]


def test_op12_on_the_small_table(spark, small_dir):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in negatives.op12_hard_negatives(spark, small_dir).collect()) == plain(rows)


def test_small_blocks_give_the_same(spark):
    rows = some(600, 8, 1)
    m = Mining(anchor_block=3, row_block=64, pivots=4)
    assert found(spark, rows, m) == plain(rows, m) != []


def test_ties_repeats_and_rows_without_part(spark):
    one = [1.0, 0.5, -0.25]
    rows = [(0, one, 1), (50, one, 1), (50, one, 1), (7, one, 1), (8, one, 1), (3, [0.75, 0.5, 0.25], 2), (4, [0.75, 0.5, 0.25], 2), (4, [0.75, 0.5, 0.25], 2),
            (None, one, 1), (9, None, 1), (10, one, None), (11, [1.0, None, 1.0], 1), (12, [float("nan"), 1.0, 1.0], 2), (13, [float("inf"), 1.0, 1.0], 2), (14, [0.9, 0.4], 2), (100, [], 1), (101, [], 2)]
    got = found(spark, rows)
    assert got == plain(rows) and {r[0] for r in got} == {0, 50}
    assert found(spark, []) == [] and found(spark, rows[3:8]) == []


def test_numbers_beyond_doubles(spark):
    rows = [(i, [float(2.0**22 + 3 * i), 1.0 * i], i % 2) for i in range(0, 120, 10)]
    assert found(spark, rows) == plain(rows)


def test_the_walk_rescores_few_and_bounds_hold():
    r = np.random.default_rng(3)
    centres = r.normal(size=(12, 16)) * 300
    rows = np.floor(centres[r.integers(0, 12, 4000)] + 8 * r.normal(size=(4000, 16))).astype(np.int64)
    anchors = rows[:60]
    walk = negatives.Walk(anchors, rows)
    exact = anchors @ rows.T

    def wanted(k, low, high):
        assert (low <= exact[k] + 1e-6).all() and (high >= exact[k] - 1e-6).all()
        return high >= negatives._nth_largest(low, 5)

    for k, at, scores in walk.each(wanted):
        assert (scores == exact[k][at]).all()
        assert set(np.sort(exact[k])[-5:]) <= set(scores)
    assert walk.rescored < 0.35 * exact.size


def test_spanning_tree_is_smallest():
    x = np.random.default_rng(0).normal(size=(30, 4))
    order, parent, edge = negatives.spanning_tree(x)
    assert sorted(order) == list(range(30)) and all(parent[k] in order[:n] for n, k in enumerate(order) if n)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    joined, total = {0}, 0.0
    while len(joined) < 30:
        w, j = min((d[i, j], j) for i in joined for j in range(30) if j not in joined)
        joined.add(j)
        total += w
    assert edge.sum() == pytest.approx(total)
