"""The shared ordered scans: every row answered once, whatever its keys, order values and frame sizes."""

import math
import random

import pytest
from pyspark.sql import functions as F

from fieldlens.operators import spatial
from fieldlens.operators.scan import Carry, carry_scan, exact_percentiles, halo_windows, row_index


def table(spark, rows):
    return spark.createDataFrame(rows, "k string, t int, v double")


def test_row_index_keeps_null_keys_and_orders(spark):
    rows = [("a", 1, 1.0), ("a", None, 2.0), (None, 3, 3.0), (None, None, 4.0), (None, 9000, 5.0)]
    got = {r.v: r.rn for r in row_index(table(spark, rows), ["k"], ["t"], F.floor(F.col("t") / 4)).collect()}
    assert got == {2.0: 1, 1.0: 2, 4.0: 1, 3.0: 2, 5.0: 3}


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_carries_match_one_pass(spark, size):
    r = random.Random(4)
    rows = [(k, t, r.choice([None, r.random()])) for k in ("a", None) for t in [None, *range(40)]]
    specs = {"last": Carry("last", F.col("v")), "before": Carry("last", F.col("v"), True), "next": Carry("first", F.col("v"), True), "sum": Carry("sum", F.col("v"))}
    got = {(x.k, x.t): x for x in carry_scan(table(spark, rows), ["k"], ["t"], F.floor(F.col("t") / size), specs).collect()}
    for k in ("a", None):
        line = [x for x in rows if x[0] == k]
        seen, total = None, None
        for i, (_, t, v) in enumerate(line):
            x = got[k, t]
            assert x.before == seen
            seen = v if v is not None else seen
            total = v if total is None else total + (v or 0)
            assert x.last == seen and x.next == next((y[2] for y in line[i + 1 :] if y[2] is not None), None)
            assert x["sum"] == pytest.approx(total) if total is not None else x["sum"] is None


@pytest.mark.parametrize("before, after", [(15, 0), (0, 9), (6, 11), (4, 4)])
def test_halo_reaches_over_several_blocks(spark, before, after):
    df = spark.range(50).select(F.lit("a").alias("k"), (F.col("id") + 1).alias("rn"), F.col("id").cast("double").alias("v"))

    got = halo_windows(df, ["k"], "rn", before, after, lambda w: {"n": F.count("v").over(w.rowsBetween(-before, after)), "s": F.sum("v").over(w.rowsBetween(-before, after))}, size=4)
    for x in got.collect():
        span = range(max(0, x.rn - 1 - before), min(50, x.rn + after))
        assert (x.n, x.s) == (len(span), sum(span))


def test_percentiles_of_null_groups(spark):
    rows = [(k, i, float(i)) for k in ("a", None) for i in range(11)]
    got = {r.k: r.m for r in exact_percentiles(table(spark, rows), ["k"], "v", {"m": 0.5}).collect()}
    assert got == {"a": 5.0, None: 5.0}


def far(a, b, radius):
    y1, p1, y2, p2 = map(math.radians, (a[1], a[2], b[1], b[2]))
    c = math.sin(p1) * math.sin(p2) + math.cos(p1) * math.cos(p2) * math.cos(y1 - y2)
    return math.degrees(math.acos(max(-1, min(1, c)))) > radius + 1e-6


@pytest.mark.parametrize("n", [255, 256, 257])
def test_nms_has_one_rule_for_nulls_and_ties(spark, n):
    r = random.Random(n)
    rows = [(i if r.random() > 0.03 else None, r.uniform(-180, 180), r.uniform(-70, 70), r.choice([None, 0.1, 0.5, 0.5, r.random()])) for i in range(n)]
    schema = "det_id long, yaw double, pitch double, conf double"
    df = spark.createDataFrame(rows, schema).withColumn("clip_id", F.lit(None).cast("string"))
    worst = 1 << 60
    order = sorted(rows, key=lambda x: (x[3] is None, -(x[3] or 0), worst if x[0] is None else x[0]))
    kept = []
    for x in order:
        if all(far(x, k, 14.0) for k in kept):
            kept.append(x)
    got = spatial.greedy_nms(df, ["clip_id"], "conf", "det_id", 14.0).select("det_id", "yaw", "pitch", "conf").collect()
    small = spatial.greedy_nms(df, ["clip_id"], "conf", "det_id", 14.0, fold_limit=5).select("det_id", "yaw", "pitch", "conf").collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, small), key=str)
    fixed = [x for x in rows if x[0] is not None]
    if len(fixed) == n:
        assert sorted(map(tuple, got), key=str) == sorted(kept, key=str)
    else:  # rows without id tie among themselves; the rest of the order is fixed up to the first of them
        first = next((i for i, x in enumerate(order) if x[0] is None), n)
        sure = [x for x in kept if order.index(x) < first]
        assert set(sure) <= {tuple(x) for x in got}


def test_dense_cells_are_not_paired_point_by_point(spark):
    # two crowds of 10,000 points, a cell apart: in reach of each other, with a third crowd out of reach
    pts = spark.range(30_000).select(
        F.lit("c").alias("clip_id"), F.col("id"),
        (F.col("id") % 3 * F.when(F.col("id") % 3 == 2, 20.0).otherwise(3.0) + (F.col("id") % 997) / 997.0).alias("yaw"),
        ((F.col("id") % 1009) / 1009.0).alias("pitch"),
    )
    got = spatial.spatial_components(pts, ["clip_id"], "id", 5.0).groupBy("comp").count().collect()
    assert {r["comp"]: r["count"] for r in got} == {0: 20_000, 2: 10_000}
