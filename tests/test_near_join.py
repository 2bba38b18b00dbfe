"""Rows that meet by cell: no broadcast of what grows, and crowded keys meet the same rows as small ones."""

import math

import pytest
from pyspark.sql import functions as F

from fieldlens.operators import crowd, joins, spatial


def points(spark, samples, each):
    r = spark.range(samples * each)
    return r.select(F.lit("c").alias("clip_id"), F.expr(f"cast(id % {samples} as int)").alias("sample"), F.col("id").alias("det_id"),
                    F.expr("cast(id * 37 % 360 as double) - 180").alias("yaw"), F.expr("cast(id * 11 % 60 as double) - 30").alias("pitch"))


def degrees_between(a, b):
    (y1, p1), (y2, p2) = [tuple(map(math.radians, x)) for x in (a, b)]
    return math.degrees(math.acos(max(-1.0, min(1.0, math.sin(p1) * math.sin(p2) + math.cos(p1) * math.cos(p2) * math.cos(y1 - y2)))))


@pytest.mark.parametrize("few", [0, 3, 128])
@pytest.mark.parametrize("reach,half", [(1, False), (2, True)])
def test_near_join_equals_the_copies(spark, few, reach, half):
    at = spatial.with_cell(points(spark, 5, 4).unionByName(points(spark, 1, 9).withColumn("det_id", F.col("det_id") + 100)), 0.4)
    a, b = [at.select("clip_id", "sample", *spatial.CELL, F.col("det_id").alias(n)) for n in "ab"]
    keys = ["clip_id", "sample"]
    want = a.join(spatial.shift_cells(b, reach, half), [*keys, *spatial.CELL]).select("a", "b")
    got = spatial.near_join(a, b, keys, reach, half, few).select("a", "b")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_sides_that_grow_are_not_broadcast(spark):
    p = points(spark, 40, 5)
    obs = p.select("clip_id", F.col("sample").alias("frame"), F.col("det_id").alias("row_id"), "yaw", "pitch")
    det = p.withColumnRenamed("sample", "frame")
    for df in (joins.nearest_in_frame(obs, det, 5.0, "det_id", ["det_id"]), crowd.crowd_clusters(p), spatial.within_pairs(p, ["clip_id", "sample"], "det_id", 25.0)):
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().toString()


def test_crowded_samples_cluster_as_small_ones(spark):
    p = points(spark, 2, 150)
    want = {}
    rows = [tuple(r) for r in p.select("sample", "det_id", "yaw", "pitch").collect()]
    for s in (0, 1):
        here = [r for r in rows if r[0] == s]
        near = {r[1]: [q[1] for q in here if degrees_between(r[2:], q[2:]) <= 6.0 + 1e-9] for r in here}
        for r in here:
            seen, todo = {r[1]}, [r[1]]
            while todo:
                new = [n for n in near[todo.pop()] if n not in seen]
                seen.update(new)
                todo += new
            want[r[1]] = min(seen)
    got = spatial.spatial_components(p, ["clip_id", "sample"], "det_id", 6.0)
    assert {r["det_id"]: r["comp"] for r in got.collect()} == want
