"""Motion terms of tracklets: the way to the previous observation is looked up, and the JVM compiles what is left."""

import math

import pytest
from pyspark.sql import functions as F

from fieldlens.operators import tracklets as T

ROWS = [("a", 1, f, float(y), float(p), 0.5) for f, y, p in ((0, 0, 0), (2, 3, 1), (3, 7, -2), (7, 7, -2), (8, 9, -2), (12, 20, 4))] + [
    ("a", 2, 5, 10.0, 1.0, 0.5), ("b", 1, 4, 1.0, 1.0, 0.5), ("b", 1, 9, 179.0, 1.0, 0.5)]
COLUMNS = "clip_id string, tracklet_id long, frame int, yaw double, pitch double, weighted_conf double"


def unit(y, p):
    y, p = math.radians(y), math.radians(p)
    return (math.cos(p) * math.sin(y), math.sin(p), math.cos(p) * math.cos(y))


def way(a, b):
    """(degrees, unit tangent at a towards b or zero)"""
    dot = sum(i * j for i, j in zip(a, b))
    t = [j - i - (dot - 1) * i for i, j in zip(a, b)]
    n = math.sqrt(sum(x * x for x in t))
    return math.degrees(2 * math.asin(min(1.0, math.dist(a, b) / 2))), tuple(x / n for x in t) if n >= 1e-9 else (0.0, 0.0, 0.0)


@pytest.mark.parametrize("size", [2, 65536])
def test_each_row_has_its_way_and_that_of_the_row_before(spark, size):
    got = T.motion_steps(spark.createDataFrame(ROWS, COLUMNS), size).orderBy("clip_id", "tracklet_id", "frame").collect()
    assert len(got) == len(ROWS)
    for i, r in enumerate(got):
        same = [x for x in ROWS if x[:2] == (r.clip_id, r.tracklet_id) and x[2] <= r.frame]
        for (later, earlier), k, speed in ((same[-1:] + same[-2:-1] if len(same) > 1 else (None, None), r.k_cur, r.speed_cur),
                                           (same[-2:-1] + same[-3:-2] if len(same) > 2 else (None, None), r.k, r.speed)):
            if later is None:
                assert k is None and speed is None
                continue
            deg, t = way(unit(*earlier[3:5]), unit(*later[3:5]))
            assert math.dist((k.x, k.y, k.z), t) < 1e-6
            assert abs(speed - (deg / (later[2] - earlier[2]) if any(t) else 0.0)) < 1e-6


def test_no_generated_method_is_too_long_for_the_compiler(spark):
    """HotSpot leaves methods of over 8,000 bytes to its interpreter."""
    obs = spark.createDataFrame(ROWS, COLUMNS).withColumn("in_static", F.lit(None).cast("string"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stages = T.tracklet_metrics(obs)._jdf.queryExecution().debug().codegenToSeq()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert stages.size() and max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) <= 8000
