import math

import pytest
from pyspark.sql import functions as F

from fieldlens.functions import geo, text


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize("x,want", [(180.0, -180.0), (-180.0, -180.0), (190.0, -170.0), (-540.0, -180.0), (0.0, 0.0)])
def test_wrap_yaw(spark, x, want):
    assert one(spark, geo.wrap_yaw(F.lit(x))) == want


def test_delta_crosses_the_seam(spark):
    assert one(spark, geo.circular_delta(F.lit(-179.0), F.lit(179.0))) == pytest.approx(2.0)


def test_distance_keeps_null_and_zero(spark):
    assert one(spark, geo.angular_distance(F.lit(None).cast("double"), F.lit(0.0), F.lit(1.0), F.lit(1.0))) is None
    assert one(spark, geo.angular_distance(F.lit(10.0), F.lit(5.0), F.lit(10.0), F.lit(5.0))) == 0.0
    assert one(spark, geo.angular_distance(F.lit(179.0), F.lit(0.0), F.lit(-179.0), F.lit(0.0))) == pytest.approx(2.0)


def test_zones_have_inclusive_edges(spark):
    zone = F.array(F.struct(F.lit(10.0).alias("yaw_centre"), F.lit(2.0).alias("yaw_radius"), F.lit(0.0).alias("pitch_centre"), F.lit(1.0).alias("pitch_radius")))
    assert one(spark, geo.in_zones(F.lit(12.0), F.lit(1.0), zone))
    assert not one(spark, geo.in_zones(F.lit(12.1), F.lit(0.0), zone))


def test_polygon(spark):
    square = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (10, 0), (10, 10), (0, 10))])
    assert one(spark, geo.point_in_polygon(F.lit(5.0), F.lit(5.0), square))
    assert not one(spark, geo.point_in_polygon(F.lit(15.0), F.lit(5.0), square))


@pytest.mark.parametrize("t,want", [("1:02:03", 3723.0), ("12:34:00", 754.0), ("2:30", 150.0), ("45.5", 45.5), ("", None), ("soon", None), ("1:2:3:4", None)])
def test_time_text(spark, t, want):
    assert one(spark, text.time_text_seconds(F.lit(t))) == want


def test_day_fraction(spark):
    assert one(spark, text.sheet_number_seconds(F.lit(0.5))) == 43200.0


@pytest.mark.parametrize("u,want", [("https://x/watch?v=abcdefghijk", "abcdefghijk"), ("https://youtu.be/ABCDEFGHIJ_", "ABCDEFGHIJ_"), ("nothing", "")])
def test_video_id(spark, u, want):
    assert one(spark, text.video_id(F.lit(u))) == want


def test_verdict_words(spark):
    assert one(spark, text.normalise_verdict(F.lit(" Likely-Ball "))) == "ball"
    assert one(spark, text.normalise_verdict(F.lit("maybe"))) is None


def test_missing_cue_is_unknown_not_zero(spark):
    from fieldlens.operators.review import TRACK_CUES, fused_score

    cues = {"detector": F.lit(0.8), "view_band": F.lit(0.75), "pose": F.lit(None).cast("double"), "geometry": F.lit(None).cast("double"), "temporal": F.lit(0.5)}
    w = TRACK_CUES
    want = (0.8 * w["detector"] + 0.75 * w["view_band"] + 0.5 * w["temporal"]) / (w["detector"] + w["view_band"] + w["temporal"])
    assert one(spark, fused_score(cues, w)) == pytest.approx(want)


def test_penalty_taper(spark):
    from fieldlens.config import HotspotConfig

    cfg = HotspotConfig()
    got = [one(spark, geo.penalty_weight(F.lit(d), cfg)) for d in (0.05, 0.10, 0.35, 0.60)]
    assert got[0] == 1.0 and got[1] == 1.0 and got[3] == 0.1
    assert got[2] == pytest.approx(0.1 + 0.9 * 0.5 * (1 + math.cos(math.pi * 0.5)))
