"""Clustering in order against a plain loop, at several block sizes."""

import math
import random

import pytest
from pyspark.sql import functions as F

from fieldlens.config import HotspotConfig
from fieldlens.operators import hotspots as H


def angle(a, b):
    (y1, p1), (y2, p2) = ((math.radians(y), math.radians(p)) for y, p in (a, b))
    c = math.sin(p1) * math.sin(p2) + math.cos(p1) * math.cos(p2) * math.cos(y1 - y2)
    return math.degrees(math.acos(max(-1.0, min(1.0, c))))


def loop(rows, n_frames, radius, coverage):
    clusters = []
    for frame, _, yaw, pitch, conf, crop in sorted(rows):
        for c in clusters:
            if angle((yaw, pitch), c["at"]) < radius:
                n = len(c["frames"])
                c["at"] = ((c["at"][0] * n + yaw) / (n + 1), (c["at"][1] * n + pitch) / (n + 1))
                break
        else:
            c = {"at": (yaw, pitch), "frames": set(), "conf": [], "crops": {}}
            clusters.append(c)
        c["frames"].add(frame)
        c["conf"].append(conf)
        c["crops"][crop] = c["crops"].get(crop, 0) + 1
    return {
        k: (round(c["at"][0], 6), round(c["at"][1], 6), len(c["frames"]), round(sum(c["conf"]) / len(c["conf"]), 6), c["crops"])
        for k, c in enumerate(clusters) if len(c["frames"]) / n_frames >= coverage
    }


@pytest.mark.parametrize("block", [7, 25, 1000])
def test_equal_to_a_plain_loop(spark, block):
    draw = random.Random(5)
    spots = [(-170.0, 5.0), (-20.0, -10.0), (-14.0, -9.0), (60.0, 3.0), (178.0, 0.0)]
    clips = {}
    for clip in ("a", "b"):
        rows = []
        for frame in range(60):
            for y, p in spots:
                if draw.random() < 0.7:
                    rows.append((frame, len(rows), y + draw.uniform(-4, 4), p + draw.uniform(-3, 3), draw.random(), float(draw.choice([0, 90]))))
            if draw.random() < 0.5:
                rows.append((frame, len(rows), draw.uniform(-180, 180), draw.uniform(-40, 40), draw.random(), 180.0))
        clips[clip] = rows
    det = spark.createDataFrame([(c, *r) for c, rows in clips.items() for r in rows],
                                "clip_id string, frame int, det_id long, yaw double, pitch double, raw_conf double, crop_yaw double")
    frames = spark.range(60).select(F.explode(F.array(F.lit("a"), F.lit("b"))).alias("clip_id"), F.col("id").cast("int").alias("frame"))
    cfg = HotspotConfig(leader_min_coverage=0.3)
    got = {}
    for r in H.leader_clusters(det, frames, cfg, block).collect():
        got.setdefault(r["clip_id"], {})[r["cluster"]] = (round(r["yaw"], 6), round(r["pitch"], 6), r["frame_count"], round(r["mean_conf"], 6), r["crops"])
    for clip, rows in clips.items():
        assert got[clip] == loop(rows, 60, cfg.leader_radius_deg, 0.3) and len(got[clip]) >= 4


def test_no_detections_no_regions(spark):
    det = spark.createDataFrame([], "clip_id string, frame int, det_id long, yaw double, pitch double, raw_conf double, crop_yaw double")
    frames = spark.createDataFrame([("a", 0)], "clip_id string, frame int")
    assert H.leader_clusters(det, frames).isEmpty()
