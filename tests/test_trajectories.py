"""Sequential operators: scenarios, brute force on small inputs, independence of block size."""

import math
import random

import pytest
from pyspark.sql import functions as F

from fieldlens.config import CrowdConfig, LinkConfig, LossConfig, RepairConfig
from fieldlens.operators import linking as L
from fieldlens.operators import repair as R
from fieldlens.operators import series as S
from fieldlens.operators import spatial, tracklets, windows

CAND = "clip_id string, frame int, det_id long, yaw double, pitch double, weighted_conf double"


def cands(spark, rows):
    return spark.createDataFrame([("c", f, i, float(y), float(p), float(w)) for i, (f, y, p, w) in enumerate(rows)], CAND)


def frames(spark, n, clip="c"):
    return spark.range(n).select(F.lit(clip).alias("clip_id"), F.col("id").cast("int").alias("frame"))


def test_moving_object_becomes_one_anchor(spark):
    c = cands(spark, [(f, -20 + f * 1.0, 0.0, 0.6) for f in range(20)])
    obs = L.link_tracklets(c, frames(spark, 20))
    t = tracklets.tracklet_status(tracklets.tracklet_metrics(obs)).collect()
    assert len(t) == 1 and t[0]["status"] == "anchor" and t[0]["observation_count"] == 20


def test_link_crosses_the_seam(spark):
    c = cands(spark, [(f, (175 + f * 1.0 + 180) % 360 - 180, 0.0, 0.6) for f in range(12)])
    assert L.link_tracklets(c, frames(spark, 12)).select("tracklet_id").distinct().count() == 1


def test_five_blank_frames_end_a_tracklet(spark):
    four = cands(spark, [(f, 0.0, 0.0, 0.6) for f in (0, 1, 6, 7)])
    five = cands(spark, [(f, 0.0, 0.0, 0.6) for f in (0, 1, 7, 8)])
    assert L.link_tracklets(four, frames(spark, 9)).select("tracklet_id").distinct().count() == 1
    assert L.link_tracklets(five, frames(spark, 9)).select("tracklet_id").distinct().count() == 2


def test_low_confidence_never_links(spark):
    assert L.link_tracklets(cands(spark, [(0, 0, 0, 0.05)]), frames(spark, 3)).count() == 0


def test_linker_does_not_depend_on_blocks(spark):
    rnd = random.Random(4)
    rows = [(f, rnd.uniform(-180, 180), rnd.uniform(-20, 20), rnd.uniform(0.05, 0.9)) for f in range(60) for _ in range(rnd.randint(0, 4))]
    c = cands(spark, rows)
    a, b = (L.link_tracklets(c, frames(spark, 60), LinkConfig(block_frames=n)).select("det_id", "tracklet_id").collect() for n in (4096, 8))
    assert dict(a) == dict(b)


def test_still_chain_needs_its_length(spark):
    blobs = spark.createDataFrame([("c", f, f, 100.0 + f % 2, 50.0, 6.0, 4.0) for f in range(16)] + [("c", f, 100 + f, 500.0 + 40 * f, 50.0, 9.0, 3.0) for f in range(16)],
                                  "clip_id string, frame int, det_id long, x double, y double, w double, h double")
    out = {r["det_id"]: r for r in L.held_still_flags(blobs).collect()}
    assert all(out[f]["static_suspect"] for f in range(16)) and not any(out[100 + f]["static_suspect"] for f in range(16))
    assert out[100]["wide_flat_suspect"] and not out[0]["wide_flat_suspect"]


def test_loss_window_record(spark):
    c = cands(spark, [(0, 1, 2, 0.9), (3, 4, 5, 0.9), (1, 9, 9, 0.1)])
    w = windows.loss_windows(frames(spark, 6), c, LossConfig()).orderBy("start_frame").collect()
    assert [(r["window_id"], r["start_frame"], r["end_frame"], r["status"]) for r in w] == [("W0001", 1, 2, "bridgeable"), ("W0002", 4, 5, "open")]
    assert (w[0]["last_trusted_frame"], w[0]["first_reacq_frame"], w[0]["last_trusted_yaw"]) == (0, 3, 1.0)


def test_isolated_when_nothing_is_trusted(spark):
    w = windows.loss_windows(frames(spark, 4), cands(spark, [(1, 0, 0, 0.05)])).collect()
    assert len(w) == 1 and w[0]["status"] == "isolated" and w[0]["duration_frames"] == 4


def with_geometry(df):
    g = F.struct(F.lit(None).cast("array<double>").alias("bbox_xyxy"), F.lit(50.0).alias("bbox_area_px"), F.lit(1.0).alias("bbox_aspect_ratio"))
    return df.withColumn("detection_geometry", g)


def repair(spark, rows, n):
    c = with_geometry(cands(spark, rows))
    return R.repair_windows(windows.loss_windows(frames(spark, n), c), c, RepairConfig())


def test_agreeing_traces_repair_the_window(spark):
    rows = [(f, f * 1.0, 0.0, 0.6 if f in (0, 5) else 0.1) for f in range(6)]
    out = repair(spark, rows, 6)
    assert sorted(r["frame"] for r in out["repairs"].collect()) == [1, 2, 3, 4]
    assert out["queue"].count() == 0


def test_empty_window_between_close_anchors_is_interpolated(spark):
    out = repair(spark, [(0, 10.0, 0.0, 0.6), (4, 11.0, 0.0, 0.6)], 5)
    got = {r["frame"]: r["yaw"] for r in out["repairs"].collect()}
    assert got == {1: pytest.approx(10.25), 2: pytest.approx(10.5), 3: pytest.approx(10.75)}


def test_fence_anchor_and_jump_go_to_review(spark):
    out = repair(spark, [(0, -77.4, -3.9, 0.6), (3, -70.0, 0.0, 0.6)], 4)
    assert [r["reason"] for r in out["queue"].collect()] == ["left_anchor_failed_quality_gate"]
    out = repair(spark, [(0, 0.0, 0.0, 0.6), (1, 60.0, 0.0, 0.1), (3, 90.0, 0.0, 0.6)], 4)
    assert out["repairs"].count() == 0 and [r["reason"] for r in out["queue"].collect()] == ["no_corridor_supported_candidates"]


def test_long_window_is_sampled_not_traced(spark):
    rows = [(0, 0, 0, 0.6), (40, 0, 0, 0.6)] + [(f, 0.0, 0.0, 0.1) for f in range(1, 40)]
    out = repair(spark, rows, 41)
    assert out["repairs"].count() == 0 and out["review"].count() == 12 and out["queue"].first()["reason"] == "long_window"


def _brute_nms(rows, radius):
    kept = []
    for i, y, p, c in sorted(rows, key=lambda r: (-r[3], r[0])):
        if all(_gc(y, p, k[1], k[2]) > radius for k in kept):
            kept.append((i, y, p, c))
    return {k[0] for k in kept}


def _gc(y1, p1, y2, p2):
    a, b = math.radians(p1), math.radians(p2)
    c = math.sin(a) * math.sin(b) + math.cos(a) * math.cos(b) * math.cos(math.radians(y1 - y2))
    return math.degrees(math.acos(max(-1, min(1, c))))


@pytest.mark.parametrize("limit", [256, 10])
def test_nms_small_and_large_frames(spark, limit):
    rnd = random.Random(9)
    rows = [(i, rnd.uniform(-180, 180), rnd.uniform(-80, 80), rnd.random()) for i in range(80)]
    df = spark.createDataFrame([("c", 0, *r) for r in rows], "clip_id string, frame int, det_id long, yaw double, pitch double, conf double")
    got = {r["det_id"] for r in spatial.greedy_nms(df, ["clip_id", "frame"], "conf", "det_id", 15.0, fold_limit=limit).collect()}
    assert got == _brute_nms(rows, 15.0)


def test_components_match_brute_force(spark):
    rnd = random.Random(3)
    pts = [(i, rnd.uniform(-180, 180), rnd.uniform(-89, 89)) for i in range(120)] + [(200, 179.5, 0.0), (201, -179.5, 0.0), (202, 10.0, 89.9), (203, -170.0, 89.9)]
    parent = {p[0]: p[0] for p in pts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in pts:
        for b in pts:
            if a[0] < b[0] and _gc(a[1], a[2], b[1], b[2]) <= 12.0:
                ra, rb = find(a[0]), find(b[0])
                parent[max(ra, rb)] = min(ra, rb)
    df = spark.createDataFrame([("c", *p) for p in pts], "clip_id string, id long, yaw double, pitch double")
    got = {r["id"]: r["comp"] for r in spatial.spatial_components(df, ["clip_id"], "id", 12.0).collect()}
    assert got == {p[0]: find(p[0]) for p in pts}


def test_series_steps_do_not_depend_on_blocks(spark):
    rnd = random.Random(1)
    df = spark.createDataFrame([("c", i, i * 0.5, rnd.uniform(-180, 180)) for i in range(90)], "clip_id string, n long, t double, y double")
    for step in (S.deadband_step("y", 30.0), S.rate_limit_step("y", "t", 25.0)):
        a, b = ({r["n"]: r["o"] for r in S.seq_scan(df, ["clip_id"], "n", ["t", "y"], step, "o", block_rows=k).collect()} for k in (1000, 7))
        assert a == b


def test_players_keep_their_track_over_two_misses(spark):
    rows = [("c", s, s, float(s), 0.0, 40.0, 0.9) for s in (0, 1, 4, 8)]
    p = spark.createDataFrame(rows, "clip_id string, frame int, det_id long, yaw double, pitch double, box_h double, conf double")
    t = {r["frame"]: r["track_no"] for r in L.track_players(p, frames(spark, 9), CrowdConfig()).collect()}
    assert t[0] == t[1] == t[4] and t[8] != t[4]


def test_stream_and_batch_tracker_agree(spark, small_dir):
    from fieldlens.plans.catalog import REGISTRY

    live = {(r["clip_id"], r["frame"]): tuple(r) for r in REGISTRY["live_tracks"].run(spark, small_dir).collect()}
    stored = {(r["clip_id"], r["frame"]): tuple(r) for r in REGISTRY["stored_tracks"].run(spark, small_dir).collect()}
    assert live and live == stored


def test_backward_paths_share_groups_and_equal_a_walk_per_anchor(spark):
    import math
    import random

    from fieldlens.config import BackwardConfig
    from fieldlens.operators.repair import propagate_backward

    cfg, r = BackwardConfig(), random.Random(3)
    # frames around the edges of the stretches that share a group
    det = [("a", f, 10 * f + k, -170.0 + 0.5 * f + r.random(), r.random() * 6.0, r.random()) for f in [*range(0, 70), *range(100, 200)] for k in range(2)]
    anchors = [("a", 10_000 + f, f, -170.0 + 0.5 * f, 3.0) for f in (0, 1, 60, 63, 64, 65, 104, 127, 128, 129, 199, 240)]

    def arc(y1, p1, y2, p2):
        a, b = math.radians(p1), math.radians(p2)
        return math.degrees(math.acos(max(-1.0, min(1.0, math.sin(a) * math.sin(b) + math.cos(a) * math.cos(b) * math.cos(math.radians(y1 - y2))))))

    want = []
    for _, anchor, at, yaw, pitch in anchors:
        path, misses = [(yaw, pitch)], 0
        for f in range(at - 1, at - cfg.horizon_frames - 1, -1):
            y, p = path[-1] if len(path) == 1 else (2 * path[-1][0] - path[-2][0], 2 * path[-1][1] - path[-2][1])
            near = [(cfg.confidence_weight * c + cfg.motion_weight * (1.0 - arc(cy, cp, y, p) / cfg.max_jump_deg), -d, cy, cp)
                    for _, g, d, cy, cp, c in det if g == f and arc(cy, cp, y, p) <= cfg.max_jump_deg]
            misses = 0 if near else misses + 1
            if misses > cfg.max_gap_frames:
                break
            if near:
                s, d, cy, cp = max(near)
                path.append((cy, cp))
                want.append((anchor, f, -d, s))
    got = propagate_backward(spark.createDataFrame(anchors, "clip_id string, anchor_id long, frame int, yaw double, pitch double"),
                             spark.createDataFrame(det, "clip_id string, frame int, det_id long, yaw double, pitch double, weighted_conf double"))
    assert "Join" not in got._jdf.queryExecution().analyzed().toString()  # no row per anchor and candidate
    assert sorted((x.anchor_id, x.frame, x.det_id, x.score) for x in got.collect()) == sorted(want)
    assert len(want) > 100
