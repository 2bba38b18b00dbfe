"""Human-label analysis, cue fusion, static-cluster audits and run-to-run comparison."""

from __future__ import annotations

import json
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldlens.config import ClusterAuditConfig
from fieldlens.functions import geo
from fieldlens.operators import spatial
from fieldlens.operators.blockrun import run_blocks
from fieldlens.operators.joins import overlap_join, point_in_interval
from fieldlens.operators.scan import Carry, carry_scan, exact_percentiles, frame_block, row_index
from fieldlens.operators.tracklets import KEY, median_position, upper_median_position
from fieldlens.session import cut

# Cue weights of the two diagnostics.
TRACK_CUES = {"detector": 0.35, "view_band": 0.10, "pose": 0.20, "geometry": 0.10, "temporal": 0.25}
CANDIDATE_CUES = {"detector": 0.38, "pose": 0.24, "static": 0.14, "temporal": 0.16, "geometry": 0.08}
LIKENESS = {"obs_count": 0.35, "spatial_spread_deg": 0.30, "vel_consistency": 0.20, "net_disp_deg": 0.15}


# ---------------------------------------------------------------- labels
def long_features(df: DataFrame, features: list[str]) -> DataFrame:
    return df.unpivot(["id", "verdict"], features, "feature", "value").filter("value is not null")


def class_comparison(df: DataFrame, features: list[str]) -> DataFrame:
    """Per feature: mean, median, n of ball and fp, and |difference of means| / pooled deviation, ranked."""
    f = long_features(df, features).filter(F.col("verdict").isin("ball", "fp"))
    s = f.groupBy("feature").agg(
        *[F.avg(F.when(F.col("verdict") == v, F.col("value"))).alias(f"{v}_mean") for v in ("ball", "fp")],
        *[F.count_if(F.col("verdict") == v).alias(f"{v}_n") for v in ("ball", "fp")],
        F.stddev_pop("value").alias("sd"),
    )
    med = exact_percentiles(f.select("feature", "verdict", "value"), ["feature", "verdict"], "value", {"m": 0.5})
    med = med.groupBy("feature").agg(*[F.max(F.when(F.col("verdict") == v, F.col("m"))).alias(f"{v}_median") for v in ("ball", "fp")])
    effect = F.abs(F.col("ball_mean") - F.col("fp_mean")) / F.when(F.col("sd") > 0, F.col("sd")).otherwise(geo.lit(1e-9))
    s = s.join(med, "feature").withColumn("effect", effect).drop("sd")
    # one row per feature: the single-partition ranking below is bounded by the feature list
    return s.withColumn("effect_rank", F.when(F.col("effect").isNotNull(), F.row_number().over(W.orderBy(F.desc_nulls_last("effect"), "feature"))))


def ambiguity_ranking(df: DataFrame, comparison: DataFrame, features: list[str]) -> DataFrame:
    """Unlabelled rows scored by closeness to both class means on the three best features; 99 when unknown."""
    top = comparison.filter("effect_rank <= 3").select("feature", "ball_mean", "fp_mean")
    u = long_features(df.filter("verdict = 'unclear'"), features).join(top, "feature")
    near = F.least(F.abs(F.col("value") - F.col("ball_mean")), F.abs(F.col("value") - F.col("fp_mean")))
    s = u.groupBy("id").agg(F.avg(near / (F.abs(F.col("ball_mean") - F.col("fp_mean")) + 1e-9)).alias("ambiguity"))
    return df.filter("verdict = 'unclear'").select("id").join(s, "id", "left").withColumn("ambiguity", F.coalesce("ambiguity", geo.lit(99.0)))


def step_consistency(obs: DataFrame) -> DataFrame:
    """Share of plain yaw/pitch steps within twice the median step; null below two steps."""
    o = carry_scan(obs, KEY, ["frame"], frame_block(), {"prev": Carry("last", F.struct("yaw", "pitch"), exclusive=True)})
    o = o.withColumn("step", F.hypot(F.col("yaw") - F.col("prev.yaw"), F.col("pitch") - F.col("prev.pitch")))
    med = exact_percentiles(o.select(*KEY, "step"), KEY, "step", {"med": 0.5})
    g = o.join(med, KEY).groupBy(*KEY).agg(
        F.count("step").alias("n"), F.first("med").alias("med"), F.count_if(F.col("step") <= F.col("med") * 2.0 + 1e-12).alias("ok"))
    v = F.when(F.col("n") < 2, None).when(F.col("med") == 0, 1.0).otherwise(F.col("ok") / F.col("n"))
    return g.select(*KEY, v.alias("vel_consistency"))


def likeness_scores(records: DataFrame) -> DataFrame:
    """Min-max over all records (a missing value counts 0, a constant feature spans 1), weighted sum."""
    span = records.agg(*[F.min(f).alias(f"lo_{f}") for f in LIKENESS], *[F.max(f).alias(f"hi_{f}") for f in LIKENESS])
    j = records.crossJoin(F.broadcast(span))  # exactly one row
    total = geo.lit(0.0)
    for f, w in LIKENESS.items():
        lo, hi = F.col(f"lo_{f}"), F.col(f"hi_{f}")
        n = F.coalesce(geo.clamp((F.col(f) - lo) / F.when(hi > lo, hi - lo).otherwise(geo.lit(1.0))), geo.lit(0.0))
        total = total + n * w
    return j.withColumn("score", total).drop(*[f"{p}_{f}" for f in LIKENESS for p in ("lo", "hi")])


# ---------------------------------------------------------------- cues
def fused_score(cues: dict[str, Column], weights: dict[str, float]) -> Column:
    """Weighted mean over the cues that are known; null when none is."""
    num, den = geo.lit(0.0), geo.lit(0.0)
    for k, c in cues.items():
        num = num + F.when(c.isNotNull(), c * weights[k]).otherwise(geo.lit(0.0))
        den = den + F.when(c.isNotNull(), geo.lit(weights[k])).otherwise(geo.lit(0.0))
    return F.when(den > 0, num / den)


def temporal_cue(obs_count, spread, net_disp, velocity) -> Column:
    c = geo.col
    return (
        geo.clamp(F.log1p(c(obs_count)) / math.log1p(120.0)) * 0.30 + geo.clamp(c(spread) / 10.0) * 0.25
        + geo.clamp(c(net_disp) / 20.0) * 0.20 + geo.clamp(F.coalesce(c(velocity), geo.lit(0.5))) * 0.25
    )


def view_band_cue(pitch, lo: float = -30.0, hi: float = 18.0) -> Column:
    p = geo.col(pitch)
    return F.when(p.isNull(), None).when(p.between(lo, hi), geo.lit(0.75)).otherwise(geo.lit(0.10))


def raw_and_fused_pick(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Per frame the raw-confidence pick, the fused pick and whether they agree."""
    best = lambda c: F.max_by("det_id", F.struct(F.coalesce(F.col(c), geo.lit(0.0)), -F.col("det_id")))
    return scored.groupBy(*keys).agg(best("raw_conf").alias("raw_pick"), best("fused").alias("fused_pick")).withColumn(
        "same_pick", F.col("raw_pick") == F.col("fused_pick"))


def pose_guided_pick(cand: DataFrame, keys: list[str], support_min: float = 0.20) -> DataFrame:
    """Only candidates with pose support compete (0.65 relative confidence + 0.35 support, to nine places, so
    that equal ones tie whatever their last bits); without any, the raw pick stands and says so."""
    ok = F.coalesce(F.col("pose_support") >= support_min, F.lit(False))
    m = cand.groupBy(*keys).agg(F.max(F.when(ok, F.col("raw_conf"))).alias("best_raw"), F.max_by("det_id", F.struct(F.col("raw_conf"), -F.col("det_id"))).alias("raw_pick"))
    j = cand.join(m, keys)
    rel = F.col("raw_conf") / F.when(F.col("best_raw") > 0, F.col("best_raw")).otherwise(geo.lit(1.0))
    j = j.withColumn("guided", F.when(ok, geo.r4(rel * 0.65 + F.col("pose_support") * 0.35, 9)))
    g = j.groupBy(*keys).agg(
        F.first("raw_pick").alias("raw_pick"),
        F.max_by("det_id", F.when(F.col("guided").isNotNull(), F.struct(F.col("guided"), -F.col("det_id")))).alias("g"))
    return g.select(*keys, "raw_pick", F.coalesce("g", "raw_pick").alias("guided_pick"),
                    F.when(F.col("g").isNull(), "RAW_FALLBACK_NO_LOWER_BODY_SUPPORT").otherwise("POSE_GUIDED").alias("label"))


def pose_distances(points: DataFrame, people: DataFrame, keys: list[str]) -> DataFrame:
    """Smallest distance from a point to a person box, lower-body point and ankle point of its frame.

    people: keys, box array<double>, lower array<struct<x,y>>, ankles array<struct<x,y>>.
    """
    near = lambda arr: F.array_min(F.transform(arr, lambda q: F.hypot(F.col("px") - q["x"], F.col("py") - q["y"])))
    j = points.join(people, keys, "left")
    g = j.groupBy(*keys, "det_id").agg(
        F.min(geo.point_rect_distance("px", "py", "box")).alias("person_px"), F.min(near(F.col("lower"))).alias("lower_px"), F.min(near(F.col("ankles"))).alias("ankle_px"))
    return g.withColumn("pose_score", geo.pose_score("ankle_px", "lower_px"))


# ---------------------------------------------------------------- static clusters
def near_static(obs: DataFrame, tracklets: DataFrame, cfg: ClusterAuditConfig = ClusterAuditConfig()) -> DataFrame:
    """Tracklets that barely move and were not rejected, with their median position."""
    t = tracklets.filter(
        (F.col("status") != "rejected_static") & (F.col("observation_count") >= cfg.min_obs)
        & (F.col("end_frame") - F.col("start_frame") >= cfg.min_span) & (F.col("net_displacement_deg") < cfg.major_motion_deg)
        & (F.col("net_displacement_deg") < cfg.net_disp_ceiling))
    return t.join(median_position(obs.join(t.select(*KEY), KEY, "left_semi")), KEY).select(
        *KEY, "status", "observation_count", "start_frame", "end_frame", "net_displacement_deg",
        F.col("median_yaw").alias("yaw"), F.col("median_pitch").alias("pitch"))


def greedy_spaced(df: DataFrame, keys: list[str], pos: str, tie: str, gap: float, strict: bool = False, block: float | None = None) -> DataFrame:
    """Rows kept when at least ``gap`` (strict: more than) after the last kept one, in order of pos."""
    # a block spans many gaps, so that most of its picks do not depend on the block before
    rows = df.select(*keys, pos, tie).withColumn("_block", F.floor(F.col(pos) / (block or max(65536.0, gap * 4096))))

    def run(pdf, state):
        last = json.loads(state) if state is not None else None
        keep = []
        for p in pdf[pos].tolist():
            ok = last is None or (p - last > gap if strict else p - last >= gap)
            keep.append(ok)
            last = float(p) if ok else last
        return pd.DataFrame({pos: pdf[pos], tie: pdf[tie], "kept": keep}), json.dumps(last)

    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return run_blocks(rows, keys, "_block", [pos, tie], run, f"{pos} {types[pos]}, {tie} {types[tie]}, kept boolean").drop("_block")


def cluster_members(members: DataFrame, cfg: ClusterAuditConfig = ClusterAuditConfig()) -> tuple[DataFrame, DataFrame]:
    """(clusters with their centres, members with comp and distance to centre)."""
    comp = spatial.spatial_components(members, ["clip_id"], "tracklet_id", cfg.cluster_radius_deg, strict=True)
    m = cut(members.join(comp, KEY))
    w = F.col("observation_count")
    c = m.groupBy("clip_id", "comp").agg(
        F.sum(w * geo.unit_x("yaw", "pitch")).alias("x"), F.sum(w * geo.unit_y("pitch")).alias("y"), F.sum(w * geo.unit_z("yaw", "pitch")).alias("z"),
        F.count(F.lit(1)).alias("member_count"), F.min("start_frame").alias("first_frame"), F.max("end_frame").alias("last_frame"), F.sum(w).alias("total_obs"))
    n = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    c = c.withColumn("centre_yaw", geo.vec_yaw("x", "z")).withColumn("centre_pitch", geo.vec_pitch(F.col("y") / n)).drop("x", "y", "z")
    c = cut(c)
    m = m.join(c.select("clip_id", "comp", "centre_yaw", "centre_pitch"), ["clip_id", "comp"]).withColumn(
        "dist_to_centre", geo.angular_distance("yaw", "pitch", "centre_yaw", "centre_pitch")).drop("centre_yaw", "centre_pitch")
    return c, cut(m)


def static_clusters(members: DataFrame, cfg: ClusterAuditConfig = ClusterAuditConfig()) -> tuple[DataFrame, DataFrame]:
    """``cluster_members``, and of each cluster its radius, its distinct windows and whether it comes again."""
    c, m = cluster_members(members, cfg)
    mids = m.withColumn("mid", F.floor((F.col("start_frame") + F.col("end_frame")) / 2))
    spaced = greedy_spaced(mids, ["clip_id", "comp"], "mid", "tracklet_id", cfg.min_window_gap).filter("kept").groupBy("clip_id", "comp").agg(F.count(F.lit(1)).alias("distinct_windows"))
    radius = m.groupBy("clip_id", "comp").agg(F.max("dist_to_centre").alias("radius_deg"))
    c = c.join(spaced, ["clip_id", "comp"]).join(radius, ["clip_id", "comp"]).withColumn("temporal_span", F.col("last_frame") - F.col("first_frame"))
    repeated = (F.col("member_count") >= cfg.min_members) & (F.col("temporal_span") >= cfg.min_temporal_span) & (F.col("distinct_windows") >= 2)
    return c.withColumn("is_repeated", repeated), m


def match_radius(members: DataFrame, cfg: ClusterAuditConfig = ClusterAuditConfig()) -> DataFrame:
    p = exact_percentiles(members.select("clip_id", "comp", "dist_to_centre"), ["clip_id", "comp"], "dist_to_centre", {"p95": 0.95})
    return p.withColumn("match_radius_deg", geo.clamp(F.col("p95") + cfg.guard_margin_deg, cfg.min_radius_deg, cfg.radius_cap_deg))


def diameter(points: DataFrame, keys: list[str], cuts: int = 12) -> DataFrame:
    """Largest pairwise angle per key without pairing all points.

    Points fall into at most cuts^3 boxes over the key's own extent. Pairs of boxes bound the
    answer from both sides; only boxes that can still hold the widest pair keep their points.
    """
    p = points.select(*keys, "yaw", "pitch").distinct()
    for c, v in (("x", geo.unit_x("yaw", "pitch")), ("y", geo.unit_y("pitch")), ("z", geo.unit_z("yaw", "pitch"))):
        p = p.withColumn(c, v)
    ext = p.groupBy(*keys).agg(*[F.min(c).alias(f"lo_{c}") for c in "xyz"], F.greatest(*[F.max(c) - F.min(c) for c in "xyz"]).alias("w"))
    p = p.join(ext, keys).withColumn("e", F.greatest(F.col("w") / cuts, geo.lit(1e-12)))
    for c in "xyz":
        p = p.withColumn(f"b{c}", F.least(F.floor((F.col(c) - F.col(f"lo_{c}")) / F.col("e")), F.lit(cuts - 1)))
    box = ["bx", "by", "bz"]
    boxes = p.groupBy(*keys, *box).agg(*[F.min(c).alias(f"n{c}") for c in "xyz"], *[F.max(c).alias(f"m{c}") for c in "xyz"])
    a = boxes.select(*keys, F.struct(*box).alias("a"), F.struct(*[f"{s}{c}" for s in "nm" for c in "xyz"]).alias("ext_a"))
    b = boxes.select(*keys, F.struct(*box).alias("b"), F.struct(*[f"{s}{c}" for s in "nm" for c in "xyz"]).alias("ext_b"))
    far = sum(F.pow(F.greatest(F.col(f"ext_a.m{c}") - F.col(f"ext_b.n{c}"), F.col(f"ext_b.m{c}") - F.col(f"ext_a.n{c}")), geo.lit(2.0)) for c in "xyz")
    near = sum(F.pow(F.greatest(F.col(f"ext_a.n{c}") - F.col(f"ext_b.m{c}"), F.col(f"ext_b.n{c}") - F.col(f"ext_a.m{c}"), geo.lit(0.0)), geo.lit(2.0)) for c in "xyz")
    pr = a.join(b, keys).filter("a <= b").withColumn("far", far).withColumn("near", near)
    low = pr.groupBy(*keys).agg(F.max("near").alias("low"))
    live = pr.join(low, keys).filter(F.col("far") >= F.col("low") - 1e-15).select(*keys, "a", "b")
    q = p.select(*keys, F.struct(*box).alias("k"), "x", "y", "z")
    l = q.select(*keys, F.col("k").alias("a"), *[F.col(c).alias(f"{c}1") for c in "xyz"])
    r = q.select(*keys, F.col("k").alias("b"), *[F.col(c).alias(f"{c}2") for c in "xyz"])
    j = live.join(l, [*keys, "a"]).join(r, [*keys, "b"])
    # the smallest dot product is the widest angle; equal points give zero
    dot = F.col("x1") * F.col("x2") + F.col("y1") * F.col("y2") + F.col("z1") * F.col("z2")
    d = j.groupBy(*keys).agg(F.min(dot).alias("d"))
    return d.select(*keys, F.when(F.col("d") >= 1.0 - 1e-15, geo.lit(0.0)).otherwise(F.degrees(F.acos(geo.clamp("d", -1.0, 1.0)))).alias("max_pairwise_deg"))


def greedy_subclusters(members: DataFrame, keys: list[str], order: list[str], radius: float) -> DataFrame:
    """Subclusters numbered in order of appearance. Members are taken by ``order``; each counts for the
    lowest-numbered subcluster that it lies within ``radius`` of, whose mean direction then moves."""
    m = row_index(members, keys, order, F.floor(F.col(order[0]) / 0.5), "_rn").withColumn("_block", F.floor(F.col("_rn") / 65536))
    id_col = order[-1]

    def run(pdf, state):
        groups = json.loads(state) if state is not None else []  # x y z size
        out = []
        limit = math.cos(math.radians(radius)) - 1e-12
        for r in pdf.itertuples():
            y, p = math.radians(r.yaw), math.radians(r.pitch)
            v = (math.cos(p) * math.sin(y), math.sin(p), math.cos(p) * math.cos(y))
            for i, g in enumerate(groups):
                if g[0] * v[0] + g[1] * v[1] + g[2] * v[2] >= limit:
                    new = [g[k] * g[3] + v[k] for k in range(3)]
                    n = math.sqrt(sum(c * c for c in new))
                    groups[i] = [c / n for c in new] + [g[3] + 1]
                    out.append(i)
                    break
            else:
                groups.append([*v, 1])
                out.append(len(groups) - 1)
        return pd.DataFrame({id_col: pdf[id_col], "subcluster": out}), json.dumps(groups)

    t = members.schema[id_col].dataType.simpleString()
    cols = m.select(*keys, "_block", "_rn", id_col, "yaw", "pitch")
    return run_blocks(cols, keys, "_block", ["_rn"], run, f"{id_col} {t}, subcluster int").drop("_block")


def cluster_coherence(members: DataFrame, cfg: ClusterAuditConfig = ClusterAuditConfig()) -> DataFrame:
    """Keep / split / annotate-only verdict per cluster."""
    k = ["clip_id", "comp"]
    g = carry_scan(members.select(*k, "tracklet_id", "dist_to_centre"), k, ["dist_to_centre", "tracklet_id"], F.floor(F.col("dist_to_centre") / 0.05),
                   {"prev": Carry("last", F.col("dist_to_centre"), exclusive=True)})
    gap = g.groupBy(*k).agg(F.coalesce(F.max(F.col("dist_to_centre") - F.col("prev")), geo.lit(0.0)).alias("largest_gap_deg"), F.count(F.lit(1)).alias("member_count"))
    sub = greedy_subclusters(members, k, ["dist_to_centre", "tracklet_id"], cfg.split_radius_deg).groupBy(*k).agg((F.max("subcluster") + 1).alias("subcluster_count"))
    j = gap.join(diameter(members, k), k).join(sub, k)
    verdict = (
        F.when(F.col("max_pairwise_deg") > cfg.spread_limit_deg, "ANNOTATION-ONLY")
        .when((F.col("largest_gap_deg") >= cfg.gap_threshold_deg) & (F.col("subcluster_count") > 1), "SPLIT").otherwise("KEEP AS ONE"))
    return j.withColumn("recommendation", verdict)


# ---------------------------------------------------------------- run comparison
def status_deltas(original: DataFrame, rerun: DataFrame) -> DataFrame:
    a = original.groupBy("clip_id", "status").agg(F.count(F.lit(1)).alias("original"))
    b = rerun.groupBy("clip_id", "status").agg(F.count(F.lit(1)).alias("rerun"))
    return a.join(b, ["clip_id", "status"], "full").na.fill(0, ["original", "rerun"]).withColumn("delta", F.col("rerun") - F.col("original"))


def continuity(original: DataFrame, obs: DataFrame, rerun: DataFrame, rerun_obs: DataFrame, cand: DataFrame, motion_floor: float = 2.0, tol: float = 2.0) -> DataFrame:
    """Do moving tracks survive a rerun, judged by place and time rather than by id?"""
    t = original.filter((F.col("net_displacement_deg") >= motion_floor) & F.col("status").isin("anchor", "passing"))
    t = t.join(upper_median_position(obs.join(t.select(*KEY), KEY, "left_semi")), KEY).select(*KEY, "status", "start_frame", "end_frame", "median_yaw", "median_pitch")
    c = cand.select("clip_id", F.col("frame").alias("cf"), F.col("yaw").alias("cy"), F.col("pitch").alias("cp"))
    near = point_in_interval(c, t, ["clip_id"], "cf", "start_frame", "end_frame").groupBy(*KEY).agg(
        F.min(geo.angular_distance("median_yaw", "median_pitch", "cy", "cp")).alias("nearest_frame_dist"))
    r = rerun.select("clip_id", F.col("tracklet_id").alias("rid"), F.col("start_frame").alias("rs"), F.col("end_frame").alias("re")).join(
        upper_median_position(rerun_obs).select("clip_id", F.col("tracklet_id").alias("rid"), F.col("median_yaw").alias("ry"), F.col("median_pitch").alias("rp")), ["clip_id", "rid"])
    linked = overlap_join(t, r, ["clip_id"], "start_frame", "end_frame", "rs", "re").groupBy(*KEY).agg(
        F.min(geo.angular_distance("median_yaw", "median_pitch", "ry", "rp")).alias("nearest_linked_dist"))
    j = t.join(near, KEY, "left").join(linked, KEY, "left")
    frame = F.col("nearest_frame_dist").isNotNull()
    place = F.coalesce(geo.within(F.col("nearest_frame_dist"), tol), F.lit(False))
    link = F.coalesce(geo.within(F.col("nearest_linked_dist"), tol), F.lit(False))
    outcome = F.when(place | link, "spatial_or_linked_continuous").when(frame, "frame_only_unsupported").otherwise("no_support")
    return j.select(*KEY, "status", frame.alias("has_frame_support"), place.alias("has_spatial_support"), link.alias("has_linked_support"),
                    "nearest_frame_dist", "nearest_linked_dist", outcome.alias("outcome"))


def acceptance(results: DataFrame, expected_removed: DataFrame) -> DataFrame:
    """PASS when no genuine window lost its support; listed origin tracks do not count."""
    e = expected_removed.select(*KEY, F.lit(True).alias("listed"))
    r = results.join(e, KEY, "left")
    lost = F.col("outcome") != "spatial_or_linked_continuous"
    outcome = F.when(lost & F.coalesce("listed", F.lit(False)), "expected_removed_origin_track").otherwise(F.col("outcome"))
    r = r.withColumn("outcome", outcome)
    unsafe = F.col("outcome").isin("frame_only_unsupported", "no_support")
    return r.groupBy("clip_id").agg(
        F.count_if(F.col("outcome") == "spatial_or_linked_continuous").alias("continuous"), F.count_if(F.col("outcome") == "frame_only_unsupported").alias("frame_only"),
        F.count_if(F.col("outcome") == "no_support").alias("no_support"), F.count_if(F.col("outcome") == "expected_removed_origin_track").alias("expected_removed"),
        F.when(F.count_if(unsafe) == 0, "PASS").otherwise("FAIL").alias("verdict"))


def review_sections(tracklets: DataFrame, k: int = 20) -> DataFrame:
    """Top anchors, top passing, least displaced; a tracklet shows under the first section that lists it."""
    parts = [
        ("A", tracklets.filter("status = 'anchor'"), F.desc(F.coalesce("anchor_strength", geo.lit(0.0)))),
        ("B", tracklets.filter("status = 'passing'"), F.desc(F.coalesce("best_available_score", geo.lit(0.0)))),
        ("C", tracklets.filter("status <> 'rejected_static'"), F.asc("net_displacement_deg")),
    ]
    out = None
    for name, t, order in parts:
        top = t.withColumn("rank", F.row_number().over(W.partitionBy("clip_id").orderBy(order, "tracklet_id"))).filter(F.col("rank") <= k)
        top = top.select(*KEY, F.lit(name).alias("section"), "rank")
        out = top if out is None else out.unionByName(top)
    return out.groupBy(*KEY).agg(F.min(F.struct("section", "rank")).alias("s")).select(*KEY, "s.section", "s.rank")


def tracker_report(frames: DataFrame) -> DataFrame:
    """KPI summary per clip. frames: clip_id, frame, n_raw, n_dedup, best_score, area, pitch, rejected (reason)."""
    q = exact_percentiles(frames.filter("best_score is not null").select("clip_id", "pitch"), ["clip_id"], "pitch", {"pitch_median": 0.5, "pitch_p90": 0.9, "pitch_p95": 0.95})
    ok = F.col("best_score").isNotNull()
    g = frames.groupBy("clip_id").agg(
        F.count(F.lit(1)).alias("frames_total"), F.count_if(F.col("n_raw") > 0).alias("frames_with_raw"), F.count_if(ok).alias("frames_confirmed"),
        (F.count_if(F.col("n_raw") > 0) * 100.0 / F.count(F.lit(1))).alias("raw_pct"), (F.count_if(ok) * 100.0 / F.count(F.lit(1))).alias("confirmed_pct"),
        F.avg("n_raw").alias("mean_raw"), F.avg("n_dedup").alias("mean_dedup"), F.avg("best_score").alias("mean_best_score"),
        F.count_if(ok & (F.col("pitch") > 10)).alias("pitch_above_10"), F.count_if(F.col("rejected") == "low_score").alias("rejected_low_score"),
        F.count_if(F.col("rejected") == "pitch_hard_max").alias("rejected_pitch"))
    return g.join(q, "clip_id", "left")
