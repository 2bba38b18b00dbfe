"""Tracklet scoring, status rules, motion audits and gaps between anchors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.config import LinkConfig, MotionAuditConfig, ScoreConfig
from fieldlens.functions import geo
from fieldlens.operators import spatial
from fieldlens.operators.hotspots import REGION_FIELDS
from fieldlens.operators.scan import Carry, carry_scan, exact_percentiles, frame_block, halo_windows, row_index

KEY = ["clip_id", "tracklet_id"]


def _dot(a: Column, b: Column) -> Column:
    return a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]


def _vec(x, y, z) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))


def _axpy(a: Column, k: Column, b: Column) -> Column:
    return _vec(a["x"] + k * b["x"], a["y"] + k * b["y"], a["z"] + k * b["z"])


def _scale(a: Column, k: Column) -> Column:
    return _vec(a["x"] * k, a["y"] * k, a["z"] * k)


def _norm(a: Column) -> Column:
    return F.sqrt(_dot(a, a))


def _gc(a: Column, b: Column) -> Column:
    return geo.unit_angle([a[c] for c in "xyz"], [b[c] for c in "xyz"])


def tracklet_steps(obs: DataFrame, size: int = 65536) -> DataFrame:
    """Adds per observation: v (unit vector), p1/p2 (previous two), f1/f2 (their frames)."""
    o = obs.withColumn("v", geo.unit_vec("yaw", "pitch"))
    o = row_index(o, KEY, ["frame"], frame_block())
    return halo_windows(
        o, KEY, "rn", 2, 0,
        lambda w: {"p1": F.lag("v", 1).over(w), "p2": F.lag("v", 2).over(w), "f1": F.lag("frame", 1).over(w), "f2": F.lag("frame", 2).over(w)},
        size,
    )


def _direction(name: str, a: Column, b: Column) -> dict[str, Column]:
    """Unit tangent at ``a`` towards ``b``; zero when they coincide, null when either is missing.

    Named steps, so that no sub-expression is evaluated twice.
    """
    known = a.isNotNull() & b.isNotNull()
    zero = _vec(geo.lit(0.0), geo.lit(0.0), geo.lit(0.0))
    unit = F.when(F.col("_n") >= 1e-9, _scale(F.col("_t"), geo.lit(1.0) / F.col("_n"))).otherwise(zero)
    return {
        "_d": F.when(known, _axpy(b, geo.lit(-1.0), a)), "_t": F.when(known, _axpy(F.col("_d"), -_dot(F.col("_d"), a), a)),
        "_n": _norm(F.col("_t")), name: F.when(known, unit),
    }


def motion_steps(obs: DataFrame, size: int = 65536) -> DataFrame:
    """Adds per observation: v, p1 and f1 (the previous one and its frame), step_deg, k_cur and speed_cur (the way from p1
    to v), k and speed (the same of the previous observation). The way to p1 is the previous row's way, so it is
    looked up instead of made again: all terms in one projection are more code than the JVM compiles."""
    o = row_index(obs.withColumn("v", geo.unit_vec("yaw", "pitch")), KEY, ["frame"], frame_block())

    def columns(w):
        return {
            "p1": F.lag("v", 1).over(w), "f1": F.lag("frame", 1).over(w), "step_deg": _gc(F.col("p1"), F.col("v")),
            **_direction("k_cur", F.col("p1"), F.col("v")),
            "speed_cur": F.col("step_deg") / (F.col("frame") - F.col("f1")) * _norm(F.col("k_cur")),
            "k": F.lag("k_cur", 1).over(w), "speed": F.lag("speed_cur", 1).over(w),
        }

    return halo_windows(o, KEY, "rn", 2, 0, columns, size).drop("_d", "_t", "_n")


def motion_terms(steps: DataFrame, predict: str = "reference") -> DataFrame:
    """Adds residual_deg (from the predicted position) and vel_sim to ``motion_steps``."""

    k, p = F.col("k"), F.col("p1")
    a = F.radians(F.col("speed") * (F.col("frame") - F.col("f1")))
    if predict == "great_circle":
        turned = _axpy(_scale(p, F.cos(a)), F.sin(a), k)
    else:
        cross = _vec(k["y"] * p["z"] - k["z"] * p["y"], k["z"] * p["x"] - k["x"] * p["z"], k["x"] * p["y"] - k["y"] * p["x"])
        turned = _axpy(_axpy(_scale(p, F.cos(a)), F.sin(a), cross), _dot(k, p) * (geo.lit(1.0) - F.cos(a)), k)
    s = steps.withColumn("turned", turned)
    t = F.col("turned")
    s = s.withColumn("pred", F.when((F.col("speed") > 1e-9) & k.isNotNull(), _scale(t, geo.lit(1.0) / _norm(t))).otherwise(p))
    sim = F.when(F.col("speed_cur") > 1e-9, geo.clamp(_dot(k, F.col("k_cur")))).otherwise(geo.lit(0.0))
    return (
        s.withColumn("residual_deg", _gc(F.col("pred"), F.col("v")))
        .withColumn("vel_sim", F.when(k.isNotNull() & (F.col("speed") > 1e-9), sim))
        .drop("k", "k_cur", "pred", "turned", "speed_cur")
    )


def mark_static(obs: DataFrame, regions: DataFrame, threshold: float) -> DataFrame:
    """Adds in_static: the label of the first confirmed region holding the observation."""
    idx = spatial.region_index(regions.filter(F.col("peak_duty") >= threshold), ["clip_id"], F.col("radius_deg"), REGION_FIELDS)
    inside = F.filter(spatial.region_distances(), lambda r: geo.within(r["dist"], r["radius_deg"]))
    first = F.array_min(F.transform(inside, lambda r: F.struct(r["region_rank"].alias("k"), r["label"].alias("label"))))
    return spatial.attach_regions(obs, idx, ["clip_id"]).withColumn("in_static", first["label"]).drop("regions")


def tracklet_metrics(obs: DataFrame, predict: str = "reference") -> DataFrame:
    """One row per tracklet. ``obs`` needs KEY, frame, yaw, pitch, weighted_conf; score and
    in_static when known."""
    for c, t in (("score", "double"), ("in_static", "string")):
        if c not in obs.columns:
            obs = obs.withColumn(c, F.lit(None).cast(t))
    s = motion_terms(motion_steps(obs), predict)
    gap = F.col("frame") - F.col("f1") - 1
    m = s.groupBy(*KEY).agg(
        F.min("frame").alias("start_frame"), F.max("frame").alias("end_frame"), F.count(F.lit(1)).alias("observation_count"),
        F.greatest(F.coalesce(F.max(gap), F.lit(0)), F.lit(0)).alias("max_internal_gap"),
        F.avg("weighted_conf").alias("mean_weighted_conf"), F.avg("score").alias("mean_link_score"),
        F.coalesce(F.avg("residual_deg"), geo.lit(0.0)).alias("mean_prediction_residual"),
        F.coalesce(F.avg("vel_sim"), geo.lit(0.0)).alias("velocity_consistency"),
        F.coalesce(F.sum("step_deg"), geo.lit(0.0)).alias("path_length_deg"),
        F.min_by("v", "frame").alias("first_v"), F.max_by("v", "frame").alias("last_v"),
        F.avg("v.x").alias("mx"), F.avg("v.y").alias("my"), F.avg("v.z").alias("mz"),
        (F.count("in_static") / F.count(F.lit(1))).alias("static_frac"),
    )
    n = F.sqrt(F.col("mx") * F.col("mx") + F.col("my") * F.col("my") + F.col("mz") * F.col("mz"))
    centre = m.select(*KEY, *[(F.col(c) / F.when(n > 1e-9, n).otherwise(geo.lit(1.0))).alias(c) for c in ("mx", "my", "mz")])
    spread = (
        obs.select(*KEY, geo.unit_vec("yaw", "pitch").alias("v"))
        .join(centre, KEY)
        .groupBy(*KEY)
        .agg(F.avg(geo.unit_angle(["v.x", "v.y", "v.z"], ["mx", "my", "mz"])).alias("sp"))
    )
    span = F.col("end_frame") - F.col("start_frame") + 1
    run = F.col("end_frame") - F.col("start_frame")
    one = F.col("observation_count") <= 1
    return m.join(spread, KEY).select(
        *KEY, "start_frame", "end_frame", span.alias("span_frames"), "observation_count",
        (F.col("observation_count") / span).alias("coverage_ratio"), "max_internal_gap", "mean_weighted_conf",
        F.coalesce("mean_link_score", geo.lit(0.0)).alias("mean_link_score"),
        "mean_prediction_residual", "velocity_consistency",
        F.when(one, geo.lit(0.0)).otherwise(_gc(F.col("first_v"), F.col("last_v"))).alias("net_displacement_deg"),
        F.when(one, geo.lit(0.0)).otherwise(F.col("sp")).alias("spatial_spread_deg"),
        "path_length_deg",
        F.when(run > 0, F.col("path_length_deg") / run).otherwise(geo.lit(0.0)).alias("mean_velocity"),
        "static_frac",
    )


def tracklet_status(m: DataFrame, cfg: ScoreConfig = ScoreConfig()) -> DataFrame:
    """Status, anchor strength and best available score from the metrics."""
    c = F.col
    secondary = (
        (c("net_displacement_deg") < 2.0).cast("int") + (c("spatial_spread_deg") < 1.5).cast("int")
        + ((c("span_frames") >= 20) & (c("coverage_ratio") >= 0.6)).cast("int")
    )
    rejected = (c("static_frac") >= 0.7) & (secondary >= 2)
    suspect = ~rejected & (c("static_frac") >= 0.5) & (secondary >= 1)
    far, fast = c("net_displacement_deg") >= 3.0, c("mean_velocity") >= 0.1
    bonus = F.when(far & fast, 1.0).when(far | fast, 0.5).otherwise(0.0)
    cap1 = lambda x: F.least(geo.lit(1.0), x)
    conf = cap1(c("mean_weighted_conf") / 0.60)
    raw = (
        conf * 0.30 + cap1(c("coverage_ratio")) * 0.20 + cap1(c("observation_count") / 30.0) * 0.15
        + (geo.lit(1.0) - cap1(c("mean_prediction_residual") / 15.0)) * 0.15 + c("velocity_consistency") * 0.10 + bonus * 0.10
    )
    scored = (c("observation_count") >= cfg.min_obs_for_score) & ~rejected
    strength = F.when(scored, F.when(suspect, F.least(raw, geo.lit(0.40))).otherwise(raw))
    best = F.when(
        scored,
        conf * 0.35 + c("coverage_ratio") * 0.25 + cap1(geo.lit(1.0) - c("mean_prediction_residual") / 15.0) * 0.20 + c("velocity_consistency") * 0.20,
    )
    flight = (
        ~rejected & c("observation_count").between(2, 10) & (c("mean_velocity") >= 1.5)
        & c("net_displacement_deg").between(5.0, 60.0) & (c("spatial_spread_deg") >= 2.0)
        & (c("mean_weighted_conf") >= cfg.min_mean_conf_for_anchor)
    )
    anchor = (
        (c("observation_count") >= cfg.min_obs_for_anchor) & (c("mean_weighted_conf") >= cfg.min_mean_conf_for_anchor)
        & (c("coverage_ratio") >= cfg.min_coverage_for_anchor) & F.coalesce(strength >= cfg.min_anchor_strength, F.lit(False))
    )
    status = (
        F.when(rejected, "rejected_static").when(flight, "flight_anchor")
        .when(c("observation_count") < cfg.min_obs_for_score, "fragment").when(anchor, "anchor").otherwise("passing")
    )
    return (
        m.withColumn("status", status)
        .withColumn("rejection_reason", F.when(rejected, "static_hotspot_tracklet_rejected"))
        .withColumn("static_suspect", suspect)
        .withColumn("anchor_strength", strength)
        .withColumn("best_available_score", best)
    )


# ---------------------------------------------------------------- motion audit
def motion_audit(obs: DataFrame, cfg: MotionAuditConfig = MotionAuditConfig()) -> DataFrame:
    """Path, steps, spread about the median position, gaps; five-condition gate."""
    steps = tracklet_steps(obs).withColumn("step_deg", _gc(F.col("p1"), F.col("v")))
    hole = (F.col("frame") - F.col("f1") - 1) > 0
    base = steps.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("obs_count"), (F.max("frame") - F.min("frame") + 1).alias("span_frames"),
        F.min_by("v", "frame").alias("a"), F.max_by("v", "frame").alias("b"),
        F.coalesce(F.sum("step_deg"), geo.lit(0.0)).alias("path_length_deg"), F.count_if(hole).alias("gap_count"),
    )
    base = base.withColumn("net_disp_deg", F.when(F.col("obs_count") > 1, _gc(F.col("a"), F.col("b"))).otherwise(geo.lit(0.0))).drop("a", "b")
    q = exact_percentiles(steps.select(*KEY, "step_deg"), KEY, "step_deg", {"median_step_deg": 0.5, "p90_step_deg": 0.9})
    mid = median_position(obs)
    off = obs.join(mid, KEY).select(*KEY, geo.angular_distance("yaw", "pitch", "median_yaw", "median_pitch").alias("off"))
    mad = exact_percentiles(off, KEY, "off", {"mad": 0.5})
    j = base.join(q, KEY, "left").join(mad, KEY, "left").select(
        *KEY, "obs_count", "span_frames", "net_disp_deg", "path_length_deg", "gap_count",
        F.when(F.col("net_disp_deg") > 1e-9, F.col("path_length_deg") / F.col("net_disp_deg")).alias("path_to_net_ratio"),
        F.coalesce("median_step_deg", geo.lit(0.0)).alias("median_step_deg"),
        F.coalesce("p90_step_deg", geo.lit(0.0)).alias("p90_step_deg"),
        F.when(F.col("obs_count") >= 2, F.col("mad")).otherwise(geo.lit(0.0)).alias("spread_mad_deg"),
        (F.col("gap_count") / F.greatest(F.lit(1), F.col("span_frames"))).alias("gap_fraction"),
    )
    failed = F.array_compact(
        F.array(
            F.when(F.col("obs_count") < cfg.obs_count, "obs_count"),
            F.when(F.col("span_frames") < cfg.span_frames, "span"),
            F.when(F.col("net_disp_deg") >= cfg.net_disp_deg, "net_disp"),
            F.when(F.col("spread_mad_deg") >= cfg.spread_mad_deg, "spread_mad"),
            F.when(F.col("p90_step_deg") >= cfg.p90_step_deg, "p90_step"),
        )
    )
    return j.withColumn("failed", failed).withColumn("would_reject", F.size("failed") == 0).withColumn("borderline", F.size("failed") == 1)


def median_position(obs: DataFrame) -> DataFrame:
    """Plain medians of yaw and pitch (not seam aware, as the audits define them)."""
    y = exact_percentiles(obs.select(*KEY, "yaw"), KEY, "yaw", {"median_yaw": 0.5})
    p = exact_percentiles(obs.select(*KEY, "pitch"), KEY, "pitch", {"median_pitch": 0.5})
    return y.join(p, KEY)


def upper_median_position(obs: DataFrame) -> DataFrame:
    """Upper-middle element, the rule of the run comparison."""
    parts = []
    for c, n in (("yaw", "median_yaw"), ("pitch", "median_pitch")):
        ranked = carry_scan(obs.select(*KEY, "frame", c), KEY, [c, "frame"], F.floor(F.col(c) / 4.0), {"r": Carry("sum", F.lit(1).cast("long"))})
        size = obs.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
        parts.append(ranked.join(size, KEY).filter(F.col("r") == F.floor(F.col("n") / 2) + 1).select(*KEY, F.col(c).alias(n)))
    return parts[0].join(parts[1], KEY)


def feature_stats(obs: DataFrame) -> DataFrame:
    """Mean, population deviation and maximum of box, confidence and plain yaw/pitch steps. Width and height
    follow from area and aspect, and are null where the box is."""
    width, height = F.sqrt(F.col("bbox_area_px") * F.col("bbox_aspect_ratio")), F.sqrt(F.col("bbox_area_px") / F.col("bbox_aspect_ratio"))
    o = carry_scan(obs, KEY, ["frame"], frame_block(), {"prev": Carry("last", F.struct("yaw", "pitch"), exclusive=True)})
    o = o.withColumn("step", F.hypot(F.col("yaw") - F.col("prev.yaw"), F.col("pitch") - F.col("prev.pitch")))
    return o.groupBy(*KEY).agg(
        F.avg(width).alias("width_mean"), F.max(width).alias("width_max"), F.avg(height).alias("height_mean"),
        F.avg("bbox_area_px").alias("area_mean"), F.avg("bbox_aspect_ratio").alias("aspect_mean"), F.max("bbox_aspect_ratio").alias("aspect_max"),
        F.avg("weighted_conf").alias("conf_mean"), F.stddev_pop("weighted_conf").alias("conf_std"),
        F.avg("step").alias("step_mean"), F.max("step").alias("step_max"), F.stddev_pop("step").alias("step_std"),
        (F.count("bbox_area_px") / F.count(F.lit(1))).alias("geo_coverage"),
    )


# ---------------------------------------------------------------- gaps
def anchor_gaps(tracklets: DataFrame, clip_range: DataFrame) -> DataFrame:
    """Frame intervals before, between and after anchors. clip_range: clip_id, first, last.

    Anchors follow each other by start frame; an overlap yields no gap.
    """
    a = tracklets.filter(F.col("status").isin("anchor", "flight_anchor")).select("clip_id", "tracklet_id", "start_frame", "end_frame")
    nxt = carry_scan(a, ["clip_id"], ["start_frame", "tracklet_id"], frame_block("start_frame"),
                     {"n": Carry("first", F.struct("start_frame", "tracklet_id"), exclusive=True)})
    j = nxt.join(clip_range, "clip_id")
    after = F.col("n").isNull()
    between = j.select(
        "clip_id", (F.col("end_frame") + 1).alias("start_frame"),
        F.when(after, F.col("last")).otherwise(F.col("n.start_frame") - 1).alias("end_frame"),
        F.when(after, "after_last_anchor").otherwise("between_anchors").alias("gap_type"),
        F.col("tracklet_id").alias("pre_anchor_id"), F.col("n.tracklet_id").alias("post_anchor_id"),
    )
    first = a.groupBy("clip_id").agg(F.min(F.struct("start_frame", "tracklet_id")).alias("f"))
    head = clip_range.join(first, "clip_id", "left").select(
        "clip_id", F.col("first").alias("start_frame"),
        F.coalesce(F.col("f.start_frame") - 1, F.col("last")).alias("end_frame"),
        F.lit("before_first_anchor").alias("gap_type"),
        F.lit(None).cast(a.schema["tracklet_id"].dataType).alias("pre_anchor_id"), F.col("f.tracklet_id").alias("post_anchor_id"),
    )
    return head.unionByName(between).filter("start_frame <= end_frame").withColumn(
        "span_frames", F.col("end_frame") - F.col("start_frame") + 1)


def gap_evidence(gaps: DataFrame, cand: DataFrame, tracklets: DataFrame, cfg: ScoreConfig = ScoreConfig()) -> DataFrame:
    """Support and reserve evidence, competing tracks and the reason, per gap.

    cand: clip_id, frame, weighted_conf, in_static (label or null).
    Gaps of a clip may overlap (a track that outlives the next anchor), so candidates join
    by frame bucket.
    """
    from fieldlens.operators.joins import overlap_join, point_in_interval

    low = F.col("weighted_conf") < cfg.min_support_conf
    per_frame = cand.groupBy("clip_id", "frame").agg(
        F.max((~low).cast("int")).alias("sup"), F.count_if(low).alias("res"), F.count_if(low & F.col("in_static").isNotNull()).alias("res_static"))
    g = gaps.select("clip_id", "start_frame", "end_frame")
    ev = point_in_interval(per_frame, g, ["clip_id"], "frame", "start_frame", "end_frame").groupBy("clip_id", "start_frame", "end_frame").agg(
        F.sum("sup").alias("support_coverage_frames"), F.sum("res").alias("reserve_candidate_count"), F.sum("res_static").alias("res_static"))
    labels = cand.filter(low & F.col("in_static").isNotNull()).groupBy("clip_id", "frame", "in_static").agg(
        F.count(F.lit(1)).alias("k"))
    dom = point_in_interval(labels, g, ["clip_id"], "frame", "start_frame", "end_frame").groupBy(
        "clip_id", "start_frame", "end_frame", "in_static").agg(F.sum("k").alias("k"), F.min("frame").alias("ff"))
    dom = dom.groupBy("clip_id", "start_frame", "end_frame").agg(
        F.max_by("in_static", F.struct(F.col("k"), -F.col("ff"), F.col("in_static"))).alias("dominant"))
    t = tracklets.filter("status <> 'anchor'").select(
        "clip_id", "tracklet_id", F.col("start_frame").alias("ts"), F.col("end_frame").alias("te"), "status", "best_available_score")
    comp = overlap_join(g, t, ["clip_id"], "start_frame", "end_frame", "ts", "te").groupBy("clip_id", "start_frame", "end_frame").agg(
        F.count(F.lit(1)).alias("competing"), F.count_if(F.col("status") == "rejected_static").alias("rejected"),
        F.max("best_available_score").alias("best_available_score"))
    k = ["clip_id", "start_frame", "end_frame"]
    j = gaps.join(ev, k, "left").join(dom, k, "left").join(comp, k, "left").na.fill(
        0, ["support_coverage_frames", "reserve_candidate_count", "res_static", "competing", "rejected"])
    n = F.col("reserve_candidate_count")
    mostly = (n >= 3) & (F.col("res_static") / F.greatest(n, F.lit(1)) > 0.60)
    reason = (
        F.when(F.col("rejected") > 0, "static_hotspot_tracklet_rejected")
        .when(F.col("competing") > 1, "ambiguous_competing_candidates")
        .when(F.col("competing") == 1, "insufficient_tracklet_score")
        .when(n > 0, "reserve_only")
        .otherwise("no_candidates_after_stage1")
    )
    return j.select(
        *gaps.columns, "support_coverage_frames", reason.alias("gap_reason"), (n > 0).alias("reserve_candidates_present"),
        "reserve_candidate_count", mostly.alias("dominant_reserve_static"), F.when(mostly, F.col("dominant")).alias("dominant_region"),
        F.col("competing").alias("competing_tracklet_count"), "best_available_score",
    )
