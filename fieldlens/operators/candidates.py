"""Candidate refinement: band and venue gates, penalties, reversible quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.config import CandidateConfig, HotspotConfig, RepairConfig
from fieldlens.functions import geo
from fieldlens.operators import spatial
from fieldlens.operators.hotspots import REGION_FIELDS


def gate(det: DataFrame, polygon: Column | None = None, frame_w: float = 3840.0, frame_h: float = 1920.0,
         cfg: CandidateConfig = CandidateConfig()) -> DataFrame:
    """status: kept | venue_rejected | pitch_rejected. The venue test comes first."""
    inside = F.lit(True)
    if polygon is not None:
        x, y = geo.yaw_pitch_to_equirect("yaw", "pitch", geo.lit(frame_w), geo.lit(frame_h))
        inside = geo.point_in_polygon(x, y, polygon)
    band = F.col("pitch").between(cfg.pitch_min_deg, cfg.pitch_max_deg)
    return det.withColumn("status", F.when(~inside, "venue_rejected").when(~band, "pitch_rejected").otherwise("kept"))


def penalise(det: DataFrame, bins: DataFrame, regions: DataFrame, hot: HotspotConfig = HotspotConfig()) -> DataFrame:
    """penalty, weighted_conf and region label per detection. ``bins`` carries penalty_weight."""
    idx = spatial.region_index(regions, ["clip_id"], F.col("radius_deg") * 2.0, REGION_FIELDS)
    near = spatial.region_distances()
    region_w = F.coalesce(
        F.array_min(F.transform(near, lambda r: geo.region_weight(r["dist"], r["radius_deg"], r["peak_duty"], hot))), geo.lit(1.0)
    )
    labelled = F.filter(near, lambda r: geo.within(r["dist"], r["radius_deg"] * 2.0))
    first = F.array_min(F.transform(labelled, lambda r: F.struct(r["region_rank"].alias("k"), r["label"].alias("label"))))
    keyed = det.withColumn("yaw_bin", geo.yaw_bin("yaw", hot.sphere_bin_deg)).withColumn(
        "pitch_bin", geo.pitch_bin("pitch", hot.sphere_bin_deg)
    )
    lookup = bins.select("clip_id", "yaw_bin", "pitch_bin", F.col("penalty_weight").alias("_bin_w"))
    return (
        spatial.attach_regions(keyed.join(lookup, ["clip_id", "yaw_bin", "pitch_bin"], "left"), idx, ["clip_id"])
        .withColumn(
            "penalty",
            F.greatest(geo.lit(hot.penalty_min), F.least(F.coalesce("_bin_w", geo.lit(1.0)), region_w)),
        )
        .withColumn("weighted_conf", F.col("raw_conf") * F.col("penalty"))
        .withColumn("region", first["label"])
        .drop("_bin_w", "regions", "yaw_bin", "pitch_bin")
    )


def static_quarantine(det: DataFrame, regions: DataFrame, threshold: float) -> DataFrame:
    """Nearest confirmed static region that contains the row; the row stays, with a reason block."""
    confirmed = regions.filter((F.col("peak_duty") >= threshold) & (F.col("radius_deg") > 0))
    idx = spatial.region_index(confirmed, ["clip_id"], F.col("radius_deg"), REGION_FIELDS)
    inside = F.filter(spatial.region_distances(), lambda r: geo.within(r["dist"], r["radius_deg"]))
    block = F.struct(
        F.lit("confirmed_static_hotspot").alias("reason"),
        F.col("_hit.label").alias("region"),
        F.col("_hit.peak_duty").alias("region_peak_duty"),
        F.lit(float(threshold)).alias("duty_cycle_threshold"),
        F.col("_hit.radius_deg").alias("region_radius_deg"),
        F.col("_hit.dist").alias("angular_distance_deg"),
    )
    return (
        spatial.attach_regions(det, idx, ["clip_id"])
        .withColumn("_hit", F.array_min(inside))
        .withColumn("quarantine", F.when(F.col("_hit").isNotNull(), block))
        .withColumn("status", F.when(F.col("_hit").isNotNull(), "quarantined").otherwise("active"))
        .drop("_hit", "regions")
    )


def quarantine_region_report(quarantined: DataFrame) -> DataFrame:
    q = quarantined.filter("status = 'quarantined'")
    per_frame = q.groupBy("clip_id", F.col("quarantine.region").alias("region"), "frame").agg(
        F.count(F.lit(1)).alias("n"), F.sum("raw_conf").alias("rc"),
        F.sum("quarantine.angular_distance_deg").alias("ds"), F.max("quarantine.angular_distance_deg").alias("dm"),
    )
    return per_frame.groupBy("clip_id", "region").agg(
        F.sum("n").alias("candidate_count"), F.count(F.lit(1)).alias("frame_count"),
        F.sum("rc").alias("raw_conf_sum"), (F.sum("ds") / F.sum("n")).alias("mean_distance"), F.max("dm").alias("max_distance"),
    )


def geometry_quarantine(det: DataFrame, cfg: CandidateConfig = CandidateConfig()) -> DataFrame:
    """Area and aspect limits for fresh detections; null geometry always passes."""
    g = F.col("detection_geometry")
    fresh = F.coalesce(F.col("source") == "new_detection", F.lit(False))
    area, aspect = g["bbox_area_px"], g["bbox_aspect_ratio"]
    reasons = F.array_compact(
        F.array(
            F.when(fresh & (area > cfg.area_max_px), "bbox_area_px"),
            F.when(fresh & (aspect > cfg.aspect_max), "bbox_aspect_ratio"),
        )
    )
    return det.withColumn("reasons", reasons).withColumn(
        "status", F.when(F.size("reasons") > 0, "geometry_quarantined").otherwise("active")
    )


def geometry_report(q: DataFrame, by: list[str]) -> DataFrame:
    bad = F.col("status") == "geometry_quarantined"
    both = F.size("reasons") == 2
    only = lambda r: bad & ~both & F.array_contains("reasons", r)
    n = lambda c: F.count_if(c)
    return q.groupBy(*by).agg(
        F.count(F.lit(1)).alias("candidates_before"),
        n(~bad).alias("candidates_active"),
        n(bad).alias("candidates_quarantined"),
        n(F.col("source") == "new_detection").alias("new_detection_before"),
        n(F.col("source") == "stage0_reuse").alias("reuse_unchanged"),
        n(only("bbox_area_px")).alias("by_area_only"),
        n(only("bbox_aspect_ratio")).alias("by_aspect_only"),
        n(bad & both).alias("by_both"),
    )


def check_manifest(manifest: DataFrame, radius_cap: float, discovery_radius: float) -> DataFrame:
    """Rows that break the rule 'action radius <= cap and < discovery radius'; empty means valid."""
    r = F.col("action_radius_deg")
    return manifest.filter((r > radius_cap + 1e-6) | (r >= discovery_radius))


def reviewed_location_filter(det: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """status removed|kept by the nearest reviewed location within its action radius."""
    hit = spatial.nearest_within(det, manifest, keys, "action_radius_deg", "location_id")
    return hit.withColumn("status", F.when(F.col("match").isNotNull(), "removed").otherwise("kept"))


def frame_accounting(frames: DataFrame, det: DataFrame, kept: Column) -> DataFrame:
    """Per clip: frames, frames with candidates before and after a filter, newly empty frames."""
    per = det.groupBy("clip_id", "frame").agg(F.count(F.lit(1)).alias("before"), F.count_if(kept).alias("after"))
    j = frames.join(per, ["clip_id", "frame"], "left").na.fill(0, ["before", "after"])
    return j.groupBy("clip_id").agg(
        F.count(F.lit(1)).alias("frames_total"),
        F.sum("before").alias("candidates_before"),
        F.sum("after").alias("candidates_after"),
        F.count_if(F.col("before") > 0).alias("frames_with_before"),
        F.count_if(F.col("after") > 0).alias("frames_with_after"),
        F.count_if((F.col("before") > 0) & (F.col("after") == 0)).alias("frames_newly_zero"),
    )


def anchor_gate(det: DataFrame, cfg: RepairConfig = RepairConfig(), conf: str = "weighted_conf") -> DataFrame:
    """anchor_ok (null geometry passes) and trace_ok (null geometry fails)."""
    g = F.col("detection_geometry")
    b = g["bbox_xyxy"]
    w = F.abs(F.try_element_at(b, F.lit(3)) - F.try_element_at(b, F.lit(1)))
    h = F.abs(F.try_element_at(b, F.lit(4)) - F.try_element_at(b, F.lit(2)))
    boxed = (F.size(b) == 4) & (w > 0) & (h > 0)
    scalars = g["bbox_area_px"].isNotNull() & g["bbox_aspect_ratio"].isNotNull()
    area = F.when(scalars, g["bbox_area_px"]).when(boxed, w * h)
    aspect = F.when(scalars, g["bbox_aspect_ratio"]).when(boxed, w / h)
    known = area.isNotNull() & aspect.isNotNull()
    plausible = F.coalesce(
        area.between(cfg.min_bbox_area_px, cfg.max_bbox_area_px)
        & aspect.between(cfg.min_bbox_aspect_ratio, cfg.max_bbox_aspect_ratio), F.lit(False)
    )
    point = F.col("yaw").isNotNull() & F.col("pitch").isNotNull()
    c = geo.clamp(F.coalesce(F.col(conf), geo.lit(0.0)))
    fence = F.coalesce(
        geo.within(geo.angular_distance("yaw", "pitch", geo.lit(cfg.fence_yaw), geo.lit(cfg.fence_pitch)), cfg.fence_radius_deg),
        F.lit(False),
    )
    return det.withColumn("anchor_ok", point & (c >= cfg.anchor_confidence) & (~known | plausible) & ~fence).withColumn(
        "trace_ok", point & (c >= cfg.trace_confidence) & plausible & ~fence
    )


def classify_frames(frames: DataFrame, cand: DataFrame, cfg: CandidateConfig = CandidateConfig()) -> DataFrame:
    """Six frame labels from per-candidate pitch_rejected / hotspot_rejected / weighted_conf."""
    p, h, wc = F.col("pitch_rejected"), F.col("hotspot_rejected"), F.col("weighted_conf")
    passing = ~p & ~h
    # the two best of a frame: a bounded aggregate, combined map-side
    best = cand.groupBy("clip_id", "frame").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(passing).alias("n_pass"),
        F.count_if(h & ~p).alias("only_hot"),
        F.count_if(p & ~h).alias("only_pitch"),
        F.max(F.when(passing, wc)).alias("top"),
    )
    at_top = cand.filter(passing).join(best.select("clip_id", "frame", "top"), ["clip_id", "frame"]).groupBy("clip_id", "frame").agg(
        F.count_if(wc == F.col("top")).alias("n_top"), F.max(F.when(wc < F.col("top"), wc)).alias("below")
    )
    j = frames.join(best, ["clip_id", "frame"], "left").join(at_top, ["clip_id", "frame"], "left")
    second = F.when(F.col("n_top") > 1, F.col("top")).otherwise(F.col("below"))
    label = (
        F.when(F.col("n").isNull(), "NOT_DETECTED")
        .when((F.col("n_pass") == 0) & (F.col("only_pitch") == F.col("n")), "PITCH_FILTERED")
        .when(F.col("n_pass") == 0, "HOTSPOT_ONLY")
        .when((F.col("top") - second < cfg.ambiguity_spread) & (F.col("top") < cfg.high_conf_thresh), "AMBIGUOUS")
        .when(F.col("top") >= cfg.high_conf_thresh, "BALL_CONFIDENT")
        .otherwise("BALL_WEAK")
    )
    return j.select("clip_id", "frame", label.alias("label"), F.col("top").alias("top_conf"), second.alias("second_conf"))


def agreement_class(frames: DataFrame, cand: DataFrame, track: DataFrame, match_deg: float = 10.0) -> DataFrame:
    """Detection against tracker state per frame. ``track``: clip_id, frame, track_yaw,
    track_pitch, confirmed. ``cand`` carries pitch_rejected and hotspot_rejected."""
    t = frames.join(track, ["clip_id", "frame"], "left")
    d = geo.angular_distance("yaw", "pitch", "track_yaw", "track_pitch")
    near = (
        cand.join(t, ["clip_id", "frame"])
        .withColumn("dist", d)
        .groupBy("clip_id", "frame")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min_by(F.struct("dist", "pitch_rejected", "hotspot_rejected", "det_id"),
                     F.when(F.col("dist").isNotNull(), F.struct("dist", "det_id"))).alias("c"),
        )
    )
    j = t.join(near, ["clip_id", "frame"], "left")
    close = F.coalesce(geo.within(F.col("c.dist"), match_deg), F.lit(False))
    confirmed = F.coalesce(F.col("confirmed"), F.lit(False))
    cls = (
        F.when(F.col("n").isNull(), "NOT_DETECTED")
        .when(~close, "DETECTED_NO_MATCH")
        .when(F.col("c.pitch_rejected") | F.col("c.hotspot_rejected") | ~confirmed, "DETECTED_REJECTED")
        .otherwise("DETECTED_CONFIRMED")
    )
    detail = (
        F.when(F.col("n").isNull(), None)
        .when(~close, "no_candidate_near_tracker")
        .when(F.col("c.pitch_rejected"), "pitch_hard_max")
        .when(F.col("c.hotspot_rejected"), "hotspot")
        .when(~confirmed, "low_score_or_hysteresis")
    )
    return j.select("clip_id", "frame", cls.alias("classification"), detail.alias("rejection_detail"), F.col("c.dist").alias("dist"))


def redetection_consistency(cand: DataFrame, checks: DataFrame) -> DataFrame:
    """0 nothing found, 0.5 found off target, 1 found within tolerance; null when not checked.

    ``checks``: clip_id, det_id, view ('centred'|'shifted'), yaw, pitch of a re-detection
    (null yaw = view examined, nothing fired).
    """
    c = cand.select("clip_id", "det_id", "yaw", "pitch", geo.verification_tolerance("bbox_width_px").alias("tol"))
    r = checks.select("clip_id", "det_id", "view", F.col("yaw").alias("ry"), F.col("pitch").alias("rp"))
    err = geo.angular_distance("yaw", "pitch", "ry", "rp")
    agg = c.join(r, ["clip_id", "det_id"], "left").groupBy("clip_id", "det_id").agg(
        F.first("tol").alias("tol"),
        F.count_if(F.col("view") == "centred").alias("n_c"),
        F.count_if(F.col("view") == "shifted").alias("n_s"),
        F.min(F.when(F.col("view") == "centred", err)).alias("err_c"),
        F.min(F.when(F.col("view") == "shifted", err)).alias("err_s"),
    )
    score = F.when(F.col("n_c") == 0, None).when(F.col("err_c").isNull(), geo.lit(0.0)).when(
        geo.within(F.col("err_c"), F.col("tol")), geo.lit(1.0)).otherwise(geo.lit(0.5))
    shifted = F.when(F.col("n_s") == 0, None).when(geo.within(F.col("err_s"), F.col("tol")), F.lit(1)).otherwise(F.lit(0))
    return agg.select("clip_id", "det_id", "tol", score.alias("consistency"), shifted.alias("shifted_consistency"))
