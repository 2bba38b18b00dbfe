"""Static false-positive map: duty cycle per spherical bin, then merged regions."""

from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldlens.config import HotspotConfig
from fieldlens.functions import geo
from fieldlens.operators import spatial
from fieldlens.operators.blockrun import run_blocks
from fieldlens.session import cut


def duty_cycle_bins(det: DataFrame, frames: DataFrame, cfg: HotspotConfig = HotspotConfig()) -> DataFrame:
    """Per clip and bin: share of sampled frames with a detection there (empty frames count).

    Counting frames first by (clip, bin, frame) lets both steps combine map-side.
    """
    b = det.select(
        "clip_id", "frame", "raw_conf",
        geo.yaw_bin("yaw", cfg.sphere_bin_deg).alias("yaw_bin"),
        geo.pitch_bin("pitch", cfg.sphere_bin_deg).alias("pitch_bin"),
    )
    per_frame = b.groupBy("clip_id", "yaw_bin", "pitch_bin", "frame").agg(
        F.count(F.lit(1)).alias("n"), F.sum("raw_conf").alias("conf")
    )
    bins = per_frame.groupBy("clip_id", "yaw_bin", "pitch_bin").agg(
        F.count(F.lit(1)).alias("n_timestamps"), F.sum("n").alias("n_detections"), F.sum("conf").alias("conf")
    )
    sampled = frames.groupBy("clip_id").agg(F.count(F.lit(1)).alias("sampled"))
    duty = F.col("n_timestamps") / F.col("sampled")
    pitch_centre = geo.bin_centre("pitch_bin", -90.0, cfg.sphere_bin_deg)
    return bins.join(sampled, "clip_id").select(
        "clip_id", "yaw_bin", "pitch_bin",
        geo.bin_centre("yaw_bin", -180.0, cfg.sphere_bin_deg).alias("yaw_centre"),
        pitch_centre.alias("pitch_centre"),
        duty.alias("duty_cycle"),
        geo.penalty_weight(duty, cfg).alias("bin_penalty_weight"),
        "n_timestamps", "n_detections",
        (F.col("conf") / F.col("n_detections")).alias("mean_conf"),
        pitch_centre.between(cfg.pitch_soft_min, cfg.pitch_hard_max).alias("in_pitch_bounds"),
    )


def hotspot_regions(bins: DataFrame, cfg: HotspotConfig = HotspotConfig()) -> DataFrame:
    """Seed bins linked within the merge radius; centre is the duty-weighted mean direction."""
    seeds = bins.filter(F.col("duty_cycle") >= cfg.low_duty_floor).select(
        "clip_id",
        (F.col("yaw_bin").cast("long") * 100000 + F.col("pitch_bin")).alias("bin"),
        F.col("yaw_centre").alias("yaw"), F.col("pitch_centre").alias("pitch"), "duty_cycle",
    )
    seeds = cut(seeds)  # small, and read several times below
    comp = spatial.spatial_components(seeds, ["clip_id"], "bin", cfg.merge_radius_deg)
    m = seeds.join(comp, ["clip_id", "bin"])
    w = F.col("duty_cycle")
    centre = m.groupBy("clip_id", "comp").agg(
        F.sum(w * geo.unit_x("yaw", "pitch")).alias("x"),
        F.sum(w * geo.unit_y("pitch")).alias("y"),
        F.sum(w * geo.unit_z("yaw", "pitch")).alias("z"),
        F.max("duty_cycle").alias("peak_duty"),
        F.count(F.lit(1)).alias("n_members"),
    )
    norm = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    norm = F.when(norm > 0, norm).otherwise(geo.lit(1.0))
    centre = centre.select(
        "clip_id", "comp", "peak_duty", "n_members",
        geo.vec_yaw("x", "z").alias("centre_yaw"), geo.vec_pitch(F.col("y") / norm).alias("centre_pitch"),
    )
    half_diagonal = cfg.sphere_bin_deg * math.sqrt(2.0) / 2.0
    reach = m.join(centre, ["clip_id", "comp"]).groupBy("clip_id", "comp").agg(
        (F.max(geo.angular_distance("yaw", "pitch", "centre_yaw", "centre_pitch")) + geo.lit(half_diagonal)).alias("radius_deg")
    )
    order = W.partitionBy("clip_id").orderBy(F.desc("peak_duty"), "comp")
    return cut(centre.join(reach, ["clip_id", "comp"]).select(
        "clip_id", "comp", "centre_yaw", "centre_pitch", "radius_deg", "peak_duty", "n_members",
        F.row_number().over(order).alias("region_rank"),
        region_label("centre_yaw", "centre_pitch").alias("label"),
    ))


def region_label(yaw, pitch):
    one = lambda c: F.format_string("%.1f", geo.r4(c, 1))
    return F.concat(F.lit("("), one(yaw), F.lit(","), one(pitch), F.lit(")"))


REGION_FIELDS = ["region_rank", "label", "centre_yaw", "centre_pitch", "radius_deg", "peak_duty"]


def final_bin_penalty(bins: DataFrame, regions: DataFrame, cfg: HotspotConfig = HotspotConfig()) -> DataFrame:
    """Stronger of a bin's own penalty and the nearby regions' penalty, floored."""
    idx = spatial.region_index(regions, ["clip_id"], F.col("radius_deg") * 2.0, REGION_FIELDS)
    b = bins.withColumn("yaw", F.col("yaw_centre")).withColumn("pitch", F.col("pitch_centre"))
    near = spatial.region_distances()
    rw = F.coalesce(
        F.array_min(F.transform(near, lambda r: geo.region_weight(r["dist"], r["radius_deg"], r["peak_duty"], cfg))), geo.lit(1.0)
    )
    return (
        spatial.attach_regions(b, idx, ["clip_id"])
        .withColumn("region_penalty_weight", rw)
        .withColumn(
            "penalty_weight",
            F.greatest(geo.lit(cfg.penalty_min), F.least("bin_penalty_weight", "region_penalty_weight")),
        )
        .drop("regions", "yaw", "pitch")
    )


def coverage_hotspots(bins: DataFrame, cfg: HotspotConfig = HotspotConfig(), min_coverage: float = 0.40) -> DataFrame:
    """Sampled-timestamp discovery: merged regions seen in enough of the sampled frames."""
    regions = hotspot_regions(bins, cfg)
    return regions.filter(F.col("peak_duty") >= min_coverage)


def hits_per_region(det: DataFrame, regions: DataFrame) -> DataFrame:
    """Detections suppressed per region; a detection counts for the first region that holds it."""
    idx = spatial.region_index(regions, ["clip_id"], F.col("radius_deg"), REGION_FIELDS)
    inside = F.filter(spatial.region_distances(), lambda r: geo.within(r["dist"], r["radius_deg"]))
    first = F.array_min(F.transform(inside, lambda r: r["region_rank"]))
    hits = (
        spatial.attach_regions(det, idx, ["clip_id"])
        .withColumn("region_rank", first)
        .filter("region_rank is not null")
        .groupBy("clip_id", "region_rank")
        .agg(F.count(F.lit(1)).alias("hit_count"))
    )
    return regions.join(hits, ["clip_id", "region_rank"], "left").withColumn("hit_count", F.coalesce("hit_count", F.lit(0)))


def _leader(radius: float):
    """Rows in order: each joins the first cluster whose running centre is nearer than ``radius``, else it
    opens one. A centre weighs a new member against the frames it has been seen in so far."""

    def run(pdf: pd.DataFrame, state: str | None):
        centres = [tuple(c) for c in json.loads(state)] if state else []  # yaw, pitch, frames, last frame
        at = np.empty((max(64, 2 * len(centres)), 3))
        unit = lambda y, p: (math.cos(p) * math.cos(y), math.cos(p) * math.sin(y), math.sin(p))
        turn = lambda y, p: unit(math.radians(y), math.radians(p))
        for i, (y, p, _, _) in enumerate(centres):
            at[i] = turn(y, p)
        found = []
        for frame, yaw, pitch in zip(pdf["frame"].tolist(), pdf["yaw"].tolist(), pdf["pitch"].tolist()):
            v = np.array(turn(yaw, pitch))
            near = at[: len(centres)]
            dist = np.degrees(np.arctan2(np.linalg.norm(np.cross(near, v), axis=1), near @ v))
            hits = np.flatnonzero(dist < radius - 1e-9)
            if len(hits):
                k = int(hits[0])
                y, p, n, seen = centres[k]
                centres[k] = ((y * n + yaw) / (n + 1), (p * n + pitch) / (n + 1), n + (seen != frame), frame)
            else:
                k = len(centres)
                centres.append((yaw, pitch, 1, frame))
                if k == len(at):
                    at = np.concatenate([at, np.empty_like(at)])
            at[k] = turn(*centres[k][:2])
            found.append((k, *centres[k][:2]))
        out = pd.DataFrame(found, columns=["cluster", "centre_yaw", "centre_pitch"])
        for c in ("frame", "det_id", "raw_conf", "crop_yaw"):
            out[c] = pdf[c].to_numpy()
        return out, json.dumps(centres)

    return run


def leader_clusters(det: DataFrame, frames: DataFrame, cfg: HotspotConfig = HotspotConfig(), block_frames: int = 65536) -> DataFrame:
    """Static regions by clustering in order: detections are read by (frame, det_id), and the first
    cluster in reach takes each. A cluster seen in enough of the clip's frames is a region.

    The order decides, so a clip is one chain: its blocks of frames hand the centres on. Centres lie a
    radius apart when they open, so the state is bounded by the sphere, not by the clip.
    Columns: clip_id, cluster (in order of opening), yaw, pitch, frame_count, coverage, mean_conf, crops.
    """
    rows = det.select("clip_id", "frame", "det_id", "yaw", "pitch", "raw_conf", "crop_yaw").withColumn("_block", F.floor(F.col("frame") / block_frames))
    ids = det.schema["det_id"].dataType.simpleString()
    schema = f"cluster int, centre_yaw double, centre_pitch double, frame int, det_id {ids}, raw_conf double, crop_yaw double"
    member = run_blocks(rows, ["clip_id"], "_block", ["frame", "det_id"], _leader(cfg.leader_radius_deg), schema)
    # members of one frame and crop are counted first, so that every step combines map-side
    per_crop = member.groupBy("clip_id", "cluster", "crop_yaw").agg(F.count(F.lit(1)).alias("n"))
    crops = per_crop.filter("crop_yaw is not null").groupBy("clip_id", "cluster").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("crop_yaw", "n")))).alias("crops"))
    per_frame = member.groupBy("clip_id", "cluster", "frame").agg(
        F.sum("raw_conf").alias("conf"), F.count("raw_conf").alias("n"),
        F.max_by(F.struct("centre_yaw", "centre_pitch"), "det_id").alias("c"))
    per = per_frame.groupBy("clip_id", "cluster").agg(
        F.count(F.lit(1)).alias("frame_count"), (F.sum("conf") / F.sum("n")).alias("mean_conf"), F.max_by("c", "frame").alias("c"))
    total = frames.groupBy("clip_id").agg(F.count(F.lit(1)).alias("total"))
    kept = per.join(total, "clip_id").withColumn("coverage", F.col("frame_count") / F.col("total")).filter(F.col("coverage") >= cfg.leader_min_coverage)
    return kept.join(crops, ["clip_id", "cluster"], "left").select(
        "clip_id", "cluster", F.col("c.centre_yaw").alias("yaw"), F.col("c.centre_pitch").alias("pitch"), "frame_count", "coverage", "mean_conf", "crops")
