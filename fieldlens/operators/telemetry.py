"""Event-log acceptance, thresholds, encoder progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions import geo
from fieldlens.operators.scan import Carry, carry_scan, frame_block


def detection_metrics(events: DataFrame, hit: Column, pan: Column, coast: Column, yaw: str, window_s: float) -> DataFrame:
    """Per clip: fresh-hit rate, longest gap between hit frames, coasting share, yaw spread, acceptance.

    events: clip_id, frame, ... ; hit / pan / coast are row predicates.
    """
    frames = events.filter(hit).select("clip_id", "frame").distinct()
    g = carry_scan(frames, ["clip_id"], ["frame"], frame_block(), {"prev": Carry("last", F.col("frame"), exclusive=True)})
    gaps = g.groupBy("clip_id").agg(F.count(F.lit(1)).alias("fresh_frames"), F.max(F.col("frame") - F.col("prev")).alias("longest_gap_frames"))
    a = events.groupBy("clip_id").agg(
        F.count(F.lit(1)).alias("event_lines"), (F.max("frame") - F.min("frame") + 1).alias("est_frames"), F.count_if(hit).alias("hit_events"),
        F.count_if(pan).alias("pan_decisions"), F.count_if(pan & coast).alias("pan_coast"),
        (F.max(F.when(pan, F.col(yaw))) - F.min(F.when(pan, F.col(yaw)))).alias("yaw_spread"), F.count(F.when(pan, F.col(yaw))).alias("n_yaw"))
    j = a.join(gaps, "clip_id", "left").na.fill(0, ["fresh_frames"])
    fps = F.col("est_frames") / geo.lit(window_s)
    return j.select(
        "clip_id", "event_lines", "fresh_frames", (F.col("fresh_frames") * 100.0 / F.col("est_frames")).alias("fresh_rate_pct"), "longest_gap_frames",
        (F.col("longest_gap_frames") / fps).alias("longest_gap_s"), (F.col("pan_coast") * 100.0 / F.when(F.col("pan_decisions") > 0, F.col("pan_decisions"))).alias("coast_pct"), "yaw_spread",
        ((F.col("hit_events") > 0) & (F.col("n_yaw") >= 2) & F.coalesce(F.col("yaw_spread") >= 1e-4, F.lit(False))).alias("accepted"))


def calibrated_threshold(scores: DataFrame, keys: list[str], t: str, value: str, first_s: float = 60.0, k: float = 2.5, fallback: float = 15.0) -> DataFrame:
    """Mean plus 2.5 population deviations over the first minute; a fallback without samples."""
    early = F.when(F.col(t) <= first_s, F.col(value))
    return scores.groupBy(*keys).agg(F.coalesce(F.avg(early) + F.stddev_pop(early) * k, geo.lit(fallback)).alias("threshold"))


def sustained_rate(progress: DataFrame, run: str, wall: str, work: str, warmup: float) -> DataFrame:
    """Work per wall second from the first tick past the warm-up mark; failed when never reached."""
    past = F.col(work) >= warmup
    g = progress.groupBy(run).agg(
        F.min_by(F.struct(work, wall), F.when(past, F.struct(wall, work))).alias("a"), F.max_by(F.struct(work, wall), F.struct(wall, work)).alias("z"))
    dt, dw = F.col(f"z.{wall}") - F.col(f"a.{wall}"), F.col(f"z.{work}") - F.col(f"a.{work}")
    return g.select(run, F.when(F.col("a").isNull(), geo.lit(0.0)).when((dt > 0) & (dw > 0), dw / F.when(dt > 0, dt)).otherwise(geo.lit(0.0)).alias("rate"), F.col("a").isNull().alias("failed"))


def slow_windows(progress: DataFrame, run: str, tick: str, wall: str, work: str, floor: float, warmup_ticks: int = 12, every: int = 6, strikes: int = 3) -> DataFrame:
    """Instantaneous speed at sampled ticks after warm-up, and the tick at which ``strikes``
    consecutive samples were below the floor (nothing is sampled after an abort)."""
    s = progress.filter((F.col(tick) >= warmup_ticks) & (F.col(tick) % every == 0))
    block = F.floor(F.col(tick) / (4096 * every))
    s = carry_scan(s, [run], [tick], block, {"prev": Carry("last", F.struct(wall, work), exclusive=True)})
    dt = F.col(wall) - F.coalesce(F.col(f"prev.{wall}"), geo.lit(0.0))
    s = s.withColumn("speed", F.when(dt > 0, (F.col(work) - F.coalesce(F.col(f"prev.{work}"), geo.lit(0.0))) / F.when(dt > 0, dt)).otherwise(geo.lit(0.0)))
    s = s.withColumn("slow", F.col("speed") < floor)
    s = s.withColumn("_t", F.when(~F.col("slow"), F.col(tick)))
    s = carry_scan(s, [run], [tick], block, {"_fast": Carry("last", F.col("_t"))})
    since = F.when(F.col("slow"), (F.col(tick) - F.coalesce("_fast", F.lit(warmup_ticks - 1 - (warmup_ticks - 1) % every))) / every).otherwise(0)
    return s.withColumn("slow_streak", F.floor(since)).withColumn("abort", F.col("slow_streak") >= strikes).drop("prev", "_t", "_fast")


def first_abort(windows: DataFrame, run: str, tick: str) -> DataFrame:
    return windows.groupBy(run).agg(F.min(F.when(F.col("abort"), F.col(tick))).alias("abort_tick"), F.count(F.lit(1)).alias("windows"), F.count_if("slow").alias("slow_windows"))


def motion_spikes(scores: DataFrame, thresholds: DataFrame, keys: list[str], t: str, value: str, tie: str, min_gap_s: float = 5.0) -> DataFrame:
    """Scores above the calibrated threshold, debounced to at most one per ``min_gap_s``."""
    from fieldlens.operators.review import greedy_spaced

    hot = scores.join(thresholds, keys).filter(F.col(value) > F.col("threshold"))
    return greedy_spaced(hot, keys, t, tie, min_gap_s, strict=True).filter("kept").drop("kept")


def blob_action(blobs: DataFrame, keys: list[str], frame_w: float, min_area: float = 40.0, scale_px: float = 0.25) -> DataFrame:
    """Area-weighted centre, dispersion and presence x compactness of foreground blobs per frame."""
    b = blobs.filter(F.col("area") >= min_area)
    a = F.col("area")
    c = b.groupBy(*keys).agg(F.sum(a).alias("total"), (F.sum(a * F.col("bx")) / F.sum(a)).alias("cx"), (F.sum(a * F.col("by")) / F.sum(a)).alias("cy"))
    j = b.join(c, keys)
    d2 = F.pow(F.col("bx") - F.col("cx"), geo.lit(2.0)) + F.pow(F.col("by") - F.col("cy"), geo.lit(2.0))
    d = j.groupBy(*keys).agg(F.sqrt(F.sum(d2 * a) / F.max("total")).alias("dispersion"))
    compact = F.exp(-F.col("dispersion") / geo.lit(max(frame_w * scale_px * 2.0, 1.0)))
    return c.join(d, keys).withColumn("score", geo.clamp(F.col("total") / (frame_w * frame_w * 0.001)) * compact)
