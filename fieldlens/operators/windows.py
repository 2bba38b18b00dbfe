"""Gaps and islands, fills and resampling over frame and time series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.config import LossConfig
from fieldlens.functions import geo
from fieldlens.operators.scan import Carry, carry_scan, frame_block, halo_windows, row_index


def loss_windows(frames: DataFrame, cand: DataFrame, cfg: LossConfig = LossConfig(), conf: str = "weighted_conf", tie: str = "det_id") -> DataFrame:
    """Runs of frames without a trusted candidate, with the trusted point on each side.

    A window counts list positions: a frame number that was never examined neither breaks
    nor lengthens it (duration_frames can differ from the frame span).
    """
    trusted = cand.filter(F.col(conf) >= cfg.min_confidence).groupBy("clip_id", "frame").agg(
        F.max_by(F.struct("yaw", "pitch"), F.struct(F.col(conf), -F.col(tie))).alias("p"))
    f = frames.select("clip_id", "frame").join(trusted, ["clip_id", "frame"], "left")
    f = f.withColumn("point", F.when(F.col("p").isNotNull(), F.struct("frame", "p.yaw", "p.pitch"))).drop("p")
    s = carry_scan(
        f, ["clip_id"], ["frame"], frame_block(),
        {
            "island": Carry("sum", F.col("point").isNotNull().cast("long")),
            "before": Carry("last", F.col("point")),
            "after": Carry("first", F.col("point")),
        },
    )
    w = s.filter("point is null").groupBy("clip_id", "island").agg(
        F.min("frame").alias("start_frame"), F.max("frame").alias("end_frame"), F.count(F.lit(1)).alias("duration_frames"),
        F.first("before").alias("b"), F.first("after").alias("a"),
    )
    status = (
        F.when(F.col("b").isNull(), "isolated").when(F.col("a").isNull(), "open").otherwise("bridgeable")
    )
    w = row_index(w, ["clip_id"], ["start_frame"], frame_block("start_frame"), "window_no")
    return w.select(
        "clip_id", F.format_string("W%04d", "window_no").alias("window_id"), "start_frame", "end_frame", "duration_frames",
        F.col("b.frame").alias("last_trusted_frame"), F.col("b.yaw").alias("last_trusted_yaw"), F.col("b.pitch").alias("last_trusted_pitch"),
        F.col("a.frame").alias("first_reacq_frame"), F.col("a.yaw").alias("first_reacq_yaw"), F.col("a.pitch").alias("first_reacq_pitch"),
        status.alias("status"),
    )


def dense_track(obs: DataFrame, frames: DataFrame, gap_max: int = 90) -> DataFrame:
    """One row per frame from anchor observations: interpolate short gaps across the seam,
    hold the previous point over long or trailing gaps, zero before the first.

    obs: clip_id, frame, yaw, pitch, score, tracklet_id (one row per frame).
    """
    key = F.struct("frame", "yaw", "pitch", "tracklet_id", "score")
    o = obs.select("clip_id", "frame", key.alias("k"))
    f = frames.select("clip_id", "frame").join(o, ["clip_id", "frame"], "left")
    s = carry_scan(f, ["clip_id"], ["frame"], frame_block(), {"prev": Carry("last", F.col("k")), "next": Carry("first", F.col("k"))})
    hit = F.col("k").isNotNull()
    gap = F.col("next.frame") - F.col("prev.frame")
    bridge = ~hit & F.coalesce(gap <= gap_max, F.lit(False))
    t = (F.col("frame") - F.col("prev.frame")) / gap
    dy = F.col("next.yaw") - F.col("prev.yaw")
    y1 = F.col("next.yaw") + F.when(dy > 180, -360.0).when(dy < -180, 360.0).otherwise(0.0)
    hold = lambda c: F.coalesce(F.col(f"prev.{c}"), geo.lit(0.0))
    return s.select(
        "clip_id", "frame",
        F.when(hit, F.col("k.yaw")).when(bridge, F.col("prev.yaw") + t * (y1 - F.col("prev.yaw"))).otherwise(hold("yaw")).alias("yaw"),
        F.when(hit, F.col("k.pitch")).when(bridge, F.col("prev.pitch") + t * (F.col("next.pitch") - F.col("prev.pitch"))).otherwise(hold("pitch")).alias("pitch"),
        F.col("k.score").alias("best_score"),
        F.when(hit, "TRACKING").otherwise("LOST").alias("tracker_state"),
        F.when(hit, F.col("k.tracklet_id").cast("string"))
        .when(bridge, F.concat(F.lit("interp("), F.col("prev.tracklet_id").cast("string"), F.lit("->"), F.col("next.tracklet_id").cast("string"), F.lit(")")))
        .alias("source_tracklet"),
    )


def resample(series: DataFrame, keys: list[str], t: str, circular: list[str], plain: list[str], carry: list[str], rate: float,
             duration: DataFrame, block_s: float = 2048.0) -> DataFrame:
    """Dense series at ``rate`` per second: linear between samples (circular columns are
    unwrapped first), held at both ends; ``carry`` columns keep the latest earlier value.

    duration: keys + total_s. Unwrapping needs a running sum of seam-safe steps, so the
    whole job is two blocked scans.
    """
    block = F.floor(F.col(t) / F.lit(block_s))
    specs = {f"_p_{c}": Carry("last", F.col(c), exclusive=True) for c in circular}
    s = carry_scan(series, keys, [t], block, specs) if circular else series
    for c in circular:
        s = s.withColumn(f"_d_{c}", F.coalesce(geo.circular_delta(F.col(c), F.col(f"_p_{c}")), F.col(c)))
    if circular:
        s = carry_scan(s, keys, [t], block, {f"_u_{c}": Carry("sum", F.col(f"_d_{c}")) for c in circular})
    values = [F.col(f"_u_{c}").alias(c) for c in circular] + [F.col(c) for c in plain + carry]
    knots = s.select(*keys, F.col(t).alias("_t"), F.struct(F.col(t).alias("t"), *values).alias("_k")).withColumn("_side", F.lit(0))
    steps = F.ceil(F.col("total_s") * F.lit(rate)).cast("long")
    per = int(block_s * rate)
    grid = (
        duration.withColumn("_gb", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(steps / per))))
        .withColumn("k", F.explode(F.sequence(F.col("_gb") * per, F.least(F.col("_gb") * per + per - 1, steps))))
        .select(*keys, "k", (F.col("k") / F.lit(rate)).alias("_t"))
        .withColumn("_side", F.lit(1))
    )
    u = grid.unionByName(knots, allowMissingColumns=True)
    d = carry_scan(u, keys, ["_t", "_side"], F.floor(F.col("_t") / F.lit(block_s)),
                   {"_a": Carry("last", F.col("_k")), "_b": Carry("first", F.col("_k"))}).filter("_side = 1")
    a, b = F.col("_a"), F.col("_b")
    frac = (F.col("_t") - a["t"]) / (b["t"] - a["t"])

    def lin(c):
        return F.when(a.isNull(), b[c]).when(b.isNull() | (b["t"] <= a["t"]), a[c]).otherwise(a[c] + frac * (b[c] - a[c]))

    return d.select(
        *keys, "k", F.col("_t").alias(t), *[geo.wrap_yaw(lin(c)).alias(c) for c in circular], *[lin(c).alias(c) for c in plain],
        *[F.coalesce(a[c], b[c]).alias(c) for c in carry],
    )


def run_lengths(df: DataFrame, keys: list[str], order: list[str], block: Column, value: str, name: str = "run_len") -> DataFrame:
    """Length so far of the current run of equal non-zero ``value``; 0 where the value is 0."""
    s = row_index(df, keys, order, block, "_rn")
    s = halo_windows(s, keys, "_rn", 1, 0, lambda w: {"_prev": F.lag(value).over(w)})
    start = F.when(F.coalesce(F.col(value) != F.col("_prev"), F.lit(True)), F.col("_rn"))
    s = carry_scan(s.withColumn("_start", start), keys, order, block, {"_from": Carry("last", F.col("_start"))})
    return s.withColumn(name, F.when(F.col(value) == 0, 0).otherwise(F.col("_rn") - F.col("_from") + 1)).drop("_rn", "_prev", "_start", "_from")


def kinematic_audit(path: DataFrame, keys: list[str], t: str, yaw: str, mode: str, max_speed: float, max_accel: float, block: Column) -> DataFrame:
    """Per key: peak speed and acceleration, cap violations, mode changes, share of wide mode."""
    s = row_index(path, keys, [t], block)
    s = halo_windows(s, keys, "rn", 2, 0, lambda w: {
        "t1": F.lag(t, 1).over(w), "t2": F.lag(t, 2).over(w), "y1": F.lag(yaw, 1).over(w), "y2": F.lag(yaw, 2).over(w), "m1": F.lag(mode, 1).over(w)})
    v = geo.circular_delta(F.col(yaw), F.col("y1")) / (F.col(t) - F.col("t1"))
    v1 = geo.circular_delta(F.col("y1"), F.col("y2")) / (F.col("t1") - F.col("t2"))
    s = s.withColumn("v", v).withColumn("a", (v - v1) / (F.col(t) - F.col("t1")))
    return s.groupBy(*keys).agg(
        F.max(F.abs("v")).alias("peak_speed"), F.max(F.abs("a")).alias("peak_accel"),
        F.count_if(F.abs("v") > max_speed + 1e-9).alias("speed_violations"), F.count_if(F.abs("a") > max_accel + 1e-9).alias("accel_violations"),
        F.count_if(F.col(mode) != F.col("m1")).alias("mode_changes"), F.avg((F.col(mode) == "wide").cast("double")).alias("wide_fraction"),
    )


def spaced_picks(df: DataFrame, keys: list[str], order: list[str], block: Column, k: int) -> DataFrame:
    """Even k-of-n selection in order, ends included; all rows when n <= k.

    Index i maps to round-half-even(i (n-1)/(k-1)); a row only has to test the two i nearest to it.
    """
    s = row_index(df, keys, order, block, "_rn")
    s = s.join(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys)
    pos = (F.col("_rn") - 1).cast("double")
    step = (F.col("_n") - 1) / F.lit(float(k - 1))
    guess = F.floor(pos / step)
    hits = [((guess + j).between(0, k - 1)) & (F.rint((guess + j) * step) == pos) for j in (0, 1)]
    return s.filter((F.col("_n") <= k) | hits[0] | hits[1]).withColumn("pick_no", F.col("_rn")).drop("_rn", "_n")


def early_mid_late(df: DataFrame, keys: list[str], order: list[str], block: Column) -> DataFrame:
    """First, middle (index n // 2) and last row, labelled."""
    s = row_index(df, keys, order, block, "_rn").join(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys)
    mid = F.when(F.col("_n") <= 2, 1).otherwise(F.floor(F.col("_n") / 2) + 1)
    labels = F.array_compact(F.array(
        F.when(F.col("_rn") == 1, "EARLY"), F.when(F.col("_rn") == mid, "MID"), F.when(F.col("_rn") == F.col("_n"), "LATE")))
    return s.withColumn("pick", F.explode(labels)).drop("_rn", "_n")


def stitch_chunks(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Shift chunk-local times to the clip and drop each chunk's overlap tail.

    plan: clip_id, chunk, chunk_start, nominal. rows: clip_id, chunk, ts, ...
    """
    j = rows.join(plan, ["clip_id", "chunk"])
    return j.withColumn("ts", F.round(F.col("ts") + F.col("chunk_start"), 4)).filter(
        F.col("ts") < F.col("chunk_start") + F.col("nominal") + 1e-6).drop("chunk_start", "nominal")
