"""Joins Spark has no single operator for, as equi joins on buckets plus an exact test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions import geo
from fieldlens.operators import spatial
from fieldlens.operators.scan import Carry, carry_scan
from fieldlens.session import shuffled


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], ls: str, le: str, rs: str, re: str, bucket: int = 64) -> DataFrame:
    """Rows whose closed intervals overlap. A pair meets in several buckets but is kept only
    in the bucket where the later of the two starts, so no distinct is needed."""
    b = lambda c: F.floor(F.col(c) / F.lit(bucket))
    l = left.withColumn("_b", F.explode(F.sequence(b(ls), b(le))))
    r = right.withColumn("_b", F.explode(F.sequence(b(rs), b(re))))
    return (
        l.join(shuffled(r), [*keys, "_b"])
        .filter((F.col(ls) <= F.col(re)) & (F.col(le) >= F.col(rs)))
        .filter(F.col("_b") == F.greatest(b(ls), b(rs)))
        .drop("_b")
    )


def point_in_interval(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, start: str, end: str, bucket: int = 64) -> DataFrame:
    b = lambda c: F.floor(F.col(c) / F.lit(bucket))
    i = intervals.withColumn("_b", F.explode(F.sequence(b(start), b(end))))
    return points.withColumn("_b", b(at)).join(shuffled(i), [*keys, "_b"]).filter(F.col(at).between(F.col(start), F.col(end))).drop("_b")


def nearest_in_time(left: DataFrame, right: DataFrame, keys: list[str], t: str, payload: list[str], later_on_tie: bool = True,
                    block: float = 4096.0) -> DataFrame:
    """As-of join to the closest right row in time; on a tie the later row wins (or the earlier).

    Both sides are merged into one ordered series and scanned in blocks: one shuffle, no
    pairing, and no key lands in a single task. Columns 'near_<payload>' and 'near_t' are added.
    """
    pay = F.struct(F.col(t).alias("t"), *payload)
    # among right rows with one timestamp the first one (lowest payload) is the match
    r = right.groupBy(*keys, t).agg(F.min(F.struct(*payload)).alias("_p")).select(*keys, t, "_p.*").withColumn("_m", pay)
    r = r.select(*keys, t, "_m").withColumn("_side", F.lit(0))
    cols = left.columns
    l = left.withColumn("_row", F.struct(*cols)).select(*keys, t, "_row").withColumn("_side", F.lit(1))
    u = l.unionByName(r, allowMissingColumns=True)
    s = carry_scan(
        u, keys, [t, "_side"], F.floor(F.col(t) / F.lit(block)),
        {"_before": Carry("last", F.col("_m")), "_after": Carry("first", F.col("_m"))},
    ).filter("_side = 1")
    gap_b, gap_a = F.col(t) - F.col("_before.t"), F.col("_after.t") - F.col(t)
    closer = gap_b < gap_a if later_on_tie else gap_b <= gap_a
    # an exact timestamp match sorts before the left row, so it is always "_before"
    pick = F.when(F.col("_after").isNull() | (F.col("_before").isNotNull() & (closer | (gap_b == 0))), F.col("_before")).otherwise(F.col("_after"))
    out = s.withColumn("_n", pick)
    return out.select("_row.*", F.col("_n.t").alias("near_t"), *[F.col(f"_n.{p}").alias(f"near_{p}") for p in payload])


def attach_by_coordinates(obs: DataFrame, cand: DataFrame, payload: str, order: str, decimals: int = 4) -> DataFrame:
    """Left join on (clip, frame, rounded yaw, rounded pitch); the last candidate wins."""
    scale = 10.0**decimals
    k = lambda c: F.round(F.col(c) * F.lit(scale)).cast("long")
    right = cand.groupBy("clip_id", "frame", k("yaw").alias("_ky"), k("pitch").alias("_kp")).agg(
        F.max_by(F.struct(F.col(payload).alias("p")), F.col(order)).alias("_g"))
    l = obs.withColumn("_ky", k("yaw")).withColumn("_kp", k("pitch"))
    j = l.join(right, ["clip_id", "frame", "_ky", "_kp"], "left")
    return j.withColumn(payload, F.col("_g.p")).withColumn("matched", F.col("_g.p").isNotNull()).drop("_g", "_ky", "_kp")


def nearest_in_frame(left: DataFrame, right: DataFrame, tolerance: float | None, order: str, payload: list[str]) -> DataFrame:
    """Closest right row of the same frame (within ``tolerance``); ties go to the lowest ``order``.

    left: clip_id, frame, row_id, yaw, pitch. Adds match_dist and 'm_<payload>'. With a tolerance
    rows meet by cell of that size, so a crowded frame is not paired as a whole.
    """
    r = right.select("clip_id", "frame", F.col("yaw").alias("ry"), F.col("pitch").alias("rp"), F.col(order).alias("_order"),
                     *[F.col(p).alias(f"m_{p}") for p in payload])
    near, keys = left.select("clip_id", "frame", "row_id", "yaw", "pitch"), ["clip_id", "frame"]
    if tolerance is None:
        j = near.join(shuffled(r), keys)
    else:
        edge = spatial.chord(tolerance) * (1 + 1e-6) + 1e-12
        j = spatial.near_join(spatial.with_cell(near, edge), spatial.with_cell(r, edge, "ry", "rp"), keys)
    j = j.withColumn("match_dist", geo.angular_distance("yaw", "pitch", "ry", "rp"))
    if tolerance is not None:
        j = j.filter(geo.within(F.col("match_dist"), tolerance))
    best = j.groupBy("clip_id", "frame", "row_id").agg(
        F.min_by(F.struct("match_dist", *[f"m_{p}" for p in payload]), F.struct("match_dist", "_order")).alias("b"))
    return left.join(shuffled(best), ["clip_id", "frame", "row_id"], "left").select(*left.columns, "b.*")


def first_track_near(probes: DataFrame, tracks: DataFrame, tolerance: float, probe: str, order: str, payload: list[str]) -> DataFrame:
    """The first track (lowest ``order``) that covers a probe's frame and lies within ``tolerance`` degrees of it.

    probes: clip_id, ``probe``, frame, yaw, pitch. tracks: clip_id, ``order``, start_frame, end_frame, yaw, pitch.
    Both meet by cell of that size and frame bucket, so neither the tracks of a moment nor those of a
    place are paired as a whole. Adds 'm_<payload>', null where there is no such track.
    """
    edge = spatial.chord(tolerance) * (1 + 1e-6) + 1e-12
    t = tracks.select("clip_id", "start_frame", "end_frame", F.col("yaw").alias("ty"), F.col("pitch").alias("tp"), F.col(order).alias("_order"),
                      *[F.col(p).alias(f"m_{p}") for p in payload])
    t = spatial.shift_cells(spatial.with_cell(t, edge, "ty", "tp"), 1)
    at = spatial.with_cell(probes.select("clip_id", probe, "frame", "yaw", "pitch"), edge)
    met = point_in_interval(at, t, ["clip_id", *spatial.CELL], "frame", "start_frame", "end_frame")
    met = met.filter(geo.within(geo.angular_distance("yaw", "pitch", "ty", "tp"), tolerance))
    first = met.groupBy("clip_id", probe).agg(F.min_by(F.struct(*[f"m_{p}" for p in payload]), "_order").alias("b"))
    return probes.join(shuffled(first), ["clip_id", probe], "left").select(*probes.columns, "b.*")


def nearest_frame_of_track(probes: DataFrame, obs: DataFrame, reach: int = 5) -> DataFrame:
    """Closest observation of a track to a frame, at most ``reach`` frames away.

    probes: clip_id, tracklet_id, probe_frame. Equal distance: the earlier observation.
    """
    p = probes.withColumn("_lo", F.col("probe_frame") - reach).withColumn("_hi", F.col("probe_frame") + reach)
    j = point_in_interval(obs.select("clip_id", "tracklet_id", "frame", "yaw", "pitch"), p, ["clip_id", "tracklet_id"], "frame", "_lo", "_hi", 64)
    d = F.abs(F.col("frame") - F.col("probe_frame"))
    best = j.groupBy("clip_id", "tracklet_id", "probe_frame").agg(
        F.min_by(F.struct("frame", "yaw", "pitch"), F.struct(d, F.col("frame"))).alias("o"))
    return probes.join(best, ["clip_id", "tracklet_id", "probe_frame"], "left").select(*probes.columns, "o.*")


def precedence_merge(layers: list[tuple[DataFrame, Column]], keys: list[str]) -> DataFrame:
    """Per key keep only the rows of the highest layer present; a hit replaces the whole frame.

    ``layers`` from lowest to highest: (rows, Column ordering duplicates or None for keep-all).
    """
    out, levels = None, []
    for level, (df, dup) in enumerate(layers):
        d = df.withColumn("_level", F.lit(level))
        if dup is not None:
            payload = [c for c in d.columns if c not in keys]
            d = d.groupBy(*keys).agg(F.max_by(F.struct(*payload), dup).alias("_r")).select(*keys, "_r.*")
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    top = out.groupBy(*keys).agg(F.max("_level").alias("_top"))
    return out.join(top, keys).filter("_level = _top").drop("_top")
