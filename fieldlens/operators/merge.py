"""Overrides of a base series by repairs and decisions, and ledger-style upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.operators.joins import precedence_merge


def merge_tracking(base: DataFrame, repairs: DataFrame, decisions: DataFrame) -> DataFrame:
    """decision(ball) > repair > base; a hit replaces all candidates of the frame, and among
    repeated hits the last (highest ``seq``) counts.

    base: clip_id, frame, det_id, yaw, pitch, weighted_conf. repairs: + seq. decisions: +
    decision, seq; only 'ball' rows with a position are used.
    """
    cols = ["clip_id", "frame", "yaw", "pitch", "weighted_conf"]
    b = base.select(*cols, F.lit("base").alias("origin"), F.col("det_id").alias("seq"))
    r = repairs.select(*cols, F.lit("bidirectional").alias("origin"), "seq")
    d = decisions.filter("decision = 'ball' and yaw is not null and pitch is not null").select(*cols, F.lit("decision").alias("origin"), "seq")
    return precedence_merge([(b, None), (r, F.col("seq")), (d, F.col("seq"))], ["clip_id", "frame"])


def replay_repairs(tracking: DataFrame, repairs: DataFrame) -> DataFrame:
    """Fill frames whose best_score is null from valid repairs; never override a confirmation.

    tracking: clip_id, frame, yaw, pitch, best_score, tracker_state. repairs: clip_id, frame,
    seq, yaw, pitch, weighted_conf, source.
    """
    j = tracking.join(_valid(repairs), ["clip_id", "frame"], "left")
    hit = F.col("r").isNotNull() & F.col("best_score").isNull()
    over = lambda c, r: F.when(hit, F.col(f"r.{r}")).otherwise(F.col(c)).alias(c)
    return j.select(
        "clip_id", "frame", over("yaw", "yaw"), over("pitch", "pitch"), over("best_score", "weighted_conf"), "tracker_state",
        hit.alias("overridden"), F.when(hit, F.lit("phase_b_repair")).alias("loss_state"), F.when(hit, F.col("r.source")).alias("override_source"))


def _valid(repairs: DataFrame) -> DataFrame:
    good = repairs.filter(
        F.col("yaw").isNotNull() & F.col("pitch").isNotNull() & F.col("source").isNotNull() & F.col("weighted_conf").between(0.0, 1.0))
    return good.groupBy("clip_id", "frame").agg(F.max_by(F.struct("yaw", "pitch", "weighted_conf", "source"), "seq").alias("r"))


def replay_summary(tracking: DataFrame, repairs: DataFrame) -> DataFrame:
    """Outcome counts per clip: frames, valid repairs, applied, already confirmed, unknown frame."""
    t = tracking.select("clip_id", "frame", "best_score", F.lit(1).alias("t"))
    j = t.join(_valid(repairs), ["clip_id", "frame"], "full")
    has_t, has_r = F.col("t").isNotNull(), F.col("r").isNotNull()
    return j.groupBy("clip_id").agg(
        F.count_if(has_t).alias("tracking_frames"), F.count_if(has_r).alias("valid_repairs"),
        F.count_if(has_t & has_r & F.col("best_score").isNull()).alias("overrides_applied"),
        F.count_if(has_t & has_r & F.col("best_score").isNotNull()).alias("skipped_confirmed"),
        F.count_if(has_r & ~has_t).alias("repairs_not_found"),
    )


def upsert(current: DataFrame, changes: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Insert or replace by key: the row with the highest version stays. The result is a new
    table to write; the largest version per key is an aggregate, combined before the shuffle."""
    u = current.unionByName(changes, allowMissingColumns=True)
    rest = [c for c in u.columns if c not in keys]
    return u.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_r")).select(*keys, "_r.*").select(*u.columns)


def latest_log(log: DataFrame, keys: list[str], version: str, deleted: str = "op") -> DataFrame:
    """Current view of an append-only edit log; a last 'delete' removes the key."""
    rest = [c for c in log.columns if c not in keys]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_r")).select(*keys, "_r.*")
    return last.filter(F.col(deleted) != "delete")
