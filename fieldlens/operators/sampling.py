"""Frame sampling and stratified review manifests."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldlens.operators.scan import Carry, carry_scan


def even_sample_flag(frames: DataFrame, totals: DataFrame, count: int, margin: int) -> DataFrame:
    """``even`` marks the frames of ``count`` evenly spaced samples inside the margins.

    A frame is picked when some i maps to it: only the two nearest i have to be tested.
    """
    step = (F.col("total") - 2 * margin) / F.lit(float(max(count - 1, 1)))
    guess = F.floor((F.col("frame") - margin) / step)

    def picks(i):
        return i.between(0, count - 1) & (F.floor(F.lit(float(margin)) + i * (F.col("total") - 2 * margin) / F.lit(float(max(count - 1, 1)))) == F.col("frame"))

    hit = picks(guess) | picks(guess + 1)
    return frames.join(totals, "clip_id").withColumn("even", F.coalesce(hit, F.lit(False)) & F.col("frame").between(0, F.col("total") - 1))


# Strata with their budgets, in the order in which they are filled.
STRATA = (
    ("temporal_early", 10), ("temporal_mid", 10), ("temporal_late", 10), ("zero_candidates", 10), ("single_candidate", 8), ("multi_candidate", 8),
    ("high_conf", 7), ("low_conf", 7), ("cluttered", 6), ("hotspot_adjacent", 6), ("hotspot_neutral", 5),
)
TARGET = 75
# The same for the frames whose best candidate is reviewed.
CANDIDATE_STRATA = (
    ("temporal_early", 10), ("temporal_mid", 10), ("temporal_late", 10), ("high_conf", 7), ("low_conf", 7), ("multi_candidate", 6),
    ("hotspot_adjacent", 5), ("single_candidate", 5), ("hotspot_neutral", 4), ("cluttered", 4),
)
TOP_QUOTA, SECOND_QUOTA, EMPTY_QUOTA = 50, 10, 15


def shuffle_key(seed: int, *cols):
    """Deterministic order instead of a random shuffle: md5 of seed and identity."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def quartile_thresholds(per_frame: DataFrame) -> DataFrame:
    """Values at index int(0.25 n) and int(0.75 n) of the sorted top confidences of a clip."""
    t = per_frame.filter("top_conf is not null")
    r = carry_scan(t.select("clip_id", "frame", "top_conf"), ["clip_id"], ["top_conf", "frame"], F.floor(F.col("top_conf") * 64), {"rk": Carry("sum", F.lit(1).cast("long"))})
    n = t.groupBy("clip_id").agg(F.count(F.lit(1)).alias("n"))
    at = lambda q: F.max(F.when(F.col("rk") == F.floor(F.col("n") * q) + 1, F.col("top_conf")))
    return r.join(n, "clip_id").groupBy("clip_id").agg(at(0.25).alias("low_t"), at(0.75).alias("high_t"))


def frame_summary(frames: DataFrame, cand: DataFrame) -> DataFrame:
    c = cand.groupBy("clip_id", "frame").agg(
        F.count(F.lit(1)).alias("n"), F.max("weighted_conf").alias("top_conf"), F.min("penalty").alias("min_penalty"))
    total = frames.groupBy("clip_id").agg(F.count(F.lit(1)).alias("total"))
    return frames.join(c, ["clip_id", "frame"], "left").join(total, "clip_id").na.fill(0, ["n"])


def third_of(frame="frame", total="total"):
    t = F.floor(F.col(total) / 3)
    return F.when(F.col(frame) < t, "temporal_early").when(F.col(frame) < 2 * t, "temporal_mid").otherwise("temporal_late")


def frame_strata(per_frame: DataFrame, thresholds: DataFrame) -> DataFrame:
    """One row per (frame, stratum)."""
    f = per_frame.join(thresholds, "clip_id", "left")
    has = F.col("n") > 0
    labels = F.array_compact(F.array(
        third_of(),
        F.when(F.col("n") == 0, "zero_candidates").when(F.col("n") == 1, "single_candidate").otherwise("multi_candidate"),
        F.when(F.col("n") >= 3, "cluttered"),
        F.when(has & (F.col("top_conf") >= F.col("high_t")), "high_conf"),
        F.when(has & (F.col("top_conf") <= F.col("low_t")), "low_conf"),
        F.when(has & (F.col("min_penalty") < 0.5), "hotspot_adjacent"),
        F.when(has & (F.col("min_penalty") >= 0.9), "hotspot_neutral"),
    ))
    return f.select("clip_id", "frame", F.explode(labels).alias("stratum"))


def review_manifest(strata: DataFrame, seed: int = 42, budgets=STRATA, target: int = TARGET) -> DataFrame:
    """Stratified sample per clip: budgets filled in order with frames not yet chosen, then
    trimmed to the rarest or topped up.

    Each pool is first cut to the rows that can still matter (a budget never needs more than
    its own size plus everything chosen before), so the ordered fill sees a few hundred rows
    per clip whatever the clip holds.
    """
    most = sum(n for _, n in budgets) + target
    s = strata.withColumn("h", shuffle_key(seed, "clip_id", "stratum", "frame"))
    sizes = strata.groupBy("clip_id", "stratum").agg(F.count(F.lit(1)).alias("pool"))
    rarity = strata.join(sizes, ["clip_id", "stratum"]).groupBy("clip_id", "frame").agg(F.sum("pool").alias("rarity"))
    pool = s.withColumn("rk", F.row_number().over(W.partitionBy("clip_id", "stratum").orderBy("h"))).filter(F.col("rk") <= most)
    anyf = strata.select("clip_id", "frame").distinct().withColumn("h", shuffle_key(seed, "clip_id", "frame"))
    spare = anyf.withColumn("rk", F.row_number().over(W.partitionBy("clip_id").orderBy("h"))).filter(F.col("rk") <= most).withColumn("stratum", F.lit("~any"))
    rows = pool.unionByName(spare.select(*pool.columns)).join(rarity, ["clip_id", "frame"])
    clip_t = strata.schema["clip_id"].dataType.simpleString()
    return rows.groupBy("clip_id").applyInPandas(_fill(budgets, target), f"clip_id {clip_t}, frame int, stratum string")


def _fill(budgets, target):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        chosen: dict[int, str] = {}
        for name, n in budgets:
            p = pdf[(pdf["stratum"] == name) & ~pdf["frame"].isin(list(chosen))].sort_values("rk")
            chosen.update({int(f): name for f in p["frame"].head(n)})
        rar = pdf.drop_duplicates("frame").set_index("frame")["rarity"]
        if len(chosen) > target:
            keep = sorted(sorted(chosen), key=lambda f: rar[f])[:target]
        else:
            extra = pdf[(pdf["stratum"] == "~any") & ~pdf["frame"].isin(list(chosen))].sort_values("rk")["frame"].head(target - len(chosen))
            keep = [*chosen, *(int(f) for f in extra)]
        return pd.DataFrame([(pdf["clip_id"].iloc[0], f, chosen.get(f, "top_up")) for f in sorted(keep)], columns=["clip_id", "frame", "stratum"])

    return run


def thirds_sample(frames: DataFrame, quota: int, seed: int) -> DataFrame:
    """``quota`` frames per clip: an equal share from each temporal third, the rest from anywhere.

    frames: clip_id, frame, total. Used for second-ranked candidates and for empty frames.
    """
    share = quota // 3
    f = frames.withColumn("third", third_of()).withColumn("h", shuffle_key(seed, "clip_id", "frame"))
    # only the first ``quota`` of a third can be chosen in either round
    f = f.withColumn("rk", F.row_number().over(W.partitionBy("clip_id", "third").orderBy("h"))).filter(F.col("rk") <= quota)
    f = f.withColumn("first", (F.col("rk") <= share).cast("int"))
    order = W.partitionBy("clip_id").orderBy(F.desc("first"), "h")
    return f.withColumn("pos", F.row_number().over(order)).filter(F.col("pos") <= quota).select("clip_id", "frame", "third")


def ranked_samples(per_frame: DataFrame, cand: DataFrame, seed: int = 42, top: int = TOP_QUOTA, second: int = SECOND_QUOTA, empty: int = EMPTY_QUOTA) -> DataFrame:
    """Review rows of a clip: the best candidate of ``top`` frames picked by stratum, the runner-up of
    ``second`` other frames, and ``empty`` frames without a candidate. What a stratum or a third
    cannot fill goes to the frames that are left.

    Columns: clip_id, frame, sample_type, reviewed_rank (0 the best), reason, candidate_count and det_id.
    """
    strata = frame_strata(per_frame.filter("n > 0"), quartile_thresholds(per_frame))
    tops = review_manifest(strata, seed, CANDIDATE_STRATA, top)
    runners = thirds_sample(per_frame.filter("n >= 2").join(tops, ["clip_id", "frame"], "left_anti"), second, seed + 2)
    blanks = thirds_sample(per_frame.filter("n = 0"), empty, seed + 1)

    def part(df, kind, rank, reason):
        return df.select("clip_id", "frame", F.lit(kind).alias("sample_type"), F.lit(rank).cast("int").alias("reviewed_rank"), F.col(reason).alias("reason"))

    picked = part(tops, "top", 0, "stratum").unionByName(part(runners, "non_top", 1, "third")).unionByName(part(blanks, "zero", None, "third"))
    # picks are a fixed number per clip: only their candidates are ranked
    best_first = W.partitionBy("clip_id", "frame").orderBy(F.desc("weighted_conf"), "det_id")
    met = cand.select("clip_id", "frame", "det_id", "weighted_conf").join(picked, ["clip_id", "frame"])
    ranked = met.withColumn("rank", F.row_number().over(best_first) - 1).withColumn("candidate_count", F.count(F.lit(1)).over(W.partitionBy("clip_id", "frame")))
    shown = ["clip_id", "frame", "sample_type", "reviewed_rank", "reason", "candidate_count", "det_id"]
    filled = ranked.filter(F.col("rank") == F.col("reviewed_rank")).select(*shown)
    none = picked.filter("reviewed_rank is null").withColumn("candidate_count", F.lit(0).cast("long")).withColumn("det_id", F.lit(None).cast(cand.schema["det_id"].dataType))
    return filled.unionByName(none.select(*shown))
