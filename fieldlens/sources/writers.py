"""Sinks: partitioned stage tables with their audit and report, and rounded edge files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.geo import r4

FILE_FRAMES = 65536


def write_stage(data: DataFrame, audit: DataFrame | None, report: DataFrame | None, path: str) -> None:
    """data/, audit/ and report/ under ``path``; data and audit are partitioned by clip.

    Rows meet by clip and stretch of frames first: a clip gets few files, and a long one several writers.
    """
    for name, df in (("data", data), ("audit", audit), ("report", report)):
        if df is None:
            continue
        if name == "report" or "clip_id" not in df.columns:
            df.write.mode("overwrite").parquet(f"{path}/{name}")
            continue
        stretch = [F.floor(F.col("frame") / FILE_FRAMES)] if "frame" in df.columns else []
        df.repartition("clip_id", *stretch).write.mode("overwrite").partitionBy("clip_id").parquet(f"{path}/{name}")


def rounded(df: DataFrame, places: dict[str, int]) -> DataFrame:
    """Rounding belongs to the edge: everything upstream keeps full doubles."""
    for c, n in places.items():
        df = df.withColumn(c, r4(c, n))
    return df


def write_series(df: DataFrame, path: str, fmt: str, places: dict[str, int]) -> None:
    out = rounded(df, places)
    if fmt == "csv":
        out.write.mode("overwrite").option("header", True).csv(path)
    elif fmt == "jsonl":
        out.write.mode("overwrite").json(path)
    else:
        raise ValueError(f"unknown series format {fmt}")


def frame_map(cand: DataFrame, frames: DataFrame) -> DataFrame:
    """Back to one document row per clip and frame: empty frames keep an empty list."""
    rest = [c for c in cand.columns if c not in ("clip_id", "frame")]
    packed = cand.groupBy("clip_id", "frame").agg(F.collect_list(F.struct(*rest)).alias("candidates"))
    return frames.join(packed, ["clip_id", "frame"], "left").withColumn("candidates", F.coalesce("candidates", F.array()))
