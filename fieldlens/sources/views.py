"""Deterministic detection, track, crowd and ledger views derived from the driver tables.

The tables hold no sports detections, so users become tracked objects and fifteen
neighbouring users share a clip: the fleet grows by clips, not by the density of a frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"
FRAME_S = 14400.0
OBJECTS_PER_CLIP = 15
FRAME_BLOCK = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seconds_since_epoch(ts: str):
    # NTZ arithmetic: independent of the session time zone
    return F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, cast({ts} as timestamp_ntz)) / 1e6")


def _keyed_events(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("clip"), F.expr(f"cast(user_id div {OBJECTS_PER_CLIP} as string)")).alias("clip_id"),
        F.floor(seconds_since_epoch("ts") / FRAME_S).cast("int").alias("frame"),
        seconds_since_epoch("ts").alias("t"),
        "ts", "event_id", "user_id", "event_type", "value", "props",
    )


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _keyed_events(spark, sf_dir)
    fresh = F.col("event_type") != "error"
    yaw = (
        F.pmod(
            F.expr("cast(user_id * 47 + case when user_id % 3 = 0 then 2 * frame else 0 end as double)")
            + F.expr("(event_id % 5) * 0.2e0"),
            F.lit(360.0),
        )
        - F.lit(180.0)
    )
    return e.select(
        "clip_id", "frame",
        F.col("event_id").alias("det_id"),
        F.col("user_id").alias("obj_id"),
        yaw.alias("yaw"),
        F.expr("cast((user_id * 13) % 60 - 35 as double) + (event_id % 3) * 0.2e0").alias("pitch"),
        F.expr("(event_id % 97) / 100e0").alias("raw_conf"),
        F.expr("(event_id % 4) * 90e0").alias("crop_yaw"),
        F.when(fresh, "new_detection").otherwise("stage0_reuse").alias("source"),
        F.when(fresh, F.col("value") * 0.5).alias("bbox_area_px"),
        F.when(fresh, F.expr("0.5e0 + (event_id % 11) * 0.1e0")).alias("bbox_aspect_ratio"),
    )


def with_geometry(det: DataFrame) -> DataFrame:
    """Nested geometry: a null struct means "not recorded"; a struct of nulls means "reused"."""
    geometry = F.struct(
        F.when(
            F.col("bbox_area_px").isNotNull(),
            F.array(
                F.lit(10.0), F.lit(20.0),
                F.lit(10.0) + F.sqrt(F.col("bbox_area_px") * F.col("bbox_aspect_ratio")),
                F.lit(20.0) + F.sqrt(F.col("bbox_area_px") / F.col("bbox_aspect_ratio")),
            ),
        ).alias("bbox_xyxy"),
        F.lit(None).cast("double").alias("bbox_width_px"),
        F.lit(None).cast("double").alias("bbox_height_px"),
        "bbox_area_px", "bbox_aspect_ratio",
    )
    return det.withColumn("detection_geometry", F.when(F.col("det_id") % 50 != 0, geometry))


def dense_frames(det: DataFrame) -> DataFrame:
    """clip_id x 0..last frame. Long clips are generated block by block, spread over tasks."""
    last = det.groupBy("clip_id").agg(F.max("frame").alias("last_frame"))
    blocks = last.select(
        "clip_id", "last_frame",
        F.explode(F.sequence(F.lit(0), F.expr(f"last_frame div {FRAME_BLOCK}").cast("int"))).alias("fb"),
    )
    lo = F.col("fb") * FRAME_BLOCK
    return blocks.select(
        "clip_id",
        F.explode(F.sequence(lo, F.least(lo + FRAME_BLOCK - 1, F.col("last_frame")))).alias("frame"),
    )


def track_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ready-made tracks: the most confident detection of an object in a frame."""
    det = detections(spark, sf_dir)
    best = det.groupBy("clip_id", "obj_id", "frame").agg(
        F.max_by(
            F.struct("det_id", "yaw", "pitch", "raw_conf", "source", "bbox_area_px", "bbox_aspect_ratio"),
            F.struct(F.col("raw_conf"), -F.col("det_id")),
        ).alias("d")
    )
    return best.select(
        "clip_id", F.col("obj_id").alias("tracklet_id"), "frame", "d.det_id", "d.yaw", "d.pitch",
        F.col("d.raw_conf").alias("weighted_conf"), "d.source", "d.bbox_area_px", "d.bbox_aspect_ratio",
    )


def strongest(obs: DataFrame) -> DataFrame:
    """One observation a frame: the most confident, of equal ones the smallest id."""
    rest = [c for c in obs.columns if c not in ("clip_id", "frame")]
    best = F.max_by(F.struct(*rest), F.struct(F.col("weighted_conf"), -F.col("det_id")))
    return obs.groupBy("clip_id", "frame").agg(best.alias("o")).select("clip_id", "frame", "o.*")


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player observations: one sample per frame, two samples a second."""
    return track_obs(spark, sf_dir).select(
        "clip_id",
        F.col("frame").alias("sample"),
        (F.col("frame") * F.lit(0.5)).alias("ts"),
        F.col("tracklet_id").alias("track_id"),
        "det_id", "yaw", "pitch",
        F.col("weighted_conf").alias("conf"),
        F.expr("(det_id % 41) * 1e0").alias("vel"),
        F.expr("40e0 + (det_id % 23)").alias("box_h"),
    )


def media(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    captured = F.col("o_orderdate").cast("timestamp_ntz")
    return o.select(
        F.col("o_orderkey").alias("media_id"),
        F.concat(F.lit("GX"), F.col("o_custkey").cast("string"), F.lit(".MP4")).alias("filename"),
        captured.alias("captured_at"),
        (captured + F.expr("make_interval(0, 0, 0, cast(o_orderkey % 20 as int))")).alias("created_at"),
        (captured + F.expr("make_interval(0, 0, 0, cast(o_orderkey % 25 as int))")).alias("updated_at"),
        (F.col("o_totalprice") * F.lit(1000.0)).alias("file_size"),
    )


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media(spark, sf_dir).filter("media_id % 3 = 0")


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("media_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("attempted_at"),
        F.col("l_linenumber").alias("attempt"),
        F.col("l_partkey").alias("tie"),
        F.when(F.col("l_returnflag") == "R", "failed").otherwise("ok").alias("outcome"),
        F.when(F.col("l_linestatus") == "O", "download failed").otherwise("upload rejected").alias("reason"),
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed_events(spark, sf_dir).select(
        "clip_id", "frame", "event_id", "t", F.col("event_type").alias("kind"), "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"), "props",
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select(
        "vec_id", *[F.element_at("embedding", i).cast("double").alias(f"e{i}") for i in (1, 2, 3)]
    )
    norm = F.sqrt(F.col("e1") * F.col("e1") + F.col("e2") * F.col("e2") + F.col("e3") * F.col("e3"))
    return e.select(
        F.lit("all").alias("clip_id"),
        F.col("vec_id").alias("id"),
        F.degrees(F.atan2("e1", "e3")).alias("yaw"),
        F.degrees(F.asin(F.col("e2") / norm)).alias("pitch"),
    )


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source")
    l = table(spark, sf_dir, "labels")
    verdict = (
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "ball")
        .when(F.col("quality") == 0, "fp")
        .otherwise("unclear")
    )
    return d.join(l, "doc_id").select(
        F.col("doc_id").alias("id"), verdict.alias("verdict"),
        F.col("n_chars").cast("double").alias("f1"),
        F.expr("cast(doc_id % 7 as double)").alias("f2"),
        F.expr("case when doc_id % 9 = 0 then null else cast((doc_id * 31) % 101 as double) end").alias("f3"),
        F.expr("cast(n_chars % 13 as double)").alias("f4"),
    )


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url")


def running_rank(keys, order):
    return F.row_number().over(W.partitionBy(*keys).orderBy(*order))
