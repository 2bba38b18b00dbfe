"""Readers for the document shapes that detectors, trackers and ledgers leave behind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions import text

CANDIDATE = (
    "struct<yaw:double,pitch:double,raw_conf:double,weighted_conf:double,conf:double,confidence:double,penalty:double,"
    "source:string,crop_yaw:double,region:string,detection_geometry:struct<bbox_xyxy:array<double>,bbox_width_px:double,"
    "bbox_height_px:double,bbox_area_px:double,bbox_aspect_ratio:double,crop_width_px:double,crop_height_px:double>>"
)
# Accepted names, in order of preference.
FRAME_ALIASES = ("frame_index", "frame_idx", "frame_number", "frame", "index")
CONFIDENCE_ALIASES = ("weighted_conf", "raw_conf", "confidence", "conf")
TYPE_ALIASES = ("type", "event", "event_type", "kind")
HIT_ALIASES = ("has_ball", "ball_found", "detected", "hit")
ALLOWED_SOURCES = ("yolo", "vlm", "yolo_finetuned")


def clip_of(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]+)\\.[^./]+$", 1)


def finite(c: Column) -> Column:
    """Numbers only: NaN and infinities count as missing."""
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), None).otherwise(c)


def confidence(c: Column) -> Column:
    return F.coalesce(*[finite(c[n]) for n in CONFIDENCE_ALIASES])


def read_frame_map(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """{"frames": {"<n>": [candidate, ...]}} -> (dense frames incl. empty ones, candidates)."""
    doc = spark.read.schema(f"frames map<string,array<{CANDIDATE}>>").json(path, multiLine=True)
    f = doc.select(clip_of(F.input_file_name()).alias("clip_id"), F.explode("frames")).select(
        "clip_id", F.col("key").cast("int").alias("frame"), "value")
    c = f.select("clip_id", "frame", F.posexplode("value").alias("det_no", "c")).select("clip_id", "frame", "det_no", "c.*")
    return f.select("clip_id", "frame"), c


def read_loss_payload(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Three shapes: a bare list of frames, a list under "frames", a map under "frames".

    Each is parsed with its own schema; the first valid integer alias numbers the frame,
    else its position.
    """
    raw = spark.read.text(path, wholetext=True).select(clip_of(F.input_file_name()).alias("clip_id"), F.col("value").alias("doc"))
    aliases = ",".join(f"{a}:double" for a in FRAME_ALIASES)
    item = f"array<struct<{aliases},candidates:array<{CANDIDATE}>>>"
    bare = F.from_json("doc", item)
    listed = F.from_json("doc", f"struct<frames:{item}>")["frames"]
    mapped = F.from_json("doc", f"struct<frames:map<string,array<{CANDIDATE}>>>")["frames"]
    first = F.substring(F.ltrim(F.col("doc")), 1, 1)
    is_map = F.col("doc").rlike('"frames"\\s*:\\s*\\{')
    lists = raw.filter((first == "[") | ~is_map).select("clip_id", F.posexplode(F.when(first == "[", bare).otherwise(listed)).alias("pos", "f"))
    number = F.coalesce(*[F.when(F.col(f"f.{a}") == F.floor(F.col(f"f.{a}")), F.col(f"f.{a}")) for a in FRAME_ALIASES], F.col("pos"))
    a = lists.select("clip_id", number.cast("int").alias("frame"), F.col("f.candidates").alias("cs"))
    b = raw.filter((first != "[") & is_map).select("clip_id", F.explode(mapped)).select("clip_id", F.col("key").cast("int").alias("frame"), F.col("value").alias("cs"))
    u = a.unionByName(b)
    c = u.select("clip_id", "frame", F.posexplode("cs").alias("det_no", "c"))
    return u.select("clip_id", "frame"), c.select("clip_id", "frame", F.col("det_no").alias("det_id"), "c.yaw", "c.pitch", confidence(F.col("c")).alias("weighted_conf"), "c.detection_geometry")


PLAYER = "struct<yaw:double,pitch:double,conf:double,foot_yaw:double,foot_pitch:double,box_h:double,vel_deg_per_sec:double,track_id:long>"
SAMPLE = (
    f"timestamp double, frame int, players array<{PLAYER}>, person_centroid_yaw double, person_centroid_pitch double, person_centroid_size int,"
    " person_centroid_dispersion_deg double, total_retained_players int"
)


def read_samples(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """JSONL sample records -> (one row per sample, one row per player)."""
    s = spark.read.schema(SAMPLE).json(path)
    # a folder written by clip carries clip_id; loose files are named after their clip
    s = s if "clip_id" in s.columns else s.withColumn("clip_id", clip_of(F.input_file_name()))
    p = s.select("clip_id", F.col("timestamp").alias("ts"), "frame", F.explode("players").alias("p")).select(
        "clip_id", "ts", "frame", "p.*").withColumn("vel", F.coalesce("vel_deg_per_sec", F.lit(0.0))).drop("vel_deg_per_sec")
    return s.drop("players"), p


def read_verdicts(spark: SparkSession, path: str, id_col: str, verdict_col: str) -> DataFrame:
    v = spark.read.option("header", True).csv(path)
    return v.withColumn("verdict", text.normalise_verdict(F.col(verdict_col))).withColumnRenamed(id_col, "id")


def parse_event_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Any JSON lines: malformed ones are skipped; type, frame and hit are found by known names."""
    v = lines.withColumn("v", F.try_parse_json(F.col(value))).filter("v is not null")
    get = lambda names, t: F.coalesce(*[F.try_variant_get("v", f"$.{n}", t) for n in names])
    return v.select(
        *[c for c in lines.columns if c != value], get(TYPE_ALIASES, "string").alias("kind"), get(FRAME_ALIASES, "int").alias("frame"),
        get(HIT_ALIASES, "boolean").alias("hit"), F.try_variant_get("v", "$.pose.yaw", "double").alias("yaw"), F.col(value).alias("doc"))


def key_inventory(lines: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Which top-level keys occur, how often: the schema report of an unknown log."""
    keys = F.json_object_keys(F.col(value))
    return lines.select(*by, F.explode(keys).alias("key")).groupBy(*by, "key").agg(F.count(F.lit(1)).alias("n"))


def read_host_speeds(spark: SparkSession, path: str) -> DataFrame:
    """{host: {last_speed, samples: [...], block_until, last_seen}} -> one row per sample."""
    doc = spark.read.text(path, wholetext=True).select(
        F.explode(F.from_json("value", "map<string,struct<block_until:string,last_seen:string,last_speed:double,samples:array<double>>>")).alias("host", "h"))
    return doc.select("host", F.posexplode("h.samples").alias("seq", "speed"), F.try_to_timestamp(F.col("h.block_until")).alias("block_until"))


def detection_gate(d: DataFrame) -> DataFrame:
    """All rules at once: ``errors`` lists every broken one, ``valid`` when none is.

    d: frame, yaw, pitch, conf, source, crop_yaw, detection_geometry.
    """
    g = F.col("detection_geometry")
    b = g["bbox_xyxy"]
    at = lambda i: F.try_element_at(b, F.lit(i))
    numbers = (F.size(b) == 4) & F.coalesce(F.forall(b, lambda x: finite(x).isNotNull()), F.lit(False))
    rules = {
        "missing_frame": F.col("frame").isNull(), "bad_yaw": finite(F.col("yaw")).isNull(), "bad_pitch": finite(F.col("pitch")).isNull(),
        "bad_source": ~F.coalesce(F.col("source").isin(*ALLOWED_SOURCES), F.lit(False)), "bad_crop_yaw": finite(F.col("crop_yaw")).isNull(),
        "missing_geometry": g.isNull(), "bad_bbox": g.isNotNull() & ~F.coalesce(numbers, F.lit(False)),
        "bbox_order": F.coalesce(numbers & ((at(3) < at(1)) | (at(4) < at(2))), F.lit(False)),
        "bad_area": g.isNotNull() & ~F.coalesce(finite(g["bbox_area_px"]) >= 0, F.lit(False)),
        "bad_aspect": g.isNotNull() & ~F.coalesce(finite(g["bbox_aspect_ratio"]) > 0, F.lit(False)),
        "conf_range": ~F.coalesce(finite(F.col("conf")).between(0.0, 1.0), F.lit(False)),
    }
    errors = F.array_compact(F.array(*[F.when(bad, name) for name, bad in rules.items()]))
    return d.withColumn("errors", errors).withColumn("valid", F.size("errors") == 0)
