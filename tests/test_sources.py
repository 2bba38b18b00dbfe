import json

import pytest
from pyspark.sql import functions as F

from fieldlens.sources import readers as RD
from fieldlens.sources import writers as WR


def test_frame_map_keeps_empty_frames(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"frames": {"0": [{"yaw": 1, "pitch": 2, "weighted_conf": 0.5}], "1": []}}))
    frames, cand = RD.read_frame_map(spark, str(tmp_path))
    assert sorted(r["frame"] for r in frames.collect()) == [0, 1]
    assert [(r["clip_id"], r["frame"], r["yaw"]) for r in cand.collect()] == [("a", 0, 1.0)]


def test_three_payload_shapes(spark, tmp_path):
    c = [{"yaw": 1, "pitch": 2, "raw_conf": 0.4}]
    docs = {"bare": [{"frame_idx": 7, "candidates": c}, {"candidates": []}], "listed": {"frames": [{"index": 3, "candidates": c}]}, "mapped": {"frames": {"9": c}}}
    for n, d in docs.items():
        (tmp_path / f"{n}.json").write_text(json.dumps(d))
    frames, cand = RD.read_loss_payload(spark, str(tmp_path))
    assert sorted((r["clip_id"], r["frame"]) for r in frames.collect()) == [("bare", 1), ("bare", 7), ("listed", 3), ("mapped", 9)]
    assert sorted((r["clip_id"], r["frame"], r["weighted_conf"]) for r in cand.collect()) == [("bare", 7, 0.4), ("listed", 3, 0.4), ("mapped", 9, 0.4)]


def test_event_lines_skip_broken_ones(spark):
    lines = spark.createDataFrame([('{"kind":"detect","frame":3,"hit":true,"pose":{"yaw":0.5}}',), ("{broken",), ('{"type":"pan","frame_idx":4}',)], "value string")
    rows = sorted(tuple(r) for r in RD.parse_event_lines(lines).select("kind", "frame", "hit", "yaw").collect())
    assert rows == [("detect", 3, True, 0.5), ("pan", 4, None, None)]


def test_host_speeds(spark, tmp_path):
    (tmp_path / "h.json").write_text(json.dumps({"1": {"block_until": "2026-07-08T15:44:08+00:00", "last_seen": "x", "last_speed": 1.4, "samples": [0.6, 1.4]}}))
    assert [(r["host"], r["seq"], r["speed"]) for r in RD.read_host_speeds(spark, str(tmp_path)).orderBy("seq").collect()] == [("1", 0, 0.6), ("1", 1, 1.4)]


def test_verdict_csv(spark, tmp_path):
    (tmp_path / "v.csv").write_text("tid,answer\nT1,Likely ball\nT2,fp\nT3,\n")
    got = {r["id"]: r["verdict"] for r in RD.read_verdicts(spark, str(tmp_path), "tid", "answer").collect()}
    assert got == {"T1": "ball", "T2": "fp", "T3": None}


@pytest.mark.parametrize("change,error", [({}, None), ({"source": "other"}, "bad_source"), ({"conf": 1.5}, "conf_range"), ({"bbox": [3.0, 0.0, 1.0, 1.0]}, "bbox_order"), ({"bbox": [1.0]}, "bad_bbox"), ({"aspect": 0.0}, "bad_aspect"), ({"yaw": float("nan")}, "bad_yaw")])
def test_detection_gate(spark, change, error):
    v = {"yaw": 1.0, "conf": 0.5, "source": "yolo", "bbox": [0.0, 0.0, 1.0, 1.0], "aspect": 1.0, **change}
    row = (1, v["yaw"], 2.0, v["conf"], v["source"], 0.0, (v["bbox"], 1.0, v["aspect"]))
    df = spark.createDataFrame([row], "frame int, yaw double, pitch double, conf double, source string, crop_yaw double, detection_geometry struct<bbox_xyxy:array<double>,bbox_area_px:double,bbox_aspect_ratio:double>")
    r = RD.detection_gate(df).first()
    assert r["valid"] == (error is None) and (error is None or error in r["errors"])


def test_stage_tables_are_partitioned(spark, tmp_path):
    d = spark.createDataFrame([("a", 1, 0.123456), ("b", 2, 0.5)], "clip_id string, frame int, x double")
    WR.write_stage(d, d.limit(1), d.groupBy().agg(F.count("*").alias("n")), str(tmp_path))
    assert (tmp_path / "data" / "clip_id=a").exists() and spark.read.parquet(str(tmp_path / "data")).count() == 2
    WR.write_series(d, str(tmp_path / "csv"), "csv", {"x": 3})
    assert sorted(r["x"] for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()) == ["0.123", "0.5"]


def test_upsert_and_merge(spark):
    from fieldlens.operators import merge as M

    base = spark.createDataFrame([("c", 0, 1, 0.0, 0.0, 0.9), ("c", 1, 2, 0.0, 0.0, 0.9), ("c", 2, 3, 0.0, 0.0, 0.9)], "clip_id string, frame int, det_id long, yaw double, pitch double, weighted_conf double")
    rep = spark.createDataFrame([("c", 1, 5.0, 0.0, 0.4, 1), ("c", 2, 5.0, 0.0, 0.4, 1), ("c", 2, 6.0, 0.0, 0.4, 2)], "clip_id string, frame int, yaw double, pitch double, weighted_conf double, seq long")
    dec = spark.createDataFrame([("c", 1, 9.0, 0.0, 0.8, "ball", 1), ("c", 0, 9.0, 0.0, 0.8, "unclear", 1)], "clip_id string, frame int, yaw double, pitch double, weighted_conf double, decision string, seq long")
    got = {r["frame"]: (r["origin"], r["yaw"]) for r in M.merge_tracking(base, rep, dec).collect()}
    assert got == {0: ("base", 0.0), 1: ("decision", 9.0), 2: ("bidirectional", 6.0)}
