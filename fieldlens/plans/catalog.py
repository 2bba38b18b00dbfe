"""Loads every query module and holds the flagship plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions.geo import r4
from fieldlens.operators import candidates as C
from fieldlens.operators import windows as WN
from fieldlens.plans import detection_queries as D
from fieldlens.plans import sqlkit as Q
from fieldlens.plans import crowd_queries, ledger_queries, review_queries, stream_queries, track_queries  # noqa: F401
from fieldlens.plans.registry import REGISTRY, query
from fieldlens.sources import views as V

__all__ = ["REGISTRY", "flagship"]

SURVIVE = f"""SELECT d.*, d.raw_conf*d.penalty AS weighted_conf FROM pen d LEFT JOIN static s ON s.det_id=d.det_id
  WHERE s.det_id IS NULL AND NOT (d.source='new_detection' AND d.det_id%50<>0 AND coalesce(bbox_area_px>100e0 OR bbox_aspect_ratio>1.25e0, false))"""
TRUST = "SELECT clip_id, frame, max(weighted_conf) AS best FROM surv WHERE weighted_conf>=0.85e0 GROUP BY ALL"
LOSSES = """SELECT clip_id, isl, count(*) AS n FROM (SELECT f.clip_id, f.frame, best, count(best) OVER (PARTITION BY f.clip_id ORDER BY f.frame ROWS UNBOUNDED PRECEDING) AS isl
   FROM v_frames f LEFT JOIN trust t ON t.clip_id=f.clip_id AND t.frame=f.frame) WHERE best IS NULL GROUP BY ALL"""


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate, penalise, quarantine; then the loss windows of what is left, summed per clip."""
    bins, regions = D.hot_map(spark, sf_dir)
    from fieldlens.operators.hotspots import final_bin_penalty

    det = V.with_geometry(V.detections(spark, sf_dir))
    kept = C.gate(det).filter("status = 'kept'")
    pen = C.penalise(kept, final_bin_penalty(bins, regions, D.HOT), regions, D.HOT)
    still = C.static_quarantine(pen, regions, D.HOT.duty_cycle_threshold).filter("status = 'active'")
    alive = C.geometry_quarantine(still).filter("status = 'active'").select("clip_id", "frame", "det_id", "yaw", "pitch", "weighted_conf")
    from fieldlens.config import LossConfig

    windows = WN.loss_windows(V.dense_frames(det), alive, LossConfig(min_confidence=0.85))
    w = windows.groupBy("clip_id").agg(F.count(F.lit(1)).alias("loss_windows"), F.max("duration_frames").alias("longest_loss"))
    s = alive.groupBy("clip_id").agg(F.count(F.lit(1)).alias("survivors"), r4(F.avg("weighted_conf")).alias("mean_weighted_conf"))
    return s.join(w, "clip_id", "left").na.fill(0, ["loss_windows", "longest_loss"])


query(
    "surviving_candidates_and_losses", "FLT-1 FLT-2 FLT-3 FLT-4 WIN-1",
    Q.sql(["v_detections", "v_frames"], f"""SELECT s.clip_id, survivors, mean_weighted_conf, coalesce(loss_windows,0) AS loss_windows, coalesce(longest_loss,0) AS longest_loss
FROM (SELECT clip_id, count(*) AS survivors, {Q.r4('avg(weighted_conf)')} AS mean_weighted_conf FROM surv GROUP BY 1) s LEFT JOIN (SELECT clip_id, count(*) AS loss_windows, max(n) AS longest_loss FROM losses GROUP BY 1) l USING (clip_id)""",
          **dict(D.PEN_CTES, static=D.STATIC_SQL, surv=SURVIVE, trust=TRUST, losses=LOSSES)),
)(flagship)
