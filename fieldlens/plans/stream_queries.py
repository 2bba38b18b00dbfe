"""Streaming queries: each drains the driver tables as a stream and returns what it emitted."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.functions.geo import r4
from fieldlens.functions import geo
from fieldlens.plans import sqlkit as Q
from fieldlens.plans.ledger_queries import FAIL, PRG, SLW
from fieldlens.plans.registry import query
from fieldlens.plans.track_queries import rounded
from fieldlens.sources import views as V
from fieldlens.streaming import online as O


def with_rocksdb(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", O.ROCKSDB)


def stream_detections(spark, sf):
    e = O.clip_events(spark, sf)
    yaw = F.pmod(F.expr("cast(user_id * 47 + case when user_id % 3 = 0 then 2 * frame else 0 end as double)") + F.expr("(event_id % 5) * 0.2e0"), F.lit(360.0)) - F.lit(180.0)
    return e.select("clip_id", "frame", "at", F.col("event_id").alias("det_id"), F.col("user_id").alias("obj_id"), yaw.alias("yaw"),
                    F.expr("cast((user_id * 13) % 60 - 35 as double) + (event_id % 3) * 0.2e0").alias("pitch"), F.expr("(event_id % 97) / 100e0").alias("raw_conf"), "value", "event_type")


@query(
    "live_hotspot_windows", "STR-5",
    Q.sql(["v_detections"], f"""SELECT clip_id, CAST(1704067200 + ((frame*14400 + 1704067200 % 432000)//432000)*432000 - 1704067200 % 432000 AS BIGINT) AS window_start, CAST(floor(({Q.wrap('yaw')}+180e0)/2e0) AS INTEGER) AS yaw_bin, CAST(floor((pitch+90e0)/2e0) AS INTEGER) AS pitch_bin,
  CAST(count(DISTINCT frame) AS INTEGER) AS n_frames, count(*) AS n_detections, {Q.r4('avg(raw_conf)')} AS mean_conf FROM v_detections GROUP BY ALL"""),
)
def live_hotspot_windows(spark, sf):
    h = O.live_hotspots(stream_detections(spark, sf), "at", "5 days", "1 day")
    return rounded(O.drain(h, "update", "hotspots", ["clip_id", "window_start", "yaw_bin", "pitch_bin"]), "mean_conf")


@query(
    "live_sessions", "STR-7",
    Q.sql(["v_events"], """SELECT clip_id, CAST(floor(min(t)) AS BIGINT) AS started, count(*) AS n FROM (SELECT *, sum(nw) OVER (PARTITION BY clip_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM
 (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY clip_id ORDER BY t, event_id) < 7200e0 THEN 0 ELSE 1 END AS nw FROM v_events)) GROUP BY clip_id, sid HAVING max(t)+7200e0 <= (SELECT max(t) FROM v_events)"""),
)
def live_sessions(spark, sf):
    s = O.detection_sessions(O.clip_events(spark, sf), "at", "2 hours", "0 seconds")
    out = O.drain(s, "append", "sessions")
    return out.select("clip_id", (F.unix_timestamp("started") - F.lit(1704067200)).alias("started"), "n")


@query("live_arrivals", "STR-6", Q.sql([], "SELECT DISTINCT l_orderkey AS media_id FROM lineitem WHERE l_shipdate > TIMESTAMP '1998-01-01'"))
def live_arrivals(spark, sf):
    li = O.event_stream(spark, sf, "lineitem").select(F.col("l_orderkey").alias("media_id"), F.timestamp_micros((V.seconds_since_epoch("l_shipdate") * 1e6).cast("long") + F.lit(1704067200000000)).alias("at"))
    cutoff = F.timestamp_seconds(F.lit(883612800))  # 1998-01-01
    return O.drain(O.new_arrivals(li, "at", "media_id", "3650 days", cutoff).select("media_id"), "append", "arrivals")


SSCAN = "SELECT l_orderkey AS grp, l_linenumber*1200e0 + (l_partkey%3)*1e0 + (l_suppkey%7)*0.125e0 AS scan_at, max(CASE WHEN l_linenumber<=2 THEN l_linenumber ELSE 3+l_orderkey%2*(l_linenumber//5) END) AS n_files FROM lineitem GROUP BY 1, 2"


ABSENT_S = 2400.0  # two scans missed
VISITS = f"SELECT *, sum(CASE WHEN gap<={ABSENT_S}e0 THEN 0 ELSE 1 END) OVER (PARTITION BY grp ORDER BY scan_at ROWS UNBOUNDED PRECEDING) AS visit FROM (SELECT *, scan_at-lag(scan_at) OVER (PARTITION BY grp ORDER BY scan_at) AS gap FROM scans)"
STILL = """SELECT *, scan_at-last_value(ch IGNORE NULLS) OVER (PARTITION BY grp, visit ORDER BY scan_at ROWS UNBOUNDED PRECEDING) AS held FROM
  (SELECT *, CASE WHEN prev IS NULL OR prev<>n_files THEN scan_at END AS ch FROM (SELECT *, lag(n_files) OVER (PARTITION BY grp, visit ORDER BY scan_at) AS prev FROM visits))"""
ENDS = "SELECT grp, visit, min(scan_at) FILTER (ch IS NULL AND held>=3600) AS ready_at, max(scan_at) AS last FROM hd GROUP BY ALL"


@query(
    "live_completeness", "STR-2 STR-3",
    Q.sql([], f"""SELECT grp, scan_at, CASE WHEN prev IS NULL THEN 'new' WHEN scan_at>ready_at THEN 'done' WHEN ch IS NOT NULL THEN 'changed' WHEN scan_at=ready_at THEN 'ready' ELSE 'waiting' END AS state FROM hd JOIN ends USING (grp, visit)
UNION ALL SELECT grp, last+{ABSENT_S}e0, CASE WHEN ready_at IS NULL THEN 'vanished' ELSE 'closed' END FROM ends WHERE last+{ABSENT_S}e0 <= (SELECT max(scan_at) FROM scans)""",
          scans=SSCAN, visits=VISITS, hd=STILL, ends=ENDS),
)
def live_completeness(spark, sf):
    with_rocksdb(spark)
    n = F.expr("cast(case when l_linenumber <= 2 then l_linenumber else 3 + l_orderkey % 2 * (l_linenumber div 5) end as long)")
    s = O.event_stream(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("grp"), F.expr("l_linenumber * 1200e0 + (l_partkey % 3) * 1e0 + (l_suppkey % 7) * 0.125e0").alias("scan_at"), n.alias("n_files"))
    return O.drain(O.completeness_stream(s, absent_s=ABSENT_S), "append", "completeness").select("grp", "scan_at", "state")


@query(
    "live_failures", "STR-4",
    Q.sql(["v_attempts"], """SELECT media_id, coalesce(fail_count, 0) AS fail_count, CASE WHEN fail_count IS NULL THEN 0 WHEN fail_count>=3 THEN 24 WHEN reason='download failed' THEN 1 ELSE 6 END AS cooldown_h, attempts_seen
FROM (SELECT media_id, count(*) AS attempts_seen FROM v_attempts GROUP BY 1) LEFT JOIN fails USING (media_id)""", fails=FAIL),
)
def live_failures(spark, sf):
    with_rocksdb(spark)
    a = O.event_stream(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("media_id"), V.seconds_since_epoch("l_shipdate").alias("attempted_at"), F.col("l_linenumber").cast("long").alias("attempt"), F.col("l_partkey").alias("tie"),
        F.when(F.col("l_returnflag") == "R", "failed").otherwise("ok").alias("outcome"), F.when(F.col("l_linestatus") == "O", "download failed").otherwise("upload rejected").alias("reason"))
    return O.drain(O.failure_stream(a), "append", "failures", ["media_id"]).drop("out_of_order")


@query(
    "live_encoder_windows", "STR-4 WIN-14",
    Q.sql(["v_telemetry"], f"""SELECT clip_id, tick, {Q.r4('spd')} AS speed, slow, streak AS slow_streak, streak>=3 AS abort FROM
 (SELECT *, CASE WHEN slow THEN tick//6-coalesce(max(CASE WHEN NOT slow THEN tick//6 END) OVER (PARTITION BY clip_id ORDER BY tick ROWS UNBOUNDED PRECEDING), 1) ELSE 0 END AS streak FROM slw)""", prg=PRG, slw=SLW),
)
def live_encoder_windows(spark, sf):
    with_rocksdb(spark)
    e = O.event_stream(spark, sf, "events").select(
        F.concat(F.lit("clip"), F.expr(f"cast(user_id div {V.OBJECTS_PER_CLIP} as string)")).alias("clip_id"), F.col("event_id").alias("seq"),
        V.seconds_since_epoch("ts").alias("t"), (F.get_json_object("props", "$.k").cast("double") * 60.0).alias("work"))
    return O.drain(O.encoder_stream(e, 1.2), "append", "encoders").withColumn("speed", r4("speed"))


def tracker_rows(d):
    """Every detection may be the object; those of kind ``view`` are players as well."""
    object_ = d.select("clip_id", "frame", "det_id", "yaw", "pitch", F.col("raw_conf").alias("conf"), (F.col("value") * 0.5 + 1.0).alias("area"), F.expr("(det_id % 1280) * 1e0").alias("px"))
    none = F.lit(None)
    player = d.filter("event_type = 'view'").select("clip_id", "frame", none.cast("long").alias("det_id"), "yaw", "pitch", *[none.cast("double").alias(c) for c in ("conf", "area", "px")])
    return object_.unionByName(player)


@query("live_tracks", "STR-1")
def live_tracks(spark, sf):
    with_rocksdb(spark)
    out = O.drain(O.track_stream(tracker_rows(stream_detections(spark, sf))), "append", "tracks")
    return rounded(out, "yaw", "pitch", "best_score")


@query("stored_tracks", "STR-1")
def stored_tracks(spark, sf):
    e = V.table(spark, sf, "events").select(F.col("event_id").alias("det_id"), "value", "event_type")
    d = V.detections(spark, sf).join(e, "det_id")
    return rounded(O.track_batch(tracker_rows(d)), "yaw", "pitch", "best_score")


@query(
    "candidate_scores", "TRK-8",
    Q.sql(["v_detections"], f"""SELECT det_id, {Q.r4('CASE WHEN pl=0 THEN 0e0 ELSE least(1e0,raw_conf/0.5e0)*0.2e0+greatest(0e0,1e0-mh/10e0)*0.25e0+pl*0.15e0+sz*0.2e0+greatest(0e0,1e0-sqrt(pow(yaw-py-0.5e0,2)+pow(pitch-pp,2))/10e0)*0.1e0+least(1e0,least(px,1280e0-px)/80e0)*0.1e0 END')} AS score FROM
 (SELECT *, CASE WHEN m>8e0 AND {Q.gc('yaw', 'pitch', 'py', 'pp')}>5e0 THEN least(m,4e0) ELSE m END AS mh FROM (SELECT *, sqrt((pow(yaw-py,2)+pow(pitch-pp,2))/25e0) AS m FROM (SELECT *, yaw+(det_id%21-10)*1e0 AS py, pitch+(det_id%5-2)*1e0 AS pp, (det_id%1280)*1e0 AS px,
    CASE WHEN pitch>18e0 THEN 0e0 ELSE greatest(0e0,1e0-greatest(pitch-10e0,-30e0-pitch,0e0)/8e0) END AS pl, CASE WHEN bbox_area_px IS NULL THEN 0.5e0 ELSE greatest(0e0,1e0-abs(ln(greatest(bbox_area_px/30e0,1e-6)))/2e0) END AS sz FROM v_detections)))"""),
)
def candidate_scores(spark, sf):
    from fieldlens.operators.scoring import candidate_score

    d = V.detections(spark, sf).select("*", F.expr("yaw + (det_id % 21 - 10) * 1e0").alias("py"), F.expr("pitch + (det_id % 5 - 2) * 1e0").alias("pp"), F.expr("(det_id % 1280) * 1e0").alias("px"))
    d = d.withColumn("size", F.when(F.col("bbox_area_px").isNull(), geo.lit(0.5)).otherwise(geo.size_score("bbox_area_px", geo.lit(30.0))))
    return d.select("det_id", r4(candidate_score("raw_conf", "yaw", "pitch", "size", "px", "py", "pp", 25.0, 0.5, 0.0)).alias("score"))
