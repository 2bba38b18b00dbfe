"""Queries over player samples: clusters, motion, flow, zones, camera series."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.config import CameraConfig, CrowdConfig
from fieldlens.functions import geo
from fieldlens.functions.geo import r4
from fieldlens.operators import crowd as CR
from fieldlens.operators import linking as L
from fieldlens.operators import series as S
from fieldlens.operators import windows as WN
from fieldlens.operators.scan import Carry, carry_scan, frame_block, halo_windows, row_index
from fieldlens.plans import sqlkit as Q
from fieldlens.plans.registry import query
from fieldlens.plans.track_queries import rounded
from fieldlens.session import shuffled
from fieldlens.sources import views as V

# Fixture venue: the outline's yaw extent in a 3840 pixel wide frame.
VENUE_XS = [400.0, 1900.0, 3300.0]

PAIR = f"""SELECT a.clip_id, a.sample, a.det_id AS a, b.det_id AS b FROM v_players a JOIN v_players b ON a.clip_id=b.clip_id AND a.sample=b.sample
  WHERE {Q.gc('a.yaw', 'a.pitch', 'b.yaw', 'b.pitch')} <= 25e0 + {Q.TOL}"""
REACH = """SELECT clip_id, sample, det_id AS src, det_id AS dst FROM v_players
  UNION SELECT r.clip_id, r.sample, r.src, p.b FROM reach r JOIN pair p ON r.clip_id=p.clip_id AND r.sample=p.sample AND r.dst=p.a"""
COMP = "SELECT clip_id, sample, dst AS det_id, min(src) AS comp FROM reach GROUP BY ALL"
CLUS = "SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY clip_id, sample, comp) AS size FROM comp) WHERE size>=2"
TOP = f"""SELECT p.*, c.comp FROM v_players p JOIN clus c ON c.clip_id=p.clip_id AND c.sample=p.sample AND c.det_id=p.det_id JOIN
  (SELECT clip_id, sample, arg_max(comp, {{'a': n, 'b': floor(mc*1e9+0.500001e0)/1e9, 'c': -comp}}) AS comp FROM
     (SELECT p.clip_id, p.sample, comp, count(*) AS n, avg(conf) AS mc FROM v_players p JOIN clus c USING (clip_id, sample, det_id) GROUP BY ALL) GROUP BY ALL) t
  ON t.clip_id=p.clip_id AND t.sample=p.sample AND t.comp=c.comp"""
CW = dict(pair=PAIR, reach=REACH, comp=COMP, clus=CLUS, top=TOP)
CENTRE = """SELECT c.*, dispersion_deg FROM (SELECT clip_id, sample, degrees(atan2(sum(sin(radians(yaw))), sum(cos(radians(yaw))))) AS cy, avg(pitch) AS cp, count(*) AS size, avg(vel) AS mean_vel FROM top GROUP BY ALL) c
  JOIN (SELECT t.clip_id, t.sample, avg(%s) AS dispersion_deg FROM top t JOIN
     (SELECT clip_id, sample, degrees(atan2(sum(sin(radians(yaw))), sum(cos(radians(yaw))))) AS cy, avg(pitch) AS cp FROM top GROUP BY ALL) k USING (clip_id, sample) GROUP BY ALL) d USING (clip_id, sample)""" % Q.gc("t.yaw", "t.pitch", "k.cy", "k.cp")


def crowd(spark, sf):
    p = V.players(spark, sf)
    members = CR.top_cluster(p, CR.crowd_clusters(p))
    return p, members


@query("crowd_clusters", "CLU-2", Q.sql(["v_players"], "SELECT clip_id, sample, det_id, comp, size FROM clus", **{k: CW[k] for k in ("pair", "reach", "comp", "clus")}))
def crowd_clusters(spark, sf):
    return CR.crowd_clusters(V.players(spark, sf)).select("clip_id", "sample", "det_id", "comp", "size")


@query(
    "crowd_centroids", "AGG-3 CRD-7",
    Q.sql(["v_players"], f"""SELECT clip_id, sample, {Q.r4('cy')} AS centroid_yaw, {Q.r4('cp')} AS centroid_pitch, size AS cluster_size, {Q.r4('dispersion_deg')} AS dispersion_deg,
  {Q.r4('greatest(0e0,least(1e0,size/CAST(total AS DOUBLE)*exp(-dispersion_deg/40e0)))')} AS concentration
FROM centre JOIN (SELECT clip_id, sample, count(*) AS total FROM v_players GROUP BY ALL) t USING (clip_id, sample)""", **CW, centre=CENTRE),
)
def crowd_centroids(spark, sf):
    p, members = crowd(spark, sf)
    c = CR.centroid_and_dispersion(members).join(shuffled(p.groupBy("clip_id", "sample").agg(F.count(F.lit(1)).alias("total"))), ["clip_id", "sample"])
    c = c.withColumn("concentration", CR.concentration("cluster_size", "total", "dispersion_deg"))
    return rounded(c.drop("mean_vel", "total"), "centroid_yaw", "centroid_pitch", "dispersion_deg", "concentration")


@query(
    "activity_centroid", "CRD-2",
    Q.sql(["v_players"], f"""SELECT clip_id, sample, {Q.r4('mv')} AS mean_vel, {Q.r4('CASE WHEN mv<15e0 THEN py ELSE wy END')} AS activity_yaw, {Q.r4('CASE WHEN mv<15e0 THEN pp ELSE wp END')} AS activity_pitch
FROM (SELECT clip_id, sample, avg(vel) AS mv, degrees(atan2(sum(sin(radians(yaw))),sum(cos(radians(yaw))))) AS py, avg(pitch) AS pp,
  degrees(atan2(sum((1e0+vel)*sin(radians(yaw))),sum((1e0+vel)*cos(radians(yaw))))) AS wy, sum((1e0+vel)*pitch)/sum(1e0+vel) AS wp FROM v_players GROUP BY ALL)"""),
)
def activity_centroid(spark, sf):
    a = CR.activity_centroid(V.players(spark, sf), CrowdConfig(low_motion_deg_s=15.0))
    return rounded(a, "mean_vel", "activity_yaw", "activity_pitch")


LIFE = """SELECT *, ts - last_value(born IGNORE NULLS) OVER (PARTITION BY clip_id, track_id ORDER BY sample ROWS UNBOUNDED PRECEDING) AS age FROM
  (SELECT *, CASE WHEN sample - coalesce(lag(sample) OVER (PARTITION BY clip_id, track_id ORDER BY sample), -99) > 3 THEN ts END AS born FROM v_players)"""


@query(
    "stable_group", "CRD-1",
    Q.sql(["v_players"], f"""SELECT clip_id, sample, {Q.r4('gy')} AS stable_yaw, {Q.r4('gp')} AS stable_pitch, coalesce(n,0) AS stable_tracks,
  {Q.r4(Q.wrap(f"my + coalesce({Q.clamp(Q.delta('gy', 'my') + '*0.2e0', '-5e0', '5e0')}, 0e0)"))} AS proposed_yaw
FROM (SELECT clip_id, sample, degrees(atan2(sum(sin(radians(yaw))),sum(cos(radians(yaw))))) AS my FROM v_players GROUP BY ALL) b LEFT JOIN
 (SELECT * FROM (SELECT clip_id, sample, degrees(atan2(sum(sin(radians(yaw))),sum(cos(radians(yaw))))) AS gy, avg(pitch) AS gp, count(*) AS n FROM life WHERE age>=2e0 GROUP BY ALL) WHERE n>=2) g USING (clip_id, sample)""", life=LIFE),
)
def stable_group(spark, sf):
    p = V.players(spark, sf)
    return rounded(CR.stable_group(p, p), "stable_yaw", "stable_pitch", "proposed_yaw")


@query(
    "yaw_gap_clusters", "CLU-3",
    Q.sql(["v_players"], """SELECT clip_id, sample, det_id, CAST(sum(nw) OVER (PARTITION BY clip_id, sample ORDER BY yaw, track_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS group_no
FROM (SELECT *, CASE WHEN yaw - lag(yaw) OVER (PARTITION BY clip_id, sample ORDER BY yaw, track_id) > 25e0 THEN 1 ELSE 0 END AS nw FROM v_players)"""),
)
def yaw_gap_clusters(spark, sf):
    return CR.yaw_gap_clusters(V.players(spark, sf), 25.0).select("clip_id", "sample", "det_id", "group_no")


PREV = """SELECT *, CASE WHEN ls=sample-1 THEN ly END AS prev_yaw, CASE WHEN ls=sample-1 THEN lp END AS prev_pitch FROM
  (SELECT *, lag(sample) OVER w AS ls, lag(yaw) OVER w AS ly, lag(pitch) OVER w AS lp FROM v_players WINDOW w AS (PARTITION BY clip_id, track_id ORDER BY sample))"""


@query("consecutive_steps", "JOIN-9", Q.sql(["v_players"], f"SELECT det_id, {Q.r4('prev_yaw')} AS prev_yaw, {Q.r4(Q.delta('yaw', 'prev_yaw'))} AS dyaw FROM prev", prev=PREV))
def consecutive_steps(spark, sf):
    p = CR.previous_sample_step(V.players(spark, sf))
    return p.select("det_id", r4("prev_yaw").alias("prev_yaw"), r4(geo.circular_delta("yaw", "prev_yaw")).alias("dyaw"))


@query(
    "flow_direction", "CRD-5 WIN-6",
    Q.sql(["v_players"], f"""SELECT clip_id, sample, direction, CASE WHEN direction<0 THEN l WHEN direction>0 THEN r ELSE 0 END AS agreeing_tracks, l+r AS moving_tracks,
  {Q.r4('CASE WHEN direction<0 THEN ml WHEN direction>0 THEN mr ELSE 0e0 END')} AS mean_delta_yaw,
  CAST(run>=3 AS INTEGER) AS sustained, run AS sustained_run_len
FROM (SELECT *, CASE WHEN direction=0 THEN 0 ELSE row_number() OVER (PARTITION BY clip_id, isl ORDER BY sample) END AS run FROM
 (SELECT *, sum(chg) OVER (PARTITION BY clip_id ORDER BY sample ROWS UNBOUNDED PRECEDING) AS isl FROM
  (SELECT *, CASE WHEN direction=lag(direction) OVER (PARTITION BY clip_id ORDER BY sample) THEN 0 ELSE 1 END AS chg FROM
   (SELECT *, CASE WHEN l>=2 AND l>r THEN -1 WHEN r>=2 AND r>l THEN 1 ELSE 0 END AS direction FROM
    (SELECT s.clip_id, s.sample, count(*) FILTER (dy<0) AS l, count(*) FILTER (dy>0) AS r, avg(dy) FILTER (dy<0) AS ml, avg(dy) FILTER (dy>0) AS mr
     FROM (SELECT DISTINCT clip_id, sample FROM v_players) s LEFT JOIN (SELECT *, {Q.delta('yaw', 'prev_yaw')} AS dy FROM prev WHERE prev_yaw IS NOT NULL AND abs(vel)>=2e0) m
     ON m.clip_id=s.clip_id AND m.sample=s.sample GROUP BY ALL)))))""", prev=PREV),
)
def flow_direction(spark, sf):
    p = V.players(spark, sf)
    f = CR.flow_direction(p, p.select("clip_id", "sample").distinct(), CrowdConfig(min_agreeing_tracks=2))
    return rounded(f, "mean_delta_yaw")


@query(
    "convergence_scores", "CRD-3",
    Q.sql(["v_players"], f"""SELECT clip_id, sample, {Q.r4('ms')} AS motion_score, {Q.r4('conv')} AS convergence_score, {Q.r4('least(1e0,n/CAST(n AS DOUBLE))*0.4e0+mc*0.4e0+(ms*0.6e0+conv*0.4e0)*0.2e0')} AS frame_confidence FROM
 (SELECT clip_id, sample, least(1e0, avg(mag)/3e0) AS ms, count(*) AS n, avg(conf) AS mc,
   CASE WHEN count(*) FILTER (mag>=0.3e0)>0 THEN count(*) FILTER (mag>=0.3e0 AND cn>=1e-6 AND (vy*cx+vp*cyy)/(mag*cn)>=0.3e0)/CAST(count(*) FILTER (mag>=0.3e0) AS DOUBLE) ELSE 0e0 END AS conv FROM
  (SELECT *, sqrt(vy*vy+vp*vp) AS mag, sqrt(cx*cx+cyy*cyy) AS cn FROM
   (SELECT p.*, (det_id%7-3)*0.5e0 AS vy, (det_id%5-2)*0.4e0 AS vp, cos(radians(k.cp))*sin(radians(k.cy-p.yaw)) AS cx, sin(radians(k.cp-p.pitch)) AS cyy FROM v_players p JOIN
    (SELECT clip_id, sample, degrees(atan2(sum(sin(radians(yaw))),sum(cos(radians(yaw))))) AS cy, avg(pitch) AS cp FROM v_players GROUP BY ALL) k USING (clip_id, sample))) GROUP BY ALL)"""),
)
def convergence_scores(spark, sf):
    p = V.players(spark, sf).select("*", F.expr("(det_id % 7 - 3) * 0.5e0").alias("vel_yaw"), F.expr("(det_id % 5 - 2) * 0.4e0").alias("vel_pitch"))
    c = p.groupBy("clip_id", "sample").agg(geo.circular_mean("yaw").alias("centroid_yaw"), F.avg("pitch").alias("centroid_pitch"))
    t = p.groupBy("clip_id", "sample").agg(F.count(F.lit(1)).alias("total"))
    return rounded(CR.convergence_scores(p, c, t), "motion_score", "convergence_score", "frame_confidence")


@query(
    "rolling_track_speed", "WIN-7 WIN-8",
    Q.sql(["v_players"], f"""SELECT det_id, {Q.r4('avg(vel) OVER (w ROWS BETWEEN 39 PRECEDING AND CURRENT ROW)')} AS roll_speed, {Q.r4('avg(box_h) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)')} AS roll_box,
  {Q.r4('avg(vel) OVER (w ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)')} AS vel_mean8 FROM v_players WINDOW w AS (PARTITION BY clip_id, track_id ORDER BY sample)"""),
)
def rolling_track_speed(spark, sf):
    p = row_index(V.players(spark, sf), ["clip_id", "track_id"], ["sample"], frame_block("sample"))
    p = halo_windows(p, ["clip_id", "track_id"], "rn", 39, 0, lambda w: {
        "roll_speed": F.avg("vel").over(w.rowsBetween(-39, 0)), "roll_box": F.avg("box_h").over(w.rowsBetween(-29, 0)), "vel_mean8": F.avg("vel").over(w.rowsBetween(-7, 0))})
    return rounded(p.select("det_id", "roll_speed", "roll_box", "vel_mean8"), "roll_speed", "roll_box", "vel_mean8")


@query(
    "circular_statistics", "AGG-3",
    Q.sql(["v_players"], f"""SELECT clip_id, track_id, {Q.r4('degrees(atan2(sum(sin(radians(yaw))),sum(cos(radians(yaw)))))')} AS mean_yaw,
  {Q.r4('CASE WHEN sum(conf)>0 THEN degrees(atan2(sum(conf*sin(radians(yaw))),sum(conf*cos(radians(yaw))))) END')} AS weighted_yaw,
  {Q.r4('sqrt(pow(avg(cos(radians(yaw))),2)+pow(avg(sin(radians(yaw))),2))')} AS resultant FROM v_players GROUP BY ALL"""),
)
def circular_statistics(spark, sf):
    return V.players(spark, sf).groupBy("clip_id", "track_id").agg(
        r4(geo.circular_mean("yaw")).alias("mean_yaw"), r4(geo.circular_mean("yaw", "conf")).alias("weighted_yaw"), r4(geo.resultant(F.radians("yaw"))).alias("resultant"))


@query(
    "rates_of_change", "WIN-9",
    Q.sql(["v_players"], f"""SELECT clip_id, sample, {Q.r4('share')} AS right_share, {Q.r4('CASE WHEN lag(ts) OVER w IS NOT NULL THEN least(abs(share-lag(share) OVER w)/greatest(ts-lag(ts) OVER w,1e-3),1e0) END')} AS switch_of_play,
  {Q.r4('(my-lag(my) OVER w)/greatest(ts-lag(ts) OVER w,1e-3)')} AS mean_yaw_rate, CASE WHEN lag(ts) OVER w IS NOT NULL THEN CAST(len(list_intersect(ids, lag(ids) OVER w)) AS INTEGER) END AS shared_tracks
FROM (SELECT clip_id, sample, max(ts) AS ts, avg(yaw) AS my, sum(CASE WHEN yaw>=0 THEN conf*vel ELSE 0e0 END)/CASE WHEN sum(conf*vel)=0 THEN 1e-6 ELSE sum(conf*vel) END AS share, list(track_id) AS ids FROM v_players GROUP BY ALL)
WINDOW w AS (PARTITION BY clip_id ORDER BY sample)"""),
)
def rates_of_change(spark, sf):
    g = V.players(spark, sf).withColumn("e", F.col("conf") * F.col("vel")).groupBy("clip_id", "sample").agg(
        F.max("ts").alias("ts"), F.avg("yaw").alias("my"), (F.sum(F.when(F.col("yaw") >= 0, F.col("e")).otherwise(0.0)) / F.when(F.sum("e") == 0, 1e-6).otherwise(F.sum("e"))).alias("share"),
        F.collect_set("track_id").alias("ids"))
    s = carry_scan(g, ["clip_id"], ["sample"], frame_block("sample"), {"p": Carry("last", F.struct("ts", "my", "share", "ids"), exclusive=True)})
    dt = F.greatest(F.col("ts") - F.col("p.ts"), geo.lit(1e-3))
    s = s.select("clip_id", "sample", F.col("share").alias("right_share"), F.when(F.col("p").isNotNull(), F.least(F.abs(F.col("share") - F.col("p.share")) / dt, geo.lit(1.0))).alias("switch_of_play"),
                 ((F.col("my") - F.col("p.my")) / dt).alias("mean_yaw_rate"), F.when(F.col("p").isNotNull(), F.size(F.array_intersect("ids", "p.ids"))).alias("shared_tracks"))
    return rounded(s, "right_share", "switch_of_play", "mean_yaw_rate")


# greedy pick in SQL: walk a sample's pairs by distance, keep a pair when both ends are free
MP = f"""SELECT *, row_number() OVER (PARTITION BY clip_id, sample ORDER BY kd, det_id, pid) AS rn FROM (SELECT a.clip_id, a.sample, a.det_id, b.det_id AS pid, {Q.gc('a.yaw', 'a.pitch', 'b.yaw', 'b.pitch')} AS d,
   floor({Q.gc('a.yaw', 'a.pitch', 'b.yaw', 'b.pitch')}*1e4+0.500001e0)/1e4 AS kd FROM v_players a JOIN v_players b ON a.clip_id=b.clip_id AND b.sample=a.sample-1) WHERE d <= 15e0 + {Q.TOL}"""
MG = """SELECT clip_id, sample, rn, [det_id] AS c, [pid] AS p, det_id, d, true AS won FROM mp WHERE rn=1 UNION ALL
  SELECT m.clip_id, m.sample, m.rn, CASE WHEN ok THEN list_append(c, m.det_id) ELSE c END, CASE WHEN ok THEN list_append(p, m.pid) ELSE p END, m.det_id, m.d, ok FROM
   (SELECT m.*, g.c, g.p, NOT list_contains(g.c, m.det_id) AND NOT list_contains(g.p, m.pid) AS ok FROM mg g JOIN mp m ON m.clip_id=g.clip_id AND m.sample=g.sample AND m.rn=g.rn+1) m"""


@query("matched_velocity", "TRK-4", Q.sql(["v_players"], f"SELECT v.clip_id, v.sample, v.det_id, {Q.r4('coalesce(g.d/0.5e0, 0e0)')} AS match_vel FROM v_players v LEFT JOIN (SELECT * FROM mg WHERE won) g ON g.det_id=v.det_id", mp=MP, mg=MG))
def matched_velocity(spark, sf):
    v = CR.nearest_match_velocity(V.players(spark, sf), 0.5)
    return v.select("clip_id", "sample", "det_id", r4("match_vel").alias("match_vel"))


@query("player_tracks", "TRK-3")
def player_tracks(spark, sf):
    p = V.players(spark, sf).withColumnRenamed("sample", "frame")
    t = L.track_players(p, p.select("clip_id", "frame").distinct())
    return t.select("clip_id", "frame", "det_id", "track_no")


def crowd_series(spark, sf):
    """One row per sample: plain centroid of all players, spread, concentration score. Modes compare the score with
    limits that exact means hit, so confidences are summed as decimals: a sum of doubles hangs on their order."""
    p = V.players(spark, sf)
    mean = F.sum(F.col("conf").cast("decimal(20,9)")).cast("double") / F.count("conf")
    c = p.groupBy("clip_id", "sample").agg(F.max("ts").alias("ts"), geo.circular_mean("yaw").alias("centroid_yaw"), mean.alias("mc"), F.count(F.lit(1)).alias("total"),
                                           (geo.lit(1.0) - geo.resultant(F.radians("yaw"))).alias("spread"))
    return c.withColumn("score", geo.clamp(F.col("mc") * 0.9)).withColumn("dispersion_deg", F.col("spread") * 60.0)


CS = """SELECT clip_id, sample, max(ts) AS ts, degrees(atan2(sum(sin(radians(yaw))),sum(cos(radians(yaw))))) AS cy, avg(conf)*0.9e0 AS score,
   row_number() OVER (PARTITION BY clip_id ORDER BY sample) AS rn FROM v_players GROUP BY clip_id, sample"""


@query("action_zone", "CRD-4")
def action_zone(spark, sf):
    z = CR.action_zone(V.players(spark, sf), crowd_series(spark, sf).withColumn("mode", F.when(F.expr("sample % 20 = 0"), "wide").otherwise("follow")))
    cols = ["centroid_yaw", "zone_raw", "zone_yaw", "target_yaw", "bias_deg", "confidence", "intensity", "breakaway", "switch_of_play", "lead_deg", "recommended_fov"]
    return rounded(z.drop("ts"), *cols)


@query(
    "subgroup_candidates", "CRD-4 CLU-3",
    Q.sql(["v_players"], f"""SELECT g.clip_id, g.sample, g.group_no, n, g.group_no=m.mg AS is_main, {Q.r4('least(speed/30e0,1e0)')} AS sub_speed_norm, {Q.r4('least(m.ms/30e0,1e0)')} AS main_speed_norm,
  {Q.r4('abs(my-m.mmy)')} AS separation, {Q.r4('coalesce(CASE WHEN h>0 THEN res END,0e0)')} AS coherence
FROM gr g JOIN (SELECT clip_id, sample, arg_max(group_no, {{'a': n, 'b': -group_no}}) AS mg, arg_max(speed, {{'a': n, 'b': -group_no}}) AS ms, arg_max(my, {{'a': n, 'b': -group_no}}) AS mmy FROM gr GROUP BY ALL) m USING (clip_id, sample)""",
          prev=PREV,
          gp="""SELECT *, CAST(sum(nw) OVER (PARTITION BY clip_id, sample ORDER BY yaw, track_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS group_no, CASE WHEN prev_yaw IS NOT NULL THEN atan2((pitch-prev_pitch)/0.5e0,(yaw-prev_yaw)/0.5e0) END AS hd
            FROM (SELECT *, CASE WHEN yaw - lag(yaw) OVER (PARTITION BY clip_id, sample ORDER BY yaw, track_id) > 25e0 THEN 1 ELSE 0 END AS nw FROM prev)""",
          gr="SELECT clip_id, sample, group_no, count(*) AS n, avg(vel) AS speed, avg(yaw) AS my, count(hd) AS h, sqrt(pow(avg(cos(hd)),2)+pow(avg(sin(hd)),2)) AS res FROM gp GROUP BY ALL"),
)
def subgroup_candidates(spark, sf):
    c = CR.subgroup_candidates(CR.zone_players(V.players(spark, sf)))
    cols = ["sub_speed_norm", "main_speed_norm", "separation", "coherence"]
    return rounded(c.select("clip_id", "sample", "group_no", "n", "is_main", *cols), *cols)


# ---------------------------------------------------------------- camera series
@query(
    "zone_smoothing", "WIN-10",
    Q.sql(["v_players"], f"SELECT clip_id, sample, {Q.r4('y')} AS smoothed FROM ema",
          cs=CS, ema="SELECT clip_id, sample, rn, cy AS y FROM cs WHERE rn=1 UNION ALL SELECT c.clip_id, c.sample, c.rn, e.y+0.35e0*(c.cy-e.y) FROM ema e JOIN cs c ON c.clip_id=e.clip_id AND c.rn=e.rn+1"),
)
def zone_smoothing(spark, sf):
    return S.ema_series(crowd_series(spark, sf), ["clip_id"], "sample", "centroid_yaw", "smoothed", 0.35).select("clip_id", "sample", r4("smoothed").alias("smoothed"))


@query(
    "deadband_hold", "SEQ-1",
    Q.sql(["v_players"], f"SELECT clip_id, sample, {Q.r4('h')} AS held FROM db",
          cs=CS, db=f"""SELECT clip_id, sample, rn, cy AS h FROM cs WHERE rn=1 UNION ALL
  SELECT c.clip_id, c.sample, c.rn, CASE WHEN abs({Q.delta('c.cy', 'd.h')})>=20e0 THEN {Q.wrap('d.h+' + Q.delta('c.cy', 'd.h'))} ELSE d.h END FROM db d JOIN cs c ON c.clip_id=d.clip_id AND c.rn=d.rn+1"""),
)
def deadband_hold(spark, sf):
    s = S.seq_scan(crowd_series(spark, sf), ["clip_id"], "sample", ["centroid_yaw"], S.deadband_step("centroid_yaw", 20.0), "held")
    return s.select("clip_id", "sample", r4("held").alias("held"))


@query(
    "rate_limited_pan", "SEQ-1",
    Q.sql(["v_players"], f"SELECT clip_id, sample, {Q.r4('p')} AS pan FROM rl",
          cs=CS, rl=f"""SELECT clip_id, sample, rn, ts, cy AS p FROM cs WHERE rn=1 UNION ALL
  SELECT c.clip_id, c.sample, c.rn, c.ts, {Q.wrap('d.p+greatest(-25e0*(c.ts-d.ts),least(25e0*(c.ts-d.ts),' + Q.delta('c.cy', 'd.p') + '))')} FROM rl d JOIN cs c ON c.clip_id=d.clip_id AND c.rn=d.rn+1"""),
)
def rate_limited_pan(spark, sf):
    s = S.seq_scan(crowd_series(spark, sf), ["clip_id"], "sample", ["ts", "centroid_yaw"], S.rate_limit_step("centroid_yaw", "ts", 25.0), "pan")
    return s.select("clip_id", "sample", r4("pan").alias("pan"))


RQ = """SELECT clip_id, sample, rn, cy AS ema, cy AS ref, score>=0.4e0 AS conf_on FROM cs WHERE rn=1 UNION ALL
  SELECT clip_id, sample, rn, CASE WHEN jump THEN cy ELSE a*u+(1e0-a)*ema END, CASE WHEN jump THEN cy ELSE u END, conf_on FROM
   (SELECT c.clip_id, c.sample, c.rn, c.cy, e.ema, c.score>=0.4e0 AS conf_on, c.score>=0.4e0 AND NOT e.conf_on AS jump, CASE WHEN c.score>=0.4e0 THEN 0.18e0 ELSE 0.08e0 END AS a,
      CASE WHEN c.cy-e.ref>180e0 THEN c.cy-360e0 WHEN c.cy-e.ref<-180e0 THEN c.cy+360e0 ELSE c.cy END AS u FROM rq e JOIN cs c ON c.clip_id=e.clip_id AND c.rn=e.rn+1)"""


@query("reacquired_smoothing", "SEQ-1", Q.sql(["v_players"], f"SELECT clip_id, sample, {Q.r4('ema')} AS ema FROM rq", cs=CS, rq=RQ))
def reacquired_smoothing(spark, sf):
    s = crowd_series(spark, sf).withColumn("best", F.when(F.col("score") >= 0.4, F.col("score")))
    s = S.seq_scan(s, ["clip_id"], "sample", ["centroid_yaw", "best"], S.reacquire_ema_step("centroid_yaw", "best"), "ema")
    return s.select("clip_id", "sample", r4("ema").alias("ema"))


CAM = CameraConfig(strong_thresh=0.47, weak_thresh=0.43, hysteresis_s=1.0)


@query(
    "mode_timeline", "SEQ-2",
    Q.sql(["v_players"], "SELECT clip_id, sample, mode FROM md",
          cs=CS, md="""SELECT clip_id, sample, rn, ts, 0e0 AS st, 0e0 AS wk, 'wide' AS mode FROM cs WHERE rn=1 UNION ALL
  SELECT clip_id, sample, rn, ts, st, wk, CASE WHEN mode='wide' AND st>=1e0-1e-9 THEN 'follow' WHEN mode='follow' AND wk>=1e0-1e-9 THEN 'wide' ELSE mode END FROM
   (SELECT c.clip_id, c.sample, c.rn, c.ts, CASE WHEN c.score>=0.47e0 THEN m.st+c.ts-m.ts ELSE 0e0 END AS st, CASE WHEN c.score<=0.43e0 THEN m.wk+c.ts-m.ts ELSE 0e0 END AS wk, m.mode FROM md m JOIN cs c ON c.clip_id=m.clip_id AND c.rn=m.rn+1)"""),
)
def mode_timeline(spark, sf):
    return S.mode_timeline(crowd_series(spark, sf), ["clip_id"], "sample", "ts", "score", CAM).select("clip_id", "sample", "mode")


MD = """SELECT clip_id, sample, rn, ts, cy, 0e0 AS st, 0e0 AS wk, 'wide' AS mode FROM cs WHERE rn=1 UNION ALL
  SELECT clip_id, sample, rn, ts, cy, st, wk, CASE WHEN mode='wide' AND st>=1e0-1e-9 THEN 'follow' WHEN mode='follow' AND wk>=1e0-1e-9 THEN 'wide' ELSE mode END FROM
   (SELECT c.clip_id, c.sample, c.rn, c.ts, c.cy, CASE WHEN c.score>=0.47e0 THEN m.st+c.ts-m.ts ELSE 0e0 END AS st, CASE WHEN c.score<=0.43e0 THEN m.wk+c.ts-m.ts ELSE 0e0 END AS wk, m.mode FROM md m JOIN cs c ON c.clip_id=m.clip_id AND c.rn=m.rn+1)"""
MY = "SELECT *, CASE WHEN sample%9<>0 THEN cy END AS k FROM md"
PU = """SELECT clip_id, rn, sample, ts, mode, CASE WHEN mode='follow' AND k IS NOT NULL THEN k ELSE 0e0 END AS p, mode='follow' AND k IS NOT NULL AS fol FROM my WHERE rn=1 UNION ALL
  SELECT m.clip_id, m.rn, m.sample, m.ts, m.mode, CASE WHEN m.mode='follow' AND m.k IS NOT NULL THEN m.k ELSE u.p+greatest(-10e0*(m.ts-u.ts),least(10e0*(m.ts-u.ts),greatest(-45e0,least(45e0,coalesce(m.k,0e0)))-u.p)) END, m.mode='follow' AND m.k IS NOT NULL
  FROM pu u JOIN my m ON m.clip_id=u.clip_id AND m.rn=u.rn+1"""


@query("camera_timeline", "SEQ-2 SEQ-1", Q.sql(["v_players"], f"SELECT clip_id, sample, mode, {Q.r4('p')} AS target_yaw, CASE WHEN fol THEN 85e0 ELSE 100e0 END AS target_fov FROM pu", cs=CS, md=MD, my=MY, pu=PU))
def camera_timeline(spark, sf):
    m = S.mode_timeline(crowd_series(spark, sf), ["clip_id"], "sample", "ts", "score", CAM).withColumn("cluster_yaw", F.when(F.expr("sample % 9 <> 0"), F.col("centroid_yaw")))
    t = S.wide_pursuit(m, ["clip_id"], "sample", "ts", CAM)
    return t.select("clip_id", "sample", "mode", r4("target_yaw").alias("target_yaw"), "target_fov")


# shown mode, next mode, held frames, zoom steps (quarters out, thirds in), reacquire streak
RM = """SELECT clip_id, rn, sample, 'FOLLOW' AS shown, CASE WHEN NOT cn AND 1>=3 THEN 'ZOOMING_OUT' ELSE 'FOLLOW' END AS mode, CASE WHEN cn THEN 0 ELSE 1 END AS held, 0e0 AS z, 0 AS sk FROM cf WHERE rn=1 UNION ALL
  SELECT clip_id, rn, sample, CASE WHEN mode='ZOOMING_IN' AND cn AND greatest(0e0,z-1e0/3e0)<=0e0 THEN 'FOLLOW' WHEN mode='ZOOMING_IN' AND NOT cn THEN 'ZOOMING_OUT' ELSE mode END,
    CASE mode WHEN 'FOLLOW' THEN CASE WHEN NOT cn AND held+1>=3 THEN 'ZOOMING_OUT' ELSE 'FOLLOW' END WHEN 'ZOOMING_OUT' THEN CASE WHEN least(1e0,z+0.25e0)>=1e0 THEN 'WIDE_HOLD' ELSE 'ZOOMING_OUT' END
      WHEN 'WIDE_HOLD' THEN CASE WHEN cn AND sk+1>=2 THEN 'ZOOMING_IN' ELSE 'WIDE_HOLD' END ELSE CASE WHEN NOT cn THEN 'ZOOMING_OUT' WHEN greatest(0e0,z-1e0/3e0)<=0e0 THEN 'FOLLOW' ELSE 'ZOOMING_IN' END END,
    CASE WHEN mode='FOLLOW' THEN CASE WHEN cn THEN 0 ELSE held+1 END WHEN mode='ZOOMING_IN' AND cn AND greatest(0e0,z-1e0/3e0)<=0e0 THEN 0 ELSE held END,
    CASE WHEN mode='FOLLOW' THEN CASE WHEN cn OR held+1>=3 THEN 0e0 ELSE z END WHEN mode='ZOOMING_OUT' THEN least(1e0,z+0.25e0) WHEN mode='ZOOMING_IN' AND cn THEN greatest(0e0,z-1e0/3e0) ELSE z END,
    CASE WHEN mode='FOLLOW' THEN CASE WHEN cn OR held+1>=3 THEN 0 ELSE sk END WHEN mode='ZOOMING_IN' THEN CASE WHEN NOT cn OR greatest(0e0,z-1e0/3e0)<=0e0 THEN 0 ELSE sk+1 END ELSE CASE WHEN cn THEN sk+1 ELSE 0 END END
  FROM (SELECT r.clip_id, c.rn, c.sample, c.cn, r.mode, r.held, r.z, r.sk FROM rm r JOIN cf c ON c.clip_id=r.clip_id AND c.rn=r.rn+1)"""


@query("render_modes", "SEQ-2", Q.sql(["v_players"], "SELECT clip_id, sample, shown AS render_mode FROM rm", cs=CS, cf="SELECT *, score>=0.42e0 AS cn FROM cs", rm=RM))
def render_modes(spark, sf):
    s = crowd_series(spark, sf).withColumn("confirmed", F.col("score") >= 0.42)
    s = S.seq_scan(s, ["clip_id"], "sample", ["confirmed"], S.render_mode_step("confirmed", 3, 4, 2, 3), "render_mode", out_type="string")
    return s.select("clip_id", "sample", "render_mode")


def thin_series(spark, sf):
    return crowd_series(spark, sf).withColumn("mode", F.when(F.expr("sample % 3 = 0"), "wide").otherwise("follow"))


THIN = "SELECT *, CASE WHEN sample%3=0 THEN 'wide' ELSE 'follow' END AS mode FROM (SELECT clip_id, sample, ts, cy, score FROM cs)"
UNW = f"SELECT *, sum(d) OVER (PARTITION BY clip_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS u FROM (SELECT *, coalesce({Q.delta('cy', 'ly')}, cy) AS d FROM (SELECT *, lag(cy) OVER (PARTITION BY clip_id ORDER BY ts) AS ly FROM thin))"
DENSE = """SELECT g.clip_id, g.k, g.k/5e0 AS gt, (SELECT max({'t': u.ts, 'u': u.u, 's': u.score, 'm': u.mode}) FROM unw u WHERE u.clip_id=g.clip_id AND u.ts<=g.k/5e0) AS a,
   (SELECT min({'t': u.ts, 'u': u.u, 's': u.score, 'm': u.mode}) FROM unw u WHERE u.clip_id=g.clip_id AND u.ts>=g.k/5e0) AS b
  FROM (SELECT clip_id, unnest(range(0, CAST(ceil(max(ts)*5e0) AS BIGINT)+1)) AS k FROM cs GROUP BY clip_id) g"""


def _lin(c):
    return f"CASE WHEN a IS NULL THEN b.{c} WHEN b IS NULL OR b.t<=a.t THEN a.{c} ELSE a.{c}+(gt-a.t)/(b.t-a.t)*(b.{c}-a.{c}) END"


@query(
    "dense_resample", "WIN-4 WIN-5",
    Q.sql(["v_players"], f"""SELECT clip_id, k, {Q.r4(Q.wrap(_lin('u')))} AS yaw, {Q.r4(_lin('s'))} AS score, coalesce(a.m, b.m) AS mode FROM dn""", cs=CS, thin=THIN, unw=UNW, dn=DENSE),
)
def dense_resample(spark, sf):
    total = crowd_series(spark, sf).groupBy("clip_id").agg(F.max("ts").alias("total_s"))
    d = WN.resample(thin_series(spark, sf).select("clip_id", "ts", F.col("centroid_yaw").alias("yaw"), "score", "mode"), ["clip_id"], "ts", ["yaw"], ["score"], ["mode"], 5.0, total, 16.0)
    return rounded(d.drop("ts"), "yaw", "score")


@query(
    "camera_path_audit", "WIN-13",
    Q.sql(["v_players"], f"""SELECT clip_id, {Q.r4('max(abs(v))')} AS peak_speed, {Q.r4('max(abs(a))')} AS peak_accel, count(*) FILTER (abs(v)>25e0+1e-9) AS speed_violations, count(*) FILTER (abs(a)>60e0+1e-9) AS accel_violations,
  count(*) FILTER (mode<>m1) AS mode_changes, {Q.r4("avg(CASE WHEN mode='wide' THEN 1e0 ELSE 0e0 END)")} AS wide_fraction
FROM (SELECT *, {Q.delta('cy', 'y1')}/(ts-t1) AS v, ({Q.delta('cy', 'y1')}/(ts-t1)-{Q.delta('y1', 'y2')}/(t1-t2))/(ts-t1) AS a FROM
 (SELECT *, lag(cy,1) OVER w AS y1, lag(cy,2) OVER w AS y2, lag(ts,1) OVER w AS t1, lag(ts,2) OVER w AS t2, lag(mode) OVER w AS m1 FROM thin WINDOW w AS (PARTITION BY clip_id ORDER BY ts))) GROUP BY clip_id""", cs=CS, thin=THIN),
)
def camera_path_audit(spark, sf):
    a = WN.kinematic_audit(thin_series(spark, sf), ["clip_id"], "ts", "centroid_yaw", "mode", 25.0, 60.0, F.floor(F.col("ts") / 2048.0))
    return rounded(a, "peak_speed", "peak_accel", "wide_fraction")


@query(
    "chunk_stitch", "WIN-15",
    Q.sql(["v_players"], f"""SELECT clip_id, chunk, count(*) AS n, {Q.r4('min(gts)')} AS first_ts, {Q.r4('max(gts)')} AS last_ts FROM
 (SELECT clip_id, c.chunk, p.ts AS gts FROM (SELECT DISTINCT clip_id, sample, ts FROM v_players) p, (SELECT unnest(range(CAST(floor(max(ts)/20e0) AS BIGINT)+1)) AS chunk FROM v_players) c WHERE p.ts>=c.chunk*20e0 AND p.ts<c.chunk*20e0+20e0) GROUP BY ALL"""),
)
def chunk_stitch(spark, sf):
    s = V.players(spark, sf).select("clip_id", "sample", "ts").distinct()
    # chunk-local rows, each chunk with a five second overlap tail
    own = F.floor(F.col("ts") / 20.0).cast("int")  # a row is in its own chunk and maybe in the tail of the one before
    starts = s.select("clip_id", "sample", "ts", F.explode(F.sequence(F.greatest(own - 1, F.lit(0)), own)).alias("chunk"))
    local = starts.filter((F.col("ts") >= F.col("chunk") * 20.0) & (F.col("ts") < F.col("chunk") * 20.0 + 25.0)).withColumn("ts", F.col("ts") - F.col("chunk") * 20.0)
    length = s.groupBy("clip_id").agg(F.floor(F.max("ts") / 20.0).cast("int").alias("last"))
    plan = length.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("last")))).select("clip_id", "chunk", (F.col("chunk") * 20.0).alias("chunk_start"), F.lit(20.0).alias("nominal"))
    out = WN.stitch_chunks(local, plan).filter(F.col("ts") < F.col("chunk") * 20.0 + 20.0)
    return out.groupBy("clip_id", F.col("chunk").cast("long").alias("chunk")).agg(F.count(F.lit(1)).alias("n"), r4(F.min("ts")).alias("first_ts"), r4(F.max("ts")).alias("last_ts"))


# ---------------------------------------------------------------- fused target
def fusion_rows(spark, sf):
    p = V.players(spark, sf)
    anchors = V.track_obs(spark, sf).filter("source = 'stage0_reuse'").select("clip_id", "frame", "yaw", "weighted_conf", "det_id")
    s = crowd_series(spark, sf).select("clip_id", "sample", "ts", "centroid_yaw")
    return CR.fusion_anchors(s, anchors), p


FUS_S = "SELECT *, round_even(ts*2e0, 0) AS fr, lag(round_even(ts*2e0, 0)) OVER (PARTITION BY clip_id ORDER BY sample) AS pf, row_number() OVER (PARTITION BY clip_id ORDER BY sample) AS n FROM (SELECT clip_id, sample, ts, cy FROM cs)"
FUS_H = """SELECT s.clip_id, s.sample, s.n, s.cy, arg_max({'y': o.yaw, 'c': o.weighted_conf}, {'a': o.weighted_conf, 'b': -o.frame, 'c': -o.det_id}) FILTER (o.det_id IS NOT NULL) AS hit
  FROM ss s LEFT JOIN (SELECT * FROM v_track_obs WHERE source='stage0_reuse') o ON o.clip_id=s.clip_id AND o.frame<=s.fr AND o.frame>coalesce(s.pf,-1) GROUP BY ALL"""


@query(
    "fusion_anchors", "WIN-11 CRD-6",
    Q.sql(["v_players"], f"""SELECT clip_id, sample, CASE WHEN hit IS NOT NULL THEN 'anchor' WHEN n-lh.n<=4 THEN 'held_anchor' ELSE 'centroid' END AS anchor_source, n-lh.n AS samples_since_anchor,
  {Q.r4('CASE WHEN hit IS NOT NULL OR n-lh.n<=4 THEN lh.y ELSE cy END')} AS anchor_position, {Q.r4('hit.c')} AS ball_conf
FROM (SELECT *, last_value(CASE WHEN hit IS NOT NULL THEN {{'n': n, 'y': hit.y}} END IGNORE NULLS) OVER (PARTITION BY clip_id ORDER BY sample ROWS UNBOUNDED PRECEDING) AS lh FROM hh)""", cs=CS, ss=FUS_S, hh=FUS_H),
)
def fusion_anchors(spark, sf):
    f, _ = fusion_rows(spark, sf)
    return rounded(f.select("clip_id", "sample", "anchor_source", "samples_since_anchor", "anchor_position", "ball_conf"), "anchor_position", "ball_conf")


@query("fused_target", "CRD-6")
def fused_target(spark, sf):
    f, p = fusion_rows(spark, sf)
    flow = CR.flow_direction(p, p.select("clip_id", "sample").distinct(), CrowdConfig(min_agreeing_tracks=2)).select("clip_id", "sample", "direction", "sustained")
    lo, hi = S.venue_yaw_extent(VENUE_XS, 3840.0)
    t = S.fused_target(f.join(flow, ["clip_id", "sample"]), lo, hi)
    return rounded(t.select("clip_id", "sample", "anchor_source", "flow_offset", "combined_yaw", "clamped_yaw", "target_yaw"), "flow_offset", "combined_yaw", "clamped_yaw", "target_yaw")
