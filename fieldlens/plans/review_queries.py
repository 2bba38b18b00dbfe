"""Queries for label analysis, cue fusion, static clusters, run comparison and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.config import ClusterAuditConfig
from fieldlens.functions import geo, text
from fieldlens.functions.geo import r4
from fieldlens.operators import hotspots as H
from fieldlens.operators import review as RV
from fieldlens.operators import sampling as SM
from fieldlens.operators import spatial
from fieldlens.operators import tracklets as T
from fieldlens.plans import detection_queries as D
from fieldlens.plans import sqlkit as Q
from fieldlens.plans import track_queries as TQ
from fieldlens.plans.registry import query
from fieldlens.plans.track_queries import rounded
from fieldlens.session import cut
from fieldlens.sources import views as V

FEATS = ["f1", "f2", "f3", "f4"]
LONG = " UNION ALL ".join(f"SELECT id, verdict, '{f}' AS feature, {f} AS value FROM v_verdicts WHERE {f} IS NOT NULL" for f in FEATS)
CMPR = """SELECT *, CASE WHEN effect IS NOT NULL THEN row_number() OVER (ORDER BY effect DESC NULLS LAST, feature) END AS effect_rank FROM
 (SELECT feature, avg(value) FILTER (verdict='ball') AS ball_mean, avg(value) FILTER (verdict='fp') AS fp_mean, count(*) FILTER (verdict='ball') AS ball_n, count(*) FILTER (verdict='fp') AS fp_n,
    quantile_cont(value,0.5) FILTER (verdict='ball') AS ball_median, quantile_cont(value,0.5) FILTER (verdict='fp') AS fp_median,
    abs(avg(value) FILTER (verdict='ball')-avg(value) FILTER (verdict='fp'))/CASE WHEN stddev_pop(value)>0 THEN stddev_pop(value) ELSE 1e-9 END AS effect
  FROM lg WHERE verdict IN ('ball','fp') GROUP BY feature)"""


@query(
    "class_comparison", "AGG-8",
    Q.sql(["v_verdicts"], f"""SELECT feature, {', '.join(f'{Q.r4(c)} AS {c}' for c in ('ball_mean', 'fp_mean', 'ball_median', 'fp_median', 'effect'))}, ball_n, fp_n, effect_rank FROM cmp""", lg=LONG, cmp=CMPR),
)
def class_comparison(spark, sf):
    c = RV.class_comparison(V.verdicts(spark, sf), FEATS)
    return rounded(c.withColumn("effect_rank", F.col("effect_rank").cast("long")), "ball_mean", "fp_mean", "ball_median", "fp_median", "effect")


@query(
    "ambiguity_ranking", "AGG-9",
    Q.sql(["v_verdicts"], f"""SELECT v.id, {Q.r4('coalesce(a, 99e0)')} AS ambiguity FROM (SELECT id FROM v_verdicts WHERE verdict='unclear') v LEFT JOIN
 (SELECT id, avg(least(abs(value-ball_mean),abs(value-fp_mean))/(abs(ball_mean-fp_mean)+1e-9)) AS a FROM lg JOIN cmp USING (feature) WHERE verdict='unclear' AND effect_rank<=3 GROUP BY id) s USING (id)""", lg=LONG, cmp=CMPR),
)
def ambiguity_ranking(spark, sf):
    v = V.verdicts(spark, sf)
    return rounded(RV.ambiguity_ranking(v, RV.class_comparison(v, FEATS), FEATS), "ambiguity")


@query(
    "verdict_words", "SRC-4",
    Q.sql([], """SELECT verdict, count(*) AS n FROM (SELECT CASE WHEN t IN ('likely_ball','ball','b') THEN 'ball' WHEN t IN ('likely_false_positive','false_positive','false','fp','f') THEN 'fp' WHEN t IN ('unclear','?','u','unsure') THEN 'unclear' END AS verdict
FROM (SELECT replace(replace(lower(trim(CASE doc_id%6 WHEN 0 THEN ' Likely Ball ' WHEN 1 THEN 'False-Positive' WHEN 2 THEN '?' WHEN 3 THEN 'FP' WHEN 4 THEN '' ELSE 'Unsure' END)),' ','_'),'-','_') AS t FROM documents)) GROUP BY 1"""),
)
def verdict_words(spark, sf):
    words = F.expr("case doc_id % 6 when 0 then ' Likely Ball ' when 1 then 'False-Positive' when 2 then '?' when 3 then 'FP' when 4 then '' else 'Unsure' end")
    return V.table(spark, sf, "documents").select(text.normalise_verdict(words).alias("verdict")).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


VC = """SELECT clip_id, tracklet_id, CASE WHEN n<2 THEN NULL WHEN med=0 THEN 1e0 ELSE ok/CAST(n AS DOUBLE) END AS vel_consistency FROM
 (SELECT s.clip_id, s.tracklet_id, count(step) AS n, any_value(med) AS med, count(*) FILTER (step<=med*2e0+1e-12) AS ok FROM st s LEFT JOIN
   (SELECT clip_id, tracklet_id, quantile_cont(step,0.5) AS med FROM st GROUP BY ALL) m USING (clip_id, tracklet_id) GROUP BY ALL)"""
ST = "SELECT clip_id, tracklet_id, frame, sqrt(pow(yaw-lag(yaw) OVER w,2)+pow(pitch-lag(pitch) OVER w,2)) AS step FROM v_track_obs WINDOW w AS (PARTITION BY clip_id, tracklet_id ORDER BY frame)"


def _nrm(f):
    return f"coalesce(CASE WHEN {f} IS NOT NULL THEN greatest(0e0,least(1e0,({f}-min({f}) OVER ())/CASE WHEN max({f}) OVER ()>min({f}) OVER () THEN max({f}) OVER ()-min({f}) OVER () ELSE 1e0 END)) END,0e0)"


@query(
    "likeness_scores", "AGG-10",
    Q.sql(["v_track_obs"], f"""SELECT clip_id, tracklet_id, {Q.r4(f"{_nrm('observation_count')}*0.35e0+{_nrm('spatial_spread_deg')}*0.3e0+{_nrm('vel_consistency')}*0.2e0+{_nrm('net_displacement_deg')}*0.15e0")} AS score
FROM metric JOIN vc USING (clip_id, tracklet_id)""", **TQ.MET, st=ST, vc=VC),
)
def likeness_scores(spark, sf):
    obs = V.track_obs(spark, sf)
    m = T.tracklet_metrics(obs).join(RV.step_consistency(obs), T.KEY).select(
        *T.KEY, F.col("observation_count").cast("double").alias("obs_count"), "spatial_spread_deg", "vel_consistency", F.col("net_displacement_deg").alias("net_disp_deg"))
    return RV.likeness_scores(m).select(*T.KEY, r4("score").alias("score"))


CUE_D = "raw_conf"
CUE_P = "CASE WHEN det_id%4=0 THEN NULL ELSE (det_id%10)/10e0 END"
CUE_S = "CASE WHEN det_id%9=0 THEN 0.3e0 ELSE 1e0 END"
CUE_T = "CASE WHEN frame%7=0 THEN NULL ELSE greatest(0e0,1e0-(det_id%12)/12e0) END"
CUE_G = Q.clamp("1e0-abs(ln(bbox_aspect_ratio))/ln(4e0)")


def _fuse(pairs):
    num = "+".join(f"coalesce(({c})*{w}e0,0e0)" for c, w in pairs)
    den = "+".join(f"(CASE WHEN ({c}) IS NOT NULL THEN {w}e0 ELSE 0e0 END)" for c, w in pairs)
    return f"({num})/({den})"


FUSED = _fuse([(CUE_D, 0.38), (CUE_P, 0.24), (CUE_S, 0.14), (CUE_T, 0.16), (CUE_G, 0.08)])
# Picks compare scores rounded to nine places, so that equal cues tie in both engines.
R9 = lambda x: f"floor(({x})*1e9+0.500001e0)/1e9"


def fused_candidates(spark, sf):
    d = V.detections(spark, sf)
    cues = {
        "detector": F.col("raw_conf"), "pose": F.expr("case when det_id % 4 = 0 then null else (det_id % 10) / 10e0 end"),
        "static": F.expr("case when det_id % 9 = 0 then 0.3e0 else 1e0 end"),
        "temporal": F.expr("case when frame % 7 = 0 then null else greatest(0e0, 1e0 - (det_id % 12) / 12e0) end"), "geometry": geo.compactness("bbox_aspect_ratio")}
    return d.withColumn("fused", r4(RV.fused_score(cues, RV.CANDIDATE_CUES), 9)).withColumn("pose_support", cues["pose"])


@query(
    "fused_candidate_pick", "AGG-11",
    Q.sql(["v_detections"], f"""SELECT clip_id, frame, raw_pick, fused_pick, raw_pick=fused_pick AS same_pick, {Q.r4('best')} AS best_fused FROM
 (SELECT clip_id, frame, arg_max(det_id, {{'a': raw_conf, 'b': -det_id}}) AS raw_pick, arg_max(det_id, {{'a': fused, 'b': -det_id}}) AS fused_pick, max(fused) AS best FROM (SELECT *, {R9(FUSED)} AS fused FROM v_detections) GROUP BY ALL)"""),
)
def fused_candidate_pick(spark, sf):
    c = fused_candidates(spark, sf)
    best = c.groupBy("clip_id", "frame").agg(r4(F.max("fused")).alias("best_fused"))
    return RV.raw_and_fused_pick(c, ["clip_id", "frame"]).join(best, ["clip_id", "frame"])


@query(
    "pose_guided_pick", "AGG-12",
    Q.sql(["v_detections"], f"""SELECT clip_id, frame, raw_pick, coalesce(g, raw_pick) AS guided_pick, CASE WHEN g IS NULL THEN 'RAW_FALLBACK_NO_LOWER_BODY_SUPPORT' ELSE 'POSE_GUIDED' END AS label FROM
 (SELECT clip_id, frame, arg_max(det_id, {{'a': raw_conf, 'b': -det_id}}) AS raw_pick, arg_max(det_id, {{'a': guided, 'b': -det_id}}) FILTER (guided IS NOT NULL) AS g FROM
  (SELECT *, CASE WHEN ps>=0.2e0 THEN {R9("raw_conf/CASE WHEN br>0 THEN br ELSE 1e0 END*0.65e0+ps*0.35e0")} END AS guided FROM
   (SELECT *, max(CASE WHEN ps>=0.2e0 THEN raw_conf END) OVER (PARTITION BY clip_id, frame) AS br FROM (SELECT *, {CUE_P} AS ps FROM v_detections))) GROUP BY ALL)"""),
)
def pose_guided_pick(spark, sf):
    return RV.pose_guided_pick(fused_candidates(spark, sf), ["clip_id", "frame"])


@query(
    "track_cue_scores", "AGG-11",
    Q.sql(["v_track_obs"], f"""SELECT clip_id, tracklet_id, {Q.r4('tc')} AS temporal, {Q.r4(_fuse([('mean_weighted_conf', 0.35), ('CASE WHEN tracklet_id%5=0 THEN 0.1e0 ELSE 0.75e0 END', 0.1), ('CASE WHEN tracklet_id%3=0 THEN NULL ELSE 0.5e0 END', 0.2), ('CASE WHEN tracklet_id%2=0 THEN NULL ELSE 0.8e0 END', 0.1), ('tc', 0.25)]))} AS fused
FROM (SELECT *, least(1e0,ln(1e0+observation_count)/ln(121e0))*0.3e0+least(1e0,spatial_spread_deg/10e0)*0.25e0+least(1e0,net_displacement_deg/20e0)*0.2e0+velocity_consistency*0.25e0 AS tc FROM metric)""", **TQ.MET),
)
def track_cue_scores(spark, sf):
    m = T.tracklet_metrics(V.track_obs(spark, sf)).withColumn("tc", RV.temporal_cue("observation_count", "spatial_spread_deg", "net_displacement_deg", "velocity_consistency"))
    cues = {"detector": F.col("mean_weighted_conf"), "view_band": RV.view_band_cue(F.expr("case when tracklet_id % 5 = 0 then 40e0 else 0e0 end")),
            "pose": F.expr("case when tracklet_id % 3 = 0 then null else 0.5e0 end"), "geometry": F.expr("case when tracklet_id % 2 = 0 then null else 0.8e0 end"), "temporal": F.col("tc")}
    return m.select(*T.KEY, r4("tc").alias("temporal"), r4(RV.fused_score(cues, RV.TRACK_CUES)).alias("fused"))


@query(
    "pose_distances", "FN-14",
    Q.sql(["v_detections"], f"""SELECT det_id, {Q.r4('pp')} AS person_px, {Q.r4('lp')} AS lower_px, {Q.r4('ap')} AS ankle_px, {Q.r4('CASE WHEN ap IS NOT NULL THEN greatest(0e0,least(1e0,1e0-ap/260e0)) WHEN lp IS NOT NULL THEN greatest(0e0,least(1e0,1e0-lp/320e0)) END')} AS pose_score FROM
 (SELECT d.det_id, min(sqrt(pow(greatest(p.x-d.px,0e0,d.px-p.x-60e0),2)+pow(greatest(p.y-d.py,0e0,d.py-p.y-120e0),2))) AS pp, min(CASE WHEN p.id IS NOT NULL THEN sqrt(pow(d.px-p.x-30e0,2)+pow(d.py-p.y-90e0,2)) END) AS lp,
    min(CASE WHEN p.id%2=0 THEN sqrt(pow(d.px-p.x-25e0,2)+pow(d.py-p.y-118e0,2)) END) AS ap
  FROM (SELECT *, (det_id%1280)*1e0 AS px, (det_id%720)*1e0 AS py FROM v_detections WHERE det_id%3<>0) d LEFT JOIN (SELECT clip_id, frame, det_id AS id, (det_id*7%1200)*1e0 AS x, (det_id*11%600)*1e0 AS y FROM v_detections WHERE det_id%3=0) p
  ON p.clip_id=d.clip_id AND p.frame=d.frame GROUP BY ALL)""".replace("min(sqrt(pow(greatest(p.x", "min(CASE WHEN p.id IS NOT NULL THEN sqrt(pow(greatest(p.x").replace("d.py-p.y-120e0),2))) AS pp", "d.py-p.y-120e0),2)) END) AS pp")),
)
def pose_distances(spark, sf):
    d = V.detections(spark, sf)
    pts = d.filter("det_id % 3 <> 0").select("clip_id", "frame", "det_id", F.expr("(det_id % 1280) * 1e0").alias("px"), F.expr("(det_id % 720) * 1e0").alias("py"))
    x, y = F.expr("(det_id * 7 % 1200) * 1e0"), F.expr("(det_id * 11 % 600) * 1e0")
    pt = lambda dx, dy: F.array(F.struct((x + dx).alias("x"), (y + dy).alias("y")))
    people = d.filter("det_id % 3 = 0").select("clip_id", "frame", F.array(x, y, x + 60.0, y + 120.0).alias("box"), pt(30.0, 90.0).alias("lower"),
                                               F.when(F.expr("det_id % 2 = 0"), pt(25.0, 118.0)).alias("ankles"))
    o = RV.pose_distances(pts, people, ["clip_id", "frame"])
    return rounded(o.drop("clip_id", "frame"), "person_px", "lower_px", "ankle_px", "pose_score")


# ---------------------------------------------------------------- static clusters over pieces of tracks
PIECE = "SELECT clip_id, tracklet_id*10+frame//20 AS tracklet_id, frame, det_id, yaw, pitch, weighted_conf, source, bbox_area_px, bbox_aspect_ratio FROM v_track_obs"
PT = f"""SELECT *, {Q.gc('a.yaw', 'a.pitch', 'b.yaw', 'b.pitch')} AS net FROM (SELECT clip_id, tracklet_id, count(*) AS n, min(frame) AS s, max(frame) AS e, arg_min({{'yaw': yaw, 'pitch': pitch}}, frame) AS a, arg_max({{'yaw': yaw, 'pitch': pitch}}, frame) AS b,
   quantile_cont(yaw,0.5) AS yaw, quantile_cont(pitch,0.5) AS pitch FROM pc GROUP BY ALL)"""
NS = "SELECT * FROM pt WHERE n>=3 AND e-s>=5 AND net<1.5e0"
SL = f"SELECT a.clip_id, a.tracklet_id AS a, b.tracklet_id AS b FROM ns a JOIN ns b ON a.clip_id=b.clip_id WHERE {Q.gc('a.yaw', 'a.pitch', 'b.yaw', 'b.pitch')} < 4e0 - {Q.TOL}"
SR = "SELECT clip_id, tracklet_id AS src, tracklet_id AS dst FROM ns UNION SELECT r.clip_id, r.src, l.b FROM sr r JOIN sl l ON r.clip_id=l.clip_id AND r.dst=l.a"
SC = "SELECT clip_id, dst AS tracklet_id, min(src) AS comp FROM sr GROUP BY ALL"
SK = """SELECT clip_id, comp, member_count, f, l, total_obs, degrees(atan2(x,z)) AS cy, degrees(asin(greatest(-1e0,least(1e0,y/sqrt(x*x+y*y+z*z))))) AS cp FROM
  (SELECT n.clip_id, comp, count(*) AS member_count, min(s) AS f, max(e) AS l, sum(n) AS total_obs, sum(n*cos(radians(pitch))*sin(radians(yaw))) AS x, sum(n*sin(radians(pitch))) AS y, sum(n*cos(radians(pitch))*cos(radians(yaw))) AS z FROM ns n JOIN sc USING (clip_id, tracklet_id) GROUP BY ALL)"""
SM_ = f"SELECT n.*, c.comp, {Q.gc('n.yaw', 'n.pitch', 'k.cy', 'k.cp')} AS dist, (s+e)//2 AS mid FROM ns n JOIN sc c USING (clip_id, tracklet_id) JOIN sk k ON k.clip_id=c.clip_id AND k.comp=c.comp"
SO = "SELECT *, row_number() OVER (PARTITION BY clip_id, comp ORDER BY mid, tracklet_id) AS rn FROM sm"
SW = """SELECT clip_id, comp, rn, mid AS last, 1 AS kept FROM so WHERE rn=1 UNION ALL
  SELECT o.clip_id, o.comp, o.rn, CASE WHEN o.mid-w.last>=50 THEN o.mid ELSE w.last END, CASE WHEN o.mid-w.last>=50 THEN 1 ELSE 0 END FROM sw w JOIN so o ON o.clip_id=w.clip_id AND o.comp=w.comp AND o.rn=w.rn+1"""
SCL = dict(pc=PIECE, pt=PT, ns=NS, sl=SL, sr=SR, sc=SC, sk=SK, sm=SM_, so=SO, sw=SW)


def pieces(spark, sf):
    obs = cut(V.track_obs(spark, sf).select("clip_id", F.expr("tracklet_id * 10 + frame div 20").alias("tracklet_id"), "frame", "det_id", "yaw", "pitch"))
    t = obs.groupBy(*T.KEY).agg(
        F.count(F.lit(1)).alias("observation_count"), F.min("frame").alias("start_frame"), F.max("frame").alias("end_frame"),
        F.min_by(F.struct("yaw", "pitch"), "frame").alias("a"), F.max_by(F.struct("yaw", "pitch"), "frame").alias("b"))
    t = t.withColumn("net_displacement_deg", geo.angular_distance("a.yaw", "a.pitch", "b.yaw", "b.pitch")).withColumn("status", F.lit("passing")).drop("a", "b")
    return obs, t


def members(obs, t):
    return cut(RV.near_static(obs, t))


def clusters(spark, sf):
    return RV.cluster_members(members(*pieces(spark, sf)))


@query(
    "static_clusters", "AGG-14 AGG-15 CLU-1",
    Q.sql(["v_track_obs"], f"""SELECT clip_id, comp, member_count, {Q.r4('cy')} AS centre_yaw, {Q.r4('cp')} AS centre_pitch, {Q.r4('radius')} AS radius_deg, l-f AS temporal_span, CAST(total_obs AS BIGINT) AS total_obs, CAST(w AS BIGINT) AS distinct_windows,
  member_count>=3 AND l-f>=150 AND w>=2 AS is_repeated
FROM sk JOIN (SELECT clip_id, comp, max(dist) AS radius FROM sm GROUP BY ALL) USING (clip_id, comp) JOIN (SELECT clip_id, comp, sum(kept) AS w FROM sw GROUP BY ALL) USING (clip_id, comp)""", **SCL),
)
def static_clusters(spark, sf):
    c, _ = RV.static_clusters(members(*pieces(spark, sf)))
    return rounded(c.select("clip_id", "comp", "member_count", "centre_yaw", "centre_pitch", "radius_deg", "temporal_span", "total_obs", "distinct_windows", "is_repeated"), "centre_yaw", "centre_pitch", "radius_deg")


@query(
    "cluster_match_radius", "AGG-16",
    Q.sql(["v_track_obs"], f"SELECT clip_id, comp, {Q.r4('p95')} AS p95, {Q.r4('greatest(0.3e0,least(6e0,p95+0.5e0))')} AS match_radius_deg FROM (SELECT clip_id, comp, quantile_cont(dist,0.95) AS p95 FROM sm GROUP BY ALL)", **{k: SCL[k] for k in ("pc", "pt", "ns", "sl", "sr", "sc", "sk", "sm")}),
)
def cluster_match_radius(spark, sf):
    _, m = clusters(spark, sf)
    return rounded(RV.match_radius(m), "p95", "match_radius_deg")


@query(
    "discovered_static_matches", "JOIN-2 AGG-16",
    Q.sql(["v_track_obs"], f"""SELECT t.clip_id, t.tracklet_id, m.comp AS match, {Q.r4('m.d')} AS match_dist FROM pt t LEFT JOIN (
  SELECT t.clip_id, t.tracklet_id, k.comp, {Q.gc('t.yaw', 't.pitch', 'k.cy', 'k.cp')} AS d FROM pt t JOIN (SELECT k.*, greatest(0.3e0,least(6e0,p95+0.5e0)) AS r FROM sk k JOIN (SELECT clip_id, comp, quantile_cont(dist,0.95) AS p95 FROM sm GROUP BY ALL) USING (clip_id, comp)) k
    ON k.clip_id=t.clip_id WHERE {Q.gc('t.yaw', 't.pitch', 'k.cy', 'k.cp')} <= r + {Q.TOL} QUALIFY row_number() OVER (PARTITION BY t.clip_id, t.tracklet_id ORDER BY {Q.gc('t.yaw', 't.pitch', 'k.cy', 'k.cp')}, comp)=1) m USING (clip_id, tracklet_id)""", **{k: SCL[k] for k in ("pc", "pt", "ns", "sl", "sr", "sc", "sk", "sm")}),
)
def discovered_static_matches(spark, sf):
    obs, t = pieces(spark, sf)
    c, m = RV.cluster_members(members(obs, t))
    centres = c.join(RV.match_radius(m), ["clip_id", "comp"]).select("clip_id", "comp", "centre_yaw", "centre_pitch", "match_radius_deg")
    pts = T.median_position(obs).select("clip_id", "tracklet_id", F.col("median_yaw").alias("yaw"), F.col("median_pitch").alias("pitch"))
    h = spatial.nearest_within(pts, centres, ["clip_id"], "match_radius_deg", "comp")
    return rounded(h.select("clip_id", "tracklet_id", "match", "match_dist"), "match_dist")


@query("cluster_coherence", "AGG-17 CLU-4")
def cluster_coherence(spark, sf):
    _, m = clusters(spark, sf)
    return rounded(RV.cluster_coherence(m), "largest_gap_deg", "max_pairwise_deg")


@query(
    "cluster_spread", "AGG-17",
    Q.sql(["v_track_obs"], f"""SELECT clip_id, comp, {Q.r4('mp')} AS max_pairwise_deg FROM (SELECT a.clip_id, a.comp, max(CASE WHEN a.yaw=b.yaw AND a.pitch=b.pitch THEN 0e0 ELSE {Q.gc('a.yaw', 'a.pitch', 'b.yaw', 'b.pitch')} END) AS mp FROM sm a JOIN sm b ON a.clip_id=b.clip_id AND a.comp=b.comp GROUP BY ALL)""",
          **{k: SCL[k] for k in ("pc", "pt", "ns", "sl", "sr", "sc", "sk", "sm")}),
)
def cluster_spread(spark, sf):
    _, m = clusters(spark, sf)
    return rounded(RV.diameter(m, ["clip_id", "comp"]), "max_pairwise_deg")


# ---------------------------------------------------------------- run comparison: the rerun lost some detections
UM = """SELECT clip_id, tracklet_id, list(yaw ORDER BY yaw)[len(list(yaw))//2+1] AS my, list(pitch ORDER BY pitch)[len(list(pitch))//2+1] AS mp FROM %s GROUP BY ALL"""
RC = dict(
    pc=PIECE, pt=PT, dc="SELECT * FROM pc WHERE det_id%3<>0 AND tracklet_id%4<>1",
    om=UM % "pc", dm=UM % "dc", ds="SELECT clip_id, tracklet_id, min(frame) AS s, max(frame) AS e, count(*) AS n FROM dc GROUP BY ALL",
    ost="SELECT *, CASE WHEN n<3 THEN 'fragment' WHEN n>=8 THEN 'anchor' ELSE 'passing' END AS status FROM pt",
    dst="SELECT *, CASE WHEN n<3 THEN 'fragment' WHEN n>=8 THEN 'anchor' ELSE 'passing' END AS status FROM ds",
)
CONT = f"""SELECT t.clip_id, t.tracklet_id, t.status, nf, nl, CASE WHEN coalesce(nf<=2e0+{Q.TOL},false) OR coalesce(nl<=2e0+{Q.TOL},false) THEN 'spatial_or_linked_continuous' WHEN nf IS NOT NULL THEN 'frame_only_unsupported' ELSE 'no_support' END AS outcome
  FROM (SELECT * FROM ost JOIN om USING (clip_id, tracklet_id) WHERE net>=2e0 AND status IN ('anchor','passing')) t
  LEFT JOIN (SELECT o.clip_id, o.tracklet_id, min({Q.gc('om.my', 'om.mp', 'c.yaw', 'c.pitch')}) AS nf FROM ost o JOIN om USING (clip_id, tracklet_id) JOIN dc c ON c.clip_id=o.clip_id AND c.frame BETWEEN o.s AND o.e WHERE net>=2e0 GROUP BY ALL) f USING (clip_id, tracklet_id)
  LEFT JOIN (SELECT o.clip_id, o.tracklet_id, min({Q.gc('om.my', 'om.mp', 'dm.my', 'dm.mp')}) AS nl FROM ost o JOIN om USING (clip_id, tracklet_id) JOIN ds d ON d.clip_id=o.clip_id AND d.s<=o.e AND d.e>=o.s JOIN dm ON dm.clip_id=d.clip_id AND dm.tracklet_id=d.tracklet_id WHERE net>=2e0 GROUP BY ALL) l USING (clip_id, tracklet_id)"""


def two_runs(spark, sf):
    obs, t = pieces(spark, sf)
    status = lambda n: F.when(F.col(n) < 3, "fragment").when(F.col(n) >= 8, "anchor").otherwise("passing")
    kept = obs.filter("det_id % 3 <> 0 and tracklet_id % 4 <> 1")
    r = kept.groupBy(*T.KEY).agg(F.min("frame").alias("start_frame"), F.max("frame").alias("end_frame"), F.count(F.lit(1)).alias("n"))
    return t.withColumn("status", status("observation_count")), obs, r.withColumn("status", status("n")), kept


@query(
    "run_status_deltas", "AGG-18",
    Q.sql(["v_track_obs"], """SELECT clip_id, status, coalesce(a,0) AS original, coalesce(b,0) AS rerun, coalesce(b,0)-coalesce(a,0) AS delta FROM (SELECT clip_id, status, count(*) AS a FROM ost GROUP BY ALL) FULL JOIN (SELECT clip_id, status, count(*) AS b FROM dst GROUP BY ALL) USING (clip_id, status)""",
          **{k: RC[k] for k in ("pc", "pt", "dc", "ds", "ost", "dst")}),
)
def run_status_deltas(spark, sf):
    o, _, r, _ = two_runs(spark, sf)
    return RV.status_deltas(o, r)


@query(
    "run_continuity", "AGG-18",
    Q.sql(["v_track_obs"], f"SELECT clip_id, tracklet_id, status, {Q.r4('nf')} AS nearest_frame_dist, {Q.r4('nl')} AS nearest_linked_dist, outcome FROM cont", **RC, cont=CONT),
)
def run_continuity(spark, sf):
    o, obs, r, kept = two_runs(spark, sf)
    c = RV.continuity(o, obs, r, kept, kept)
    return rounded(c.drop("has_frame_support", "has_spatial_support", "has_linked_support"), "nearest_frame_dist", "nearest_linked_dist")


@query(
    "run_acceptance", "AGG-18",
    Q.sql(["v_track_obs"], """SELECT clip_id, count(*) FILTER (o='spatial_or_linked_continuous') AS continuous, count(*) FILTER (o='frame_only_unsupported') AS frame_only, count(*) FILTER (o='no_support') AS no_support,
  count(*) FILTER (o='x') AS expected_removed, CASE WHEN count(*) FILTER (o IN ('frame_only_unsupported','no_support'))=0 THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM (SELECT clip_id, CASE WHEN outcome<>'spatial_or_linked_continuous' AND tracklet_id%10<5 THEN 'x' ELSE outcome END AS o FROM cont) GROUP BY clip_id""", **RC, cont=CONT),
)
def run_acceptance(spark, sf):
    o, obs, r, kept = two_runs(spark, sf)
    return RV.acceptance(RV.continuity(o, obs, r, kept, kept), o.filter("tracklet_id % 10 < 5"))


# ---------------------------------------------------------------- review picks and samples
@query(
    "review_sections", "TOP-2",
    Q.sql(["v_track_obs"], """SELECT clip_id, tracklet_id, min({'s': section, 'r': rk}).s AS section, min({'s': section, 'r': rk}).r AS rank FROM (
  SELECT clip_id, tracklet_id, 'A' AS section, row_number() OVER (PARTITION BY clip_id ORDER BY n DESC, tracklet_id) AS rk FROM ost WHERE status='anchor'
  UNION ALL SELECT clip_id, tracklet_id, 'B', row_number() OVER (PARTITION BY clip_id ORDER BY n DESC, tracklet_id) FROM ost WHERE status='passing'
  UNION ALL SELECT clip_id, tracklet_id, 'C', row_number() OVER (PARTITION BY clip_id ORDER BY floor(net*1e3+0.500001e0)/1e3, tracklet_id) FROM ost) WHERE rk<=20 GROUP BY ALL""", **{k: RC[k] for k in ("pc", "pt", "ost")}),
)
def review_sections(spark, sf):
    o, _, _, _ = two_runs(spark, sf)
    o = o.withColumn("anchor_strength", F.col("observation_count").cast("double")).withColumn("best_available_score", F.col("observation_count").cast("double"))
    s = RV.review_sections(o.withColumn("net_displacement_deg", r4("net_displacement_deg", 3)))
    return s.withColumn("rank", F.col("rank").cast("long"))


@query(
    "tracker_report", "AGG-19",
    Q.sql(["v_detections", "v_frames"], f"""SELECT clip_id, count(*) AS frames_total, count(*) FILTER (n>0) AS frames_with_raw, count(best) AS frames_confirmed, {Q.r4('count(*) FILTER (n>0)*100e0/count(*)')} AS raw_pct, {Q.r4('count(best)*100e0/count(*)')} AS confirmed_pct,
  {Q.r4('avg(n)')} AS mean_raw, {Q.r4('avg(nd)')} AS mean_dedup, {Q.r4('avg(best)')} AS mean_best_score, count(*) FILTER (best IS NOT NULL AND pitch>10) AS pitch_above_10, count(*) FILTER (best IS NULL AND n>0 AND pitch<=18) AS rejected_low_score, count(*) FILTER (best IS NULL AND pitch>18) AS rejected_pitch,
  {Q.r4('quantile_cont(pitch,0.5) FILTER (best IS NOT NULL)')} AS pitch_median, {Q.r4('quantile_cont(pitch,0.9) FILTER (best IS NOT NULL)')} AS pitch_p90, {Q.r4('quantile_cont(pitch,0.95) FILTER (best IS NOT NULL)')} AS pitch_p95
FROM (SELECT f.clip_id, f.frame, count(d.det_id) AS n, count(DISTINCT d.obj_id) AS nd, CASE WHEN max(raw_conf)>=0.8e0 THEN max(raw_conf) END AS best, arg_max(pitch, {{'a': raw_conf, 'b': -det_id}}) AS pitch FROM v_frames f LEFT JOIN v_detections d ON d.clip_id=f.clip_id AND d.frame=f.frame GROUP BY ALL) GROUP BY clip_id"""),
)
def tracker_report(spark, sf):
    det = V.detections(spark, sf)
    per = det.groupBy("clip_id", "frame", "obj_id").agg(F.count(F.lit(1)).alias("k"), F.max(F.struct("raw_conf", -F.col("det_id"), "pitch")).alias("top"))
    per = per.groupBy("clip_id", "frame").agg(F.sum("k").alias("n_raw"), F.count(F.lit(1)).alias("n_dedup"), F.max("top").alias("top"))
    f = V.dense_frames(det).join(per, ["clip_id", "frame"], "left").na.fill(0, ["n_raw", "n_dedup"])
    f = f.withColumn("best_score", F.when(F.col("top.raw_conf") >= 0.8, F.col("top.raw_conf"))).withColumn("pitch", F.col("top.pitch"))
    f = f.withColumn("rejected", F.when(F.col("best_score").isNull() & (F.col("pitch") > 18), "pitch_hard_max").when(F.col("best_score").isNull() & (F.col("n_raw") > 0), "low_score"))
    r = RV.tracker_report(f)
    return rounded(r, "raw_pct", "confirmed_pct", "mean_raw", "mean_dedup", "mean_best_score", "pitch_median", "pitch_p90", "pitch_p95")


PF = """SELECT f.clip_id, f.frame, count(d.det_id) AS n, max(raw_conf) AS top_conf, min(CASE WHEN d.det_id IS NOT NULL THEN CASE WHEN det_id%8=0 THEN 0.3e0 WHEN det_id%8=1 THEN 0.7e0 ELSE 1e0 END END) AS min_penalty, any_value(total) AS total
  FROM v_frames f LEFT JOIN v_detections d ON d.clip_id=f.clip_id AND d.frame=f.frame JOIN (SELECT clip_id, count(*) AS total FROM v_frames GROUP BY 1) t ON t.clip_id=f.clip_id GROUP BY f.clip_id, f.frame"""
QT = "SELECT clip_id, list(top_conf ORDER BY top_conf)[CAST(floor(count(*)*0.25) AS BIGINT)+1] AS low_t, list(top_conf ORDER BY top_conf)[CAST(floor(count(*)*0.75) AS BIGINT)+1] AS high_t FROM pf WHERE top_conf IS NOT NULL GROUP BY clip_id"
THIRD = "CASE WHEN frame<total//3 THEN 'temporal_early' WHEN frame<2*(total//3) THEN 'temporal_mid' ELSE 'temporal_late' END"


def sample_inputs(spark, sf):
    det = V.detections(spark, sf)
    cand = det.select("clip_id", "frame", "det_id", F.col("raw_conf").alias("weighted_conf"),
                      F.expr("case when det_id % 8 = 0 then 0.3e0 when det_id % 8 = 1 then 0.7e0 else 1e0 end").alias("penalty"))
    return SM.frame_summary(V.dense_frames(det), cand)


FS = f"""SELECT clip_id, frame, unnest(list_filter([{THIRD}, CASE WHEN n=0 THEN 'zero_candidates' WHEN n=1 THEN 'single_candidate' ELSE 'multi_candidate' END, CASE WHEN n>=3 THEN 'cluttered' END,
  CASE WHEN n>0 AND top_conf>=high_t THEN 'high_conf' END, CASE WHEN n>0 AND top_conf<=low_t THEN 'low_conf' END, CASE WHEN n>0 AND min_penalty<0.5e0 THEN 'hotspot_adjacent' END, CASE WHEN n>0 AND min_penalty>=0.9e0 THEN 'hotspot_neutral' END], lambda x: x IS NOT NULL)) AS stratum
FROM pf LEFT JOIN qt USING (clip_id)"""


def _fill_ctes(prefix, where, budgets, target, seed=42):
    """CTEs ``<prefix>`` (clip_id, frame, stratum): budgets filled one after the other, then trimmed or topped up."""
    c = {f"{prefix}s": f"SELECT *, md5('{seed}|' || clip_id || '|' || stratum || '|' || CAST(frame AS VARCHAR)) AS h, count(*) OVER (PARTITION BY clip_id, stratum) AS pool FROM fs WHERE {where}"}
    taken = None
    for k, (name, n) in enumerate(budgets):
        free = f" AND NOT EXISTS (SELECT 1 FROM {taken} t WHERE t.clip_id=s.clip_id AND t.frame=s.frame)" if taken else ""
        picks = f"SELECT clip_id, frame, stratum FROM {prefix}s s WHERE stratum='{name}'{free} QUALIFY row_number() OVER (PARTITION BY clip_id ORDER BY h)<={n}"
        c[f"{prefix}{k}"] = f"SELECT * FROM {taken} UNION ALL ({picks})" if taken else picks
        taken = f"{prefix}{k}"
    c[f"{prefix}r"] = f"SELECT clip_id, frame, sum(pool) AS rarity, md5('{seed}|' || clip_id || '|' || CAST(frame AS VARCHAR)) AS h FROM {prefix}s GROUP BY clip_id, frame"
    c[prefix] = f"""SELECT clip_id, frame, stratum FROM (SELECT r.clip_id, r.frame, coalesce(t.stratum, 'top_up') AS stratum,
   row_number() OVER (PARTITION BY r.clip_id ORDER BY CASE WHEN t.stratum IS NULL THEN 1 ELSE 0 END, CASE WHEN t.stratum IS NOT NULL THEN rarity END, CASE WHEN t.stratum IS NOT NULL THEN r.frame END, r.h) AS pos
  FROM {prefix}r r LEFT JOIN {taken} t ON t.clip_id=r.clip_id AND t.frame=r.frame) WHERE pos<={target}"""
    return c


@query("frame_strata", "SMP-1", Q.sql(["v_detections", "v_frames"], "SELECT clip_id, frame, stratum FROM fs", pf=PF, qt=QT, fs=FS))
def frame_strata(spark, sf):
    f = sample_inputs(spark, sf)
    return SM.frame_strata(f, SM.quartile_thresholds(f))


@query(
    "review_manifest", "SMP-1",
    Q.sql(["v_detections", "v_frames"], "SELECT clip_id, frame, stratum FROM mf", pf=PF, qt=QT, fs=FS, **_fill_ctes("mf", "true", SM.STRATA, SM.TARGET)),
)
def review_manifest(spark, sf):
    f = sample_inputs(spark, sf)
    return SM.review_manifest(SM.frame_strata(f, SM.quartile_thresholds(f)))


def _thirds_sql(cond, quota, seed):
    return Q.sql(["v_detections", "v_frames"], f"""SELECT clip_id, frame, third FROM (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY (CASE WHEN rk<={quota // 3} THEN 1 ELSE 0 END) DESC, h) AS pos FROM
 (SELECT *, row_number() OVER (PARTITION BY clip_id, third ORDER BY h) AS rk FROM (SELECT clip_id, frame, {THIRD} AS third, md5('{seed}|' || clip_id || '|' || CAST(frame AS VARCHAR)) AS h FROM pf WHERE {cond}))) WHERE pos<={quota}""", pf=PF)


@query("second_rank_samples", "SMP-2", _thirds_sql("n>=2", 10, 44))
def second_rank_samples(spark, sf):
    return SM.thirds_sample(sample_inputs(spark, sf).filter("n >= 2"), 10, 44)


@query("empty_frame_samples", "SMP-2", _thirds_sql("n=0", 15, 43))
def empty_frame_samples(spark, sf):
    return SM.thirds_sample(sample_inputs(spark, sf).filter("n = 0"), 15, 43)


def _share(source, quota, seed):
    return f"""SELECT clip_id, frame, third FROM (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY (CASE WHEN rk<={quota // 3} THEN 1 ELSE 0 END) DESC, h) AS pos FROM
 (SELECT *, row_number() OVER (PARTITION BY clip_id, third ORDER BY h) AS rk FROM (SELECT clip_id, frame, {THIRD} AS third, md5('{seed}|' || clip_id || '|' || CAST(frame AS VARCHAR)) AS h FROM {source}))) WHERE pos<={quota}"""


@query(
    "ranked_samples", "SMP-2",
    Q.sql(
        ["v_detections", "v_frames"],
        """SELECT clip_id, frame, sample_type, reviewed_rank, reason, candidate_count, det_id FROM (
  SELECT clip_id, frame, 'top' AS sample_type, 0 AS reviewed_rank, stratum AS reason FROM tp UNION ALL SELECT clip_id, frame, 'non_top', 1, third FROM sd)
 JOIN (SELECT clip_id, frame, det_id, row_number() OVER (PARTITION BY clip_id, frame ORDER BY raw_conf DESC, det_id)-1 AS rk, count(*) OVER (PARTITION BY clip_id, frame) AS candidate_count FROM v_detections) USING (clip_id, frame)
 WHERE rk=reviewed_rank UNION ALL SELECT clip_id, frame, 'zero', NULL, third, 0, NULL FROM em""",
        pf=PF, qt=QT, fs=FS, **_fill_ctes("tp", "frame IN (SELECT frame FROM pf WHERE pf.clip_id=fs.clip_id AND n>0)", SM.CANDIDATE_STRATA, SM.TOP_QUOTA),
        sd=_share("pf WHERE n>=2 AND NOT EXISTS (SELECT 1 FROM tp WHERE tp.clip_id=pf.clip_id AND tp.frame=pf.frame)", SM.SECOND_QUOTA, 44), em=_share("pf WHERE n=0", SM.EMPTY_QUOTA, 43),
    ),
)
def ranked_samples(spark, sf):
    f = sample_inputs(spark, sf)
    cand = V.detections(spark, sf).select("clip_id", "frame", "det_id", F.col("raw_conf").alias("weighted_conf"))
    return SM.ranked_samples(f, cand)
