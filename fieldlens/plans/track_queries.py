"""Queries over tracklets: linking, scoring, gaps, loss windows, repair, merges, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.config import LinkConfig, RepairConfig
from fieldlens.functions import geo
from fieldlens.functions.geo import r4
from fieldlens.operators import joins as J
from fieldlens.operators import linking as L
from fieldlens.operators import merge as M
from fieldlens.operators import repair as R
from fieldlens.operators import spatial
from fieldlens.operators import tracklets as T
from fieldlens.operators import windows as WN
from fieldlens.operators.scan import frame_block
from fieldlens.plans import detection_queries as D
from fieldlens.plans import sqlkit as Q
from fieldlens.plans.registry import query
from fieldlens.sources import views as V


def rounded(df, *names):
    for n in names:
        df = df.withColumn(n, r4(n))
    return df


# ---------------------------------------------------------------- metrics and status
_DOT = lambda a, b: f"({a}.x*{b}.x+{a}.y*{b}.y+{a}.z*{b}.z)"
_CROSS = lambda a, b: " + ".join(f"pow({a}.{i}*{b}.{j}-{a}.{j}*{b}.{i},2)" for i, j in ("yz", "zx", "xy"))
# the acos of a dot product loses small angles; this form does not
_ANG = lambda a, b: f"degrees(atan2(sqrt({_CROSS(a, b)}), {_DOT(a, b)}))"
VEC_SQL = "SELECT *, {'x': cos(radians(pitch))*sin(radians(yaw)), 'y': sin(radians(pitch)), 'z': cos(radians(pitch))*cos(radians(yaw))} AS v FROM v_track_obs"
STEP_SQL = """SELECT *, lag(v,1) OVER w AS p1, lag(v,2) OVER w AS p2, lag(frame,1) OVER w AS f1, lag(frame,2) OVER w AS f2
  FROM vec WINDOW w AS (PARTITION BY clip_id, tracklet_id ORDER BY frame)"""


def _dir(a, b, name):
    """tangent direction at a towards b, zero when they coincide"""
    d = {c: f"({b}.{c}-{a}.{c})" for c in "xyz"}
    along = f"({d['x']}*{a}.x+{d['y']}*{a}.y+{d['z']}*{a}.z)"
    return ", ".join(f"{d[c]} - {along}*{a}.{c} AS {name}{c}" for c in "xyz")


DIR_SQL = f"SELECT *, {_dir('p2', 'p1', 'k')}, {_dir('p1', 'v', 'c')} FROM step"
MOT_SQL = f"""SELECT *, CASE WHEN p1 IS NULL THEN NULL ELSE {_ANG('p1', 'v')} END AS step_deg,
    CASE WHEN p2 IS NULL THEN NULL WHEN nk < 1e-9 THEN 0e0 ELSE {_ANG('p2', 'p1')}/(f1-f2) END AS speed,
    CASE WHEN p1 IS NULL THEN NULL WHEN nc < 1e-9 THEN 0e0 ELSE {_ANG('p1', 'v')}/(frame-f1) END AS speed_cur
  FROM (SELECT *, sqrt(kx*kx+ky*ky+kz*kz) AS nk, sqrt(cx*cx+cy*cy+cz*cz) AS nc FROM dirs)"""
PRED_SQL = f"""SELECT *, CASE WHEN speed > 1e-9 THEN radians(speed*(frame-f1)) END AS ang, kx/nk AS ux, ky/nk AS uy, kz/nk AS uz FROM mot"""
PRED2_SQL = """SELECT *, CASE WHEN ang IS NULL THEN p1.x ELSE p1.x*cos(ang)+(uy*p1.z-uz*p1.y)*sin(ang)+ux*(ux*p1.x+uy*p1.y+uz*p1.z)*(1-cos(ang)) END AS qx,
    CASE WHEN ang IS NULL THEN p1.y ELSE p1.y*cos(ang)+(uz*p1.x-ux*p1.z)*sin(ang)+uy*(ux*p1.x+uy*p1.y+uz*p1.z)*(1-cos(ang)) END AS qy,
    CASE WHEN ang IS NULL THEN p1.z ELSE p1.z*cos(ang)+(ux*p1.y-uy*p1.x)*sin(ang)+uz*(ux*p1.x+uy*p1.y+uz*p1.z)*(1-cos(ang)) END AS qz FROM pred"""
TERM_SQL = """SELECT *, CASE WHEN p1 IS NULL THEN NULL ELSE degrees(acos(greatest(-1e0,least(1e0,(qx*v.x+qy*v.y+qz*v.z)/sqrt(qx*qx+qy*qy+qz*qz))))) END AS residual_deg,
    CASE WHEN speed > 1e-9 THEN CASE WHEN speed_cur > 1e-9 THEN greatest(0e0,least(1e0,(kx*cx+ky*cy+kz*cz)/(nk*nc))) ELSE 0e0 END END AS vel_sim FROM pred2"""
METRIC_SQL = f"""SELECT m.*, CASE WHEN observation_count<=1 THEN 0e0 ELSE sp END AS spatial_spread_deg,
    observation_count/CAST(span_frames AS DOUBLE) AS coverage_ratio,
    CASE WHEN observation_count<=1 THEN 0e0 ELSE {_ANG('first_v', 'last_v')} END AS net_displacement_deg,
    CASE WHEN end_frame>start_frame THEN path_length_deg/(end_frame-start_frame) ELSE 0e0 END AS mean_velocity
  FROM (SELECT clip_id, tracklet_id, min(frame) AS start_frame, max(frame) AS end_frame, max(frame)-min(frame)+1 AS span_frames, count(*) AS observation_count,
          greatest(coalesce(max(frame-f1-1),0),0) AS max_internal_gap, avg(weighted_conf) AS mean_weighted_conf, coalesce(avg(residual_deg),0e0) AS mean_prediction_residual,
          coalesce(avg(vel_sim),0e0) AS velocity_consistency, coalesce(sum(step_deg),0e0) AS path_length_deg, arg_min(v, frame) AS first_v, arg_max(v, frame) AS last_v
        FROM term GROUP BY ALL) m
  JOIN (SELECT o.clip_id, o.tracklet_id, avg(degrees(acos(greatest(-1e0,least(1e0,(o.v.x*mx+o.v.y*my+o.v.z*mz)/n))))) AS sp
        FROM vec o JOIN (SELECT clip_id, tracklet_id, mx, my, mz, sqrt(mx*mx+my*my+mz*mz) AS n FROM
            (SELECT clip_id, tracklet_id, avg(v.x) mx, avg(v.y) my, avg(v.z) mz FROM vec GROUP BY ALL)) c ON c.clip_id=o.clip_id AND c.tracklet_id=o.tracklet_id
        GROUP BY ALL) s ON s.clip_id=m.clip_id AND s.tracklet_id=m.tracklet_id"""
MET = dict(vec=VEC_SQL, step=STEP_SQL, dirs=DIR_SQL, mot=MOT_SQL, pred=PRED_SQL, pred2=PRED2_SQL, term=TERM_SQL, metric=METRIC_SQL)
# observations inside a confirmed static region
STATIC_OBS_SQL = f"""SELECT o.clip_id, o.tracklet_id, count(r.region_rank)/CAST(count(*) AS DOUBLE) AS static_frac FROM
  (SELECT o.clip_id, o.tracklet_id, o.frame, min(region_rank) AS region_rank FROM v_track_obs o
   LEFT JOIN regions r ON r.clip_id=o.clip_id AND r.peak_duty>=0.35e0 AND {Q.gc('o.yaw', 'o.pitch', 'r.centre_yaw', 'r.centre_pitch')} <= r.radius_deg + {Q.TOL} GROUP BY ALL) r
  JOIN v_track_obs o ON o.clip_id=r.clip_id AND o.tracklet_id=r.tracklet_id AND o.frame=r.frame GROUP BY ALL"""
STATUS_SQL = """SELECT *, CASE WHEN rejected THEN 'rejected_static'
      WHEN observation_count BETWEEN 2 AND 10 AND mean_velocity>=1.5e0 AND net_displacement_deg BETWEEN 5e0 AND 60e0 AND spatial_spread_deg>=2e0 AND mean_weighted_conf>=0.2e0 THEN 'flight_anchor'
      WHEN observation_count<4 THEN 'fragment'
      WHEN observation_count>=8 AND mean_weighted_conf>=0.2e0 AND coverage_ratio>=0.5e0 AND strength>=0.55e0 THEN 'anchor' ELSE 'passing' END AS status
  FROM (SELECT *, CASE WHEN observation_count>=4 AND NOT rejected THEN CASE WHEN suspect THEN least(raw,0.4e0) ELSE raw END END AS strength,
          CASE WHEN observation_count>=4 AND NOT rejected THEN least(1e0,mean_weighted_conf/0.6e0)*0.35e0+coverage_ratio*0.25e0+least(1e0,1e0-mean_prediction_residual/15e0)*0.2e0+velocity_consistency*0.2e0 END AS best
    FROM (SELECT *, NOT rejected AND static_frac>=0.5e0 AND secondary>=1 AS suspect,
            least(1e0,mean_weighted_conf/0.6e0)*0.3e0+least(1e0,coverage_ratio)*0.2e0+least(1e0,observation_count/30e0)*0.15e0+(1e0-least(1e0,mean_prediction_residual/15e0))*0.15e0
              +velocity_consistency*0.1e0+(CASE WHEN net_displacement_deg>=3e0 AND mean_velocity>=0.1e0 THEN 1e0 WHEN net_displacement_deg>=3e0 OR mean_velocity>=0.1e0 THEN 0.5e0 ELSE 0e0 END)*0.1e0 AS raw
      FROM (SELECT *, static_frac>=0.7e0 AND secondary>=2 AS rejected FROM
        (SELECT m.*, static_frac, CAST(net_displacement_deg<2e0 AS INT)+CAST(spatial_spread_deg<1.5e0 AS INT)+CAST(span_frames>=20 AND coverage_ratio>=0.6e0 AS INT) AS secondary
         FROM metric m JOIN static_obs s ON s.clip_id=m.clip_id AND s.tracklet_id=m.tracklet_id))))"""
STAT = dict(D.HOT_CTES, **MET, static_obs=STATIC_OBS_SQL, tracklets=STATUS_SQL)
METRIC_COLS = ["coverage_ratio", "mean_weighted_conf", "mean_prediction_residual", "velocity_consistency", "net_displacement_deg", "spatial_spread_deg", "path_length_deg", "mean_velocity"]


def scored_tracklets(spark, sf):
    _, regions = D.hot_map(spark, sf)
    return T.tracklet_status(T.tracklet_metrics(T.mark_static(V.track_obs(spark, sf), regions, D.HOT.duty_cycle_threshold)))


@query(
    "tracklet_metrics", "AGG-4",
    Q.sql(["v_track_obs"], f"""SELECT clip_id, tracklet_id, start_frame, end_frame, span_frames, observation_count, max_internal_gap,
  {', '.join(f'{Q.r4(c)} AS {c}' for c in METRIC_COLS)} FROM metric""", **MET),
)
def tracklet_metrics(spark, sf):
    m = T.tracklet_metrics(V.track_obs(spark, sf))
    return rounded(m.select("clip_id", "tracklet_id", "start_frame", "end_frame", "span_frames", "observation_count", "max_internal_gap", *METRIC_COLS), *METRIC_COLS)


@query(
    "tracklet_status", "AGG-5",
    Q.sql(["v_track_obs", "v_frames"], f"""SELECT clip_id, tracklet_id, status, suspect AS static_suspect, {Q.r4('static_frac')} AS static_frac,
  {Q.r4('strength')} AS anchor_strength, {Q.r4('best')} AS best_available_score FROM tracklets""", **STAT),
)
def tracklet_status(spark, sf):
    t = scored_tracklets(spark, sf).select("clip_id", "tracklet_id", "status", "static_suspect", "static_frac", "anchor_strength", "best_available_score")
    return rounded(t, "static_frac", "anchor_strength", "best_available_score")


AUDIT_SQL = f"""SELECT b.*, {_ANG('va', 'vb')} AS net_raw, coalesce(mad,0e0) AS mad FROM
   (SELECT clip_id, tracklet_id, count(*) AS obs_count, max(frame)-min(frame)+1 AS span_frames, arg_min(v, frame) AS va, arg_max(v, frame) AS vb,
      coalesce(sum(step_deg),0e0) AS path, count(*) FILTER (frame-f1-1>0) AS gap_count, coalesce(quantile_cont(step_deg,0.5),0e0) AS med, coalesce(quantile_cont(step_deg,0.9),0e0) AS p90
    FROM mot GROUP BY ALL) b JOIN
   (SELECT o.clip_id, o.tracklet_id, quantile_cont({Q.gc('o.yaw', 'o.pitch', 'my', 'mp')}, 0.5) AS mad FROM v_track_obs o JOIN
      (SELECT clip_id, tracklet_id, quantile_cont(yaw,0.5) my, quantile_cont(pitch,0.5) mp FROM v_track_obs GROUP BY ALL) m ON m.clip_id=o.clip_id AND m.tracklet_id=o.tracklet_id GROUP BY ALL) q
   ON q.clip_id=b.clip_id AND q.tracklet_id=b.tracklet_id"""
AUD = dict(vec=VEC_SQL, step=STEP_SQL, dirs=DIR_SQL, mot=MOT_SQL, aud=AUDIT_SQL)


@query(
    "static_motion_audit", "AGG-6",
    Q.sql(["v_track_obs"], f"""SELECT clip_id, tracklet_id, obs_count, span_frames, gap_count, {Q.r4('net')} AS net_disp_deg, {Q.r4('path')} AS path_length_deg,
  {Q.r4('med')} AS median_step_deg, {Q.r4('p90')} AS p90_step_deg, {Q.r4('mad')} AS spread_mad_deg, {Q.r4('gap_count/CAST(greatest(1,span_frames) AS DOUBLE)')} AS gap_fraction,
  nfail=0 AS would_reject, nfail=1 AS borderline
FROM (SELECT *, CAST(obs_count<12 AS INT)+CAST(span_frames<20 AS INT)+CAST(net>=1.5e0 AS INT)+CAST(mad>=0.6e0 AS INT)+CAST(p90>=0.25e0 AS INT) AS nfail
      FROM (SELECT *, CASE WHEN obs_count>1 THEN net_raw ELSE 0e0 END AS net FROM aud))""", **AUD),
)
def static_motion_audit(spark, sf):
    a = T.motion_audit(V.track_obs(spark, sf))
    cols = ["net_disp_deg", "path_length_deg", "median_step_deg", "p90_step_deg", "spread_mad_deg", "gap_fraction"]
    return rounded(a.select("clip_id", "tracklet_id", "obs_count", "span_frames", "gap_count", *cols, "would_reject", "borderline"), *cols)


@query(
    "observation_features", "AGG-7",
    Q.sql(["v_track_obs"], f"""SELECT clip_id, tracklet_id, {Q.r4('avg(sqrt(bbox_area_px*bbox_aspect_ratio))')} AS width_mean, {Q.r4('max(sqrt(bbox_area_px*bbox_aspect_ratio))')} AS width_max, {Q.r4('avg(sqrt(bbox_area_px/bbox_aspect_ratio))')} AS height_mean,
  {Q.r4('avg(bbox_area_px)')} AS area_mean, {Q.r4('avg(bbox_aspect_ratio)')} AS aspect_mean, {Q.r4('max(bbox_aspect_ratio)')} AS aspect_max,
  {Q.r4('avg(weighted_conf)')} AS conf_mean, {Q.r4('stddev_pop(weighted_conf)')} AS conf_std, {Q.r4('avg(step)')} AS step_mean, {Q.r4('max(step)')} AS step_max, {Q.r4('stddev_pop(step)')} AS step_std,
  {Q.r4('count(bbox_area_px)/CAST(count(*) AS DOUBLE)')} AS geo_coverage
FROM (SELECT *, sqrt(pow(yaw-lag(yaw) OVER w,2)+pow(pitch-lag(pitch) OVER w,2)) AS step FROM v_track_obs WINDOW w AS (PARTITION BY clip_id, tracklet_id ORDER BY frame)) GROUP BY ALL"""),
)
def observation_features(spark, sf):
    f = T.feature_stats(V.track_obs(spark, sf))
    return rounded(f, *[c for c in f.columns if c not in ("clip_id", "tracklet_id")])


# ---------------------------------------------------------------- linker (sequential: no SQL form)
@query("linked_tracklets", "TRK-1")
def linked_tracklets(spark, sf):
    det = V.detections(spark, sf).withColumn("weighted_conf", F.col("raw_conf"))
    rows = L.link_tracklets(det, V.dense_frames(det), LinkConfig())
    return rows.select("clip_id", "tracklet_id", "frame", "det_id", r4("weighted_conf").alias("weighted_conf"), r4("score").alias("score"),
                       F.size("alternates").alias("n_alternates"))


@query("held_still_flags", "TRK-2 FLT-6")
def held_still_flags(spark, sf):
    det = V.detections(spark, sf)
    x, y = geo.yaw_pitch_to_equirect("yaw", "pitch", geo.lit(3840.0), geo.lit(1920.0))
    blobs = det.select("clip_id", "frame", "det_id", x.alias("x"), y.alias("y"), F.expr("4e0 + det_id % 9").alias("w"), F.expr("2e0 + det_id % 4").alias("h"))
    return L.held_still_flags(blobs, 3840.0, 12.0, 4).select("clip_id", "frame", "det_id", "chain_len", "static_suspect", "wide_flat_suspect")


# ---------------------------------------------------------------- gaps
_GAPS = """SELECT clip_id, 0 AS start_frame, coalesce(first_start-1, last) AS end_frame, 'before_first_anchor' AS gap_type, CAST(NULL AS BIGINT) AS pre_anchor_id, first_id AS post_anchor_id FROM
    (SELECT r.clip_id, last, arg_min(tracklet_id, {'a': start_frame, 'b': tracklet_id}) AS first_id, min(start_frame) AS first_start
     FROM (SELECT clip_id, max(frame) AS last FROM v_frames GROUP BY 1) r LEFT JOIN anchors a ON a.clip_id=r.clip_id GROUP BY r.clip_id, last)
  UNION ALL
  SELECT a.clip_id, end_frame+1, coalesce(nstart-1, last), CASE WHEN nid IS NULL THEN 'after_last_anchor' ELSE 'between_anchors' END, tracklet_id, nid FROM
    (SELECT *, lead(start_frame) OVER w AS nstart, lead(tracklet_id) OVER w AS nid FROM anchors WINDOW w AS (PARTITION BY clip_id ORDER BY start_frame, tracklet_id)) a
    JOIN (SELECT clip_id, max(frame) AS last FROM v_frames GROUP BY 1) r ON r.clip_id=a.clip_id"""
# Stretches of reused detections act as tracklets, so that gaps exist.
PIECES = "SELECT clip_id, frame//20 AS tracklet_id, frame, det_id, yaw, pitch, weighted_conf, source, bbox_area_px, bbox_aspect_ratio FROM v_track_obs WHERE source='stage0_reuse'"
GAP_ANCHORS = """SELECT clip_id, tracklet_id, min(frame) AS start_frame, max(frame) AS end_frame, avg(weighted_conf) AS best,
    CASE WHEN tracklet_id%3=0 THEN 'passing' WHEN count(*)<4 THEN 'fragment' WHEN tracklet_id%7=0 THEN 'rejected_static' ELSE 'anchor' END AS status FROM pieces GROUP BY clip_id, tracklet_id"""
GAP = dict(pieces=PIECES, tk=GAP_ANCHORS, anchors="SELECT * FROM tk WHERE status='anchor'", gaps_all=_GAPS, gaps="SELECT *, end_frame-start_frame+1 AS span_frames FROM gaps_all WHERE start_frame<=end_frame")


def gap_inputs(spark, sf):
    obs = V.track_obs(spark, sf).filter("source = 'stage0_reuse'").withColumn("tracklet_id", F.expr("frame div 20"))
    tk = obs.groupBy("clip_id", "tracklet_id").agg(
        F.min("frame").alias("start_frame"), F.max("frame").alias("end_frame"), F.avg("weighted_conf").alias("best_available_score"), F.count(F.lit(1)).alias("n"))
    status = F.when(F.expr("tracklet_id % 3 = 0"), "passing").when(F.col("n") < 4, "fragment").when(F.expr("tracklet_id % 7 = 0"), "rejected_static").otherwise("anchor")
    frames = V.dense_frames(V.detections(spark, sf))
    clip = frames.groupBy("clip_id").agg(F.min("frame").alias("first"), F.max("frame").alias("last"))
    return tk.withColumn("status", status), clip, frames


@query(
    "anchor_gaps", "WIN-2",
    Q.sql(["v_track_obs", "v_frames"], "SELECT clip_id, start_frame, end_frame, gap_type, pre_anchor_id, post_anchor_id, span_frames FROM gaps", **GAP),
)
def anchor_gaps(spark, sf):
    tk, clip, _ = gap_inputs(spark, sf)
    return T.anchor_gaps(tk, clip)


_EV = """SELECT g.clip_id, g.start_frame, g.end_frame, count(*) FILTER (sup) AS support_coverage_frames, coalesce(sum(res),0) AS n_res, coalesce(sum(res_static),0) AS n_static
  FROM gaps g LEFT JOIN (SELECT clip_id, frame, bool_or(raw_conf>=0.1e0) AS sup, count(*) FILTER (raw_conf<0.1e0) AS res, count(*) FILTER (raw_conf<0.1e0 AND lab IS NOT NULL) AS res_static FROM cd GROUP BY ALL) c
  ON c.clip_id=g.clip_id AND c.frame BETWEEN g.start_frame AND g.end_frame GROUP BY ALL"""
_DOM = """SELECT clip_id, start_frame, end_frame, arg_max(lab, {'a': k, 'b': -ff, 'c': lab}) AS dominant FROM
  (SELECT g.clip_id, start_frame, end_frame, lab, count(*) AS k, min(frame) AS ff FROM gaps g JOIN cd c ON c.clip_id=g.clip_id AND c.frame BETWEEN start_frame AND end_frame WHERE raw_conf<0.1e0 AND lab IS NOT NULL GROUP BY ALL) GROUP BY ALL"""
_CMP = """SELECT g.clip_id, g.start_frame, g.end_frame, count(t.tracklet_id) AS competing, count(*) FILTER (t.status='rejected_static') AS rejected, max(t.best) AS best
  FROM gaps g LEFT JOIN (SELECT * FROM tk WHERE status<>'anchor') t ON t.clip_id=g.clip_id AND t.start_frame<=g.end_frame AND t.end_frame>=g.start_frame GROUP BY ALL"""


@query(
    "gap_evidence", "AGG-13 JOIN-7 JOIN-8",
    Q.sql(["v_track_obs", "v_frames"], f"""SELECT g.clip_id, g.start_frame, g.end_frame, g.gap_type, g.pre_anchor_id, g.post_anchor_id, g.span_frames, e.support_coverage_frames,
  CASE WHEN rejected>0 THEN 'static_hotspot_tracklet_rejected' WHEN competing>1 THEN 'ambiguous_competing_candidates' WHEN competing=1 THEN 'insufficient_tracklet_score'
       WHEN n_res>0 THEN 'reserve_only' ELSE 'no_candidates_after_stage1' END AS gap_reason,
  n_res>0 AS reserve_candidates_present, CAST(n_res AS BIGINT) AS reserve_candidate_count, n_res>=3 AND n_static/n_res>0.6 AS dominant_reserve_static,
  CASE WHEN n_res>=3 AND n_static/n_res>0.6 THEN dominant END AS dominant_region, competing AS competing_tracklet_count, {Q.r4('best')} AS best_available_score
FROM gaps g JOIN ev e USING (clip_id, start_frame, end_frame) JOIN cmp USING (clip_id, start_frame, end_frame) LEFT JOIN dom USING (clip_id, start_frame, end_frame)""",
          **GAP, cd="SELECT clip_id, frame, raw_conf, CASE WHEN obj_id%3=1 THEN 'R' || CAST(obj_id AS VARCHAR) END AS lab FROM v_detections", ev=_EV, dom=_DOM, cmp=_CMP),
)
def gap_evidence(spark, sf):
    tk, clip, _ = gap_inputs(spark, sf)
    gaps = T.anchor_gaps(tk, clip)
    cand = V.detections(spark, sf).select(
        "clip_id", "frame", F.col("raw_conf").alias("weighted_conf"),
        F.when(F.expr("obj_id % 3 = 1"), F.concat(F.lit("R"), F.col("obj_id").cast("string"))).alias("in_static"))
    return rounded(T.gap_evidence(gaps, cand, tk), "best_available_score")


# ---------------------------------------------------------------- loss windows and repair
LOSS_IN = "SELECT * FROM v_detections WHERE source='stage0_reuse'"
LOSS_SQL = """SELECT *, 'W' || lpad(CAST(row_number() OVER (PARTITION BY clip_id ORDER BY start_frame) AS VARCHAR), 4, '0') AS window_id,
    CASE WHEN b IS NULL THEN 'isolated' WHEN a IS NULL THEN 'open' ELSE 'bridgeable' END AS status FROM (
  SELECT clip_id, island, min(frame) AS start_frame, max(frame) AS end_frame, count(*) AS duration_frames, any_value(b) AS b, any_value(a) AS a FROM (
    SELECT *, count(pt) OVER (PARTITION BY clip_id ORDER BY frame ROWS UNBOUNDED PRECEDING) AS island,
      last_value(pt IGNORE NULLS) OVER (PARTITION BY clip_id ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b,
      first_value(pt IGNORE NULLS) OVER (PARTITION BY clip_id ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a
    FROM (SELECT f.clip_id, f.frame, t.pt FROM v_frames f LEFT JOIN
      (SELECT clip_id, frame, arg_max({'frame': frame, 'yaw': yaw, 'pitch': pitch}, {'c': raw_conf, 'd': -det_id}) AS pt FROM loss_in WHERE raw_conf>=0.15e0 GROUP BY ALL) t USING (clip_id, frame)))
  WHERE pt IS NULL GROUP BY ALL)"""


def loss_inputs(spark, sf):
    det = V.with_geometry(V.detections(spark, sf))
    # the object is seen where detections are reused, and lost between
    return det.filter("source = 'stage0_reuse'"), V.dense_frames(det)


@query(
    "loss_windows", "WIN-1",
    Q.sql(["v_detections", "v_frames"], f"""SELECT clip_id, window_id, start_frame, end_frame, duration_frames, b.frame AS last_trusted_frame, {Q.r4('b.yaw')} AS last_trusted_yaw,
  {Q.r4('b.pitch')} AS last_trusted_pitch, a.frame AS first_reacq_frame, {Q.r4('a.yaw')} AS first_reacq_yaw, {Q.r4('a.pitch')} AS first_reacq_pitch, status FROM losses""",
          loss_in=LOSS_IN, losses=LOSS_SQL),
)
def loss_windows(spark, sf):
    cand, frames = loss_inputs(spark, sf)
    w = WN.loss_windows(frames, cand, conf="raw_conf")
    return rounded(w, "last_trusted_yaw", "last_trusted_pitch", "first_reacq_yaw", "first_reacq_pitch")


def repaired(spark, sf):
    cand, frames = loss_inputs(spark, sf)
    windows = WN.loss_windows(frames, cand, conf="raw_conf")
    # every detection of the clip may support a trace, not only those of the object
    return R.repair_windows(windows, V.with_geometry(V.detections(spark, sf)), RepairConfig(), conf="raw_conf")


@query("window_repairs", "TRK-5")
def window_repairs(spark, sf):
    return rounded(repaired(spark, sf)["repairs"], "agreement_deg", "yaw", "pitch", "weighted_conf")


@query("review_queue", "TRK-5 TOP-3")
def review_queue(spark, sf):
    out = repaired(spark, sf)
    n = out["review"].groupBy("clip_id", "window_id").agg(F.count(F.lit(1)).alias("review_frames"))
    return out["queue"].join(n, ["clip_id", "window_id"], "left").na.fill(0, ["review_frames"])


@query("repair_summary", "SET-2")
def repair_summary(spark, sf):
    return R.repair_summary(repaired(spark, sf))


@query("backward_paths", "TRK-6")
def backward_paths(spark, sf):
    det = V.detections(spark, sf)
    anchors = V.track_obs(spark, sf).filter("source = 'stage0_reuse'").select("clip_id", F.col("det_id").alias("anchor_id"), "frame", "yaw", "pitch")
    return rounded(R.propagate_backward(anchors, det, conf="raw_conf"), "yaw", "pitch", "score")


REVIEW_ITEMS = "SELECT clip_id, 'W' || CAST(frame//30 AS VARCHAR) AS window_id, frame, max(raw_conf) AS conf FROM v_detections GROUP BY ALL"


@query(
    "capped_review_frames", "TOP-3",
    Q.sql(["v_detections"], f"""SELECT clip_id, window_id, frame, {Q.r4('conf')} AS conf FROM items QUALIFY row_number() OVER (PARTITION BY clip_id, window_id ORDER BY conf DESC, frame) <= 12""", items=REVIEW_ITEMS),
)
def capped_review_frames(spark, sf):
    items = V.detections(spark, sf).groupBy("clip_id", F.concat(F.lit("W"), F.expr("cast(frame div 30 as string)")).alias("window_id"), "frame").agg(F.max("raw_conf").alias("conf"))
    return rounded(R.cap_review_frames(items, 12), "conf")


# ---------------------------------------------------------------- merges
REP = "SELECT clip_id, frame, det_id AS seq, yaw+0.5e0 AS yaw, pitch, raw_conf AS weighted_conf, CASE WHEN det_id%5=0 THEN NULL ELSE 'bidirectional' END AS source FROM v_detections WHERE det_id%11=0"
DEC = "SELECT clip_id, frame, det_id AS seq, CASE WHEN det_id%2=0 THEN yaw END AS yaw, pitch+1e0 AS pitch, raw_conf AS weighted_conf, CASE WHEN det_id%3=0 THEN 'unclear' ELSE 'ball' END AS decision FROM v_detections WHERE det_id%13=0"


def merge_inputs(spark, sf):
    det = V.detections(spark, sf)
    rep = det.filter("det_id % 11 = 0").select("clip_id", "frame", F.col("det_id").alias("seq"), (F.col("yaw") + 0.5).alias("yaw"), "pitch", F.col("raw_conf").alias("weighted_conf"),
                                               F.expr("case when det_id % 5 = 0 then null else 'bidirectional' end").alias("source"))
    dec = det.filter("det_id % 13 = 0").select("clip_id", "frame", F.col("det_id").alias("seq"), F.expr("case when det_id % 2 = 0 then yaw end").alias("yaw"), (F.col("pitch") + 1.0).alias("pitch"),
                                               F.col("raw_conf").alias("weighted_conf"), F.expr("case when det_id % 3 = 0 then 'unclear' else 'ball' end").alias("decision"))
    return det, rep, dec


@query(
    "override_merge", "JOIN-10",
    Q.sql(["v_detections"], f"""SELECT clip_id, frame, {Q.r4('yaw')} AS yaw, {Q.r4('pitch')} AS pitch, {Q.r4('weighted_conf')} AS weighted_conf, origin FROM (
  SELECT *, max(lv) OVER (PARTITION BY clip_id, frame) AS top, row_number() OVER (PARTITION BY clip_id, frame, lv ORDER BY seq DESC) AS rk FROM (
    SELECT clip_id, frame, yaw, pitch, raw_conf AS weighted_conf, 'base' AS origin, 0 AS lv, det_id AS seq FROM v_detections
    UNION ALL SELECT clip_id, frame, yaw, pitch, weighted_conf, 'bidirectional', 1, seq FROM rep
    UNION ALL SELECT clip_id, frame, yaw, pitch, weighted_conf, 'decision', 2, seq FROM dec WHERE decision='ball' AND yaw IS NOT NULL))
WHERE lv=top AND (lv=0 OR rk=1)""", rep=REP, dec=DEC),
)
def override_merge(spark, sf):
    det, rep, dec = merge_inputs(spark, sf)
    m = M.merge_tracking(det.withColumn("weighted_conf", F.col("raw_conf")), rep, dec)
    return rounded(m.select("clip_id", "frame", "yaw", "pitch", "weighted_conf", "origin"), "yaw", "pitch", "weighted_conf")


TRK_T = "SELECT clip_id, frame, yaw, pitch, CASE WHEN weighted_conf>=0.5e0 THEN weighted_conf END AS best_score FROM v_track_obs QUALIFY row_number() OVER (PARTITION BY clip_id, frame ORDER BY weighted_conf DESC, det_id)=1"
VALID = "SELECT clip_id, frame, arg_max({'yaw': yaw, 'pitch': pitch, 'wc': weighted_conf, 'source': source}, seq) AS r FROM rep WHERE source IS NOT NULL GROUP BY ALL"


def replay_inputs(spark, sf):
    tr = V.strongest(V.track_obs(spark, sf)).select(
        "clip_id", "frame", "yaw", "pitch", F.when(F.col("weighted_conf") >= 0.5, F.col("weighted_conf")).alias("best_score"), F.lit("TRACKING").alias("tracker_state"))
    return tr, merge_inputs(spark, sf)[1]


@query(
    "replayed_repairs", "JOIN-11",
    Q.sql(["v_track_obs"], f"""SELECT t.clip_id, t.frame, {Q.r4('CASE WHEN h THEN v.r.yaw ELSE yaw END')} AS yaw, {Q.r4('CASE WHEN h THEN v.r.pitch ELSE pitch END')} AS pitch,
  {Q.r4('CASE WHEN h THEN v.r.wc ELSE best_score END')} AS best_score, h AS overridden, CASE WHEN h THEN 'phase_b_repair' END AS loss_state
FROM (SELECT t.*, v.r IS NOT NULL AND best_score IS NULL AS h FROM tr t LEFT JOIN valid v USING (clip_id, frame)) t LEFT JOIN valid v USING (clip_id, frame)""", rep=REP, tr=TRK_T, valid=VALID),
)
def replayed_repairs(spark, sf):
    tr, rep = replay_inputs(spark, sf)
    return rounded(M.replay_repairs(tr, rep).drop("tracker_state", "override_source"), "yaw", "pitch", "best_score")


@query(
    "replay_outcomes", "JOIN-11 SET-2",
    Q.sql(["v_track_obs"], """SELECT clip_id, count(t) AS tracking_frames, count(r) AS valid_repairs, count(*) FILTER (t IS NOT NULL AND r IS NOT NULL AND best_score IS NULL) AS overrides_applied,
  count(*) FILTER (t IS NOT NULL AND r IS NOT NULL AND best_score IS NOT NULL) AS skipped_confirmed, count(*) FILTER (t IS NULL) AS repairs_not_found
FROM (SELECT *, 1 AS t FROM tr) FULL JOIN valid USING (clip_id, frame) GROUP BY clip_id""", rep=REP, tr=TRK_T, valid=VALID),
)
def replay_outcomes(spark, sf):
    return M.replay_summary(*replay_inputs(spark, sf))


KEYF = "SELECT clip_id, frame, arg_max({'yaw': yaw, 'pitch': pitch, 'id': tracklet_id, 'score': weighted_conf}, {'c': weighted_conf, 'd': -det_id}) AS k FROM v_track_obs WHERE source='stage0_reuse' GROUP BY ALL"


@query(
    "dense_track", "WIN-3",
    Q.sql(["v_track_obs", "v_frames"], f"""SELECT clip_id, frame, {Q.r4('CASE WHEN k IS NOT NULL THEN k.yaw WHEN br THEN p.yaw+t*(y1-p.yaw) ELSE coalesce(p.yaw,0e0) END')} AS yaw,
  {Q.r4('CASE WHEN k IS NOT NULL THEN k.pitch WHEN br THEN p.pitch+t*(n.pitch-p.pitch) ELSE coalesce(p.pitch,0e0) END')} AS pitch, {Q.r4('k.score')} AS best_score,
  CASE WHEN k IS NOT NULL THEN 'TRACKING' ELSE 'LOST' END AS tracker_state,
  CASE WHEN k IS NOT NULL THEN CAST(k.id AS VARCHAR) WHEN br THEN 'interp(' || CAST(p.id AS VARCHAR) || '->' || CAST(n.id AS VARCHAR) || ')' END AS source_tracklet
FROM (SELECT *, coalesce(k IS NULL AND nf-pf<=12,false) AS br, (frame-pf)/CAST(nf-pf AS DOUBLE) AS t, n.yaw + CASE WHEN n.yaw-p.yaw>180 THEN -360e0 WHEN n.yaw-p.yaw<-180 THEN 360e0 ELSE 0e0 END AS y1 FROM (
  SELECT clip_id, frame, k, last_value(k IGNORE NULLS) OVER b AS p, last_value(CASE WHEN k IS NOT NULL THEN frame END IGNORE NULLS) OVER b AS pf,
         first_value(k IGNORE NULLS) OVER a AS n, first_value(CASE WHEN k IS NOT NULL THEN frame END IGNORE NULLS) OVER a AS nf
  FROM v_frames LEFT JOIN kf USING (clip_id, frame)
  WINDOW b AS (PARTITION BY clip_id ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY clip_id ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)))""", kf=KEYF),
)
def dense_track(spark, sf):
    obs = V.track_obs(spark, sf).filter("source = 'stage0_reuse'").groupBy("clip_id", "frame").agg(
        F.max_by(F.struct("yaw", "pitch", F.col("weighted_conf").alias("score"), "tracklet_id"), F.struct(F.col("weighted_conf"), -F.col("det_id"))).alias("k")).select("clip_id", "frame", "k.*")
    d = WN.dense_track(obs, V.dense_frames(V.detections(spark, sf)), 12)
    return rounded(d, "yaw", "pitch", "best_score")


# ---------------------------------------------------------------- joins
@query(
    "geometry_by_coordinates", "JOIN-1",
    Q.sql(["v_track_obs"], """SELECT clip_id, count(*) AS total_observations, count(*) FILTER (g IS NOT NULL) AS geometry_matched, count(*) FILTER (g.a IS NOT NULL) AS geometry_populated
FROM v_track_obs o LEFT JOIN (SELECT clip_id, frame, CAST(round(yaw*1e4) AS BIGINT) AS ky, CAST(round(pitch*1e4) AS BIGINT) AS kp, arg_max(CASE WHEN det_id%50<>0 THEN {'a': bbox_area_px} END, det_id) FILTER (TRUE) AS g0,
   arg_max({'g': CASE WHEN det_id%50<>0 THEN {'a': bbox_area_px} END}, det_id).g AS g FROM v_detections GROUP BY ALL) d
 ON d.clip_id=o.clip_id AND d.frame=o.frame AND d.ky=CAST(round(o.yaw*1e4) AS BIGINT) AND d.kp=CAST(round(o.pitch*1e4) AS BIGINT) GROUP BY o.clip_id""".replace("SELECT clip_id, count(*) AS total", "SELECT o.clip_id, count(*) AS total").replace(
        "arg_max(CASE WHEN det_id%50<>0 THEN {'a': bbox_area_px} END, det_id) FILTER (TRUE) AS g0,\n   ", "")),
)
def geometry_by_coordinates(spark, sf):
    j = J.attach_by_coordinates(V.track_obs(spark, sf), V.with_geometry(V.detections(spark, sf)), "detection_geometry", "det_id")
    return j.groupBy("clip_id").agg(F.count(F.lit(1)).alias("total_observations"), F.count_if("matched").alias("geometry_matched"),
                                    F.count("detection_geometry.bbox_area_px").alias("geometry_populated"))


@query(
    "near_point_pairs", "JOIN-3",
    Q.sql(["v_points"], f"""SELECT a.id AS a, b.id AS b, {Q.r4(Q.gc('a.yaw', 'a.pitch', 'b.yaw', 'b.pitch'))} AS dist FROM v_points a JOIN v_points b ON a.id<b.id
WHERE {Q.gc('a.yaw', 'a.pitch', 'b.yaw', 'b.pitch')} <= 5e0 + {Q.TOL}"""),
)
def near_point_pairs(spark, sf):
    return rounded(spatial.within_pairs(V.points(spark, sf), ["clip_id"], "id", 5.0).select("a", "b", "dist"), "dist")


@query(
    "point_components", "CLU-1",
    Q.sql(["v_points"], "SELECT dst AS id, min(src) AS comp FROM reach GROUP BY 1",
          lk=f"SELECT a.id AS a, b.id AS b FROM v_points a JOIN v_points b ON {Q.gc('a.yaw', 'a.pitch', 'b.yaw', 'b.pitch')} < 3e0 - {Q.TOL}",
          reach="SELECT id AS src, id AS dst FROM v_points UNION SELECT r.src, l.b FROM reach r JOIN lk l ON r.dst=l.a"),
)
def point_components(spark, sf):
    return spatial.spatial_components(V.points(spark, sf), ["clip_id"], "id", 3.0, strict=True).select("id", "comp")


@query(
    "tolerance_match", "JOIN-4 JOIN-6",
    Q.sql(["v_track_obs"], f"""SELECT o.clip_id, o.frame, o.det_id AS row_id, m.m_det_id, {Q.r4('m.dist')} AS match_dist FROM v_track_obs o LEFT JOIN (
  SELECT o.det_id, d.det_id AS m_det_id, {Q.gc('o.yaw+(o.det_id%4)*0.02e0', 'o.pitch', 'd.yaw', 'd.pitch')} AS dist FROM v_track_obs o JOIN v_detections d ON d.clip_id=o.clip_id AND d.frame=o.frame
  WHERE {Q.gc('o.yaw+(o.det_id%4)*0.02e0', 'o.pitch', 'd.yaw', 'd.pitch')} <= 0.03e0 + {Q.TOL}
  QUALIFY row_number() OVER (PARTITION BY o.det_id ORDER BY {Q.gc('o.yaw+(o.det_id%4)*0.02e0', 'o.pitch', 'd.yaw', 'd.pitch')}, d.det_id)=1) m ON m.det_id=o.det_id"""),
)
def tolerance_match(spark, sf):
    obs = V.track_obs(spark, sf).select("clip_id", "frame", F.col("det_id").alias("row_id"), F.expr("yaw + (det_id % 4) * 0.02e0").alias("yaw"), "pitch")
    j = J.nearest_in_frame(obs, V.detections(spark, sf), 0.03, "det_id", ["det_id"])
    return rounded(j.select("clip_id", "frame", "row_id", "m_det_id", "match_dist"), "match_dist")


@query(
    "interval_overlaps", "JOIN-7",
    Q.sql(["v_track_obs"], """SELECT a.clip_id, a.tracklet_id AS a, b.tracklet_id AS b, greatest(a.s, b.s) AS from_frame, least(a.e, b.e) AS to_frame
FROM sp a JOIN sp b ON a.clip_id=b.clip_id AND a.tracklet_id<b.tracklet_id AND a.s<=b.e AND a.e>=b.s""",
          sp="SELECT clip_id, tracklet_id*10+frame//20 AS tracklet_id, min(frame) AS s, max(frame) AS e FROM v_track_obs GROUP BY ALL"),
)
def interval_overlaps(spark, sf):
    sp = V.track_obs(spark, sf).groupBy("clip_id", F.expr("tracklet_id * 10 + frame div 20").alias("tracklet_id")).agg(F.min("frame").alias("s"), F.max("frame").alias("e"))
    l = sp.select("clip_id", F.col("tracklet_id").alias("a"), F.col("s").alias("s1"), F.col("e").alias("e1"))
    r = sp.select("clip_id", F.col("tracklet_id").alias("b"), F.col("s").alias("s2"), F.col("e").alias("e2"))
    return J.overlap_join(l, r, ["clip_id"], "s1", "e1", "s2", "e2", 16).filter("a < b").select(
        "clip_id", "a", "b", F.greatest("s1", "s2").alias("from_frame"), F.least("e1", "e2").alias("to_frame"))


@query(
    "best_in_interval", "JOIN-8",
    Q.sql(["v_track_obs"], f"""SELECT i.clip_id, i.lo, arg_max(o.det_id, {{'a': o.weighted_conf, 'b': -o.det_id}}) AS det_id, {Q.r4('max(o.weighted_conf)')} AS conf, count(*) AS n
FROM (SELECT DISTINCT clip_id, frame-3 AS lo, frame+3 AS hi FROM v_track_obs WHERE source='stage0_reuse') i JOIN v_track_obs o ON o.clip_id=i.clip_id AND o.frame BETWEEN lo AND hi GROUP BY ALL"""),
)
def best_in_interval(spark, sf):
    obs = V.track_obs(spark, sf)
    i = obs.filter("source = 'stage0_reuse'").select("clip_id", (F.col("frame") - 3).alias("lo"), (F.col("frame") + 3).alias("hi")).distinct()
    j = J.point_in_interval(obs.select("clip_id", "frame", "det_id", "weighted_conf"), i, ["clip_id"], "frame", "lo", "hi", 16)
    return j.groupBy("clip_id", "lo").agg(F.max_by("det_id", F.struct(F.col("weighted_conf"), -F.col("det_id"))).alias("det_id"), r4(F.max("weighted_conf")).alias("conf"), F.count(F.lit(1)).alias("n"))


_ASOF = "SELECT clip_id, t, min(event_id) AS id FROM v_telemetry WHERE kind='view' GROUP BY ALL"


def _asof_sql(tie):
    # the closest view event; on a tie the later (or earlier) one
    return Q.sql(["v_telemetry"], f"""SELECT l.event_id, arg_min(r.id, {{'a': abs(r.t-l.t), 'b': {tie}}}) AS near_id, {Q.r4('min(abs(r.t-l.t))')} AS gap_s
FROM (SELECT * FROM v_telemetry WHERE kind='click') l JOIN rt r ON r.clip_id=l.clip_id GROUP BY l.event_id""",
                 rt="SELECT clip_id, t, min(event_id) AS id FROM (SELECT clip_id, floor(t/3600e0)*3600e0 AS t, event_id, kind FROM v_telemetry) WHERE kind='view' GROUP BY ALL").replace(
        "(SELECT * FROM v_telemetry WHERE kind='click') l", "(SELECT clip_id, event_id, floor(t/1800e0)*1800e0 AS t FROM v_telemetry WHERE kind='click') l")


def _asof(spark, sf, later):
    t = V.telemetry(spark, sf)
    l = t.filter("kind = 'click'").select("clip_id", "event_id", (F.floor(F.col("t") / 1800.0) * 1800.0).alias("t"))
    r = t.filter("kind = 'view'").select("clip_id", F.col("event_id").alias("id"), (F.floor(F.col("t") / 3600.0) * 3600.0).alias("t"))
    j = J.nearest_in_time(l, r, ["clip_id"], "t", ["id"], later_on_tie=later, block=86400.0)
    return j.filter("near_id is not null").select("event_id", "near_id", r4(F.abs(F.col("t") - F.col("near_t"))).alias("gap_s"))


@query("asof_later_on_tie", "JOIN-5", _asof_sql("-r.t"))
def asof_later_on_tie(spark, sf):
    return _asof(spark, sf, True)


@query("asof_earlier_on_tie", "JOIN-5", _asof_sql("r.t"))
def asof_earlier_on_tie(spark, sf):
    return _asof(spark, sf, False)


@query(
    "track_at_frame", "JOIN-14",
    Q.sql(["v_track_obs"], f"""SELECT p.clip_id, p.tracklet_id, p.pf AS probe_frame, m.frame, {Q.r4('m.yaw')} AS yaw FROM pr p LEFT JOIN (
  SELECT p.clip_id, p.tracklet_id, p.pf, o.frame, o.yaw FROM pr p JOIN v_track_obs o ON o.clip_id=p.clip_id AND o.tracklet_id=p.tracklet_id AND abs(o.frame-p.pf)<=5
  QUALIFY row_number() OVER (PARTITION BY p.clip_id, p.tracklet_id, p.pf ORDER BY abs(o.frame-p.pf), o.frame)=1) m USING (clip_id, tracklet_id, pf)""",
          pr="SELECT DISTINCT clip_id, tracklet_id, (frame//25)*25+11 AS pf FROM v_track_obs"),
)
def track_at_frame(spark, sf):
    obs = V.track_obs(spark, sf)
    probes = obs.select("clip_id", "tracklet_id", F.expr("(frame div 25) * 25 + 11").alias("probe_frame")).distinct()
    return rounded(J.nearest_frame_of_track(probes, obs, 5).drop("pitch"), "yaw")


MID = """SELECT clip_id, tracklet_id, min(frame) AS s, max(frame) AS e, list_sort(list(yaw))[count(*)//2+1] AS ty, list_sort(list(pitch))[count(*)//2+1] AS tp FROM v_track_obs GROUP BY ALL"""


@query(
    "track_near_detection", "JOIN-14",
    Q.sql(["v_track_obs"], f"""SELECT d.clip_id, d.det_id, min(t.tracklet_id) FILTER ({Q.gc('d.yaw', 'd.pitch', 'ty', 'tp')}<=10e0+{Q.TOL}) AS tracklet_id
FROM v_detections d LEFT JOIN tm t ON t.clip_id=d.clip_id AND d.frame BETWEEN s AND e GROUP BY d.clip_id, d.det_id""", tm=MID),
)
def track_near_detection(spark, sf):
    obs = V.track_obs(spark, sf)
    span = obs.groupBy("clip_id", "tracklet_id").agg(F.min("frame").alias("start_frame"), F.max("frame").alias("end_frame"))
    mid = T.upper_median_position(obs).withColumnsRenamed({"median_yaw": "yaw", "median_pitch": "pitch"})
    det = V.detections(spark, sf).select("clip_id", "det_id", "frame", "yaw", "pitch")
    near = J.first_track_near(det, span.join(mid, ["clip_id", "tracklet_id"]), 10.0, "det_id", "tracklet_id", ["tracklet_id"])
    return near.select("clip_id", "det_id", F.col("m_tracklet_id").alias("tracklet_id"))


@query(
    "early_mid_late", "WIN-12",
    Q.sql(["v_track_obs"], """SELECT clip_id, tracklet_id, frame, unnest(list_filter([CASE WHEN rn=1 THEN 'EARLY' END, CASE WHEN rn=(CASE WHEN n<=2 THEN 1 ELSE n//2+1 END) THEN 'MID' END, CASE WHEN rn=n THEN 'LATE' END], lambda x: x IS NOT NULL)) AS pick
FROM (SELECT *, row_number() OVER (PARTITION BY clip_id, tracklet_id ORDER BY frame) AS rn, count(*) OVER (PARTITION BY clip_id, tracklet_id) AS n FROM v_track_obs)"""),
)
def early_mid_late(spark, sf):
    return WN.early_mid_late(V.track_obs(spark, sf).select("clip_id", "tracklet_id", "frame"), ["clip_id", "tracklet_id"], ["frame"], frame_block())


@query(
    "even_picks", "WIN-12",
    Q.sql(["v_track_obs"], """SELECT clip_id, tracklet_id, frame FROM (SELECT *, row_number() OVER (PARTITION BY clip_id, tracklet_id ORDER BY frame) AS rn, count(*) OVER (PARTITION BY clip_id, tracklet_id) AS n FROM v_track_obs)
WHERE n<=12 OR rn-1 IN (SELECT round_even(i*(n-1)/11e0, 0) FROM range(12) t(i))"""),
)
def even_picks(spark, sf):
    return WN.spaced_picks(V.track_obs(spark, sf).select("clip_id", "tracklet_id", "frame"), ["clip_id", "tracklet_id"], ["frame"], frame_block(), 12).select("clip_id", "tracklet_id", "frame")


WD = "SELECT clip_id, frame//5 AS batch, frame%5 AS pos, det_id, yaw, pitch, raw_conf AS conf FROM v_detections"
# chains only grow along better scores: best chain per end point, layer by layer
WCH = """SELECT clip_id, batch, pos, det_id, yaw, pitch, conf, conf AS score, [det_id] AS path, pitch>18e0 AS bad FROM wd WHERE pos=%d"""


def _layer(n):
    prev = f"w{n - 1}"
    return f"""SELECT * FROM (SELECT w.clip_id, w.batch, w.pos, w.det_id, w.yaw, w.pitch, w.conf, p.score+(p.conf+w.conf)/2e0-{Q.gc('p.yaw', 'p.pitch', 'w.yaw', 'w.pitch')}/60e0 AS score, list_append(p.path, w.det_id) AS path, p.bad OR w.pitch>18e0 AS bad
  FROM {prev} p JOIN wd w ON w.clip_id=p.clip_id AND w.batch=p.batch AND w.pos={n} WHERE {Q.gc('p.yaw', 'p.pitch', 'w.yaw', 'w.pitch')} <= 30e0 + {Q.TOL} UNION ALL {WCH % n})
  QUALIFY row_number() OVER (PARTITION BY clip_id, batch, det_id ORDER BY score DESC, len(path) DESC)=1"""


WALL = " UNION ALL ".join(f"SELECT * FROM w{n}" for n in range(5))


@query(
    "warmup_paths", "TRK-7",
    Q.sql(["v_detections"], f"""SELECT clip_id, batch, {Q.r4('score')} AS score, CAST(len(path) AS INTEGER) AS length, array_to_string(path, '>') AS path FROM wa WHERE len(path)>=3 AND NOT bad QUALIFY row_number() OVER (PARTITION BY clip_id, batch ORDER BY score DESC, det_id)=1""",
          wd=WD, w0=WCH % 0, **{f"w{n}": _layer(n) for n in range(1, 5)}, wa=WALL),
)
def warmup_paths(spark, sf):
    from fieldlens.operators.crowd import warmup_chain

    det = V.detections(spark, sf)
    return rounded(warmup_chain(det.select("clip_id", F.expr("frame div 5").alias("batch"), F.expr("frame % 5").alias("pos"), "det_id", "yaw", "pitch", F.col("raw_conf").alias("conf"))), "score")
