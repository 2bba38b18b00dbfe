"""Queries over detections: expressions, hotspot maps, gates, quarantine, frame classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.config import CandidateConfig, HotspotConfig
from fieldlens.functions import geo
from fieldlens.functions.geo import r4
from fieldlens.operators import candidates as C
from fieldlens.operators import hotspots as H
from fieldlens.operators import spatial
from fieldlens.plans import sqlkit as Q
from fieldlens.plans.registry import query
from fieldlens.sources import views as V

# Fixture threshold: with the default 0.60 no region of the test data counts as static.
HOT = HotspotConfig(duty_cycle_threshold=0.35)
# Fixture venue outline in equirect pixels of a 3840 x 1920 frame.
POLYGON = [(300.0, 500.0), (1900.0, 380.0), (3500.0, 520.0), (3300.0, 1350.0), (1800.0, 1500.0), (500.0, 1300.0)]
ZONES = [(-77.4, 6.0, -3.9, 5.0), (120.0, 15.0, 10.0, 8.0)]
MANIFEST = [("L1", -77.4, -3.9, 5.5), ("L2", 100.0, 10.0, 6.0), ("L3", -20.0, -15.0, 3.0), ("L4", 30.0, 0.0, 4.5)]


def polygon_col():
    return F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in POLYGON])


def zones_col():
    names = ("yaw_centre", "yaw_radius", "pitch_centre", "pitch_radius")
    return F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(z, names)]) for z in ZONES])


def manifest(spark):
    return spark.createDataFrame(MANIFEST, "location_id string, centre_yaw double, centre_pitch double, action_radius_deg double")


def hot_bins(spark, sf, cfg=HOT):
    det = V.detections(spark, sf)
    return H.duty_cycle_bins(det, V.dense_frames(det), cfg)


def hot_map(spark, sf, cfg=HOT):
    bins = hot_bins(spark, sf, cfg)
    regions = H.hotspot_regions(bins, cfg)
    return bins, regions


def penalised(spark, sf, cfg=HOT):
    bins, regions = hot_map(spark, sf, cfg)
    det = C.gate(V.detections(spark, sf)).filter("status = 'kept'")
    return C.penalise(det, H.final_bin_penalty(bins, regions, cfg), regions, cfg), regions


# ---------------------------------------------------------------- oracle pieces
BINS_SQL = f"""
  SELECT b.clip_id, yaw_bin, pitch_bin, yaw_bin*2e0-180e0+1e0 AS yaw_centre, pitch_bin*2e0-90e0+1e0 AS pitch_centre,
         n_timestamps/CAST(sampled AS DOUBLE) AS duty_cycle, n_timestamps, n_detections, mean_conf
  FROM (SELECT clip_id, CAST(floor(({Q.wrap('yaw')}+180e0)/2e0) AS INTEGER) AS yaw_bin, CAST(floor((pitch+90e0)/2e0) AS INTEGER) AS pitch_bin,
               count(DISTINCT frame) AS n_timestamps, count(*) AS n_detections, avg(raw_conf) AS mean_conf
        FROM v_detections GROUP BY ALL) b
  JOIN (SELECT clip_id, count(*) AS sampled FROM v_frames GROUP BY 1) f ON b.clip_id = f.clip_id"""
SEEDS_SQL = "SELECT clip_id, CAST(yaw_bin AS BIGINT)*100000+pitch_bin AS bin, yaw_centre, pitch_centre, duty_cycle FROM bins WHERE duty_cycle >= 0.1e0"
LINKS_SQL = f"""
  SELECT a.clip_id, a.bin AS a, b.bin AS b FROM seeds a JOIN seeds b ON a.clip_id = b.clip_id
  WHERE {Q.gc('a.yaw_centre', 'a.pitch_centre', 'b.yaw_centre', 'b.pitch_centre')} <= 4e0 + {Q.TOL}"""
REACH_SQL = """
  SELECT clip_id, bin AS src, bin AS dst FROM seeds
  UNION
  SELECT r.clip_id, r.src, l.b FROM reach r JOIN links l ON r.clip_id = l.clip_id AND r.dst = l.a"""
COMP_SQL = "SELECT clip_id, dst AS bin, min(src) AS comp FROM reach GROUP BY ALL"
CENTRES_SQL = """
  SELECT clip_id, comp, degrees(atan2(x, z)) AS centre_yaw,
         degrees(asin(greatest(-1e0, least(1e0, y/sqrt(x*x+y*y+z*z))))) AS centre_pitch, peak_duty, n_members
  FROM (SELECT s.clip_id, comp, sum(duty_cycle*cos(radians(pitch_centre))*sin(radians(yaw_centre))) x,
               sum(duty_cycle*sin(radians(pitch_centre))) y, sum(duty_cycle*cos(radians(pitch_centre))*cos(radians(yaw_centre))) z,
               max(duty_cycle) AS peak_duty, count(*) AS n_members
        FROM seeds s JOIN comp c ON s.clip_id = c.clip_id AND s.bin = c.bin GROUP BY ALL)"""
REGIONS_SQL = f"""
  SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY peak_duty DESC, comp) AS region_rank FROM (
  SELECT k.clip_id, k.comp, centre_yaw, centre_pitch, peak_duty, n_members,
         max({Q.gc('s.yaw_centre', 's.pitch_centre', 'k.centre_yaw', 'k.centre_pitch')}) + 2e0*sqrt(2e0)/2e0 AS radius_deg,
         '(' || printf('%.1f', {Q.r4('centre_yaw', 1)}) || ',' || printf('%.1f', {Q.r4('centre_pitch', 1)}) || ')' AS label
  FROM centres k JOIN comp c ON k.clip_id = c.clip_id AND k.comp = c.comp
  JOIN seeds s ON s.clip_id = c.clip_id AND s.bin = c.bin GROUP BY ALL)"""
HOT_CTES = dict(bins=BINS_SQL, seeds=SEEDS_SQL, links=LINKS_SQL, reach=REACH_SQL, comp=COMP_SQL, centres=CENTRES_SQL, regions=REGIONS_SQL)


def region_w(d: str, r: str, peak: str) -> str:
    eff = f"(CASE WHEN {d} <= {r} + {Q.TOL} THEN {peak} ELSE {peak}*(1e0-({d}-{r})/{r}) END)"
    return f"(CASE WHEN {d} <= {r}*2e0 + {Q.TOL} THEN {Q.penalty(eff, '0.35e0')} ELSE 1e0 END)"


FINAL_BINS_SQL = f"""
  SELECT b.*, {Q.penalty('duty_cycle', '0.35e0')} AS bin_penalty_weight, coalesce(rw, 1e0) AS region_penalty_weight,
         greatest(0.1e0, least({Q.penalty('duty_cycle', '0.35e0')}, coalesce(rw, 1e0))) AS penalty_weight
  FROM bins b LEFT JOIN (
    SELECT b.clip_id, yaw_bin, pitch_bin, min({region_w(Q.gc('yaw_centre', 'pitch_centre', 'centre_yaw', 'centre_pitch'), 'radius_deg', 'r.peak_duty')}) AS rw
    FROM bins b JOIN regions r ON b.clip_id = r.clip_id GROUP BY ALL) w
  ON b.clip_id = w.clip_id AND b.yaw_bin = w.yaw_bin AND b.pitch_bin = w.pitch_bin"""
KEPT_SQL = "SELECT * FROM v_detections WHERE pitch >= -30e0 AND pitch <= 18e0"
_D = Q.gc("d.yaw", "d.pitch", "r.centre_yaw", "r.centre_pitch")
PEN_SQL = f"""
  SELECT d.*, greatest(0.1e0, least(coalesce(fb.penalty_weight, 1e0), coalesce(m.rw, 1e0))) AS penalty, m.region
  FROM kept d
  LEFT JOIN final_bins fb ON fb.clip_id = d.clip_id AND fb.yaw_bin = floor(({Q.wrap('d.yaw')}+180e0)/2e0) AND fb.pitch_bin = floor((d.pitch+90e0)/2e0)
  LEFT JOIN (
    SELECT d.det_id, min({region_w(_D, 'radius_deg', 'r.peak_duty')}) AS rw,
           arg_min(label, CASE WHEN {_D} <= radius_deg*2e0 + {Q.TOL} THEN region_rank END) FILTER ({_D} <= radius_deg*2e0 + {Q.TOL}) AS region
    FROM kept d JOIN regions r ON d.clip_id = r.clip_id GROUP BY 1) m ON m.det_id = d.det_id"""
PEN_CTES = dict(HOT_CTES, final_bins=FINAL_BINS_SQL, kept=KEPT_SQL, pen=PEN_SQL)


# ---------------------------------------------------------------- expressions
@query(
    "angles_and_vectors", "FN-1 FN-2 FN-3 FN-4 FN-5",
    Q.sql(["v_detections"], f"""
SELECT det_id, {Q.r4(Q.wrap('yaw*3e0'))} AS wrapped, {Q.r4(Q.delta('yaw', 'crop_yaw'))} AS delta,
       {Q.r4(Q.gc('yaw', 'pitch', '-77.4e0', '-3.9e0'))} AS dist,
       {Q.r4('cos(radians(pitch))*sin(radians(yaw))')} AS x, {Q.r4('sin(radians(pitch))')} AS y, {Q.r4('cos(radians(pitch))*cos(radians(yaw))')} AS z,
       CAST(floor(({Q.wrap('yaw')}+180e0)/2e0) AS INTEGER) AS yaw_bin, CAST(floor((pitch+90e0)/2e0) AS INTEGER) AS pitch_bin,
       floor(({Q.wrap('yaw')}+180e0)/2e0)*2e0-180e0+1e0 AS yaw_centre
FROM v_detections"""),
)
def angles_and_vectors(spark, sf):
    d = V.detections(spark, sf)
    yb = geo.yaw_bin("yaw", 2.0)
    return d.select(
        "det_id",
        r4(geo.wrap_yaw(F.col("yaw") * 3.0)).alias("wrapped"),
        r4(geo.circular_delta("yaw", "crop_yaw")).alias("delta"),
        r4(geo.angular_distance("yaw", "pitch", geo.lit(-77.4), geo.lit(-3.9))).alias("dist"),
        r4(geo.unit_x("yaw", "pitch")).alias("x"), r4(geo.unit_y("pitch")).alias("y"), r4(geo.unit_z("yaw", "pitch")).alias("z"),
        yb.alias("yaw_bin"), geo.pitch_bin("pitch", 2.0).alias("pitch_bin"),
        geo.bin_centre(yb, -180.0, 2.0).alias("yaw_centre"),
    )


@query(
    "pixel_projection", "FN-8 FN-9 FN-10",
    Q.sql(["v_detections"], f"""
SELECT det_id, {Q.r4('degrees(atan2(cos(c)*nx+sin(c), cos(c)-sin(c)*nx))')} AS crop_yaw_deg, {Q.r4('degrees(asin(ny/sqrt(nx*nx+ny*ny+1e0)))')} AS crop_pitch_deg,
       {Q.r4('(px/3840e0-0.5e0)*360e0')} AS eq_yaw, {Q.r4('(0.5e0-py/1920e0)*180e0')} AS eq_pitch,
       {Q.r4('(yaw/360e0+0.5e0)*3840e0')} AS eq_x, {Q.r4('(0.5e0-pitch/180e0)*1920e0')} AS eq_y,
       {Q.r4('bw')} AS width, {Q.r4('bh')} AS height, {Q.r4('bw*bh')} AS area, {Q.r4('bw/bh')} AS aspect
FROM (SELECT *, (px-640e0)/640e0*tan(radians(55e0)) AS nx, -(py-360e0)/360e0*(tan(radians(55e0))*1280e0/720e0) AS ny, radians(crop_yaw) AS c,
             sqrt(bbox_area_px*bbox_aspect_ratio) AS bw, sqrt(bbox_area_px/bbox_aspect_ratio) AS bh
      FROM (SELECT *, CAST(det_id%1280 AS DOUBLE) AS px, CAST(det_id%720 AS DOUBLE) AS py FROM v_detections))"""),
)
def pixel_projection(spark, sf):
    d = V.with_geometry(V.detections(spark, sf)).select(
        "*", F.expr("cast(det_id % 1280 as double)").alias("px"), F.expr("cast(det_id % 720 as double)").alias("py")
    )
    cy, cp = geo.crop_pixel_to_yaw_pitch("px", "py", "crop_yaw", 110.0, 1280.0, 720.0)
    ey, ep = geo.equirect_to_yaw_pitch("px", "py", geo.lit(3840.0), geo.lit(1920.0))
    ex, eyy = geo.yaw_pitch_to_equirect("yaw", "pitch", geo.lit(3840.0), geo.lit(1920.0))
    w = F.sqrt(F.col("bbox_area_px") * F.col("bbox_aspect_ratio"))
    h = F.sqrt(F.col("bbox_area_px") / F.col("bbox_aspect_ratio"))
    box = geo.bbox_geometry(F.array(geo.lit(0.0), geo.lit(0.0), w, h))
    return d.select(
        "det_id", r4(cy).alias("crop_yaw_deg"), r4(cp).alias("crop_pitch_deg"), r4(ey).alias("eq_yaw"), r4(ep).alias("eq_pitch"),
        r4(ex).alias("eq_x"), r4(eyy).alias("eq_y"),
        *[r4(box[k]).alias(k) for k in ("width", "height", "area", "aspect")],
    )


@query(
    "filled_geometry", "FN-10",
    Q.sql(["v_detections"], f"""SELECT det_id, {Q.r4('w')} AS width, {Q.r4('h')} AS height, {Q.r4('coalesce(area, w*h)')} AS area,
  {Q.r4('CASE WHEN w IS NOT NULL THEN coalesce(CASE WHEN aspect>0 THEN aspect END, w/greatest(h,1e-6)) ELSE aspect END')} AS aspect
FROM (SELECT det_id, CASE WHEN det_id%50<>0 AND det_id%5<>4 THEN sqrt(bbox_area_px*bbox_aspect_ratio) END AS w, CASE WHEN det_id%50<>0 AND det_id%5<>4 THEN sqrt(bbox_area_px/bbox_aspect_ratio) END AS h,
  CASE WHEN det_id%50<>0 AND det_id%3<>0 THEN bbox_area_px END AS area, CASE WHEN det_id%50=0 THEN NULL WHEN det_id%7=0 THEN -1e0 WHEN det_id%3<>0 THEN bbox_aspect_ratio END AS aspect FROM v_detections)"""),
)
def filled_geometry(spark, sf):
    """Recorded scalars first, then the box; some scalars are missing, some aspects invalid, some boxes lost."""
    d = V.with_geometry(V.detections(spark, sf))
    g = F.col("detection_geometry")
    known = F.expr("det_id % 3 <> 0")
    g = g.withField("bbox_area_px", F.when(known, g["bbox_area_px"])).withField(
        "bbox_aspect_ratio", F.when(F.expr("det_id % 7 = 0"), geo.lit(-1.0)).when(known, g["bbox_aspect_ratio"])).withField(
        "bbox_xyxy", F.when(F.expr("det_id % 5 <> 4"), g["bbox_xyxy"]))
    filled = geo.fill_geometry("g")
    return d.select("det_id", g.alias("g")).select("det_id", *[r4(filled[k]).alias(k) for k in ("width", "height", "area", "aspect")])


@query(
    "plausibility_and_cues", "FN-13 FN-14 FN-15 FN-16 FN-17 FN-18",
    Q.sql(["v_detections"], f"""
SELECT det_id,
       {Q.r4("CASE WHEN pitch > 18e0 THEN 0e0 ELSE greatest(0e0, 1e0-greatest(pitch-10e0, -30e0-pitch, 0e0)/8e0) END")} AS plausibility,
       {Q.r4("sqrt(pow(greatest(100e0-px,0e0,px-400e0),2)+pow(greatest(80e0-py,0e0,py-300e0),2))")} AS rect_dist,
       {Q.r4("CASE WHEN det_id%3=0 THEN NULL WHEN det_id%3=1 THEN greatest(0e0,least(1e0,1e0-px/260e0)) ELSE greatest(0e0,least(1e0,1e0-py/320e0)) END")} AS pose,
       {Q.r4(Q.clamp("1e0-abs(ln(bbox_aspect_ratio))/ln(4e0)"))} AS compactness,
       {Q.r4("CASE WHEN bbox_area_px IS NULL THEN NULL ELSE greatest(0e0,1e0-abs(ln(greatest(bbox_area_px/40e0,1e-6)))/2e0) END")} AS size_score,
       {Q.r4("greatest(0.5e0,bbox_area_px*(110e0/1280e0)*1.5e0)")} AS tolerance,
       {Q.r4("coalesce(" + Q.clamp("4e0*pi()*bbox_area_px/(perim*perim)") + ", 0e0)")} AS circularity,
       coalesce(bbox_area_px>=100 AND bbox_area_px<=800 AND greatest(0e0,least(1e0,4e0*pi()*bbox_area_px/(perim*perim)))>=0.5e0 AND NOT (2e0/bbox_aspect_ratio>2.5e0), false) AS blob_ok,
       {Q.r4(Q.sigmoid('raw_conf*4e0-2e0'))} AS sig
FROM (SELECT *, CAST(det_id%640 AS DOUBLE) AS px, CAST(det_id%480 AS DOUBLE) AS py, 20e0+CAST(det_id%90 AS DOUBLE) AS perim FROM v_detections)"""),
)
def plausibility_and_cues(spark, sf):
    d = V.detections(spark, sf).select(
        "*", F.expr("cast(det_id % 640 as double)").alias("px"), F.expr("cast(det_id % 480 as double)").alias("py"),
        F.expr("20e0 + cast(det_id % 90 as double)").alias("perim"),
    )
    rect = F.array(*[geo.lit(v) for v in (100.0, 80.0, 400.0, 300.0)])
    ankle = F.when(F.expr("det_id % 3 = 1"), F.col("px"))
    lower = F.when(F.expr("det_id % 3 = 2"), F.col("py"))
    return d.select(
        "det_id",
        r4(geo.pitch_plausibility("pitch")).alias("plausibility"),
        r4(geo.point_rect_distance("px", "py", rect)).alias("rect_dist"),
        r4(geo.pose_score(ankle, lower)).alias("pose"),
        r4(geo.compactness("bbox_aspect_ratio")).alias("compactness"),
        r4(F.when(F.col("bbox_area_px").isNotNull(), geo.size_score("bbox_area_px", geo.lit(40.0)))).alias("size_score"),
        r4(F.when(F.col("bbox_area_px").isNotNull(), geo.verification_tolerance("bbox_area_px")).otherwise(geo.lit(0.5))).alias("tolerance"),
        r4(F.when(F.col("bbox_area_px").isNotNull(), geo.circularity("bbox_area_px", "perim")).otherwise(geo.lit(0.0))).alias("circularity"),
        F.coalesce(geo.blob_passes("bbox_area_px", "perim", geo.lit(1.0), geo.lit(2.0) / F.col("bbox_aspect_ratio")), F.lit(False)).alias("blob_ok"),
        r4(geo.sigmoid(F.col("raw_conf") * 4.0 - 2.0)).alias("sig"),
    )


_EDGES = [(POLYGON[i], POLYGON[(i + 1) % len(POLYGON)]) for i in range(len(POLYGON))]
_CROSS = " + ".join(
    f"(CASE WHEN ey > {min(a[1], b[1])}e0 AND ey <= {max(a[1], b[1])}e0 AND ex <= {max(a[0], b[0])}e0"
    f" AND ex <= (ey-{a[1]}e0)*({b[0]}e0-{a[0]}e0)/({b[1]}e0-{a[1]}e0)+{a[0]}e0 THEN 1 ELSE 0 END)"
    for a, b in _EDGES
)


@query(
    "venue_gate", "FN-11 FN-12 FLT-1",
    Q.sql(["v_detections"], f"""
SELECT clip_id, status, in_zone, count(*) AS n, {Q.r4('avg(raw_conf)')} AS mean_conf
FROM (SELECT clip_id, raw_conf, CASE WHEN ({_CROSS}) % 2 = 0 THEN 'venue_rejected' WHEN pitch < -30e0 OR pitch > 18e0 THEN 'pitch_rejected' ELSE 'kept' END AS status,
             {' OR '.join(f'(abs(yaw-({a}e0))<={b}e0 AND abs(pitch-({c}e0))<={d}e0)' for a, b, c, d in ZONES)} AS in_zone
      FROM (SELECT *, (yaw/360e0+0.5e0)*3840e0 AS ex, (0.5e0-pitch/180e0)*1920e0 AS ey FROM v_detections))
GROUP BY ALL"""),
)
def venue_gate(spark, sf):
    d = C.gate(V.detections(spark, sf), polygon_col()).withColumn("in_zone", geo.in_zones("yaw", "pitch", zones_col()))
    return d.groupBy("clip_id", "status", "in_zone").agg(F.count(F.lit(1)).alias("n"), r4(F.avg("raw_conf")).alias("mean_conf"))


# ---------------------------------------------------------------- hotspot map
@query(
    "duty_cycle_bins", "AGG-1 FN-6",
    Q.sql(["v_detections", "v_frames"], f"""
SELECT clip_id, yaw_bin, pitch_bin, {Q.r4('duty_cycle')} AS duty_cycle, {Q.r4(Q.penalty('duty_cycle'))} AS bin_penalty_weight,
       n_timestamps, n_detections, {Q.r4('mean_conf')} AS mean_conf, pitch_centre >= -30 AND pitch_centre <= 18 AS in_pitch_bounds FROM bins""",
          bins=BINS_SQL),
)
def duty_cycle_bins(spark, sf):
    return hot_bins(spark, sf, HotspotConfig()).select(
        "clip_id", "yaw_bin", "pitch_bin", r4("duty_cycle").alias("duty_cycle"), r4("bin_penalty_weight").alias("bin_penalty_weight"),
        "n_timestamps", "n_detections", r4("mean_conf").alias("mean_conf"), "in_pitch_bounds",
    )


@query(
    "hotspot_regions", "AGG-2 CLU-1 JOIN-3",
    Q.sql(["v_detections", "v_frames"], f"""
SELECT clip_id, comp, {Q.r4('centre_yaw')} AS centre_yaw, {Q.r4('centre_pitch')} AS centre_pitch, {Q.r4('radius_deg')} AS radius_deg,
       {Q.r4('peak_duty')} AS peak_duty, n_members, region_rank FROM regions""", **HOT_CTES),
)
def hotspot_regions(spark, sf):
    _, regions = hot_map(spark, sf)
    return regions.select("clip_id", "comp", *[r4(c).alias(c) for c in ("centre_yaw", "centre_pitch", "radius_deg", "peak_duty")],
                          "n_members", F.col("region_rank").cast("long").alias("region_rank"))


@query(
    "hotspot_bin_penalties", "FN-7 AGG-2",
    Q.sql(["v_detections", "v_frames"], f"""
SELECT clip_id, yaw_bin, pitch_bin, {Q.r4('bin_penalty_weight')} AS bin_penalty_weight,
       {Q.r4('region_penalty_weight')} AS region_penalty_weight, {Q.r4('penalty_weight')} AS penalty_weight FROM final_bins""",
          **dict(HOT_CTES, final_bins=FINAL_BINS_SQL)),
)
def hotspot_bin_penalties(spark, sf):
    bins, regions = hot_map(spark, sf)
    return H.final_bin_penalty(bins, regions, HOT).select(
        "clip_id", "yaw_bin", "pitch_bin", *[r4(c).alias(c) for c in ("bin_penalty_weight", "region_penalty_weight", "penalty_weight")]
    )


@query(
    "coverage_hotspots", "AGG-23",
    Q.sql(["v_detections", "v_frames"], f"""
SELECT r.clip_id, r.comp, {Q.r4('peak_duty')} AS peak_duty, count(h.det_id) AS hit_count
FROM regions r LEFT JOIN (
  SELECT d.clip_id, d.det_id, min(region_rank) AS region_rank FROM v_detections d JOIN (SELECT * FROM regions WHERE peak_duty >= 0.3e0) r ON d.clip_id = r.clip_id
  WHERE {_D} <= radius_deg + {Q.TOL} GROUP BY ALL) h ON r.clip_id = h.clip_id AND r.region_rank = h.region_rank
WHERE peak_duty >= 0.3e0 GROUP BY ALL""", **HOT_CTES),
)
def coverage_hotspots(spark, sf):
    regions = H.coverage_hotspots(hot_bins(spark, sf), HOT, 0.30)
    return H.hits_per_region(V.detections(spark, sf), regions).select("clip_id", "comp", r4("peak_duty").alias("peak_duty"), "hit_count")


@query("leader_hotspots", "AGG-23")
def leader_hotspots(spark, sf):
    det = V.detections(spark, sf)
    found = H.leader_clusters(det, V.dense_frames(det), HotspotConfig(leader_min_coverage=0.30))
    return found.select("clip_id", "cluster", r4("yaw").alias("yaw"), r4("pitch").alias("pitch"), "frame_count", r4("coverage").alias("coverage"), r4("mean_conf").alias("mean_conf"),
                        F.to_json("crops").alias("crops"))


# ---------------------------------------------------------------- refinement
@query(
    "candidate_penalties", "FLT-2",
    Q.sql(["v_detections", "v_frames"], f"""
SELECT clip_id, det_id, {Q.r4('penalty')} AS penalty, {Q.r4('raw_conf*penalty')} AS weighted_conf, region FROM pen""", **PEN_CTES),
)
def candidate_penalties(spark, sf):
    d, _ = penalised(spark, sf)
    return d.select("clip_id", "det_id", r4("penalty").alias("penalty"), r4("weighted_conf").alias("weighted_conf"), "region")


STATIC_SQL = f"""
  SELECT d.det_id, r.label, r.peak_duty, r.radius_deg, {_D} AS dist
  FROM v_detections d JOIN regions r ON d.clip_id = r.clip_id
  WHERE r.peak_duty >= 0.35e0 AND {_D} <= r.radius_deg + {Q.TOL}
  QUALIFY row_number() OVER (PARTITION BY d.det_id ORDER BY {_D}, region_rank) = 1"""


@query(
    "static_quarantine", "FLT-3 JOIN-2",
    Q.sql(["v_detections", "v_frames"], f"""
SELECT d.clip_id, d.det_id, CASE WHEN s.det_id IS NULL THEN 'active' ELSE 'quarantined' END AS status, s.label AS region,
       {Q.r4('s.peak_duty')} AS region_peak_duty, {Q.r4('s.dist')} AS dist
FROM v_detections d LEFT JOIN static s ON s.det_id = d.det_id""", **dict(HOT_CTES, static=STATIC_SQL)),
)
def static_quarantine(spark, sf):
    _, regions = hot_map(spark, sf)
    q = C.static_quarantine(V.detections(spark, sf), regions, HOT.duty_cycle_threshold)
    return q.select("clip_id", "det_id", "status", F.col("quarantine.region").alias("region"),
                    r4("quarantine.region_peak_duty").alias("region_peak_duty"), r4("quarantine.angular_distance_deg").alias("dist"))


@query(
    "static_quarantine_report", "FLT-3 SNK-1",
    Q.sql(["v_detections", "v_frames"], f"""
SELECT d.clip_id, s.label AS region, count(*) AS candidate_count, count(DISTINCT frame) AS frame_count, {Q.r4('sum(raw_conf)')} AS raw_conf_sum,
       {Q.r4('avg(dist)')} AS mean_distance, {Q.r4('max(dist)')} AS max_distance
FROM v_detections d JOIN static s ON s.det_id = d.det_id GROUP BY ALL""", **dict(HOT_CTES, static=STATIC_SQL)),
)
def static_quarantine_report(spark, sf):
    _, regions = hot_map(spark, sf)
    rep = C.quarantine_region_report(C.static_quarantine(V.detections(spark, sf), regions, HOT.duty_cycle_threshold))
    return rep.select("clip_id", "region", "candidate_count", "frame_count",
                      *[r4(c).alias(c) for c in ("raw_conf_sum", "mean_distance", "max_distance")])


GEO_SQL = """
  SELECT *, source='new_detection' AND det_id%50<>0 AND coalesce(bbox_area_px>100e0,false) AS by_area,
         source='new_detection' AND det_id%50<>0 AND coalesce(bbox_aspect_ratio>1.25e0,false) AS by_aspect FROM v_detections"""


@query(
    "geometry_quarantine", "FLT-4",
    Q.sql(["v_detections"], """
SELECT clip_id, count(*) AS candidates_before, count(*) FILTER (NOT by_area AND NOT by_aspect) AS candidates_active,
       count(*) FILTER (by_area OR by_aspect) AS candidates_quarantined, count(*) FILTER (source='new_detection') AS new_detection_before,
       count(*) FILTER (source='stage0_reuse') AS reuse_unchanged, count(*) FILTER (by_area AND NOT by_aspect) AS by_area_only,
       count(*) FILTER (by_aspect AND NOT by_area) AS by_aspect_only, count(*) FILTER (by_area AND by_aspect) AS by_both
FROM g GROUP BY clip_id""", g=GEO_SQL),
)
def geometry_quarantine(spark, sf):
    return C.geometry_report(C.geometry_quarantine(V.with_geometry(V.detections(spark, sf))), ["clip_id"])


_M = ", ".join(f"('{a}', {b}e0, {c}e0, {d}e0)" for a, b, c, d in MANIFEST)


@query(
    "reviewed_location_filter", "FLT-5",
    Q.sql(["v_detections"], f"""
SELECT d.det_id, CASE WHEN m.det_id IS NULL THEN 'kept' ELSE 'removed' END AS status, m.location_id, {Q.r4('m.dist')} AS dist
FROM v_detections d LEFT JOIN m ON m.det_id = d.det_id""",
          m=f"""SELECT det_id, location_id, {Q.gc('yaw', 'pitch', 'ly', 'lp')} AS dist FROM v_detections, (VALUES {_M}) t(location_id, ly, lp, lr)
  WHERE {Q.gc('yaw', 'pitch', 'ly', 'lp')} <= lr + {Q.TOL}
  QUALIFY row_number() OVER (PARTITION BY det_id ORDER BY {Q.gc('yaw', 'pitch', 'ly', 'lp')}, location_id) = 1"""),
)
def reviewed_location_filter(spark, sf):
    d = C.reviewed_location_filter(V.detections(spark, sf).withColumn("all_clips", F.lit(1)),
                                   manifest(spark).withColumn("all_clips", F.lit(1)), ["all_clips"])
    return d.select("det_id", "status", F.col("match").alias("location_id"), r4("match_dist").alias("dist"))


@query(
    "manifest_faults", "FLT-5",
    Q.sql(["v_detections"], f"SELECT det_id AS location_id, {Q.r4('raw_conf*10e0')} AS action_radius_deg FROM v_detections WHERE raw_conf*10e0 > 5e0+1e-6 OR raw_conf*10e0 >= 4.5e0"),
)
def manifest_faults(spark, sf):
    """Reviewed locations whose radius of action breaks the cap or reaches the radius of discovery."""
    m = V.detections(spark, sf).select(F.col("det_id").alias("location_id"), (F.col("raw_conf") * 10.0).alias("action_radius_deg"))
    return C.check_manifest(m, 5.0, 4.5).select("location_id", r4("action_radius_deg").alias("action_radius_deg"))


@query(
    "anchor_quality_gate", "FLT-7",
    Q.sql(["v_detections"], f"""
SELECT det_id, raw_conf >= 0.15e0 AND (NOT known OR plausible) AND NOT fence AS anchor_ok, raw_conf >= 0.03e0 AND plausible AND NOT fence AS trace_ok
FROM (SELECT *, det_id%50<>0 AND bbox_area_px IS NOT NULL AS known,
        coalesce(det_id%50<>0 AND bbox_area_px BETWEEN 4 AND 2500 AND bbox_aspect_ratio BETWEEN 0.25 AND 4, false) AS plausible,
        {Q.gc('yaw', 'pitch', '-77.4e0', '-3.9e0')} <= 5e0 + {Q.TOL} AS fence FROM v_detections)"""),
)
def anchor_quality_gate(spark, sf):
    return C.anchor_gate(V.with_geometry(V.detections(spark, sf)), conf="raw_conf").select("det_id", "anchor_ok", "trace_ok")


CLASS_SQL = f"""
  SELECT d.*, d.raw_conf*d.penalty AS weighted_conf, false AS pitch_rejected, d.penalty < 0.5e0 AS hotspot_rejected FROM pen d
  UNION ALL BY NAME
  SELECT v.*, raw_conf AS weighted_conf, true AS pitch_rejected, false AS hotspot_rejected FROM v_detections v WHERE pitch < -30e0 OR pitch > 18e0"""


@query(
    "frame_classes", "FLT-10",
    Q.sql(["v_detections", "v_frames"], f"""
SELECT f.clip_id, f.frame, CASE WHEN n IS NULL THEN 'NOT_DETECTED' WHEN n_pass=0 AND only_pitch=n THEN 'PITCH_FILTERED' WHEN n_pass=0 THEN 'HOTSPOT_ONLY'
    WHEN tops[1]-tops[2] < 0.15e0 AND tops[1] < 0.35e0 THEN 'AMBIGUOUS' WHEN tops[1] >= 0.35e0 THEN 'BALL_CONFIDENT' ELSE 'BALL_WEAK' END AS label,
  {Q.r4('tops[1]')} AS top_conf, {Q.r4('tops[2]')} AS second_conf
FROM v_frames f LEFT JOIN (
  SELECT clip_id, frame, count(*) AS n, count(*) FILTER (NOT pitch_rejected AND NOT hotspot_rejected) AS n_pass, count(*) FILTER (pitch_rejected AND NOT hotspot_rejected) AS only_pitch,
         list(weighted_conf ORDER BY weighted_conf DESC) FILTER (NOT pitch_rejected AND NOT hotspot_rejected) AS tops
  FROM cls GROUP BY ALL) c ON c.clip_id=f.clip_id AND c.frame=f.frame""", **dict(PEN_CTES, cls=CLASS_SQL)),
)
def frame_classes(spark, sf):
    pen, _ = penalised(spark, sf)
    out = C.gate(V.detections(spark, sf)).filter("status <> 'kept'")
    flags = lambda d, p, h, w: d.select("clip_id", "frame", w.alias("weighted_conf"), p.alias("pitch_rejected"), h.alias("hotspot_rejected"))
    cand = flags(pen, F.lit(False), F.col("penalty") < 0.5, F.col("weighted_conf")).unionByName(
        flags(out, F.lit(True), F.lit(False), F.col("raw_conf")))
    c = C.classify_frames(V.dense_frames(V.detections(spark, sf)), cand)
    return c.select("clip_id", "frame", "label", r4("top_conf").alias("top_conf"), r4("second_conf").alias("second_conf"))


@query(
    "frame_accounting", "AGG-21 SRC-1",
    Q.sql(["v_detections", "v_frames"], """
SELECT clip_id, count(*) AS frames_total, CAST(sum(b) AS BIGINT) AS candidates_before, CAST(sum(a) AS BIGINT) AS candidates_after, count(*) FILTER (b>0) AS frames_with_before,
       count(*) FILTER (a>0) AS frames_with_after, count(*) FILTER (b>0 AND a=0) AS frames_newly_zero
FROM (SELECT f.clip_id, f.frame, count(d.det_id) AS b, count(d.det_id) FILTER (d.pitch BETWEEN -30 AND 18 AND d.raw_conf >= 0.6e0) AS a
      FROM v_frames f LEFT JOIN v_detections d ON d.clip_id=f.clip_id AND d.frame=f.frame GROUP BY ALL) GROUP BY clip_id"""),
)
def frame_accounting(spark, sf):
    det = V.detections(spark, sf)
    return C.frame_accounting(V.dense_frames(det), det, F.col("pitch").between(-30, 18) & (F.col("raw_conf") >= 0.6))


@query(
    "agreement_classes", "FLT-11 JOIN-6",
    Q.sql(["v_detections", "v_frames", "v_track_obs"], f"""
SELECT f.clip_id, f.frame, CASE WHEN c.n IS NULL THEN 'NOT_DETECTED' WHEN NOT coalesce(dist <= 10e0 + {Q.TOL}, false) THEN 'DETECTED_NO_MATCH'
    WHEN hot OR cap OR NOT coalesce(confirmed, false) THEN 'DETECTED_REJECTED' ELSE 'DETECTED_CONFIRMED' END AS classification,
  CASE WHEN c.n IS NULL THEN NULL WHEN NOT coalesce(dist <= 10e0 + {Q.TOL}, false) THEN 'no_candidate_near_tracker' WHEN cap THEN 'pitch_hard_max'
    WHEN hot THEN 'hotspot' WHEN NOT coalesce(confirmed, false) THEN 'low_score_or_hysteresis' END AS rejection_detail, {Q.r4('dist')} AS dist
FROM v_frames f LEFT JOIN tr ON tr.clip_id=f.clip_id AND tr.frame=f.frame LEFT JOIN c ON c.clip_id=f.clip_id AND c.frame=f.frame""",
          tr="SELECT clip_id, frame, yaw AS ty, pitch AS tp, weighted_conf >= 0.5e0 AS confirmed FROM v_track_obs QUALIFY row_number() OVER (PARTITION BY clip_id, frame ORDER BY weighted_conf DESC, det_id)=1",
          nd=f"SELECT d.*, {Q.gc('d.yaw', 'd.pitch', 'tr.ty', 'tr.tp')} AS dist FROM v_detections d LEFT JOIN tr ON tr.clip_id=d.clip_id AND tr.frame=d.frame",
          c="""SELECT clip_id, frame, count(*) AS n, min(dist) AS dist, arg_min(pitch > 18e0, {'a': dist, 'b': det_id}) FILTER (dist IS NOT NULL) AS cap,
     arg_min(raw_conf < 0.1e0, {'a': dist, 'b': det_id}) FILTER (dist IS NOT NULL) AS hot FROM nd GROUP BY ALL"""),
)
def agreement_classes(spark, sf):
    det = V.detections(spark, sf)
    track = V.strongest(V.track_obs(spark, sf)).select(
        "clip_id", "frame", F.col("yaw").alias("track_yaw"), F.col("pitch").alias("track_pitch"), (F.col("weighted_conf") >= 0.5).alias("confirmed"))
    cand = det.withColumn("pitch_rejected", F.col("pitch") > 18).withColumn("hotspot_rejected", F.col("raw_conf") < 0.1)
    out = C.agreement_class(V.dense_frames(det), cand, track)
    return out.withColumn("dist", r4("dist"))


@query(
    "redetection_consistency", "FLT-12",
    Q.sql(["v_detections"], f"""
SELECT d.clip_id, d.det_id, {Q.r4('d.tol')} AS tol,
  CASE WHEN n_c=0 THEN NULL WHEN err_c IS NULL THEN 0e0 WHEN err_c <= tol + {Q.TOL} THEN 1e0 ELSE 0.5e0 END AS consistency,
  CASE WHEN n_s=0 THEN NULL WHEN coalesce(err_s <= tol + {Q.TOL}, false) THEN 1 ELSE 0 END AS shifted_consistency
FROM (SELECT clip_id, det_id, greatest(0.5e0, bbox_area_px*(110e0/1280e0)*1.5e0) AS tol,
        CASE WHEN det_id%4=0 THEN 0 ELSE 1 END AS n_c, CASE WHEN det_id%4=0 OR det_id%3=0 THEN 0 ELSE 1 END AS n_s,
        CASE WHEN det_id%5=0 THEN NULL ELSE {Q.gc('yaw', 'pitch', 'yaw+(det_id%9)*0.3e0', 'pitch')} END AS err_c,
        CASE WHEN det_id%5=1 THEN NULL ELSE {Q.gc('yaw', 'pitch', 'yaw', 'pitch+(det_id%7)*0.4e0')} END AS err_s
      FROM v_detections WHERE bbox_area_px IS NOT NULL) d"""),
)
def redetection_consistency(spark, sf):
    d = V.detections(spark, sf).filter("bbox_area_px is not null").withColumn("bbox_width_px", F.col("bbox_area_px"))
    seen = d.filter("det_id % 4 <> 0")
    centred = seen.select("clip_id", "det_id", F.lit("centred").alias("view"),
                          F.expr("case when det_id % 5 = 0 then null else yaw + (det_id % 9) * 0.3e0 end").alias("yaw"), "pitch")
    shifted = seen.filter("det_id % 3 <> 0").select(
        "clip_id", "det_id", F.lit("shifted").alias("view"), F.expr("case when det_id % 5 = 1 then null else yaw end").alias("yaw"),
        F.expr("pitch + (det_id % 7) * 0.4e0").alias("pitch"))
    out = C.redetection_consistency(d, centred.unionByName(shifted))
    return out.withColumn("tol", r4("tol"))


# greedy suppression in SQL: walk a frame's rows by confidence, carrying the kept positions
ND = "SELECT *, row_number() OVER (PARTITION BY clip_id, frame ORDER BY raw_conf DESC, det_id) AS rn FROM v_detections"
NK = f"""SELECT clip_id, frame, rn, det_id, raw_conf, [{{'y': yaw, 'p': pitch}}] AS kept, true AS ok FROM nd WHERE rn=1 UNION ALL
  SELECT clip_id, frame, rn, det_id, raw_conf, CASE WHEN ok THEN list_append(kept, {{'y': yaw, 'p': pitch}}) ELSE kept END, ok FROM
   (SELECT d.*, k.kept, len(list_filter(k.kept, lambda e: {Q.gc('e.y', 'e.p', 'd.yaw', 'd.pitch')} <= 15e0 + {Q.TOL}))=0 AS ok FROM nk k JOIN nd d ON d.clip_id=k.clip_id AND d.frame=k.frame AND d.rn=k.rn+1)"""


@query("frame_nms", "DED-1", Q.sql(["v_detections"], f"SELECT clip_id, frame, det_id, {Q.r4('raw_conf')} AS raw_conf FROM nk WHERE ok", nd=ND, nk=NK))
def frame_nms(spark, sf):
    kept = spatial.greedy_nms(V.detections(spark, sf).select("clip_id", "frame", "det_id", "yaw", "pitch", "raw_conf"),
                              ["clip_id", "frame"], "raw_conf", "det_id", 15.0)
    return kept.select("clip_id", "frame", "det_id", r4("raw_conf").alias("raw_conf"))


@query(
    "top_blobs", "TOP-1",
    Q.sql(["v_detections"], f"""
SELECT clip_id, frame, det_id, {Q.r4('raw_conf')} AS raw_conf FROM v_detections
QUALIFY row_number() OVER (PARTITION BY clip_id, frame ORDER BY raw_conf DESC, det_id) <= 5"""),
)
def top_blobs(spark, sf):
    top = V.detections(spark, sf).withColumn("rk", V.running_rank(["clip_id", "frame"], [F.desc("raw_conf"), "det_id"])).filter("rk <= 5")
    return top.select("clip_id", "frame", "det_id", r4("raw_conf").alias("raw_conf"))


@query(
    "reused_frames_union", "SET-1",
    Q.sql(["v_detections"], f"""
SELECT clip_id, frame, source, count(*) AS n FROM (
  SELECT * FROM v_detections WHERE source='stage0_reuse'
  UNION ALL
  SELECT n.* FROM v_detections n WHERE source='new_detection' AND NOT EXISTS (SELECT 1 FROM v_detections s WHERE s.source='stage0_reuse' AND s.clip_id=n.clip_id AND s.frame=n.frame))
GROUP BY ALL"""),
)
def reused_frames_union(spark, sf):
    det = V.detections(spark, sf)
    old = det.filter("source = 'stage0_reuse'")
    new = det.filter("source = 'new_detection'").join(old.select("clip_id", "frame").distinct(), ["clip_id", "frame"], "left_anti")
    return old.unionByName(new).groupBy("clip_id", "frame", "source").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stride_and_even_sampling", "SMP-3",
    Q.sql(["v_detections", "v_frames"], """
SELECT clip_id, frame, frame % 15 = 0 AS strided, frame IN (SELECT CAST(floor(5 + i*((n.last+1) - 10)/49e0) AS INTEGER) FROM range(50) t(i)) AS even
FROM v_frames JOIN (SELECT clip_id, max(frame) AS last FROM v_frames GROUP BY 1) n USING (clip_id)"""),
)
def stride_and_even_sampling(spark, sf):
    from fieldlens.operators.sampling import even_sample_flag

    det = V.detections(spark, sf)
    frames = V.dense_frames(det)
    return even_sample_flag(frames, det.groupBy("clip_id").agg((F.max("frame") + 1).alias("total")), 50, 5).select(
        "clip_id", "frame", (F.col("frame") % 15 == 0).alias("strided"), "even")
