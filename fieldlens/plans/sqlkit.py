"""DuckDB text for the oracle: the same views and geometry, written independently as SQL."""

from __future__ import annotations

TOL = "1e-9"


def r4(x: str, places: int = 4) -> str:
    s = f"1e{places}"
    return f"floor(({x}) * {s} + 0.500001e0) / {s}"


def pmod(a: str, n: str = "360e0") -> str:
    return f"(CASE WHEN (({a}) % {n}) < 0 THEN ((({a}) % {n}) + {n}) % {n} ELSE ({a}) % {n} END)"


def wrap(a: str) -> str:
    return f"({pmod(f'({a}) + 180e0')} - 180e0)"


def delta(a: str, b: str) -> str:
    return f"({pmod(f'({a}) - ({b}) + 180e0')} - 180e0)"


def clamp(x: str, lo="0e0", hi="1e0") -> str:
    return f"(CASE WHEN ({x}) IS NOT NULL THEN greatest({lo}, least({hi}, {x})) END)"


def gc(y1, p1, y2, p2) -> str:
    dot = (
        f"sin(radians({p1}))*sin(radians({p2}))"
        f" + cos(radians({p1}))*cos(radians({p2}))*cos(radians(({y1}) - ({y2})))"
    )
    known = f"({y1}) + ({p1}) + ({y2}) + ({p2}) IS NOT NULL"
    return f"(CASE WHEN {known} THEN degrees(acos(greatest(-1e0, least(1e0, {dot})))) END)"


def penalty(d: str, thr: str = "0.6e0", floor_: str = "0.1e0", pmin: str = "0.1e0") -> str:
    return (
        f"(CASE WHEN {d} < {floor_} THEN 1e0 WHEN {d} >= {thr} THEN {pmin} ELSE "
        f"{pmin} + (1e0-{pmin})*0.5e0*(1e0+cos(pi()*(({d})-{floor_})/({thr}-{floor_}))) END)"
    )


def sigmoid(x: str) -> str:
    return f"(1e0/(1e0+exp(-({x}))))"


VIEWS = {
    "v_events": """v_events AS (
  SELECT 'clip' || CAST(user_id // 15 AS VARCHAR) AS clip_id,
         epoch_us(ts)/1e6 - 1704067200e0 AS t, ts,
         CAST(floor((epoch_us(ts)/1e6 - 1704067200e0)/14400e0) AS INTEGER) AS frame,
         event_id, user_id, event_type, value, props
  FROM events)""",
    "v_detections": """v_detections AS (
  SELECT clip_id, frame, event_id AS det_id, user_id AS obj_id,
         (CAST(user_id*47 + CASE WHEN user_id%3=0 THEN 2*frame ELSE 0 END AS DOUBLE) + (event_id%5)*0.2e0) % 360e0 - 180e0 AS yaw,
         CAST((user_id*13)%60-35 AS DOUBLE) + (event_id%3)*0.2e0 AS pitch,
         (event_id%97)/100e0 AS raw_conf,
         (event_id%4)*90e0 AS crop_yaw,
         CASE WHEN event_type='error' THEN 'stage0_reuse' ELSE 'new_detection' END AS source,
         CASE WHEN event_type='error' THEN NULL ELSE value*0.5e0 END AS bbox_area_px,
         CASE WHEN event_type='error' THEN NULL ELSE 0.5e0+(event_id%11)*0.1e0 END AS bbox_aspect_ratio
  FROM v_events)""",
    "v_frames": """v_frames AS (
  SELECT clip_id, CAST(unnest(range(0, max(frame)+1)) AS INTEGER) AS frame
  FROM v_detections GROUP BY clip_id)""",
    "v_track_obs": """v_track_obs AS (
  SELECT clip_id, obj_id AS tracklet_id, frame, det_id, yaw, pitch, raw_conf AS weighted_conf, source, bbox_area_px, bbox_aspect_ratio
  FROM v_detections
  QUALIFY row_number() OVER (PARTITION BY clip_id, obj_id, frame ORDER BY raw_conf DESC, det_id) = 1)""",
    "v_players": """v_players AS (
  SELECT clip_id, frame AS sample, frame*0.5e0 AS ts, tracklet_id AS track_id, det_id, yaw, pitch, weighted_conf AS conf,
         (det_id % 41)*1e0 AS vel, 40e0 + (det_id % 23) AS box_h
  FROM v_track_obs)""",
    "v_media": """v_media AS (
  SELECT o_orderkey AS media_id, 'GX' || CAST(o_custkey AS VARCHAR) || '.MP4' AS filename, o_orderdate AS captured_at,
         o_orderdate + to_days(CAST(o_orderkey % 20 AS INT)) AS created_at,
         o_orderdate + to_days(CAST(o_orderkey % 25 AS INT)) AS updated_at,
         o_totalprice*1000e0 AS file_size
  FROM orders)""",
    "v_uploads": "v_uploads AS (SELECT * FROM v_media WHERE media_id % 3 = 0)",
    "v_attempts": """v_attempts AS (
  SELECT l_orderkey AS media_id, l_shipdate AS attempted_at, l_linenumber AS attempt, l_partkey AS tie,
         CASE WHEN l_returnflag='R' THEN 'failed' ELSE 'ok' END AS outcome,
         CASE WHEN l_linestatus='O' THEN 'download failed' ELSE 'upload rejected' END AS reason
  FROM lineitem)""",
    "v_telemetry": """v_telemetry AS (
  SELECT clip_id, frame, event_id, t, event_type AS kind, value,
         CAST(json_extract_string(props,'$.k') AS DOUBLE) AS k, props
  FROM v_events)""",
    "v_points": """v_points AS (
  SELECT 'all' AS clip_id, vec_id AS id, degrees(atan2(e1,e3)) AS yaw, degrees(asin(e2/sqrt(e1*e1+e2*e2+e3*e3))) AS pitch
  FROM (SELECT vec_id, CAST(embedding[1] AS DOUBLE) e1, CAST(embedding[2] AS DOUBLE) e2, CAST(embedding[3] AS DOUBLE) e3 FROM embeddings))""",
    "v_verdicts": """v_verdicts AS (
  SELECT d.doc_id AS id, CASE WHEN quality=1 AND toxic=0 THEN 'ball' WHEN quality=0 THEN 'fp' ELSE 'unclear' END AS verdict,
         CAST(n_chars AS DOUBLE) AS f1, CAST(d.doc_id%7 AS DOUBLE) AS f2,
         CASE WHEN d.doc_id%9=0 THEN NULL ELSE CAST((d.doc_id*31)%101 AS DOUBLE) END AS f3,
         CAST(n_chars%13 AS DOUBLE) AS f4
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)""",
    "v_urls": "v_urls AS (SELECT page_id, url FROM pages)",
}
NEEDS = {
    "v_detections": ["v_events"],
    "v_frames": ["v_detections"],
    "v_track_obs": ["v_detections"],
    "v_players": ["v_track_obs"],
    "v_uploads": ["v_media"],
    "v_telemetry": ["v_events"],
}


def ctes(names: list[str], extra: dict[str, str] | None = None) -> str:
    """Ordered CTE list for the named views, their inputs, then ``extra`` (name -> select)."""
    order: list[str] = []

    def visit(n):
        for d in NEEDS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = [VIEWS[n] for n in order]
    parts += [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    return ",\n".join(parts)


def sql(views: list[str], body: str, **extra: str) -> str:
    head = ctes(views, extra)
    return f"WITH RECURSIVE {head}\n{body}" if head else body
