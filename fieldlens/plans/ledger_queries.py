"""Queries over media ledgers, clip requests and telemetry."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fieldlens.config import LedgerConfig
from fieldlens.functions import geo, text
from fieldlens.functions.geo import r4
from fieldlens.operators import ledger as LG
from fieldlens.operators import merge as M
from fieldlens.operators import telemetry as TM
from fieldlens.operators.scan import frame_block
from fieldlens.plans import sqlkit as Q
from fieldlens.plans.registry import query
from fieldlens.plans.track_queries import rounded
from fieldlens.session import shared_dir
from fieldlens.sources import readers as RD
from fieldlens.sources import views as V
from fieldlens.sources import writers as WR

NOW = "1998-09-01 00:00:00"
NOW_SQL = f"TIMESTAMP '{NOW}'"
VENUE = "Riverside"

FAIL = """SELECT a.media_id, count(*) AS fail_count, max(attempted_at) AS failed_at, arg_max(reason, {'a': attempted_at, 'b': attempt, 'c': tie}) AS reason FROM v_attempts a LEFT JOIN
  (SELECT media_id, max({'a': attempted_at, 'b': attempt, 'c': tie}) AS lo FROM v_attempts WHERE outcome<>'failed' GROUP BY 1) o ON o.media_id=a.media_id
  WHERE outcome='failed' AND (lo IS NULL OR {'a': attempted_at, 'b': attempt, 'c': tie} > lo) GROUP BY a.media_id"""
COOL = f"""SELECT *, {NOW_SQL} < failed_at + to_hours(h) AS in_cooldown FROM (SELECT *, CASE WHEN fail_count>=3 THEN 24 WHEN reason='download failed' THEN 1 ELSE 6 END AS h FROM fails)"""


@query("failure_cooldown", "STR-4 SET-3", Q.sql(["v_attempts"], "SELECT media_id, fail_count, reason, h AS cooldown_h, in_cooldown FROM cool", fails=FAIL, cool=COOL))
def failure_cooldown(spark, sf):
    f = LG.with_cooldown(LG.failure_state(V.attempts(spark, sf)), LG.ntz(NOW))
    return f.select("media_id", "fail_count", "reason", "cooldown_h", "in_cooldown")


@query(
    "media_eligibility", "FLT-8 JOIN-12",
    Q.sql(["v_media", "v_uploads", "v_attempts"], f"""SELECT m.media_id, m.filename, array_to_string(list_filter([CASE WHEN u.media_id IS NOT NULL THEN 'already_uploaded' END, CASE WHEN c.in_cooldown THEN 'in_cooldown' END, CASE WHEN m.file_size<=1e8 THEN 'below_100mb' END,
  CASE WHEN m.updated_at > {NOW_SQL} - INTERVAL 30 MINUTE THEN 'still_processing' END], lambda x: x IS NOT NULL), ';') AS reasons, u.media_id IS NULL AND n.filename IS NOT NULL AS filename_reused
FROM v_media m LEFT JOIN v_uploads u ON u.media_id=m.media_id LEFT JOIN (SELECT DISTINCT filename FROM v_uploads) n ON n.filename=m.filename LEFT JOIN cool c ON c.media_id=m.media_id""", fails=FAIL, cool=COOL),
)
def media_eligibility(spark, sf):
    e = LG.eligibility(V.media(spark, sf), V.uploads(spark, sf), LG.failure_state(V.attempts(spark, sf)), LG.ntz(NOW))
    return e.select("media_id", "filename", F.array_join("reasons", ";").alias("reasons"), "filename_reused")


EFF = f"""SELECT media_id, CASE WHEN captured_at > {NOW_SQL} + INTERVAL 1 DAY THEN created_at WHEN created_at - INTERVAL 14 DAY > captured_at THEN created_at ELSE captured_at END AS ts,
  CASE WHEN captured_at > {NOW_SQL} + INTERVAL 1 DAY THEN 'captured_in_future' WHEN created_at - INTERVAL 14 DAY > captured_at THEN 'captured_long_before_created' ELSE '' END AS reason FROM v_media"""


@query("effective_dates", "FN-23", Q.sql(["v_media"], "SELECT media_id, strftime(ts, '%Y-%m-%d') AS effective_day, reason FROM eff", eff=EFF))
def effective_dates(spark, sf):
    m = V.media(spark, sf).withColumn("e", text.effective_date("captured_at", "created_at", "updated_at", LG.ntz(NOW), 14))
    return m.select("media_id", F.date_format("e.ts", "yyyy-MM-dd").alias("effective_day"), F.col("e.reason").alias("reason"))


@query(
    "missing_dates", "FN-23",
    Q.sql(["v_media"], f"""SELECT media_id, strftime(coalesce(k, u, c), '%Y-%m-%d') AS discovered, strftime(CASE WHEN k IS NOT NULL AND (c IS NULL OR c > {NOW_SQL} + INTERVAL 1 DAY OR k - INTERVAL 14 DAY > c) THEN k
    WHEN c IS NOT NULL THEN c WHEN u IS NOT NULL THEN u ELSE {NOW_SQL} END, '%Y-%m-%d') AS effective_day,
  CASE WHEN c IS NOT NULL AND k IS NOT NULL AND c > {NOW_SQL} + INTERVAL 1 DAY THEN 'captured_in_future' WHEN c IS NOT NULL AND k IS NOT NULL AND k - INTERVAL 14 DAY > c THEN 'captured_long_before_created'
    WHEN c IS NOT NULL THEN '' WHEN k IS NOT NULL THEN 'captured_missing' WHEN u IS NOT NULL THEN 'captured_and_created_missing' ELSE 'no_dates' END AS reason
FROM (SELECT media_id, CASE WHEN media_id%3<>0 THEN captured_at END AS c, CASE WHEN media_id%2<>0 THEN created_at END AS k, CASE WHEN media_id%5<>0 THEN updated_at END AS u FROM v_media)"""),
)
def missing_dates(spark, sf):
    """Every reason of the effective date, and the date of discovery, where dates are missing."""
    have = lambda n, c: F.when(F.col("media_id") % n != 0, F.col(c))
    m = V.media(spark, sf).select("media_id", have(3, "captured_at").alias("c"), have(2, "created_at").alias("k"), have(5, "updated_at").alias("u"))
    e = text.effective_date("c", "k", "u", LG.ntz(NOW), 14)
    m = m.withColumn("e", e).withColumn("found", text.discovery_date("k", "u", "c"))
    return m.select("media_id", F.date_format("found", "yyyy-MM-dd").alias("discovered"), F.date_format("e.ts", "yyyy-MM-dd").alias("effective_day"), F.col("e.reason").alias("reason"))


@query(
    "session_titles", "FN-24",
    Q.sql(["v_media"], f"""SELECT media_id, dayname(captured_at) || ' Session | ' || CAST(day(captured_at) AS VARCHAR) || CASE WHEN day(captured_at) BETWEEN 11 AND 13 THEN 'th' WHEN day(captured_at)%10=1 THEN 'st' WHEN day(captured_at)%10=2 THEN 'nd' WHEN day(captured_at)%10=3 THEN 'rd' ELSE 'th' END
  || ' ' || monthname(captured_at) || ' ' || CAST(year(captured_at) AS VARCHAR) || ' | {VENUE}' || CASE WHEN media_id%2=0 THEN ' | Camera B' ELSE '' END AS title FROM v_media"""),
)
def session_titles(spark, sf):
    return V.media(spark, sf).select("media_id", text.session_title("captured_at", VENUE, F.expr("case when media_id % 2 = 0 then 'B' else '' end")).alias("title"))


@query(
    "filename_times", "FN-25",
    Q.sql(["v_media"], """SELECT media_id, regexp_extract(fn, '^([^-]*-[^-]*-[^-]*-[^-]*)', 1) AS prefix, strftime(captured_at, '%Y-%m-%d %H:%M') AS started, media_id%4=1 AS is_chapter FROM
 (SELECT media_id, captured_at, strftime(captured_at, '%Y-%m-%d-%H-%M-%S') || '_' || CAST(media_id AS VARCHAR) || '.mp4' AS fn FROM v_media)"""),
)
def filename_times(spark, sf):
    m = V.media(spark, sf)
    fn = F.concat(F.date_format("captured_at", "yyyy-MM-dd-HH-mm-ss"), F.lit("_"), F.col("media_id").cast("string"), F.lit(".mp4"))
    named = F.when(F.expr("media_id % 2 = 0"), F.concat(F.lit("match_"), F.date_format("captured_at", "yyyy-MM-dd_HH-mm"), F.lit(".mp4"))).otherwise(
        F.concat(F.date_format("captured_at", "yyyyMMdd_HHmmss"), F.lit(".mp4")))
    chapter = F.expr("case media_id % 4 when 1 then 'S0419_ch02.MP4' when 2 then 's0419x_ch01.mp4' else 's0419_ch1.mov' end")
    return m.select("media_id", text.session_prefix(fn).alias("prefix"), F.date_format(text.start_time_from_filename(named), "yyyy-MM-dd HH:mm").alias("started"),
                    text.is_chapter_of(chapter, F.lit("s0419")).alias("is_chapter"))


@query(
    "time_texts", "FN-19 FN-26",
    Q.sql(["v_media"], f"""SELECT media_id, {Q.r4('s')} AS seconds, {Q.r4('raw')} AS clip_seconds, CASE WHEN s IS NULL OR s<0 THEN 'calculating...' WHEN s>=3600 THEN printf('%dh %dm %ds', CAST(floor(s/3600) AS INT), CAST(floor((s%3600)/60) AS INT), CAST(floor(s)%60 AS INT))
    WHEN s>=60 THEN printf('%dm %ds', CAST(floor(s/60) AS INT), CAST(floor(s)%60 AS INT)) ELSE printf('%ds', CAST(floor(s) AS INT)) END AS words,
  CASE WHEN s IS NOT NULL THEN printf('%02d:%02d:%06.3f', CAST(floor(s/3600) AS INT), CAST(floor((s%3600)/60) AS INT), s%60e0) END AS hms
FROM (SELECT media_id, CASE k WHEN 0 THEN h*3600e0+m*60e0+sec WHEN 1 THEN h*60e0+m WHEN 2 THEN m*60e0+sec WHEN 3 THEN sec+0.5e0 ELSE NULL END AS s, CASE k WHEN 0 THEN h*3600e0+m*60e0+sec WHEN 1 THEN h*3600e0+m*60e0 WHEN 2 THEN m*60e0+sec WHEN 3 THEN sec+0.5e0 ELSE NULL END AS raw
  FROM (SELECT media_id, media_id%5 AS k, media_id%3 AS h, media_id%57 AS m, media_id%58+1 AS sec FROM v_media))"""),
)
def time_texts(spark, sf):
    h, m, s = (F.expr(e).cast("string") for e in ("media_id % 3", "media_id % 57", "media_id % 58 + 1"))
    t = F.when(F.expr("media_id % 5 = 0"), F.concat_ws(":", h, m, s)).when(F.expr("media_id % 5 = 1"), F.concat_ws(":", h, m, F.lit("00"))).when(
        F.expr("media_id % 5 = 2"), F.concat_ws(":", m, s)).when(F.expr("media_id % 5 = 3"), F.concat(s, F.lit(".5"))).otherwise("soon")
    x = V.media(spark, sf).select("media_id", text.time_text_seconds(t).alias("s"), text.time_text_seconds(t, False).alias("raw"))
    return x.select("media_id", r4("s").alias("seconds"), r4("raw").alias("clip_seconds"), text.duration_words("s").alias("words"), F.when(F.col("s").isNotNull(), text.hhmmss_millis("s")).alias("hms"))


@query(
    "page_links", "FN-20 FN-21 FN-22",
    Q.sql(["v_urls"], """SELECT page_id, url AS link, printf('AbC_-%06d', page_id) AS vid, regexp_replace(trim(substr(regexp_replace(url, '[\\\\/*?\\[\\]:]', '', 'g'), 1, 100)), '^$', '') AS tab,
  regexp_replace(regexp_replace(url, '[^A-Za-z0-9_\\-]+', '_', 'g'), '^_+|_+$', '', 'g') AS clip_name,
  CASE page_id%4 WHEN 0 THEN 'video is private' WHEN 1 THEN 'YouTube rate-limited the runner' WHEN 2 THEN 'video unavailable (deleted or region-locked)' ELSE 'download failed' END AS reason FROM v_urls"""),
)
def page_links(spark, sf):
    u = V.urls(spark, sf)
    cell = F.when(F.expr("page_id % 2 = 0"), F.concat(F.lit('=HYPERLINK("'), F.col("url"), F.lit('","View")'))).otherwise(F.concat(F.lit("see "), F.col("url"), F.lit(" now")))
    vid = F.concat(F.expr("case when page_id % 2 = 0 then 'https://x.example/watch?t=1&v=' else 'https://youtu.be/' end"), F.format_string("AbC_-%06d", "page_id"))
    err = F.expr("case page_id % 4 when 0 then 'ERROR: Private video.' when 1 then 'HTTP Error 429: x' when 2 then 'Video unavailable' else 'boom' end")
    return u.select("page_id", text.extract_url(cell).alias("link"), text.video_id(vid).alias("vid"), text.safe_tab_name("url").alias("tab"), text.safe_clip_name("url", "page_id").alias("clip_name"), text.failure_reason(err).alias("reason"))


REQ = """SELECT l_orderkey*8+l_linenumber AS row_no, l_orderkey AS tab, CAST(l_quantity AS INT) AS a, CASE WHEN l_linenumber=3 THEN CAST(l_quantity AS INT)-1 WHEN l_linenumber=4 THEN CAST(l_quantity AS INT)+200 ELSE CAST(l_quantity AS INT)+30 END AS b, l_linenumber AS k FROM lineitem"""


def requests(spark, sf):
    li = V.table(spark, sf, "lineitem")
    a = F.col("l_quantity").cast("int")
    b = F.when(F.col("l_linenumber") == 3, a - 1).when(F.col("l_linenumber") == 4, a + 200).otherwise(a + 30)
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_no"), F.col("l_orderkey").alias("tab"), a.cast("string").alias("start_text"),
        F.when(F.col("l_linenumber") == 5, "later").otherwise(b.cast("string")).alias("end_text"), F.lit("goal").alias("name"),
        F.when(F.col("l_linenumber") == 6, "https://x/1").alias("link"))


@query(
    "clip_request_status", "FLT-9",
    Q.sql([], "SELECT status, count(*) AS n, CAST(sum(CASE WHEN k<>5 THEN b-a END) AS DOUBLE) AS total_s FROM (SELECT *, CASE WHEN k=6 THEN 'not_pending' WHEN k=5 THEN 'Error: bad timestamp' WHEN b-a<=0 THEN 'Error: end before start' WHEN b-a>90 THEN 'Skipped: clip too long' ELSE 'ok' END AS status FROM rq) GROUP BY status", rq=REQ),
)
def clip_request_status(spark, sf):
    r = LG.clip_requests(requests(spark, sf))
    return r.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("end_s") - F.col("start_s")).alias("total_s"))


@query("clip_error_rollup", "AGG-26", Q.sql([], "SELECT tab, count(*) AS errors FROM rq WHERE k IN (3,4,5) GROUP BY tab", rq=REQ))
def clip_error_rollup(spark, sf):
    return LG.clip_errors(LG.clip_requests(requests(spark, sf))).groupBy("tab").agg(F.count(F.lit(1)).alias("errors"))


TRK_IN = "SELECT page_id AS num, url AS link FROM v_urls WHERE page_id%3=0"


@query(
    "tracker_backfill", "AGG-26 JOIN-12",
    Q.sql(["v_urls"], """SELECT top+row_number() OVER (ORDER BY tab, row_no) AS num, CASE WHEN row_no%5=0 THEN 'clip_' || CAST(top+row_number() OVER (ORDER BY tab, row_no) AS VARCHAR) ELSE 'goal' END AS name, tab, row_no, link FROM
 (SELECT url AS link, min({'t': page_id%7, 'r': page_id}).t AS tab, min({'t': page_id%7, 'r': page_id}).r AS row_no FROM v_urls WHERE url NOT IN (SELECT link FROM tr) GROUP BY url), (SELECT max(num) AS top FROM tr)""", tr=TRK_IN),
)
def tracker_backfill(spark, sf):
    u = V.urls(spark, sf)
    clips = u.select(F.expr("page_id % 7").alias("tab"), F.col("page_id").alias("row_no"), F.expr("case when page_id % 5 = 0 then ' ' else 'goal' end").alias("name"), F.concat(F.lit('=HYPERLINK("'), F.col("url"), F.lit('","x")')).alias("link"))
    tracker = u.filter("page_id % 3 = 0").select(F.col("page_id").cast("string").alias("num"), F.col("url").alias("link"))
    return LG.reconcile_tracker(clips, tracker)


@query(
    "ledger_look_back", "FLT-13",
    Q.sql(["v_uploads"], "SELECT media_id, filename FROM (SELECT CASE WHEN media_id%9=0 THEN 'direct:' ELSE '' END || CAST(media_id AS VARCHAR) AS media_id, filename, captured_at FROM v_uploads) WHERE captured_at >= TIMESTAMP '1998-01-01' AND media_id NOT LIKE 'direct:%' AND media_id NOT LIKE 'filename:%'"),
)
def ledger_look_back(spark, sf):
    u = V.uploads(spark, sf).withColumn("media_id", F.concat(F.expr("case when media_id % 9 = 0 then 'direct:' else '' end"), F.col("media_id").cast("string")))
    return LG.look_back(u, LG.ntz("1998-01-01 00:00:00")).select("media_id", "filename")


@query("new_media", "JOIN-12 STR-6", Q.sql(["v_media", "v_uploads"], "SELECT media_id, filename FROM v_media m WHERE NOT EXISTS (SELECT 1 FROM v_uploads u WHERE u.media_id=m.media_id) AND captured_at > (SELECT max(captured_at) FROM v_uploads) - INTERVAL 900 DAY"))
def new_media(spark, sf):
    m, u = V.media(spark, sf), V.uploads(spark, sf)
    cutoff = u.agg((F.max("captured_at") - F.expr("INTERVAL 900 DAY")).alias("cutoff"))  # one row
    return LG.not_in_ledger(m, u, "media_id").crossJoin(F.broadcast(cutoff)).filter("captured_at > cutoff").select("media_id", "filename")


@query("source_filenames", "JOIN-13", Q.sql(["v_uploads"], "SELECT l.l_orderkey AS media_id, l_linenumber, coalesce(u.filename, '') AS filename FROM lineitem l LEFT JOIN v_uploads u ON u.media_id=l.l_orderkey"))
def source_filenames(spark, sf):
    li = V.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("media_id"), "l_linenumber")
    # a plain left join: Spark broadcasts the ledger only while its size is under the threshold
    return li.join(V.uploads(spark, sf).select("media_id", "filename"), "media_id", "left").withColumn("filename", F.coalesce("filename", F.lit("")))


UPS = "SELECT media_id, arg_max({'o': outcome, 'r': reason, 'a': attempt}, {'a': attempted_at, 'b': attempt, 'c': tie}) AS r FROM v_attempts GROUP BY 1"


@query("upserted_ledger", "SET-3", Q.sql(["v_attempts"], "SELECT media_id, r.o AS outcome, r.r AS reason, r.a AS attempt FROM up", up=UPS))
def upserted_ledger(spark, sf):
    a = V.attempts(spark, sf).withColumn("version", F.struct("attempted_at", "attempt", "tie")).select("media_id", "outcome", "reason", "attempt", "version")
    return M.upsert(a.filter("attempt <= 3"), a.filter("attempt > 3"), ["media_id"], "version").drop("version")


@query(
    "label_edit_log", "SET-4",
    Q.sql(["v_attempts"], "SELECT label_id, r.o AS op, r.y AS yaw FROM (SELECT media_id AS label_id, arg_max({'o': CASE WHEN attempt%5=4 THEN 'delete' ELSE 'put' END, 'y': attempt*10e0}, {'a': attempt, 'b': tie}) AS r FROM v_attempts GROUP BY 1) WHERE r.o<>'delete'"),
)
def label_edit_log(spark, sf):
    log = V.attempts(spark, sf).select(F.col("media_id").alias("label_id"), F.expr("case when attempt % 5 = 4 then 'delete' else 'put' end").alias("op"), (F.col("attempt") * 10.0).alias("yaw"), F.struct("attempt", "tie").alias("v"))
    return M.latest_log(log, ["label_id"], "v").drop("v")


@query(
    "index_tidy", "SET-5",
    Q.sql(["v_urls"], """SELECT tab, recent, pending, recent OR pending AS visible FROM (SELECT page_id AS tab, page_id IN (SELECT page_id FROM v_urls WHERE page_id%4<>1 ORDER BY md5(url) DESC, page_id DESC LIMIT 3) AS recent, page_id%6=0 AS pending FROM v_urls WHERE page_id%4<>1)"""),
)
def index_tidy(spark, sf):
    u = V.urls(spark, sf).select(F.col("page_id").alias("tab"), F.expr("case when page_id % 4 = 1 then 'Short' else 'Sunday SESSION' end").alias("title"), F.md5("url").alias("added"))
    return LG.tidy_index(u, u.filter("tab % 6 = 0").select("tab")).select("tab", "recent", "pending", "visible")


@query(
    "duplicate_tabs", "SET-7",
    Q.sql(["v_urls"], "SELECT tab_no, keep FROM (SELECT page_id AS tab_no, row_number() OVER (PARTITION BY page_id%40 ORDER BY len(url) DESC, page_id)=1 AS keep FROM v_urls)"),
)
def duplicate_tabs(spark, sf):
    t = V.urls(spark, sf).select(F.col("page_id").alias("tab_no"), F.expr("concat('u', cast(page_id % 40 as string))").alias("url"), F.length("url").alias("data_rows"))
    return LG.duplicate_tabs(t).select("tab_no", "keep")


@query(
    "first_index_rows", "SET-7",
    Q.sql(["v_urls"], "SELECT page_id AS row_no, CASE WHEN page_id%10=0 THEN '' ELSE 'u' || CAST(page_id%40 AS VARCHAR) END AS url FROM v_urls QUALIFY page_id%10=0 OR row_number() OVER (PARTITION BY CASE WHEN page_id%10=0 THEN '' ELSE 'u' || CAST(page_id%40 AS VARCHAR) END ORDER BY page_id)=1"),
)
def first_index_rows(spark, sf):
    return LG.first_index_rows(V.urls(spark, sf).select(F.col("page_id").alias("row_no"), F.expr("case when page_id % 10 = 0 then '' else concat('u', cast(page_id % 40 as string)) end").alias("url")))


@query(
    "camera_letters", "SET-6",
    Q.sql(["v_media"], """SELECT strftime(day, '%Y-%m-%d') AS day, media_id, CASE WHEN i<=26 THEN chr(CAST(64+i AS INT)) ELSE CAST(i AS VARCHAR) END AS label FROM
 (SELECT day, media_id, row_number() OVER (PARTITION BY day ORDER BY media_id) AS slot FROM md WHERE media_id%3<>0) n JOIN
 (SELECT day, i, row_number() OVER (PARTITION BY day ORDER BY i) AS slot FROM (SELECT DISTINCT day FROM md), range(1, 200) r(i) WHERE (day, i) NOT IN (SELECT day, i FROM tk)) f USING (day, slot)""",
          md="SELECT CAST(captured_at AS DATE) AS day, media_id FROM v_media",
          tk="SELECT DISTINCT day, i FROM (SELECT day, media_id%5+1 AS i FROM md WHERE media_id%6=0 UNION ALL SELECT day, row_number() OVER (PARTITION BY day ORDER BY media_id) FROM md WHERE media_id%6=3)"),
)
def camera_letters(spark, sf):
    m = V.media(spark, sf).select(F.to_date("captured_at").alias("day"), "media_id")
    used = m.filter("media_id % 3 = 0").withColumn("label", F.expr("case when media_id % 6 = 0 then chr(cast(65 + media_id % 5 as int)) end")).drop("media_id")
    return LG.next_camera_letters(m.filter("media_id % 3 <> 0"), used).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


SCAN = "SELECT l_orderkey AS grp, l_linenumber*1200e0 + floor(l_partkey%3)*1e0 AS scan_at, max(CASE WHEN l_linenumber<=2 THEN l_linenumber ELSE 3+l_orderkey%2*(l_linenumber//5) END) AS n_files FROM lineitem GROUP BY 1, 2"
HELD = """SELECT *, scan_at - last_value(ch IGNORE NULLS) OVER (PARTITION BY grp ORDER BY scan_at ROWS UNBOUNDED PRECEDING) AS held FROM (SELECT *, CASE WHEN prev IS NULL OR prev<>n_files THEN scan_at END AS ch FROM (SELECT *, lag(n_files) OVER (PARTITION BY grp ORDER BY scan_at) AS prev FROM scans))"""


def scans(spark, sf):
    n = F.expr("case when l_linenumber <= 2 then l_linenumber else 3 + l_orderkey % 2 * (l_linenumber div 5) end")
    return V.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("grp"), F.expr("l_linenumber * 1200e0 + (l_partkey % 3) * 1e0").alias("scan_at")).agg(F.max(n).alias("n_files"))


@query("completeness_gate", "STR-2", Q.sql([], "SELECT grp, scan_at, n_files, held AS stable_s, CASE WHEN prev IS NULL THEN 'new' WHEN ch IS NOT NULL THEN 'changed' WHEN held>=3600 THEN 'ready' ELSE 'waiting' END AS state FROM hd", scans=SCAN, hd=HELD))
def completeness_gate(spark, sf):
    return LG.completeness(scans(spark, sf))


@query(
    "size_stability_gate", "STR-3",
    Q.sql([], "SELECT grp, scan_at, CASE WHEN n_files*4e9>=15e9 THEN 'ready' WHEN n_files*4e9<5e9 THEN 'ignored' WHEN prev IS NOT NULL AND ch IS NULL AND held>=3600 THEN 'ready' ELSE 'waiting' END AS state FROM hd", scans=SCAN, hd=HELD),
)
def size_stability_gate(spark, sf):
    s = scans(spark, sf).withColumn("n_files", F.col("n_files") * 4e9)
    return LG.size_stability(s, LedgerConfig(tiny_bytes=5e9)).select("grp", "scan_at", "state")


# ---------------------------------------------------------------- telemetry
@query(
    "event_log_keys", "SRC-6",
    Q.sql(["v_events"], "SELECT clip_id, event_type, key, count(*) AS n FROM (SELECT clip_id, event_type, unnest(json_keys(props)) AS key FROM v_events) GROUP BY ALL"),
)
def event_log_keys(spark, sf):
    return RD.key_inventory(V.telemetry(spark, sf).withColumnRenamed("kind", "event_type"), "props", ["clip_id", "event_type"])


@query(
    "event_log_parse", "SRC-6",
    Q.sql(["v_events"], "SELECT clip_id, event_type AS kind, count(*) AS n, count(*) FILTER (event_id%3=0) AS hits, min(frame) AS first_frame FROM v_events WHERE event_id%10<>9 GROUP BY ALL"),
)
def event_log_parse(spark, sf):
    t = V.telemetry(spark, sf)
    name = F.expr("case event_id % 3 when 0 then 'kind' when 1 then 'type' else 'event' end")
    fr = F.expr("case event_id % 2 when 0 then 'frame' else 'frame_idx' end")
    line = F.concat(F.lit('{"'), name, F.lit('":"'), F.col("kind"), F.lit('","'), fr, F.lit('":'), F.col("frame").cast("string"), F.lit(',"hit":'), F.expr("case when event_id % 3 = 0 then 'true' else 'false' end"), F.lit("}"))
    lines = t.select("clip_id", F.when(F.expr("event_id % 10 = 9"), F.lit('{"kind": broken')).otherwise(line).alias("value"))
    return RD.parse_event_lines(lines).groupBy("clip_id", "kind").agg(F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("hits"), F.min("frame").alias("first_frame"))


@query(
    "detection_metrics", "AGG-20",
    Q.sql(["v_telemetry"], f"""SELECT a.clip_id, event_lines, fresh_frames, {Q.r4('fresh_frames*100e0/est')} AS fresh_rate_pct, longest_gap_frames, {Q.r4('longest_gap_frames/(est/60e0)')} AS longest_gap_s, {Q.r4('coast*100e0/pan')} AS coast_pct, {Q.r4('spread')} AS yaw_spread, hits>0 AND pan>=2 AND spread>=1e-4 AS accepted
FROM (SELECT clip_id, count(*) AS event_lines, max(frame)-min(frame)+1 AS est, count(*) FILTER (kind='click' AND k>=50) AS hits, count(*) FILTER (kind='view') AS pan, count(*) FILTER (kind='view' AND k<20) AS coast, max(value) FILTER (kind='view')-min(value) FILTER (kind='view') AS spread FROM v_telemetry GROUP BY 1) a
JOIN (SELECT clip_id, count(*) AS fresh_frames, max(frame-pf) AS longest_gap_frames FROM (SELECT *, lag(frame) OVER (PARTITION BY clip_id ORDER BY frame) AS pf FROM (SELECT DISTINCT clip_id, frame FROM v_telemetry WHERE kind='click' AND k>=50)) GROUP BY 1) g USING (clip_id)"""),
)
def detection_metrics(spark, sf):
    m = TM.detection_metrics(V.telemetry(spark, sf), (F.col("kind") == "click") & (F.col("k") >= 50), F.col("kind") == "view", F.col("k") < 20, "value", 60.0)
    return rounded(m, "fresh_rate_pct", "longest_gap_s", "coast_pct", "yaw_spread")


@query(
    "calibrated_threshold", "AGG-24",
    Q.sql(["v_telemetry"], f"SELECT clip_id, {Q.r4('coalesce(avg(value) FILTER (t<=864000e0)+2.5e0*stddev_pop(value) FILTER (t<=864000e0), 15e0)')} AS threshold FROM v_telemetry GROUP BY 1"),
)
def calibrated_threshold(spark, sf):
    return rounded(TM.calibrated_threshold(V.telemetry(spark, sf), ["clip_id"], "t", "value", 864000.0), "threshold")


SPK = "SELECT clip_id, t, event_id, row_number() OVER (PARTITION BY clip_id ORDER BY t, event_id) AS rn FROM v_telemetry WHERE k>80"
SPW = "SELECT clip_id, t, event_id, rn, t AS last, true AS kept FROM spk WHERE rn=1 UNION ALL SELECT s.clip_id, s.t, s.event_id, s.rn, CASE WHEN s.t-w.last>43200e0 THEN s.t ELSE w.last END, s.t-w.last>43200e0 FROM spw w JOIN spk s ON s.clip_id=w.clip_id AND s.rn=w.rn+1"


@query("debounced_spikes", "AGG-15", Q.sql(["v_telemetry"], "SELECT clip_id, event_id FROM spw WHERE kept", spk=SPK, spw=SPW))
def debounced_spikes(spark, sf):
    t = V.telemetry(spark, sf)
    th = t.select("clip_id").distinct().withColumn("threshold", F.lit(80.0))
    return TM.motion_spikes(t, th, ["clip_id"], "t", "k", "event_id", 43200.0).select("clip_id", "event_id")


PRG = "SELECT clip_id, CAST(row_number() OVER (PARTITION BY clip_id ORDER BY event_id) AS INT) AS tick, t, sum(k) OVER (PARTITION BY clip_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)*60e0 AS work FROM v_telemetry"


def progress(spark, sf):
    from fieldlens.operators.scan import Carry, carry_scan

    t = V.telemetry(spark, sf)
    p = carry_scan(t, ["clip_id"], ["event_id"], F.floor(F.col("event_id") / 1048576), {"tick": Carry("sum", F.lit(1)), "w": Carry("sum", F.col("k"))})
    return p.select("clip_id", F.col("tick").cast("int").alias("tick"), "t", (F.col("w") * 60.0).alias("work"))


@query(
    "sustained_rates", "AGG-27",
    Q.sql(["v_telemetry"], f"""SELECT clip_id, {Q.r4('CASE WHEN a IS NULL THEN 0e0 WHEN z.t>a.t AND z.w>a.w THEN (z.w-a.w)/(z.t-a.t) ELSE 0e0 END')} AS rate, a IS NULL AS failed FROM (SELECT clip_id, arg_min({{'t': t, 'w': work}}, t) FILTER (work>=3000000e0) AS a, arg_max({{'t': t, 'w': work}}, t) AS z FROM prg GROUP BY 1)""", prg=PRG),
)
def sustained_rates(spark, sf):
    return rounded(TM.sustained_rate(progress(spark, sf), "clip_id", "t", "work", 3000000.0), "rate")


SLW = """SELECT *, spd<1.2e0 AS slow FROM (SELECT clip_id, tick, CASE WHEN t-coalesce(lt,0e0)>0 THEN (work-coalesce(lw,0e0))/(t-coalesce(lt,0e0)) ELSE 0e0 END AS spd FROM (SELECT *, lag(t) OVER w AS lt, lag(work) OVER w AS lw FROM prg WHERE tick>=12 AND tick%6=0 WINDOW w AS (PARTITION BY clip_id ORDER BY tick)))"""


@query(
    "slow_encoder_windows", "WIN-14",
    Q.sql(["v_telemetry"], f"""SELECT clip_id, tick, {Q.r4('spd')} AS speed, slow, CASE WHEN slow THEN row_number() OVER (PARTITION BY clip_id, isl ORDER BY tick)-CASE WHEN has0 THEN 1 ELSE 0 END ELSE 0 END AS slow_streak FROM
 (SELECT *, bool_or(NOT slow) OVER (PARTITION BY clip_id, isl) AS has0 FROM (SELECT *, sum(CASE WHEN slow THEN 0 ELSE 1 END) OVER (PARTITION BY clip_id ORDER BY tick ROWS UNBOUNDED PRECEDING) AS isl FROM slw))""", prg=PRG, slw=SLW),
)
def slow_encoder_windows(spark, sf):
    s = TM.slow_windows(progress(spark, sf), "clip_id", "tick", "t", "work", 1.2)
    return s.select("clip_id", "tick", r4("speed").alias("speed"), "slow", "slow_streak")


@query(
    "encoder_aborts", "WIN-14",
    Q.sql(["v_telemetry"], """SELECT clip_id, min(tick) FILTER (c3) AS abort_tick, count(*) AS windows, count(*) FILTER (slow) AS slow_windows FROM (SELECT *, slow AND coalesce(lag(slow,1) OVER w,false) AND coalesce(lag(slow,2) OVER w,false) AS c3 FROM slw WINDOW w AS (PARTITION BY clip_id ORDER BY tick)) GROUP BY clip_id""", prg=PRG, slw=SLW),
)
def encoder_aborts(spark, sf):
    return TM.first_abort(TM.slow_windows(progress(spark, sf), "clip_id", "tick", "t", "work", 1.2), "clip_id", "tick")


@query(
    "host_speeds", "AGG-25 SRC-7",
    Q.sql([], f"SELECT CAST(l_suppkey AS VARCHAR) AS host, {Q.r4('arg_max(l_discount, {a: l_orderkey, b: l_linenumber, c: l_partkey})'.replace('{a:', chr(123) + chr(39) + 'a' + chr(39) + ':').replace(' b:', chr(32) + chr(39) + 'b' + chr(39) + ':').replace(' c:', chr(32) + chr(39) + 'c' + chr(39) + ':'))} AS last_speed, {Q.r4('avg(l_discount)')} AS mean_speed, {Q.r4('min(l_discount)')} AS min_speed, count(l_discount) AS n_samples, max(l_shipdate) > TIMESTAMP '2001-01-01' AS blocked FROM lineitem GROUP BY l_suppkey"),
)
def host_speeds(spark, sf):
    s = V.table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("host"), F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("seq"), F.col("l_discount").alias("speed"), F.col("l_shipdate").cast("timestamp_ntz").alias("block_until"))
    return rounded(LG.host_speeds(s, LG.ntz("2001-01-01 00:00:00")).drop("block_until"), "last_speed", "mean_speed", "min_speed")


@query(
    "blob_action", "AGG-22",
    Q.sql(["v_detections"], f"""SELECT clip_id, frame, {Q.r4('total')} AS total, {Q.r4('cx')} AS cx, {Q.r4('cy')} AS cy, {Q.r4('dp')} AS dispersion, {Q.r4('greatest(0e0,least(1e0,total/(1000e0*1000e0*0.001e0)))*exp(-dp/500e0)')} AS score FROM
 (SELECT b.clip_id, b.frame, any_value(total) AS total, any_value(cx) AS cx, any_value(cy) AS cy, sqrt(sum((pow(bx-cx,2)+pow(by_-cy,2))*a)/max(total)) AS dp FROM bl b JOIN (SELECT clip_id, frame, sum(a) AS total, sum(a*bx)/sum(a) AS cx, sum(a*by_)/sum(a) AS cy FROM bl GROUP BY ALL) c USING (clip_id, frame) GROUP BY b.clip_id, b.frame)""",
          bl="SELECT clip_id, frame, (det_id%200)*1e0 AS a, (det_id%1000)*1e0 AS bx, (det_id%700)*1e0 AS by_ FROM v_detections WHERE det_id%200>=40"),
)
def blob_action(spark, sf):
    b = V.detections(spark, sf).select("clip_id", "frame", F.expr("(det_id % 200) * 1e0").alias("area"), F.expr("(det_id % 1000) * 1e0").alias("bx"), F.expr("(det_id % 700) * 1e0").alias("by"))
    return rounded(TM.blob_action(b, ["clip_id", "frame"], 1000.0), "total", "cx", "cy", "dispersion", "score")


@query(
    "detection_schema_gate", "SRC-8",
    Q.sql(["v_detections"], """SELECT source, errors, count(*) AS n FROM (SELECT CASE WHEN det_id%6=0 THEN 'camera' ELSE 'yolo' END AS source, array_to_string(list_filter([CASE WHEN det_id%6=0 THEN 'bad_source' END, CASE WHEN det_id%50=0 THEN 'missing_geometry' END, CASE WHEN det_id%50<>0 AND bbox_area_px IS NULL THEN 'bad_bbox' END,
  CASE WHEN det_id%50<>0 AND bbox_area_px IS NULL THEN 'bad_area' END, CASE WHEN det_id%50<>0 AND bbox_area_px IS NULL THEN 'bad_aspect' END, CASE WHEN raw_conf*1.1e0>1e0 THEN 'conf_range' END], lambda x: x IS NOT NULL), ';') AS errors FROM v_detections) GROUP BY ALL"""),
)
def detection_schema_gate(spark, sf):
    d = V.with_geometry(V.detections(spark, sf)).withColumn("conf", F.col("raw_conf") * 1.1).withColumn("source", F.expr("case when det_id % 6 = 0 then 'camera' else 'yolo' end"))
    return RD.detection_gate(d).groupBy("source", F.array_join("errors", ";").alias("errors")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "stage_roundtrip", "SNK-1",
    Q.sql(["v_detections"], "SELECT clip_id, count(*) AS n, max(det_id) AS last_det, count(*) FILTER (pitch>18e0) AS audited, count(*) AS reported FROM v_detections GROUP BY 1"),
)
def stage_roundtrip(spark, sf):
    """Data, audit and report of a stage, written by clip and read again."""
    det = V.detections(spark, sf)
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    WR.write_stage(det, det.filter("pitch > 18"), det.groupBy("clip_id").agg(F.count(F.lit(1)).alias("reported")), path)
    data, audit, report = (spark.read.parquet(f"{path}/{p}") for p in ("data", "audit", "report"))
    n = data.groupBy("clip_id").agg(F.count(F.lit(1)).alias("n"), F.max("det_id").alias("last_det"))
    a = audit.groupBy("clip_id").agg(F.count(F.lit(1)).alias("audited"))
    return n.join(a, "clip_id", "left").na.fill(0, ["audited"]).join(report, "clip_id")


@query(
    "frame_documents", "SRC-1 SNK-1 SRC-2",
    Q.sql(["v_detections", "v_frames"], f"SELECT f.clip_id, f.frame, count(d.det_id) AS n, {Q.r4('max(raw_conf)')} AS top FROM v_frames f LEFT JOIN v_detections d ON d.clip_id=f.clip_id AND d.frame=f.frame GROUP BY f.clip_id, f.frame"),
)
def frame_documents(spark, sf):
    """Pack candidates into one document per frame and open them again: empty frames survive."""
    det = V.detections(spark, sf)
    doc = WR.frame_map(det.select("clip_id", "frame", "det_id", "yaw", "pitch", "raw_conf"), V.dense_frames(det))
    doc = doc.select("clip_id", "frame", F.to_json("candidates").alias("doc"))
    back = doc.select("clip_id", "frame", F.explode_outer(F.from_json("doc", "array<struct<det_id:long,yaw:double,pitch:double,raw_conf:double>>")).alias("c"))
    return back.groupBy("clip_id", "frame").agg(F.count("c.det_id").alias("n"), r4(F.max("c.raw_conf")).alias("top"))


@query(
    "sample_series_roundtrip", "SRC-3 SNK-2",
    Q.sql(["v_players"], f"SELECT clip_id, track_id, count(*) AS n, {Q.r4('sum(' + Q.r4('yaw', 2) + ')', 2)} AS yaw_sum, {Q.r4('sum(' + Q.r4('vel', 1) + ')', 2)} AS vel_sum FROM v_players GROUP BY ALL"),
)
def sample_series_roundtrip(spark, sf):
    """Write player samples as rounded JSON lines (one folder per clip), read them back as records."""
    import uuid

    from fieldlens.session import shared_dir

    p = V.players(spark, sf)
    rec = WR.rounded(p, {"yaw": 2, "pitch": 2, "vel": 1}).groupBy("clip_id", "sample", "ts").agg(
        F.collect_list(F.struct("yaw", "pitch", "conf", F.lit(None).cast("double").alias("foot_yaw"), F.lit(None).cast("double").alias("foot_pitch"), "box_h", F.col("vel").alias("vel_deg_per_sec"), "track_id")).alias("players"))
    path = f"{shared_dir(spark)}/samples-{uuid.uuid4().hex}"
    rec = rec.select("clip_id", F.col("ts").alias("timestamp"), F.col("sample").alias("frame"), "players")
    # one file for a stretch of a clip; else every task writes a file for every clip
    rec.repartition("clip_id", frame_block()).write.partitionBy("clip_id").json(path)
    _, back = RD.read_samples(spark, path)
    return back.groupBy("clip_id", "track_id").agg(F.count(F.lit(1)).alias("n"), r4(F.sum("yaw"), 2).alias("yaw_sum"), r4(F.sum("vel"), 2).alias("vel_sum"))


@query(
    "ledger_tables", "SRC-5",
    Q.sql(["v_uploads", "v_attempts"], "SELECT u.media_id, u.filename, coalesce(f.fail_count, 0) AS fail_count FROM v_uploads u LEFT JOIN fails f ON f.media_id=u.media_id", fails=FAIL),
)
def ledger_tables(spark, sf):
    """Uploads with their open failures: the two ledger tables side by side."""
    f = LG.failure_state(V.attempts(spark, sf)).select("media_id", "fail_count")
    return V.uploads(spark, sf).select("media_id", "filename").join(f, "media_id", "left").na.fill(0, ["fail_count"])
