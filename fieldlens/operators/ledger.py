"""Media arrivals, upload ledger, clip requests and index upkeep.

``now`` is always a parameter: results do not depend on when a job runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.config import LedgerConfig
from fieldlens.functions import geo, text
from fieldlens.operators.scan import Carry, carry_scan, row_index

# Ids of rows that did not come from the camera cloud.
SYNTHETIC_PREFIXES = ("direct:", "filename:")
LETTERS = [chr(c) for c in range(ord("A"), ord("Z") + 1)]
TRANSIENT_REASONS = ("no download URL", "download failed")


def ntz(value: str) -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{value}'")


def failure_state(attempts: DataFrame) -> DataFrame:
    """Current failures per media: consecutive failures since the last success, and the last one.

    attempts: media_id, attempted_at, attempt, outcome, reason, tie. Two aggregates combined
    map-side, no per-media ordering.
    """
    at = F.struct("attempted_at", "attempt", "tie")
    ok = attempts.filter("outcome <> 'failed'").groupBy("media_id").agg(F.max(at).alias("last_ok"))
    bad = attempts.filter("outcome = 'failed'").withColumn("at", at).join(ok, "media_id", "left")
    live = bad.filter(F.col("last_ok").isNull() | (F.col("at") > F.col("last_ok")))
    return live.groupBy("media_id").agg(
        F.count(F.lit(1)).alias("fail_count"), F.max("attempted_at").alias("failed_at"), F.max_by("reason", "at").alias("reason"))


def cooldown_hours(fail_count="fail_count", reason="reason") -> Column:
    """24 h from the third failure in a row, 1 h for transient reasons, 6 h otherwise."""
    return F.when(F.col(fail_count) >= 3, 24).when(F.col(reason).isin(*TRANSIENT_REASONS), 1).otherwise(6)


def with_cooldown(state: DataFrame, now: Column) -> DataFrame:
    until = F.col("failed_at") + F.expr("make_interval(0, 0, 0, 0, cooldown_h)")
    return state.withColumn("cooldown_h", cooldown_hours()).withColumn("blocked_until", until).withColumn("in_cooldown", now < F.col("blocked_until"))


def eligibility(media: DataFrame, uploads: DataFrame, failures: DataFrame, now: Column, cfg: LedgerConfig = LedgerConfig()) -> DataFrame:
    """Reasons why a media item is not uploaded; empty = accepted. A reused filename only warns."""
    up = uploads.select("media_id").distinct().withColumn("up", F.lit(True))
    names = uploads.groupBy("filename").agg(F.count(F.lit(1)).alias("name_hits"))
    f = with_cooldown(failures, now).select("media_id", "in_cooldown")
    j = media.join(up, "media_id", "left").join(names, "filename", "left").join(f, "media_id", "left")
    young = (F.col("updated_at") > now - F.expr(f"INTERVAL {int(cfg.processing_minutes)} MINUTE"))
    reasons = F.array_compact(F.array(
        F.when(F.col("up"), "already_uploaded"),
        F.when(F.col("in_cooldown"), "in_cooldown"),
        F.when(F.col("file_size") <= cfg.min_video_bytes, "below_100mb"),
        F.when(young, "still_processing"),
    ))
    return j.select("media_id", "filename", reasons.alias("reasons"), (F.col("up").isNull() & F.col("name_hits").isNotNull()).alias("filename_reused")).withColumn(
        "accepted", F.size("reasons") == 0)


def look_back(uploads: DataFrame, cutoff: Column, limit: int | None = None) -> DataFrame:
    """Ledger rows captured since the cutoff, without synthetic ids, newest first."""
    id_ = F.col("media_id").cast("string")
    keep = F.lit(True)
    for p in SYNTHETIC_PREFIXES:
        keep = keep & ~id_.startswith(p)
    out = uploads.filter((F.col("captured_at") >= cutoff) & keep).orderBy(F.desc("captured_at"), "media_id")
    return out.limit(limit) if limit else out


def not_in_ledger(items: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    return items.join(ledger.select(key).distinct(), key, "left_anti")


def clip_requests(req: DataFrame, cfg: LedgerConfig = LedgerConfig()) -> DataFrame:
    """Validate requested clips. req: row_no, start_text, end_text, name, link."""
    s, e = text.time_text_seconds("start_text"), text.time_text_seconds("end_text")
    r = req.withColumn("start_s", s).withColumn("end_s", e)
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    pending = ~blank("start_text") & ~blank("end_text") & blank("link")
    dur = F.col("end_s") - F.col("start_s")
    status = (
        F.when(~pending, "not_pending").when(F.col("start_s").isNull() | F.col("end_s").isNull(), "Error: bad timestamp")
        .when(dur <= 0, "Error: end before start").when(dur > cfg.max_clip_seconds, "Skipped: clip too long").otherwise("ok"))
    return r.withColumn("status", status).withColumn("clip_name", text.safe_clip_name("name", "row_no"))


def tidy_index(index: DataFrame, pending: DataFrame, keep_recent: int = 3) -> DataFrame:
    """Session rows only, oldest first; visible when among the newest or with pending clips.

    index: tab, title, added. The newest few are found by a top-k, not by a global rank.
    """
    s = index.filter(F.lower("title").contains("session"))
    newest = s.orderBy(F.desc("added"), F.desc("tab")).limit(keep_recent).select("tab", F.lit(True).alias("recent"))
    return s.join(newest, "tab", "left").join(pending.select("tab").distinct().withColumn("pending", F.lit(True)), "tab", "left").select(
        "tab", "title", "added", F.coalesce("recent", F.lit(False)).alias("recent"), F.coalesce("pending", F.lit(False)).alias("pending"),
        (F.coalesce("recent", F.lit(False)) | F.coalesce("pending", F.lit(False))).alias("visible"))


def duplicate_tabs(tabs: DataFrame) -> DataFrame:
    """Per URL keep the tab with most rows (first on ties). tabs: tab_no, url, data_rows."""
    best = tabs.groupBy("url").agg(F.max_by("tab_no", F.struct(F.col("data_rows"), -F.col("tab_no"))).alias("keep_no"))
    return tabs.join(best, "url").withColumn("keep", F.col("tab_no") == F.col("keep_no")).drop("keep_no")


def first_index_rows(index: DataFrame) -> DataFrame:
    """First row per URL; rows without a URL all stay. index: row_no, url."""
    has = F.coalesce(F.col("url"), F.lit("")) != ""
    first = index.filter(has).groupBy("url").agg(F.min("row_no").alias("row_no"))
    return index.filter(~has).unionByName(index.filter(has).join(first, ["url", "row_no"], "left_semi"))


def next_camera_letters(new: DataFrame, used: DataFrame) -> DataFrame:
    """Give each new recording of a date the next free camera letter (a number after Z).

    new: day, media_id. used: day, label (null for old rows, which occupy A, B, ... by count).
    """
    legacy = used.filter("label is null").groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    legacy = legacy.select("day", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i")).select("day", _letter(F.col("i")).alias("label"))
    taken = used.filter("label is not null").select("day", "label").unionByName(legacy).distinct()
    want = new.groupBy("day").agg(F.count(F.lit(1)).alias("k"))
    have = taken.groupBy("day").agg(F.count(F.lit(1)).alias("t"))
    free = (
        want.join(have, "day", "left").select("day", F.explode(F.sequence(F.lit(1).cast("long"), F.col("k") + F.coalesce("t", F.lit(0)))).alias("i"))
        .withColumn("label", _letter(F.col("i"))).join(taken, ["day", "label"], "left_anti"))
    # a busy day may hold a large share of all rows: number in blocks, not in one window
    free = row_index(free, ["day"], ["i"], F.floor(F.col("i") / 65536), "slot")
    rank = row_index(new, ["day"], ["media_id"], F.floor(F.col("media_id") / 65536), "slot")
    return rank.join(free, ["day", "slot"]).select("day", "media_id", "label")


def _letter(i: Column) -> Column:
    return F.when(i <= len(LETTERS), F.element_at(F.array(*[F.lit(c) for c in LETTERS]), F.least(i, F.lit(len(LETTERS))).cast("int"))).otherwise(i.cast("string"))


def reconcile_tracker(clips: DataFrame, tracker: DataFrame) -> DataFrame:
    """Rows to append: clips with a link that the tracker lacks, numbered after its maximum.

    clips: tab, row_no, name, link. tracker: num, link. The first row per link counts.
    """
    have = tracker.select(text.extract_url("link").alias("link")).filter("link <> ''").distinct()
    c = clips.withColumn("link", text.extract_url("link")).filter("link <> ''").join(have, "link", "left_anti")
    c = c.groupBy("link").agg(F.min(F.struct("tab", "row_no", "name")).alias("r")).select("link", "r.*")
    top = tracker.agg(F.coalesce(F.max(F.col("num").try_cast("long")), F.lit(0)).alias("top"))  # one row
    n = row_index(c.withColumn("_one", F.lit(1)), ["_one"], ["tab", "row_no"], F.col("tab"), "i")
    return n.crossJoin(F.broadcast(top)).select(
        (F.col("top") + F.col("i")).alias("num"), F.coalesce(F.nullif(F.trim("name"), F.lit("")), F.concat(F.lit("clip_"), (F.col("top") + F.col("i")).cast("string"))).alias("name"), "tab", "row_no", "link")


def clip_errors(requests: DataFrame) -> DataFrame:
    return requests.filter(F.col("status").startswith("Error:") | F.col("status").startswith("Skipped:"))


# ---------------------------------------------------------------- gates
def completeness(scans: DataFrame, cfg: LedgerConfig = LedgerConfig()) -> DataFrame:
    """Per group and scan: new / changed / waiting / ready, from the file count over time.

    scans: grp, scan_at (seconds), n_files. Ready when the count held for an hour. Groups that
    vanish simply have no later row.
    """
    block = F.floor(F.col("scan_at") / 1e6)
    s = carry_scan(scans, ["grp"], ["scan_at"], block, {"prev": Carry("last", F.col("n_files"), exclusive=True)})
    change = F.when(F.col("prev").isNull() | (F.col("prev") != F.col("n_files")), F.col("scan_at"))
    s = carry_scan(s.withColumn("change_at", change), ["grp"], ["scan_at"], block, {"since": Carry("last", F.col("change_at"))})
    held = F.col("scan_at") - F.col("since")
    state = F.when(F.col("prev").isNull(), "new").when(F.col("change_at").isNotNull(), "changed").when(held >= cfg.stable_seconds, "ready").otherwise("waiting")
    return s.select("grp", "scan_at", "n_files", held.alias("stable_s"), state.alias("state"))


def size_stability(scans: DataFrame, cfg: LedgerConfig = LedgerConfig()) -> DataFrame:
    """15 GB and more goes at once, below 1 GB is ignored, the rest must be stable for an hour.

    scans: grp, scan_at, n_files = size in bytes.
    """
    c = completeness(scans, cfg)
    size = F.col("n_files")
    return c.withColumn("state", F.when(size >= cfg.huge_bytes, "ready").when(size < cfg.tiny_bytes, "ignored").when(F.col("state") == "ready", "ready").otherwise("waiting"))


def host_speeds(samples: DataFrame, now: Column | None = None) -> DataFrame:
    """samples: host, seq, speed, block_until."""
    g = samples.groupBy("host").agg(
        F.max_by("speed", "seq").alias("last_speed"), F.avg("speed").alias("mean_speed"), F.min("speed").alias("min_speed"), F.count("speed").alias("n_samples"),
        F.max("block_until").alias("block_until"))
    return g if now is None else g.withColumn("blocked", F.coalesce(now < F.col("block_until"), F.lit(False)))
