"""Ledger text and date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldlens.functions.geo import col, lit

# These strings are compared with existing sheets and ledgers.
FAILURE_REASONS = (
    ("Sign in to confirm", "YouTube bot-check blocked download — cookies missing/expired"),
    ("no such table", "runner cookie profile unreadable — needs refresh on VM"),
    ("Video unavailable", "video unavailable (deleted or region-locked)"),
    ("Private video", "video is private"),
    ("Requested format is not available", "no 1080p+ format available"),
    ("HTTP Error 429", "YouTube rate-limited the runner"),
)
FAILURE_OTHER = "download failed"
VERDICT_WORDS = {
    "ball": ("likely_ball", "ball", "b"),
    "fp": ("likely_false_positive", "false_positive", "false", "fp", "f"),
    "unclear": ("unclear", "?", "u", "unsure"),
}


def time_text_seconds(text, zero_tail_is_minutes: bool = True) -> Column:
    """Seconds from H:M:S, M:S, a plain number, or (sheet variant) a fraction of a day.

    With ``zero_tail_is_minutes`` a three-part time that ends in zero means M:S.
    Unreadable text gives null.
    """
    t = F.trim(col(text).cast("string"))
    parts = F.transform(F.split(t, ":"), lambda p: p.try_cast("double"))
    a, b, c = (F.try_element_at(parts, F.lit(i)) for i in (1, 2, 3))
    hms = a * lit(3600.0) + b * lit(60.0) + c
    if zero_tail_is_minutes:
        hms = F.when(c == 0, a * lit(60.0) + b).otherwise(hms)
    n = F.size(parts)
    bad = F.exists(parts, lambda p: p.isNull())
    return F.when(~bad & (n == 1), a).when(~bad & (n == 2), a * lit(60.0) + b).when(~bad & (n == 3), hms)


def sheet_number_seconds(value) -> Column:
    """A numeric cell: strictly between 0 and 1 it is a fraction of a day."""
    v = col(value)
    return F.when((v > 0) & (v < 1), v * lit(86400.0)).otherwise(v)


def extract_url(text) -> Column:
    t = F.coalesce(col(text).cast("string"), F.lit(""))
    formula = F.regexp_extract(t, 'HYPERLINK\\("([^"]+)"', 1)
    return F.coalesce(F.nullif(formula, F.lit("")), F.regexp_extract(t, "https?://\\S+", 0))


def video_id(url) -> Column:
    """The 11-character id in a long (?v=) or short link; empty when there is none."""
    u = col(url)
    long_form = F.regexp_extract(u, "[?&]v=([A-Za-z0-9_-]{11})", 1)
    return F.coalesce(F.nullif(long_form, F.lit("")), F.regexp_extract(u, "youtu\\.be/([A-Za-z0-9_-]{11})", 1))


def safe_tab_name(title) -> Column:
    return F.trim(F.substring(F.regexp_replace(col(title), "[\\\\/*?\\[\\]:]", ""), 1, 100))


def safe_clip_name(name, row_number) -> Column:
    cleaned = F.regexp_replace(F.regexp_replace(col(name), "[^A-Za-z0-9_\\-]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.format_string("clip_%02d", col(row_number)))


def failure_reason(text) -> Column:
    out = F.lit(FAILURE_OTHER)
    for needle, reason in reversed(FAILURE_REASONS):
        out = F.when(F.coalesce(col(text), F.lit("")).contains(needle), F.lit(reason)).otherwise(out)
    return out


def normalise_verdict(text) -> Column:
    t = F.regexp_replace(F.lower(F.trim(col(text))), "[ \\-]", "_")
    out = F.lit(None).cast("string")
    for label, words in VERDICT_WORDS.items():
        out = F.when(t.isin(*words), F.lit(label)).otherwise(out)
    return out


def discovery_date(created, updated, captured) -> Column:
    return F.coalesce(col(created), col(updated), col(captured))


def effective_date(captured, created, updated, now, gap_days: int) -> Column:
    """struct(ts, reason): the capture date, unless it is in the future or far older than the arrival."""
    c, k, u = col(captured), col(created), col(updated)
    day = F.expr("INTERVAL 1 DAY")
    gap = F.expr(f"INTERVAL {int(gap_days)} DAY")

    def pick(ts, reason):
        return F.struct(ts.alias("ts"), F.lit(reason).alias("reason"))

    both = c.isNotNull() & k.isNotNull()
    return (
        F.when(both & (c > now + day), pick(k, "captured_in_future"))
        .when(both & (k - gap > c), pick(k, "captured_long_before_created"))
        .when(c.isNotNull(), pick(c, ""))
        .when(k.isNotNull(), pick(k, "captured_missing"))
        .when(u.isNotNull(), pick(u, "captured_and_created_missing"))
        .otherwise(pick(now, "no_dates"))
    )


def ordinal_day(day) -> Column:
    d = col(day)
    suffix = (
        F.when(d.between(11, 13), "th")
        .when(d % 10 == 1, "st")
        .when(d % 10 == 2, "nd")
        .when(d % 10 == 3, "rd")
        .otherwise("th")
    )
    return F.concat(d.cast("string"), suffix)


def session_title(ts, venue: str, camera=None) -> Column:
    """'<Weekday> Session | <day> <Month> <year> | <venue>[ | Camera <x>]'"""
    t = col(ts)
    base = F.concat(
        F.date_format(t, "EEEE"), F.lit(" Session | "), ordinal_day(F.dayofmonth(t)), F.lit(" "),
        F.date_format(t, "MMMM yyyy"), F.lit(f" | {venue}"),
    )
    if camera is None:
        return base
    cam = col(camera)
    return F.when(F.coalesce(cam, F.lit("")) != "", F.concat(base, F.lit(" | Camera "), cam)).otherwise(base)


def session_prefix(filename) -> Column:
    """First four dash-separated parts (date and hour), null with fewer parts."""
    parts = F.split(col(filename), "-")
    return F.when(F.size(parts) >= 4, F.array_join(F.slice(parts, 1, 4), "-"))


def start_time_from_filename(filename) -> Column:
    f = col(filename)
    day = F.regexp_extract(f, "(\\d{4}-\\d{2}-\\d{2})[_ ](\\d{2}[-:]\\d{2})", 1)
    clock = F.translate(F.regexp_extract(f, "(\\d{4}-\\d{2}-\\d{2})[_ ](\\d{2}[-:]\\d{2})", 2), "-", ":")
    compact = F.concat(F.regexp_extract(f, "(\\d{8})[_ ](\\d{6})", 1), F.regexp_extract(f, "(\\d{8})[_ ](\\d{6})", 2))
    return F.coalesce(
        F.try_to_timestamp(F.concat(day, F.lit(" "), clock), F.lit("yyyy-MM-dd HH:mm")),
        F.try_to_timestamp(compact, F.lit("yyyyMMddHHmmss")),
    )


def is_chapter_of(filename, session) -> Column:
    tail = F.regexp_extract(F.lower(col(filename)), "^(.*)_ch[0-9]+\\.mp4$", 1)
    return (tail != "") & (tail == F.lower(col(session)))


def hhmmss_millis(seconds) -> Column:
    s = col(seconds)
    return F.format_string(
        "%02d:%02d:%06.3f", F.floor(s / 3600), F.floor((s % lit(3600.0)) / 60), s % lit(60.0)
    )


def duration_words(seconds) -> Column:
    s = F.floor(col(seconds))
    h, m, r = F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60
    return (
        F.when(col(seconds).isNull() | (col(seconds) < 0), F.lit("calculating..."))
        .when(h > 0, F.format_string("%dh %dm %ds", h, m, r))
        .when(m > 0, F.format_string("%dm %ds", m, r))
        .otherwise(F.format_string("%ds", r))
    )
