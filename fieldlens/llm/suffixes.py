"""Exact repeated bytes by bucket-pointer refinement over the suffixes of the whole corpus.

All texts stand one after another in the order of their ids, so a suffix is one number: its place
in that row of bytes. A bucket is the set of suffixes that begin alike; its pointer is its
smallest place. A suffix alone in its bucket is settled; others are refined by the identifiers of
buckets at later offsets, and what a finer bucket is called is made of the identifiers before:
16 bytes at i and i + 16 name 32, those at i and i + 32 name 64, those at i and i + 36 name the
``MATCH`` = 100 bytes that decide. A suffix is repeated if the pointer of its 100-byte bucket is
not itself: the pointer is where the string starts first.

Suffixes need not enter the buckets one by one. A window of 100 bytes goes by its *key gram*, the
one of its 85 16-grams with the smallest identifier (the first, on ties); equal windows have it at
the same offset. Neighbouring windows mostly share it and travel as one *segment*.

1. 16-byte buckets of key grams: segments alone in theirs are settled.
2. Whole segments: one whose bytes all stand in an earlier segment is repeated outright, and only
   the pointer of each bucket of equal segments goes on. A passage or a group of near copies of any
   size is thereby looked into once.
3. 80-byte buckets around the key gram: windows that have it at offsets ``STEP`` * c and the next
   20 all hold the 80 bytes from c steps before it, so that part of a segment is settled if it is
   alone in that bucket.
4. 100-byte buckets of the suffixes in what is left.

Every step counts and takes minima, which combine before the shuffle, and joins back to one row per
bucket, so that a bucket of any size costs its rows and no pairs. Identifiers have 64 bits in steps
1 and 3, which only settle, and 96 where they decide. Texts move three times.

Nulls and cases: a null text is empty. Rows that agree in id and text are one document and share
its result; rows of one id and different texts stand in the order of a hash of the text; null ids
stand last. Later copies of a whole text are repeated from end to end (texts under 100 bytes lose
nothing). Very long texts are read in pieces that overlap by 99 bytes. An empty table gives no
rows. Columns other than id and text are carried along and not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.common import release, running_total, stored, table, text_of

MATCH = 100
GRAM = 16  # bytes of an initial bucket
SPAN = MATCH - GRAM + 1  # grams of a window
STEP = 21  # windows that share an 80-byte bucket: MATCH - STEP + 1 bytes
PIECE = 1 << 20  # window starts of a text read at a time
BLOCK = 1 << 17  # bytes of texts read together: their identifiers, eight times as many, stay in a core's cache
GATHER = 1 << 15  # rows that go to Spark together
PLACE_BITS = 21
# fixed values: odd multipliers of the two families of identifiers, and the stirring of SplitMix64
FAMILY = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
STIR = np.uint64(0xBF58476D1CE4E5B9)


def paired(a: np.ndarray, b: np.ndarray, family: int = 0) -> np.ndarray:
    """The identifier of two buckets in a row."""
    x = a * np.uint64(FAMILY[family])
    x += b
    return _stirred(x)


def _stirred(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(29)
    x *= STIR
    x ^= x >> np.uint64(32)
    return x


def gram_buckets(data: np.ndarray) -> np.ndarray:
    """The identifier of the 16 bytes from each place. Eight bytes name themselves, as one number; they are stirred
    (one to one) before they pair, as plain bytes of a pair could cancel."""
    h = np.empty(len(data) - 7, np.uint64)
    for k in range(8):
        h[k::8] = data[k : k + (len(data) - k) // 8 * 8].view(np.uint64)
    h *= np.uint64(FAMILY[0])
    h = _stirred(h)
    return paired(h[:-8], h[8:])


def finer(grams: np.ndarray, at: np.ndarray, family: int = 0) -> np.ndarray:
    """The identifier of the 100 bytes from the places ``at``; families share the identifiers of 16 bytes."""
    def named64(i):
        return paired(paired(grams[i], grams[i + 16], family), paired(grams[i + 32], grams[i + 48], family), family)

    return paired(named64(at), named64(at + MATCH - 64), family)


def shared_part(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The identifier of the MATCH - STEP + 1 = 80 bytes from the places ``at``."""
    first, last = paired(grams[at], grams[at + 16]), paired(grams[at + 32], grams[at + 48])
    return paired(paired(first, last), grams[at + 64])


def key_grams(grams: np.ndarray) -> np.ndarray:
    """For each window start, where the smallest of its grams is (the first, on ties)."""
    low = np.uint64((1 << PLACE_BITS) - 1)
    m = grams & ~low
    m |= np.arange(len(grams), dtype=np.uint64)
    step = 1
    while step * 2 <= SPAN:
        m = np.minimum(m[:-step], m[step:])
        step *= 2
    rest = SPAN - step
    if rest:
        m = np.minimum(m[:-rest], m[rest:])
    m &= low
    return m.view(np.int64)


class Piece:
    """Some documents, or a part of a long one, as one row of bytes with their window starts."""

    def __init__(self, parts: list[tuple[int, int, bytes]]):
        # (start of the document, offset of the part in it, its bytes)
        self.data = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
        sizes = np.array([len(p[2]) for p in parts])
        self.begins = np.cumsum(sizes) - sizes
        self.docs = np.array([p[0] for p in parts], np.int64)
        self.offsets = np.array([p[1] for p in parts], np.int64)
        self.stops = self.begins + sizes - MATCH + 1  # after the last window start

    def of(self, at: np.ndarray) -> np.ndarray:
        """Which part each place is in."""
        return np.searchsorted(self.begins, at, side="right") - 1

    def segments(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(part, first window, last window, key gram) of each segment."""
        key = key_grams(grams)
        n = len(key)
        # a run ends where the key gram or the document changes
        edge = np.ones(n + 1, bool)
        np.not_equal(key[1:], key[:-1], out=edge[1:-1])
        edge[self.begins], edge[self.stops] = True, True
        at = np.flatnonzero(edge)
        first, last = at[:-1], at[1:] - 1
        part = self.of(first)
        good = first < self.stops[part]
        part, first, last = part[good], first[good], last[good]
        return part, first, last, key[first]


def pieces(rows: Iterator[tuple]) -> Iterator[tuple[Piece, list]]:
    """Documents (start, bytes, extra...) in pieces of a bounded size, long ones alone; texts without a window are left out."""
    held, extras, size = [], [], 0
    for start, raw, *extra in rows:
        for lo in range(0, len(raw) - MATCH + 1, PIECE):
            part = raw[lo : lo + PIECE + MATCH - 1]
            if size + len(part) > min(BLOCK, PIECE + MATCH - 1) and held:
                yield Piece(held), extras
                held, extras, size = [], [], 0
            held.append((start, lo, part))
            extras.append(extra)
            size += len(part)
    if held:
        yield Piece(held), extras


def _texts(batches: Iterator[pa.RecordBatch], key: str = "start") -> Iterator[tuple]:
    """(key, bytes, other columns...) row by row, without copies of whole batches."""
    for batch in batches:
        text = batch.column("text").cast(pa.large_binary())
        keys = batch.column(key).to_pylist()
        others = [c for n, c in zip(batch.schema.names, batch.columns) if n not in (key, "text")]
        for i in range(batch.num_rows):
            yield (keys[i], text[i].as_py(), *[c[i].values.to_numpy(zero_copy_only=False) for c in others])


def _rows(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns], names=names)


def _gathered(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same rows in batches of some size: a batch costs its way to Spark, however few its rows."""
    @wraps(rows)
    def gather(batches):
        held, count = [], 0
        for batch in rows(batches):
            held.append(batch)
            count += batch.num_rows
            if count >= GATHER:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, count = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return gather


@_gathered
def _key_gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, key, place): the bucket of each segment's key gram, and in which text and where it is."""
    for piece, _ in pieces(_texts(batches, "key")):
        grams = gram_buckets(piece.data)
        part, _, _, key = piece.segments(grams)
        place = piece.offsets[part] + key - piece.begins[part]
        yield _rows(["gram", "key", "place"], grams[key], piece.docs[part], place.astype(np.int32))


SEGMENTS = "s1 bigint, s2 int, start bigint, first int, n int, gram int, parts array<bigint>"


@_gathered
def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments whose key gram is in ``places``: the identifier of all their bytes, their windows, the
    place of the key gram, and the 80-byte buckets of their parts from the last windows to the first."""
    for piece, extras in pieces(_texts(batches)):
        grams = gram_buckets(piece.data)
        part, first, last, key = piece.segments(grams)
        hot = np.zeros(len(piece.data), bool)
        ends = np.append(piece.begins[1:], len(piece.data))
        for k, (places,) in enumerate(extras):
            at = places.astype(np.int64) - piece.offsets[k] + piece.begins[k]
            hot[at[(at >= piece.begins[k]) & (at < ends[k])]] = True
        part, first, last, key = (x[hot[key]] for x in (part, first, last, key))
        if not len(part):
            continue
        n = last - first + 1
        s1 = paired(finer(grams, first), finer(grams, last)) + n.astype(np.uint64)
        s2 = _high(paired(finer(grams, first, 1), finer(grams, last, 1), 1))
        low, high = (key - last) // STEP, (key - first) // STEP
        count = high - low + 1
        which = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        parts = shared_part(grams, np.repeat(key, count) - which * STEP).view(np.int64)
        local = piece.begins[part] - piece.offsets[part]
        rows = _rows(["s1", "s2", "start", "first", "n", "gram"], s1, s2, piece.docs[part], *(x.astype(np.int32) for x in (first - local, n, key - local)))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), pa.array(parts))
        yield pa.RecordBatch.from_arrays([*rows.columns, lists], names=[*rows.schema.names, "parts"])


@_gathered
def _suffix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h1, h2, start, place): the 100-byte buckets of the suffixes in the ranges of each document."""
    for piece, extras in pieces(_texts(batches)):
        wanted = np.zeros(len(piece.data) + 1, np.int64)
        for k, (begins, counts) in enumerate(extras):
            lo = begins.astype(np.int64) - piece.offsets[k] + piece.begins[k]
            hi = np.minimum(lo + counts, piece.stops[k])
            lo = np.maximum(lo, piece.begins[k])
            ok = hi > lo
            np.add.at(wanted, lo[ok], 1)
            np.add.at(wanted, hi[ok], -1)
        at = np.flatnonzero(np.cumsum(wanted[:-1]) > 0)
        if not len(at):
            continue
        grams = gram_buckets(piece.data)
        h1, h2 = finer(grams, at), _high(finer(grams, at, 1))
        part = piece.of(at)
        yield _rows(["h1", "h2", "start", "place"], h1, h2, piece.docs[part], (piece.offsets[part] + at - piece.begins[part]).astype(np.int32))


def _high(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _mark(text: Column) -> Column:
    return F.unhex(F.md5(text))


def texts_in_a_row(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(mark, key, owner, n_bytes, start): each text by its hash (and a short one), the id of the first document that has it,
    and where its bytes start when all texts stand in a row."""
    text = text_of(text_col)
    each = docs.select(F.col(id_col).alias("id"), _mark(text).alias("mark"), F.octet_length(text).alias("n_bytes"), F.xxhash64(text).alias("key")).distinct()
    first = F.min(F.struct(F.col("id").isNull().alias("void"), "id")).alias("f")
    owners = each.groupBy("mark").agg(first, F.first("n_bytes").alias("n_bytes"), F.first("key").alias("key"))
    owners = owners.select("mark", F.col("f.id").alias("owner"), "n_bytes", "key")
    numbered = stored(owners.orderBy(F.col("owner").isNull(), "owner", "mark").withColumn("_no", F.monotonically_increasing_id()))
    # whole numbers from 0: rows of earlier partitions, then the row in its own
    part, row = F.shiftrightunsigned("_no", 33), F.col("_no").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = running_total(numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows")), "_part", "_rows", "_rows_before")
    dense = numbered.join(sizes.select("_part", "_rows_before"), part == F.col("_part")).withColumn("_no", F.col("_rows_before") + row)
    return stored(running_total(dense, "_no", "n_bytes", "start").select("mark", "key", "owner", "n_bytes", "start"))


def repeated_windows(docs: DataFrame, owners: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(start, begins, counts): for each text, ranges of windows that start earlier, from the text's own start."""
    text = text_of(text_col)
    long = F.octet_length(text) >= MATCH
    # all rows are read here, as texts are few bytes to read again and many to move; a copy of a text meets
    # no other place than the text itself
    grams = docs.filter(long).select(F.xxhash64(text).alias("key"), text.alias("text")).mapInArrow(_key_gram_rows, "gram bigint, key bigint, place int")
    spot = F.xxhash64("key", "place")
    shared = stored(grams.groupBy("gram").agg(F.min(spot).alias("a"), F.max(spot).alias("b")).filter("a < b").select("gram"))
    places = grams.join(shared, "gram", "left_semi").groupBy("key").agg(F.collect_set("place").alias("places"))
    places = stored(places.join(owners, "key").select("mark", "owner", "start", "places"))

    def with_text(lists: DataFrame, *columns: str) -> DataFrame:
        rows = docs.filter(long).select(F.col(id_col).alias("id"), text.alias("text"), _mark(text).alias("r_mark"))
        return rows.join(lists, (rows["r_mark"] == lists["mark"]) & rows["id"].eqNullSafe(lists["owner"])).select("start", "text", *columns)

    segments = stored(with_text(places, "places").mapInArrow(_segment_rows, SEGMENTS))
    release(places, shared)
    suffix = F.col("start") + F.col("first")
    # written, so that Spark can split the join of a bucket with many segments
    heads = stored(segments.groupBy("s1", "s2").agg(F.min(suffix).alias("pointer"), F.max(suffix).alias("last")).filter("pointer < last").drop("last"))
    is_first = F.col("pointer").isNull() | (suffix == F.col("pointer"))
    pointed = stored(segments.join(heads, ["s1", "s2"], "left").withColumn("is_first", is_first).drop("s1", "s2", "pointer"), heads)
    again = pointed.filter(~F.col("is_first")).select("start", "first", "n")

    # part c of a segment: its windows that have the key gram STEP * c to STEP * c + 20 bytes on
    c = F.floor((F.col("gram") - F.col("first") - F.col("n") + 1) / STEP) + F.col("at")
    begin = F.greatest(F.col("first"), F.col("gram") - c * STEP - (STEP - 1))
    end = F.least(F.col("first") + F.col("n") - 1, F.col("gram") - c * STEP)
    parts = pointed.filter("is_first").select("start", "first", "n", "gram", F.posexplode("parts").alias("at", "bucket"))
    parts = parts.select("start", c.cast("int").alias("side"), "bucket", begin.cast("int").alias("first"), (end - begin + 1).cast("int").alias("n"))
    met = stored(parts.groupBy("side", "bucket").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").drop("k"))
    open_ = _by_text(parts.join(met, ["side", "bucket"], "left_semi"))
    # an empty text starts where the next one does
    open_ = stored(open_.join(owners.filter(F.col("n_bytes") >= MATCH), "start").select("start", "mark", "owner", "begins", "counts"))
    held = stored(with_text(open_, "begins", "counts"))
    release(segments, met, open_)

    suffixes = held.mapInArrow(_suffix_rows, "h1 bigint, h2 int, start bigint, place int")
    # made once for the pointers and once to meet them, as they take more room than time
    at = F.col("start") + F.col("place")
    pointers = stored(suffixes.groupBy("h1", "h2").agg(F.min(at).alias("pointer"), F.count(F.lit(1)).alias("k")).filter("k > 1").drop("k"))
    late = suffixes.join(pointers, ["h1", "h2"]).filter(at > F.col("pointer")).select("start", F.col("place").alias("first"), F.lit(1).alias("n"))
    return stored(_by_text(again.unionByName(late)), held, pointed, pointers)


def _by_text(ranges: DataFrame) -> DataFrame:
    both = ranges.groupBy("start").agg(F.collect_set(F.shiftleft(F.col("first").cast("bigint"), 32) + F.col("n")).alias("r"))
    begins, counts = F.transform("r", lambda x: F.shiftright(x, 32).cast("int")), F.transform("r", lambda x: x.bitwiseAND(F.lit((1 << 32) - 1)).cast("int"))
    return both.select("start", begins.alias("begins"), counts.alias("counts"))


LEFT = T.StructType().add("n_bytes", T.LongType()).add("n_removed", T.LongType()).add("n_spans", T.LongType()).add("kept", T.BinaryType())


def without_ranges(raw: bytes, begins: np.ndarray, counts: np.ndarray) -> tuple[bytes, int]:
    """The bytes that no repeated window covers, and how many runs of bytes went."""
    mark = np.zeros(len(raw) + 1, np.int64)
    np.add.at(mark, begins, 1)
    np.add.at(mark, begins + counts + MATCH - 1, -1)
    gone = np.cumsum(mark[:-1]) > 0
    spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1])) if len(raw) else 0
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), spans


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept): every input row as a struct and what is left of its bytes."""
    owners = texts_in_a_row(docs, id_col, text_col)
    windows = repeated_windows(docs, owners, id_col, text_col)
    text = text_of(text_col)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), _mark(text).alias("r_mark"))
    named = owners.join(windows, "start", "left").select("mark", "owner", "begins", "counts")
    both = rows.join(named, rows["r_mark"] == named["mark"])
    later = ~F.col("id").eqNullSafe(F.col("owner"))
    size = F.octet_length(text_of(f"row.{text_col}"))

    def ranges(of_copy: Column, of_first: Column) -> Column:
        return F.when(size >= MATCH, F.when(later, F.array(of_copy)).otherwise(of_first))

    begins, counts = ranges(F.lit(0), F.col("begins")), ranges(size - MATCH + 1, F.col("counts"))
    return both.select("row", _left(text_of(f"row.{text_col}"), begins, counts).alias("left")).select("row", "left.*")


@F.pandas_udf(LEFT)
def _left(text: pd.Series, begins: pd.Series, counts: pd.Series) -> pd.DataFrame:
    """What is left of each text when the ranges of windows go."""
    none = np.zeros(0, np.int64)
    out = []
    for t, b, c in zip(text, begins, counts):
        raw = t.encode()
        b, c = (none, none) if b is None else (np.asarray(b, np.int64), np.asarray(c, np.int64))
        kept, spans = without_ranges(raw, b, c)
        out.append((len(raw), len(raw) - len(kept), spans, kept))
    return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])


def op11_suffix_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_bytes(table(spark, sf_dir, "documents"))
    return done.select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
