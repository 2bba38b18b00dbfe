"""Exact substring dedup with difference-cover anchors.

A run of words is repeated if its ``window`` words also start anywhere else. Windows are not
hashed everywhere: with period 21 and cover {0, 1, 4, 14, 16}, every difference modulo 21 is a
difference of two cover residues, so for any two places p and q there is a shift below 21 that
puts both p + shift and q + shift on the cover. Two equal windows of 35 words therefore share an
aligned anchor: 15 words that begin at cover places of both documents, inside both windows.

1. Anchors are hashed and counted over the corpus; those met twice or more are hot.
2. Each document gets the places of its hot anchors and extends them: only windows that hold a hot
   anchor can be repeated, and their 35 words are hashed (96 bits) and counted.
3. Windows counted twice or more are repeated; every word they cover goes.

Counting is by hash, combined before the shuffle, so a passage or a group of copies of any size
costs its own words and no pairs. The anchors only choose what is looked at: the 96-bit window
hash, over the word sequence itself, decides.
Nulls and cases: a null text has no words; rows that agree in id and text are copies of each
other and lose their windows like any copies; shorter texts lose nothing; an empty table gives
no rows; input columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm.common import let, stored, table, text_of, words

WINDOW = 35
PERIOD = 21
COVER = (0, 1, 4, 14, 16)  # a perfect difference set modulo 21
ANCHOR = WINDOW - (PERIOD - 1)
ON_COVER = np.isin(np.arange(PERIOD), COVER)
# words that numpy works on at a time
PART_WORDS = 1 << 17
# fixed values: odd multipliers of the rolling hashes
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def run_hashes(w: np.ndarray, places: np.ndarray, size: int, multiplier: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` numbers from each place: a polynomial modulo 2**64, stirred."""
    w = w.astype(np.uint64)
    out = np.zeros(len(places), np.uint64)
    m = np.uint64(multiplier)
    with np.errstate(over="ignore"):
        for k in range(size):
            out *= m
            out += w[places + k]
            out ^= out >> np.uint64(29)
    return out.view(np.int64)


def window_hashes(w: np.ndarray, size: int, multiplier: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` numbers from every place, by doubling: two runs of half the length make
    one, and the last two overlap where ``size`` is no power of two."""
    h = w.astype(np.uint64)
    length, level = 1, 0
    with np.errstate(over="ignore"):
        while length < size:
            step = min(length, size - length)
            h = h[: max(len(h) - step, 0)] * np.uint64(multiplier + 2 * level) + h[step:]
            h ^= h >> np.uint64(29)
            length, level = length + step, level + 1
    return h.view(np.int64)


def cover_places(n: int) -> np.ndarray:
    """Places on the cover where an anchor fits in n words."""
    last = n - ANCHOR + 1
    if n < WINDOW:
        return np.zeros(0, np.int64)
    return np.flatnonzero(ON_COVER[np.arange(last) % PERIOD])


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Neighbouring rows of about ``PART_WORDS`` words: the rows, their words one after another, and where
    each row's words begin and end there."""
    ends = batch.column("w").offsets.to_numpy()
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + PART_WORDS, "right")) - 1)
        yield batch.slice(lo, hi - lo), batch.column("w").values.to_numpy()[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo]
        lo = hi


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, key, place) of every anchor."""
    for batch in batches:
        for part, w, ends in _parts(batch):
            places = [cover_places(n) for n in np.diff(ends)]
            keys = np.repeat(part.column("key").to_numpy(), [len(p) for p in places])
            at = np.concatenate([p + begin for p, begin in zip(places, ends)])
            h = run_hashes(w, at, ANCHOR, MULTIPLIERS[0])
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(keys), pa.array(np.concatenate(places).astype(np.int32))], names=["hash", "key", "place"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h1, h2, nr, place) of every window that holds a hot anchor."""
    for batch in batches:
        for part, w, ends in _parts(batch):
            hot = part.column("hot")
            begin, end = (np.repeat(e, np.diff(hot.offsets.to_numpy())) for e in (ends[:-1], ends[1:]))
            at = hot.flatten().to_numpy() + begin
            # a hot anchor lies in the windows from PERIOD - 1 words before it up to it
            mark = np.zeros(len(w) + 1, np.int64)
            np.add.at(mark, np.maximum(at - (PERIOD - 1), begin), 1)
            np.add.at(mark, np.minimum(at + 1, end - WINDOW + 1), -1)
            starts = np.flatnonzero(np.cumsum(mark) > 0)
            row = np.searchsorted(ends, starts, "right") - 1
            h = [window_hashes(w, WINDOW, m)[starts] for m in MULTIPLIERS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[0]), pa.array((h[1] >> 32).astype(np.int32)), pa.array(part.column("nr").to_numpy()[row]), pa.array((starts - ends[row]).astype(np.int32))],
                names=["h1", "h2", "nr", "place"])


def removed_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, starts): for each document with a repeated window, where its repeated windows start.
    key is a hash of id and text."""
    text = text_of(text_col)
    plain = docs.select(F.xxhash64(F.col(id_col), text).alias("key"), text.alias("text"))
    hashed = plain.select("key", word_hashes(F.col("text")).alias("w"))
    # anchors and windows are each counted and then looked up: written once, texts are split and moved once for both.
    # What is met twice is the small side without repeats, so it is hashed and the many rows are not sorted
    anchors = stored(hashed.mapInArrow(_anchors, "hash bigint, key bigint, place int"))
    hot = stored(anchors.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"))
    places = anchors.join(hot.hint("shuffle_hash"), "hash", "left_semi").groupBy("key").agg(F.array_distinct(F.collect_list("place")).alias("hot"))
    # the many window rows name their document by a small number, fixed once it is written
    places = stored(places.withColumn("nr", F.monotonically_increasing_id()), anchors, hot)
    chosen = plain.join(places, "key").select("nr", word_hashes(F.col("text")).alias("w"), "hot")
    windows = stored(chosen.mapInArrow(_windows, "h1 bigint, h2 int, nr bigint, place int"))
    repeated = stored(windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1", "h2"))
    starts = windows.join(repeated.hint("shuffle_hash"), ["h1", "h2"], "left_semi")
    starts = starts.groupBy("nr").agg(F.array_sort(F.array_distinct(F.collect_list("place"))).alias("starts"))
    return stored(starts.join(places.select("nr", "key"), "nr").select("key", "starts"), windows, repeated, places)


def without_windows(w: Column, starts: Column) -> Column:
    """The words that no window covers; ``starts`` are the places of windows in rising order, null for none."""
    before = F.transform(starts, lambda s: s + WINDOW)
    stretches = F.arrays_zip(F.concat(F.array(F.lit(0)), before).alias("lo"), F.concat(starts, F.array(F.size(w))).alias("hi"))
    free = F.filter(stretches, lambda x: x["hi"] > x["lo"])
    return F.when(starts.isNull(), w).otherwise(F.flatten(F.transform(free, lambda x: F.slice(w, x["lo"] + 1, x["hi"] - x["lo"]))))


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, text, n_words, n_removed): every input row as a struct, and what is left of its words."""
    runs = removed_runs(docs, id_col, text_col).withColumnRenamed("key", "run_key")
    text = text_of(text_col)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(F.col(id_col), text).alias("key"))
    both = rows.join(runs, rows["key"] == runs["run_key"], "left")

    def rest(w: Column, kept: Column) -> Column:
        return F.struct(F.array_join(kept, " ").alias("text"), F.size(w).alias("n_words"), (F.size(w) - F.size(kept)).alias("n_removed"))

    new = let(words(F.coalesce(F.col("row")[text_col], F.lit(""))), lambda w: let(without_windows(w, F.col("starts")), lambda kept: rest(w, kept)))
    return both.select("row", new.alias("new")).select("row", "new.*")


def op10_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_substrings(table(spark, sf_dir, "documents"))
    return done.select(
        F.col("row.doc_id").alias("doc_id"), F.col("n_words").cast("bigint").alias("n_words"),
        F.col("n_removed").cast("bigint").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"),
    )
