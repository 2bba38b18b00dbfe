"""SimHash near-duplicates through an inverted index of positional bytes with count filtering.

A fingerprint has eight bytes. Two fingerprints that differ in at most three bits differ in at
most three bytes, so they share at least five positional bytes. Any five of eight positions
contain three of the first four or three of the last four: the index therefore lists each
fingerprint under its eight such triples, and every link meets in some list. For a pair that
meets, the shared positional bytes are tallied; five are the guaranteed minimum, and what
reaches it is verified bit by bit. A list above ``long_list`` entries is not paired as it is:
its members go on to longer keys (the triple and two more positions, of which a link shares
at least one choice). Equal fingerprints are one entry, so copies never pair among themselves.

Stages ask for a similarity of shingle sets (``keep_one(similarity=...)``). Three bits of 64 reach few
pairs at 0.8, whose fingerprints differ in ten bits on average: such documents have ``WIDE``
fingerprints of independent hashes, an index of triples of their 64 bytes, of which a pair at 0.8
shares five on average, and a bit limit that such a pair stays under. What meets is verified by the
Jaccard similarity of the shingle sets. A list meets its first document only; what is similar to it
leaves, the rest meets its next one, and after ``rounds`` of this what is left meets as pairs.

Nulls and cases: a null text is empty; a text without words has fingerprint zero and links like
any other; repeated rows and rows of one id each count as documents; a null id takes part, and
is a component's name only if the component has no other id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm.common import batches_of, let, stored, table, text_of, words
from fieldlens.operators.spatial import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK_BITS, SHARED_BYTES, SHINGLE = 3, 5, 3
# by similarity: fingerprints of a document, and of their bits how many similar documents differ in at most
WIDE, FAR_BITS = 8, 160
# no two of these share more than one byte
SPREAD = [tuple((i + b) % (WIDE * 8) for b in base) for base in ((0, 1, 3), (0, 4, 11), (0, 5, 18), (0, 6, 22)) for i in range(WIDE * 8)]
# documents whose lists of hashes are in memory at a time
LIST_ROWS = 512
TRIPLES = [c for half in (range(4), range(4, 8)) for c in combinations(half, 3)]


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """XXH64 (seed 42) of each run of ``size`` words joined by a space; fewer words: of the whole."""
    w = words(F.translate(text, UPPER, LOWER))

    def hashes(w):
        runs = F.transform(
            F.sequence(F.lit(0), F.size(w) - size),
            lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(w, i + k) for k in range(size)])),
        )
        whole = F.when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(w) >= size, runs).otherwise(whole)

    return let(w, hashes)


def majority_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the last column, lists of hashes, by their SimHash: a bit is set if more than half set it."""
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        values, ends = lists.values.to_numpy().astype(">i8"), lists.offsets.to_numpy()
        fp = np.zeros(batch.num_rows, ">i8")
        for row, (start, end) in enumerate(zip(ends[:-1], ends[1:])):
            ones = np.zeros(64, np.int64)
            for at in range(start, end, 65536):
                part = values[at : min(at + 65536, end)]
                ones += np.unpackbits(part.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
            fp[row] = np.packbits(ones * 2 > end - start).view(">i8")[0]
        names = [*batch.schema.names[:-1], "fp"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fp.astype("i8"))], names=names)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(id, mark, fp): the 64-bit SimHash of each row's text as a signed number; mark is a hash of the text."""
    id_type = docs.schema[id_col].dataType.simpleString()
    text = text_of(text_col)
    hashed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), shingle_hashes(text, size).alias("hashes"))
    return hashed.mapInArrow(majority_bits, f"id {id_type}, mark bigint, fp bigint")


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 56 - 8 * position).bitwiseAND(F.lit(255).cast("bigint"))


def _key(fp: Column, positions: tuple[int, ...]) -> Column:
    mask = sum(0xFF << (56 - 8 * p) for p in positions)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint"))


def _postings(fps: DataFrame, choices: list[tuple[int, ...]]) -> DataFrame:
    """(which, key, fp): one row for each chosen set of positions."""
    lists = F.array(*[F.struct(F.lit(n).alias("which"), _key(F.col("fp"), c).alias("key")) for n, c in enumerate(choices)])
    return fps.select("fp", F.explode(lists).alias("p")).select("p.which", "p.key", "fp")


def _links(postings: DataFrame) -> DataFrame:
    a = postings.select("which", "key", F.col("fp").alias("a"))
    b = postings.select("which", "key", F.col("fp").alias("b"))
    x, y = F.col("a"), F.col("b")
    tally = sum(F.when(_byte(x, p) == _byte(y, p), 1).otherwise(0) for p in range(8))
    near = F.bit_count(x.bitwiseXOR(y)) <= LINK_BITS
    return a.join(b, (a["which"] == b["which"]) & (a["key"] == b["key"]) & (x < y) & (tally >= SHARED_BYTES) & near).select("a", "b")


def similar_fingerprints(fps: DataFrame, long_list: int = 512) -> DataFrame:
    """Pairs (a < b) of distinct fingerprints with at most three differing bits, each once."""
    fps = fps.select("fp").distinct()
    postings = _postings(fps, TRIPLES)
    sizes = postings.groupBy("which", "key").agg(F.count(F.lit(1)).alias("n"))
    short = sizes.filter(F.col("n").between(2, long_list)).drop("n")
    long = sizes.filter(F.col("n") > long_list).drop("n")
    found = _links(postings.join(short, ["which", "key"], "left_semi"))
    crowded = postings.join(long, ["which", "key"], "left_semi").select("fp").distinct()
    fives = [c for c in combinations(range(8), 5)]
    # a link inside a long list has both ends crowded and shares five bytes outright
    return found.unionByName(_links(_postings(crowded, fives))).distinct()


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", long_list: int = 512, size: int = SHINGLE) -> DataFrame:
    """(id, fp, component): component is the smallest id reachable over links."""
    prints = stored(fingerprints(docs, id_col, text_col, size))
    groups = prints.groupBy("fp").agg(F.min("id").alias("first"))
    links = similar_fingerprints(groups, long_list)
    reach = connected_components(links, []).select(F.col("node").alias("fp"), F.col("comp").alias("root"))
    named = groups.join(reach, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = named.groupBy("root").agg(F.min("first").alias("component"))
    label = named.join(names, "root").select("fp", "component")
    return prints.join(label, "fp").select("id", "mark", "fp", "component")


def _mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k-th of independent hashes (SplitMix64)."""
    x = hashes ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def wide_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the last column, lists of hashes, by their ``WIDE`` SimHashes as one binary."""
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        values, ends = lists.values.to_numpy().view("u8"), lists.offsets.to_numpy()
        prints = []
        for start, end in zip(ends[:-1], ends[1:]):
            ones = np.zeros((WIDE, 64), np.int64)
            for at in range(start, end, 16384):
                part = values[at : min(at + 16384, end)]
                for k in range(WIDE):
                    bits = np.unpackbits(_mixed(part, k).astype(">u8").view(np.uint8)).reshape(-1, 64)
                    ones[k] += bits.sum(axis=0, dtype=np.int64)
            prints.append(np.packbits(ones * 2 > end - start).tobytes())
        names = [*batch.schema.names[:-1], "wide"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints, pa.binary())], names=names)


def wide_postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(no, wide) in, (key, no) out: a document under each triple of ``SPREAD``."""
    at = np.array(SPREAD)
    which = np.arange(len(SPREAD), dtype=np.int64) << 24
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            part = batch.slice(start, 1000)
            wide = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint8).reshape(-1, WIDE * 8).astype(np.int64)
            key = which + (wide[:, at[:, 0]] << 16) + (wide[:, at[:, 1]] << 8) + wide[:, at[:, 2]]
            no = np.repeat(part.column(0).to_numpy(), len(SPREAD))
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(no)], names=["key", "no"])


def wide_near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, wide_a, wide_b) in, the pairs (a, b) of at most ``FAR_BITS`` differing bits out."""
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "u8").reshape(-1, WIDE) for k in (2, 3))
        near = pa.array(np.bitwise_count(x ^ y).sum(axis=1) <= FAR_BITS)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], names=["a", "b"])


def _with_both(pairs: DataFrame, of: DataFrame, name: str) -> DataFrame:
    a, b = (of.select(F.col("no").alias(k), F.col(name).alias(f"{name}_{k}")) for k in "ab")
    return pairs.join(a, "a").join(b, "b")


def dissimilar(docs: DataFrame, id_col: str, text_col: str, size: int, similarity: float, rounds: int = 4) -> DataFrame:
    """(h_id, h_mark) of the texts that stay: no earlier one (by id, then mark) was found as similar."""
    text = text_of(text_col)
    order = F.struct(F.col("id").isNull().alias("void"), "id", "mark")
    sets = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), F.array_distinct(shingle_hashes(text, size)).alias("hashes"))
    one = sets.select("id", "mark", F.xxhash64(F.sort_array("hashes")).alias("same"), "hashes")
    kind = one.schema["id"].dataType.simpleString()
    with batches_of(docs.sparkSession, LIST_ROWS):
        prints = stored(one.mapInArrow(wide_bits, f"id {kind}, mark bigint, same bigint, wide binary"))
    # texts with the same shingles are one entry, under its first document
    firsts = prints.groupBy("same").agg(F.min(order).alias("f"), F.first("wide").alias("wide"))
    firsts = firsts.select("same", F.col("f.id").alias("id"), F.col("f.mark").alias("mark"), "wide").orderBy(F.col("id").isNull(), "id", "mark")
    entries = stored(firsts.withColumn("no", F.monotonically_increasing_id()))  # rises with the order

    def similar(pairs: DataFrame) -> DataFrame:
        """(no) of each b whose shingle set is similar to that of its a."""
        near = stored(_with_both(pairs.distinct(), entries, "wide").select("a", "b", "wide_a", "wide_b").mapInArrow(wide_near, "a bigint, b bigint"))
        met_again = near.select(F.col("a").alias("no")).unionByName(near.select(F.col("b").alias("no"))).distinct()
        marks = entries.join(met_again, "no", "left_semi").select("no", "mark")
        texts = docs.select(F.xxhash64(text).alias("mark"), text.alias("t")).join(marks.select("mark").distinct(), "mark", "left_semi").dropDuplicates(["mark"])
        hashes = stored(texts.join(marks, "mark").select("no", F.array_distinct(shingle_hashes(F.col("t"), size)).alias("set")))
        common = F.size(F.array_intersect("set_a", "set_b"))
        alike = common >= similarity * (F.size("set_a") + F.size("set_b") - common)
        return stored(_with_both(near, hashes, "set").filter(alike).select(F.col("b").alias("no")).distinct())

    live = entries.select("no", "wide").mapInArrow(wide_postings, "key bigint, no bigint").repartition("key")
    gone = []
    for n in range(rounds + 1):
        heads = live.groupBy("key").agg(F.min("no").alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        met = stored(live.join(heads, "key").filter("no > head").select("key", "no", "head"))
        if met.isEmpty():
            break
        if n == 0:
            # members of a large group share lists with many heads: the one shared most often settles most of them
            tally = met.groupBy("no", "head").agg(F.count(F.lit(1)).alias("shared"))
            best = tally.groupBy(F.col("no").alias("b")).agg(F.max_by("head", F.struct("shared", -F.col("head"))).alias("a"))
            gone.append(similar(best.select("a", "b")))
            met = stored(met.join(gone[-1], "no", "left_anti"), met)
        pairs = met.select(F.col("head").alias("a"), F.col("no").alias("b"))
        if n == rounds:
            pairs = pairs.unionByName(met.select("key", F.col("no").alias("a")).join(met.select("key", F.col("no").alias("b")), "key").filter("a < b").select("a", "b"))
        gone.append(similar(pairs))
        live = met.select("key", "no").join(gone[-1], "no", "left_anti")
    left = entries.select("no", F.col("id").alias("h_id"), F.col("mark").alias("h_mark"))
    for g in gone:
        left = left.join(g, "no", "left_anti")
    return left.select("h_id", "h_mark")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, similarity: float | None = None,
) -> DataFrame:
    """The rows of ``docs`` that stay. Without ``similarity``: of each component of fingerprints at most
    three bits apart the document with the smallest id. With it: all but documents whose shingle sets
    are at least so similar to those of one with a smaller id. Of rows that share the id one with the
    smallest text hash stays."""
    if similarity is None:
        found = components(docs, id_col, text_col, size=size)
        first = F.min(F.struct(F.col("id").isNull().alias("void"), "id", "mark"))
        heads = found.groupBy("component").agg(first.alias("h")).select(F.col("h.id").alias("h_id"), F.col("h.mark").alias("h_mark"))
    else:
        heads = dissimilar(docs, id_col, text_col, size, similarity)
    row = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("mark"))
    kept = row.join(heads, row["id"].eqNullSafe(heads["h_id"]) & (row["mark"] == heads["h_mark"]), "left_semi")
    return kept.dropDuplicates(["id", "mark"]).select("row.*")


def op6_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
