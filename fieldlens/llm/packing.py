"""Best-fit packing of documents into token sequences by hierarchical residual packing.

Every task tokenizes its documents, cuts the long ones into full sequences (the first piece takes
the remainder) and packs the other pieces best-fit decreasing, a bounded number at a time. Bins
that are nearly full are final. The pieces of all others, however many, are items of the next
round: its tasks are as many as hold ``per_task`` items each, and items are dealt in turn, so that
the sizes of all tasks mix. Once the items fit one task it is the last; a round of several tasks
that saves less than one bin in a thousand is the last as well, and its bins, or those before if
they are fewer, are final as they are. No bin is left out of a round for being one of many.

Each round is written before it is read: a retried task cannot change bins already counted.
Nulls and cases: a null or empty text is the end token alone; repeated rows are documents of
their own; an empty table gives no rows; ids may be null or of any type, and columns other than
id and text are not read. Token ids come from the vocabulary given by ``tokenizer``.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.common import stored, table, text_of

LENGTH = 2048
END = 0
FULL_FROM = 0.98  # a bin this full is final
CHUNK = 50_000  # items packed at a time
PER_TASK = 16_384  # items of a task from the second round on
PIECE = ("piece", "start", "length", "ids_crc32")


# what both tokenizer libraries surely read alike; other texts take the slower one
ODD = re.compile(r"[^\t\n\r -~\u00a1-\u024f]|<\|")


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level BPE as a ``tokenizers`` file, and the same merges as ranks with their word pattern."""

    file: str
    ranks: str
    pattern: str


def vocabulary() -> Vocabulary:
    import public_tokenizers as public

    return Vocabulary(public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


def encoder(v: Vocabulary) -> Callable[[str], list[int]]:
    """Text to the ids of ``tokenizers`` without special tokens. Ordinary texts are encoded from the
    ranks, which gives the same ids several times faster."""
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(v.file)
    with open(v.ranks, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f)}
    quick = tiktoken.Encoding("ranks", pat_str=v.pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda t: exact.encode(t, add_special_tokens=False).ids if ODD.search(t) else quick.encode_ordinary(t)


def cut_points(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: whole up to ``length``, else full pieces after the remainder."""
    if n <= length:
        return [(0, n)]
    first = n % length or length
    return [(0, first), *[(s, length) for s in range(first, n, length)]]


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Best-fit decreasing: each item goes to the open bin with the least room that holds it."""
    order = np.argsort(-sizes, kind="stable")
    bins: list[list[int]] = []
    rooms: list[int] = []  # distinct room sizes in order
    by_room: dict[int, list[int]] = {}
    for i in order:
        n = int(sizes[i])
        k = bisect_left(rooms, n)
        if k == len(rooms):
            bins.append([])
            b, room = len(bins) - 1, length
        else:
            room = rooms[k]
            b = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[k]
        bins[b].append(int(i))
        left = room - n
        if left:
            if left not in by_room:
                insort(rooms, left)
                by_room[left] = []
            by_room[left].append(b)
    return bins


def _packer(length: int, full: int, round_no: int):
    """Items (size, members) in, bins (sequence_id, size, members, done) out; where not done, the
    bin's pieces go on to the next round."""
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        head = (round_no << 56) | ((context.partitionId() if context else 0) << 28)
        number = 0
        held: list[tuple[int, list]] = []

        def settle(keep: int):
            nonlocal number, held
            sizes = np.array([s for s, _ in held], np.int64)
            done, rest = [], []
            for b in best_fit(sizes, length):
                size = int(sizes[b].sum())
                members = [m for i in b for m in held[i][1]]
                (done if size >= full else rest).append((size, members))
            rest.sort(key=lambda x: x[0])
            held = rest[:keep]  # the emptiest meet the next items
            bins = done + rest[keep:]
            rows = [(head + number + k, size, members, k < len(done)) for k, (size, members) in enumerate(bins)]
            number += len(bins)
            return pd.DataFrame(rows, columns=["sequence_id", "size", "members", "done"])

        for pdf in frames:
            held += list(zip(pdf["size"].astype(int), (list(m) for m in pdf["members"])))
            if len(held) >= CHUNK:
                yield settle(CHUNK // 4)
        yield settle(0)

    return pack


def _tokenizer(v: Vocabulary, length: int, names: list[str]):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(v)
        for batch in batches:
            rows, cols = [], {c: [] for c in PIECE}
            for row, text in enumerate(batch.column("text").to_pylist()):
                ids = np.array([*encode(text), END], "<u4")
                for n, (start, size) in enumerate(cut_points(len(ids), length)):
                    rows.append(row)
                    for c, value in zip(PIECE, (n, start, size, zlib.crc32(ids[start : start + size].tobytes()))):
                        cols[c].append(value)
            taken = batch.column("id").take(pa.array(rows, pa.int64()))
            arrays = [pa.array(cols[c], pa.int32() if c == "piece" else pa.int64()) for c in PIECE]
            yield pa.RecordBatch.from_arrays([taken, *arrays], names=names)

    return pieces


def tokenized_pieces(docs: DataFrame, tokenizer: Vocabulary, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every piece of every document."""
    plain = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    id_type = plain.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return plain.mapInArrow(_tokenizer(tokenizer, length, ["id", *PIECE]), schema)


def pack(
    docs: DataFrame, tokenizer: Vocabulary | None = None, length: int = LENGTH, per_task: int = PER_TASK,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset): where each piece of ``docs`` lies."""
    pieces = stored(tokenized_pieces(docs, tokenizer or vocabulary(), length, id_col, text_col))
    member = F.struct("id", *PIECE)
    schema = T.StructType([
        T.StructField("sequence_id", T.LongType()), T.StructField("size", T.LongType()),
        T.StructField("members", T.ArrayType(pieces.select(member.alias("m")).schema["m"].dataType)),
        T.StructField("done", T.BooleanType()),
    ])
    full = int(length * FULL_FROM)
    items = pieces.select(F.col("length").alias("size"), F.array(member).alias("members"))
    done, before, round_no, last = [], None, 0, items.rdd.getNumPartitions() <= 1
    while True:
        packed = stored(items.mapInPandas(_packer(length, full, round_no), schema))
        open_, pieces_left = packed.filter("not done").agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("members")), F.lit(0))).first()
        if before is not None:
            bins_before, held_before = before
            count = packed.count()
            if count > bins_before:
                done.append(held_before)
                break
            last = last or bins_before - count < bins_before / 1000
        if last or not open_:
            done.append(packed)
            break
        done.append(packed.filter("done"))
        left = packed.filter("not done")
        before, round_no = (open_, left), round_no + 1
        tasks = -(-pieces_left // per_task)
        last = tasks == 1
        items = left.select(F.explode("members").alias("m")).select(F.col("m.length").alias("size"), F.array("m").alias("members")).repartition(tasks)
    bins = done[0]
    for more in done[1:]:
        bins = bins.unionByName(more)
    sizes = F.transform("members", lambda m: m["length"])
    laid = bins.select("sequence_id", F.posexplode("members").alias("at", "m"), sizes.alias("sizes"))
    offset = F.aggregate(F.slice("sizes", F.lit(1), F.col("at")), F.lit(0).cast("bigint"), lambda a, n: a + n)
    return laid.select("m.*", "sequence_id", offset.alias("offset"))


def op3_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
