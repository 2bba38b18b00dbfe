"""Two tokenizers aligned over a corpus by the byte offsets where their tokens end.

Documents are read in blocks of about ``BLOCK_BYTES`` of text. In a block both token lists are
flattened with the number of their document beside each token; token lengths add up per document
to end offsets; an Acero join on (document, end) puts the ends of both sides in one row of cuts.
A cut that both share closes a group. Between two neighbouring cuts lies just one token of each
side, and every overlapping pair of tokens has just one such stretch: the cuts are the links. The
pairs of ids that they link are counted per block by ``Table.group_by`` and added up by Spark.

Counts of pairs go back to the blocks that have them, one row for each pair and block, and each
block's documents are summed there from lists of the block's own pair numbers: neither a table
of all pairs nor one row per link ever moves.

Nulls and cases: a text that is null or empty, or whose tokens of either side do not give back a
space and the text, has no tokens and gives zeros and an empty digest. Repeated rows count as
often as they are there; ids may be null or of any type; columns other than id and text are not
read. One text is never split over blocks; an empty table gives no rows. The strings of special
tokens are plain text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm.common import stored, table
from fieldlens.llm.packing import ODD, Vocabulary, vocabulary

BLOCK_BYTES = 2 << 20


@dataclass(frozen=True)
class Pair:
    """Side A, a byte-level BPE that gets a space and the text; side B, a piece model that adds the space itself."""

    a: Vocabulary
    b: str


def public_pair() -> Pair:
    import public_tokenizers as public

    return Pair(vocabulary(), public.path("piece_bpe_32k.model"))


class Side:
    """A tokenizer as a function of a text, and the bytes of each id."""

    def __init__(self, encode: Callable[[str], Sequence[int]], bytes_of: list[bytes]):
        self.encode = encode
        self.bytes_of = pa.array(bytes_of, pa.binary())
        self.lengths = pc.binary_length(self.bytes_of).cast(pa.int64())

    def said(self, after: str) -> list[str]:
        """Each id as text with what stands after it."""
        return [f"{i}{after}" for i in range(len(self.bytes_of))]


def byte_letters() -> dict[str, int]:
    """The letter of each byte in byte-level vocabularies: printable ones stand for themselves, the others follow from 256."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def byte_level_side(v: Vocabulary) -> Side:
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(v.file)
    exact.encode_special_tokens = True  # their strings in a text are plain text
    with open(v.ranks, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f)}
    quick = tiktoken.Encoding("ranks", pat_str=v.pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text):
        return exact.encode(" " + text, add_special_tokens=False).ids if ODD.search(text) else quick.encode_ordinary(" " + text)

    letters = byte_letters()
    entries = [exact.id_to_token(i) or "" for i in range(exact.get_vocab_size(with_added_tokens=True))]
    return Side(encode, [bytes(letters[c] for c in e) for e in entries])


def piece_side(path: str) -> Side:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, model.id_to_piece(i)) for i in range(len(model)))]
    return Side(model.encode, pieces)


def token_lists(texts: list[str], side: Side) -> pa.ListArray:
    ids = [np.array(side.encode(t), np.int32) for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))


def joined_bytes(lists: pa.ListArray, side: Side) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(lists.offsets, side.bytes_of.take(pc.list_flatten(lists))), b"")


def token_ends(lists: pa.ListArray, side: Side, name: str) -> pa.Table:
    """(at, token): the document of each token and where it ends there, as one number; token is its id."""
    ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists).cast(pa.int64())
    total = pc.cumulative_sum(side.lengths.take(ids))
    # what had come before the document
    before = np.concatenate([[0], total.to_numpy()])[lists.offsets.to_numpy()[:-1]]
    end = pc.subtract(total, pa.array(before, pa.int64()).take(doc))
    return pa.table({"at": pc.bit_wise_or(pc.shift_left(doc, 32), end), name: ids})


def cuts(a: pa.Table, b: pa.Table) -> pa.Table:
    """(doc, a, b, a_ends, b_ends, common) in order: every end of either side, the token of each side there, and what ends."""
    both = a.join(b, keys="at", join_type="full outer", use_threads=False).sort_by("at").combine_chunks()
    at, one, other = (both[n].chunk(0) if both[n].num_chunks else pa.array([], both.schema.field(n).type) for n in ("at", "a", "b"))
    a_ends, b_ends = pc.is_valid(one), pc.is_valid(other)
    # a token covers what lies up to its end; the last ends of a document are always common
    return pa.table({"doc": pc.shift_right(at, 32), "a": pc.fill_null_backward(one), "b": pc.fill_null_backward(other), "a_ends": a_ends, "b_ends": b_ends, "common": pc.and_(a_ends, b_ends)})


class GroupTexts:
    """Per document ``a1,a2|b1;a3|b2,b3``: the ids of each group."""

    def __init__(self, a: Side, b: Side):
        self.a, self.b = len(a.bytes_of), len(b.bytes_of)
        self.words = pa.array(a.said(",") + a.said("|") + b.said(",") + b.said(";") + b.said(""), pa.string())

    def of(self, found: pa.Table, a: pa.ListArray, b: pa.ListArray) -> pa.Array:
        common = found["common"].to_numpy().astype(np.int64)
        group = np.cumsum(common) - common
        a_ends, b_ends = found["a_ends"].to_numpy(), found["b_ends"].to_numpy()
        of_a, of_b = group[a_ends], group[b_ends]
        n = int(common.sum())
        # tokens of the groups before each, and of all groups up to each
        before_b = np.concatenate([[0], np.cumsum(np.bincount(of_b, minlength=n))])
        upto_a = np.cumsum(np.bincount(of_a, minlength=n))
        closing = common[b_ends]
        last = b.offsets.to_numpy()[1:] - 1
        closing[last[np.diff(b.offsets.to_numpy()) > 0]] = 2
        word = np.empty(len(of_a) + len(of_b), np.int64)
        word[np.arange(len(of_a)) + before_b[of_a]] = pc.list_flatten(a).to_numpy() + self.a * common[a_ends]
        word[np.arange(len(of_b)) + upto_a[of_b]] = pc.list_flatten(b).to_numpy() + 2 * self.a + self.b * closing
        return pc.binary_join(pa.ListArray.from_arrays(pc.add(a.offsets, b.offsets), self.words.take(pa.array(word))), "")


def by_document(doc: pa.Array, values: dict[str, pa.Array], n: int) -> dict[str, np.ndarray]:
    """Sums of the values for each of n documents."""
    sums = pa.table({"doc": doc, **values}).group_by("doc").aggregate([(v, "sum") for v in values])
    out = {v: np.zeros(n, np.int64) for v in values}
    for v in values:
        out[v][sums["doc"].to_numpy()] = sums[f"{v}_sum"].to_numpy()
    return out


ALIGNED = "block bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, links array<int>, pair_a array<int>, pair_b array<int>, pair_n array<bigint>"
MEASURES = ("n_a", "n_b", "n_groups", "n_links")


def align_block(texts: list[str], side_a: Side, side_b: Side, said: GroupTexts) -> tuple[dict[str, np.ndarray], list[str], list[np.ndarray], pa.Table]:
    """Measures, digests and links (as numbers of the block's pairs) of each text, and the pairs (pair_a, pair_b, pair_n)."""
    n = len(texts)
    has = [k for k, t in enumerate(texts) if t]
    a, b = (token_lists([texts[k] for k in has], side) for side in (side_a, side_b))
    spaced = pa.array([b" " + texts[k].encode() for k in has], pa.binary())
    good = pc.and_(pc.equal(joined_bytes(a, side_a), spaced), pc.equal(joined_bytes(b, side_b), spaced))
    a, b, at = a.filter(good), b.filter(good), np.array(has, np.int64)[good.to_numpy(zero_copy_only=False)]
    found = cuts(token_ends(a, side_a, "a"), token_ends(b, side_b, "b"))
    doc = found["doc"].combine_chunks()
    sums = by_document(doc, {"n_groups": found["common"].cast(pa.int64()), "n_links": pa.array(np.ones(len(doc), np.int64))}, len(at))
    measures = {m: np.zeros(n, np.int64) for m in MEASURES}
    for m, v in (("n_a", pc.list_value_length(a)), ("n_b", pc.list_value_length(b)), *sums.items()):
        measures[m][at] = v
    digests, links = [""] * n, [np.zeros(0, np.int32)] * n
    both = pc.bit_wise_or(pc.shift_left(found["a"].cast(pa.int64()), 32), found["b"].cast(pa.int64())).combine_chunks()
    pair = both.dictionary_encode()
    numbers = pair.indices.to_numpy()
    stops = np.cumsum(sums["n_links"])
    for k, groups, stop, size in zip(at, said.of(found, a, b), stops, sums["n_links"]):
        digests[k] = hashlib.sha256(groups.as_buffer()).hexdigest()
        links[k] = numbers[stop - size : stop]
    counted = pa.table({"pair": pair.indices}).group_by("pair").aggregate([([], "count_all")]).sort_by("pair")
    ids = pair.dictionary
    pairs = pa.table({"pair_a": pc.shift_right(ids, 32).cast(pa.int32()), "pair_b": pc.bit_wise_and(ids, 0xFFFFFFFF).cast(pa.int32()), "pair_n": counted["count_all"]})
    return measures, digests, links, pairs


def _aligner(pair: Pair, block_bytes: int):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level_side(pair.a), piece_side(pair.b)
        said = GroupTexts(a, b)
        context = TaskContext.get()
        block = (context.partitionId() if context else 0) << 32
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                base = sizes[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(sizes, base + block_bytes, side="right")))
                part = batch.slice(at, end - at)
                measures, digests, links, pairs = align_block(part.column("text").to_pylist(), a, b, said)
                n = part.num_rows
                none = [None]
                whole = {"pair_a": pa.int32(), "pair_b": pa.int32(), "pair_n": pa.int64()}
                ids = part.column("id")
                yield pa.RecordBatch.from_pydict({
                    "id": pa.concat_arrays([ids, pa.nulls(1, ids.type)]),
                    "block": pa.array(np.full(n + 1, block)),
                    **{m: pa.array(np.append(v, 0)) for m, v in measures.items()},
                    "groups_sha256": pa.array(digests + none, pa.string()),
                    "links": pa.array(links + none, pa.list_(pa.int32())),
                    **{c: pa.array([None] * n + [pairs[c].to_numpy()], pa.list_(t)) for c, t in whole.items()},
                })
                block += 1
                at = end

    return align


def _summer(names: list[str]):
    def summed(documents: pa.Table, pairs: pa.Table) -> pa.Table:
        """Documents of one block with sums over their links; ``pairs`` has count and is_best of each pair number."""
        pairs = pairs.sort_by("pos")
        links = documents["links"].combine_chunks()
        links = links.chunk(0) if isinstance(links, pa.ChunkedArray) else links
        flat, doc = pc.list_flatten(links), pc.list_parent_indices(links)
        values = {"n_best": pairs["is_best"].combine_chunks().take(flat).cast(pa.int64()), "count_sum": pairs["count"].combine_chunks().take(flat)}
        sums = by_document(doc, values, documents.num_rows)
        kept = [c for c in names if c not in sums]
        return pa.table({**{c: documents[c] for c in kept}, **{c: pa.array(v) for c, v in sums.items()}}).select(names)

    return summed


def align(docs: DataFrame, pair: Pair | None = None, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): per row id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; per
    pair of ids that is linked anywhere a, b, count and whether it is the highest count of b."""
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    rows = stored(plain.mapInArrow(_aligner(pair or public_pair(), block_bytes), f"id {kind}, {ALIGNED}"))
    zipped = F.arrays_zip("pair_a", "pair_b", "pair_n")
    local = rows.filter("pair_a IS NOT NULL").select("block", F.posexplode(zipped).alias("pos", "p"))
    local = local.select("block", "pos", F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"), F.col("p.pair_n").alias("n"))
    counts = stored(local.groupBy("a", "b").agg(F.sum("n").alias("count")))
    best = counts.groupBy("b").agg(F.max("count").alias("most"))
    counts = stored(counts.join(best, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("is_best")))
    looked = local.drop("n").join(counts, ["a", "b"]).select(F.col("block").alias("of"), "pos", "count", "is_best")
    names = ["id", *MEASURES, "n_best", "count_sum", "groups_sha256"]
    schema = f"id {kind}, " + ", ".join(f"{m} bigint" for m in (*MEASURES, "n_best", "count_sum")) + ", groups_sha256 string"
    documents = rows.filter("pair_a IS NULL").drop("pair_a", "pair_b", "pair_n")
    found = documents.groupBy("block").cogroup(looked.groupBy("of")).applyInArrow(_summer(names), schema)
    return found, counts


def op13_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = align(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")
