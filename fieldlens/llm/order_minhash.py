"""Order MinHash fingerprints: signatures of texts that follow edit distance.

A text is a sequence of tokens (runs of up to eight characters that are not white space), read as
k-mers of three tokens. A k-mer is numbered by its occurrence, so repeats count. Each
numbered k-mer has a hash; the hash deals it to one of ``COMPONENTS`` parts and orders it
there. In each part the ``TUPLE`` minimal k-mers are selected, put back into text order, and the tuple
is hashed: one component of the signature. Both what is there and its order decide, so moved or
replaced stretches change components. The likeness of two fingerprints is the share of equal
components among those that at least one of them has.

Only DataFrame operations, row by row: no shuffle but the one that brings a document its
neighbour. Every step is linear or a sort in the tokens of one text.
Nulls and cases: a null text is empty; texts without tokens have the empty fingerprint and are
like each other only; equal texts have equal fingerprints; rows of one id are ordered by their
text, and follow each other; null ids come last; one row is its own neighbour; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldlens.llm.common import let, table, text_of

TOKEN = r"[^\x20\x09-\x0D]{1,8}"
K, COMPONENTS, TUPLE = 3, 32, 2
PLACE_BITS, DIGITS = 28, 8
EMPTY = "-" * DIGITS
LEAST_BLOCKS, MOST_BLOCKS, BLOCK_ROWS = 64, 4096, 20_000


def fingerprint(text: Column) -> Column:
    """The signature: ``COMPONENTS`` strings, EMPTY where a part has no k-mer."""
    low_places = F.lit((1 << PLACE_BITS) - 1).cast("bigint")
    place = lambda number: number.bitwiseAND(low_places)
    part_shift = 63 - COMPONENTS.bit_length() + 1

    def hashes(tokens: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.greatest(F.size(tokens) - K, F.lit(0))),
                           lambda i: F.xxhash64(*[F.get(tokens, i + j) for j in range(K)]))
        return F.when(F.size(tokens) > 0, runs).otherwise(F.array().cast("array<bigint>"))

    def by_hash(h: Column) -> Column:
        # a number that sorts by hash, then place; equal hashes lie together in text order
        return F.sort_array(F.transform(h, lambda x, i: F.shiftleft(x, PLACE_BITS).bitwiseOR(i.cast("bigint"))))

    def packed(x: Column, at: Column) -> Column:
        """Part, order in the part and place in one number that sorts so."""
        rank = F.shiftleft(F.shiftrightunsigned(x, PLACE_BITS + 64 - part_shift), PLACE_BITS)
        return F.shiftleft(F.pmod(x, F.lit(COMPONENTS)), part_shift).bitwiseOR(rank).bitwiseOR(at)

    def all_different(h: Column) -> Column:
        x = F.transform(h, lambda v: F.xxhash64(v, F.lit(0)))
        return F.sort_array(F.transform(x, lambda v, i: packed(v, i.cast("bigint"))))

    def with_repeats(h: Column, order: Column) -> Column:
        last = F.size(order)
        group = lambda i: F.shiftright(F.get(order, i), PLACE_BITS)
        starts = F.filter(F.sequence(F.lit(0), last - 1), lambda i: (i == 0) | (group(i) != group(i - 1)))
        places = F.transform(order, place)

        def occurrences(starts: Column, places: Column) -> Column:
            def one(at: Column, n: Column) -> Column:
                until = F.coalesce(F.get(starts, n + 1), last)
                return F.transform(F.sequence(at, until - 1), lambda i: F.xxhash64(F.get(h, F.get(places, i).cast("int")), i - at))

            x = F.flatten(F.transform(starts, one))
            return F.sort_array(F.zip_with(x, places, packed))

        return let(starts, lambda s: let(places, lambda p: occurrences(s, p)))

    def numbered(h: Column) -> Column:
        """The k-mers with their occurrence numbers, by part and order; most texts repeat none."""
        repeats = let(by_hash(h), lambda order: with_repeats(h, order))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), all_different(h)).otherwise(repeats)

    def components(h: Column, ranked: Column) -> Column:
        part = lambda i: F.shiftrightunsigned(F.get(ranked, i), part_shift)
        heads = F.filter(F.sequence(F.lit(0), F.size(ranked) - 1), lambda i: (i == 0) | (part(i) != part(i - 1)))

        def tuple_hash(at: Column) -> Column:
            chosen = F.filter(F.slice(ranked, at + 1, F.lit(TUPLE)), lambda v: F.shiftrightunsigned(v, part_shift) == part(at))
            in_text = F.sort_array(F.transform(chosen, place))
            kmers = F.transform(in_text, lambda p: F.get(h, p.cast("int")))
            return F.struct(part(at).cast("int").alias("part"), F.xxhash64(kmers).alias("hash"))

        made = F.map_from_entries(F.transform(heads, tuple_hash))
        shown = lambda v: F.lower(F.substring(F.lpad(F.hex(v), 16, "0"), 1, DIGITS))
        return let(made, lambda m: F.transform(F.sequence(F.lit(0), F.lit(COMPONENTS - 1)), lambda j: F.coalesce(shown(F.try_element_at(m, j)), F.lit(EMPTY))))

    empty = F.array_repeat(F.lit(EMPTY), COMPONENTS)
    signature = let(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda t: let(hashes(t), lambda h: F.when(
        F.size(h) > 0, let(numbered(h), lambda ranked: components(h, ranked))).otherwise(empty)))
    return signature


def likeness(a: Column, b: Column) -> Column:
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
    used = F.filter(pairs, lambda p: (p["a"] != EMPTY) | (p["b"] != EMPTY))
    same = F.filter(used, lambda p: p["a"] == p["b"])
    return F.when(F.size(used) > 0, F.size(same) / F.size(used)).otherwise(F.lit(1.0))


def _rank(value: Column, cuts: list) -> Column:
    """How many of the sorted ``cuts`` are at or above ``value``, looked up in two steps."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    runs = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    coarse = F.size(F.filter(F.lit([r[-1] for r in runs]), lambda c: c < value))  # whole runs below the value
    fine = F.size(F.filter(F.get(F.array(*map(F.lit, runs)), coarse), lambda c: c < value))
    below = coarse * step + F.when(coarse < len(runs), fine).otherwise(0)
    return len(cuts) - F.least(below, F.lit(len(cuts)))


def with_next(docs: DataFrame, order: str, columns: dict[str, Column], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add to each row the values that ``columns`` has in the next row by descending ``order``, a number
    (after the last: the first). Rows are dealt to blocks of the order, cut at quantiles; the first
    row of a block is also lent to the block before it, so that no block needs another. What the
    driver gets is one value of ``order`` for each block, and there are at most MOST_BLOCKS."""
    rows = docs.count()
    blocks = min(MOST_BLOCKS, max(LEAST_BLOCKS, rows // block_rows))
    at = [i / blocks for i in range(1, blocks)]
    cuts = docs.agg(F.percentile_approx(order, at, 20 * blocks).alias("c")).first()["c"] or []
    cuts = sorted(set(cuts))
    # block 0 has the largest values, null comes after all
    block = F.when(F.col(order).isNull(), F.lit(len(cuts) + 1)).otherwise(_rank(F.col(order), cuts)).cast("int")
    heads = [tuple(r) for r in docs.groupBy(block.alias("b")).agg(F.max(order)).orderBy("b").collect()]
    tops, lender = [None] * (len(cuts) + 2), [None] * (len(cuts) + 2)
    for i, (b, top) in enumerate(heads):
        tops[b], lender[b] = top, heads[i - 1][0]  # the head of block b goes to the block before it, or to the last
    as_array = lambda v, kind: F.array(*map(F.lit, v)).cast(f"array<{kind}>")
    is_head = F.col(order).eqNullSafe(F.get(as_array(tops, docs.schema[order].dataType.simpleString()), F.col("_block")))
    lent = F.when(is_head, F.get(as_array(lender, "int"), F.col("_block")))
    names = list(columns)
    own = docs.select("*", *[v.alias(f"_own_{n}") for n, v in columns.items()], block.alias("_block"))
    homes = F.array(F.struct(F.col("_block").alias("b"), F.lit(False).alias("lent")), F.struct(lent.alias("b"), F.lit(True).alias("lent")))
    own = own.withColumn("_home", F.explode(F.filter(homes, lambda x: x["b"].isNotNull())))
    own = own.withColumn("_b", F.col("_home.b")).withColumn("_lent", F.col("_home.lent"))
    w = W.partitionBy("_b").orderBy("_lent", F.col(order).desc_nulls_last(), F.xxhash64(*[f"_own_{n}" for n in names]))
    for n in names:
        own = own.withColumn(n, F.lead(f"_own_{n}").over(w))
    return own.filter("not _lent").select(*docs.columns, *names)


def edited(text: Column, other: Column) -> Column:
    """The text with the last third of its characters replaced by as many first ones of ``other``."""
    n = F.length(text)
    third = F.floor(n / F.lit(3)).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - third), F.substring(other, F.lit(1), third))


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", text_of("text").alias("text"))
    docs = docs.select("doc_id", "text", fingerprint(F.col("text")).alias("print"))
    near = with_next(docs, "doc_id", {"next_text": F.col("text"), "next_print": F.col("print")})
    made = near.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), "print", "next_print", edited(F.col("text"), F.col("next_text")).alias("edit"))
    made = made.select("*", fingerprint(F.col("edit")).alias("edit_print"))
    return made.select(
        "doc_id", "n_chars", F.sha2("edit", 256).alias("edited_sha256"),
        F.array_join("print", "").alias("fingerprint"), F.array_join("edit_print", "").alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edit_print")).alias("near_edited"), likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
