"""Mixing sources to target weights by Sainte-Laguë apportionment.

The mix is made of blocks of equally many words. Sources get blocks one by one, each time the
source with the highest quotient target / (2 blocks + 1); the blocks of a source are shared out
over its shards (slices of the source by a seeded hash, so that a hot source is many shards)
by the same rule. In a shard the documents lie end to end in seeded order, cut into blocks, and
the blocks with the lowest seeded hashes are taken until the shard's quota is met; a quota above
the number of blocks takes each block once before any is taken twice.

Only DataFrame operations; windows run over one shard, over the shards of one source and over
the list of sources, never over documents as a whole.
Nulls and cases: a null text has no words; null is a source of its own and comes last; repeated
rows are documents of their own; documents without words take nothing; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldlens.llm.common import let, stored, table, text_of, words

SEED = 20_240_613
BLOCK_WORDS = 128
SHARD_WORDS = 250_000
WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2  # of all words; of a source's own words


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(src, source, source_size, target) from (source, source_size). A target stops at ``most``
    times the source's size, and the excess goes to the others by weight: target = min(cap, level * weight),
    where level is the highest of (all words - caps already full) / (weights not yet full) in order of cap per weight."""
    order = W.orderBy(F.col("source").isNull(), "source")
    s = sizes.withColumn("src", F.row_number().over(order).cast("int"))
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("src") - 1, F.lit(len(weights))) + 1))
    s = s.withColumn("cap", F.col("source_size") * float(most))
    fill = W.orderBy(F.col("cap") / F.col("weight"), "src")
    everything = F.sum("source_size").over(W.partitionBy()) * share
    full = F.coalesce(F.sum("cap").over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(fill.rowsBetween(0, W.unboundedFollowing))
    s = s.withColumn("level", (everything - full) / open_weight)
    s = s.withColumn("level", F.max("level").over(W.partitionBy()))
    return s.select("src", "source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def apportion(df: DataFrame, group: list[str], key: str, votes: str, seats: Column, name: str) -> DataFrame:
    """Add the seats of each ``key`` within ``group`` by Sainte-Laguë. With n keys the last divisor
    lies where all votes make between seats - n/2 and seats + n/2 quotients, so only seats in that
    range are ranked: about two for each key, however many seats there are."""
    all_of = W.partitionBy(*group)
    n = F.count(F.lit(1)).over(all_of)
    part = F.when(F.sum(votes).over(all_of) > 0, F.col(votes) / F.sum(votes).over(all_of)).otherwise(F.lit(0.0))
    r = df.withColumn("_seats", seats).withColumn("_n", n).withColumn("_part", part)
    sure = F.greatest(F.floor(F.col("_part") * (F.col("_seats") - F.col("_n") / 2) - 0.5) - 1, F.lit(0)).cast("bigint")
    most = F.ceil(F.col("_part") * (F.col("_seats") + F.col("_n") / 2) + 0.5).cast("bigint") + 1
    r = r.withColumn("_sure", sure).withColumn("_open", F.col("_seats") - F.sum("_sure").over(all_of))
    quotients = r.select("*", F.explode(F.sequence(F.col("_sure") + 1, most)).alias("_k"))
    best = W.partitionBy(*group).orderBy((F.col("_part") / (2 * F.col("_k") - 1)).desc(), key, "_k")
    won = quotients.withColumn("_won", (F.row_number().over(best) <= F.col("_open")) & (F.col("_part") > 0))
    seen = won.groupBy(*group, key).agg(F.sum(F.col("_won").cast("bigint")).alias("_more"), F.first("_sure").alias("_base"),
                                        *[F.first(c).alias(c) for c in df.columns if c not in (*group, key)])
    return seen.select(*df.columns, (F.col("_base") + F.col("_more")).alias(name))


def draw(
    docs: DataFrame, seed: int = SEED, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """(id, mark, copy, size, source_size, target, taken, spans) of every document: the words taken, and
    the runs of words as (start, end, times). mark is a hash of the text, copy counts rows that agree in both."""
    text = text_of(text_col)
    sized = stored(docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), F.col(source_col).alias("source"),
        F.size(words(text)).cast("bigint").alias("size"), F.xxhash64(F.lit(seed), F.col(id_col), text).alias("place"),
    ))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes).withColumn("shards", F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)))
    seats = F.round(F.sum("target").over(W.partitionBy()) / block_words).cast("bigint")
    targets = stored(apportion(targets, [], "src", "target", seats, "blocks"))

    named = sized.join(targets.withColumnRenamed("source", "s"), sized["source"].eqNullSafe(F.col("s")), "inner").drop("s", "source")
    placed = named.withColumn("shard", F.pmod("place", "shards"))
    cells = placed.groupBy("src", "shard").agg(F.sum("size").alias("cell_size"), F.first("blocks").alias("blocks"))
    quotas = stored(apportion(cells, ["src"], "shard", "cell_size", F.col("blocks"), "quota").select("src", "shard", "cell_size", "quota"))

    cell = W.partitionBy("src", "shard")
    line = cell.orderBy("place", "id", "mark")
    laid = placed.join(quotas, ["src", "shard"])
    laid = laid.withColumn("n", F.row_number().over(line)).withColumn("start", F.sum("size").over(line.rowsBetween(W.unboundedPreceding, 0)) - F.col("size"))
    end = F.col("start") + F.col("size")
    # the cell's blocks are equal to a word: block b starts at word ceil(b * cell_size / blocks)
    blocks = F.greatest(F.round(F.col("cell_size") / block_words), F.lit(1)).cast("bigint")
    laid = laid.withColumn("cell_blocks", blocks)
    block_of = lambda at: F.floor(at * F.col("cell_blocks") / F.col("cell_size")).cast("bigint")
    first_word = lambda b: F.ceil(b * F.col("cell_size") / F.col("cell_blocks")).cast("bigint")
    cut = laid.select("*", F.explode_outer(F.when(F.col("size") > 0, F.sequence(block_of(F.col("start")), block_of(end - 1)))).alias("block"))
    chance = F.when(F.col("block").isNotNull(), F.xxhash64(F.lit(seed), "src", "shard", "block"))
    lot = F.dense_rank().over(cell.orderBy(chance.asc_nulls_last(), F.col("block").asc_nulls_last()))
    rounds, rest = F.floor(F.col("quota") / F.col("cell_blocks")), F.col("quota") % F.col("cell_blocks")
    times = F.least(rounds + F.when(lot <= rest, 1).otherwise(0), F.lit(MOST))
    lo = F.greatest(first_word(F.col("block")), F.col("start")) - F.col("start")
    hi = F.least(first_word(F.col("block") + 1), end) - F.col("start")
    parts = cut.withColumn("times", times.cast("int")).withColumn("span", F.struct(lo.alias("start"), hi.alias("end"), "times"))
    spans = F.filter(F.sort_array(F.collect_list("span")), lambda s: s["start"].isNotNull() & (s["times"] > 0))
    taken = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + (s["end"] - s["start"]) * s["times"])
    out = parts.groupBy("src", "shard", "n").agg(
        *[F.first(c).alias(c) for c in ("id", "mark", "size", "source_size", "target")], spans.alias("spans"))
    copy = F.row_number().over(W.partitionBy("id", "mark").orderBy("n"))
    return out.select("id", "mark", copy.alias("copy"), "size", "source_size", "target", taken.alias("taken"), "spans")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row for each document and each time it is
    drawn, its text cut to the words taken that time (unchanged if all of them are)."""
    drawn = draw(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    drawn = drawn.select(F.col("id").alias("_id"), F.col("mark").alias("_mark"), F.col("copy").alias("_copy"), "spans", "size")
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    rows = rows.select("row", F.col("row")[id_col].alias("id"), F.xxhash64(text).alias("mark"))
    rows = rows.withColumn("copy", F.row_number().over(W.partitionBy("id", "mark").orderBy("mark")))
    both = rows.join(drawn, rows["id"].eqNullSafe(drawn["_id"]) & (rows["mark"] == drawn["_mark"]) & (rows["copy"] == drawn["_copy"]))
    each = both.select("row", "size", "spans", F.explode(F.sequence(F.lit(1), F.lit(MOST))).alias("time"))
    each = each.withColumn("spans", F.filter("spans", lambda s: s["times"] >= F.col("time")))
    each = each.withColumn("got", F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])).filter("got > 0")
    # a text is split once, not once a span
    part = let(words(text), lambda w: F.array_join(F.flatten(F.transform("spans", lambda s: F.slice(w, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), " "))
    part = F.when(F.col("got") == F.col("size"), text).otherwise(part)
    length = F.length("cut").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    kept = each.withColumn("cut", part)
    pick = {c: F.col("row")[c] for c in docs.columns} | {text_col: F.col("cut")} | ({"n_chars": length} if length is not None else {})
    return kept.select(*[v.alias(c) for c, v in pick.items()])


def op8_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = draw(table(spark, sf_dir, "documents"))
    return drawn.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")
