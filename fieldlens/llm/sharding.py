"""Shards of a corpus in random order: a two-pass external shuffle.

Pass one scatters whole records uniformly into memory-sized buckets by a seeded hash of id and
text. Pass two loads one bucket at a time, shuffles it with a seeded Fisher-Yates permutation
and writes it. Buckets laid end to end are the shuffled corpus; shard s takes the s-th equal
run of rows, so the counts of two shards differ by one at most (law ``rows``). Neither a hot
source nor a group of equal texts gathers anywhere, as the id takes part in the hash.

A bucket is put in a fixed order before it is permuted, so reruns and retried tasks agree.
Nulls and cases: null ids and texts are hashed as such; a null text has no bytes; rows that
agree in id and text share a bucket and each get a slot; an empty table gives no rows; the whole input row travels in
the struct ``record``, so its column names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.common import running_total, stored, table, text_of

SEED = 20_240_607


def shard_and_slot(position: Column, total: int, shards: int) -> tuple[Column, Column]:
    """The shard of a global position, and the place in it; the first shards take the odd rows."""
    base, odd = divmod(total, shards)
    edge = odd * (base + 1)
    in_first = F.floor(position / F.lit(base + 1))
    in_rest = F.lit(odd) + F.floor((position - edge) / F.lit(max(base, 1)))
    shard = F.when(position < edge, in_first).otherwise(in_rest).cast("int")
    start = shard * F.lit(base).cast("bigint") + F.least(shard, F.lit(odd))
    return shard, (position - start).cast("bigint")


def shuffle_records(
    docs: DataFrame, shards: int = 8, seed: int = SEED, bucket_bytes: int = 16 << 20, least_buckets: int = 256,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(record, shard, slot): every row of ``docs``, dealt to ``shards`` in random order.

    The number of buckets follows the bytes of the corpus, so a bucket stays memory-sized.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint")
    sums = docs.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    buckets = max(least_buckets, -(-sums["bytes"] // bucket_bytes))

    place = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    records = docs.select(F.pmod(place, F.lit(buckets)).alias("bucket"), place.alias("place"), F.struct(*docs.columns).alias("record"))
    counts = docs.select(F.pmod(place, F.lit(buckets)).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    all_buckets = spark.range(buckets).withColumnRenamed("id", "bucket").join(counts, "bucket", "left").fillna(0, ["n"])
    starts = stored(running_total(all_buckets, "bucket", "n", "before").select("bucket", "before"))

    schema = T.StructType([records.schema["record"], T.StructField("position", T.LongType())])

    def permute(rows: pa.Table, start: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({"record": rows["record"], "position": pa.array([], pa.int64())})
        rows = rows.take(pc.sort_indices(rows["place"]))
        draw = np.random.Generator(np.random.PCG64([seed, rows["bucket"][0].as_py()]))
        order = draw.permutation(rows.num_rows)  # a Fisher-Yates shuffle
        position = start["before"][0].as_py() + np.arange(rows.num_rows)
        return pa.table({"record": rows["record"].take(pa.array(order)), "position": pa.array(position)})

    dealt = records.groupBy("bucket").cogroup(starts.groupBy("bucket")).applyInArrow(permute, schema)
    shard, slot = shard_and_slot(F.col("position"), sums["rows"], shards)
    return stored(dealt.select("record", shard.alias("shard"), slot.alias("slot")))


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write one folder per shard, rows in slot order within each file."""
    dealt = shuffle_records(docs, **options)
    dealt.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op5_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shuffle_records(table(spark, sf_dir, "documents"), shards=8)
    text = text_of("record.text")
    return dealt.select(
        F.col("record.doc_id").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
