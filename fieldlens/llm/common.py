"""Small pieces that the corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldlens.session import shared_dir

# words are what lies between these characters: space, tab, line feed, vertical tab, form feed, return
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text, a null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    return F.filter(F.split(text, GAP), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body, or a lambda in it, names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# Spark's switch to delete the shuffle files of a query at its end
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# rows that Spark gathers, on both sides of the pipe, before a batch goes to Python
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def setting(spark: SparkSession, name: str, value: str, default: str) -> Iterator[None]:
    before = spark.conf.get(name, default)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffles_end_with_query(spark: SparkSession):
    return setting(spark, SHUFFLE_CLEANUP, "true", "false")


def batches_of(spark: SparkSession, rows: int):
    """Smaller Arrow batches for steps run inside, where a row is a long list."""
    return setting(spark, BATCH_ROWS, str(rows), "10000")


def stored(df: DataFrame, *used: DataFrame) -> DataFrame:
    """Write to the folder that all executors share and read back: a lost executor then costs
    no earlier work, and later readers see one fixed result. The shuffle files of the step go with its
    end. ``used`` are stored steps that nothing reads any more once this one is written; their folders go."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    with shuffles_end_with_query(spark):
        df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_at = path
    release(*used)
    return back


def release(*steps: DataFrame) -> None:
    """Delete the folders of stored steps that only steps already written have read."""
    for step in steps:
        path = step.sparkSession._jvm.org.apache.hadoop.fs.Path(step.stored_at)
        path.getFileSystem(step.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def running_total(df: DataFrame, position: str, value: str, name: str, block: int = 4096) -> DataFrame:
    """Add the sum of ``value`` over smaller ``position`` (whole numbers from 0), in two levels:
    blocks of positions add up on their own, and only one row per block is summed in order."""
    b = F.floor(F.col(position) / block).alias("_block")
    sums = df.groupBy(b).agg(F.sum(value).alias("_sum"))
    upto = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    before = sums.select("_block", F.coalesce(F.sum("_sum").over(upto), F.lit(0)).alias("_before"))
    inside = W.partitionBy("_block").orderBy(position).rowsBetween(W.unboundedPreceding, -1)
    out = df.select("*", b).join(before, "_block")
    return out.withColumn(name, F.col("_before") + F.coalesce(F.sum(value).over(inside), F.lit(0))).select(*df.columns, name)
