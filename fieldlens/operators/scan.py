"""Ordered scans that do not put a whole key into one task.

A window over ``partitionBy(clip)`` gives a long clip to one task. These helpers cut
the key into ordered blocks, scan each block on its own, and carry only one summary
row per block across: the same answer, spread over the cluster.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK = 4096
ROW_BLOCK = 65536


@dataclass(frozen=True)
class Carry:
    """What to carry: 'last'/'first' non-null value, or a running 'sum'.

    exclusive: look strictly before (last, sum) or strictly after (first) the row.
    """

    kind: str
    value: Column
    exclusive: bool = False


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where a null key meets a null key; the key columns are those of ``left``."""
    other = right.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    on = [left[k].eqNullSafe(other[f"_key_{i}"]) for i, k in enumerate(keys)]
    return left.join(other, on, how).drop(*[f"_key_{i}" for i in range(len(keys))])


def frame_block(frame: str = "frame", size: int = BLOCK) -> Column:
    return F.floor(F.col(frame) / F.lit(size))


def carry_scan(df: DataFrame, keys: list[str], order: list[str], block: Column, specs: dict[str, Carry]) -> DataFrame:
    """Add one column per spec. ``block`` must not decrease along ``order``.

    Every row stays: null keys are a key of their own, and rows without an order value come first.
    """
    work = df.withColumn("_blk", block)
    for n, s in specs.items():
        work = work.withColumn(f"_v_{n}", s.value)
    w = W.partitionBy(*keys, "_blk").orderBy(*order)
    position = F.struct(*order)
    local, summary = work, []
    over_blocks = W.partitionBy(*keys).orderBy("_blk")
    carried = []
    for n, s in specs.items():
        v = F.col(f"_v_{n}")
        if s.kind == "last":
            local = local.withColumn(n, F.last(v, True).over(w.rowsBetween(W.unboundedPreceding, -1 if s.exclusive else 0)))
            summary.append(F.max_by(v, F.when(v.isNotNull(), position)).alias(f"_s_{n}"))
            carried.append(F.last(f"_s_{n}", True).over(over_blocks.rowsBetween(W.unboundedPreceding, -1)).alias(f"_c_{n}"))
        elif s.kind == "first":
            local = local.withColumn(n, F.first(v, True).over(w.rowsBetween(1 if s.exclusive else 0, W.unboundedFollowing)))
            summary.append(F.min_by(v, F.when(v.isNotNull(), position)).alias(f"_s_{n}"))
            carried.append(F.first(f"_s_{n}", True).over(over_blocks.rowsBetween(1, W.unboundedFollowing)).alias(f"_c_{n}"))
        else:
            run = F.sum(v).over(w.rowsBetween(W.unboundedPreceding, -1 if s.exclusive else 0))
            local = local.withColumn(n, run)
            summary.append(F.sum(v).alias(f"_s_{n}"))
            carried.append(F.sum(f"_s_{n}").over(over_blocks.rowsBetween(W.unboundedPreceding, -1)).alias(f"_c_{n}"))
    blocks = work.groupBy(*keys, "_blk").agg(*summary).select(*keys, "_blk", *carried)
    out = null_safe_join(local, blocks, [*keys, "_blk"])
    for n, s in specs.items():
        own, before = F.col(n), F.col(f"_c_{n}")
        if s.kind == "sum":
            out = out.withColumn(n, F.when(own.isNull() & before.isNull(), None).otherwise(
                F.coalesce(own, F.lit(0)) + F.coalesce(before, F.lit(0))))
        else:
            out = out.withColumn(n, F.coalesce(own, before))
    return out.select(*df.columns, *specs)


def row_index(df: DataFrame, keys: list[str], order: list[str], block: Column, name: str = "rn") -> DataFrame:
    """1-based position of a row within its key."""
    return carry_scan(df, keys, order, block, {name: Carry("sum", F.lit(1).cast("long"))})


def halo_windows(
    df: DataFrame, keys: list[str], rn: str, before: int, after: int, columns, size: int = ROW_BLOCK
) -> DataFrame:
    """Bounded ROWS frames over a dense row index: each block borrows the rows it needs from the
    blocks around it, as many as the frame reaches over. ``columns(window)`` returns {name:
    expression over that window}. A row without an index has no neighbours and stands alone."""
    pos = F.col(rn) - 1
    own = F.floor(pos / size)
    first, last = F.floor((pos - after) / size), F.floor((pos + before) / size)  # blocks whose frames reach this row
    reached = F.transform(F.sequence(first, last), lambda b: F.struct(b.alias("b"), (b == own).alias("own")))
    targets = F.coalesce(reached, F.array(F.struct(own.alias("b"), F.lit(True).alias("own"))))
    wide = df.withColumn("_t", F.explode(targets)).withColumn("_rb", F.col("_t.b")).withColumn("_own", F.col("_t.own"))
    w = W.partitionBy(*keys, "_rb").orderBy(rn)
    cols = columns(w)
    for name, expr in cols.items():
        wide = wide.withColumn(name, expr)
    return wide.filter("_own").select(*df.columns, *cols)


def exact_percentiles(df: DataFrame, keys: list[str], value: str, qs: dict[str, float], buckets: int = 1024) -> DataFrame:
    """Linear-interpolation percentiles without holding a key's values in one task.

    Values are counted per bucket first; only the buckets that hold a wanted rank are ordered.
    """
    v = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    spread = v.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.sum("_n").alias("_tot"))
    wanted = F.array_distinct(F.flatten(F.array(*[
        F.array(F.floor(F.lit(q) * (F.col("_tot") - 1)), F.ceil(F.lit(q) * (F.col("_tot") - 1))) for q in qs.values()
    ])))
    spread = spread.withColumn("_want", wanted)
    width = (F.col("_hi") - F.col("_lo")) / buckets
    vb = null_safe_join(v, spread, keys).withColumn(
        "_b", F.when(width > 0, F.least(F.floor((F.col(value) - F.col("_lo")) / width), F.lit(buckets - 1))).otherwise(F.lit(0))
    )
    per_bucket = vb.groupBy(*keys, "_b").agg(F.sum("_n").alias("_bn"), F.first("_want").alias("_want"))
    run = F.sum("_bn").over(W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1))
    per_bucket = per_bucket.withColumn("_before", F.coalesce(run, F.lit(0)))
    hit = per_bucket.filter(
        F.exists("_want", lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_bn")))
    ).select(*keys, "_b", "_before")
    w = W.partitionBy(*keys, "_b").orderBy(value)
    ranked = (
        null_safe_join(vb, hit, [*keys, "_b"])
        .withColumn("_top", F.col("_before") + F.sum("_n").over(w.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("_from", F.col("_top") - F.col("_n"))
        .withColumn("_r", F.explode(F.filter("_want", lambda r: (r >= F.col("_from")) & (r < F.col("_top")))))
    )
    picked = ranked.groupBy(*keys).agg(
        F.map_from_entries(F.collect_set(F.struct(F.col("_r").alias("k"), F.col(value).cast("double").alias("v")))).alias("_m"),
        F.first("_tot").alias("_tot"),
    )
    out = []
    for name, q in qs.items():
        pos = F.lit(q) * (F.col("_tot") - 1)
        lo = F.element_at("_m", F.floor(pos))
        hi = F.element_at("_m", F.ceil(pos))
        out.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return picked.select(*keys, *out)
