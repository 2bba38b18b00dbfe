"""Sequential steps over long ordered series, in parallel blocks.

Some operators depend on their own previous output (a linker, a rate limit). A series is
cut into ordered blocks; every block runs at once from a guessed starting state, and a
block runs again only while the state handed over by its predecessor differs from the one
it assumed. When nothing changes, each block started from exactly the state the block
before it produced, so by induction the result equals one pass from the start. States are
small and forget quickly, so two passes are the rule. Series of one block take one pass, and
many of them share a call into Python: a call costs more than a short series.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.session import cut

# run(rows sorted by order, state or None) -> (output rows, state after the block as text)
Run = Callable[[pd.DataFrame, "str | None"], "tuple[pd.DataFrame, str]"]


BUCKET_ROWS = 65536


def steps(pdf: pd.DataFrame, by: str, columns: list) -> Iterator[tuple]:
    """(value, arrays of ``columns``) for each run of equal ``by`` in rows sorted by it; a column is a name or an
    array as long as the rows. Slices of arrays: a pandas group per frame costs more than the step that it feeds."""
    at, cols = pdf[by].to_numpy(), [pdf[c].to_numpy() if isinstance(c, str) else c for c in columns]
    starts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1)] if len(at) else []
    for a, b in zip(starts, [*starts[1:], len(at)]):
        yield at[a], [c[a:b] for c in cols]


def run_blocks(rows: DataFrame, keys: list[str], block: str, order: list[str], run: Run, out_schema: str) -> DataFrame:
    """Output columns: keys, block, then ``out_schema``."""
    fields = {f.name: f.dataType for f in rows.schema.fields}
    group = [*keys, block]
    head = ", ".join(f"{k} {fields[k].simpleString()}" for k in group)
    names = [f.name for f in T._parse_datatype_string(out_schema).fields]

    def emit(pdf, state):
        out, _ = run(pdf.sort_values(order, kind="stable").reset_index(drop=True), state)
        for i, k in enumerate(group):
            out.insert(i, k, pdf[k].iloc[0])
        return out[[*group, *names]]

    def emit_bucket(pdf):
        pdf = pdf.sort_values(order, kind="stable")
        of = pdf.groupby(group, sort=False, dropna=False).ngroup().to_numpy()
        by_group = np.argsort(of, kind="stable")
        pdf, of = pdf.iloc[by_group], of[by_group]
        starts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1)]
        outs = [run(pdf.iloc[a:b].reset_index(drop=True), None)[0] for a, b in zip(starts, [*starts[1:], len(pdf)])]
        out, sizes = pd.concat(outs, ignore_index=True), [len(o) for o in outs]
        for i, k in enumerate(group):
            out.insert(i, k, pdf[k].iloc[starts].repeat(sizes).to_numpy())
        return out[[*group, *names]]

    def last_state(pdf, state):
        _, after = run(pdf.sort_values(order, kind="stable").reset_index(drop=True), state)
        return pd.DataFrame([[*(pdf[k].iloc[0] for k in group), after]], columns=[*group, "state"])

    def plain(fn):
        return lambda pdf: fn(pdf, None)

    def in_buckets(df, total):
        n = max(8 * parts, math.ceil(total / BUCKET_ROWS))
        bucketed = df.withColumn("_bucket", F.pmod(F.xxhash64(*group), F.lit(n))).repartition(parts, "_bucket")
        return bucketed.groupBy("_bucket").applyInPandas(emit_bucket, emit_schema)

    def fed(fn, columns):
        def g(pdf, st):
            if pdf.empty:
                return pd.DataFrame(columns=columns)
            state = st["state"].iloc[0] if len(st) else None
            return fn(pdf, None if pd.isna(state) else state)

        return g

    # explicit partitions: a Python pass is bound by CPU, so small shuffles must not be merged
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    emit_schema, state_schema = f"{head}, {out_schema}", f"{head}, state string"
    rows = cut(rows)  # read by the count and by every pass
    sizes = rows.groupBy(*keys).agg(F.min(block).alias("a"), F.max(block).alias("b"), F.count(F.lit(1)).alias("n"))
    several = F.coalesce(F.col("b") > F.col("a"), F.lit(False))
    long_count, short_rows = sizes.agg(F.count_if(several), F.coalesce(F.sum(F.when(~several, F.col("n"))), F.lit(0))).first()
    if not long_count:
        return cut(in_buckets(rows, short_rows))

    long_keys = sizes.filter(several).select(*keys)
    single = in_buckets(rows.join(long_keys, keys, "left_anti"), short_rows)
    long = rows.join(long_keys, keys, "left_semi").repartition(parts, *group)
    over = W.partitionBy(*keys).orderBy(block)
    after = cut(long.groupBy(*group).applyInPandas(plain(last_state), state_schema))
    assumed = after.select(*group, F.lit(None).cast("string").alias("state"))
    while True:
        handed = after.select(*group, F.lag("state").over(over).alias("state"))
        stale = cut(
            handed.join(assumed.withColumnRenamed("state", "was"), group).filter("not (state <=> was)").select(*group, "state")
        )
        assumed = handed
        if stale.isEmpty():
            break
        again = (
            long.join(stale.select(*group), group, "left_semi")
            .groupBy(*group)
            .cogroup(stale.groupBy(*group))
            .applyInPandas(fed(last_state, [*group, "state"]), state_schema)
        )
        after = cut(after.join(stale.select(*group), group, "left_anti").unionByName(again))
        assumed = cut(assumed)
    final = long.groupBy(*group).cogroup(assumed.groupBy(*group)).applyInPandas(fed(emit, [*group, *names]), emit_schema)
    # the pass is the costly part: store it, so that no later reader runs it again
    return cut(single.unionByName(final))
