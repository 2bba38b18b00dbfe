"""Hard negatives by score bounds along a spanning tree of anchors.

Vectors are quantized to whole numbers; a row's score for an anchor is their inner product. Anchors
stand in blocks of near ones, rows in blocks of any ones, and every block of anchors meets every
block of rows once for positives and once for negatives: the anchors are the stated queries.

Where two blocks meet, the anchors' smallest spanning tree is walked from a root that scores all
rows. For a child, a row's score lies within (edge length) x (norm of the row) of its interval at
the parent (Cauchy-Schwarz). Only rows whose interval reaches what the child looks for are scored
again, and then have an exact interval to hand on:

* positives: rows of the anchor's label that may still be among the block's first five;
* negatives: rows of other labels that may lie in the window of one of the anchor's positives, and
  among its first three there.

Blocks give their own firsts, and Spark picks the firsts of all. No score is estimated: every
returned one is exact, and bounds are widened by more than rounding can shift them.

Nulls and cases: rows with a null id, label or vector, or a component that is null or not finite,
take no part. Rows of one id are never each other's positives or negatives; each row of an anchor's
id is an anchor, and repeated rows are candidates of their own. Rows meet only rows with as many
components; vectors without components score 0. Quantized components and scores stop at the ends
of a long; where a product could leave the exact range of a double, a block is scored in whole
numbers of any length instead. Columns other than id, vector and label are not read. An empty
table, or one without anchors, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldlens.llm.common import stored, table

EXACT = 2.0**53  # doubles hold whole numbers up to here


@dataclass(frozen=True)
class Mining:
    scale: int = 256
    positives: int = 5
    negatives: int = 3
    low: int = 50  # percent of the positive's score
    high: int = 95
    anchor_block: int = 512
    row_block: int = 8192
    pivots: int = 64  # at most; a bounded sample of anchors, to which blocks of near anchors gather


def usable(vectors: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """(id, label, v) of the rows that take part, v in whole numbers."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & label.isNotNull() & v.isNotNull() & finite)
    return rows.select(F.col(id_col).alias("id"), label.cast("bigint").alias("label"), F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array, rows: np.ndarray, dim: int) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.take(pa.array(rows)).flatten().to_numpy().astype(np.int64).reshape(len(rows), dim)


def _sizes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.list_value_length(column).to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else pc.list_value_length(column).to_numpy()


def spanning_tree(x: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(order, parent, length of the edge to it) of a smallest spanning tree, the root first with parent -1."""
    n = len(x)
    squares = (x * x).sum(axis=1)
    mean = x.mean(axis=0)
    root = int(np.argmin(((x - mean) ** 2).sum(axis=1)))

    def reach(i):
        return np.sqrt(np.maximum(squares + squares[i] - 2 * (x @ x[i]), 0))

    order, parent, edge = [root], np.full(n, -1), np.zeros(n)
    near, by = reach(root), np.full(n, root)
    out = np.ones(n, bool)
    out[root] = False
    for _ in range(n - 1):
        i = int(np.argmin(np.where(out, near, np.inf)))
        out[i] = False
        order.append(i)
        parent[i] = by[i]
        # from the difference itself: the form above loses digits between near vectors
        edge[i] = np.sqrt(((x[i] - x[by[i]]) ** 2).sum())
        d = reach(i)
        closer = d < near
        near[closer], by[closer] = d[closer], i
    return order, parent, edge


class Walk:
    """Scores of one block of rows for one block of anchors of the same number of components."""

    def __init__(self, anchors: np.ndarray, rows: np.ndarray):
        most = max(int(np.abs(a.astype(np.float64)).max(initial=0)) for a in (anchors, rows))
        self.whole = most * most * max(anchors.shape[1], 1) >= EXACT
        kind = object if self.whole else np.float64
        self.anchors, self.rows = anchors.astype(kind), rows.astype(kind)
        self.norms = np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))
        self.rescored = 0

    def _scores(self, k: int, at: np.ndarray | None) -> np.ndarray:
        rows = self.rows if at is None or 2 * len(at) > len(self.rows) else self.rows[at]
        s = rows @ self.anchors[k]
        self.rescored += len(rows)
        if self.whole:
            s = np.array([max(min(int(x), 2**63 - 1), -(2**63)) for x in s], object)
        return s if at is None or len(s) == len(at) else s[at]

    def each(self, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, rows, exact scores) along the tree; wanted(anchor, low, high) says which rows matter."""
        n = len(self.rows)
        if self.whole:  # no bounds: all rows are scored
            for k in range(len(self.anchors)):
                yield k, np.arange(n), self._scores(k, None)
            return
        order, parent, edge = spanning_tree(self.anchors)
        children = np.bincount(parent[parent >= 0], minlength=len(order))
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k in order:
            p = parent[k]
            if p < 0:
                low = high = self._scores(k, None)
                at = np.flatnonzero(wanted(k, low, high))
            else:
                low, high = kept[p]
                children[p] -= 1
                if not children[p]:
                    del kept[p]
                far = edge[k] * self.norms * (1 + 1e-9) + 1e-3
                low, high = low - far, high + far
                at = np.flatnonzero(wanted(k, low, high))
                low[at] = high[at] = self._scores(k, at)
            if children[k]:
                kept[k] = (low, high)
            yield k, at, low[at].astype(np.int64)


def _nth_largest(x: np.ndarray, n: int) -> float:
    return -np.inf if len(x) < n else np.partition(x, len(x) - n)[len(x) - n]


def _best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the n first by falling score, then rising id."""
    by_id = np.argsort(ids, kind="stable")
    return by_id[np.argsort(-scores[by_id], kind="stable")][:n]


def _meet(anchors: pa.Table, rows: pa.Table) -> Iterator[tuple[Walk, np.ndarray, np.ndarray]]:
    """Walks of the anchors and rows with the same number of components, with their places in the tables."""
    of_a, of_r = _sizes(anchors["v"]), _sizes(rows["v"])
    for dim in np.unique(of_a):
        a, r = np.flatnonzero(of_a == dim), np.flatnonzero(of_r == dim)
        if len(r):
            yield Walk(_matrix(anchors["v"], a, dim), _matrix(rows["v"], r, dim)), a, r


def _positives(m: Mining):
    def find(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        a_id, a_label, no = (anchors[c].to_numpy() for c in ("id", "label", "no"))
        r_id, r_label = rows["id"].to_numpy(), rows["label"].to_numpy()
        out = [[], [], []]
        for walk, a, r in _meet(anchors, rows):
            ids, labels = r_id[r], r_label[r]

            def wanted(k, low, high):
                own = (labels == a_label[a[k]]) & (ids != a_id[a[k]])
                return own & (high >= _nth_largest(low[own], m.positives))

            for k, at, scores in walk.each(wanted):
                own = (labels[at] == a_label[a[k]]) & (ids[at] != a_id[a[k]])
                at, scores = at[own], scores[own]
                first = _best(scores, ids[at], m.positives)
                for column, values in zip(out, (np.full(len(first), no[a[k]]), ids[at[first]], scores[first])):
                    column.extend(values.tolist())
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("no", "positive_id", "positive_score"), out)})

    return find


def _negatives(m: Mining):
    def find(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        a_id, a_label, no = (anchors[c].to_numpy() for c in ("id", "label", "no"))
        found = anchors["found"].to_pylist()
        r_id, r_label = rows["id"].to_numpy(), rows["label"].to_numpy()
        out = [[], [], [], []]
        for walk, a, r in _meet(anchors, rows):
            ids, labels = r_id[r], r_label[r]

            def wanted(k, low, high):
                other = (labels != a_label[a[k]]) & (ids != a_id[a[k]])
                any_ = np.zeros(len(ids), bool)
                for p in {f["positive_score"] for f in found[a[k]]}:
                    lo, hi = m.low * p / 100, m.high * p / 100
                    may = other & (high >= lo) & (low <= hi)
                    sure = other & (low >= lo) & (high <= hi)
                    any_ |= may & (high >= _nth_largest(low[sure], m.negatives))
                return any_

            for k, at, scores in walk.each(wanted):
                other = (labels[at] != a_label[a[k]]) & (ids[at] != a_id[a[k]])
                at, scores = at[other], scores[other]
                for f in found[a[k]]:
                    p = f["positive_score"]
                    exact = scores.astype(object) if walk.whole or abs(p) > EXACT else scores
                    inside = np.flatnonzero(((exact * 100 >= m.low * p) & (exact * 100 <= m.high * p)).astype(bool))
                    first = inside[_best(scores[inside], ids[at[inside]], m.negatives)]
                    for column, values in zip(out, ([no[a[k]]] * len(first), [f["place"]] * len(first), ids[at[first]].tolist(), scores[first].tolist())):
                        column.extend(values)
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("no", "place", "negative_id", "negative_score"), out)})

    return find


def _near_pivots(pivots: np.ndarray):
    """The nearest pivot of each anchor; anchors with another number of components go to the first."""
    squares = (pivots * pivots).sum(axis=1)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = _sizes(batch.column("v"))
            to = np.zeros(batch.num_rows, np.int32)
            at = np.flatnonzero(sizes == pivots.shape[1])
            if len(at):
                x = _matrix(batch.column("v"), at, pivots.shape[1]).astype(np.float64)
                to[at] = np.argmin(squares - 2 * (x @ pivots.T), axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(to)], names=[*batch.schema.names, "pivot"])

    return assign


def anchor_blocks(anchors: DataFrame, m: Mining) -> tuple[DataFrame, int]:
    """Anchors with a number and their block, and how many blocks there are. Blocks gather around pivots."""
    total = anchors.count()
    wanted = min(max(total // m.anchor_block, 1), m.pivots)
    sample = anchors.orderBy(F.xxhash64("id", "v")).limit(wanted).collect()
    if not sample:
        return anchors.withColumn("no", F.lit(0).cast("bigint")).withColumn("block", F.lit(0)), 0
    dim = len(sample[0].v)
    pivots = np.array([r.v for r in sample if len(r.v) == dim], np.float64).reshape(-1, dim)
    with_pivot = anchors.withColumn("no", F.monotonically_increasing_id()).mapInArrow(_near_pivots(pivots), anchors.schema.simpleString()[7:-1] + ",no:bigint,pivot:int")
    placed = stored(with_pivot)
    sizes = {r.pivot: r["count"] for r in placed.groupBy("pivot").count().collect()}  # at most m.pivots rows
    blocks = [-(-sizes.get(p, 0) // m.anchor_block) for p in range(len(pivots))]
    before = np.concatenate([[0], np.cumsum(blocks)]).tolist()
    of = F.get(F.array(*[F.lit(b) for b in before]), F.col("pivot"))
    many = F.get(F.array(*[F.lit(max(b, 1)) for b in blocks]), F.col("pivot"))
    return placed.withColumn("block", (of + F.pmod(F.xxhash64("no"), many)).cast("int")), before[-1]


def mine(
    vectors: DataFrame, is_anchor: Column, label: Column, mining: Mining | None = None, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score). ``is_anchor`` may name ``id``."""
    m = mining or Mining()
    rows = usable(vectors, id_col, vector_col, label, m.scale)
    # the width of numbers that all components fit, so that what travels stays small
    top = rows.agg(F.max(F.aggregate("v", F.lit(0).cast("bigint"), lambda a, x: F.greatest(a, F.when(x < 0, -(x + 1)).otherwise(x)))).alias("top")).first().top or 0
    width = "smallint" if top < 2**15 else "int" if top < 2**31 else "bigint"
    rows = stored(rows.withColumn("v", F.col("v").cast(f"array<{width}>")))
    anchors, n_blocks = anchor_blocks(rows.filter(is_anchor), m)
    anchors = stored(anchors)
    n_rows = max(-(-rows.count() // m.row_block), 1)
    # every block of anchors meets every block of rows
    listed = rows.withColumn("r_block", F.pmod(F.xxhash64("id", "v"), F.lit(n_rows)).cast("int"))
    listed = listed.withColumn("a_block", F.explode(F.sequence(F.lit(0), F.lit(max(n_blocks, 1) - 1))))

    def met(asked: DataFrame, find, schema: str) -> DataFrame:
        spread = asked.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))))
        return spread.groupBy("block", "q_block").cogroup(listed.groupBy("a_block", "r_block")).applyInArrow(find, schema)

    positives = met(anchors.select("no", "id", "label", "v", "block"), _positives(m), "no bigint, positive_id bigint, positive_score bigint")
    order = W.partitionBy("no").orderBy(F.desc("positive_score"), "positive_id")
    positives = positives.withColumn("place", F.row_number().over(order).cast("bigint")).filter(F.col("place") <= m.positives)
    positives = stored(positives)
    grouped = positives.groupBy("no").agg(F.collect_list(F.struct("place", "positive_score")).alias("found"))
    asked = anchors.select("no", "id", "label", "v", "block").join(grouped, "no")
    negatives = met(asked, _negatives(m), "no bigint, place bigint, negative_id bigint, negative_score bigint")
    order = W.partitionBy("no", "place").orderBy(F.desc("negative_score"), "negative_id")
    negatives = negatives.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= m.negatives)
    names = anchors.select("no", F.col("id").alias("anchor_id"))
    both = negatives.join(positives, ["no", "place"]).join(names, "no")
    return both.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label)
