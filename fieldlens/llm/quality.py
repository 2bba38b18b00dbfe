"""Quality rules whose cutoffs carry a guarantee on false rejection.

Rules measure a document (share of symbols, of repeated lines, of words in repeated runs). In
each stratum of length every rule may reject documents above its cutoff. The labelled documents
of a stratum are dealt by a hash of their id: a quarter of them proposes a cutoff for each rule: the one with
the best balance of bad against good documents, a good one counting ``good_cost`` bad ones. All rules together then tighten from the laxest
cutoff to these, step by step. The other three quarters are the holdout: a step is certified when the exact
binomial test on its good documents rejects "more than ``limit`` of good documents are lost to any rule". Steps
are tested in order, and testing stops at the first that fails, which needs no correction along the
order; the level ``alpha`` is split over the strata (Bonferroni). So with a chance of 1 - alpha no stratum loses more
than ``limit`` of its good documents to all rules together. Of the certified steps the one with the best
balance is used. Without a certified and useful step the rules of a stratum are idle.

Nulls and cases: a null text has no words and fails the base rules; labels that are null or
for unknown documents are ignored; a document labelled twice counts with its larger label;
empty tables give idle rules or no rows; input columns other than id and text are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import re
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm.common import stored, table, text_of

SYMBOLS = "#*$%&|<>"
GAPS = " \t\n\v\f\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
BANDS = (200, 1000)  # strata: up to 199, up to 999, more words
GRID = tuple(round(0.8**k, 6) for k in range(24))  # cutoffs of a share, laxest first
DEAL = 20_240_901  # seed of the hash that deals labelled documents
PARTS = 4  # one of so many parts proposes


@dataclass(frozen=True)
class Risk:
    limit: float = 0.02  # of a stratum's good documents, all rules together
    alpha: float = 0.05
    good_cost: float = 25.0


def measure_text(text: str) -> tuple[int, ...]:
    found = WORD.findall(text)
    n = len(found)
    runs = list(zip(found, found[1:], found[2:]))
    covered = 0
    if len(set(runs)) < len(runs):
        seen = Counter(runs)
        upto = 0
        for i, r in enumerate(runs):
            if seen[r] > 1:
                covered += i + 3 - max(upto, i)
                upto = i + 3
    lines = [x for x in text.split("\n") if x.strip(GAPS)]
    return (
        n, len(text) - sum(map(text.count, GAPS)), sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)), covered, len(lines),
    )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = np.array([measure_text(t) for t in b.column("text").to_pylist()], np.int64).reshape(-1, len(MEASURES))
        yield pa.RecordBatch.from_arrays([b.column("id"), *map(pa.array, rows.T)], names=["id", *MEASURES])


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    id_type = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return plain.mapInArrow(_measure, f"id {id_type}, " + ", ".join(f"{m} bigint" for m in MEASURES))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules() -> dict[str, Column]:
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "symbols": share("n_symbols", "word_chars"),
        "repeated_lines": share("n_dup_lines", "n_lines"),
        "repeated_runs": share("n_repeat_words", "n_words"),
    }


def stratum() -> Column:
    return sum(F.when(F.col("n_words") >= b, 1).otherwise(0) for b in BANDS)


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X of n draws with chance p."""
    if k >= n:
        return 1.0
    i = np.arange(k, dtype=np.float64)
    steps = np.log((n - i) / (i + 1)) + np.log(p) - np.log1p(-p)
    logs = n * np.log1p(-p) + np.concatenate([[0.0], np.cumsum(steps)])
    top = logs.max()
    return float(min(1.0, np.exp(top) * np.exp(logs - top).sum()))


@dataclass
class Cutoffs:
    values: dict[tuple[int, str], float] = field(default_factory=dict)

    def rejects(self) -> Column:
        """True where some rule's value is above its cutoff in the row's stratum."""
        hit, at = F.lit(False), rules()
        for (band, rule), cut in sorted(self.values.items()):
            hit = hit | ((stratum() == band) & (at[rule] > F.lit(cut)))
        return hit


def _per_cutoff(counts: np.ndarray) -> np.ndarray:
    """Documents rejected at each step from the documents first rejected there."""
    return np.cumsum(counts, axis=-1)


def fit(measured: DataFrame, labels: DataFrame, risk: Risk = Risk(), id_col: str = "doc_id", label_col: str = "quality") -> Cutoffs:
    """Cutoffs from all labelled documents that pass the base rules. What comes to the driver
    are tables of strata x rules x grid x label."""
    marks = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("good"))
    # the first grid cutoff below each rule's value; the grid's length where there is none
    first = [sum(F.when(v > F.lit(g), 0).otherwise(1) for g in GRID).alias(r) for r, v in rules().items()]
    held = measured.filter(~base_failed()).join(marks, "id")
    held = stored(held.select(F.pmod(F.xxhash64(F.lit(DEAL), "id"), F.lit(PARTS)).alias("part"), stratum().alias("band"), "good", *first))

    cells = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("first")) for r in rules()])).alias("c")
    counts = held.filter("part = 0").select("band", "good", cells).groupBy("band", "good", "c.rule", "c.first").agg(F.count(F.lit(1)).alias("n"))
    seen: dict[tuple[int, str], np.ndarray] = {}
    for r in counts.collect():
        seen.setdefault((r["band"], r["rule"]), np.zeros((2, len(GRID) + 1), np.int64))[r["good"], r["first"]] += r["n"]
    proposed: dict[int, dict[str, int]] = {}
    for (band, rule), grid in seen.items():
        bad, good = _per_cutoff(grid)[:, :-1]
        gain = bad - risk.good_cost * good
        if gain.max() > 0:
            proposed.setdefault(band, {})[rule] = int(gain.argmax())

    hits = [F.when((F.col("band") == band) & (F.col(rule) <= g), F.col(rule)) for band, found in proposed.items() for rule, g in found.items()]
    step = F.least(F.lit(len(GRID)), F.lit(len(GRID)), *hits)  # least passes over nulls
    counts = held.filter("part > 0").groupBy("band", "good", step.alias("step")).agg(F.count(F.lit(1)).alias("n"))
    steps: dict[int, np.ndarray] = {}
    for r in counts.collect():
        steps.setdefault(r["band"], np.zeros((2, len(GRID) + 1), np.int64))[r["good"], r["step"]] += r["n"]
    out, level = Cutoffs(), risk.alpha / (len(BANDS) + 1)
    for band, found in proposed.items():
        bad, good = _per_cutoff(steps.get(band, np.zeros((2, len(GRID) + 1), np.int64)))
        n, best, chosen = int(good[-1]), 0.0, None
        for g in range(max(found.values()) + 1):
            if not n or good[g] >= risk.limit * n or binomial_cdf(int(good[g]), n, risk.limit) > level:
                break
            if (gain := bad[g] - risk.good_cost * good[g]) > best:
                best, chosen = gain, g
        if chosen is not None:
            out.values |= {(band, rule): GRID[min(chosen, g)] for rule, g in found.items()}
    return out


def assess(docs: DataFrame, labels: DataFrame, risk: Risk = Risk(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, measures, base_failed, kept) of every document."""
    measured = stored(measures(docs, id_col, text_col))
    cutoffs = fit(measured, labels, risk, id_col)
    return measured.withColumn("base_failed", base_failed()).withColumn("kept", ~(F.col("base_failed") | cutoffs.rejects()))


def op9_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(F.col("id").alias("doc_id"), *MEASURES[:-1], "base_failed", "kept")
