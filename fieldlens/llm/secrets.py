"""Secret scan: patterns, and character Markov models compared by log-likelihood ratio.

Three patterns (assignments, access keys, long hex runs) give the base spans. Beyond them, runs of
16 or more characters that can make a credential, whatever they mix, are judged by two first-order Markov models of characters:
one of random strings, trained on the values that the patterns found, one of ordinary strings,
trained on words of documents without any find (below 16 characters, or common to several texts). The patterns thus label the samples. A run is a
secret ("markov") if its whole log-likelihood ratio is above the threshold that the
models' own samples set, and it does not touch a base span: the longer a run, the surer the sum.

Only DataFrame operations. The models are counts of character pairs over bounded samples:
``max_samples`` strings of each kind by smallest hash; they come to the driver as one table of
at most 96 x 96 numbers. Positions are code points: a text is split at the matches, and lengths add up.
Nulls and cases: a null or empty text has no span; without samples of both kinds no span is
added; repeated rows are scanned alike; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm.common import let, stored, table, text_of, words

ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""^(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
# maximal runs: asking for the length in the pattern finds the runs that are kept afterwards
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
LEAST = 16  # characters of a run that the models judge, and of the values that teach them
CANDIDATE = r"[A-Za-z0-9+/_=-]{%d,}" % LEAST
SPAN = "array<struct<start:int,kind:int,end:int>>"
FIRST, CHARS = 32, 96  # the characters that have a row of their own; others share the last
MAX_SAMPLES = 20_000
LONGEST, SHARED_BY = 64, 5  # a word as long as a candidate is ordinary up to so many characters, if so many texts have it
BACK_OFF = 5.0


def matches(text: Column, pattern: str, kind: int) -> Column:
    """(start, kind, end, value) of each leftmost non-overlapping match, in code points."""
    def spans(found: Column) -> Column:
        between = F.transform(F.split(text, pattern, -1), lambda s: F.length(s))
        pairs = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda gap, m: F.struct(gap.alias("gap"), m.alias("m")))

        def step(done: Column, p: Column) -> Column:
            start = F.coalesce(F.try_element_at(done, F.lit(-1))["end"], F.lit(0)) + p["gap"]
            one = F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(p["m"])).alias("end"), p["m"].alias("value"))
            return F.concat(done, F.array(one))

        return F.aggregate(pairs, F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>"), step)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)


def base_matches(text: Column) -> Column:
    """The base spans with their values, by start and kind."""
    value = lambda m: F.regexp_extract(m, ASSIGN_VALUE, 1)
    # only texts that hold a keyword at all are searched for assignments
    assign = F.filter(matches(text, ASSIGN, 0), lambda m: F.length(value(m["value"])) >= 6)
    assign = F.transform(assign, lambda m: m.withField("value", value(m["value"])))
    return F.array_sort(F.concat(assign, matches(text, ACCESS, 1), matches(text, HEX, 2)))


def _pairs(sample: DataFrame) -> DataFrame:
    """(a, b, y, n): how often character b follows a in the strings of either kind."""
    codes = F.transform(F.split("s", ""), _code)
    rows = sample.select("y", F.explode(F.zip_with(F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("p"))
    return rows.filter("p.b is not null").groupBy("p.a", "p.b", "y").agg(F.count(F.lit(1)).alias("n"))


def _code(c: Column) -> Column:
    return F.when(F.ascii(c).between(FIRST, FIRST + CHARS - 2), F.ascii(c) - FIRST).otherwise(CHARS - 1)


class Models:
    """Log-likelihood ratios (random over ordinary) by character pair, and the threshold of a whole string."""

    def __init__(self, ratios: list[float] | None = None, threshold: float = 0.0):
        self.ratios, self.threshold = ratios, threshold

    def ratio(self, s: Column) -> Column:
        """Log-likelihood ratio of a string."""
        table_ = F.array(*map(F.lit, self.ratios))
        steps = let(F.transform(F.split(s, ""), _code), lambda c: F.transform(
            F.sequence(F.lit(0), F.size(c) - 2), lambda i: F.get(table_, F.get(c, i) * CHARS + F.get(c, i + 1))))
        total = F.aggregate(steps, F.lit(0.0), lambda a, x: a + x)
        return F.when(F.length(s) >= 2, total).otherwise(F.lit(-99.0))


def train(plain: DataFrame, base: Callable[[Column], Column] = base_matches, max_samples: int = MAX_SAMPLES) -> Models:
    """Models from (text): values of base spans in all texts against words of sampled texts without any."""
    order = F.xxhash64(F.lit(29), "s")
    values = plain.select(F.explode(base(F.col("text"))["value"]).alias("s")).filter(F.length("s") >= LEAST).distinct()
    # texts are drawn by hash before any is searched; of copies one is drawn
    h = F.xxhash64(F.lit(29), "text")
    last = plain.select(h.alias("h")).distinct().orderBy("h").limit(max_samples // 10).agg(F.max("h").alias("h")).first()["h"]
    drawn = plain.filter(h <= F.lit(last if last is not None else 0)).select("text", h.alias("h")).dropDuplicates(["h"])
    ordinary = drawn.filter(F.size(base(F.col("text"))) == 0).select("h", F.posexplode(words(F.col("text"))).alias("at", "s"))
    # shorter than a candidate, so no unknown secret teaches the model; longer ones if several texts have them
    brief = F.length("s").between(6, LEAST - 1)
    common = ordinary.filter(F.length("s").between(LEAST, LONGEST)).groupBy("s").agg(F.count_distinct("h").alias("texts")).filter(F.col("texts") >= SHARED_BY)
    ordinary = ordinary.filter(brief).unionByName(ordinary.join(common.select("s"), "s", "left_semi"))
    random = values.orderBy(order, "s").limit(max_samples).select("s", F.lit(1).alias("y"))
    ordinary = ordinary.orderBy(F.xxhash64("h", "at"), "h", "at").limit(max_samples).select("s", F.lit(0).alias("y"))
    sample = stored(random.unionByName(ordinary))
    counts = {(r["a"], r["b"], r["y"]): r["n"] for r in _pairs(sample).collect()}
    if {y for _, _, y in counts} != {0, 1}:
        return Models()
    # a pair's chance backs off to the chance of its second character
    single = [[0.5] * CHARS for _ in (0, 1)]
    follow = [[0] * CHARS for _ in (0, 1)]
    for (a, b, y), n in counts.items():
        single[y][b] += n
        follow[y][a] += n
    single = [[n / sum(row) for n in row] for row in single]
    chance = lambda a, b, y: (counts.get((a, b, y), 0) + BACK_OFF * single[y][b]) / (follow[y][a] + BACK_OFF)
    out = [round(math.log(chance(a, b, 1) / chance(a, b, 0)), 4) for a in range(CHARS) for b in range(CHARS)]
    models = Models(out)
    # the threshold lies between the samples: above all but one in a thousand ordinary strings
    ranks = sample.select("y", models.ratio(F.col("s")).alias("r")).groupBy("y").agg(F.percentile("r", F.array(F.lit(0.05), F.lit(0.999))).alias("q"))
    q = {r["y"]: r["q"] for r in ranks.collect()}
    models.threshold = max(q[0][1], (q[0][1] + q[1][0]) / 2, 0.0)
    return models


def added_matches(text: Column, base: Column, models: Models) -> Column:
    """Spans of candidate runs that the models call random and that touch no base span."""
    if models.ratios is None:
        return F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    free = lambda m: ~F.exists(base, lambda b: (m["start"] < b["end"]) & (b["start"] < m["end"]))
    return F.filter(matches(text, CANDIDATE, 3), lambda m: free(m) & (models.ratio(m["value"]) > models.threshold))


def listed(spans: Column) -> Column:
    name = lambda s: F.get(F.array(*map(F.lit, KINDS)), s["kind"])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_samples: int = MAX_SAMPLES) -> DataFrame:
    """(id, base, added): the spans of every document as (start, kind, end, value)."""
    plain = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    models = train(plain, max_samples=max_samples)
    found = plain.withColumn("base", base_matches(F.col("text")))
    return found.select("id", "base", let(F.col("base"), lambda b: added_matches(F.col("text"), b, models)).alias("added"))


def op7_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        F.col("id").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )
