"""Toxicity by a weighted lexicon matched with Aho-Corasick on folded text.

Folding undoes disguise: compatibility forms, unusual marks, invisible characters, look-alike letters
of other alphabets and digits that stand for letters all become plain letters; the lexicon is
folded likewise. Terms are whole words or word beginnings; their weights are log odds learned
from labelled documents. An exception phrase (a word, or two neighbouring words, that holds a
term but is met only in clean documents, or one given by the caller) silences the terms inside
it. The weights that remain, divided by the length in words, give the density; score =
density / (density + cut), and the cut is set on the labelled documents, so 0.5 is the verdict.

The lexicon is fitted on a bounded sample: at most ``max_labelled`` documents of each label, by
smallest hash of the id; at most ``max_terms`` terms and as many exceptions are kept, which bounds
what is sent to the tasks. Scoring covers every document's whole text.
Nulls and cases: a null or empty text, or one without words, scores 0; without toxic labels the
lexicon is empty and all score 0; null labels are ignored, of several the largest counts;
repeated rows score alike; input columns other than id and text are not read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm.common import stored, table, text_of

# fixed values: letters that look like Latin ones, and signs that stand for letters
LOOKS_LIKE = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ғ": "f", "ɡ": "g", "һ": "h", "н": "h", "і": "i", "ј": "j", "к": "k",
    "м": "m", "п": "n", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "α": "a", "β": "b",
    "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe",
}
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "l": "i"}
_SIGNS = {ord(k): v for k, v in (LOOKS_LIKE | STANDS_FOR).items()}
_PLAIN = bytes(ord(STANDS_FOR.get(c, c if c.isalnum() else " ")) for c in (chr(i).lower() for i in range(128))) + b" " * 128
_PAIRS = {chr(k): v for k, v in _SIGNS.items() if len(v) > 1 and k < 256}
_LATIN = bytes(i if len(_SIGNS.get(i, "")) > 1 else ord(_SIGNS.get(i, chr(i))) for i in range(256))
_BETWEEN = re.compile(r"[\W_]+")
HIDDEN = ("Mn", "Me", "Cf")  # marks above or below a letter, and characters without width
_LOOSE = re.compile("[\u00ad\u0300-\u036f]")  # soft hyphens, and accents written as characters of their own
PREFIXES = (4, 5, 6, 7, 8)


def fold(text: str) -> str:
    """Plain lower-case words with single or repeated spaces between, a space at either end."""
    if text.isascii():
        return f" {text.encode().translate(_PLAIN).decode()} "
    t = unicodedata.normalize("NFKC", _LOOSE.sub("", text.casefold()))
    try:
        latin = t.encode("latin-1")
    except UnicodeEncodeError:
        t = t.translate(_SIGNS)
    else:  # by a table of bytes, which spares a look-up a letter
        t = latin.translate(_LATIN).decode("latin-1")
        for sign, letters in _PAIRS.items():
            t = t.replace(sign, letters)
    if t and max(t) > "\u00ff":  # Latin letters with accents are spelling; other marks are taken off
        t = "".join(c for x in t for c in (x if x <= "\u00ff" else unicodedata.normalize("NFKD", x)) if c <= "\u00ff" or unicodedata.category(c) not in HIDDEN)
    return f" {_BETWEEN.sub(' ', t)} "


def terms_of(words: list[str]) -> Counter:
    """How often a text has each term."""
    found: Counter = Counter()
    for w, n in Counter(words).items():
        for k in PREFIXES:
            if len(w) > k:
                found[f" {w[:k]}"] += n
        if 2 < len(w) < 25:
            found[f" {w} "] += n
    return found


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)  # folded terms: " beginning" or " word "
    exceptions: frozenset[str] = frozenset()  # folded phrases " ... "
    cut: float = 1.0
    pad: int = 20  # words added to every length, so that one hit in a line is not everything

    def automaton(self) -> ahocorasick.Automaton:
        a = ahocorasick.Automaton()
        for t, w in self.weights.items():
            a.add_word(t, (len(t), w))
        for p in self.exceptions:
            a.add_word(p, (len(p), None))
        if len(a):
            a.make_automaton()
        return a

    def hits(self, folded: str, automaton) -> dict[int, float]:
        """Where terms begin, with the largest weight of those outside exception phrases."""
        found: list[tuple[int, int, float]] = []
        quiet: list[tuple[int, int]] = []
        for last, (n, w) in automaton.iter(folded) if len(automaton) else ():
            if w is None:
                quiet.append((last - n + 1, last))
            else:
                found.append((last - n + 1, last, w))
        best: dict[int, float] = {}
        k, reach = 0, -1
        quiet.sort()
        for start, last, w in sorted(found):
            while k < len(quiet) and quiet[k][0] <= start:
                reach = max(reach, quiet[k][1])
                k += 1
            if last > reach:
                best[start] = max(w, best.get(start, 0.0))
        return best

    def density(self, text: str, automaton) -> float:
        folded = fold(text)
        weight = sum(self.hits(folded, automaton).values())
        return weight / (len(folded.split()) + self.pad) if weight else 0.0


def held_out(id_col: str) -> Column:
    """One document in five, never learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


@dataclass(frozen=True)
class Fit:
    max_labelled: int = 5000  # labelled documents of each label, the sample the lexicon is fitted on
    max_terms: int = 5000
    least_documents: int = 3
    least_weight: float = 1.6
    least_exceptions: int = 20


def _counted(sample: DataFrame, terms_in, by: str) -> DataFrame:
    """(term, d1, n1, n0): toxic documents with a term, and its uses in toxic and in other documents;
    ``terms_in(text)`` counts the terms of a text."""
    def emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for at in range(0, len(pdf), 128):  # a text has some hundred terms
                part = pdf.iloc[at : at + 128]
                rows = [(t, y, n) for text, y in zip(part["text"], part["y"]) for t, n in terms_in(text).items()]
                yield pd.DataFrame(rows, columns=[by, "y", "n"])

    uses = sample.mapInPandas(emit, f"{by} string, y int, n bigint")
    n, y = F.col("n"), F.col("y")
    return uses.groupBy(by).agg(F.sum(y).alias("d1"), F.sum(n * y).alias("n1"), F.sum(n * (1 - y)).alias("n0"))


def fit(docs: DataFrame, labels: DataFrame, how: Fit = Fit(), exceptions: tuple[str, ...] = (), id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic") -> Lexicon:
    marks = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    marks = marks.groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("y"))
    order = F.xxhash64(F.lit(17), "id")
    picked = [marks.filter(F.col("y") == y).orderBy(order, "id").limit(how.max_labelled) for y in (0, 1)]
    picked = stored(picked[0].unionByName(picked[1]))
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    sample = stored(texts.join(picked, "id").select("text", "y"))
    counts = sample.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(F.split("text", " "))).alias("words"))
    size = {r["y"]: (r["n"], r["words"]) for r in counts.collect()}
    (n1, words1), (n0, words0) = size.get(1, (0, 0)), size.get(0, (0, 0))
    lex = Lexicon(exceptions=frozenset(fold(p).rstrip() + " " for p in exceptions))
    if not n1 or not n0:
        return lex

    # the log of how much more often toxic documents use the term, less 1.64 standard errors
    odds = F.log((F.col("n1") + 0.5) / words1) - F.log((F.col("n0") + 0.5) / words0)
    odds = odds - 1.64 * F.sqrt(1 / (F.col("d1") + 0.5) + 1 / (F.col("n0") + 0.5))
    strong = _counted(sample, lambda t: terms_of(fold(t).split()), "term").withColumn("w", odds)
    strong = strong.filter((F.col("d1") >= how.least_documents) & (F.col("w") >= how.least_weight))
    kept: dict[str, float] = {}
    for r in sorted(strong.orderBy(F.desc("n1"), "term").limit(how.max_terms).collect(), key=lambda r: (len(r["term"]), r["term"])):
        t = r["term"].rstrip()
        shorter = (kept.get(t[:k]) for k in range(2, len(t) + 1))
        if all(w is None or w < r["w"] - 0.5 for w in shorter):  # a beginning that says as much stands for it
            kept[r["term"]] = r["w"]
    lex.weights = kept

    def phrases(text: str) -> Counter:
        words = fold(text).split()
        at = [i for i, w in enumerate(words) if any(f" {w[:k]}" in kept for k in PREFIXES if len(w) > k) or f" {w} " in kept]
        one = {f" {words[i]} " for i in at}
        pairs = {(i - 1, i) for i in at if i} | {(i, i + 1) for i in at if i + 1 < len(words)}
        return Counter(one | {f" {words[i]} {words[j]} " for i, j in pairs})

    clean = _counted(sample, phrases, "phrase").filter(f"n1 = 0 and n0 >= {how.least_exceptions}")
    found = clean.orderBy(F.desc("n0"), "phrase").limit(how.max_terms).collect()
    lex.exceptions |= {r["phrase"] for r in found}

    # the cut: fewest wrong verdicts on the sample, in the middle of the gap on a log scale
    steps = 20
    floor = -1000

    def densities(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lex.automaton()
        for pdf in frames:
            d = (lex.density(t, automaton) for t in pdf["text"])
            yield pd.DataFrame({"step": [math.floor(math.log(x) * steps) if x > 0 else floor for x in d], "y": pdf["y"]})

    cells = sample.mapInPandas(densities, "step int, y int").groupBy("step").agg(F.sum("y").alias("n1"), F.sum(1 - F.col("y")).alias("n0"))
    cells = sorted((r["step"], r["n1"], r["n0"]) for r in cells.collect())  # steps are few: a log scale
    wrong, best, gap = n0, None, (0, 0)
    for k, (step, one, zero) in enumerate(cells):  # toxic from this step on
        if step > floor and (best is None or wrong < best):
            best, gap = wrong, (cells[k - 1][0] if k else floor, step)
        wrong += one - zero
    if best is not None:
        low, high = gap
        # no clean document with any weight: half of the least toxic density
        lex.cut = math.exp(high / steps) / 2 if low == floor else math.exp((low + 1 + high) / 2 / steps)
    return lex


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches in parts, so that the texts of few rows are Python strings at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, score, and the ``carry`` columns) for every row of ``docs``; score is 0 to 1."""
    plain = docs.select(F.col(id_col).alias("id"), *carry, text_of(text_col).alias("text"))
    fields = [f for f in plain.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for b in slices(batches):
            d = [lexicon.density(t, automaton) for t in b.column("text").to_pylist()]
            scores = pa.array([x / (x + lexicon.cut) for x in d], pa.float64())
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in fields], scores], names=[*[f.name for f in fields], "score"])

    return plain.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below 0.5, unchanged."""
    lexicon = fit(docs, labels, id_col=id_col, text_col=text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for b in slices(batches):
            d = [lexicon.density(t or "", automaton) for t in b.column(text_col).to_pylist()]
            # a score of 0.5 is a density at the cut
            yield b.filter(pa.array([x / (x + lexicon.cut) < 0.5 for x in d], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
