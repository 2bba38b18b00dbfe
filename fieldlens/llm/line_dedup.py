"""Line dedup by pairwise alignment.

Documents overlap through shared line hashes. Every line that several documents hold names its
first holder (the smallest id); a later document is paired with the first holders of its
lines and with no one else, so a line held by a group of thousands makes one link each, never
all pairs. A pair is aligned by patience diff on the lines that name it: lines unique in both are
the anchors, their longest rising run is kept, and the gaps between anchors are aligned
likewise. Lines that did not align, as they stand in another order there, name the first holder
among the later documents they are left in, in rounds until no line is left twice; a pair always
aligns a line, so rounds end. A block is a run of the later document's lines that align with one and
the same partner, blank lines aside; a block of at least ``block_words`` words is deleted, with the blank
lines inside. Lines that align with several documents, a line each, make no block together.

Work of a round is linear in the lines that are left: a group of copies is one row per line and copy.
Nulls and cases: a null text stays null; documents are ordered by (id, text hash), a null id
comes last; rows that agree in id and text are one document and change alike, so repeated rows
delete nothing of each other; a line repeated within one document only stays; empty tables give
no rows; the columns of the input are kept as they are, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.common import stored, table, text_of

BLOCK_WORDS = 5
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rising_run(values: list[int]) -> list[int]:
    """Indices of a longest strictly rising run."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        if k == len(tails):
            tails.append(v)
            ends.append(i)
        else:
            tails[k], ends[k] = v, i
        before[i] = ends[k - 1] if k else -1
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(later: list[tuple[int, int]], first: list[tuple[int, int]]) -> list[int]:
    """Positions of the later document that align. Both arguments list (position, line) in order."""
    aligned: list[int] = []
    todo = [(0, len(later), 0, len(first))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and later[a][1] == first[c][1]:
            aligned.append(later[a][0])
            a, c = a + 1, c + 1
        while a < b and c < d and later[b - 1][1] == first[d - 1][1]:
            b, d = b - 1, d - 1
            aligned.append(later[b][0])
        if a == b or c == d:
            continue
        once: dict[int, list[int]] = {}
        for i in range(a, b):
            once.setdefault(later[i][1], [0, 0, i, -1])[0] += 1
        for j in range(c, d):
            if (seen := once.get(first[j][1])) is not None:
                seen[1] += 1
                seen[3] = j
        anchors = sorted((s[2], s[3]) for s in once.values() if s[0] == s[1] == 1)
        if not anchors:
            # no line is unique: lines match greedily in order
            at: dict[int, list[int]] = {}
            for j in range(c, d):
                at.setdefault(first[j][1], []).append(j)
            j = c
            for i in range(a, b):
                places = at.get(later[i][1], ())
                k = bisect_left(places, j)
                if k < len(places):
                    aligned.append(later[i][0])
                    j = places[k] + 1
            continue
        kept = [anchors[i] for i in rising_run([j for _, j in anchors])]
        i, j = a, c
        for x, y in [*kept, (b, d)]:
            todo.append((i, x, j, y))
            if x < b:
                aligned.append(later[x][0])
            i, j = x + 1, y + 1
    return aligned


PLACES = T.ArrayType(T.IntegerType())
ALIGNED = T.StructType().add("aligned", T.ArrayType(PLACES)).add("lines", T.ArrayType(T.LongType())).add("left", T.ArrayType(PLACES))


@F.pandas_udf(ALIGNED)
def aligned_lines(shared: pd.Series) -> pd.DataFrame:
    """Of each document's shared lines (partner, line, its places, the partner's places): the aligned
    places by partner, and the lines with places that are left."""
    out = []
    for lines in shared:
        partners: dict[tuple, tuple[list, list]] = {}
        for s in lines:
            later, first = partners.setdefault((s["first_id"], s["first_mark"]), ([], []))
            later += [(int(p), s["line"]) for p in s["places"]]
            first += [(int(p), s["line"]) for p in s["first_places"]]
        blocks = [sorted(patience(sorted(later), sorted(first))) for later, first in partners.values()]
        gone = {p for places in blocks for p in places}
        left = [(int(s["line"]), rest) for s in lines if (rest := [int(p) for p in s["places"] if p not in gone])]
        out.append((blocks, [line for line, _ in left], [rest for _, rest in left]))
    return pd.DataFrame(out, columns=["aligned", "lines", "left"])


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_places(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, mark, line, places): the places of each distinct line with a word, a row per document and line."""
    text = text_of(text_col)
    one = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), F.posexplode(_split(text)).alias("place", "content"))
    content = F.rtrim("content")
    lines = one.filter(F.col("content").rlike(r"[^\x20\x09-\x0D]")).select("id", "mark", "place", F.xxhash64(content, F.length(content)).alias("line"))
    # array_distinct: repeated rows of one document are one document
    return lines.groupBy("id", "mark", "line").agg(F.array_sort(F.collect_set("place")).alias("places"))


def deleted_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, mark, aligned): the places of lines that align with an earlier document's, a list for each such document."""
    held = line_places(docs, id_col, text_col)
    who = F.struct(F.col("id").isNull().alias("void"), "id", "mark")
    same = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("mark") == F.col("first_mark"))
    rounds = []
    while True:
        heads = held.groupBy("line").agg(F.min(who).alias("who"), F.min_by("places", who).alias("first_places"), F.count(F.lit(1)).alias("holders"))
        # written, so that the join below has plain shuffles on both sides and Spark can split a hot line
        heads = stored(heads.filter("holders > 1").select("line", F.col("who.id").alias("first_id"), F.col("who.mark").alias("first_mark"), "first_places"))
        if rounds and heads.isEmpty():
            break
        shared = held.join(heads, "line").filter(~same)
        parts = F.collect_list(F.struct("first_id", "first_mark", "line", "places", "first_places"))
        grouped = shared.groupBy("id", "mark").agg(parts.alias("shared"))
        rounds.append(stored(grouped.select("id", "mark", aligned_lines("shared").alias("x")).select("id", "mark", "x.*")))
        left = rounds[-1].select("id", "mark", F.explode(F.arrays_zip("lines", "left")).alias("x"))
        held = left.select("id", "mark", F.col("x.lines").alias("line"), F.col("x.left").alias("places"))
    found = rounds[0].select("id", "mark", "aligned")
    for more in rounds[1:]:
        found = found.unionByName(more.select("id", "mark", "aligned"))
    if len(rounds) > 1:
        found = found.groupBy("id", "mark").agg(F.flatten(F.collect_list("aligned")).alias("aligned"))
    return found


REWRITTEN = T.StructType().add("text", T.StringType()).add("n_lines", T.IntegerType()).add("n_removed", T.IntegerType())


@F.pandas_udf(REWRITTEN)
def rewritten(text: pd.Series, aligned: pd.Series, least: pd.Series) -> pd.DataFrame:
    """The text without blocks of lines aligned with one document (and the blank lines inside them) of at least so many words."""
    out = []
    for t, partners, n in zip(text, aligned, least):
        lines = (t or "").split("\n")
        if partners is None:
            out.append((t, len(lines), 0))
            continue
        words = [len(WORD.findall(line)) for line in lines]
        worded = list(accumulate(1 if w else 0 for w in words))  # lines with a word up to each
        gone = set()
        for places in partners:
            at = list(map(int, places))
            start = 0
            for k in range(1, len(at) + 1):
                if k < len(at) and worded[at[k]] - worded[at[k - 1]] == 1:
                    continue
                if sum(words[p] for p in at[start:k]) >= n:
                    gone.update(range(at[start], at[k - 1] + 1))
                start = k
        out.append(("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else t, len(lines), len(gone)))
    return pd.DataFrame(out, columns=["text", "n_lines", "n_removed"])


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(row, text, n_lines, n_removed): every input row as a struct, and its text without the deleted blocks."""
    found = stored(deleted_lines(docs, id_col, text_col))
    found = found.select(F.col("id").alias("d_id"), F.col("mark").alias("d_mark"), "aligned")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("mark"))
    both = rows.join(found, rows["id"].eqNullSafe(found["d_id"]) & (rows["mark"] == found["d_mark"]), "left")
    done = both.select("row", F.col("row")[text_col].alias("t"), "aligned", F.lit(block_words).alias("least"))
    return done.select("row", rewritten("t", "aligned", "least").alias("new")).select("row", "new.*")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", **options) -> DataFrame:
    """The rows of ``docs`` with their texts deduplicated (and ``length_col``, if there, brought up to
    date). A document of which no word is left goes; one that had no word before stays."""
    done = dedup_lines(docs, id_col, text_col, **options)
    done = done.filter((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    new = {c: F.col("row")[c] for c in docs.columns} | {text_col: F.col("text")}
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        new[length_col] = F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("row")[length_col])
    return done.select(*[v.alias(c) for c, v in new.items()])


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(table(spark, sf_dir, "documents"))
    return done.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", "text")
