"""op10 looks its anchors and windows up in steps written once, and takes the covered words out without Python."""

import random

from pyspark.sql import functions as F

from fieldlens.llm import substring


def _docs(spark):
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [" ".join(f"w{rng.randrange(9999)}" for _ in range(rng.randrange(0, 400))) for _ in range(40)]
    texts = [f"{t[: len(t) // 2]} {passage} {t[len(t) // 2 :]}" if i % 3 == 0 else t for i, t in enumerate(texts)]
    return spark.createDataFrame([*enumerate(texts), (90, None), (91, ""), (92, " \t\n")], "doc_id long, text string")


def test_no_python_where_the_rest_is_joined(spark):
    plan = substring.dedup_substrings(_docs(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" not in plan and plan.count("split(") == 1


def test_texts_are_split_for_anchors_windows_and_the_rest_only(spark, monkeypatch):
    """Each split of all texts and each step that is written: anchors, hot, places, windows, repeated, runs."""
    plans, write = [], substring.stored

    def watched(df, *used):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, *used)

    monkeypatch.setattr(substring, "stored", watched)
    docs = _docs(spark)
    substring.dedup_substrings(docs)
    assert sum("split(" in p for p in plans) == 2


def test_words_outside_windows(spark):
    rng = random.Random(6)
    cases = [([f"w{i}" for i in range(n)], sorted(rng.sample(range(n - 34), k))) for n, k in ((35, 1), (200, 3), (200, 166), (500, 5), (36, 2)) for _ in range(3)]
    cases.append((["a", "b"], None))
    rows = spark.createDataFrame([(i, w, s) for i, (w, s) in enumerate(cases)], "i int, w array<string>, s array<int>")
    got = dict(rows.select("i", substring.without_windows(F.col("w"), F.col("s"))).collect())
    for i, (w, s) in enumerate(cases):
        covered = {p for a in s or [] for p in range(a, a + substring.WINDOW)}
        assert got[i] == [x for p, x in enumerate(w) if p not in covered]


def test_small_parts_give_the_same_windows(spark, monkeypatch):
    whole = sorted((r.row.doc_id, r.text, r.n_words, r.n_removed) for r in substring.dedup_substrings(_docs(spark)).collect())
    assert sum(r[3] > 0 for r in whole) >= 14
    monkeypatch.setattr(substring, "PART_WORDS", 1)
    anchors = _docs(spark).select(F.xxhash64("doc_id").alias("key"), substring.word_hashes(F.coalesce("text", F.lit(""))).alias("w"))
    one = sorted(tuple(r) for b in anchors.toArrow().to_batches() for p in substring._anchors([b]) for r in zip(*(c.to_pylist() for c in p.columns)))
    monkeypatch.setattr(substring, "PART_WORDS", 1 << 17)
    assert one == sorted(tuple(r) for b in anchors.toArrow().to_batches() for p in substring._anchors([b]) for r in zip(*(c.to_pylist() for c in p.columns)))
