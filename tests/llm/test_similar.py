"""Near copies by the similarity of five-word shingles, as the pipeline's stage removes them."""

import random

import corpus_pipeline
from fieldlens.llm import simhash


def shingles(t, size=5):
    w = t.split()
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or {tuple(w)}


def similarity(a, b):
    return len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))


def edited(r, text, edits):
    w = text.split()
    for k in range(edits):
        w[(k + 1) * len(w) // (edits + 1)] = f"new{r.random()}"
    return " ".join(w)


def test_copies_with_a_few_edits_go(spark):
    r = random.Random(1)
    base = [" ".join(f"w{r.randrange(20000)}" for _ in range(300)) for _ in range(60)]
    rows, far = [(i, t) for i, t in enumerate(base)], []
    for edits in (1, 3, 5, 6):
        rows += [(1000 * edits + i, edited(r, t, edits)) for i, t in enumerate(base)]
    assert all(similarity(base[i % 1000], t) >= 0.8 for i, t in rows)
    far = [(90000 + i, edited(r, t, 12)) for i, t in enumerate(base)]
    rows += [*far, (None, "a b"), (95000, "A b "), (95001, ""), (95002, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {x.doc_id for x in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert {i for i, _ in enumerate(base)} | {i for i, _ in far} | {95000, 95001} <= kept and None not in kept and 95002 not in kept
    assert not kept & {1000 * k + i for k in (1, 3) for i in range(60)}
    assert len(kept & {1000 * k + i for k in (5, 6) for i in range(60)}) <= 12  # 120 at 0.8 to 0.85: nine of ten are found at least


def test_rounds_and_pairs_find_the_same(spark):
    r = random.Random(2)
    base = " ".join(f"w{k}" for k in range(200))
    rows = [(i, edited(r, base, i % 12)) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for rounds in (0, 4):
        ids = {x.h_id for x in simhash.dissimilar(docs, "doc_id", "text", 5, 0.8, rounds).collect()}
        texts = dict(rows)
        assert 0 in ids and not any(similarity(texts[a], texts[b]) >= 0.85 for a in ids for b in ids if a < b)
