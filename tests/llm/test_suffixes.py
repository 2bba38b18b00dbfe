"""Repeated bytes against a plain set of the strings seen before."""

import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldlens.llm import suffixes
from tests_llm_rows import COLUMNS, awkward_rows, some_text


def plain(docs):
    """{id: (bytes, removed, spans, digest)} of (id, text) in the order given."""
    seen, out = set(), {}
    for i, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            w = b[p : p + 100]
            if w in seen:
                gone[p : p + 100] = b"\x01" * 100
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def found(spark, docs, schema="doc_id bigint, text string"):
    got = suffixes.dedup_bytes(spark.createDataFrame(docs, schema))
    return {r.row.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got.collect()}


def test_op11_on_the_small_table(spark, small_dir):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.op11_suffix_buckets(spark, small_dir).collect()}
    assert got == plain(docs)


def test_parts_of_passages_and_low_entropy(spark):
    r = random.Random(5)
    passage = "".join(r.choice("abcde fgh") for _ in range(900))
    fill = lambda n: "".join(r.choice("klmno pqrs") for _ in range(n))
    docs = [(1, passage), (2, fill(300) + passage[200:299] + fill(50)), (3, fill(10) + passage[200:300] + fill(50)), (4, passage[100:640] + fill(70) + passage[500:]),
            (5, "a" * 99), (6, "a" * 100), (7, "a" * 1500), (8, "ab" * 400), (9, "é" * 300), (10, "x" + "é" * 60), (11, None), (12, ""), (13, passage), (14, fill(120) * 9)]
    assert found(spark, docs) == plain(docs)


def test_order_copies_and_null_ids(spark):
    t, u = (some_text(k, 60)[:150] for k in (1, 2))
    got = suffixes.dedup_bytes(spark.createDataFrame([(2, t), (2, t), (5, t), (None, u), (9, u), (3, t[:99])], "doc_id bigint, text string"))
    assert sorted((str(r.row.doc_id), r.n_removed) for r in got.collect()) == [("2", 0), ("2", 0), ("3", 0), ("5", 150), ("9", 0), ("None", 150)]


def test_awkward_tables(spark):
    rows = awkward_rows()
    got = suffixes.dedup_bytes(spark.createDataFrame(rows, COLUMNS).withColumnsRenamed({"lang": "start", "source": "mark"})).collect()
    assert len(got) == len(rows) and all(r.n_bytes == len((r.row.text or "").encode()) and 0 <= r.n_removed <= r.n_bytes for r in got)
    assert suffixes.dedup_bytes(spark.createDataFrame([], COLUMNS)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 4))
def test_equal_windows_have_their_key_gram_at_the_same_offset(seed, letters):
    r = np.random.default_rng(seed)
    window = r.integers(0, letters, 100, dtype=np.uint8)
    offsets = []
    for _ in range(2):
        left = int(r.integers(0, 200))
        data = np.concatenate([r.integers(0, letters, left, dtype=np.uint8), window, r.integers(0, letters, 50, dtype=np.uint8)])
        offsets.append(suffixes.key_grams(suffixes.gram_buckets(data))[left] - left)
    assert offsets[0] == offsets[1] and 0 <= offsets[0] < suffixes.SPAN


def test_removed_ranges():
    raw = bytes(range(250))
    assert suffixes.without_ranges(raw, np.array([0, 149]), np.array([1, 2])) == (raw[100:149], 2)
    assert suffixes.without_ranges(b"", np.zeros(0, int), np.zeros(0, int)) == (b"", 0)


def test_long_texts_come_in_pieces_that_overlap(monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 700)
    raw = bytes(random.Random(1).choice(b"abcdef") for _ in range(2500))
    windows = []
    for piece, extras in suffixes.pieces([(10, raw, "x"), (5000, raw[:99], "y"), (6000, raw[:150], "z")]):
        part, first, last, _ = piece.segments(suffixes.gram_buckets(piece.data))
        for p, lo, hi in zip(part, first, last):
            windows += [(int(piece.docs[p]), int(piece.offsets[p] + i - piece.begins[p]), bytes(piece.data[i : i + 100])) for i in range(lo, hi + 1)]
    assert windows == [(d, i, raw[i : i + 100]) for d, n in ((10, 2500), (6000, 150)) for i in range(n - 99)]
