"""Texts are read in blocks that fit a cache, and rows go to Spark in batches of some size."""

import random

import numpy as np
import pyarrow as pa

from fieldlens.llm import suffixes


def test_short_texts_come_in_small_blocks_and_long_ones_alone():
    rows = [(k, bytes(150)) for k in range(3000)] + [(9000, bytes(400_000))]
    sizes = [(len(p.docs), len(p.data)) for p, _ in suffixes.pieces(iter(rows))]
    assert sum(n for n, _ in sizes) == 3001
    assert all(size <= 1 << 17 for n, size in sizes if n > 1) and sizes[-1] == (1, 400_000)


def test_rows_of_many_blocks_share_a_batch(monkeypatch):
    texts = [random.Random(k).randbytes(300).hex() for k in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(400))], names=["text", "key"])
    whole = pa.Table.from_batches(list(suffixes._key_gram_rows(iter([batch]))))
    monkeypatch.setattr(suffixes, "BLOCK", 1000)
    got = list(suffixes._key_gram_rows(iter([batch])))
    assert len(got) == 1 and pa.Table.from_batches(got).equals(whole)


def test_grams_have_one_name_if_and_only_if_they_are_equal():
    r = np.random.default_rng(3)
    # few letters, and pairs that differ in the highest bytes of both halves only
    tops = [bytes(7) + bytes([a]) + bytes(7) + bytes([b]) for a in range(0, 256, 5) for b in range(256)]
    data = np.frombuffer(b"".join([r.integers(0, 2, 70_003, dtype=np.uint8).tobytes(), *tops]), np.uint8)
    names = suffixes.gram_buckets(data)
    raw = data.tobytes()
    by_name, by_gram = {}, {}
    for i, name in enumerate(names.tolist()):
        gram = raw[i : i + 16]
        assert by_name.setdefault(name, gram) == gram and by_gram.setdefault(gram, name) == name
    assert len(names) == len(raw) - 15
