"""Lists of hashes go to Python a few documents at a time."""

from fieldlens.llm import simhash
from fieldlens.llm.common import BATCH_ROWS


def test_wide_prints_read_few_lists_at_a_time(spark, monkeypatch):
    limit, plain = simhash.LIST_ROWS, simhash.wide_bits

    def watched(batches):
        def few():
            for b in batches:
                assert b.num_rows <= limit, b.num_rows
                yield b

        yield from plain(few())

    monkeypatch.setattr(simhash, "wide_bits", watched)
    before = spark.conf.get(BATCH_ROWS)
    docs = spark.range(0, 3000, 1, 1).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(1, 12), i -> concat('w', (id div 2) * 100 + i))) as text")
    left = simhash.keep_one(docs, size=5, similarity=0.8)
    assert sorted(r["doc_id"] for r in left.select("doc_id").collect()) == list(range(0, 3000, 2))
    assert spark.conf.get(BATCH_ROWS) == before
