"""Packing of tables whose tasks hold documents of one size each."""

from pyspark.sql import functions as F

from fieldlens.llm import packing


def test_fillers_of_other_tasks_are_found(spark):
    # 11 tokens in the first half, 9 in the second (with the end token): one of each fills a sequence of 20
    long = spark.range(0, 5000, 1, 1).select("id", F.lit("x" + " x" * 9).alias("text"))
    short = spark.range(5000, 10000, 1, 1).select("id", F.lit("x" + " x" * 7).alias("text"))
    for per_task in (packing.PER_TASK, 3000):  # one task at the end, and several
        got = packing.pack(long.unionByName(short), length=20, per_task=per_task, id_col="id").collect()
        bins = {}
        for r in got:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert sorted(r.id for r in got) == list(range(10000)) and {r.length for r in got} == {9, 11}
        assert all(sum(n for _, n in b) <= 20 and sorted(b)[0][0] == 0 for b in bins.values())
        assert len(bins) <= 5000 * 1.02


def test_many_bins_without_fillers_come_out_once(spark):
    docs = spark.range(0, 6000, 1, 3).select("id", F.lit("x" + " x" * 9).alias("text"))
    got = packing.pack(docs, length=20, per_task=1000, id_col="id").collect()
    assert sorted(r.id for r in got) == list(range(6000)) and len({r.sequence_id for r in got}) == 6000
