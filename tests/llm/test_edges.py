"""Every operator and stage on awkward tables: nulls, empty and long texts, ties, repeated rows, clashing columns, no rows."""

import random

import pytest
from pyspark.sql import functions as F

from fieldlens.llm import line_dedup, mixing, order_minhash, packing, quality, secrets, sharding, simhash, substring, toxicity

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# names that the operators use inside
CLASH = ("id", "row", "mark", "key", "fp", "place", "size", "bucket", "shard", "slot", "position", "record", "starts", "w", "h", "base",
         "spans", "copy", "src", "target", "n", "score", "members", "component", "text_", "_block", "_b", "aligned", "new", "y")


def some_text(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(words))


def rows():
    long = some_text(1, 40_000)
    copy = "\n".join(some_text(k, 40) for k in range(3))
    out = [
        (1, copy, "en", "a", 1), (2, copy, "en", "a", 1), (3, copy + " end", "en", "a", 1), (4, None, "en", "a", None), (5, "", None, None, 0),
        (6, " \n\t ", "en", "b", 4), (7, long, "en", "b", len(long)), (None, some_text(2, 60), None, "b", 1), (None, None, None, None, None),
        (8, some_text(3, 80), "en", "c", 1), (8, some_text(3, 80), "en", "c", 1), (8, some_text(4, 80), "en", "c", 1), (9, "x", "en", "c", 1),
        (10, "x", "fr", "c", 1), (11, "same " * 3000, "fr", "d", 1), (12, "\n".join(["one two three four five six"] * 50), "fr", "d", 1),
        (13, "éß日本 😀 \U0001f600 a‍b", "fr", None, 1),
    ]
    return out


@pytest.fixture(scope="module")
def awkward(spark):
    df = spark.createDataFrame(rows(), COLUMNS)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASH}).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 1), (8, 0, 1), (99, 1, 1), (None, 1, 1), (7, None, None), (11, 0, 1)], "doc_id bigint, quality int, toxic int")


def no_labels(labels):
    return labels.limit(0)


OPERATORS = {
    "toxicity": lambda d, y: toxicity.score(d, toxicity.fit(d, y)),
    "line dedup": lambda d, y: line_dedup.dedup_lines(d),
    "packing": lambda d, y: packing.pack(d),
    "fingerprints": lambda d, y: order_minhash.with_next(
        d.select("doc_id", "text", order_minhash.fingerprint(F.coalesce("text", F.lit(""))).alias("print")), "doc_id", {"next_print": F.col("print")}),
    "sharding": lambda d, y: sharding.shuffle_records(d),
    "simhash": lambda d, y: simhash.components(d),
    "secrets": lambda d, y: secrets.scan(d),
    "mixing": lambda d, y: mixing.draw(d),
    "quality": lambda d, y: quality.assess(d, y),
    "substrings": lambda d, y: substring.dedup_substrings(d),
}
# rows out for rows in; packing cuts the long text into more
EXACT = set(OPERATORS) - {"packing"}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows_are_all_answered(awkward, labels, name):
    got = OPERATORS[name](awkward, labels)
    assert len(set(got.columns)) == len(got.columns)
    n = len(got.collect())
    assert n == len(rows()) if name in EXACT else n > len(rows())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_give_no_rows(nothing, labels, name):
    assert OPERATORS[name](nothing, labels).collect() == []
    assert OPERATORS[name](nothing, no_labels(labels)).collect() == []


STAGES = {
    "toxicity": lambda d, y: toxicity.drop_toxic(d, y),
    "line dedup": lambda d, y: line_dedup.drop_repeated_lines(d),
    "simhash": lambda d, y: simhash.keep_one(d),
    "mixing": lambda d, y: mixing.mix(d),
}


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_the_columns(awkward, nothing, labels, name):
    got = STAGES[name](awkward, labels)
    assert got.columns == awkward.columns
    found = got.collect()
    assert 0 < len(found) and all(r["row"] == "own row" for r in found)
    assert STAGES[name](nothing, labels).collect() == []


def test_line_dedup_rows(awkward):
    got = {(r.doc_id, r.text) for r in line_dedup.drop_repeated_lines(awkward).select("doc_id", "text").collect()}
    ids = [i for i, _ in got]
    assert 1 in ids and 2 not in ids  # the copy has nothing left
    tail = next(t for i, t in got if i == 3)
    assert tail == rows()[2][1].split("\n")[2]  # two lines align, the changed one stays
    assert (4, None) in got and (5, "") in got
    assert (12, rows()[15][1]) in got  # repeats inside one document stay


def test_simhash_keeps_one_of_each_group(awkward):
    kept = [r.doc_id for r in simhash.keep_one(awkward).select("doc_id").collect()]
    assert kept.count(1) == 1 and 2 not in kept
    assert kept.count(4) == 1 and 5 not in kept and 6 not in kept  # texts without words are one group
    assert kept.count(8) == 1 or kept.count(8) == 2


def test_substrings_of_repeated_rows(awkward):
    got = [(r.row.doc_id, r.n_words, r.n_removed) for r in substring.dedup_substrings(awkward).collect()]
    assert (1, 120, 120) in got and (2, 120, 120) in got
    assert [g for g in got if g[0] == 8].count((8, 80, 80)) == 2  # rows of one id and text are copies
    assert (11, 3000, 3000) in got and (9, 1, 0) in got


def test_sharding_is_a_full_shuffle(awkward):
    got = sharding.shuffle_records(awkward, shards=4).select("shard", "slot").collect()
    sizes = sorted(sum(r.shard == s for r in got) for s in range(4))
    assert sizes[-1] - sizes[0] <= 1
    for s in range(4):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    again = sharding.shuffle_records(awkward, shards=4).select("shard", "slot", "record.doc_id").collect()
    assert sorted(map(str, again)) == sorted(map(str, sharding.shuffle_records(awkward.repartition(7), shards=4).select("shard", "slot", "record.doc_id").collect()))
