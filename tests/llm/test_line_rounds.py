"""Shared lines that stand in another order in their first holder, and lines that most documents hold."""

from fieldlens.llm import line_dedup

LINES = [f"line {k} of some words here" for k in range(3)]
SCHEMA = "doc_id bigint, text string"


def test_copies_of_a_reordered_document_go(spark):
    a, b = "\n".join(LINES[::-1]), "\n".join(LINES)
    docs = spark.createDataFrame([(1, a), (2, b), (3, b), (4, b + "\nan own line of words here")], SCHEMA)
    got = {r.row.doc_id: (r.n_removed, r.text) for r in line_dedup.dedup_lines(docs).collect()}
    assert got[1][0] == 0 and got[2][0] == 1
    assert got[3][0] == 3 and got[4] == (3, "an own line of words here")


def test_lines_of_most_documents_align(spark):
    common = "a line of five words"
    docs = spark.createDataFrame([(i, f"own line number {i} of many\n{common}") for i in range(40)], SCHEMA)
    got = {r.row.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert common in got[0] and not any(common in got[i] for i in range(1, 40))


def test_lines_of_several_documents_are_no_block(spark):
    rows = [(i, f"w{i}\nown text of document {i} here") for i in range(5)]
    rows += [(9, "\n".join(f"w{i}" for i in range(5)) + "\nan own line of document 9")]
    got = {r.row.doc_id: (r.n_removed, r.text) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: (0, t) for i, t in rows}


def test_short_lines_of_one_document_are_a_block(spark):
    shared = "one two\n\nthree\nfour five"
    rows = [(1, f"a first own line\n{shared}\nanother own line"), (2, f"own words\n{shared}\nmore own words"), (3, "three\nfour five\nown")]
    got = {r.row.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: rows[0][1], 2: "own words\nmore own words", 3: rows[2][1]}
