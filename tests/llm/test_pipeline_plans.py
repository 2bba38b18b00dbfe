"""Steps of the pipeline that did the same work once a span or once a comparison, by their plans and results."""

import unicodedata

from fieldlens.llm import mixing, simhash, toxicity


def _docs(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(60 + i)), "ab"[i % 2], 0) for i in range(20)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")


def test_a_mixed_text_is_split_once_and_not_once_a_span(spark):
    plan = mixing.mix(_docs(spark), block_words=16)._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(" in plan and "slice(filter(split(" not in plan


def test_shingle_hashes_are_sorted_without_a_comparator(spark, monkeypatch):
    plans, write = [], simhash.stored

    def watched(df, *used):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, *used)

    monkeypatch.setattr(simhash, "stored", watched)
    assert simhash.keep_one(_docs(spark), size=5, similarity=0.8).count() == 20
    assert any("sort_array(" in p for p in plans) and not any("array_sort(" in p for p in plans)


def test_latin_letters_fold_by_the_table_as_one_by_one():
    for c in map(chr, range(128, 256)):
        t = unicodedata.normalize("NFKC", toxicity._LOOSE.sub("", f"x{c}0".casefold())).translate(toxicity._SIGNS)
        if not t or max(t) <= "ÿ":
            assert toxicity.fold(f"x{c}0") == f" {toxicity._BETWEEN.sub(' ', t)} "
