"""The small pure parts, by brute force and by property."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldlens.llm import line_dedup, mixing, packing, quality, secrets, simhash, substring, toxicity
from fieldlens.llm.common import running_total


@given(st.lists(st.integers(1, 100), max_size=60))
@settings(max_examples=80, deadline=None)
def test_best_fit_holds_every_item_once(sizes):
    bins = packing.best_fit(np.array(sizes, np.int64), 100)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 100 for b in bins)
    assert len(bins) <= 1.3 * math.ceil(sum(sizes) / 100) + 2 or any(s > 50 for s in sizes)


@given(st.integers(1, 5000))
@settings(deadline=None)
def test_cut_points_tile(n):
    cuts = packing.cut_points(n, 64)
    assert cuts[0][0] == 0 and sum(s for _, s in cuts) == n
    assert all(s == 64 for _, s in cuts[1:]) and all(a + s == b for (a, s), (b, _) in zip(cuts, cuts[1:]))


def test_cover_reaches_every_difference():
    c = substring.COVER
    for d in range(substring.PERIOD):
        assert any((a - b) % substring.PERIOD == d for a in c for b in c)


def test_every_five_bytes_hold_an_index_triple():
    from itertools import combinations

    assert all(any(set(t) <= set(five) for t in simhash.TRIPLES) for five in combinations(range(8), 5))


@given(st.lists(st.integers(0, 6), max_size=25), st.lists(st.integers(0, 6), max_size=25))
@settings(max_examples=150, deadline=None)
def test_patience_aligns_in_order(a, b):
    later, first = [(i, x) for i, x in enumerate(a) if x in b], [(j, x) for j, x in enumerate(b) if x in a]
    got = sorted(line_dedup.patience(later, first))
    assert len(set(got)) == len(got)
    rest = iter(b)
    assert all(a[p] in rest for p in got)  # aligned lines are a common subsequence
    if a == b:
        assert got == list(range(len(a)))


def test_binomial_cdf():
    for n, k, p in ((10, 3, 0.2), (50, 0, 0.02), (200, 7, 0.05), (5, 5, 0.5)):
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality.binomial_cdf(k, n, p) == pytest.approx(want, rel=1e-9)


def test_cutoffs_hold_the_limit(spark):
    good = [(i, "a b c d e f g h " * 0 + " ".join(f"w{i}x{k}" for k in range(60))) for i in range(400)]
    bad = [(1000 + i, " ".join(f"w{i}y{k}##" for k in range(60))) for i in range(100)]
    docs = spark.createDataFrame(good + bad, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id bigint, quality int")
    kept = {r.id: r.kept for r in quality.assess(docs, labels).collect()}
    assert all(kept[i] for i, _ in good) and not any(kept[i] for i, _ in bad)
    few = {r.id: r.kept for r in quality.assess(docs, labels.filter("doc_id < 20 or doc_id > 1050")).collect()}
    assert all(few.values())  # twenty good documents prove nothing: the rule stays idle


def test_the_limit_holds_for_all_rules_together(spark):
    own = lambda i, n=60: " ".join(f"w{i}x{k}" for k in range(n))
    odd = [lambda i: own(i) + " ####" * 1 + "#" * 200, lambda i: own(i) + f"\nl{i}" * 30, lambda i: own(i) + f" a{i} b{i} c{i}" * 10]
    good = [(i, odd[i % 3](i) if i < 84 else own(i)) for i in range(700)]
    bad = [(1000 + i, odd[i % 3](1000 + i)) for i in range(900)]
    docs = spark.createDataFrame(good + bad, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad], "doc_id bigint, quality int")
    lost = lambda risk: sum(not r.kept for r in quality.assess(docs, labels, risk).filter("id < 1000").collect())
    # every rule alone loses 4 in 100 of the good documents, all of them 12
    assert lost(quality.Risk(limit=0.1, good_cost=2.0)) <= 70
    assert lost(quality.Risk(limit=0.2, good_cost=2.0)) == 84


def sainte_lague(votes, seats):
    won = {k: 0 for k in votes}
    for _ in range(seats):
        k = min(votes, key=lambda k: (-votes[k] / (2 * won[k] + 1), k))
        won[k] += 1
    return won


@pytest.mark.parametrize("seats", [0, 1, 7, 40, 333])
def test_apportion_is_sainte_lague(spark, seats):
    for votes in ({1: 60.0, 2: 25.0, 3: 15.0}, {1: 1000.0, **{k: 1.5 + k / 97 for k in range(2, 40)}}, {1: 0.0, 2: 3.0}):
        df = spark.createDataFrame(list(votes.items()), "src int, target double")
        got = {r.src: r.blocks for r in mixing.apportion(df, [], "src", "target", F.lit(seats), "blocks").collect()}
        assert got == sainte_lague(votes, seats)


def test_running_total(spark):
    df = spark.range(50).select(F.col("id").alias("at"), (F.col("id") % 7).alias("v"))
    got = {r["at"]: r["before"] for r in running_total(df, "at", "v", "before", block=8).collect()}
    assert got == {i: sum(k % 7 for k in range(i)) for i in range(50)}


def test_fold():
    assert toxicity.fold("1D10T").split() == toxicity.fold("idiot").split() == toxicity.fold("іdіоt").split()
    assert toxicity.fold("ｉｄｉｏｔ").split() == toxicity.fold("id​iot").split() == toxicity.fold("idiot").split()
    assert toxicity.fold("Été").split() == ["été"]
    assert toxicity.fold("st\u00adupid").split() == toxicity.fold("i\u0301diot st\u0301upid".replace("i\u0301diot ", "")).split() == toxicity.fold("stupid").split()
    assert toxicity.fold("i\u0301diot").split() == toxicity.fold("idiot").split() and toxicity.fold("\u00ad").split() == []


def test_exception_phrases_silence():
    lex = toxicity.Lexicon({" trash": 5.0}, frozenset({" trash can "}), cut=0.01)
    a = lex.automaton()
    assert lex.density("such trash here", a) > 0 and lex.density("a trash can here", a) == 0
    assert lex.density("trash can and trash", a) > 0 and lex.density("", a) == 0


def test_markov_finds_random_strings(spark):
    import random

    r = random.Random(5)
    token = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))
    plain = "the of and thing other nation station ordinary words letter matter reader user_name number_of table_2_of version_2".split()
    text = lambda: " ".join(r.choice(plain) for _ in range(40))
    rows = [(i, f"{text()} password={token(24)} {text()}") for i in range(60)] + [(100 + i, text()) for i in range(60)]
    hidden = token(32)
    rows += [(500, f"{text()} {hidden} {text()}"), (501, "see version_number_2_of_the_table for that")]
    got = {x.id: x for x in secrets.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [s.value for s in got[500].added] == [hidden]
    assert got[501].added == [] and all(len(got[i].base) == 1 for i in range(60))


def test_markov_judges_short_runs_and_letters(spark):
    import random

    r = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    draw = lambda n, of: "".join(r.choice(of) for _ in range(n))
    plain = "the of and thing other nation station ordinary words letter matter reader user_name number_of internationalisation ---------------- characteristically".split()
    text = lambda: " ".join(r.choice(plain) for _ in range(40))
    rows = [(i, f"{text()} password={draw(24, letters + '0123456789')} {text()}") for i in range(200)] + [(1000 + i, text()) for i in range(200)]
    kinds = {(n, of): [draw(n, of) for _ in range(50)] for n in (16, 18, 24) for of in (letters, letters + "0123456789")}
    hidden = [v for vs in kinds.values() for v in vs]
    rows += [(5000 + i, f"{text()} {v} {text()}") for i, v in enumerate(hidden)]
    got = {x.id: [s.value for s in x.added] for x in secrets.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert not any(got[i] for i in got if i < 5000)
    assert sum(got[5000 + i] == [v] for i, v in enumerate(hidden)) >= 0.97 * len(hidden)


def test_long_lists_of_fingerprints_lose_no_link(spark):
    r = np.random.default_rng(3)
    base = int(r.integers(1 << 62))
    fps = sorted({base ^ sum(1 << int(b) for b in r.choice(24, size=3)) for _ in range(120)} | {int(x) for x in r.integers(1 << 62, size=100)})
    df = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 3}
    for limit in (4, 512):
        assert {(x.a, x.b) for x in simhash.similar_fingerprints(df, limit).collect()} == want


def test_stored_steps_leave_no_shuffle_files(spark):
    """A step can be read and stored again after its shuffle files went, and the session's own setting comes back."""
    from fieldlens.llm.common import SHUFFLE_CLEANUP, stored

    before = spark.conf.get(SHUFFLE_CLEANUP)
    dealt = spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count()
    first, again = stored(dealt), stored(dealt)
    assert sorted(first.collect()) == sorted(again.collect()) == sorted(dealt.collect())
    assert spark.conf.get(SHUFFLE_CLEANUP) == before


@given(st.lists(st.integers(0, 2), min_size=1, max_size=90), st.integers(1, 40))
@settings(max_examples=100, deadline=None)
def test_window_hashes_tell_windows_apart(numbers, size):
    """Windows are equal where their hashes are, whatever their length; too short a list has none."""
    assert not len(substring.window_hashes(np.ones(6, np.int64), 8, 3))
    w = np.array(numbers, np.int64) * 0x1234567 + 1
    found = substring.window_hashes(w, size, substring.MULTIPLIERS[0])
    assert len(found) == max(len(w) - size + 1, 0)
    by_window = {}
    for i, h in enumerate(found.tolist()):
        by_window.setdefault(tuple(numbers[i : i + size]), set()).add(h)
    assert all(len(v) == 1 for v in by_window.values())
    assert len(set.union(set(), *by_window.values())) == len(by_window)
