"""Series of one block share calls into Python, and steps read slices instead of pandas groups."""

import numpy as np
import pandas as pd
import pytest

from fieldlens.config import ActionZoneConfig, CrowdConfig, LinkConfig
from fieldlens.operators import crowd, linking, review
from fieldlens.operators.blockrun import run_blocks
from fieldlens.plans import review_queries
from fieldlens.streaming import online


def running_sum():
    def run(pdf, state):
        at = float(state or 0)
        upto = at + pdf["v"].cumsum()
        return pd.DataFrame({"n": pdf["n"], "upto": upto}), str(upto.iloc[-1])

    return run


@pytest.mark.parametrize("block", [7, 1000])
def test_short_long_and_null_keys_sum_up(spark, block):
    rows = spark.range(3000).selectExpr(
        "case when id % 300 = 299 then null else concat('k', id % 300) end as k", "cast(id div 300 as int) as n", "cast(id % 17 as double) as v", f"(id div 300) div {block} as b")
    got = run_blocks(rows, ["k"], "b", ["n"], running_sum(), "n int, upto double").toPandas()
    assert len(got) == 3000
    known = rows.toPandas().sort_values(["k", "n"]).dropna()
    want = known.assign(upto=known.groupby("k")["v"].cumsum())
    assert {(r.k, r.n): r.upto for r in got.dropna().itertuples()} == {(r.k, r.n): r.upto for r in want.itertuples()}


def test_short_keys_share_calls_into_python(spark, monkeypatch):
    rows = spark.range(4000).selectExpr("id as k", "0 as b", "1 as n", "1d as v")
    seen, plain = [], type(rows).groupBy
    monkeypatch.setattr(type(rows), "groupBy", lambda self, *c: (seen.append(c), plain(self, *c))[1])
    assert run_blocks(rows, ["k"], "b", ["n"], running_sum(), "n int, upto double").count() == 4000
    assert ("_bucket",) in seen and ("k", "b") not in seen


def frames_of(monkeypatch):
    def no_groups(self, *a, **k):
        raise AssertionError("a pandas group per frame")

    monkeypatch.setattr(pd.DataFrame, "groupby", no_groups)


def test_steps_of_frames_make_no_pandas_groups(monkeypatch):
    frames_of(monkeypatch)
    n = 60
    rng = np.arange(n)
    pdf = pd.DataFrame({
        "idx": rng // 3, "frame": rng // 3, "sample": rng // 3, "det_id": rng, "yaw": (rng % 3) * 40.0 + rng * 0.1, "pitch": 0.0, "weighted_conf": 0.5,
        "conf": 0.5, "box_h": 40.0, "cx": (rng % 3) * 100.0, "cy": 5.0, "area": 9.0, "px": 600.0})
    for run in (linking._linker(LinkConfig()), linking._player_tracks(CrowdConfig()), linking._still_chains(3840.0, 5.0)):
        out, _ = run(pdf, None)
        seen = out[out["slot"].isna()]
        assert len(seen) == n and seen["ref"].nunique() == 3
    zone = pd.DataFrame({
        "sample": [0, 0, 1, 2, 2], "ts": [0.0, 0.0, 0.5, 1.0, 1.0], "group_no": [0, 1, 0, 0, 1], "eligible": True, "is_main": [True, False, True, True, False],
        "separation": [0.0, 40.0, 0.0, 0.0, 50.0], "sub_speed_norm": 1.0, "coherence": 1.0, "main_speed_norm": 0.0, "size_penalty": 0.0, "ids": [[1], [2, 3], [1], [1], [2, 3]]})
    out, _ = crowd.breakaway_run(ActionZoneConfig())(zone, None)
    assert out["sample"].tolist() == [0, 1, 2] and out["best_separation"].tolist() == [40.0, 0.0, 50.0]


def test_blocks_of_stored_tracks_make_no_pandas_groups(spark, monkeypatch):
    held = {}
    monkeypatch.setattr(online, "run_blocks", lambda rows, keys, block, order, run, schema: held.setdefault("run", run) and rows)
    online.track_batch(spark.createDataFrame([("c", 0)], "clip_id string, frame int"))
    frames_of(monkeypatch)
    pdf = pd.DataFrame({"frame": [0, 0, 2], "det_id": [1.0, np.nan, 2.0], "yaw": 1.0, "pitch": 2.0, "conf": 0.5, "area": 9.0, "px": 600.0})
    out, _ = held["run"](pdf, None)
    assert out["frame"].tolist() == [0, 1, 2]


def test_queries_that_need_no_windows_do_not_space_them(spark, small_dir, monkeypatch):
    def never(*a, **k):
        raise AssertionError("windows spaced for a query that does not show them")

    monkeypatch.setattr(review, "greedy_spaced", never)
    for q in (review_queries.cluster_match_radius, review_queries.cluster_spread, review_queries.discovered_static_matches):
        assert q(spark, small_dir) is not None
