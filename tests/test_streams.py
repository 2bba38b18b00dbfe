"""Streams over several files against the same rows at once, and against plain loops."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fieldlens.streaming import online as O


@pytest.fixture(autouse=True)
def rocksdb(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", O.ROCKSDB)


def stream_of(spark, folder, batches, schema):
    """One file for each list of rows, read one a batch in this order."""
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/in/{n:03d}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")


def test_failures_in_any_order_give_the_same(spark, tmp_path):
    r = random.Random(4)
    reasons = ["download failed", "upload rejected", "no download URL", None]
    rows = [(i, float(r.randint(-50, 50)), r.randint(1, 3), r.randint(1, 9), r.choice(["failed", "failed", "ok"]), r.choice(reasons)) for i in range(6) for _ in range(r.randint(1, 14))]
    want = {}
    for i in {x[0] for x in rows}:
        mine = [x for x in rows if x[0] == i]
        success = max((x[1:4] for x in mine if x[4] == "ok"), default=(-99.0, 0, 0))
        after = [x for x in mine if x[4] == "failed" and x[1:4] > success]
        last = max((x[1:4] for x in after), default=None)
        reason = max((x[5] or "" for x in after if x[1:4] == last), default="")
        want[i] = (len(after), 24 if len(after) >= 3 else 0 if not after else 1 if reason in ("download failed", "no download URL") else 6, len(mine))
    r.shuffle(rows)
    schema = "media_id long, attempted_at double, attempt long, tie long, outcome string, reason string"
    s = stream_of(spark, tmp_path, [rows[k::5] for k in range(5)], schema)
    got = O.drain(O.failure_stream(s), "append", "t", ["media_id"]).collect()
    assert {x.media_id: (x.fail_count, x.cooldown_h, x.attempts_seen) for x in got} == want
    assert {h for _, h, _ in want.values()} == {0, 1, 6, 24} or len({h for _, h, _ in want.values()}) >= 3
    assert sum(x.out_of_order for x in got) > 0


def gate(scans, absent, end):
    """(at, state) of one group's scans (at, n) in order."""
    out, now = [], None
    for at, n in scans:
        if now and at - now[0] > absent:
            out.append((now[0] + absent, "closed" if now[3] else "vanished"))
            now = None
        if now is None:
            state, now = "new", (at, n, at, False)
        elif now[3]:
            state, now = "done", (at, n, now[2], True)
        elif n != now[1]:
            state, now = "changed", (at, n, at, False)
        else:
            ready = at - now[2] >= 3600
            state, now = ("ready" if ready else "waiting"), (at, n, now[2], ready)
        out.append((at, state))
    if now[0] + absent <= end:
        out.append((now[0] + absent, "closed" if now[3] else "vanished"))
    return out


def test_groups_are_ready_once_and_leave_the_state(spark, tmp_path):
    r = random.Random(9)
    scans = defaultdict(dict)
    for g in range(8):
        t, n = r.randint(0, 3000), 1
        for _ in range(r.randint(2, 14)):
            t, n = t + r.choice([900, 1200, 1500, 1800, 9000 if g % 3 == 0 else 1200]), n + r.choice([0, 0, 0, 1])
            scans[g][float(t)] = n
    scans[99][60000.0] = 1  # a late group, whose scan closes all others
    rows = sorted(((g, at, n) for g, s in scans.items() for at, n in s.items()), key=lambda x: x[1])
    cuts = [rows[:20], rows[20:40], rows[40:-1], rows[-1:]]
    s = stream_of(spark, tmp_path, [c for c in cuts if c], "grp long, scan_at double, n_files long")
    got = O.drain(O.completeness_stream(s, absent_s=5000.0), "append", "t").collect()
    want = sorted((g, at, state) for g, s in scans.items() for at, state in gate(sorted(s.items()), 5000.0, 60000.0))
    assert sorted((x.grp, x.scan_at, x.state) for x in got) == want
    assert {"new", "changed", "waiting", "ready", "done", "closed", "vanished"} == {x[2] for x in want}


def test_slow_encoders_are_aborted_over_several_files(spark, tmp_path):
    rows = [("c", n, float(n), 2.0 if n < 18 or 42 <= n < 48 else 1.0) for n in range(1, 73)] + [("d", n, float(n), 3.0) for n in range(1, 40)]
    s = stream_of(spark, tmp_path, [[x for x in rows if x[1] <= 20], [x for x in rows if 20 < x[1] <= 50], [x for x in rows if x[1] > 50]], "clip_id string, seq long, t double, work double")
    got = sorted(tuple(x) for x in O.drain(O.encoder_stream(s, 1.6), "append", "t").collect())
    c = [x for x in got if x[0] == "c"]
    assert [x[1] for x in c] == list(range(12, 73, 6))
    # the windows up to ticks 18 and 48 hold five fast ticks, that up to 42 one
    assert [x[4] for x in c] == [0, 0, 1, 2, 3, 4, 0, 1, 2, 3, 4]
    assert [x[1] for x in c if x[5]] == [36, 42, 66, 72]
    assert all(not x[3] and x[2] == 3.0 for x in got if x[0] == "d")


def test_tracker_drifts_to_the_players_in_stream_and_batch(spark, tmp_path):
    seen = [("a", f, f, 10.0 + 0.1 * f, -10.0, 0.9, 30.0, 400.0) for f in range(30)]
    players = [("a", f, None, 60.0 + k, -5.0, None, None, None) for f in range(0, 260, 2) for k in (0, 4)]
    rows = sorted([*seen, *players], key=lambda x: x[1])
    schema = "clip_id string, frame int, det_id long, yaw double, pitch double, conf double, area double, px double"
    s = stream_of(spark, tmp_path, [[x for x in rows if lo <= x[1] < lo + 90] for lo in (0, 90, 180)], schema)
    live = sorted(tuple(x) for x in O.drain(O.track_stream(s), "append", "t").select("frame", "yaw", "pitch", "tracker_state", "loss_state").collect())
    batch = O.track_batch(spark.createDataFrame(rows, schema)).select("frame", "yaw", "pitch", "tracker_state", "loss_state")
    assert live == sorted(tuple(x) for x in batch.collect())
    assert [x[0] for x in live] == list(range(259))
    drift = [x for x in live if x[4].startswith("player_drift")]
    assert drift and drift[-1][1] > drift[0][1] + 5 and drift[-1][1] < 63
    assert [x[1] for x in drift] == sorted(x[1] for x in drift)


def test_small_keys_share_a_call(spark, tmp_path, monkeypatch):
    """A call into Python for every media item took hours on millions of them."""
    monkeypatch.setattr(O, "BUCKETS", 1)
    rows = [(i, float(i % 7), 1, 1, "failed", None) for i in range(50)]
    s = stream_of(spark, tmp_path, [rows[:30], rows[20:]], "media_id long, attempted_at double, attempt long, tie long, outcome string, reason string")
    plan = O.failure_stream(s)._jdf.queryExecution().analyzed().toString()
    assert "_bucket" in plan
    got = O.drain(O.failure_stream(s), "append", "t", ["media_id"]).collect()
    assert {x.media_id: x.fail_count for x in got} == {i: 2 if 20 <= i < 30 else 1 for i in range(50)}
