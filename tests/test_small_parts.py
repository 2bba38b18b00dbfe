"""Files of a clip and timers of a clip do not multiply with tasks and frames."""

import os

import pandas as pd

from fieldlens.plans.catalog import REGISTRY
from fieldlens.session import shared_dir
from fieldlens.streaming import online as O


def test_samples_of_a_clip_fill_one_file(spark, small_dir):
    base = shared_dir(spark).removeprefix("file://").removeprefix("file:")
    before = set(os.listdir(base))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled",)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        REGISTRY["sample_series_roundtrip"].run(spark, small_dir)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    (new,) = [d for d in set(os.listdir(base)) - before if d.startswith("samples-")]
    clips = [d for d in os.listdir(f"{base}/{new}") if d.startswith("clip_id=")]
    assert clips and all(len([f for f in os.listdir(f"{base}/{new}/{c}") if f.endswith(".json")]) == 1 for c in clips)


class Handle:
    """State of one key in plain Python."""

    def __init__(self):
        self.timers, self.registered, self.values = set(), 0, {}

    def getValueState(self, name, schema):
        return Cell(self.values, name)

    def getMapState(self, name, keys, values):
        return Cell(self.values.setdefault(name, {}), None)

    def registerTimer(self, at):
        self.registered += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class Cell:
    def __init__(self, at, name):
        self.at, self.name = at, name

    exists = lambda self: self.name in self.at
    get = lambda self: self.at[self.name]
    update = lambda self, v: self.at.update({self.name: v})
    containsKey = lambda self, k: k in self.at
    getValue = lambda self, k: self.at[k]
    updateValue = lambda self, k, v: self.at.update({k: v})
    removeKey = lambda self, k: self.at.pop(k)
    iterator = lambda self: iter(list(self.at.items()))


class Times:
    def __init__(self, ms):
        self.ms = ms

    getCurrentWatermarkInMs = getExpiryTimeInMs = lambda self: self.ms


def test_a_clip_has_one_timer_for_its_first_waiting_frame():
    handle, tracker = Handle(), O.OnlineTracker()
    tracker.init(handle)
    rows = pd.DataFrame([(f, f, 1.0 * f, 0.0, 0.9, 30.0, 400.0) for f in range(50)], columns=["frame", "det_id", "yaw", "pitch", "conf", "area", "px"])
    list(tracker.handleInputRows(("a",), iter([rows]), None))
    assert handle.timers == {999} and handle.registered == 1
    (out,) = tracker.handleExpiredTimer(("a",), Times(20_000), Times(999))
    assert out["frame"].tolist() == list(range(20))
    assert handle.registered == 2 and 20_999 in handle.timers
