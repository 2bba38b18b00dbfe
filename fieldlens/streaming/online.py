"""Structured Streaming forms of the gates, maps and the online tracker."""

from __future__ import annotations

import json
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fieldlens.functions import geo
from fieldlens.operators.blockrun import run_blocks
from fieldlens.session import shared_dir
from fieldlens.sources import views as V
from fieldlens.streaming import tracker as TK

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def event_stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/{table}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").option("maxFilesPerTrigger", 1).parquet(sf_dir)


def drain(df: DataFrame, mode: str, name: str, keys: list[str] | None = None) -> DataFrame:
    """Run a stream over what is there, through files in the shared folder, and read it back.

    With ``keys`` only the last emission per key counts (update mode). Every batch writes its
    own folder, so a repeated batch replaces itself.
    """
    spark = df.sparkSession
    base = f"{shared_dir(spark)}/stream-{name}-{uuid.uuid4().hex}"
    out_schema = df.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{base}/data/b={batch_id}")

    q = df.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/cp").trigger(availableNow=True).foreachBatch(write).start()
    q.awaitTermination()
    rows = spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in out_schema.fields)}, _batch long").parquet(f"{base}/data/*")
    if keys:
        rest = [c for c in rows.columns if c not in keys]
        rows = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("r")).select(*keys, "r.*")
    return rows.select(*df.columns)


def clip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = event_stream(spark, sf_dir, "events")
    t = V.seconds_since_epoch("ts")
    return e.select(
        F.concat(F.lit("clip"), F.expr(f"cast(user_id div {V.OBJECTS_PER_CLIP} as string)")).alias("clip_id"),
        F.floor(t / V.FRAME_S).cast("int").alias("frame"), F.timestamp_micros(((t + 1704067200.0) * 1e6).cast("long")).alias("at"),
        "event_id", "user_id", "event_type", "value")


# ---------------------------------------------------------------- windows
def live_hotspots(det: DataFrame, at: str, size: str, delay: str, bin_deg: float = 2.0, slide: str | None = None) -> DataFrame:
    """Duty counts per clip, window and bin. A window holds a bounded number of frames, so the
    exact set of frames fits the state; ``slide`` gives overlapping windows."""
    w = F.window(at, size, slide) if slide else F.window(at, size)
    return det.withWatermark(at, delay).groupBy(
        "clip_id", w.alias("w"), geo.yaw_bin("yaw", bin_deg).alias("yaw_bin"), geo.pitch_bin("pitch", bin_deg).alias("pitch_bin")
    ).agg(F.size(F.collect_set("frame")).alias("n_frames"), F.count(F.lit(1)).alias("n_detections"), F.avg("raw_conf").alias("mean_conf")).select(
        "clip_id", F.unix_timestamp("w.start").alias("window_start"), "yaw_bin", "pitch_bin", "n_frames", "n_detections", "mean_conf")


def detection_sessions(det: DataFrame, at: str, gap: str, delay: str) -> DataFrame:
    """Sessions of detections per clip; a loss is the silence between two sessions."""
    return det.withWatermark(at, delay).groupBy("clip_id", F.session_window(at, gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(
        "clip_id", F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "n")


def new_arrivals(items: DataFrame, at: str, key: str, delay: str, cutoff=None) -> DataFrame:
    """Arrivals after the cutoff, each id once."""
    d = items if cutoff is None else items.filter(F.col(at) > cutoff)
    return d.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


# ---------------------------------------------------------------- state per group
BUCKETS = 4096


def by_bucket(df: DataFrame, key: str):
    """Many small keys share the state of a bucket, which is read and written once a batch; a call into Python
    for every key would cost more than its rows. The number of buckets holds for the life of a checkpoint."""
    return df.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS))).groupBy("_bucket")


class CompletenessGate(StatefulProcessor):
    """File counts per group: new / changed / waiting, ``ready`` once when the count held still for ``hold_s``,
    ``done`` from then on. A group that no scan shows for ``absent_s`` leaves the state: reported as
    ``vanished`` where it never got ready, else as ``closed``; if it comes back, it is new.

    The state of a bucket: its groups (last scan, count, unchanged since, ready) and the time of its one timer,
    at which the first of them leaves."""

    hold_s = 3600.0

    def __init__(self, absent_s: float = 7200.0):
        self.absent_s = absent_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("s", "doc string")

    def handleInputRows(self, key, rows, timerValues):
        timer, groups = self._load()
        scans = pd.concat(list(rows)).groupby(["grp", "scan_at"], as_index=False)["n_files"].max()
        out = []
        for grp, at, n in zip(scans["grp"].tolist(), scans["scan_at"].astype(float).tolist(), scans["n_files"].astype(int).tolist()):
            now = groups.get(str(grp))
            if now and at <= now[0]:
                continue  # late
            if now and at - now[0] > self.absent_s:
                out.append(self._gone(grp, now))
                now = None
            if now is None:
                state, now = "new", (at, n, at, False)
            else:
                last, before, since, ready = now
                since = at if n != before else since
                held = n == before and at - since >= self.hold_s
                state = "done" if ready else "changed" if n != before else "ready" if held else "waiting"
                now = (at, n, since, ready or held)
            groups[str(grp)] = now
            out.append((grp, at, n, at - now[2], state))
        self._store(timer, groups)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        over = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        _, groups = self._load()
        gone = {g: now for g, now in groups.items() if self._leaves(now) <= over}
        self._store(None, {g: now for g, now in groups.items() if g not in gone})
        yield self._frame([self._gone(int(g), now) for g, now in gone.items()])

    def _load(self):
        return json.loads(self.state.get()[0]) if self.state.exists() else (None, {})

    def _store(self, timer, groups) -> None:
        first = min(map(self._leaves, groups.values()), default=None)
        if timer is not None and first != timer:
            self.handle.deleteTimer(timer)
        if first is None:
            self.state.clear()
            return
        if first != timer:
            self.handle.registerTimer(first)
        self.state.update((json.dumps([first, groups]),))

    def _leaves(self, now) -> int:
        return round((now[0] + self.absent_s) * 1000)

    def _gone(self, grp, now):
        last, n, since, ready = now
        at = last + self.absent_s
        return (grp, at, n, at - since, "closed" if ready else "vanished")

    def _frame(self, rows):
        df = pd.DataFrame(rows, columns=["grp", "scan_at", "n_files", "stable_s", "state"])
        return df.astype({"grp": "int64", "scan_at": "float64", "n_files": "int64", "stable_s": "float64"})

    def close(self) -> None:
        pass


def completeness_stream(scans: DataFrame, delay: str = "0 seconds", absent_s: float = 7200.0) -> DataFrame:
    """scans: grp, scan_at, n_files."""
    s = scans.withColumn("at", F.timestamp_micros((F.col("scan_at") * 1e6).cast("long"))).withWatermark("at", delay)
    return by_bucket(s, "grp").transformWithStateInPandas(
        CompletenessGate(absent_s), "grp long, scan_at double, n_files long, stable_s double, state string", "Append", "eventTime")


class FailureCounter(StatefulProcessor):
    """Failures of a media item since its last success, whatever order the attempts come in.

    The state is the latest success and the failures after it, for all items of a bucket. A later success drops
    those before it, an earlier one changes nothing, so files in any order give what all rows at once give, and no
    watermark has to wait for late ones. Attempts that came after a later one are counted."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("s", "doc string")

    def handleInputRows(self, key, rows, timerValues):
        items = json.loads(self.state.get()[0]) if self.state.exists() else {}
        pdf, mine, out = pd.concat(list(rows)), {}, []
        columns = [pdf[c].tolist() for c in ("media_id", "attempted_at", "attempt", "tie", "outcome", "reason")]
        for item, t, attempt, tie, outcome, reason in zip(*columns):
            mine.setdefault(item, []).append(([round(t * 1e6), attempt, tie], outcome == "failed", reason or ""))
        for item, attempts in mine.items():
            # places in time are lists, the empty one comes before all
            seen, late, newest, success, held = items.get(str(item), (0, 0, [], [], []))
            late += sum(at < newest for at, _, _ in attempts)
            seen, newest = seen + len(attempts), max([newest, *[at for at, _, _ in attempts]])
            success = max([success, *[at for at, failed, _ in attempts if not failed]])
            failures = {tuple(at): (n, reason) for at, n, reason in held if at > success}
            for at, failed, reason in attempts:
                if failed and at > success:
                    n, other = failures.get(tuple(at), (0, ""))
                    failures[tuple(at)] = (n + 1, max(other, reason))
            held = [(at, *failures[at]) for at in sorted(failures)]
            fails = sum(n for _, n, _ in held)
            hours = 0 if not held else 24 if fails >= 3 else 1 if held[-1][2] in ("no download URL", "download failed") else 6
            items[str(item)] = (seen, late, newest, success, held)
            out.append((item, fails, hours, seen, late))
        self.state.update((json.dumps(items),))
        yield pd.DataFrame(out, columns=["media_id", "fail_count", "cooldown_h", "attempts_seen", "out_of_order"])

    def close(self) -> None:
        pass


def failure_stream(attempts: DataFrame) -> DataFrame:
    """attempts: media_id, attempted_at (seconds), attempt, tie, outcome, reason. A row per item and batch that names it."""
    return by_bucket(attempts, "media_id").transformWithStateInPandas(
        FailureCounter(), "media_id long, fail_count long, cooldown_h int, attempts_seen long, out_of_order long", "Append", "None")


class EncoderMonitor(StatefulProcessor):
    """Speed of an encoder over windows of ticks, with the last windows in the state. After ``strikes`` slow
    ones in a row the run is to be aborted; the windows go on, for those who only watch."""

    def __init__(self, floor: float, warmup: int, every: int, strikes: int):
        self.floor, self.warmup, self.every, self.strikes = floor, warmup, every, strikes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.at = handle.getValueState("a", "tick long, work double, t double, done double, streak long")
        self.ring = handle.getListState("r", "speed double")

    def handleInputRows(self, key, rows, timerValues):
        pdf = pd.concat(list(rows)).sort_values("seq", kind="stable")
        tick, work, t0, done, streak = self.at.get() if self.at.exists() else (0, 0.0, 0.0, 0.0, 0)
        ring = [r[0] for r in self.ring.get()] if self.ring.exists() else []
        out = []
        for t, k in zip(pdf["t"].astype(float), pdf["work"].astype(float)):
            tick, work = tick + 1, work + (0.0 if pd.isna(k) else k)
            if tick < self.warmup or tick % self.every:
                continue
            speed = (work - done) / (t - t0) if t > t0 else 0.0
            t0, done, ring = t, work, [*ring, speed][-self.strikes :]
            streak = streak + 1 if speed < self.floor else 0
            out.append((key[0], tick, speed, speed < self.floor, streak, len(ring) == self.strikes and max(ring) < self.floor))
        self.at.update((tick, work, t0, done, streak))
        self.ring.put([(x,) for x in ring])
        df = pd.DataFrame(out, columns=["clip_id", "tick", "speed", "slow", "slow_streak", "abort"])
        yield df.astype({"clip_id": object, "tick": "int32", "speed": float, "slow": bool, "slow_streak": "int64", "abort": bool})

    def close(self) -> None:
        pass


def encoder_stream(ticks: DataFrame, floor: float, warmup: int = 12, every: int = 6, strikes: int = 3) -> DataFrame:
    """ticks: clip_id, seq, t, work (done in this tick), in the order of seq over the files."""
    return ticks.groupBy("clip_id").transformWithStateInPandas(
        EncoderMonitor(floor, warmup, every, strikes), "clip_id string, tick int, speed double, slow boolean, slow_streak long, abort boolean", "Append", "None")


# ---------------------------------------------------------------- online tracker
TRACK_OUT = "frame int, yaw double, pitch double, best_score double, tracker_state string, loss_state string"


def _records(g: pd.DataFrame) -> list[dict]:
    """Rows as records; those without det_id are positions of players."""
    rows = g[["det_id", "yaw", "pitch", "conf", "area", "px"]].to_dict("records")
    return [{**r, "det_id": int(r["det_id"])} if pd.notna(r["det_id"]) else {"det_id": None, "yaw": r["yaw"], "pitch": r["pitch"]} for r in rows]


def _crowd(rows):
    """The middle of a frame's players, to which the camera drifts when the object has long been lost."""
    at = sorted((r["yaw"], r["pitch"]) for r in rows if r["det_id"] is None)
    return [sum(x) / len(at) for x in zip(*at)] if at else None


def _advance(state, by_frame, upto):
    """Frames from the next expected one up to ``upto``; a frame without rows still ticks."""
    out = []
    if not by_frame and state["frame"] is None:
        return out
    first = state["frame"] + 1 if state["frame"] is not None else min(by_frame)
    for f in range(first, upto + 1):
        rows = by_frame.get(f, [])
        out.append(TK.step(state, f, sorted((r for r in rows if r["det_id"] is not None), key=lambda r: r["det_id"]), _crowd(rows)))
    return out


class OnlineTracker(StatefulProcessor):
    """Buffers detections until the watermark has passed their frame, then steps in order.
    Rows of frames already stepped are late: dropped and counted in the state."""

    frame_ms = 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.track = handle.getValueState("t", "doc string")
        self.pending = handle.getMapState("p", "frame int", "rows string")
        self.late = handle.getValueState("l", "n long")

    def handleInputRows(self, key, rows, timerValues):
        state, timer = json.loads(self.track.get()[0]) if self.track.exists() else (TK.fresh_state(), None)
        late = self.late.get()[0] if self.late.exists() else 0
        first = timer
        for f, g in pd.concat(list(rows)).groupby("frame"):
            if state["frame"] is not None and f <= state["frame"]:
                late += len(g)
                continue
            k = (int(f),)
            old = json.loads(self.pending.getValue(k)[0]) if self.pending.containsKey(k) else []
            self.pending.updateValue(k, (json.dumps(old + _records(g)),))
            first = self._over(f) if first is None else min(first, self._over(f))
        self.late.update((late,))
        self._store(state, first, timer)
        yield self._frame(key, [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        over = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        state, timer = json.loads(self.track.get()[0])
        waiting = {k[0]: v[0] for k, v in self.pending.iterator()}
        due = {f: json.loads(doc) for f, doc in waiting.items() if self._over(f) <= over}
        for f in due:
            self.pending.removeKey((f,))
        out = _advance(state, due, max(due)) if due else []
        self._store(state, min((self._over(f) for f in waiting if f not in due), default=None), None)
        yield self._frame(key, out)

    def _over(self, frame) -> int:
        """The first moment at which rows of the frame are late, so that the last frame of a clip needs no later one."""
        return (int(frame) + 1) * self.frame_ms - 1

    def _store(self, state, first, timer) -> None:
        """One timer a clip, for its first waiting frame: all frames that are over by then step in one call."""
        if first is not None and first != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(first)
        self.track.update((json.dumps([state, first]),))

    def _frame(self, key, recs):
        cols = ["frame", "yaw", "pitch", "best_score", "tracker_state", "loss_state"]
        df = pd.DataFrame(recs, columns=cols)
        df.insert(0, "clip_id", key[0])
        return df.astype({"frame": "int32", "yaw": float, "pitch": float, "best_score": "Float64", "clip_id": object})

    def close(self) -> None:
        pass


def track_stream(det: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """det: clip_id, frame, det_id (null: a player), yaw, pitch, conf, area, px. One second of event time per
    frame, starting at second one: a row at the initial watermark (zero) would count as late."""
    d = det.withColumn("at", F.timestamp_seconds(F.col("frame") + 1)).withWatermark("at", delay)
    return d.groupBy("clip_id").transformWithStateInPandas(OnlineTracker(), f"clip_id string, {TRACK_OUT}", "Append", "eventTime")


def track_batch(det: DataFrame, block_frames: int = 65536) -> DataFrame:
    """The same steps over stored rows; long clips run in blocks."""
    rows = det.withColumn("_block", F.floor(F.col("frame") / block_frames))

    def run(pdf, text):
        state = json.loads(text) if text is not None else TK.fresh_state()
        by = {}
        for f, r in zip(pdf["frame"].tolist(), _records(pdf)):
            by.setdefault(int(f), []).append(r)
        out = pd.DataFrame(_advance(state, by, int(pdf["frame"].max())), columns=["frame", "yaw", "pitch", "best_score", "tracker_state", "loss_state"])
        return out.astype({"frame": "int32", "yaw": float, "pitch": float, "best_score": "Float64"}), json.dumps(state)

    return run_blocks(rows, ["clip_id"], "_block", ["frame", "det_id"], run, TRACK_OUT).drop("_block")
