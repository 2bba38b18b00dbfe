"""Two-sided repair of loss windows, and backward propagation from an anchor."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldlens.config import BackwardConfig, RepairConfig
from fieldlens.functions import geo
from fieldlens.operators.candidates import anchor_gate
from fieldlens.operators.joins import point_in_interval
from fieldlens.session import cut


def _turn(a, b):
    return (a - b + 540.0) % 360.0 - 180.0


def _walk(by_frame, frames, seed, cfg: RepairConfig):
    """Follow the corridor from ``seed`` = (frame, yaw, pitch) over ``frames``: {frame: row}."""
    path, found = [seed], {}
    for f in frames:
        last = path[-1]
        gap = abs(f - last[0])
        py, pp = last[1], last[2]
        if len(path) > 1 and last[0] != path[-2][0]:
            back = path[-2]
            rate = (f - last[0]) / (last[0] - back[0])
            py, pp = py + _turn(last[1], back[1]) * rate, pp + (last[2] - back[2]) * rate
        y_max, p_max = cfg.max_yaw_step_deg * gap, cfg.max_pitch_step_deg * gap
        best = None
        for row in by_frame.get(f, ()):
            ey, ep = abs(_turn(row.yaw, py)), abs(row.pitch - pp)
            ry, rp = abs(_turn(row.yaw, last[1])), abs(row.pitch - last[2])
            if ry > y_max or ey > y_max or rp > p_max or ep > p_max:
                continue
            motion = 1.0 - 0.5 * (min(1.0, ey / y_max) + min(1.0, ep / p_max))
            trust = min(1.0, max(0.0, row.conf / max(cfg.anchor_confidence, 1e-9)))
            score = cfg.confidence_weight * trust + cfg.motion_weight * motion
            if best is None or score > best[0]:
                best = (score, row)
        if best is not None:
            found[f] = best[1]
            path.append((f, best[1].yaw, best[1].pitch))
    return found


TRACE = "frame int, f_det long, f_yaw double, f_pitch double, f_conf double, b_det long, b_yaw double, b_pitch double, b_conf double"


def _trace_windows(cfg: RepairConfig):
    """Trace every window of a group: short windows of one stretch of a clip, handled together
    so that the cost per call is shared."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        heads = pdf.drop_duplicates("window_id")
        by_window: dict[str, dict[int, list]] = {}
        hits = pdf[pdf["det_id"].notna()].sort_values(["frame", "det_id"])
        for row in hits[["window_id", "frame", "det_id", "yaw", "pitch", "conf"]].itertuples(index=False):
            by_window.setdefault(row.window_id, {}).setdefault(int(row.frame), []).append(row)
        out = []
        for h in heads.itertuples(index=False):
            span, found = range(int(h.start_frame), int(h.end_frame) + 1), by_window.get(h.window_id, {})
            fwd = _walk(found, span, (int(h.l_frame), h.l_yaw, h.l_pitch), cfg)
            bwd = _walk(found, reversed(span), (int(h.r_frame), h.r_yaw, h.r_pitch), cfg)
            for f in span:
                row = [h.clip_id, h.window_id, f]
                for side in (fwd.get(f), bwd.get(f)):
                    row += [None] * 4 if side is None else [int(side.det_id), side.yaw, side.pitch, side.conf]
                out.append(row)
        df = pd.DataFrame(out, columns=["clip_id", "window_id", *[c.split()[0] for c in TRACE.split(", ")]])
        return df.astype({"f_det": "Int64", "b_det": "Int64", "f_conf": float, "b_conf": float})

    return run


def _anchor(cand: DataFrame, windows: DataFrame, side: str, frame: str, yaw: str, pitch: str, cfg: RepairConfig) -> DataFrame:
    """Most confident anchor-quality candidate near the trusted point, per window."""
    w = windows.filter(F.col(frame).isNotNull()).select(
        "clip_id", "window_id", F.col(frame).alias("frame"), F.col(yaw).alias("ey"), F.col(pitch).alias("ep"))
    c = cand.filter("anchor_ok").select("clip_id", "frame", "det_id", "yaw", "pitch", "conf")
    near = F.col("ey").isNull() | F.col("ep").isNull() | geo.within(geo.angular_distance("yaw", "pitch", "ey", "ep"), cfg.anchor_match_deg)
    j = w.join(c, ["clip_id", "frame"]).filter(near)
    best = j.groupBy("clip_id", "window_id").agg(
        F.max_by(F.struct("frame", "det_id", "yaw", "pitch", "conf"), F.struct(F.col("conf"), -F.col("det_id"))).alias(side))
    if cfg.stable_frames > 1:
        best = _stable_only(best, c, side, cfg)
    return best


def _stable_only(best: DataFrame, cand: DataFrame, side: str, cfg: RepairConfig) -> DataFrame:
    """Keep anchors that continue for stable_frames more frames away from the window."""
    sign = -1 if side == "left" else 1
    cur = best.withColumn("at", F.col(side))
    for _ in range(1, cfg.stable_frames):
        step = cur.withColumn("frame", F.col("at.frame") + sign)
        c = cand.select("clip_id", "frame", F.struct("frame", "det_id", "yaw", "pitch", "conf").alias("n"))
        ok = (F.abs(geo.circular_delta(F.col("n.yaw"), F.col("at.yaw"))) <= cfg.max_yaw_step_deg) & (
            F.abs(F.col("n.pitch") - F.col("at.pitch")) <= cfg.max_pitch_step_deg)
        cur = step.join(c, ["clip_id", "frame"]).filter(ok).groupBy("clip_id", "window_id").agg(
            F.first(side).alias(side), F.max_by("n", F.struct(F.col("n.conf"), -F.col("n.det_id"))).alias("at"))
    return cur.select("clip_id", "window_id", side)


def repair_windows(windows: DataFrame, cand: DataFrame, cfg: RepairConfig = RepairConfig(), conf: str = "weighted_conf") -> dict[str, DataFrame]:
    """repairs (per frame), queue (per window), review (per queued frame), rejects.

    Only bridgeable windows of at most 29 frames with two anchors are traced; a group holds
    those of 1024 frames of a clip, so its size is bounded. Everything else is native.
    """
    rejects = windows.filter((F.col("end_frame") < F.col("start_frame")) | (F.col("duration_frames") != F.col("end_frame") - F.col("start_frame") + 1))
    ok = windows.filter(F.col("duration_frames") == F.col("end_frame") - F.col("start_frame") + 1)
    c = anchor_gate(cand, cfg, conf).withColumn("conf", geo.clamp(F.coalesce(F.col(conf), geo.lit(0.0)))).select(
        "clip_id", "frame", "det_id", "yaw", "pitch", "conf", "anchor_ok", "trace_ok")
    # anchors, traces and long-window samples all read the gated candidates
    c = cut(c)
    k = ["clip_id", "window_id"]
    short = ok.filter((F.col("status") == "bridgeable") & (F.col("duration_frames") <= cfg.max_resolvable_window_frames))
    left = _anchor(c, short, "left", "last_trusted_frame", "last_trusted_yaw", "last_trusted_pitch", cfg)
    right = _anchor(c, short, "right", "first_reacq_frame", "first_reacq_yaw", "first_reacq_pitch", cfg)
    a = ok.join(left, k, "left").join(right, k, "left")
    long = F.col("duration_frames") > cfg.max_resolvable_window_frames
    lost = F.array_compact(F.array(
        F.when(F.col("left").isNull(), "left_anchor_failed_quality_gate"), F.when(F.col("right").isNull(), "right_anchor_failed_quality_gate")))
    a = a.withColumn(
        "gate",
        F.when(F.col("status") != "bridgeable", "window_not_bridgeable").when(long, "long_window")
        .when(F.size(lost) > 0, F.array_join(lost, ";")),
    )
    a = cut(a)  # one row per window, read by every output below
    traceable = a.filter("gate is null").select(
        *k, "start_frame", "end_frame", *[F.col(f"{s}.{f}").alias(f"{s[0]}_{f}") for s in ("left", "right") for f in ("frame", "yaw", "pitch")])
    inside = point_in_interval(c.filter("trace_ok"), traceable.select(*k, F.col("start_frame").alias("_s"), F.col("end_frame").alias("_e")),
                               ["clip_id"], "frame", "_s", "_e").select(*k, "frame", "det_id", "yaw", "pitch", "conf")
    stretch = F.floor(F.col("start_frame") / 1024).alias("stretch")
    rows = traceable.select("*", stretch).join(inside, k, "left").repartition(
        int(cand.sparkSession.conf.get("spark.sql.shuffle.partitions")), "clip_id", "stretch")
    key_types = f"clip_id {windows.schema['clip_id'].dataType.simpleString()}, window_id string"
    t = cut(rows.groupBy("clip_id", "stretch").applyInPandas(_trace_windows(cfg), f"{key_types}, {TRACE}"))

    both = F.col("f_det").isNotNull() & F.col("b_det").isNotNull()
    t = t.withColumn("agreement_deg", geo.angular_distance("f_yaw", "f_pitch", "b_yaw", "b_pitch"))
    weak = F.least("f_conf", "b_conf") < cfg.borderline_confidence
    t = t.withColumn(
        "verdict",
        F.when(both & geo.within(F.col("agreement_deg"), cfg.agreement_deg) & ~weak, "repair")
        .when(both & weak, "borderline_support").when(both, "trace_disagreement")
        .when(F.col("f_det").isNotNull() | F.col("b_det").isNotNull(), "one_sided_trace"),
    )
    fwd_wins = F.col("f_conf") >= F.col("b_conf")
    pick = lambda c: F.when(fwd_wins, F.col(f"f_{c}")).otherwise(F.col(f"b_{c}"))
    agreed = t.filter("verdict = 'repair'").select(
        *k, "frame", F.lit("forward_backward_agreement").alias("reason"), "agreement_deg", pick("yaw").alias("yaw"), pick("pitch").alias("pitch"),
        F.least("f_conf", "b_conf").alias("weighted_conf"), F.lit("bidirectional").alias("source"))

    per = t.groupBy(*k).agg(
        F.count_if(F.col("verdict") == "repair").alias("n_repair"),
        F.count_if(F.col("verdict").isNotNull() & (F.col("verdict") != "repair")).alias("n_review"))
    s = a.join(per, k, "left")
    quiet = F.col("gate").isNull() & (F.col("n_review") == 0) & (F.col("n_repair") < F.col("duration_frames"))
    anchors_agree = geo.angular_distance("left.yaw", "left.pitch", "right.yaw", "right.pitch")
    s = s.withColumn("anchor_agreement", anchors_agree)
    bridged = quiet & geo.within(F.col("anchor_agreement"), cfg.agreement_deg)
    frac = (F.col("frame") - F.col("start_frame") + 1) / (F.col("duration_frames") + 1)
    # plain interpolation on yaw, as defined: it does not take the short way across the seam
    filled = s.filter(bridged).withColumn("frame", F.explode(F.sequence("start_frame", "end_frame"))).select(
        *k, "frame", F.lit("anchor_interpolation").alias("reason"), F.col("anchor_agreement").alias("agreement_deg"),
        (F.col("left.yaw") + frac * (F.col("right.yaw") - F.col("left.yaw"))).alias("yaw"),
        (F.col("left.pitch") + frac * (F.col("right.pitch") - F.col("left.pitch"))).alias("pitch"),
        F.least("left.conf", "right.conf").alias("weighted_conf"), F.lit("anchor_interpolation").alias("source"))
    repairs = agreed.unionByName(filled)

    done = F.col("gate").isNull() & (F.col("n_review") == 0) & (
        (F.col("n_repair") == F.col("duration_frames")) | (bridged & (F.col("n_repair") == 0)))
    queue = s.filter(~F.coalesce(done, F.lit(False))).select(
        *k, "start_frame", "end_frame", "duration_frames",
        F.coalesce(F.col("gate"), F.when(F.col("n_review") > 0, "unresolved_trace_frames").otherwise("no_corridor_supported_candidates")).alias("reason"),
        F.col("left.det_id").alias("left_det"), F.col("right.det_id").alias("right_det"))

    fb = F.when(F.col("b_det").isNull() | (F.col("f_conf") >= F.col("b_conf")), F.struct(F.col("f_det").alias("det_id"), F.col("f_conf").alias("conf"))).otherwise(
        F.struct(F.col("b_det").alias("det_id"), F.col("b_conf").alias("conf")))
    unresolved = t.filter("verdict is not null and verdict <> 'repair'").select(
        *k, "frame", F.col("verdict").alias("reason"), fb["det_id"].alias("det_id"), fb["conf"].alias("conf"))
    long_w = a.filter("gate = 'long_window'").select(*k, F.col("start_frame").alias("_s"), F.col("end_frame").alias("_e"))
    long_best = point_in_interval(c.filter("trace_ok"), long_w, ["clip_id"], "frame", "_s", "_e").groupBy(*k, "frame").agg(
        F.max_by(F.struct("det_id", "conf"), F.struct(F.col("conf"), -F.col("det_id"))).alias("b"))
    sampled = long_best.select(*k, "frame", F.lit("long_window").alias("reason"), "b.det_id", "b.conf")
    review = cap_review_frames(unresolved.unionByName(sampled), cfg.max_review_frames_per_window)
    return {"repairs": repairs, "queue": queue, "review": review, "rejects": rejects}


def cap_review_frames(items: DataFrame, maximum: int) -> DataFrame:
    """The ``maximum`` most confident frames of a window (earlier first on ties)."""
    order = W.partitionBy("clip_id", "window_id").orderBy(F.desc("conf"), "frame")
    return items.withColumn("_rk", F.row_number().over(order)).filter(F.col("_rk") <= maximum).drop("_rk")


def repair_summary(out: dict[str, DataFrame]) -> DataFrame:
    """Per clip: repaired frames, windows fully and partly resolved, queued windows."""
    k = ["clip_id", "window_id"]
    fixed = out["repairs"].groupBy(*k).agg(F.count(F.lit(1)).alias("n"))
    queued = out["queue"].select(*k, F.lit(1).alias("q"))
    j = fixed.join(queued, k, "full")
    return j.groupBy("clip_id").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("repair_frames"),
        F.count_if(F.col("n").isNotNull() & F.col("q").isNull()).alias("fully_resolved"),
        F.count_if(F.col("n").isNotNull() & F.col("q").isNotNull()).alias("partially_resolved"),
        F.count("q").alias("windows_queued"),
    )


# ---------------------------------------------------------------- backward propagation
def propagate_backward(anchors: DataFrame, cand: DataFrame, cfg: BackwardConfig = BackwardConfig(), conf: str = "weighted_conf") -> DataFrame:
    """Chronological path that leads to each anchor, over at most ``horizon_frames`` frames.

    anchors: clip_id, anchor_id, frame, yaw, pitch. The anchors of a stretch of frames share one group with the
    candidates that any of their horizons holds; a candidate is in as many groups as horizons reach over, two at most.
    """
    size = max(64, cfg.horizon_frames)
    block = lambda f: F.floor(f / F.lit(size))
    a = anchors.filter("frame is not null").select("clip_id", block(F.col("frame")).alias("_b"), "anchor_id", "frame", "yaw", "pitch")
    reached = F.sequence(block(F.col("frame") + 1), block(F.col("frame") + cfg.horizon_frames))
    c = cand.select("clip_id", F.explode(reached).alias("_b"), F.col("frame").alias("cf"), "det_id", F.col("yaw").alias("cy"), F.col("pitch").alias("cp"), F.col(conf).alias("conf"))
    parts = int(cand.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a, c = [df.repartition(parts, "clip_id", "_b").groupBy("clip_id", "_b") for df in (a, c)]
    schema = f"clip_id {anchors.schema['clip_id'].dataType.simpleString()}, anchor_id {anchors.schema['anchor_id'].dataType.simpleString()}, frame int, det_id long, yaw double, pitch double, score double"
    return a.cogroup(c).applyInPandas(_backward(cfg), schema)


def _backward(cfg):
    def path_to(h, frames):
        path, out, misses = [(h.yaw, h.pitch)], [], 0
        for f in range(int(h.frame) - 1, int(h.frame) - cfg.horizon_frames - 1, -1):
            y, p = path[-1]
            if len(path) > 1:
                y, p = 2 * path[-1][0] - path[-2][0], 2 * path[-1][1] - path[-2][1]
            best = None
            for det, cy, cp, conf in frames.get(f, ()):
                d = _arc(cy, cp, y, p)
                if d > cfg.max_jump_deg:
                    continue
                s = cfg.confidence_weight * conf + cfg.motion_weight * (1.0 - d / cfg.max_jump_deg)
                if best is None or s > best[0]:
                    best = (s, det, cy, cp)
            if best is None:
                misses += 1
                if misses > cfg.max_gap_frames:
                    break
                continue
            misses = 0
            path.append(best[2:])
            out.append((h.clip_id, h.anchor_id, f, int(best[1]), *best[2:], best[0]))
        return out[::-1]

    def run(pdf, near):
        frames = {}
        near = near[near["det_id"].notna()].sort_values("det_id", kind="stable")
        for f, *row in zip(near["cf"].tolist(), near["det_id"].tolist(), near["cy"].tolist(), near["cp"].tolist(), near["conf"].tolist()):
            frames.setdefault(f, []).append(row)
        out = [x for h in pdf.rename(columns={"_b": "block"}).itertuples(index=False) for x in path_to(h, frames)]
        return pd.DataFrame(out, columns=["clip_id", "anchor_id", "frame", "det_id", "yaw", "pitch", "score"])

    return run


def _arc(y1, p1, y2, p2):
    a, b = math.radians(p1), math.radians(p2)
    c = math.sin(a) * math.sin(b) + math.cos(a) * math.cos(b) * math.cos(math.radians(y1 - y2))
    return math.degrees(math.acos(max(-1.0, min(1.0, c))))
