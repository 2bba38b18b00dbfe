"""Frame-to-frame association: tracklet linker, held-still chains, player tracks.

All three share one frame: a run of blank frames that ends every open track cuts a clip
into independent segments (found natively); long segments are cut into blocks
(blockrun); fragments of one track in consecutive blocks are joined by components.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.config import CrowdConfig, LinkConfig
from fieldlens.operators.blockrun import run_blocks, steps
from fieldlens.operators.scan import Carry, carry_scan, frame_block, halo_windows, row_index
from fieldlens.operators.spatial import connected_components
from fieldlens.session import cut

OUT = "frame int, det_id long, ref string, slot int, score double, alternates array<struct<det_id:long,yaw:double,pitch:double,score:double>>"
COLUMNS = ["frame", "det_id", "ref", "slot", "score", "alternates"]


def _segments(cand: DataFrame, processed: DataFrame, blanks_that_end: int, block_frames: int) -> DataFrame:
    """Adds idx (position among processed frames), segment and block."""
    marked = processed.select("clip_id", "frame").join(
        cand.select("clip_id", "frame").distinct().withColumn("busy", F.lit(1)), ["clip_id", "frame"], "left")
    idx = row_index(marked, ["clip_id"], ["frame"], frame_block("frame", block_frames), "idx")
    recent = lambda w: {"recent": F.max("busy").over(w.rowsBetween(-blanks_that_end, -1))}
    lagged = halo_windows(idx, ["clip_id"], "idx", blanks_that_end, 0, recent).filter("busy = 1")
    lagged = lagged.withColumn("cutpoint", F.when(F.col("recent").isNull(), 1).otherwise(0))
    seg = carry_scan(lagged, ["clip_id"], ["frame"], frame_block("frame", block_frames), {"segment": Carry("sum", F.col("cutpoint"))})
    seg = seg.select("clip_id", "frame", "idx", "segment", F.floor(F.col("idx") / block_frames).alias("block"))
    return cut(cand.join(seg, ["clip_id", "frame"]))


def _join_fragments(raw: DataFrame) -> DataFrame:
    """Replace block-local refs by one id per track: 'segment:block:ref' of its birth."""
    key = ["clip_id", "segment"]
    node = lambda block, ref: F.concat(F.lpad(block.cast("string"), 12, "0"), F.lit(":"), ref)
    slots = raw.filter("slot is not null").select(*key, "block", "slot", "ref")
    nexts = raw.select(*key, "block").distinct()
    if nexts.groupBy(*key).count().filter("count > 1").isEmpty():
        named = raw.filter("slot is null").withColumn("track", node(F.col("block"), F.col("ref")))
    else:
        order = carry_scan(nexts, key, ["block"], F.floor(F.col("block") / 4096), {"nxt": Carry("first", F.col("block"), exclusive=True)})
        edges = slots.join(order.filter("nxt is not null"), [*key, "block"]).select(
            *key, node(F.col("block"), F.col("ref")).alias("a"),
            node(F.col("nxt"), F.concat(F.lit("i"), F.col("slot").cast("string"))).alias("b"),
        )
        comp = connected_components(edges, key)
        named = raw.filter("slot is null").withColumn("node", node(F.col("block"), F.col("ref")))
        named = named.join(comp, [*key, "node"], "left").withColumn("track", F.coalesce("comp", "node"))
    return named.withColumn("track", F.concat(F.lpad(F.col("segment").cast("string"), 9, "0"), F.lit(":"), F.col("track")))


def _number_tracks(named: DataFrame, payload: list[str]) -> DataFrame:
    """Running number per clip in order of birth (first frame, then detection id)."""
    born = named.groupBy("clip_id", "track").agg(F.min(F.struct("frame", "det_id")).alias("b")).select(
        "clip_id", "track", F.col("b.frame").alias("bf"), F.col("b.det_id").alias("bd")
    )
    numbered = row_index(born, ["clip_id"], ["bf", "bd"], frame_block("bf"), "track_no")
    return named.join(numbered.select("clip_id", "track", "track_no"), ["clip_id", "track"]).select(
        "clip_id", F.col("track_no").alias("tracklet_no"), *payload
    )


# ---------------------------------------------------------------- tracklet linker
def _unit(yaw, pitch):
    y, p = np.radians(yaw), np.radians(pitch)
    return np.stack([np.cos(p) * np.sin(y), np.sin(p), np.cos(p) * np.cos(y)], axis=-1)


def _angle(a, b):
    return np.degrees(np.arccos(np.minimum(np.maximum((a * b).sum(axis=-1), -1.0), 1.0)))


def _length(v):
    return np.sqrt((v * v).sum(axis=-1))


def _cross(a, b):
    ax, ay, az, bx, by, bz = a[:, 0], a[:, 1], a[:, 2], b[:, 0], b[:, 1], b[:, 2]
    return np.stack([ay * bz - az * by, az * bx - ax * bz, ax * by - ay * bx], axis=1)


def _predicted(pos, vel, has, delta, mode):
    """Positions after ``delta`` frames; vel is degrees per frame along a tangent."""
    speed = _length(vel)
    moving = has & (speed > 1e-9)
    if not moving.any():
        return pos
    d = vel / np.where(moving, speed, 1.0)[:, None]
    a = np.radians(speed * delta)[:, None]
    if mode == "great_circle":
        turned = pos * np.cos(a) + d * np.sin(a)
    else:
        along = (d * pos).sum(axis=1, keepdims=True)
        turned = pos * np.cos(a) + _cross(d, pos) * np.sin(a) + d * along * (1 - np.cos(a))
    n = _length(turned)[:, None]
    turned = turned / np.where(n > 1e-9, n, 1.0)
    return np.where((moving & (n[:, 0] > 1e-9))[:, None], turned, pos)


def _link_scores(cv, conf, pred, vel, has, delta, cfg):
    """(candidate x track) scores; -inf where the gate forbids the link."""
    gate = cfg.base_tolerance_deg + cfg.max_speed_deg_per_frame * delta
    miss = _angle(cv[:, None, :], pred[None, :, :])
    c = np.minimum(1.0, conf / 0.60)[:, None]
    prox = np.exp(-0.5 * (miss / (gate / 2.0)) ** 2)
    still = (cfg.w_conf * c + cfg.w_prox * prox) / (cfg.w_conf + cfg.w_prox)
    step = cv[:, None, :] - pred[None, :, :]
    step = step - (step * pred[None, :, :]).sum(axis=2, keepdims=True) * pred[None, :, :]
    ns, nv = _length(step), _length(vel)
    dot = (step * vel[None, :, :]).sum(axis=2)
    cos = np.where((ns > 1e-9) & (nv > 1e-9)[None, :], dot / np.where(ns * nv > 0, ns * nv, 1.0), 0.0)
    aligned = cfg.w_conf * c + cfg.w_prox * prox + cfg.w_vel * np.minimum(np.maximum(cos, 0.0), 1.0)
    score = np.where((has & (nv > 1e-9))[None, :], aligned, still)
    return np.where(miss > gate[None, :], -np.inf, score)


def _greedy(pairs_c, pairs_t):
    used_c, used_t, won = set(), set(), {}
    for c, t in zip(pairs_c, pairs_t):
        if c not in used_c and t not in used_t:
            used_c.add(c), used_t.add(t)
            won[t] = c
    return won


def _linker(cfg: LinkConfig):
    def run(pdf: pd.DataFrame, state: str | None):
        tracks, refs, last_idx, born, out = [], [], None, 0, []
        if state is not None:
            last_idx, tracks = json.loads(state)
            refs = [f"i{j}" for j in range(len(tracks))]
        # a track: x y z vx vy vz has_velocity last_frame missed
        tab = np.array(tracks, dtype=float).reshape(-1, 9)
        at = _unit(pdf["yaw"].to_numpy(), pdf["pitch"].to_numpy())
        for idx, (frames, ids, cv, yaw, pitch, conf) in steps(pdf, "idx", ["frame", "det_id", at, "yaw", "pitch", "weighted_conf"]):
            frame = int(frames[0])
            if last_idx is not None and len(tab):
                tab[:, 8] += idx - last_idx - 1
                alive = tab[:, 8] < cfg.max_link_gap
                tab, refs = tab[alive], [r for r, a in zip(refs, alive) if a]
            last_idx = int(idx)
            won, links = {}, []
            if len(tab):
                delta = frame - tab[:, 7]
                has = tab[:, 6] > 0
                pred = _predicted(tab[:, :3], tab[:, 3:6], has, delta, cfg.predict)
                score = _link_scores(cv, conf, pred, tab[:, 3:6], has, delta, cfg)
                ci, ti = np.nonzero(np.isfinite(score))
                best = np.lexsort((ti, ci, -score[ci, ti]))
                links, scores = list(zip(ci[best].tolist(), ti[best].tolist())), score.tolist()
                won = _greedy([c for c, _ in links], [t for _, t in links])
                near = {t: [] for t in won}
                for c, t in links:
                    if t in won and c != won[t] and scores[won[t]][t] - scores[c][t] <= cfg.alternate_margin:
                        near[t].append({"det_id": int(ids[c]), "yaw": float(yaw[c]), "pitch": float(pitch[c]), "score": scores[c][t]})
                for t, c in won.items():
                    out.append((frame, int(ids[c]), refs[t], None, scores[c][t], near[t]))
                tab[:, 8] += 1
                if won:
                    t, c = list(won), list(won.values())
                    p, v, gone = tab[t, :3], cv[c], delta[t]
                    diff = v - p
                    tang = diff - (diff * p).sum(axis=1, keepdims=True) * p
                    n = _length(tang)
                    speed = np.where(gone > 0, _angle(p, v) / np.where(gone > 0, gone, 1.0), 0.0)
                    tab[t, 3:6] = np.where(n >= 1e-9, speed / np.where(n > 0, n, 1.0), 0.0)[:, None] * tang
                    tab[t, :3], tab[t, 6], tab[t, 7], tab[t, 8] = v, 1.0, frame, 0.0
                alive = tab[:, 8] < cfg.max_link_gap
                tab, refs = tab[alive], [r for r, a in zip(refs, alive) if a]
            taken = set(won.values())
            fresh = [c for c in range(len(ids)) if c not in taken]
            for c in fresh:
                ref = f"n{born:09d}"
                born += 1
                refs.append(ref)
                out.append((frame, int(ids[c]), ref, None, None, []))
            if fresh:
                new = np.zeros((len(fresh), 9))
                new[:, :3], new[:, 7] = cv[fresh], frame
                tab = np.vstack([tab, new])
        after = json.dumps([last_idx, tab.tolist()])
        out += [(None, None, r, k, None, None) for k, r in enumerate(refs)]
        return _frame(out), after

    return run


def _frame(rows):
    df = pd.DataFrame(rows, columns=COLUMNS)
    df["frame"] = df["frame"].astype("Int32")
    df["det_id"] = df["det_id"].astype("Int64")
    df["slot"] = df["slot"].astype("Int32")
    df["score"] = df["score"].astype("float64")
    return df


def link_tracklets(cand: DataFrame, processed: DataFrame, cfg: LinkConfig = LinkConfig()) -> DataFrame:
    """cand: clip_id, frame, det_id, yaw, pitch, weighted_conf. processed: the frames examined.

    Returns one row per linked observation: tracklet_id, frame, det_id, yaw, pitch,
    weighted_conf, score (null for a seed), alternates.
    """
    support = cand.filter(F.col("weighted_conf") >= cfg.min_support_conf).select(
        "clip_id", "frame", "det_id", "yaw", "pitch", "weighted_conf")
    seg = _segments(support, processed, cfg.max_link_gap, cfg.block_frames)
    raw = run_blocks(seg, ["clip_id", "segment"], "block", ["idx", "det_id"], _linker(cfg), OUT)
    rows = _number_tracks(_join_fragments(raw), ["frame", "det_id", "score", "alternates"])
    return rows.join(support, ["clip_id", "frame", "det_id"]).select(
        "clip_id", F.format_string("T%04d", "tracklet_no").alias("tracklet_id"), "frame", "det_id", "yaw", "pitch",
        "weighted_conf", "score", "alternates",
    )


# ---------------------------------------------------------------- held-still chains
def _still_chains(frame_w: float, radius: float):
    def run(pdf, state):
        last_idx, pos = json.loads(state) if state is not None else (None, [])
        refs, born, out = [f"i{j}" for j in range(len(pos))], 0, []
        for idx, (frames, ids, x, y) in steps(pdf, "idx", ["frame", "det_id", "cx", "cy"]):
            if last_idx is not None and idx - last_idx > 1:
                pos, refs = [], []
            last_idx = int(idx)
            frame = int(frames[0])
            free = np.ones(len(ids), bool)
            keep_pos, keep_ref = [], []
            for (px, py), ref in zip(pos, refs):
                dx = np.abs(x - px)
                d = np.hypot(np.minimum(dx, frame_w - dx), y - py)
                d = np.where(free & (d <= radius), d, np.inf)
                k = int(np.argmin(d)) if len(d) else 0
                if len(d) and np.isfinite(d[k]):
                    free[k] = False
                    out.append((frame, int(ids[k]), ref, None, None, None))
                    keep_pos.append([float(x[k]), float(y[k])])
                    keep_ref.append(ref)
            for k in np.nonzero(free)[0]:
                ref = f"n{born:09d}"
                born += 1
                out.append((frame, int(ids[k]), ref, None, None, None))
                keep_pos.append([float(x[k]), float(y[k])])
                keep_ref.append(ref)
            pos, refs = keep_pos, keep_ref
        out += [(None, None, r, k, None, None) for k, r in enumerate(refs)]
        return _frame(out), json.dumps([last_idx, pos])

    return run


def held_still_flags(blobs: DataFrame, frame_w: float = 3840.0, radius: float = 5.0, min_frames: int = 15,
                     max_aspect: float = 2.5, block_frames: int = 4096) -> DataFrame:
    """blobs: clip_id, frame, det_id, x, y, w, h. Flags only; nothing is dropped.

    A frame number without blobs ends every chain, so each run of consecutive frames is a segment.
    """
    b = blobs.withColumn("cx", F.col("x") + F.col("w") / 2.0).withColumn("cy", F.col("y") + F.col("h") / 2.0)
    busy = b.select("clip_id", "frame").distinct()
    lagged = carry_scan(busy, ["clip_id"], ["frame"], frame_block("frame", block_frames),
                        {"prev": Carry("last", F.col("frame"), exclusive=True)})
    lagged = lagged.withColumn("cutpoint", F.coalesce((F.col("frame") - F.col("prev") > 1).cast("int"), F.lit(0)))
    seg = carry_scan(lagged, ["clip_id"], ["frame"], frame_block("frame", block_frames), {"segment": Carry("sum", F.col("cutpoint"))})
    seg = seg.select("clip_id", "frame", F.col("frame").alias("idx"), "segment", F.floor(F.col("frame") / block_frames).alias("block"))
    work = cut(b.join(seg, ["clip_id", "frame"]).select("clip_id", "segment", "block", "idx", "frame", "det_id", "cx", "cy"))
    raw = run_blocks(work, ["clip_id", "segment"], "block", ["idx", "det_id"], _still_chains(frame_w, radius), OUT)
    named = _join_fragments(raw)
    length = named.groupBy("clip_id", "track").agg(F.count(F.lit(1)).alias("chain_len"))
    flags = named.join(length, ["clip_id", "track"]).select("clip_id", "frame", "det_id", "chain_len")
    return (
        blobs.join(flags, ["clip_id", "frame", "det_id"], "left")
        .withColumn("static_suspect", F.coalesce(F.col("chain_len") >= min_frames, F.lit(False)))
        .withColumn("wide_flat_suspect", F.coalesce((F.col("h") > 0) & (F.col("w") / F.col("h") > max_aspect), F.lit(False)))
    )


# ---------------------------------------------------------------- player association
def _player_tracks(cfg: CrowdConfig):
    def run(pdf, state):
        last_idx, tab = json.loads(state) if state is not None else (None, [])
        refs, born, out = [f"i{j}" for j in range(len(tab))], 0, []
        # a track: yaw pitch box_h missed
        at = _unit(pdf["yaw"].to_numpy(), pdf["pitch"].to_numpy())
        for idx, (frames, ids, cv, yaw, pitch, box, conf) in steps(pdf, "idx", ["frame", "det_id", at, "yaw", "pitch", "box_h", "conf"]):
            if last_idx is not None:
                blank = int(idx) - last_idx - 1
                alive = [k for k, t in enumerate(tab) if t[3] + blank <= cfg.max_missed]
                tab, refs = [[*tab[k][:3], tab[k][3] + blank] for k in alive], [refs[k] for k in alive]
            last_idx = int(idx)
            frame = int(frames[0])
            won = {}
            if tab:
                t = np.array(tab)
                d = _angle(cv[:, None, :], _unit(t[:, 0], t[:, 1])[None, :, :])
                cost = d + 0.02 * np.abs(box[:, None] - t[None, :, 2]) - 0.1 * conf[:, None]
                ci, ti = np.nonzero(d <= cfg.motion_match_deg)
                best = np.lexsort((ti, ci, cost[ci, ti]))
                won = _greedy([int(ci[k]) for k in best], [int(ti[k]) for k in best])
                for k, c in won.items():
                    out.append((frame, int(ids[c]), refs[k], None, float(cost[c, k]), None))
                    tab[k] = [float(yaw[c]), float(pitch[c]), float(box[c]), 0]
                for k in range(len(tab)):
                    if k not in won:
                        tab[k][3] += 1
                alive = [k for k in range(len(tab)) if tab[k][3] <= cfg.max_missed]
                tab, refs = [tab[k] for k in alive], [refs[k] for k in alive]
            taken = set(won.values())
            for c in range(len(ids)):
                if c not in taken:
                    ref = f"n{born:09d}"
                    born += 1
                    refs.append(ref)
                    tab.append([float(yaw[c]), float(pitch[c]), float(box[c]), 0])
                    out.append((frame, int(ids[c]), ref, None, None, None))
        out += [(None, None, r, k, None, None) for k, r in enumerate(refs)]
        return _frame(out), json.dumps([last_idx, tab])

    return run


def track_players(players: DataFrame, samples: DataFrame, cfg: CrowdConfig = CrowdConfig(), block_frames: int = 4096) -> DataFrame:
    """players: clip_id, frame, det_id, yaw, pitch, box_h, conf. Adds a short-lived track number."""
    seg = _segments(players.select("clip_id", "frame", "det_id", "yaw", "pitch", "box_h", "conf"), samples, cfg.max_missed + 1, block_frames)
    raw = run_blocks(seg, ["clip_id", "segment"], "block", ["idx", "det_id"], _player_tracks(cfg), OUT)
    rows = _number_tracks(_join_fragments(raw), ["frame", "det_id"])
    return players.join(rows, ["clip_id", "frame", "det_id"]).withColumnRenamed("tracklet_no", "track_no")
