"""Crowd signals: clusters, flow, motion, action zone, fused target, warm-up chains."""

from __future__ import annotations

import json
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.config import ActionZoneConfig, CrowdConfig, FusionConfig
from fieldlens.functions import geo
from fieldlens.operators import spatial
from fieldlens.operators.blockrun import run_blocks, steps
from fieldlens.operators.scan import Carry, carry_scan, frame_block, halo_windows, row_index
from fieldlens.operators.windows import run_lengths
from fieldlens.session import cut, shuffled

SAMPLE = ["clip_id", "sample"]
TRACK = ["clip_id", "track_id"]


# ---------------------------------------------------------------- clusters
def crowd_clusters(players: DataFrame, cfg: CrowdConfig = CrowdConfig(), id_col: str = "det_id") -> DataFrame:
    """Density groups per sample. Two members suffice by default, so a group is a connected
    component of size >= 2; larger min_players adds the core / border rule."""
    if cfg.min_players <= 2:
        comp = spatial.spatial_components(players, SAMPLE, id_col, cfg.cluster_radius_deg)
        size = comp.groupBy(*SAMPLE, "comp").agg(F.count(F.lit(1)).alias("size"))
        return comp.join(shuffled(size.filter(F.col("size") >= cfg.min_players)), [*SAMPLE, "comp"])
    pairs = spatial.within_pairs(players, SAMPLE, id_col, cfg.cluster_radius_deg)
    both = pairs.select(*SAMPLE, "a", "b").unionByName(pairs.select(*SAMPLE, F.col("b").alias("a"), F.col("a").alias("b")))
    core = both.groupBy(*SAMPLE, "a").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") + 1 >= cfg.min_players).select(*SAMPLE, F.col("a").alias("core"))
    core = cut(core)
    link = both.join(core.withColumnRenamed("core", "a"), [*SAMPLE, "a"])
    core_edges = link.join(core.withColumnRenamed("core", "b"), [*SAMPLE, "b"])
    comp = spatial.connected_components(core_edges, SAMPLE).withColumnRenamed("node", "core")
    labelled = core.join(comp, [*SAMPLE, "core"], "left").withColumn("comp", F.coalesce("comp", "core"))
    border = link.join(labelled.withColumnRenamed("core", "a"), [*SAMPLE, "a"]).join(
        core.withColumnRenamed("core", "b"), [*SAMPLE, "b"], "left_anti").groupBy(*SAMPLE, F.col("b").alias(id_col)).agg(F.min("comp").alias("comp"))
    out = labelled.withColumnRenamed("core", id_col).unionByName(border)
    size = out.groupBy(*SAMPLE, "comp").agg(F.count(F.lit(1)).alias("size"))
    return out.join(size, [*SAMPLE, "comp"])


def top_cluster(players: DataFrame, clusters: DataFrame, id_col: str = "det_id") -> DataFrame:
    """Members of the biggest cluster of each sample; ties by mean confidence, then label."""
    m = players.join(shuffled(clusters), [*SAMPLE, id_col])
    s = m.groupBy(*SAMPLE, "comp").agg(F.count(F.lit(1)).alias("n"), F.avg("conf").alias("mc"))
    best = s.groupBy(*SAMPLE).agg(F.max_by("comp", F.struct(F.col("n"), geo.r4("mc", 9), -F.col("comp"))).alias("comp"))
    return m.join(shuffled(best), [*SAMPLE, "comp"])


def centroid_and_dispersion(members: DataFrame) -> DataFrame:
    """Circular mean yaw, mean pitch, size and mean distance from that centre, per sample."""
    c = members.groupBy(*SAMPLE).agg(
        geo.circular_mean("yaw").alias("centroid_yaw"), F.avg("pitch").alias("centroid_pitch"), F.count(F.lit(1)).alias("cluster_size"),
        F.avg("vel").alias("mean_vel"))
    d = members.join(shuffled(c.select(*SAMPLE, "centroid_yaw", "centroid_pitch")), SAMPLE).groupBy(*SAMPLE).agg(
        F.avg(geo.angular_distance("yaw", "pitch", "centroid_yaw", "centroid_pitch")).alias("dispersion_deg"))
    return c.join(shuffled(d), SAMPLE)


def activity_centroid(members: DataFrame, cfg: CrowdConfig = CrowdConfig()) -> DataFrame:
    """Centroid weighted by 1 + velocity; the plain one when the cluster barely moves."""
    w = geo.lit(1.0) + F.col("vel")
    a = members.groupBy(*SAMPLE).agg(
        F.avg("vel").alias("mean_vel"), geo.circular_mean("yaw").alias("py"), F.avg("pitch").alias("pp"),
        geo.circular_mean("yaw", w).alias("wy"), (F.sum(w * F.col("pitch")) / F.sum(w)).alias("wp"))
    low = F.col("mean_vel") < cfg.low_motion_deg_s
    return a.select(*SAMPLE, "mean_vel", F.when(low, F.col("py")).otherwise(F.col("wy")).alias("activity_yaw"),
                    F.when(low, F.col("pp")).otherwise(F.col("wp")).alias("activity_pitch"))


def stable_group(players: DataFrame, members: DataFrame, cfg: CrowdConfig = CrowdConfig(), id_col: str = "det_id") -> DataFrame:
    """Mean direction of top-cluster tracks with enough uninterrupted history, and the clamped blend.

    A track's life restarts when it is missing for more than max_missed samples.
    """
    p = carry_scan(players, TRACK, ["sample"], frame_block("sample"), {"prev_sample": Carry("last", F.col("sample"), exclusive=True)})
    born = F.when(F.col("prev_sample").isNull() | (F.col("sample") - F.col("prev_sample") > cfg.max_missed + 1), F.col("ts"))
    p = carry_scan(p.withColumn("born", born), TRACK, ["sample"], frame_block("sample"), {"since": Carry("last", F.col("born"))})
    age = p.select(*SAMPLE, id_col, (F.col("ts") - F.col("since")).alias("age"))
    old = members.join(age, [*SAMPLE, id_col]).filter(F.col("age") >= cfg.stable_coverage_s)
    g = old.groupBy(*SAMPLE).agg(geo.circular_mean("yaw").alias("gy"), F.avg("pitch").alias("gp"), F.count(F.lit(1)).alias("n"))
    base = members.groupBy(*SAMPLE).agg(geo.circular_mean("yaw").alias("masked_yaw"))
    j = base.join(g.filter(F.col("n") >= cfg.stable_min_tracks), SAMPLE, "left")
    pull = geo.clamp(geo.circular_delta("gy", "masked_yaw") * cfg.blend_weight, -cfg.blend_clamp_deg, cfg.blend_clamp_deg)
    return j.select(*SAMPLE, F.col("gy").alias("stable_yaw"), F.col("gp").alias("stable_pitch"), F.coalesce("n", F.lit(0)).alias("stable_tracks"),
                    geo.wrap_yaw(F.col("masked_yaw") + F.coalesce(pull, geo.lit(0.0))).alias("proposed_yaw"))


def yaw_gap_clusters(players: DataFrame, gap_deg: float) -> DataFrame:
    """Groups split where sorted yaw jumps by more than ``gap_deg`` (not seam aware, as defined).

    Sorted by (yaw, track) within a sample; blocks of yaw keep even a crowded sample spread out.
    """
    block = F.floor(F.col("yaw") / 30.0)
    s = carry_scan(players, SAMPLE, ["yaw", "track_id"], block, {"_py": Carry("last", F.col("yaw"), exclusive=True)})
    s = s.withColumn("_new", F.coalesce((F.col("yaw") - F.col("_py") > gap_deg).cast("int"), F.lit(0)))
    return carry_scan(s, SAMPLE, ["yaw", "track_id"], block, {"group_no": Carry("sum", F.col("_new"))}).drop("_py", "_new")


# ---------------------------------------------------------------- motion
def previous_sample_step(players: DataFrame) -> DataFrame:
    """Position of the same track in exactly the previous sample (null when it was absent)."""
    prev = F.struct(F.col("sample").alias("s"), F.col("yaw").alias("yaw"), F.col("pitch").alias("pitch"), F.col("ts").alias("ts"))
    p = carry_scan(players, TRACK, ["sample"], frame_block("sample"), {"_p": Carry("last", prev, exclusive=True)})
    ok = F.col("_p.s") == F.col("sample") - 1
    return p.select(*players.columns, *[F.when(ok, F.col(f"_p.{c}")).alias(f"prev_{c}") for c in ("yaw", "pitch", "ts")])


def nearest_match_velocity(players: DataFrame, dt: float, cfg: CrowdConfig = CrowdConfig()) -> DataFrame:
    """Velocity from the greedy closest-pair match with the previous sample; 0 when unmatched.

    Pairs of a sample are few (a radius of 15 degrees), so the greedy pick folds over them.
    """
    cur = players.select(*SAMPLE, "det_id", "yaw", "pitch")
    edge = spatial.chord(cfg.motion_match_deg) * (1 + 1e-9)
    a = spatial.with_cell(cur, edge)
    b = spatial.with_cell(cur.select("clip_id", (F.col("sample") + 1).alias("sample"), F.col("det_id").alias("pid"), F.col("yaw").alias("qy"), F.col("pitch").alias("qp")), edge, "qy", "qp")
    d = geo.angular_distance("yaw", "pitch", "qy", "qp")
    pairs = spatial.near_join(a, b, SAMPLE).withColumn("d", d).filter(geo.within(F.col("d"), cfg.motion_match_deg))
    item = F.struct(geo.r4("d", 4).alias("k"), F.col("det_id").alias("c"), F.col("pid").alias("p"), F.col("d").alias("d"))
    packed = pairs.groupBy(*SAMPLE).agg(F.array_sort(F.collect_list(item)).alias("xs"))
    free = lambda kept, x: ~F.exists(kept, lambda k: (k["c"] == x["c"]) | (k["p"] == x["p"]))
    won = packed.select(*SAMPLE, F.explode(F.aggregate("xs", F.slice("xs", 1, 0), lambda kept, x: F.when(free(kept, x), F.concat(kept, F.array(x))).otherwise(kept))).alias("m"))
    won = won.select(*SAMPLE, F.col("m.c").alias("det_id"), (F.col("m.d") / dt).alias("v"))
    return players.join(shuffled(won), [*SAMPLE, "det_id"], "left").withColumn("match_vel", F.coalesce("v", geo.lit(0.0))).drop("v")


def flow_direction(players: DataFrame, samples: DataFrame, cfg: CrowdConfig = CrowdConfig()) -> DataFrame:
    """Majority direction of the moving tracks per sample, its mean yaw step and sustained run."""
    p = previous_sample_step(players).withColumn("dy", geo.circular_delta("yaw", "prev_yaw"))
    moving = p.filter(F.col("dy").isNotNull() & (F.abs("vel") >= cfg.min_moving_vel))
    g = moving.groupBy(*SAMPLE).agg(
        F.count_if(F.col("dy") < 0).alias("l"), F.count_if(F.col("dy") > 0).alias("r"),
        F.avg(F.when(F.col("dy") < 0, F.col("dy"))).alias("ml"), F.avg(F.when(F.col("dy") > 0, F.col("dy"))).alias("mr"))
    j = samples.select(*SAMPLE).join(g, SAMPLE, "left").na.fill(0, ["l", "r"])
    k = cfg.min_agreeing_tracks
    direction = F.when((F.col("l") >= k) & (F.col("l") > F.col("r")), -1).when((F.col("r") >= k) & (F.col("r") > F.col("l")), 1).otherwise(0)
    j = j.withColumn("direction", direction).withColumn("moving_tracks", F.col("l") + F.col("r"))
    j = j.withColumn("agreeing_tracks", F.when(F.col("direction") < 0, F.col("l")).when(F.col("direction") > 0, F.col("r")).otherwise(F.lit(0)))
    j = j.withColumn("mean_delta_yaw", F.when(F.col("direction") < 0, F.col("ml")).when(F.col("direction") > 0, F.col("mr")).otherwise(geo.lit(0.0)))
    j = run_lengths(j, ["clip_id"], ["sample"], frame_block("sample"), "direction", "sustained_run_len")
    return j.withColumn("sustained", (F.col("sustained_run_len") >= cfg.min_sustain_samples).cast("int")).select(
        *SAMPLE, "direction", "agreeing_tracks", "moving_tracks", "mean_delta_yaw", "sustained", "sustained_run_len")


def convergence_scores(members: DataFrame, centre: DataFrame, totals: DataFrame, cfg: CrowdConfig = CrowdConfig()) -> DataFrame:
    """Motion score, share of moving players heading for the cluster centre, blended confidence.

    members: SAMPLE, yaw, pitch, conf, vel_yaw, vel_pitch. centre: SAMPLE, centroid_yaw, centroid_pitch.
    """
    m = members.join(centre.select(*SAMPLE, "centroid_yaw", "centroid_pitch"), SAMPLE)
    mag = F.hypot("vel_yaw", "vel_pitch")
    cx = F.cos(F.radians("centroid_pitch")) * F.sin(F.radians(F.col("centroid_yaw") - F.col("yaw")))
    cy = F.sin(F.radians(F.col("centroid_pitch") - F.col("pitch")))
    m = m.withColumn("mag", mag).withColumn("cx", cx).withColumn("cy", cy).withColumn("cn", F.hypot("cx", "cy"))
    moving = F.col("mag") >= cfg.vel_min_deg_per_frame
    dot = (F.col("vel_yaw") * F.col("cx") + F.col("vel_pitch") * F.col("cy")) / (F.col("mag") * F.col("cn"))
    g = m.groupBy(*SAMPLE).agg(
        F.least(geo.lit(1.0), F.avg("mag") / 3.0).alias("motion_score"), F.count_if(moving).alias("mv"),
        F.count_if(moving & (F.col("cn") >= 1e-6) & (dot >= cfg.convergence_dot)).alias("cv"),
        F.count(F.lit(1)).alias("size"), F.avg("conf").alias("mc"))
    conv = F.when(F.col("mv") > 0, F.col("cv") / F.col("mv")).otherwise(geo.lit(0.0))
    g = g.withColumn("convergence_score", conv).join(totals, SAMPLE)
    ratio = F.least(geo.lit(1.0), F.col("size") / F.greatest(F.lit(1), F.col("total")))
    blend = ratio * 0.40 + F.col("mc") * 0.40 + (F.col("motion_score") * 0.60 + F.col("convergence_score") * 0.40) * 0.20
    return g.select(*SAMPLE, "motion_score", "convergence_score", blend.alias("frame_confidence"))


def concentration(size, total, dispersion, scale: float = 40.0) -> Column:
    n, t, d = geo.col(size), geo.col(total), geo.col(dispersion)
    tight = F.coalesce(F.exp(-d / geo.lit(scale)), geo.lit(0.0))
    return F.when((t > 0) & (n > 0), geo.clamp(n / t * tight)).otherwise(geo.lit(0.0))


# ---------------------------------------------------------------- action zone
def _rolling_mean(players: DataFrame, value: str, rows: int, name: str) -> DataFrame:
    """Mean over the last ``rows`` appearances of a track."""
    p = row_index(players, TRACK, ["sample"], frame_block("sample"), "_rn")
    return halo_windows(p, TRACK, "_rn", rows - 1, 0, lambda w: {name: F.avg(value).over(w.rowsBetween(-(rows - 1), 0))}).drop("_rn")


def zone_players(players: DataFrame, cfg: ActionZoneConfig = ActionZoneConfig()) -> DataFrame:
    """Per player: direction of motion, static score, speed norm, yaw-gap group."""
    p = previous_sample_step(players)
    dt = F.greatest(F.col("ts") - F.col("prev_ts"), geo.lit(1e-3))
    p = p.withColumn("heading", F.atan2((F.col("pitch") - F.col("prev_pitch")) / dt, (F.col("yaw") - F.col("prev_yaw")) / dt)).drop("prev_yaw", "prev_pitch", "prev_ts")
    p = _rolling_mean(p, "vel", cfg.history, "roll")
    p = p.withColumn("static_score", geo.clamp(geo.lit(1.0) - F.col("roll") / cfg.static_speed_cap)).drop("roll")
    p = p.withColumn("speed_norm", F.least(F.col("vel") / cfg.speed_norm_cap, geo.lit(1.0)))
    return yaw_gap_clusters(p, cfg.gap_deg)


GROUP = ("n", "speed", "yaw_mean", "coherence", "ids")


def subgroup_candidates(zp: DataFrame, cfg: ActionZoneConfig = ActionZoneConfig()) -> DataFrame:
    """Groups other than the largest one, with everything their breakaway score needs but growth."""
    g = zp.groupBy(*SAMPLE, "group_no").agg(
        F.count(F.lit(1)).alias("n"), F.avg("vel").alias("speed"), F.avg("yaw").alias("yaw_mean"), F.count("heading").alias("h"),
        geo.resultant(F.col("heading")).alias("res"), F.sort_array(F.collect_set("track_id")).alias("ids"), F.max("ts").alias("ts"))
    g = g.withColumn("coherence", F.when(F.col("h") > 0, F.col("res")).otherwise(geo.lit(0.0)))
    main = g.groupBy(*SAMPLE).agg(F.max_by(F.struct("group_no", "speed", "yaw_mean"), F.struct(F.col("n"), -F.col("group_no"))).alias("main"))
    j = g.join(main, SAMPLE)
    return j.select(
        *SAMPLE, "group_no", "ts", "n", "coherence", "ids", (F.col("group_no") == F.col("main.group_no")).alias("is_main"),
        F.least(F.col("speed") / cfg.speed_norm_cap, geo.lit(1.0)).alias("sub_speed_norm"),
        F.least(F.col("main.speed") / cfg.speed_norm_cap, geo.lit(1.0)).alias("main_speed_norm"),
        F.abs(F.col("yaw_mean") - F.col("main.yaw_mean")).alias("separation"),
        F.when(F.col("n") > cfg.subgroup_max, 0.6).otherwise(0.0).alias("size_penalty"),
        (F.col("n") >= cfg.subgroup_min).alias("eligible"),
    )


BREAKAWAY = ["separation", "sub_speed_norm", "coherence", "main_speed_norm", "size_penalty", "ids"]


def breakaway_run(cfg: ActionZoneConfig):
    """Step for blockrun: growth of separation depends on the subgroup chosen one sample before."""
    a1, a2, a3, a4, a5 = cfg.a

    def run(pdf: pd.DataFrame, state: str | None):
        prev = json.loads(state) if state is not None else None
        out = []
        for sample, (when, *of_groups) in steps(pdf, "sample", ["ts", "eligible", "is_main", *BREAKAWAY]):
            ts, best = float(when[0]), None
            for eligible, is_main, *r in zip(*(c.tolist() for c in of_groups)):
                if not eligible or is_main:
                    continue
                separation, speed, coherence, main_speed, penalty, members = r
                ids = set(int(i) for i in members)
                growth = 0.0
                if prev is not None and prev[2]:
                    shared = len(ids & set(prev[2])) / (min(len(ids), len(prev[2])) or 1)
                    if shared >= cfg.sep_growth_min_overlap:
                        growth = min(max(0.0, (separation - prev[1]) / max(ts - prev[0], 1e-3)) / 10.0, 1.0)
                x = a1 * speed + a2 * coherence + a3 * (1.0 - main_speed) + a4 * growth - a5 * penalty
                score = 1.0 / (1.0 + math.exp(-x))
                if best is None or score > best[0]:
                    best = (score, separation, sorted(ids), growth)
            if best is None:
                best = (0.0, 0.0, [], 0.0)
            prev = [ts, best[1], best[2]]
            out.append((int(sample), best[0], best[1], best[2] if best[0] > 0.5 else [], best[3]))
        df = pd.DataFrame(out, columns=["sample", "breakaway", "best_separation", "subgroup", "sep_growth"])
        return df.astype({"sample": "int64"}), json.dumps(prev)

    return run


def action_zone(players: DataFrame, crowd: DataFrame, cfg: ActionZoneConfig = ActionZoneConfig()) -> DataFrame:
    """Bounded camera target per sample.

    players: SAMPLE, ts, track_id, yaw, pitch, conf, vel. crowd: SAMPLE, ts, centroid_yaw,
    dispersion_deg, total, mode. Two sequential steps (subgroup choice, smoothing) run in
    blocks; all scores are native.
    """
    from fieldlens.operators.series import ema_series

    zp = cut(zone_players(players, cfg))
    # every sample appears, also those without an eligible subgroup: they reset the memory
    cand = subgroup_candidates(zp, cfg).withColumn("block", F.floor(F.col("sample") / 4096))
    brk = run_blocks(cand, ["clip_id"], "block", ["sample", "group_no"], breakaway_run(cfg),
                     "sample long, breakaway double, best_separation double, subgroup array<long>, sep_growth double").drop("block")
    p = zp.join(brk.select(*SAMPLE, "breakaway", "subgroup"), SAMPLE)
    boost = F.when(F.array_contains("subgroup", F.col("track_id").cast("long")), geo.lit(1.0) + F.col("breakaway") * cfg.beta_c).otherwise(geo.lit(1.0))
    w = F.greatest(F.col("conf") * (geo.lit(1.0) + F.col("speed_norm") * cfg.beta_m) * (geo.lit(1.0) - F.col("static_score") * cfg.beta_s) * boost, geo.lit(0.0))
    energy = F.col("conf") * F.col("speed_norm")
    s = p.withColumn("w", w).withColumn("e", energy).groupBy(*SAMPLE).agg(
        geo.circular_mean("yaw", "w").alias("zone_raw"),
        F.sum(F.when(F.col("yaw") >= 0, F.col("e")).otherwise(geo.lit(0.0))).alias("re"), F.sum("e").alias("te"), F.avg("e").alias("activity"),
        F.count("heading").alias("h"), geo.resultant(F.col("heading")).alias("res"), F.avg("vel").alias("ms"), F.stddev_pop("vel").alias("sd"), F.sum("vel").alias("sv"))
    s = crowd.select(*SAMPLE, "ts", "centroid_yaw", "dispersion_deg", "total", "mode").join(s, SAMPLE, "left").join(
        brk.select(*SAMPLE, "breakaway", F.size("subgroup").alias("subgroup_size")), SAMPLE, "left")
    s = s.withColumn("zone_raw", F.coalesce("zone_raw", "centroid_yaw"))
    s = s.withColumn("share", F.coalesce("re", geo.lit(0.0)) / F.when(F.coalesce("te", geo.lit(0.0)) == 0, geo.lit(1e-6)).otherwise(F.col("te")))
    s = row_index(s, ["clip_id"], ["sample"], frame_block("sample"))
    rad = F.radians("centroid_yaw")
    s = halo_windows(s, ["clip_id"], "rn", cfg.persist_window - 1, 0, lambda w_: {
        "p_ts": F.lag("ts").over(w_), "p_raw": F.lag("zone_raw").over(w_), "p_share": F.lag("share").over(w_),
        "persistence": F.hypot(F.avg(F.cos(rad)).over(w_.rowsBetween(-(cfg.persist_window - 1), 0)), F.avg(F.sin(rad)).over(w_.rowsBetween(-(cfg.persist_window - 1), 0)))})
    dt = F.greatest(F.col("ts") - F.col("p_ts"), geo.lit(1e-3))
    s = s.withColumn("zone_speed", F.coalesce((F.col("zone_raw") - F.col("p_raw")) / dt, geo.lit(0.0)))
    s = s.withColumn("switch", F.coalesce(F.least(F.abs(F.col("share") - F.col("p_share")) / dt / cfg.switch_norm_cap, geo.lit(1.0)), geo.lit(0.0)))
    s = ema_series(s, ["clip_id"], "sample", "zone_raw", "zone_yaw", cfg.smooth_alpha)
    coherence = F.when(F.coalesce("h", F.lit(0)) > 0, F.col("res")).otherwise(geo.lit(0.0))
    agreement = F.when(F.coalesce("sv", geo.lit(0.0)) > 0, F.greatest(geo.lit(0.0), geo.lit(1.0) - F.least(F.col("sd") / F.col("ms"), geo.lit(1.0)))).otherwise(geo.lit(0.0))
    det = F.least(F.col("total") / cfg.det_norm_cap, geo.lit(1.0))
    disp = F.least(F.coalesce("dispersion_deg", geo.lit(0.0)) / cfg.disp_norm_cap, geo.lit(1.0))
    c1, c2, c3, c4 = cfg.c
    s = s.withColumn("confidence", geo.sigmoid(det * c1 + (geo.lit(1.0) - disp) * c2 + agreement * c3 - (geo.lit(1.0) - coherence) * c4))
    i1, i2, i3, i4, i5 = cfg.ai
    brk_score = F.coalesce("breakaway", geo.lit(0.0))
    s = s.withColumn("intensity", geo.sigmoid(det * i1 + F.least(F.coalesce("activity", geo.lit(0.0)), geo.lit(1.0)) * i2 + F.col("persistence") * i3 + F.col("switch") * i4 + brk_score * i5))
    lead = F.when(F.col("confidence") > cfg.lead_conf_gate, geo.clamp(F.col("zone_speed") * cfg.k_lead_s, -cfg.lead_max_deg, cfg.lead_max_deg)).otherwise(geo.lit(0.0))
    s = s.withColumn("lead_deg", lead)
    bias = geo.clamp(F.col("confidence") * cfg.arbitration_w * (F.col("zone_yaw") + F.col("lead_deg") - F.col("centroid_yaw")), -cfg.bias_max_deg, cfg.bias_max_deg)
    reason = F.when(F.col("mode") == "wide", "wide_mode_zero_influence").when(F.col("confidence") < cfg.conf_floor, "low_confidence_fallback").otherwise("active")
    s = s.withColumn("reason_code", reason).withColumn("bias_deg", F.when(F.col("reason_code") == "active", bias).otherwise(geo.lit(0.0)))
    fov = geo.lit(cfg.follow_fov) + F.greatest(geo.lit(1.0) - F.col("confidence"), brk_score * 0.5, F.col("switch")) * (cfg.wide_fov - cfg.follow_fov)
    return s.select(
        *SAMPLE, "ts", "centroid_yaw", "zone_raw", "zone_yaw", (F.col("centroid_yaw") + F.col("bias_deg")).alias("target_yaw"), "bias_deg", "confidence", "intensity",
        brk_score.alias("breakaway"), F.col("switch").alias("switch_of_play"), "lead_deg", fov.alias("recommended_fov"),
        F.coalesce("subgroup_size", F.lit(0)).alias("subgroup_size"), "reason_code")


# ---------------------------------------------------------------- fused target
def fusion_anchors(samples: DataFrame, anchors: DataFrame, cfg: FusionConfig = FusionConfig()) -> DataFrame:
    """Best anchor observation per sampling step, then hold for a few samples, then centroid.

    Steps tile the clip, so an anchor belongs to exactly one: each anchor row is labelled
    with the next sample at or after its frame and grouped, without a range join.
    """
    s = samples.select("clip_id", F.rint(F.col("ts") * cfg.clip_fps).cast("int").alias("frame"), "sample").withColumn("_side", F.lit(1))
    a = anchors.select("clip_id", "frame", F.struct("weighted_conf", "frame", "yaw", "det_id").alias("o")).withColumn("_side", F.lit(0))
    u = s.unionByName(a, allowMissingColumns=True)
    u = carry_scan(u, ["clip_id"], ["frame", "_side"], frame_block(), {"step": Carry("first", F.col("sample"))})
    best = u.filter("_side = 0 and step is not null").groupBy("clip_id", F.col("step").alias("sample")).agg(
        F.max_by("o", F.struct(F.col("o.weighted_conf"), -F.col("o.frame"), -F.col("o.det_id"))).alias("hit"))
    j = samples.join(best, SAMPLE, "left")
    j = row_index(j, ["clip_id"], ["sample"], frame_block("sample"))
    last = F.when(F.col("hit").isNotNull(), F.struct("rn", "hit.yaw"))
    j = carry_scan(j, ["clip_id"], ["sample"], frame_block("sample"), {"last_hit": Carry("last", last)})
    since = F.col("rn") - F.col("last_hit.rn")
    source = F.when(F.col("hit").isNotNull(), "anchor").when(since <= cfg.hold_max_samples, "held_anchor").otherwise("centroid")
    return j.withColumn("anchor_source", source).withColumn("samples_since_anchor", since).withColumn(
        "anchor_position", F.when(F.col("anchor_source") == "centroid", F.col("centroid_yaw")).otherwise(F.col("last_hit.yaw"))).withColumn(
        "ball_conf", F.col("hit.weighted_conf")).drop("hit", "last_hit", "rn")


# ---------------------------------------------------------------- warm-up chains
def warmup_chain(cand: DataFrame, hard_pitch: float = 18.0, max_step: float = 30.0, min_len: int = 3) -> DataFrame:
    """Best chain over consecutive positions of a five-frame batch, by dynamic programming.

    cand: clip_id, batch, pos (0..4), det_id, yaw, pitch, conf. A chain starts anywhere with
    its first confidence and gains mean confidence minus distance/60 per link. Four equi
    joins on pos + 1, each reduced to the best chain per end point before the next: the best score,
    then the longer chain, then the smaller detections.
    """
    keys = ["clip_id", "batch"]
    node = cand.select(*keys, "pos", "det_id", "yaw", "pitch", "conf", F.col("conf").alias("score"), F.array("det_id").alias("path"), (F.col("pitch") > hard_pitch).alias("bad"))
    layer, done = node.filter("pos = 0"), None
    for pos in range(1, 5):
        nxt = cand.filter(F.col("pos") == pos).select(*keys, F.col("det_id").alias("nd"), F.col("yaw").alias("ny"), F.col("pitch").alias("np"), F.col("conf").alias("nc"))
        d = geo.angular_distance("yaw", "pitch", "ny", "np")
        ext = layer.join(nxt, keys).withColumn("d", d).filter(geo.within(F.col("d"), max_step)).select(
            *keys, F.lit(pos).alias("pos"), F.col("nd").alias("det_id"), F.col("ny").alias("yaw"), F.col("np").alias("pitch"), F.col("nc").alias("conf"),
            (F.col("score") + (F.col("conf") + F.col("nc")) / 2.0 - F.col("d") / 60.0).alias("score"),
            F.concat("path", F.array("nd")).alias("path"), (F.col("bad") | (F.col("np") > hard_pitch)).alias("bad"))
        options = ext.unionByName(node.filter(F.col("pos") == pos))
        rest = ["yaw", "pitch", "conf", "score", "path", "bad"]
        done = layer if done is None else done.unionByName(layer)
        layer = options.groupBy(*keys, "pos", "det_id").agg(F.max_by(F.struct(*rest), F.struct("score", F.size("path"), F.transform("path", lambda d: -d))).alias("r")).select(*keys, "pos", "det_id", "r.*")
    done = done.unionByName(layer)
    ok = done.filter((F.size("path") >= min_len) & ~F.col("bad"))
    return ok.groupBy(*keys).agg(F.max_by(F.struct("score", "path"), F.struct(F.col("score"), -F.col("det_id"))).alias("b")).select(
        *keys, "b.score", F.size("b.path").alias("length"), F.array_join("b.path", ">").alias("path"))
