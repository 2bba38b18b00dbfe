"""Immutable thresholds. Every operator takes one of these; nothing is a module global."""

from __future__ import annotations

from dataclasses import dataclass

# These have to equal the published defaults for results to match.


@dataclass(frozen=True)
class HotspotConfig:
    sphere_bin_deg: float = 2.0
    low_duty_floor: float = 0.10
    duty_cycle_threshold: float = 0.60
    penalty_min: float = 0.10
    merge_radius_deg: float = 4.0
    pitch_soft_min: float = -30.0
    pitch_hard_max: float = 18.0
    leader_radius_deg: float = 5.0
    leader_min_coverage: float = 0.40


@dataclass(frozen=True)
class CandidateConfig:
    pitch_min_deg: float = -30.0
    pitch_max_deg: float = 18.0
    area_max_px: float = 100.0
    aspect_max: float = 1.25
    nms_thresh_deg: float = 15.0
    player_nms_deg: float = 8.0
    hotspot_hard_thresh: float = 0.5
    high_conf_thresh: float = 0.35
    ambiguity_spread: float = 0.15


@dataclass(frozen=True)
class LinkConfig:
    base_tolerance_deg: float = 5.0
    max_speed_deg_per_frame: float = 8.0
    max_link_gap: int = 5
    min_support_conf: float = 0.10
    w_conf: float = 0.40
    w_prox: float = 0.35
    w_vel: float = 0.25
    alternate_margin: float = 0.15
    # "reference" turns about the motion axis; "great_circle" moves along it.
    predict: str = "reference"
    block_frames: int = 4096


@dataclass(frozen=True)
class ScoreConfig:
    min_anchor_strength: float = 0.55
    min_obs_for_score: int = 4
    min_obs_for_anchor: int = 8
    min_mean_conf_for_anchor: float = 0.20
    min_coverage_for_anchor: float = 0.50
    min_support_conf: float = 0.10


@dataclass(frozen=True)
class MotionAuditConfig:
    obs_count: int = 12
    span_frames: int = 20
    net_disp_deg: float = 1.5
    spread_mad_deg: float = 0.6
    p90_step_deg: float = 0.25


@dataclass(frozen=True)
class ClusterAuditConfig:
    net_disp_ceiling: float = 1.5
    major_motion_deg: float = 42.0
    min_obs: int = 3
    min_span: int = 5
    cluster_radius_deg: float = 4.0
    min_members: int = 3
    min_temporal_span: int = 150
    min_window_gap: int = 50
    guard_margin_deg: float = 0.5
    radius_cap_deg: float = 6.0
    min_radius_deg: float = 0.3
    split_radius_deg: float = 1.2
    gap_threshold_deg: float = 0.5
    spread_limit_deg: float = 3.5


@dataclass(frozen=True)
class LossConfig:
    min_confidence: float = 0.15


@dataclass(frozen=True)
class RepairConfig:
    anchor_confidence: float = 0.15
    trace_confidence: float = 0.03
    borderline_confidence: float = 0.06
    min_bbox_area_px: float = 4.0
    max_bbox_area_px: float = 2500.0
    min_bbox_aspect_ratio: float = 0.25
    max_bbox_aspect_ratio: float = 4.0
    fence_yaw: float = -77.4
    fence_pitch: float = -3.9
    fence_radius_deg: float = 5.0
    stable_frames: int = 1
    anchor_match_deg: float = 6.0
    max_yaw_step_deg: float = 3.0
    max_pitch_step_deg: float = 1.5
    agreement_deg: float = 1.25
    max_resolvable_window_frames: int = 29
    max_review_frames_per_window: int = 12
    confidence_weight: float = 0.45
    motion_weight: float = 0.55


@dataclass(frozen=True)
class BackwardConfig:
    max_jump_deg: float = 8.0
    max_gap_frames: int = 3
    confidence_weight: float = 0.45
    motion_weight: float = 0.55
    # chronological reach before the anchor
    horizon_frames: int = 60


@dataclass(frozen=True)
class CrowdConfig:
    cluster_radius_deg: float = 25.0
    min_players: int = 2
    motion_match_deg: float = 15.0
    low_motion_deg_s: float = 1.5
    max_missed: int = 2
    rolling_window_s: float = 2.5
    stable_coverage_s: float = 2.0
    stable_min_tracks: int = 2
    blend_weight: float = 0.2
    blend_clamp_deg: float = 5.0
    vel_min_deg_per_frame: float = 0.3
    convergence_dot: float = 0.3
    min_moving_vel: float = 2.0
    min_agreeing_tracks: int = 3
    min_sustain_samples: int = 3


@dataclass(frozen=True)
class ActionZoneConfig:
    static_speed_cap: float = 5.0
    beta_m: float = 1.0
    beta_s: float = 1.0
    beta_c: float = 0.0
    speed_norm_cap: float = 30.0
    gap_deg: float = 25.0
    subgroup_min: int = 2
    subgroup_max: int = 5
    k_lead_s: float = 0.4
    lead_max_deg: float = 8.0
    lead_conf_gate: float = 0.5
    smooth_alpha: float = 0.35
    conf_floor: float = 0.35
    det_norm_cap: float = 8.0
    disp_norm_cap: float = 60.0
    switch_norm_cap: float = 1.0
    bias_max_deg: float = 15.0
    arbitration_w: float = 1.0
    sep_growth_min_overlap: float = 0.5
    follow_fov: float = 85.0
    wide_fov: float = 100.0
    c: tuple = (1.6, 1.6, 1.0, 1.4)
    a: tuple = (1.4, 1.2, 0.8, 1.0, 2.0)
    ai: tuple = (1.2, 1.2, 1.0, 0.5, 0.3)
    persist_window: int = 6
    history: int = 40


@dataclass(frozen=True)
class FusionConfig:
    hold_max_samples: int = 4
    lookahead_offset_deg: float = 10.0
    flow_offset_alpha: float = 0.35
    max_pan_speed_deg_s: float = 25.0
    clip_fps: float = 2.0


@dataclass(frozen=True)
class CameraConfig:
    dispersion_scale_deg: float = 40.0
    strong_thresh: float = 0.45
    weak_thresh: float = 0.30
    hysteresis_s: float = 1.5
    wide_yaw_max_speed: float = 10.0
    wide_yaw_range: float = 45.0
    wide_yaw: float = 0.0
    follow_fov: float = 85.0
    wide_fov: float = 100.0
    deadband_deg: float = 1.5
    max_pan_speed: float = 25.0
    max_pan_accel: float = 60.0


@dataclass(frozen=True)
class LedgerConfig:
    min_video_bytes: float = 100e6
    processing_minutes: float = 30.0
    suspicious_gap_days: int = 14
    max_clip_seconds: float = 90.0
    stable_seconds: float = 3600.0
    huge_bytes: float = 15e9
    tiny_bytes: float = 1e9
