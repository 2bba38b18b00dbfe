"""Six-term candidate score against a predicted state, as one column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldlens.functions import geo


def candidate_score(conf, yaw, pitch, size, px, pred_yaw, pred_pitch, variance: float, vel_yaw: float, vel_pitch: float,
                    crop_w: float = 1280.0, edge_px: float = 80.0) -> Column:
    """Confidence, position, pitch, size, motion and edge terms; zero above the hard pitch limit.

    ``variance`` is the innovation variance of the (isotropic) prediction.
    """
    c = geo.col
    dy, dp = c(yaw) - c(pred_yaw), c(pitch) - c(pred_pitch)
    m = F.sqrt((dy * dy + dp * dp) / variance)
    fast = (m > 8.0) & (geo.angular_distance(yaw, pitch, pred_yaw, pred_pitch) > 5.0)
    m = F.when(fast, F.least(m, geo.lit(4.0))).otherwise(m)
    plaus = geo.pitch_plausibility(pitch)
    motion = F.greatest(geo.lit(0.0), geo.lit(1.0) - F.hypot(dy - vel_yaw, dp - vel_pitch) / 10.0)
    edge = F.least(geo.lit(1.0), F.least(F.abs(c(px)), F.abs(geo.lit(crop_w) - c(px))) / edge_px)
    total = (
        F.least(geo.lit(1.0), c(conf) / 0.5) * 0.20 + F.greatest(geo.lit(0.0), geo.lit(1.0) - m / 10.0) * 0.25 + plaus * 0.15
        + c(size) * 0.20 + motion * 0.10 + edge * 0.10
    )
    return F.when(plaus == 0, geo.lit(0.0)).otherwise(total)
