"""Angles and geometry as Spark column expressions (no Python UDFs).

Degrees throughout; yaw has a seam at +-180. All literals are doubles so that
nothing turns into DECIMAL. Distances compare with a 1e-9 degree tolerance, so an
exact tie with a radius does not depend on the last bit of acos.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TOL = 1e-9


def lit(x) -> Column:
    return F.lit(float(x))


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r4(c, places: int = 4) -> Column:
    """Rounding for results at the edge: half up on the scaled double. The small nudge sends
    exact decimal ties up whatever the last bit of a sum says."""
    scale = float(10**places)
    return F.floor(col(c) * lit(scale) + lit(0.500001)) / lit(scale)


def clamp(c, lo: float = 0.0, hi: float = 1.0) -> Column:
    # greatest/least skip nulls, so an unknown value has to be kept unknown explicitly
    return F.when(col(c).isNotNull(), F.greatest(lit(lo), F.least(lit(hi), col(c))))


def sigmoid(c) -> Column:
    return lit(1.0) / (lit(1.0) + F.exp(-col(c)))


def wrap_yaw(c) -> Column:
    return F.pmod(col(c) + lit(180.0), lit(360.0)) - lit(180.0)


def circular_delta(a, b) -> Column:
    return F.pmod(col(a) - col(b) + lit(180.0), lit(360.0)) - lit(180.0)


def angular_distance(y1, p1, y2, p2) -> Column:
    """Great-circle angle. The atan2 form needs no clamping, keeps nulls and stays exact near
    zero, where an arc cosine loses half its digits."""
    p1, p2 = F.radians(col(p1)), F.radians(col(p2))
    dy = F.radians(col(y1) - col(y2))
    across = F.cos(p2) * F.sin(dy)
    along = F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dy)
    return F.degrees(F.atan2(F.hypot(across, along), F.sin(p1) * F.sin(p2) + F.cos(p1) * F.cos(p2) * F.cos(dy)))


def within(distance: Column, radius, strict: bool = False) -> Column:
    radius = lit(radius) if isinstance(radius, (int, float)) else radius
    return distance < radius - lit(TOL) if strict else distance <= radius + lit(TOL)


def unit_x(y, p) -> Column:
    return F.cos(F.radians(col(p))) * F.sin(F.radians(col(y)))


def unit_y(p) -> Column:
    return F.sin(F.radians(col(p)))


def unit_z(y, p) -> Column:
    return F.cos(F.radians(col(p))) * F.cos(F.radians(col(y)))


def unit_vec(y, p) -> Column:
    return F.struct(unit_x(y, p).alias("x"), unit_y(p).alias("y"), unit_z(y, p).alias("z"))


def vec_yaw(x, z) -> Column:
    return F.degrees(F.atan2(col(x), col(z)))


def vec_pitch(y) -> Column:
    return F.degrees(F.asin(clamp(col(y), -1.0, 1.0)))


def unit_angle(a, b) -> Column:
    """Angle between two unit vectors given as (x, y, z) column triples."""
    less = [col(i) - col(j) for i, j in zip(a, b)]
    more = [col(i) + col(j) for i, j in zip(a, b)]
    norm = lambda v: F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])
    return F.degrees(F.atan2(norm(less), norm(more))) * lit(2.0)


def yaw_bin(yaw, bin_deg: float) -> Column:
    return F.floor((wrap_yaw(yaw) + lit(180.0)) / lit(bin_deg)).cast("int")


def pitch_bin(pitch, bin_deg: float) -> Column:
    return F.floor((col(pitch) + lit(90.0)) / lit(bin_deg)).cast("int")


def bin_centre(index, origin: float, bin_deg: float) -> Column:
    return col(index) * lit(bin_deg) + lit(origin) + lit(bin_deg / 2.0)


def penalty_weight(duty, cfg) -> Column:
    duty = col(duty)
    frac = (duty - lit(cfg.low_duty_floor)) / lit(cfg.duty_cycle_threshold - cfg.low_duty_floor)
    taper = lit(cfg.penalty_min) + lit((1.0 - cfg.penalty_min) * 0.5) * (lit(1.0) + F.cos(lit(math.pi) * frac))
    return (
        F.when(duty < lit(cfg.low_duty_floor), lit(1.0))
        .when(duty >= lit(cfg.duty_cycle_threshold), lit(cfg.penalty_min))
        .otherwise(taper)
    )


def region_weight(distance, radius, peak_duty, cfg) -> Column:
    """Full peak inside the radius, linear fall-off over one more radius, neutral beyond."""
    d, r, peak = col(distance), col(radius), col(peak_duty)
    eff = F.when(within(d, r), peak).when(d <= r * lit(2.0), peak * (lit(1.0) - (d - r) / r))
    return F.when(eff.isNull(), lit(1.0)).otherwise(penalty_weight(eff, cfg))


def crop_pixel_to_yaw_pitch(px, py, crop_yaw, fov_deg: float, w: float, h: float) -> tuple[Column, Column]:
    t = math.tan(math.radians(fov_deg / 2.0))
    nx = (col(px) - lit(w / 2.0)) / lit(w / 2.0) * lit(t)
    ny = -(col(py) - lit(h / 2.0)) / lit(h / 2.0) * lit(t * w / h)
    norm = F.sqrt(nx * nx + ny * ny + lit(1.0))
    c = F.radians(col(crop_yaw).cast("double"))
    wx = F.cos(c) * nx + F.sin(c)
    wz = F.cos(c) - F.sin(c) * nx
    return F.degrees(F.atan2(wx, wz)), F.degrees(F.asin(clamp(ny / norm, -1.0, 1.0)))


def equirect_to_yaw_pitch(px, py, w, h) -> tuple[Column, Column]:
    return (col(px) / w - lit(0.5)) * lit(360.0), (lit(0.5) - col(py) / h) * lit(180.0)


def yaw_pitch_to_equirect(yaw, pitch, w, h) -> tuple[Column, Column]:
    return (col(yaw) / lit(360.0) + lit(0.5)) * w, (lit(0.5) - col(pitch) / lit(180.0)) * h


def bbox_geometry(bbox) -> dict[str, Column]:
    """Width, height, area, aspect (null when the height is not positive) and centre."""
    b = col(bbox)
    x1, y1, x2, y2 = (F.element_at(b, i) for i in (1, 2, 3, 4))
    w, h = x2 - x1, y2 - y1
    return {
        "width": w,
        "height": h,
        "area": w * h,
        "aspect": F.when(h > 0, w / h),
        "cx": (x1 + x2) / lit(2.0),
        "cy": (y1 + y2) / lit(2.0),
    }


def fill_geometry(geometry) -> dict[str, Column]:
    """Recorded scalars first, else from a valid box; a non-positive aspect counts as missing."""
    g = col(geometry)
    b = g["bbox_xyxy"]
    x1, y1, x2, y2 = (F.try_element_at(b, F.lit(i)) for i in (1, 2, 3, 4))
    ok = (F.size(b) == 4) & (x2 > x1) & (y2 > y1)
    w, h = F.when(ok, x2 - x1), F.when(ok, y2 - y1)
    aspect = g["bbox_aspect_ratio"]
    return {
        "width": F.coalesce(g["bbox_width_px"], w),
        "height": F.coalesce(g["bbox_height_px"], h),
        "area": F.coalesce(g["bbox_area_px"], w * h),
        "aspect": F.when(ok, F.coalesce(F.when(aspect > 0, aspect), w / F.greatest(h, lit(1e-6)))).otherwise(aspect),
    }


def point_in_polygon(x, y, polygon) -> Column:
    """Even-odd ray cast over an array<struct<x,y>>; polygons are short vertex lists."""
    x, y, poly = col(x), col(y), col(polygon)
    n = F.size(poly)
    rotated = F.concat(F.slice(poly, F.lit(2), F.greatest(n - 1, F.lit(0))), F.slice(poly, F.lit(1), F.lit(1)))
    edges = F.arrays_zip(poly.alias("a"), rotated.alias("b"))

    def crosses(e):
        (x1, y1), (x2, y2) = (e["a"]["x"], e["a"]["y"]), (e["b"]["x"], e["b"]["y"])
        spans = (y > F.least(y1, y2)) & (y <= F.greatest(y1, y2)) & (x <= F.greatest(x1, x2))
        hit_x = (y - y1) * (x2 - x1) / F.when(y1 != y2, y2 - y1) + x1
        return F.coalesce(spans & ((x1 == x2) | (x <= hit_x)), F.lit(False))

    return F.aggregate(edges, F.lit(False), lambda inside, e: F.when(crosses(e), ~inside).otherwise(inside))


def in_zones(yaw, pitch, zones) -> Column:
    """Axis-aligned zones given as array<struct<yaw_centre,yaw_radius,pitch_centre,pitch_radius>>."""
    return F.exists(
        col(zones),
        lambda z: (F.abs(col(yaw) - z["yaw_centre"]) <= z["yaw_radius"])
        & (F.abs(col(pitch) - z["pitch_centre"]) <= z["pitch_radius"]),
    )


def pitch_plausibility(pitch, soft_min=-30.0, soft_max=10.0, hard_max=18.0, decay=8.0) -> Column:
    p = col(pitch)
    over = F.greatest(p - lit(soft_max), lit(soft_min) - p, lit(0.0))
    return F.when(p > lit(hard_max), lit(0.0)).otherwise(F.greatest(lit(0.0), lit(1.0) - over / lit(decay)))


def point_rect_distance(px, py, rect) -> Column:
    r = col(rect)
    x1, y1, x2, y2 = (F.element_at(r, i) for i in (1, 2, 3, 4))
    dx = F.greatest(x1 - col(px), lit(0.0), col(px) - x2)
    dy = F.greatest(y1 - col(py), lit(0.0), col(py) - y2)
    return F.when(r.isNotNull() & col(px).isNotNull() & col(py).isNotNull(), F.hypot(dx, dy))


def pose_score(ankle_px, lower_px) -> Column:
    """Ankles decide when seen, else the lower body; neither seen stays unknown (null)."""
    a, l = col(ankle_px), col(lower_px)
    return F.when(a.isNotNull(), clamp(lit(1.0) - a / lit(260.0))).when(
        l.isNotNull(), clamp(lit(1.0) - l / lit(320.0))
    )


def compactness(aspect) -> Column:
    a = col(aspect)
    return F.when(a > 0, clamp(lit(1.0) - F.abs(F.log(a)) / lit(math.log(4.0))))


def size_score(area, expected) -> Column:
    ratio = F.greatest(col(area) / col(expected), lit(1e-6))
    return F.when(
        col(expected).isNull() | (col(expected) <= 0), lit(0.5)
    ).otherwise(F.greatest(lit(0.0), lit(1.0) - F.abs(F.log(ratio)) / lit(2.0)))


def verification_tolerance(bbox_width_px) -> Column:
    return F.greatest(lit(0.5), col(bbox_width_px) * lit(110.0 / 1280.0) * lit(1.5))


def circularity(area, perimeter) -> Column:
    a, p = col(area), col(perimeter)
    return F.when(p > 0, clamp(lit(4.0 * math.pi) * a / (p * p))).otherwise(lit(0.0))


def blob_passes(area, perimeter, w, h, min_area=100.0, max_area=800.0, min_circularity=0.5, max_aspect=2.5) -> Column:
    return (
        col(area).between(min_area, max_area)
        & (circularity(area, perimeter) >= lit(min_circularity))
        & ~((col(w) > 0) & (col(h) / col(w) > lit(max_aspect)))
    )


def circular_mean(yaw, weight=None) -> Column:
    """Aggregate: weighted circular mean; null when the total weight is not positive."""
    w = lit(1.0) if weight is None else col(weight)
    r = F.radians(col(yaw))
    mean = F.degrees(F.atan2(F.sum(w * F.sin(r)), F.sum(w * F.cos(r))))
    return mean if weight is None else F.when(F.sum(w) > 0, mean)


def resultant(angle_rad: Column) -> Column:
    """Aggregate: length of the mean direction vector, 1 = aligned."""
    return F.hypot(F.avg(F.cos(angle_rad)), F.avg(F.sin(angle_rad)))
