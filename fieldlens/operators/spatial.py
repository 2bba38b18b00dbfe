"""Neighbourhood joins on the sphere, blocked by a grid over unit vectors.

Grid cells live in (x, y, z), so neither the yaw seam nor the poles need special care.
A chord of length 2 sin(r/2) spans an angle r; a ball of that radius covers the cap.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldlens.functions import geo
from fieldlens.operators.scan import null_safe_join
from fieldlens.session import cut, shuffled

CELL = ("cx", "cy", "cz")


def chord(radius_deg: float) -> float:
    return 2.0 * math.sin(math.radians(min(radius_deg, 180.0)) / 2.0)


def with_cell(df: DataFrame, edge: float, yaw: str = "yaw", pitch: str = "pitch") -> DataFrame:
    xyz = {"cx": geo.unit_x(yaw, pitch), "cy": geo.unit_y(pitch), "cz": geo.unit_z(yaw, pitch)}
    for name, v in xyz.items():
        df = df.withColumn(name, F.floor(v / geo.lit(edge)).cast("int"))
    return df


def shift_cells(df: DataFrame, reach: int, half: bool = False) -> DataFrame:
    """One row per cell within ``reach`` cells (a fixed number of copies). ``half`` takes one of
    each two opposite neighbours, so that an unordered pair of cells is met once. The next join shuffles them."""
    offsets = F.array(*[
        F.struct(*[F.lit(v).alias(a) for v, a in zip(o, "abc")])
        for o in product(range(-reach, reach + 1), repeat=3) if not half or o > (0, 0, 0)
    ])
    o = df.withColumn("_o", F.explode(offsets))
    for c, a in zip(CELL, "abc"):
        o = o.withColumn(c, F.col(c) + F.col(f"_o.{a}"))
    return shuffled(o.drop("_o"))


def near_join(a: DataFrame, b: DataFrame, keys: list[str], reach: int = 1, half: bool = False, few: int = 128) -> DataFrame:
    """Rows of a key whose cells are at most ``reach`` apart; both sides carry CELL, the result has that of ``a``.

    Keys with at most ``few`` rows in ``b`` meet as they are, since a copy per neighbouring cell would be many
    times the table; only rows of larger keys are copied. ``half`` as in shift_cells, the greater cell being ``a``'s.
    """
    crowded = cut(b.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > few).select(*keys))

    def direct(a, b):
        j = a.join(shuffled(b.withColumnsRenamed({c: f"_{c}" for c in CELL})), keys)
        for c in CELL:
            j = j.filter(F.abs(F.col(c) - F.col(f"_{c}")) <= reach)
        j = j.filter(F.struct(*CELL) > F.struct(*[F.col(f"_{c}").alias(c) for c in CELL])) if half else j
        return j.drop(*[f"_{c}" for c in CELL])

    if crowded.isEmpty():
        return direct(a, b)
    rest = direct(a.join(crowded, keys, "left_anti"), b.join(crowded, keys, "left_anti"))
    copied = a.join(crowded, keys, "left_semi").join(shift_cells(b.join(crowded, keys, "left_semi"), reach, half), [*keys, *CELL])
    return rest.unionByName(copied.select(*rest.columns))


def within_pairs(df: DataFrame, keys: list[str], id_col: str, radius: float, strict: bool = False) -> DataFrame:
    """All pairs (a < b) of rows of a key closer than ``radius``: keys, a, b, dist.

    The output is the pair list itself; to group points use spatial_components, which
    does not enumerate pairs.
    """
    edge = chord(radius) * (1 + 1e-9)
    pts = with_cell(df.select(*keys, F.col(id_col).alias("a"), F.col("yaw").alias("ya"), F.col("pitch").alias("pa")), edge, "ya", "pa")
    other = shift_cells(
        pts.select(*keys, F.col("a").alias("b"), F.col("ya").alias("yb"), F.col("pa").alias("pb"), *CELL), 1
    )
    d = geo.angular_distance("ya", "pa", "yb", "pb")
    return (
        pts.join(other, [*keys, *CELL])
        .filter("a < b")
        .withColumn("dist", d)
        .filter(geo.within(F.col("dist"), radius, strict))
        .select(*keys, "a", "b", "dist")
    )


def connected_components(edges: DataFrame, keys: list[str], max_rounds: int = 60) -> DataFrame:
    """(keys, node, comp) for the nodes of undirected ``edges`` (keys, a, b); comp = smallest node.

    Alternating large-star / small-star rounds (Kiveris et al., 2014). Only minima are
    aggregated, so a hub node is combined map-side; each round is checkpointed.
    """
    e = edges.select(*keys, F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e = cut(e)
    for _ in range(max_rounds):
        if _is_star_forest(e, keys):
            break
        both = e.unionByName(e.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(*keys, "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        big = both.join(shuffled(low), [*keys, "u"]).filter("v > u and v <> m").select(*keys, F.col("v").alias("u"), F.col("m").alias("v"))
        low = big.groupBy(*keys, "u").agg(F.min("v").alias("m"))
        small = (
            big.join(shuffled(low), [*keys, "u"])
            .select(*keys, F.explode(F.array(F.col("v"), F.col("u"))).alias("n"), "m")
            .filter("n <> m")
            .select(*keys, F.col("n").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        e = cut(small)
    else:
        raise RuntimeError("components did not settle; raise max_rounds")
    roots = e.select(*keys, F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return e.select(*keys, F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(roots)


def _is_star_forest(e: DataFrame, keys: list[str]) -> bool:
    """Every node has one parent and no parent has a parent: all components are labelled."""
    ends = e.select(*keys, F.explode(F.array(
        F.struct(F.col("u").alias("n"), F.lit(1).alias("child"), F.lit(0).alias("parent")),
        F.struct(F.col("v").alias("n"), F.lit(0).alias("child"), F.lit(1).alias("parent")),
    )).alias("x"))
    per = ends.groupBy(*keys, "x.n").agg(F.sum("x.child").alias("c"), F.max("x.parent").alias("p"))
    return per.filter("c > 1 or (c > 0 and p > 0)").isEmpty()


SUBCELLS = 8
SUB = ("fx", "fy", "fz")


def _cell_links(pairs: DataFrame, members: DataFrame, keys: list[str], edge: float, radius: float, strict: bool) -> DataFrame:
    """(keys, a, b): the cell pairs (c1, c2) that hold two points close enough.

    Subcells are compared by their boxes first. A pair with boxes wholly in reach is linked, boxes wholly out
    of reach cannot link; only where neither decides do points meet, and only those of the
    open subcells. A dense cell costs its subcells, whose number is bounded, not its points squared.
    """
    at = members.select("*", *[v.alias(n) for n, v in zip("xyz", (geo.unit_x("yaw", "pitch"), geo.unit_y("pitch"), geo.unit_z("yaw", "pitch")))])
    at = at.select("*", *[F.floor(F.col(n) / geo.lit(edge)).cast("int").alias(f) for n, f in zip("xyz", SUB)])
    boxes = at.groupBy(*keys, "cell_id", *SUB).agg(*[f(n).alias(f"{m}{n}") for n in "xyz" for f, m in ((F.min, "lo"), (F.max, "hi"))])

    def side(df: DataFrame, n: int) -> DataFrame:
        return df.select(*keys, *[F.col(c).alias(f"c{n}" if c == "cell_id" else f"{c}{n}") for c in df.columns if c not in keys])

    both = pairs.join(shuffled(side(boxes, 1)), [*keys, "c1"]).join(shuffled(side(boxes, 2)), [*keys, "c2"])
    square = lambda v: v * v
    gap = sum(square(F.greatest(F.col(f"lo{n}1") - F.col(f"hi{n}2"), F.col(f"lo{n}2") - F.col(f"hi{n}1"), geo.lit(0.0))) for n in "xyz")
    span = sum(square(F.greatest(F.col(f"hi{n}1") - F.col(f"lo{n}2"), F.col(f"hi{n}2") - F.col(f"lo{n}1"))) for n in "xyz")
    reach = chord(radius)
    near = both.filter(gap <= geo.lit((reach * (1 + 1e-7) + 1e-9) ** 2)).withColumn("sure", span < geo.lit((reach * (1 - 1e-7)) ** 2))
    pair = [*keys, "c1", "c2"]
    sure = near.filter("sure").select(*pair).distinct()
    opened = near.filter(~F.col("sure")).select(*pair, *[f"{f}{n}" for n in (1, 2) for f in SUB]).join(shuffled(sure), pair, "left_anti")
    spots = at.select(*keys, "cell_id", *SUB, "yaw", "pitch")
    met = opened.join(shuffled(side(spots, 1)), [*keys, "c1", *[f"{f}1" for f in SUB]]).join(shuffled(side(spots, 2)), [*keys, "c2", *[f"{f}2" for f in SUB]])
    met = met.filter(geo.within(geo.angular_distance("yaw1", "pitch1", "yaw2", "pitch2"), radius, strict)).select(*pair).distinct()
    return sure.unionByName(met).select(*keys, F.col("c1").alias("a"), F.col("c2").alias("b"))


def spatial_components(df: DataFrame, keys: list[str], id_col: str, radius: float, strict: bool = False) -> DataFrame:
    """Single-linkage groups: (keys, id, comp), comp = smallest id of the group; singletons included.

    Points of one small cell are always linked, so the graph is built over occupied cells,
    not over points. Two cells are linked when any of their points are close enough; equal
    positions are merged first.
    """
    edge = chord(radius) / math.sqrt(3.0) * (1 - 1e-9)
    pts = with_cell(df.select(*keys, F.col(id_col).alias("id"), "yaw", "pitch"), edge)
    spots = pts.groupBy(*keys, *CELL, "yaw", "pitch").agg(F.min("id").alias("spot"))
    cells = spots.groupBy(*keys, *CELL).agg(F.min("spot").alias("cell_id"))
    pairs = near_join(cells.withColumnRenamed("cell_id", "c1"), cells.withColumnRenamed("cell_id", "c2"), keys, 2, half=True).select(*keys, "c1", "c2")
    members = spots.join(shuffled(cells), [*keys, *CELL]).select(*keys, "cell_id", "yaw", "pitch")
    links = _cell_links(pairs, members, keys, edge / SUBCELLS, radius, strict)
    comp = connected_components(links, keys).withColumnRenamed("node", "cell_id")
    labelled = cells.join(shuffled(comp), [*keys, "cell_id"], "left").withColumn("comp", F.coalesce("comp", "cell_id"))
    return pts.join(shuffled(labelled), [*keys, *CELL]).select(*keys, F.col("id").alias(id_col), "comp")


REGION_EDGE = chord(6.0)


def region_index(regions: DataFrame, keys: list[str], reach: Column, fields: list[str], edge: float = REGION_EDGE) -> DataFrame:
    """(keys, cell) -> array of the regions whose cap of angle ``reach`` may touch the cell.

    Regions of a clip do not overlap in centre, so the array per cell stays short however
    many detections fall into it.
    """
    r = regions.withColumn("_chord", geo.lit(2.0) * F.sin(F.radians(F.least(reach, geo.lit(180.0))) / 2.0))
    axes = {"cx": geo.unit_x("centre_yaw", "centre_pitch"), "cy": geo.unit_y("centre_pitch"), "cz": geo.unit_z("centre_yaw", "centre_pitch")}
    for c, v in axes.items():
        lo = F.floor((v - F.col("_chord")) / geo.lit(edge)).cast("int")
        hi = F.floor((v + F.col("_chord")) / geo.lit(edge)).cast("int")
        r = r.withColumn(f"_{c}", v).withColumn(c, F.explode(F.sequence(lo, hi)))
    # drop cells that the ball misses
    gap = sum(
        F.pow(F.greatest(F.col(c) * geo.lit(edge) - F.col(f"_{c}"), F.col(f"_{c}") - (F.col(c) + 1) * geo.lit(edge), geo.lit(0.0)), geo.lit(2.0))
        for c in CELL
    )
    r = r.filter(F.sqrt(gap) <= F.col("_chord") + geo.lit(1e-9))
    return r.groupBy(*keys, *CELL).agg(F.collect_list(F.struct(*fields)).alias("regions"))


def attach_regions(df: DataFrame, index: DataFrame, keys: list[str], edge: float = REGION_EDGE) -> DataFrame:
    """Left join on (keys, cell). Each row meets one index row, so nothing multiplies."""
    return with_cell(df, edge).join(index, [*keys, *CELL], "left").drop(*CELL)


def region_distances(regions: str = "regions", yaw: str = "yaw", pitch: str = "pitch") -> Column:
    return F.transform(
        F.coalesce(F.col(regions), F.array().cast("array<struct<region_rank:int,label:string,centre_yaw:double,centre_pitch:double,radius_deg:double,peak_duty:double>>")),
        lambda r: F.struct(
            geo.angular_distance(yaw, pitch, r["centre_yaw"], r["centre_pitch"]).alias("dist"),
            r["region_rank"].alias("region_rank"), r["label"].alias("label"),
            r["radius_deg"].alias("radius_deg"), r["peak_duty"].alias("peak_duty"),
        ),
    )


def nearest_within(points: DataFrame, centres: DataFrame, keys: list[str], radius_col: str, label: str) -> DataFrame:
    """Each point with the closest centre whose own radius contains it (left join)."""
    idx = region_index(
        centres, keys, F.col(radius_col), [label, "centre_yaw", "centre_pitch", radius_col]
    )
    joined = attach_regions(points, idx, keys)
    d = F.transform(
        "regions",
        lambda r: F.struct(
            geo.angular_distance("yaw", "pitch", r["centre_yaw"], r["centre_pitch"]).alias("dist"),
            r[label].alias("label"), r[radius_col].alias("radius"),
        ),
    )
    hit = F.array_min(F.filter(d, lambda x: geo.within(x["dist"], x["radius"])))
    return joined.withColumn("_hit", hit).withColumn("match", F.col("_hit.label")).withColumn(
        "match_dist", F.col("_hit.dist")).withColumn("match_radius", F.col("_hit.radius")).drop("_hit", "regions")


def greedy_nms(
    df: DataFrame, keys: list[str], score: str, tie: str, radius: float, inclusive_keep: bool = False, fold_limit: int = 256
) -> DataFrame:
    """Greedy suppression per key: best score first, keep what is farther than ``radius``
    from everything kept (``inclusive_keep`` also keeps exact ties).

    Small frames fold over their sorted array. Frames above ``fold_limit`` rows are solved
    by rounds of cell maxima, so no group is ever gathered. Both ways follow one order: a null
    score comes last, then the smaller ``tie``, a null tie last, then the row itself; rows equal
    in all of that are interchangeable. Null keys are a frame of their own; a row without a
    direction suppresses nothing and is kept.
    """
    lost = F.col("yaw").isNull() | F.col("pitch").isNull()
    placeless, df = df.filter(lost), df.filter(~lost)
    return _nms(df, keys, score, tie, radius, inclusive_keep, fold_limit).unionByName(placeless)


def _nms_order(df: DataFrame, keys: list[str], score: str, tie: str) -> Column:
    """Grows from the best row to the worst."""
    rest = F.struct(*[c for c in df.columns if c not in keys])
    return F.struct(F.col(score).isNull().alias("a"), (-F.col(score)).alias("b"), F.col(tie).isNull().alias("c"), F.col(tie).alias("d"), F.xxhash64(rest).alias("e"))


def _nms(df, keys, score, tie, radius, inclusive_keep, fold_limit):
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    big_keys = sizes.filter(F.col("_n") > fold_limit).select(*keys)
    has_big = not big_keys.isEmpty()
    small = null_safe_join(df, big_keys, keys, "left_anti") if has_big else df

    rest = [c for c in df.columns if c not in keys]
    item = F.struct(_nms_order(df, keys, score, tie).alias("rank"), F.struct(*rest).alias("row"))
    sorted_items = F.array_sort(F.collect_list(item))

    def far(kept, x):
        d = lambda k: geo.angular_distance(x["row"]["yaw"], x["row"]["pitch"], k["row"]["yaw"], k["row"]["pitch"])
        bad = lambda k: geo.within(d(k), radius, strict=inclusive_keep)
        return ~F.exists(kept, bad)

    folded = (
        small.groupBy(*keys)
        .agg(sorted_items.alias("_items"))
        .select(
            *keys,
            F.explode(F.aggregate("_items", F.slice("_items", 1, 0), lambda kept, x: F.when(far(kept, x), F.concat(kept, F.array(x))).otherwise(kept))).alias("_k"),
        )
        .select(*keys, "_k.row.*")
        .select(*df.columns)
    )
    if not has_big:
        return folded
    return folded.unionByName(_nms_rounds(null_safe_join(df, big_keys, keys, "left_semi"), keys, score, tie, radius, inclusive_keep))


def _nms_rounds(df, keys, score, tie, radius, inclusive_keep):
    edge = chord(radius) * (1 + 1e-9)
    # equal rows must differ, or each would wait for the other
    twin = W.partitionBy(*keys, *CELL, "_rank").orderBy("_rank")
    left = with_cell(df, edge).withColumn("_rank", _nms_order(df, keys, score, tie))
    left = cut(left.withColumn("_rank", F.struct("_rank", F.row_number().over(twin).alias("f"))))
    kept = None
    payload = [c for c in df.columns if c not in keys]
    while not left.isEmpty():
        tops = left.groupBy(*keys, *CELL).agg(F.min("_rank").alias("top"), F.min_by(F.struct(*payload), "_rank").alias("row"))
        around = shift_cells(tops.select(*keys, *CELL, F.col("top").alias("near")), 1)
        best = around.groupBy(*keys, *CELL).agg(F.min("near").alias("near"))
        winners = cut(null_safe_join(tops, best, [*keys, *CELL]).filter(F.col("top") <= F.col("near")).select(*keys, *CELL, "top", "row"))
        new = winners.select(*keys, "row.*").select(*df.columns)
        kept = new if kept is None else kept.unionByName(new)
        caps = shift_cells(winners.select(*keys, *CELL, F.col("row.yaw").alias("ky"), F.col("row.pitch").alias("kp")), 1)
        caps = caps.groupBy(*keys, *CELL).agg(F.collect_list(F.struct("ky", "kp")).alias("caps"))
        hit = lambda k: geo.within(geo.angular_distance("yaw", "pitch", k["ky"], k["kp"]), radius, strict=inclusive_keep)
        own = winners.select(*keys, *CELL, F.col("top").alias("won"))
        left = null_safe_join(left, caps, [*keys, *CELL], "left").filter(~F.coalesce(F.exists("caps", hit), F.lit(False))).drop("caps")
        # a kept row is done even where a distance of zero does not suppress (radius 0, exact ties kept)
        left = cut(null_safe_join(left, own, [*keys, *CELL], "left").filter(~F.coalesce(F.col("_rank") == F.col("won"), F.lit(False))).drop("won"))
    return kept if kept is not None else df
