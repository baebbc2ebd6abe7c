"""Plane geometry for crosswalks: projection, areas, and areas of intersection between two polygon layers.

Layers are (id, rings): rings are arrays of (x, y) points, holes wound the other way. Outlines are cut to the cells of a grid,
pieces meet in an equi-join on cells, and the area that two of a cell share is exact: the signed sum, over pairs of edges that share
a range of x, of what lies below both, in arrays. Its work grows with the edges of a cell, not with the product of two outlines.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportion.functions.settle import settle

RADIUS = 6_378_137.0
RINGS = "array<array<struct<x: double, y: double>>>"


def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * RADIUS


def mercator_y(lat: Column) -> Column:
    return F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * RADIUS


def project(rings: Column) -> Column:
    """Rings of longitudes and latitudes in web Mercator metres."""
    return F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(mercator_x(p["x"]).alias("x"), mercator_y(p["y"]).alias("y"))))


def longitude(x: Column) -> Column:
    return F.degrees(x / RADIUS)


def latitude(y: Column) -> Column:
    return F.degrees(2 * F.atan(F.exp(y / RADIUS)) - math.pi / 2)


GEOGRAPHIC = ("EPSG:4326", "EPSG:4269")
MERCATOR = "EPSG:3857"
ELLIPSOID = (6_378_137.0, 1 / 298.257222101)
"""Half axis and flattening."""
NO_SHIFT = (0.0,) * 7


def helmert(lon: Column, lat: Column, shift: tuple[float, ...]) -> tuple[Column, Column]:
    """Longitude and latitude in another datum: seven parameters, of which three move (metres), three turn (arc seconds, as
    position vectors) and one stretches (parts in a million); heights are none."""
    a, f = ELLIPSOID
    e2, b = f * (2 - f), a * (1 - f)
    p, q = F.radians(lat), F.radians(lon)
    n = F.lit(a) / F.sqrt(1 - e2 * F.sin(p) * F.sin(p))
    x, y, z = n * F.cos(p) * F.cos(q), n * F.cos(p) * F.sin(q), n * (1 - e2) * F.sin(p)
    tx, ty, tz, *turns, ppm = shift
    rx, ry, rz = (math.radians(t / 3600) for t in turns)
    m = 1 + ppm * 1e-6
    u, v, w = tx + m * (x - rz * y + ry * z), ty + m * (rz * x + y - rx * z), tz + m * (rx * y - ry * x + z)
    flat = F.sqrt(u * u + v * v)
    t = F.atan2(w * a, flat * b)
    second = e2 / (1 - e2)
    return F.degrees(F.atan2(v, u)), F.degrees(F.atan2(w + second * b * F.pow(F.sin(t), 3), flat - e2 * a * F.pow(F.cos(t), 3)))


def with_crs(layer: DataFrame, crs: str) -> DataFrame:
    """The layer with the reference system of its rings in the column's metadata, where spatial joins look for it."""
    if crs not in (*GEOGRAPHIC, MERCATOR):
        raise ValueError(f"unknown reference system {crs!r}")
    return layer.withMetadata("rings", {**layer.schema["rings"].metadata, "crs": crs})


def crs_of(layer: DataFrame) -> str | None:
    return layer.schema["rings"].metadata.get("crs")


def to_crs(layer: DataFrame, crs: str, shift: tuple[float, ...] = NO_SHIFT) -> DataFrame:
    """The layer in another reference system. `shift` takes coordinates of the one datum to the other; published default is none, as the
    two geographic systems differ by less than a metre or two."""
    own = crs_of(layer)
    if own is None:
        raise ValueError("the layer's reference system is not known; name it by with_crs()")
    moves = own != crs and any(shift)
    if own == crs or (own in GEOGRAPHIC and crs in GEOGRAPHIC and not moves):
        return with_crs(layer, crs)

    def moved(p):
        lon, lat = (longitude(p["x"]), latitude(p["y"])) if own == MERCATOR else (p["x"], p["y"])
        lon, lat = helmert(lon, lat, shift) if moves else (lon, lat)
        x, y = (mercator_x(lon), mercator_y(lat)) if crs == MERCATOR else (lon, lat)
        return F.struct(x.alias("x"), y.alias("y"))

    return with_crs(layer.withColumn("rings", F.transform("rings", lambda r: F.transform(r, moved))), crs)


def aligned(left: DataFrame, right: DataFrame) -> DataFrame:
    """right in left's reference system; ValueError if only one of them is known. Layers without any are taken as they are."""
    a, b = crs_of(left), crs_of(right)
    if (a is None) != (b is None):
        raise ValueError(f"only one layer has a reference system: {a or b}")
    return right if a == b else to_crs(right, a)


def signed_ring(r: Column) -> Column:
    """Area of a ring by the shoelace formula, closed or not: above zero if it is wound to the left."""
    index = F.sequence(F.lit(1), F.size(r))
    return F.aggregate(index, F.lit(0.0), lambda s, i: s + F.element_at(r, i)["x"] * F.element_at(r, i % F.size(r) + 1)["y"] - F.element_at(r, i % F.size(r) + 1)["x"] * F.element_at(r, i)["y"]) / 2


def signed_area(rings: Column) -> Column:
    return F.aggregate(rings, F.lit(0.0), lambda s, r: s + F.when(F.size(r) > 2, signed_ring(r)).otherwise(0.0))


def area(rings: Column) -> Column:
    """Area of a polygon; holes count against it by their winding."""
    return F.abs(signed_area(rings))


def bounds(rings: Column) -> Column:
    points = F.flatten(rings)
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def _edges(rings) -> np.ndarray:
    """Edges of all rings as columns x0, y0, x1, y1, sign, from left to right; upright ones go. The signed areas below them
    add up to the polygon, whichever way it is wound."""
    parts = []
    for r in rings if rings is not None else ():
        if len(r) > 2:
            p = np.array([(q["x"], q["y"]) for q in r], dtype=float)
            parts.append(np.column_stack([p, np.roll(p, -1, axis=0)]))
    if not parts:
        return np.zeros((0, 5))
    e = np.concatenate(parts)
    e = e[e[:, 0] != e[:, 2]]
    back = e[:, 0] > e[:, 2]
    e[back] = e[back][:, [2, 3, 0, 1]]
    sign = np.where(back, -1.0, 1.0)
    base = e[:, 1].min(initial=np.inf)
    total = (sign * (e[:, 2] - e[:, 0]) * ((e[:, 1] - base) + (e[:, 3] - base))).sum()
    return np.column_stack([e, sign if total >= 0 else -sign])


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row once for each whole number from its first to its last: the row, and the number."""
    n = (last - first + 1).astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    return row, first[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)


def pieces(rings, cell: float):
    """(cx, cy, edges) of the polygon's part in each grid cell that it meets, edges as rows x0, y0, x1, y1, sign.

    Heights are above the cell's lower side. What of the outline lies above a cell bounds it by its upper side: such edges
    are one flat each, joined where they follow each other, so a cell within the polygon has one edge. Points where
    edges cross the grid depend on the edge alone: equal edges of two polygons are cut alike.
    """
    e = _edges(rings)
    if not len(e):
        return
    slope = (e[:, 3] - e[:, 1]) / (e[:, 2] - e[:, 0])

    def height(row, x):
        # Ends are as they were.
        return np.where(x == e[row, 0], e[row, 1], np.where(x == e[row, 2], e[row, 3], e[row, 1] + (x - e[row, 0]) * slope[row]))

    last = np.ceil(e[:, 2] / cell) - 1
    row, cx = _spread(np.floor(e[:, 0] / cell), np.maximum(last, np.floor(e[:, 0] / cell)))
    x0, x1 = np.maximum(e[row, 0], cx * cell), np.minimum(e[row, 2], (cx + 1) * cell)
    y0, y1 = height(row, x0), height(row, x1)
    # Each is cut again where it passes from one row of cells to another.
    part, cy = _spread(np.floor(np.minimum(y0, y1) / cell), np.floor(np.maximum(y0, y1) / cell))
    own, rising = row[part], y1[part] >= y0[part]

    def place(level):
        """Where an edge reaches the height of a row of cells, within its column."""
        with np.errstate(divide="ignore", invalid="ignore"):
            x = e[own, 0] + (level * cell - e[own, 1]) / slope[own]
        return np.where(np.isfinite(x), np.clip(x, x0[part], x1[part]), x0[part])

    enters, leaves = place(np.where(rising, cy, cy + 1)), place(np.where(rising, cy + 1, cy))
    lowest, highest = np.floor(np.minimum(y0, y1) / cell)[part], np.floor(np.maximum(y0, y1) / cell)[part]
    a = np.where(cy == np.where(rising, lowest, highest), x0[part], enters)
    b = np.where(cy == np.where(rising, highest, lowest), x1[part], leaves)
    ya, yb = (np.clip(height(own, x) - cy * cell, 0.0, cell) for x in (a, b))
    cut = np.column_stack([a, ya, b, yb, e[own, 4]])
    cx = cx[part]
    order = np.lexsort((-cy, cx))
    order = order[(b > a)[order]]
    cut, cx, cy = cut[order], cx[order].astype(np.int64), cy[order].astype(np.int64)
    column = np.flatnonzero(np.diff(cx, prepend=np.iinfo(np.int64).min))
    for c0, c1 in zip(column, np.append(column[1:], len(cx)), strict=True):
        # From the top of the column down; `above` has where the winding of what lies above changes, and by how much.
        above: dict[float, float] = {}
        rows = c0 + np.flatnonzero(np.diff(cy[c0:c1], prepend=np.iinfo(np.int64).max))
        at = int(cy[c0])
        for r0, r1 in zip(rows, np.append(rows[1:], c1), strict=True):
            while at > cy[r0]:
                if above:
                    yield int(cx[c0]), at, _flats(above, cell)
                at -= 1
            yield int(cx[c0]), at, np.concatenate([cut[r0:r1], _flats(above, cell)])
            for x, s in [*zip(cut[r0:r1, 0].tolist(), cut[r0:r1, 4].tolist(), strict=True), *zip(cut[r0:r1, 2].tolist(), (-cut[r0:r1, 4]).tolist(), strict=True)]:
                if total := above.get(x, 0.0) + s:
                    above[x] = total
                else:
                    del above[x]
            at -= 1


def _flats(above: dict[float, float], cell: float) -> np.ndarray:
    if not above:
        return np.zeros((0, 5))
    x = np.array(sorted(above))
    sign = np.cumsum([above[v] for v in x.tolist()])[:-1]
    full = np.full(len(x) - 1, cell)
    return np.column_stack([x[:-1], full, x[1:], full, sign])[sign != 0]


PAIRS = 1 << 20
"""Pairs of edges that are looked at together."""


def common_area(a: np.ndarray, b: np.ndarray) -> float:
    """Area of the intersection of two pieces of a cell: the sum, over pairs of edges that share a range of x, of the area
    below both, with both signs."""
    if not len(a) or not len(b):
        return 0.0
    a, b = a[np.argsort(a[:, 0], kind="stable")], b[np.argsort(b[:, 0], kind="stable")]
    # The right one begins within the left one or where it begins; or the left one begins within the right one.
    i0, i1 = np.searchsorted(b[:, 0], a[:, 0], "left"), np.searchsorted(b[:, 0], a[:, 2], "left")
    j0, j1 = np.searchsorted(a[:, 0], b[:, 0], "right"), np.searchsorted(a[:, 0], b[:, 2], "left")
    total = 0.0
    for first, last, turned in ((i0, i1, False), (j0, j1, True)):
        n = np.maximum(last - first, 0)
        ends, at = np.cumsum(n), 0
        while at < len(n):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
            row, other = _spread(first[at:to], first[at:to] + n[at:to] - 1)
            row = row + at
            total += float(_below_both(a[other if turned else row], b[row if turned else other]).sum())
            at = to
    return total


SMALL = 64
"""Pairs of edges up to which two pieces are looked at together with others."""


def common_areas(a: pa.Array, b: pa.Array) -> np.ndarray:
    """common_area() of many pairs of pieces, given as bytes: those of few edges all at once, edge by edge."""
    (own, at), (other, bt) = (_unpacked(x) for x in (a, b))
    n, m = np.diff(at), np.diff(bt)
    out = np.zeros(len(n))
    for k in np.flatnonzero(n * m > SMALL).tolist():
        out[k] = common_area(own[at[k] : at[k + 1]], other[bt[k] : bt[k + 1]])
    few = np.flatnonzero(n * m <= SMALL)
    for part in np.array_split(few, max(1, len(few) * SMALL // PAIRS)):
        size = n[part] * m[part]
        row = np.repeat(np.arange(len(part)), size)
        k = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        e, f = own[at[part][row] + k // m[part][row]], other[bt[part][row] + k % m[part][row]]
        met = np.maximum(e[:, 0], f[:, 0]) < np.minimum(e[:, 2], f[:, 2])
        out[part] = np.bincount(row[met], weights=_below_both(e[met], f[met]), minlength=len(part))
    return out


def _unpacked(x: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Edges of all pieces of an array, and where each begins, with the end of the last."""
    x = x.cast(pa.large_binary())
    _, places, data = x.buffers()
    at = np.frombuffer(places, dtype=np.int64)[x.offset : x.offset + len(x) + 1]
    edges = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return np.frombuffer(edges.tobytes(), dtype=float).reshape(-1, 5), (at - at[0]) // 40


def _below_both(e: np.ndarray, f: np.ndarray) -> np.ndarray:
    left, right = np.maximum(e[:, 0], f[:, 0]), np.minimum(e[:, 2], f[:, 2])

    def height(g, x):
        return g[:, 1] + (x - g[:, 0]) * ((g[:, 3] - g[:, 1]) / (g[:, 2] - g[:, 0]))

    e0, e1, f0, f1 = height(e, left), height(e, right), height(f, left), height(f, right)
    d0, d1 = e0 - f0, e1 - f1
    # The lower of two is their mean less half their distance, which is a trapezoid, or two triangles where they cross.
    size = np.abs(d0) + np.abs(d1)
    apart = np.where(d0 * d1 >= 0, size / 2, (d0 * d0 + d1 * d1) / np.where(size > 0, 2 * size, 1))
    return e[:, 4] * f[:, 4] * (right - left) * ((e0 + e1 + f0 + f1) / 4 - apart / 2)


LEAST = 1e-12
"""Common areas of a smaller part of a cell are taken for rounding."""


def intersection_area(a, b, cell: float | None = None) -> float:
    """Area of the intersection of two polygons, of any shape, given as rings; a sixteenth of the larger extent is the
    cell if none is given."""
    if cell is None:
        points = [(p["x"], p["y"]) for rings in (a, b) for r in rings for p in r]
        cell = float(np.ptp(np.array(points), axis=0).max()) / 16 if points else 1.0
    own = {(x, y): e for x, y, e in pieces(a, cell or 1.0)}
    areas = [common_area(own[x, y], e) for x, y, e in pieces(b, cell or 1.0) if (x, y) in own]
    return sum(s for s in areas if s > LEAST * cell * cell)


def cell_of(layer: DataFrame) -> float:
    """A grid size for a layer: the median of its polygons' larger sides, so most meet a few cells."""
    b = layer.select(bounds(F.col("rings")).alias("b")).where("b.x0 IS NOT NULL")
    side = b.agg(F.percentile_approx(F.greatest(F.expr("b.x1 - b.x0"), F.expr("b.y1 - b.y0")), 0.5)).first()[0]
    return float(side) if side else 1.0


def outlines(layer: DataFrame, side: str) -> tuple[DataFrame, DataFrame, bool]:
    """A layer's distinct outlines (shape, rings), its rows (side_shape, side_id, n) with how often an id has the outline, and
    whether every id has one outline only."""
    own = layer.select("id", "rings").where("rings IS NOT NULL")
    shapes = settle(own.select("rings").distinct().select(F.monotonically_increasing_id().alias("shape"), "rings"))
    members = settle(own.join(shapes, "rings").groupBy(F.col("shape").alias(f"{side}_shape"), F.col("id").alias(f"{side}_id")).agg(F.count("*").alias("n")))
    return shapes, members, members.groupBy(f"{side}_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def overlay(left: DataFrame, right: DataFrame, cell: float | None = None) -> DataFrame:
    """(left_id, right_id, area) of every pair that overlaps; `cell` is the grid's size, that of left's polygons if not given.

    Outlines are cut to cells first, each polygon by itself. Pieces then meet cell by cell, so a pair moves no more of an outline than
    the cells that it shares, and a long outline is the work of as many tasks as it has cells. Equal outlines of a layer are cut and
    compared once, and their rows joined to the areas. A right layer of another reference system is brought to left's.
    """
    right = aligned(left, right)
    cell = cell or cell_of(left)

    def celled(df: DataFrame, side: str) -> DataFrame:
        def batch(cells):
            x, y, shapes, edges = zip(*cells, strict=True)
            ends = (pa.array([f(e) for e in edges], pa.float64()) for f in (lambda e: e[:, 0].min(), lambda e: e[:, 2].max()))
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in (x, y, shapes)), *ends, pa.array([e.tobytes() for e in edges], pa.binary())], names=["cx", "cy", *(f"{side}_{c}" for c in ("shape", "x0", "x1", "edges"))])

        def run(batches):
            # A batch costs as much as many cells, so it holds those of many outlines, or a part of a long one's.
            cells, size = [], 0
            for rows in batches:
                for shape, rings in zip(rows.column(0).to_pylist(), rows.column(1), strict=True):
                    for x, y, edges in pieces(rings.as_py(), cell):
                        cells.append((x, y, shape, edges))
                        size += edges.nbytes
                        if len(cells) == 4096 or size > 1 << 22:
                            yield batch(cells)
                            cells, size = [], 0
            if cells:
                yield batch(cells)

        return df.mapInArrow(run, f"cx long, cy long, {side}_shape long, {side}_x0 double, {side}_x1 double, {side}_edges binary")

    @F.arrow_udf("double")
    def common(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(common_areas(a, b), pa.float64())

    common = common.asNondeterministic()  # else the filter on areas works them out once more
    own, own_rows, own_once = outlines(left, "left")
    other, other_rows, other_once = outlines(right, "right")
    # Outlines are few bytes and much work: their partitions are not to be merged by size. A cell's pieces without a common range
    # of x share no area. An outline's many cells of one edge are small, those of its border are not.
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first, second = (celled(df.repartition(n), side).repartition(n, "cx", "cy") for df, side in ((own, "left"), (other, "right")))
    pairs = first.join(second, ["cx", "cy"]).where("left_x0 < right_x1 AND right_x0 < left_x1")
    areas = pairs.select("left_shape", "right_shape", common("left_edges", "right_edges").alias("area")).where(F.col("area") > LEAST * cell * cell)
    found = areas.groupBy("left_shape", "right_shape").agg(F.sum("area").alias("area"))

    def named(df: DataFrame, rows: DataFrame, side: str, by: str, once: bool) -> DataFrame:
        met = df.join(rows, f"{side}_shape").select(by, f"{side}_id", (F.col("area") * F.col("n")).alias("area"))
        return met if once else met.groupBy(by, f"{side}_id").agg(F.sum("area").alias("area"))

    # Ids with several outlines are added up while the other side is still outlines, not rows.
    if other_once and not own_once:
        return named(named(found, own_rows, "left", "right_shape", own_once), other_rows, "right", "left_id", other_once).select("left_id", "right_id", "area")
    return named(named(found, other_rows, "right", "left_shape", other_once), own_rows, "left", "right_id", own_once).select("left_id", "right_id", "area")


def dissolve(blocks: DataFrame, *keys: str) -> DataFrame:
    """(keys, rings): the outline of all blocks that agree in keys, holes and islands as rings of their own, closed, shells
    wound to the left and holes to the right.

    blocks has keys and rings. Neighbours have the points of their common border in common, as blocks of one layer do:
    edges that two of them run through in opposite directions cancel in one aggregation. What is left is joined to rings
    by doubling: each round every edge learns what the edge twice as far ahead knows, until all edges of a ring know its first
    one and how far ahead it is. Rounds grow with the logarithm of the longest ring; no task holds more than one outline.
    """
    p, q = F.col("e.p"), F.col("e.q")

    def ends(ring):
        at = F.sequence(F.lit(1), F.size(ring))
        return F.transform(at, lambda i: F.struct(F.element_at(ring, i).alias("p"), F.element_at(ring, i % F.size(ring) + 1).alias("q")))

    whole = F.filter(F.coalesce("rings", F.array().cast(RINGS)), lambda r: F.size(r) > 2)
    own = blocks.select(F.struct(*keys).alias("key"), whole.alias("rings")).withColumn("left", signed_area(F.col("rings")) >= 0)
    edges = own.select("key", "left", F.explode(F.flatten(F.transform("rings", ends))).alias("e")).where(p != q)
    turned = edges.select("key", F.when(F.col("left"), p).otherwise(q).alias("p"), F.when(F.col("left"), q).otherwise(p).alias("q"))
    sums = turned.groupBy("key", F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).agg(F.sum(F.when(F.col("p") < F.col("q"), 1).otherwise(-1)).alias("n"))
    border = sums.where("n != 0").select("key", F.when(F.col("n") > 0, F.col("a")).otherwise(F.col("b")).alias("p"), F.when(F.col("n") > 0, F.col("b")).otherwise(F.col("a")).alias("q"))
    border = settle(border.withColumn("id", F.monotonically_increasing_id()))

    # After an edge comes the first one clockwise from where it came: outlines that touch in a point stay apart.
    out = border.select("key", F.col("p").alias("v"), F.col("q").alias("w"), F.col("id").alias("next"))
    turn = F.pmod(F.atan2(F.expr("p.y - v.y"), F.expr("p.x - v.x")) - F.atan2(F.expr("w.y - v.y"), F.expr("w.x - v.x")), F.lit(2 * math.pi))
    met = border.select("key", "p", F.col("q").alias("v"), "id").join(out, ["key", "v"]).withColumn("turn", turn)
    chain = met.groupBy("id").agg(F.min_by("next", F.struct(F.when(F.col("turn") > 1e-12, F.col("turn")).otherwise(2 * math.pi), "next")).alias("next"))
    known = settle(chain.select("id", "next", F.col("id").alias("first"), F.lit(0).cast("long").alias("ahead")))
    reach, changed = 1, True
    while changed:
        there = known.select(F.col("id").alias("next"), F.col("next").alias("__next"), F.col("first").alias("__first"), F.col("ahead").alias("__ahead"))
        nearer = F.col("first") <= F.col("__first")
        step = known.join(there, "next").select("id", F.col("__next").alias("next"), F.least("first", "__first").alias("first"), F.when(nearer, F.col("ahead")).otherwise(F.lit(reach) + F.col("__ahead")).alias("ahead"), (~nearer).alias("changed"))
        known = settle(step)
        changed = bool(known.where("changed").limit(1).collect())
        reach *= 2
    # From a ring's first edge on, those from which it is farthest ahead come first.
    placed = border.join(known.select("id", "first", "ahead"), "id").groupBy("key", "first").agg(F.array_sort(F.collect_list(F.struct(F.when(F.col("ahead") == 0, -1).otherwise(0).alias("o"), (-F.col("ahead")).alias("a"), "p"))).alias("e"))
    ring = F.transform("e", lambda x: x["p"])
    closed = placed.select("key", F.concat(ring, F.slice(ring, 1, 1)).alias("ring"))
    return closed.groupBy("key").agg(F.array_sort(F.collect_list("ring")).alias("rings")).select("key.*", "rings")


def _crossed(ring: Column, x: Column, y: Column) -> Column:
    """Whether a ring holds a point: it crosses the ray to the right of it an odd number of times."""

    def at(inside, i):
        p, q = F.element_at(ring, i), F.element_at(ring, i % F.size(ring) + 1)
        crosses = (p["y"] <= y) != (q["y"] <= y)
        return inside != (crosses & F.coalesce(x < p["x"] + (y - p["y"]) * F.try_divide(q["x"] - p["x"], q["y"] - p["y"]), F.lit(False)))

    return F.aggregate(F.sequence(F.lit(1), F.size(ring)), F.lit(False), at)


def polygons(rings: Column) -> Column:
    """Rings as polygons: each shell with its holes. Shells are wound as the largest ring is; a hole belongs to the smallest
    shell that holds the middle of its first edge."""
    sized = F.transform(F.filter(rings, lambda r: F.size(r) > 2), lambda r: F.struct(signed_ring(r).alias("a"), r.alias("r")))
    largest = F.element_at(F.array_sort(F.transform(sized, lambda s: F.struct((-F.abs(s["a"])).alias("size"), s["a"].alias("a")))), 1)["a"]
    shells = F.filter(sized, lambda s: s["a"] * largest > 0)
    holes = F.filter(sized, lambda s: s["a"] * largest < 0)

    def owner(hole):
        p, q = F.element_at(hole["r"], 1), F.element_at(hole["r"], 2)
        around = F.filter(shells, lambda s: _crossed(s["r"], (p["x"] + q["x"]) / 2, (p["y"] + q["y"]) / 2))
        return F.element_at(F.array_sort(F.transform(around, lambda s: F.struct(F.abs(s["a"]).alias("size"), s["r"].alias("r")))), 1)["r"]

    owned = F.transform(holes, lambda h: F.struct(h["r"].alias("r"), owner(h).alias("shell")))
    return F.when(F.size(sized) > 0, F.transform(shells, lambda s: F.concat(F.array(s["r"]), F.transform(F.filter(owned, lambda h: h["shell"] == s["r"]), lambda h: h["r"])))).otherwise(F.array().cast(f"array<{RINGS}>"))


def inner_point(rings: Column) -> Column:
    """A point (x, y) inside the polygon: the middle of its widest span at half its height or, where nothing lies there, at half the
    height of its steepest edge, beside which there is always something; null for outlines without area."""
    return F.arrow_udf(inner_points, "struct<x: double, y: double>")(rings)


def inner_points(rings: pa.Array) -> pa.Array:
    """inner_point() of all polygons of an array at once: their edges are rows, and what is widest is found by sorting."""
    n = len(rings)
    each = rings.flatten()
    points = each.flatten()
    size = pc.fill_null(pc.list_value_length(each), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    count = pc.fill_null(pc.list_value_length(rings), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    x, y = (pc.struct_field(points, c).to_numpy(zero_copy_only=False).astype(float) for c in ("x", "y"))
    owner = np.repeat(np.arange(n), count)
    low, high = np.full(n, np.inf), np.full(n, -np.inf)
    np.fmin.at(low, np.repeat(owner, size), y)
    np.fmax.at(high, np.repeat(owner, size), y)
    # From each point to the next of its ring, and from the last to the first.
    start = np.cumsum(size) - size
    ring = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(x))
    after = np.where(at + 1 < (start + size)[ring], at + 1, start[ring])
    whole = size[ring] > 2
    of, p, q = owner[ring][whole], at[whole], after[whole]
    px, py, qx, qy = x[p], y[p], x[q], y[q]
    out = np.full((n, 2), np.nan)

    def last_of(of: np.ndarray, *keys: np.ndarray) -> np.ndarray:
        """The row of each polygon that is the greatest by keys, the first key first."""
        order = np.lexsort((*reversed(keys), of))
        return order[np.flatnonzero(np.diff(of[order], append=n))]

    def widest(level: np.ndarray) -> None:
        """Fills in the points of polygons that have none yet."""
        line = level[of]
        met = ((py <= line) != (qy <= line)) & np.isnan(out[of, 0])
        k, cut = of[met], px[met] + (line[met] - py[met]) * ((qx[met] - px[met]) / (qy[met] - py[met]))
        order = np.lexsort((cut, k))
        k, cut = k[order], cut[order]
        first = np.flatnonzero(np.diff(k, prepend=-1))
        place = np.arange(len(k)) - np.repeat(first, np.diff(first, append=len(k)))
        i = np.flatnonzero((place[:-1] % 2 == 0) & (k[:-1] == k[1:]) & (cut[1:] > cut[:-1]))
        k, width, middle = k[i], cut[i + 1] - cut[i], (cut[i + 1] + cut[i]) / 2
        best = last_of(k, width, middle)
        out[k[best], 0], out[k[best], 1] = middle[best], level[k[best]]

    with np.errstate(invalid="ignore"):
        widest((low + high) / 2)
        steepest, height = np.full(n, np.nan), (py + qy) / 2
        best = last_of(of, np.abs(py - qy), height)
        steepest[of[best]] = height[best]
        widest(steepest)
    none = np.isnan(out[:, 0])
    return pa.StructArray.from_arrays([pa.array(out[:, c]) for c in (0, 1)], names=["x", "y"], mask=pa.array(none))


def centroid_layer(precincts: DataFrame) -> DataFrame:
    """Internal point of each precinct where it has one, else a point inside its outline; (id, lon, lat)."""
    own = precincts.select("id", "lon", "lat", inner_point(F.col("rings")).alias("own"))
    return own.select("id", F.coalesce(F.col("lon").try_cast("double"), F.col("own.x")).alias("lon"), F.coalesce(F.col("lat").try_cast("double"), F.col("own.y")).alias("lat"))
