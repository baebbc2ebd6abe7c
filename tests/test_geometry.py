"""Overlay against clipped triangles, outlines of dissolved blocks against flood fill, points and polygons."""

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from apportion.operators import geo

from .plain_geometry import intersection_area as plain_area


def ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def square(x, y, w, h=None):
    h = w if h is None else h
    return ring([(x, y), (x, y + h), (x + w, y + h), (x + w, y), (x, y)])


def blob(r, n, x, y, size, rough=0.3):
    angle, far = np.sort(r.uniform(0, 2 * math.pi, n)), size * (1 - rough * r.uniform(0, 1, n))
    return list(zip(x + far * np.cos(angle), y + far * np.sin(angle), strict=True))


@pytest.mark.parametrize("cell", [None, 0.37, 1.0, 100.0])
def test_common_area_of_random_outlines(cell):
    r = np.random.default_rng(1)
    for k in range(60):
        a = [ring(blob(r, r.integers(3, 30), *r.uniform(-3, 3, 2), r.uniform(0.5, 4)))]
        if k % 3 == 0:
            a.append(ring(blob(r, 8, *[np.mean([p[c] for p in a[0]]) for c in "xy"], 0.15)[::-1]))
        b = [ring(blob(r, r.integers(3, 30), *r.uniform(-3, 3, 2), r.uniform(0.5, 4))[::-1])]
        if k % 4 == 0:
            b.append(ring(blob(r, 7, 20, 20, 1)[::-1]))
        assert geo.intersection_area(a, b, cell) == pytest.approx(plain_area(a, b), abs=1e-9)


def test_edges_on_the_grid_and_neighbours():
    for cell in (1.0, 2.0, 4.0, 0.5):
        assert geo.intersection_area([square(0, 0, 4)], [square(2, 2, 4)], cell) == 4
        assert geo.intersection_area([square(0, 0, 4)], [square(4, 0, 4)], cell) == 0
        assert geo.intersection_area([square(0, 0, 4)], [square(0, 4, 4)], cell) == 0
        assert geo.intersection_area([square(0, 0, 4)], [square(0, 0, 4)], cell) == 16
    assert geo.intersection_area([], [square(0, 0, 1)]) == 0 and list(geo.pieces(None, 1.0)) == [] and geo.intersection_area([ring([(0, 0), (1, 1), (0, 0)])], [square(0, 0, 1)], 1.0) == 0
    slant = [ring([(0, 0), (3, 1), (4, 5), (1, 4)])]
    other = [ring([(3, 1), (7, 0), (8, 6), (4, 5)])]  # shares an edge with it
    assert geo.intersection_area(slant, other, 0.7) == 0


def test_long_outlines_are_quick():
    r = np.random.default_rng(2)
    a, b = ([ring(blob(r, n, 0, 0, 10, 0.02))] for n in (1_000, 20_000))
    began = time.time()
    geo.intersection_area(a, b)
    assert time.time() - began < 1


def test_a_cell_within_has_one_edge():
    cells = {(x, y): e for x, y, e in geo.pieces([ring(blob(np.random.default_rng(3), 500, 0, 0, 10, 0.05))], 1.0)}
    assert len(cells[0, 0]) == 1 and cells[0, 0].tolist() == [[0.0, 1.0, 1.0, 1.0, 1.0]]
    assert sum(len(e) for e in cells.values()) < 2_500


@pytest.mark.parametrize("cell", [None, 0.7])
def test_overlay_of_layers(spark, cell):
    r = np.random.default_rng(4)
    left = [(k, [ring(blob(r, 12, k % 5, k // 5, 0.8))]) for k in range(25)] + [(99, []), (98, None)]
    right = [(f"d{k}", [ring(blob(r, 60, *r.uniform(0, 5, 2), 2))]) for k in range(4)]
    frames = [spark.createDataFrame(rows, f"id {kind}, rings {geo.RINGS}") for rows, kind in ((left, "long"), (right, "string"))]
    got = {(x["left_id"], x["right_id"]): x["area"] for x in geo.overlay(*frames, cell).collect()}
    want = {(i, j): s for i, a in left for j, b in right if a and (s := plain_area(a, b)) > 1e-9}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    assert geo.overlay(frames[0].where("false"), frames[1], 1.0).count() == 0


@pytest.mark.parametrize("turned", [False, True])
def test_equal_outlines_are_compared_once(spark, tmp_path, monkeypatch, turned):
    r = np.random.default_rng(5)
    shapes = [[ring(blob(r, 9, x, 0, 1))] for x in (0, 0.5, 1, 1.5)]
    left = [(k, shapes[k % 3]) for k in range(60)]
    right = [(k % 7, shapes[1 + k % 3]) for k in range(90)] + [(0, shapes[1])]  # ids that come with several outlines, and twice with one
    want = {}
    for i, a in left:
        for j, b in right:
            want[i, j] = want.get((i, j), 0) + plain_area(a, b)
    whole = geo.common_areas

    def counted(a, b):
        with open(tmp_path / "seen", "a") as f:
            f.write(f"{len(a)}\n")
        return whole(a, b)

    monkeypatch.setattr(geo, "common_areas", counted)
    frames = [spark.createDataFrame(rows, f"id long, rings {geo.RINGS}") for rows in (left, right)]
    got = geo.overlay(*(frames[::-1] if turned else frames), 10.0).collect()
    assert len(got) == len(want) and all(x["area"] == pytest.approx(want[(x["right_id"], x["left_id"]) if turned else (x["left_id"], x["right_id"])], abs=1e-9) for x in got)
    # Outlines fall into four cells at most, and each pair is looked at once.
    assert sum(map(int, (tmp_path / "seen").read_text().split())) <= 9 * 4


def components(cells, steps):
    left, n = set(cells), 0
    while left:
        n, todo = n + 1, [left.pop()]
        while todo:
            x, y = todo.pop()
            for dx, dy in steps:
                if (x + dx, y + dy) in left:
                    left.remove((x + dx, y + dy))
                    todo.append((x + dx, y + dy))
    return n


def test_outlines_of_dissolved_blocks(spark):
    r = random.Random(6)
    own = {(x, y): r.choice("aab") for x in range(9) for y in range(9) if r.random() < 0.8}
    own |= {(x, 30): "long" for x in range(70)}  # a ring of 142 edges
    rows = [(k, None if k == "b" else 1, [square(x, y, 1) if (x + y) % 2 else square(x, y, 1)[::-1]]) for (x, y), k in own.items()]
    got = {x["key"]: x["rings"] for x in geo.dissolve(spark.createDataFrame(rows, f"key string, other int, rings {geo.RINGS}").repartition(5), "key", "other").collect()}
    four, eight = [(0, 1), (1, 0), (0, -1), (-1, 0)], [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    assert set(got) == {"a", "b", "long"}
    for key, rings in got.items():
        cells = {c for c, k in own.items() if k == key}
        areas = [sum(p["x"] * q["y"] - q["x"] * p["y"] for p, q in zip(x, x[1:], strict=False)) / 2 for x in rings]
        assert sum(areas) == len(cells) and all(x[0] == x[-1] for x in rings)
        assert sum(len(x) - 1 for x in rings) == sum((x + a, y + b) not in cells for x, y in cells for a, b in four)
        around = {(x, y) for x in range(-1, 72) for y in range(-1, 32)} - cells
        assert sum(a > 0 for a in areas) == components(cells, four)
        assert sum(a < 0 for a in areas) == components(around, eight) - 1
    assert geo.dissolve(spark.createDataFrame([("a", [])], f"key string, rings {geo.RINGS}"), "key").count() == 0


def test_dissolved_blocks_with_holes_and_islands(spark):
    frame = [square(0, 0, 9), square(3, 3, 3)[::-1]]
    rows = [("k", frame), ("k", [square(4, 4, 1)]), ("k", [square(9, 0, 2, 9)])]
    (got,) = geo.dissolve(spark.createDataFrame(rows, f"key string, rings {geo.RINGS}"), "key").select("key", geo.area(F.col("rings")).alias("area"), F.size("rings").alias("n"), geo.polygons(F.col("rings")).alias("polygons")).collect()
    # The strip's corners are not all the frame's: its border runs there and back, or is gone, but areas hold.
    assert (got["key"], got["area"]) == ("k", 81 - 9 + 1 + 18)
    assert sorted(len(p) for p in got["polygons"]) == [1, 2]


def test_polygons_of_rings(spark):
    outer, hole, island, hole2 = square(0, 0, 10), square(1, 1, 8)[::-1], square(2, 2, 4), square(3, 3, 1)[::-1]
    for rings, want in (([outer], [[outer]]), ([hole, outer], [[outer, hole]]), ([outer, hole, island, hole2], [[outer, hole], [island, hole2]]), ([outer, square(20, 0, 1)], [[outer], [square(20, 0, 1)]]), ([], [])):
        got = spark.createDataFrame([(rings,)], f"rings {geo.RINGS}").select(geo.polygons(F.col("rings")).alias("p")).first()["p"]
        assert [[[x.asDict() for x in r] for r in p] for p in got] == want


def test_inner_points_of_any_outline(spark):
    r = np.random.default_rng(7)
    shapes = [[square(0, 0, 1), square(0, 3, 1)], [square(0, 0, 4), square(1, 1, 2)[::-1]], [ring([(0, 0), (4, 2), (0, 4), (3, 2)])], *([ring(blob(r, 20, 0, 0, 3, 0.9))] for _ in range(20))]
    df = spark.createDataFrame(list(enumerate(shapes)), f"id int, rings {geo.RINGS}")
    got = {x["id"]: x["p"] for x in df.select("id", geo.inner_point(F.col("rings")).alias("p")).collect()}
    for k, rings in enumerate(shapes):
        crossings = sum((p["y"] <= got[k]["y"]) != (q["y"] <= got[k]["y"]) and got[k]["x"] < p["x"] + (got[k]["y"] - p["y"]) * (q["x"] - p["x"]) / (q["y"] - p["y"]) for x in rings for p, q in zip(x, x[1:] + x[:1], strict=True))
        assert crossings % 2 == 1, k
    flat = spark.createDataFrame([([ring([(0, 0), (1, 0), (2, 0)])],), ([],), (None,)], f"rings {geo.RINGS}")
    assert [x["p"] for x in flat.select(geo.inner_point(F.col("rings")).alias("p")).collect()] == [None] * 3


def test_reference_systems(spark, tmp_path):
    rows = spark.createDataFrame([(1, [square(-77.5, 38.5, 0.25)])], f"id int, rings {geo.RINGS}")
    a, b = geo.with_crs(rows, "EPSG:4269"), geo.to_crs(geo.with_crs(rows, "EPSG:4326"), "EPSG:3857")
    assert (geo.crs_of(rows), geo.crs_of(a.select("rings", "id")), geo.crs_of(b)) == (None, "EPSG:4269", "EPSG:3857")
    back = geo.to_crs(b, "EPSG:4269").first()["rings"]
    assert all(p["x"] == pytest.approx(q["x"], abs=1e-11) and p["y"] == pytest.approx(q["y"], abs=1e-11) for p, q in zip(back[0], rows.first()["rings"][0], strict=True))
    # Layers of two systems are aligned; one that has none beside one that has is an error.
    assert geo.overlay(a, b, 0.1).first()["area"] == pytest.approx(0.0625, abs=1e-9)
    with pytest.raises(ValueError, match="only one"):
        geo.overlay(a, rows, 0.1)
    with pytest.raises(ValueError, match="not known"):
        geo.to_crs(rows, "EPSG:3857")
    with pytest.raises(ValueError, match="unknown"):
        geo.with_crs(rows, "EPSG:1")


def test_datum_shift(spark):
    def moved(shift, lon=-77.0, lat=38.0):
        return spark.range(1).select(*[c.alias(n) for c, n in zip(geo.helmert(F.lit(lon), F.lit(lat), shift), "xy", strict=True)]).first()

    same = moved(geo.NO_SHIFT)
    assert (same["x"], same["y"]) == (pytest.approx(-77, abs=1e-11), pytest.approx(38, abs=1e-10))
    # On the equator a metre along z is a metre north; a turn about z of one second is one second east; a stretch changes nothing.
    north, east, far = moved((0, 0, 1, 0, 0, 0, 0), 0.0, 0.0), moved((0, 0, 0, 0, 0, 1, 0)), moved((0, 0, 0, 0, 0, 0, 5))
    a, f = geo.ELLIPSOID
    assert north["y"] == pytest.approx(math.degrees(1 / (a * (1 - f * (2 - f)))), rel=1e-4) and east["x"] == pytest.approx(-77 + 1 / 3600, abs=1e-10)
    assert (far["x"], far["y"]) == (pytest.approx(-77, abs=1e-10), pytest.approx(38, abs=1e-6))
    layer = geo.with_crs(spark.createDataFrame([([square(0, 0, 1)],)], f"rings {geo.RINGS}"), "EPSG:4269")
    assert geo.to_crs(layer, "EPSG:4326", (0, 0, 1, 0, 0, 0, 0)).first()["rings"][0][0]["y"] == pytest.approx(north["y"], abs=1e-9)


def test_inner_points_of_many_outlines_are_quick(spark):
    n = 100_000
    df = spark.range(n).select("id", F.array(F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.struct((F.col("id") + F.cos(i * math.pi / 6)).alias("x"), F.sin(i * math.pi / 6).alias("y")))).alias("rings"))
    began = time.time()
    own = df.withColumn("p", geo.inner_point(F.col("rings"))).agg(F.max(F.abs(F.expr("p.x - id"))), F.max(F.abs(F.col("p.y"))), F.count("p")).first()
    assert own[0] < 1e-9 and own[1] < 1e-9 and own[2] == n
    assert time.time() - began < 20


def test_inner_points_of_slices_and_nulls():
    import pyarrow as pa

    kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
    shapes = [[square(9, 9, 1)], None, [], [square(0, 0, 2)], [ring([(5, 5)]), square(0, 0, 4)], [square(0, 0, 1), square(7, 0, 3)]]
    got = geo.inner_points(pa.array(shapes, kind).slice(1)).to_pylist()
    assert got == [None, None, {"x": 1.0, "y": 1.0}, {"x": 2.0, "y": 2.5}, {"x": 8.5, "y": 1.5}]
