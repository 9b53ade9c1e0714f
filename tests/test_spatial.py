"""Spatial joins against brute force in plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from citypulse.operators import spatial


def polygon(rng, cx, cy, r, n):
    """Star-shaped ring of integer corners."""
    angles = sorted(rng.random() * 2 * math.pi for _ in range(n))
    ring = []
    for a in angles:
        p = (round(cx + math.cos(a) * r * (0.4 + rng.random())), round(cy + math.sin(a) * r * (0.4 + rng.random())))
        if p not in ring:
            ring.append(p)
    return ring


def edges_of(spark, polygons):
    data = [
        (name, *a, *b) for name, ring in polygons.items() for a, b in zip(ring, ring[1:] + ring[:1])
    ]
    return spark.createDataFrame(data, "poly_id string, x1 int, y1 int, x2 int, y2 int")


def side(p, a, b):
    return (b[0] - a[0]) * (p[1] - a[1]) - (p[0] - a[0]) * (b[1] - a[1])


def on_segment(p, a, b):
    return side(p, a, b) == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])


def inside(p, ring):
    odd = False
    for a, b in zip(ring, ring[1:] + ring[:1]):
        if on_segment(p, a, b):
            return True
        if (a[1] > p[1]) != (b[1] > p[1]) and (side(p, a, b) > 0) == (b[1] > a[1]):
            odd = not odd
    return odd


def segments_meet(a, b, c, d):
    s = [side(a, c, d), side(b, c, d), side(c, a, b), side(d, a, b)]
    if s[0] * s[1] < 0 and s[2] * s[3] < 0:
        return True
    return on_segment(a, c, d) or on_segment(b, c, d) or on_segment(c, a, b) or on_segment(d, a, b)


def polygons_meet(p, q):
    pe, qe = list(zip(p, p[1:] + p[:1])), list(zip(q, q[1:] + q[:1]))
    return any(segments_meet(*e, *f) for e in pe for f in qe) or inside(p[0], q) or inside(q[0], p)


def distance(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    t = min(max(((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy), 0), 1)
    return math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy)


def gap(p, q):
    pe, qe = list(zip(p, p[1:] + p[:1])), list(zip(q, q[1:] + q[:1]))
    return min(min(distance(e[0], *f), distance(f[0], *e)) for e in pe for f in qe)


@pytest.fixture(scope="module")
def shapes():
    rng = random.Random(11)
    big = {f"D{i}": polygon(rng, rng.randrange(400), rng.randrange(400), 60, 9) for i in range(8)}
    small = {f"c{i:03d}": polygon(rng, rng.randrange(-100, 900), rng.randrange(-100, 900), 8, 5) for i in range(60)}
    points = [(rng.randrange(-50, 500), rng.randrange(-50, 500)) for _ in range(300)]
    points += [p for ring in big.values() for p in ring] + [points[0]] * 200
    keep = {n: r for n, r in {**big, **small}.items() if len(r) >= 3}
    return {n: r for n, r in keep.items() if n[0] == "D"}, {n: r for n, r in keep.items() if n[0] == "c"}, points


@pytest.mark.parametrize("tile", [7, 50, 1000])
def test_points_in_polygons(spark, shapes, tile):
    big, _, points = shapes
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, x int, y int")
    found = {(r.i, r.grid_id) for r in spatial.locate(df, edges_of(spark, big), tile).collect()}
    expected = set()
    for i, p in enumerate(points):
        hits = [n for n, ring in big.items() if inside(p, ring)]
        expected |= {(i, n) for n in hits} or {(i, None)}
    assert found == expected
    first = {r.i: r.grid_id for r in spatial.locate(df, edges_of(spark, big), tile, ties="first").collect()}
    assert first == {i: min((n for j, n in expected if j == i and n), default=None) for i in range(len(points))}


@pytest.mark.parametrize("tile", [9, 70])
def test_polygons_touch(spark, shapes, tile):
    big, small, _ = shapes
    small = {**small, "within": [(200, 200), (202, 200), (202, 202)], "around": [(-500, -500), (900, -500), (900, 900), (-500, 900)]}
    found = {tuple(r) for r in spatial.polygons_touch(edges_of(spark, small), edges_of(spark, big), tile).collect()}
    assert found == {(s, b) for s, p in small.items() for b, q in big.items() if polygons_meet(p, q)}


def test_nearest_and_districts(spark, shapes):
    big, small, _ = shapes
    small = {**small, "faraway": [(40_000, 40_000), (40_003, 40_000), (40_003, 40_005)]}
    lost = {s: p for s, p in small.items() if not any(polygons_meet(p, q) for q in big.values())}
    assert len(lost) > 10
    found = {r.poly_id: (r.target_id, r.distance) for r in spatial.nearest_polygon(edges_of(spark, lost), edges_of(spark, big)).collect()}
    expected = {s: min((gap(p, q), b) for b, q in big.items()) for s, p in lost.items()}
    assert set(found) == set(expected)
    for s, (d, b) in expected.items():
        assert found[s][1] == pytest.approx(d) and found[s][0] == b
    districts = spatial.assign_districts(edges_of(spark, small), edges_of(spark, big), 40)
    assert {r.poly_id for r in districts.collect()} == set(small)


def test_nearest_tie_goes_to_the_lowest_id(spark):
    targets = {"B": [(10, 0), (12, 0), (12, 2), (10, 2)], "A": [(-12, 0), (-10, 0), (-10, 2), (-12, 2)]}
    middle = {"m": [(-1, 0), (1, 0), (1, 2), (-1, 2)]}
    found = spatial.nearest_polygon(edges_of(spark, middle), edges_of(spark, targets)).collect()
    assert [tuple(r) for r in found] == [("m", "A", 9.0)]


def test_nearest_of_nothing(spark, shapes):
    big, _, _ = shapes
    none = edges_of(spark, big).limit(0)
    assert spatial.nearest_polygon(none, edges_of(spark, big)).count() == 0


def test_grid_arithmetic_equals_polygons(spark):
    rng = random.Random(5)
    cells = [(f"{10_000_000 + i}", i % 6 * 10, i // 6 * 10, i % 6 * 10 + 10, i // 6 * 10 + 10) for i in range(36)]
    grid = spark.createDataFrame(cells, "id string, x0 int, y0 int, x1 int, y1 int")
    points = [(i, rng.randrange(-5, 66), rng.randrange(-5, 66)) for i in range(400)] + [(900, None, 5)]
    df = spark.createDataFrame(points, "i int, x int, y int")
    for ties in ("all", "first"):
        a = spatial.locate_on_grid(df, grid, (0, 0), (10, 10), ties).select("i", "grid_id")
        b = spatial.locate(df, spatial.cell_edges(grid), 15, ties).select("i", "grid_id")
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_within_radius(spark):
    rng = random.Random(9)
    points = [(i, rng.uniform(0, 5000), rng.uniform(0, 5000)) for i in range(500)]
    centres = [(f"c{i}", rng.uniform(0, 5000), rng.uniform(0, 5000)) for i in range(6)] + [("edge", 1000.0, 0.0)]
    df = spark.createDataFrame(points + [(777, 2000.0, 0.0)], "i int, x double, y double")
    found = {tuple(r) for r in spatial.within_radius(df, spark.createDataFrame(centres, "center string, x double, y double"), 1000.0, ["i"]).collect()}
    assert found == {(i, c) for i, x, y in points for c, a, b in centres if math.hypot(x - a, y - b) < 1000.0}


def test_region_filter(spark, shapes):
    big, small, _ = shapes
    found = {r.poly_id for r in spatial.polygons_touching(edges_of(spark, small), edges_of(spark, big), 40).collect()}
    assert found == {s for s, p in small.items() if any(polygons_meet(p, q) for q in big.values())}


def test_rings_become_closed_edges(spark):
    df = spark.createDataFrame([("p", [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0]], [[5.0, 5.0], [6.0, 5.0], [6.0, 6.0], [5.0, 5.0]]])], "id string, rings array<array<array<double>>>")
    edges = spatial.edges_from_rings(df, "id")
    assert edges.count() == 6
    ends = edges.select("ring_no", F.col("x1").alias("x"), F.col("y1").alias("y"))
    starts = edges.select("ring_no", F.col("x2").alias("x"), F.col("y2").alias("y"))
    assert sorted(map(tuple, ends.collect())) == sorted(map(tuple, starts.collect()))


def test_nearest_sees_past_a_long_slanted_edge(spark):
    square = {"s": [(9000.0, 1000.0), (9001.0, 1000.0), (9001.0, 1001.0), (9000.0, 1001.0)]}
    circle = [(9000 + 50 * math.cos(k * math.pi / 200), 500 + 50 * math.sin(k * math.pi / 200)) for k in range(400)]
    targets = {"A": [(0.0, 0.0), (10000.0, 10000.0), (10000.0, 10000.5)], "B": circle}
    def edges(shapes):
        rows = [(name, *p, *q) for name, ring in shapes.items() for p, q in zip(ring, ring[1:] + ring[:1], strict=True)]
        return spark.createDataFrame(rows, "poly_id string, x1 double, y1 double, x2 double, y2 double")

    found = spatial.nearest_polygon(edges(square), edges(targets)).collect()
    assert [(r.target_id, round(r.distance, 6)) for r in found] == [("B", 450.0)]


def test_tiles_of_an_edge_grow_with_its_length(spark):
    edge = spark.createDataFrame([("e", 0.5, 0.5, 1000.5, 800.5)], "poly_id string, x1 double, y1 double, x2 double, y2 double")
    tiles = {(r.tx, r.ty) for r in spatial._edge_tiles(edge, 1.0).collect()}
    passed = {(math.floor(0.5 + 1000 * k / 200000), math.floor(0.5 + 800 * k / 200000)) for k in range(200001)}
    assert passed <= tiles and len(tiles) < 2200


def test_points_on_corners_of_a_grid_in_degrees(spark):
    cells = [(i * 10 + j, 127.5 + 0.01 * i, 34.5 + 0.01 * j, 127.5 + 0.01 * (i + 1), 34.5 + 0.01 * (j + 1)) for i in range(8) for j in range(3)]
    grid = spark.createDataFrame(cells, "id long, x0 double, y0 double, x1 double, y1 double")
    corners = sorted({(c[1], c[2]) for c in cells} | {(c[3], c[4]) for c in cells}) + [(127.535, 34.515), (127.6, 34.5), (127.499, 34.51)]
    points = spark.createDataFrame(corners, "x double, y double")
    for ties in ("all", "first"):
        by_grid = spatial.locate_on_grid(points, grid, (127.5, 34.5), (0.01, 0.01), ties).select("x", "y", "grid_id")
        by_edges = spatial.locate(points, spatial.cell_edges(grid), 0.01, ties).select("x", "y", "grid_id")
        assert sorted(map(str, by_grid.collect())) == sorted(map(str, by_edges.collect()))


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


@pytest.fixture(scope="module")
def mixed():
    """Polygons from a few units to the whole map, one with a thousand short edges, one with a hole."""
    rng = random.Random(21)
    shapes = {f"s{i:02d}": [polygon(rng, rng.randrange(4000), rng.randrange(4000), 6, 5)] for i in range(40)}
    shapes |= {f"m{i:02d}": [polygon(rng, rng.randrange(4000), rng.randrange(4000), 300, 12)] for i in range(6)}
    shapes["map"] = [box(-10, -10, 4100, 4100)]
    shapes["fine"] = [[(round(2000 + 900 * math.cos(k * math.pi / 500)), round(2000 + 700 * math.sin(k * math.pi / 500))) for k in range(1000)]]
    shapes["holed"] = [box(500, 500, 3500, 3600), box(1000, 1000, 3000, 3100)]
    return {n: r for n, r in shapes.items() if all(len(ring) >= 3 for ring in r)}


def edges_of_rings(spark, shapes):
    data = [(n, k, *a, *b) for n, rings in shapes.items() for k, ring in enumerate(rings) for a, b in zip(ring, ring[1:] + ring[:1], strict=True) if a != b]
    return spark.createDataFrame(data, "poly_id string, ring_no int, x1 int, y1 int, x2 int, y2 int")


def in_rings(p, rings):
    edges = [(a, b) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]
    if any(on_segment(p, a, b) for a, b in edges if a != b):
        return True
    return sum((a[1] > p[1]) != (b[1] > p[1]) and (side(p, a, b) > 0) == (b[1] > a[1]) for a, b in edges) % 2 == 1


@pytest.mark.parametrize("tile", [3, 64, 5000])
def test_points_in_polygons_of_all_sizes(spark, mixed, tile):
    rng = random.Random(tile)
    points = {(rng.randrange(-200, 4300), rng.randrange(-200, 4300)) for _ in range(500)}
    points |= {p for n in ("s00", "m00", "map", "holed") for ring in mixed[n] for p in ring} | {(500, 2000), (1000, 2000), (750, 2000), (2000, 2000), (-10, 7)}
    df = spark.createDataFrame(sorted(points), "x int, y int")
    found = {(r.x, r.y, r.poly_id) for r in spatial.points_in_polygons(df, edges_of_rings(spark, mixed), tile).collect()}
    assert found == {(*p, n) for p in points for n, rings in mixed.items() if in_rings(p, rings)}
    assert spatial.points_in_polygons(df, edges_of_rings(spark, mixed).limit(0), tile).count() == 0


@pytest.mark.parametrize("tile", [1, 10, 1000])
def test_cover_grows_with_edges_and_not_with_area(spark, mixed, tile):
    edges = edges_of_rings(spark, {"huge": [box(0, 0, 10_000_000, 10_000_000)], "flat": [box(5, 5, 9_000_000, 8)], **{k: mixed[k] for k in ("fine", "map", "holed")}})
    passed, inner = spatial._cover(edges.join(spatial._shapes(edges, tile).select("poly_id", "level"), "poly_id"), tile)
    sizes = {r.poly_id: r["count"] for r in edges.groupBy("poly_id").count().collect()}
    for rows in (passed, inner):
        for r in rows.groupBy("poly_id").count().collect():
            assert r["count"] <= 60 * sizes[r.poly_id]
    if tile < 1000:
        assert {r.poly_id for r in inner.select("poly_id").distinct().collect()} >= {"huge", "map", "fine"}


def test_polygons_of_all_sizes_touch(spark, mixed):
    shapes = {n: r[0] for n, r in mixed.items() if n not in ("holed", "fine")}
    small, big = {n: p for n, p in shapes.items() if n[0] == "s" or n == "map"}, {n: p for n, p in shapes.items() if n[0] == "m"}
    want = {(s, b) for s, p in small.items() for b, q in big.items() if polygons_meet(p, q)}
    for tile in (2, 50):
        assert {tuple(r) for r in spatial.polygons_touch(edges_of(spark, small), edges_of(spark, big), tile).collect()} == want
        assert {r.poly_id for r in spatial.polygons_touching(edges_of(spark, small), edges_of(spark, {k: big[k] for k in big if k != "map"}), tile).collect()} == {s for s, b in want if b != "map"}


def test_one_wide_lost_cell_leaves_the_others_their_tiles(spark):
    """400 lost cells, 400 targets, and one lost cell as wide as the map: pairs stay linear in both."""
    cells = {f"c{i:03d}": box(i % 20 * 100, i // 20 * 100, i % 20 * 100 + 4, i // 20 * 100 + 4) for i in range(400)}
    targets = {f"t{i:03d}": box(i % 20 * 100 + 30, i // 20 * 100 + 30, i % 20 * 100 + 50, i // 20 * 100 + 50) for i in range(400)}
    wide = {"wide": box(0, -60, 2000, -50)}
    plain = spatial._near_edges(edges_of(spark, cells), edges_of(spark, targets)).count()
    near = spatial._near_edges(edges_of(spark, {**cells, **wide}), edges_of(spark, targets))
    assert near.count() <= plain + 4 * 4 * 400 * 10 and plain <= 400 * 4 * 4 * 60
    found = {r.poly_id: (r.target_id, r.distance) for r in spatial.nearest_polygon(edges_of(spark, {**cells, **wide}), edges_of(spark, targets)).collect()}
    for name, p in {**dict(list(cells.items())[:40]), **wide}.items():
        d, t = min((gap(p, q), t) for t, q in targets.items())
        assert found[name][1] == pytest.approx(d) and found[name][0] == t
    assert len(found) == 401


def test_sides_of_joins_are_dealt_out_whatever_their_files_seem_to_hold(spark):
    """Edges and tiles are listed from small files, so an estimate of a side may be far too low."""
    cells = spark.range(40).select(F.col("id").cast("string").alias("id"), F.col("id").alias("x0"), (F.col("id") * 0).alias("y0"), (F.col("id") + 1).alias("x1"), (F.col("id") * 0 + 1).alias("y1"))
    edges = spatial.cell_edges(cells)
    far = spatial.cell_edges(cells.filter("id = '3'").withColumns({"y0": F.col("y0") + 50, "y1": F.col("y1") + 50}))
    points = cells.select(F.col("x0").alias("x"), F.col("y0").alias("y"))
    made = {
        "locate": spatial.locate(points, edges, 2),
        "grid": spatial.locate_on_grid(points, cells, (0, 0), (1, 1)),
        "touch": spatial.polygons_touch(edges, far, 2),
        "nearest": spatial.nearest_polygon(edges, far),
        "assign": spatial.assign_districts(edges, far, 2),
        "region": spatial.polygons_touching(edges, far, 2),
    }
    assert [n for n, df in made.items() if "Broadcast" in df._jdf.queryExecution().executedPlan().toString()] == []
    assert made["assign"].count() == made["nearest"].count() == 40 and made["touch"].count() == 0


def test_radius_makes_names_distinct_once_for_a_set_of_places(spark):
    at = [(k, k * 37 % 400, k * 53 % 300) for k in range(60)]
    data = at + at[:9] + [(5, 1, 1), (5, 390, 290), (None, 10, 10), (None, 300, 200), (70, None, 4)]
    places = [(f"c{k % 4}", k * 90 % 400, k * 70 % 300) for k in range(12)] + [("c1", 90, 70), (None, 90, 70), ("far", 9000, 9000)]
    points = spark.createDataFrame([(k, None if x is None else float(x), y) for k, x, y in data], "point_id long, x double, y int")
    centres = spark.createDataFrame([(n, float(x), float(y)) for n, x, y in places], "center string, x double, y double")
    found = spatial.within_radius(points, centres, 100.0, ["point_id"])
    want = {(str(k), str(n)) for k, x, y in data for n, cx, cy in places if x is not None and math.hypot(x - cx, y - cy) < 100}
    assert sorted((str(r.point_id), str(r.center)) for r in found.collect()) == sorted(want)
    assert found._jdf.queryExecution().optimizedPlan().toString().startswith("Union"), "not all pairs are made distinct"
