"""Spatial joins, projection, places."""

from pyspark.sql import functions as F

from checks import inputs as I
from checks.registry import query
from citypulse.functions import points as P
from citypulse.operators import spatial

TILE = 20_000
DISTRICT_TILE = 40_000


def _points(spark, sf_dir):
    rows = I.derived(spark, sf_dir, I.POINTS)
    return rows.select("point_id", F.col("lon_u").alias("x"), F.col("lat_u").alias("y"))


def _cells(spark, sf_dir):
    return I.derived(spark, sf_dir, I.CELLS)


def _cell_edges(spark, sf_dir):
    return spatial.cell_edges(_cells(spark, sf_dir))


def _districts(spark, sf_dir):
    rows = I.derived(spark, sf_dir, I.DISTRICT_EDGES)
    return rows.select(
        "poly_id", F.col("ax").alias("x1"), F.col("ay").alias("y1"), F.col("bx").alias("x2"), F.col("by2").alias("y2")
    )


IN_CELL = "p.lon_u BETWEEN c.x0 AND c.x1 AND p.lat_u BETWEEN c.y0 AND c.y1"
ALL_CELLS = f"SELECT p.point_id, c.id AS grid_id FROM ({I.POINTS}) p LEFT JOIN ({I.CELLS}) c ON {IN_CELL}"
FIRST_CELL = f"SELECT point_id, min(grid_id) AS grid_id FROM ({ALL_CELLS}) a GROUP BY point_id"


@query("points_to_grid_cells", ALL_CELLS)
def points_to_grid_cells(spark, sf_dir):
    rows = spatial.locate_on_grid(
        _points(spark, sf_dir), _cells(spark, sf_dir), (127_500_000, 34_600_000), (10_000, 10_000)
    )
    return rows.select("point_id", "grid_id")


@query("points_to_grid_cells_first", FIRST_CELL)
def points_to_grid_cells_first(spark, sf_dir):
    rows = spatial.locate_on_grid(
        _points(spark, sf_dir), _cells(spark, sf_dir), (127_500_000, 34_600_000), (10_000, 10_000), ties="first"
    )
    return rows.select("point_id", "grid_id")


@query("points_to_polygon_cells", ALL_CELLS)
def points_to_polygon_cells(spark, sf_dir):
    rows = spatial.locate(_points(spark, sf_dir), _cell_edges(spark, sf_dir), TILE)
    return rows.select("point_id", "grid_id")


SIDE = "(e.bx - e.ax) * ({y} - e.ay) - ({x} - e.ax) * (e.by2 - e.ay)"


def in_district(x, y):
    side = SIDE.format(x=x, y=y)
    return f"""(count(*) FILTER (WHERE (e.ay <= {y} AND {y} < e.by2 AND {side} > 0) OR (e.by2 <= {y} AND {y} < e.ay AND {side} < 0)) % 2 = 1
  OR bool_or({side} = 0 AND {x} BETWEEN least(e.ax, e.bx) AND greatest(e.ax, e.bx) AND {y} BETWEEN least(e.ay, e.by2) AND greatest(e.ay, e.by2)))"""


@query(
    "points_to_districts",
    f"""
SELECT p.point_id, m.poly_id AS grid_id FROM ({I.POINTS}) p LEFT JOIN (
  SELECT q.point_id, e.poly_id FROM ({I.POINTS}) q CROSS JOIN ({I.DISTRICT_EDGES}) e
  GROUP BY q.point_id, q.lon_u, q.lat_u, e.poly_id HAVING {in_district('q.lon_u', 'q.lat_u')}) m
ON p.point_id = m.point_id""",
)
def points_to_districts(spark, sf_dir):
    rows = spatial.locate(_points(spark, sf_dir), _districts(spark, sf_dir), DISTRICT_TILE)
    return rows.select("point_id", "grid_id")


# Brute force: a cell and a district touch if an edge of one meets an edge of the other, a corner of the
# cell is in the district, or a corner of the district is in the cell.
SEGMENTS_MEET = """(
  ((d1 > 0 AND d2 < 0 OR d1 < 0 AND d2 > 0) AND (d3 > 0 AND d4 < 0 OR d3 < 0 AND d4 > 0))
  OR d1 = 0 AND c.ax BETWEEN least(d.ax, d.bx) AND greatest(d.ax, d.bx) AND c.ay BETWEEN least(d.ay, d.by2) AND greatest(d.ay, d.by2)
  OR d2 = 0 AND c.bx BETWEEN least(d.ax, d.bx) AND greatest(d.ax, d.bx) AND c.by2 BETWEEN least(d.ay, d.by2) AND greatest(d.ay, d.by2)
  OR d3 = 0 AND d.ax BETWEEN least(c.ax, c.bx) AND greatest(c.ax, c.bx) AND d.ay BETWEEN least(c.ay, c.by2) AND greatest(c.ay, c.by2)
  OR d4 = 0 AND d.bx BETWEEN least(c.ax, c.bx) AND greatest(c.ax, c.bx) AND d.by2 BETWEEN least(c.ay, c.by2) AND greatest(c.ay, c.by2))"""


def _turn(e, x, y):
    return f"(({e}.bx - {e}.ax) * ({y} - {e}.ay) - ({x} - {e}.ax) * ({e}.by2 - {e}.ay))"


_MEET = (
    SEGMENTS_MEET.replace("d1", _turn("d", "c.ax", "c.ay"))
    .replace("d2", _turn("d", "c.bx", "c.by2"))
    .replace("d3", _turn("c", "d.ax", "d.ay"))
    .replace("d4", _turn("c", "d.bx", "d.by2"))
)
TOUCH = f"""
SELECT DISTINCT c.poly_id AS left_id, d.poly_id AS right_id FROM ({I.CELL_EDGES}) c JOIN ({I.DISTRICT_EDGES}) d ON {_MEET}
UNION
SELECT left_id, right_id FROM (
  SELECT q.poly_id AS left_id, e.poly_id AS right_id, q.ax AS vx, q.ay AS vy,
    count(*) FILTER (WHERE (e.ay <= q.ay AND q.ay < e.by2 AND {SIDE.format(x='q.ax', y='q.ay')} > 0)
      OR (e.by2 <= q.ay AND q.ay < e.ay AND {SIDE.format(x='q.ax', y='q.ay')} < 0)) AS n
  FROM ({I.CELL_EDGES}) q CROSS JOIN ({I.DISTRICT_EDGES}) e GROUP BY ALL) v WHERE n % 2 = 1
UNION
SELECT c.id, d.poly_id FROM ({I.CELLS}) c JOIN ({I.DISTRICT_EDGES}) d ON d.ax BETWEEN c.x0 AND c.x1 AND d.ay BETWEEN c.y0 AND c.y1"""


@query("cells_touching_districts", TOUCH)
def cells_touching_districts(spark, sf_dir):
    return spatial.polygons_touch(_cell_edges(spark, sf_dir), _districts(spark, sf_dir), TILE)


@query(
    "cells_left_joined_to_districts",
    f"SELECT c.id AS poly_id, t.right_id AS admin_cd FROM ({I.CELLS}) c LEFT JOIN ({TOUCH}) t ON c.id = t.left_id",
)
def cells_left_joined_to_districts(spark, sf_dir):
    pairs = spatial.polygons_touch(_cell_edges(spark, sf_dir), _districts(spark, sf_dir), TILE)
    cells = _cells(spark, sf_dir).select(F.col("id").alias("left_id"))
    return cells.join(pairs, "left_id", "left").select(
        F.col("left_id").alias("poly_id"), F.col("right_id").alias("admin_cd")
    )


def _dist2(px, py, e):
    dx, dy = f"cast({e}.bx - {e}.ax AS double)", f"cast({e}.by2 - {e}.ay AS double)"
    t = f"least(greatest(cast(({px} - {e}.ax) * {dx} + ({py} - {e}.ay) * {dy} AS double) / cast({dx} * {dx} + {dy} * {dy} AS double), 0.0), 1.0)"
    return f"(pow({px} - ({e}.ax + {t} * {dx}), 2) + pow({py} - ({e}.ay + {t} * {dy}), 2))"


NEAREST = f"""
SELECT poly_id, target_id, distance FROM (
  SELECT c.poly_id, d.poly_id AS target_id, round(sqrt(min(least({_dist2('c.ax', 'c.ay', 'd')}, {_dist2('d.ax', 'd.ay', 'c')}))), 3) AS distance,
    row_number() OVER (PARTITION BY c.poly_id ORDER BY min(least({_dist2('c.ax', 'c.ay', 'd')}, {_dist2('d.ax', 'd.ay', 'c')})), d.poly_id) AS rn
  FROM ({I.CELL_EDGES}) c CROSS JOIN ({I.DISTRICT_EDGES}) d
  WHERE c.poly_id NOT IN (SELECT left_id FROM ({TOUCH}) t) GROUP BY c.poly_id, d.poly_id) r WHERE rn = 1"""


@query("nearest_district_of_unmatched_cells", NEAREST)
def nearest_district(spark, sf_dir):
    cells, districts = _cell_edges(spark, sf_dir), _districts(spark, sf_dir)
    pairs = spatial.polygons_touch(cells, districts, TILE)
    lost = cells.join(pairs.select(F.col("left_id").alias("poly_id")), "poly_id", "left_anti")
    return spatial.nearest_polygon(lost, districts).withColumn("distance", F.round("distance", 3))


@query(
    "cells_with_district",
    f"SELECT left_id AS poly_id, right_id AS admin_cd FROM ({TOUCH}) t UNION ALL SELECT poly_id, target_id FROM ({NEAREST}) n",
)
def cells_with_district(spark, sf_dir):
    return spatial.assign_districts(_cell_edges(spark, sf_dir), _districts(spark, sf_dir), TILE)


@query("cells_in_region", f"SELECT DISTINCT left_id AS poly_id FROM ({TOUCH}) t")
def cells_in_region(spark, sf_dir):
    return spatial.polygons_touching(_cell_edges(spark, sf_dir), _districts(spark, sf_dir), TILE)


# The oracle projects with the classic power series in (longitude - central meridian), the library with the
# trigonometric series: the two agree to well under a millimetre in this area.
_A, _F = P.SEMI_MAJOR, P.FLATTENING
_E2 = _F * (2 - _F)
_EP2 = _E2 / (1 - _E2)


def _meridian(phi):
    e2, e4, e6, e8 = _E2, _E2**2, _E2**3, _E2**4
    return (
        f"{_A!r} * ({1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256 - 175 * e8 / 16384!r} * {phi}"
        f" - {3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024 + 105 * e8 / 4096!r} * sin(2 * {phi})"
        f" + {15 * e4 / 256 + 45 * e6 / 1024 + 525 * e8 / 16384!r} * sin(4 * {phi})"
        f" - {35 * e6 / 3072 + 175 * e8 / 12288!r} * sin(6 * {phi}) + {315 * e8 / 131072!r} * sin(8 * {phi}))"
    )


def metric_sql(source, lon, lat, keep):
    """Easting and northing (``ex``, ``ny``) by the classic series."""
    n = f"({_A!r} / sqrt(1 - {_E2!r} * pow(sin(phi), 2)))"
    t, c, a = "pow(tan(phi), 2)", f"({_EP2!r} * pow(cos(phi), 2))", f"((lam - radians({P.ORIGIN_LON})) * cos(phi))"
    m0 = _meridian(f"radians({P.ORIGIN_LAT})")
    return f"""
SELECT {keep}, {P.FALSE_EASTING} + {P.SCALE} * {n} * ({a} + (1 - {t} + {c}) * pow({a}, 3) / 6
    + (5 - 18 * {t} + pow({t}, 2) + 72 * {c} - 58 * {_EP2!r}) * pow({a}, 5) / 120) AS ex,
  {P.FALSE_NORTHING} + {P.SCALE} * ({_meridian('phi')} - {m0} + {n} * tan(phi) * (pow({a}, 2) / 2
    + (5 - {t} + 9 * {c} + 4 * pow({c}, 2)) * pow({a}, 4) / 24
    + (61 - 58 * {t} + pow({t}, 2) + 600 * {c} - 330 * {_EP2!r}) * pow({a}, 6) / 720)) AS ny
FROM (SELECT *, radians({lat}) AS phi, radians({lon}) AS lam FROM ({source}) s) r"""


DEGREES = ("lon_u / 1000000.0::double", "lat_u / 1000000.0::double")


def _metric_points(df, *keep):
    x, y = P.to_metric(F.col("lon_u") / 1e6, F.col("lat_u") / 1e6)
    return df.select(*keep, x.alias("x"), y.alias("y"))


@query(
    "points_in_metres",
    f"SELECT point_id, round(ex, 0) AS x, round(ny, 0) AS y FROM ({metric_sql(I.POINTS, *DEGREES, 'point_id')}) m",
)
def points_in_metres(spark, sf_dir):
    rows = _metric_points(I.derived(spark, sf_dir, I.POINTS), "point_id")
    return rows.select("point_id", F.round("x", 0).alias("x"), F.round("y", 0).alias("y"))


@query(
    "points_back_in_degrees",
    f"SELECT point_id, lon_u, lat_u FROM ({I.POINTS}) p",
)
def points_back_in_degrees(spark, sf_dir):
    rows = _metric_points(I.derived(spark, sf_dir, I.POINTS), "point_id")
    lon, lat = P.to_degrees(F.col("x"), F.col("y"))
    return rows.select(
        "point_id", F.round(lon * 1e6).cast("bigint").alias("lon_u"), F.round(lat * 1e6).cast("bigint").alias("lat_u")
    )


@query(
    "points_within_radius",
    f"""
SELECT DISTINCT p.point_id, c.center FROM ({metric_sql(I.POINTS, *DEGREES, 'point_id')}) p
JOIN ({metric_sql(I.CENTRES, *DEGREES, 'center')}) c ON sqrt(pow(p.ex - c.ex, 2) + pow(p.ny - c.ny, 2)) < 1000""",
)
def points_within_radius(spark, sf_dir):
    points = _metric_points(I.derived(spark, sf_dir, I.POINTS), "point_id")
    centres = _metric_points(I.derived(spark, sf_dir, I.CENTRES), "center")
    return spatial.within_radius(points, centres, 1000.0, ["point_id"])


@query(
    "points_from_columns",
    f"SELECT point_id, lon_u / 1000000.0::double AS lon, lat_u / 1000000.0::double AS lat FROM ({I.POINTS}) p",
)
def points_from_columns(spark, sf_dir):
    rows = I.derived(spark, sf_dir, I.POINTS).select(
        "point_id", (F.col("lon_u") / 1e6).alias("lon"), (F.col("lat_u") / 1e6).alias("lat")
    )
    return rows.filter(P.valid_degrees(F.col("lon"), F.col("lat")))
