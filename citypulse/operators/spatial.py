"""Spatial joins on tiles.

Polygons are rows of edges ``poly_id, x1, y1, x2, y2`` (rings closed, ``ring_no`` optional), points are
two columns. Every join is an equi-join on a tile of a square grid, followed by an exact test that
needs no division, so integer coordinates give exact answers. A tile that many points share is
split by AQE, because the polygon side of a tile is small; equal points are tested once.

Tiles come in levels, each twice as wide as the one below. A polygon (or an edge, where edges meet edges) is
laid out on the level that suits its own size, so a map-wide one beside a million small ones
costs rows by the number of its edges, not by its area in tiles.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citypulse.session import cut_lineage

XY = ["x", "y"]
#: A polygon's tiles are at least as wide as this part of its average edge; tiles that one edge passes at most, about;
#: tiles of a box that are all listed, whatever is in it.
FINE, MOST_TILES, BOX_TILES = 8, 64, 100


def _wide(df: DataFrame) -> DataFrame:
    """Short integers as long ones, so that products of coordinate differences do not overflow."""
    short = [name for name, kind in df.dtypes if kind in ("int", "smallint", "tinyint")]
    return df.withColumns({n: F.col(n).cast("bigint") for n in short if n[-2:] in ("x1", "y1", "x2", "y2") or n in XY})


def _tile(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(size))


def _tile_range(low: Column, high: Column, size: float, margin: int = 0) -> Column:
    return F.explode(F.sequence(_tile(low, size) - margin, _tile(high, size) + margin))


def _meet(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """An equi-join in which both sides are dealt out, never sent whole to the driver and on to everyone.

    Spark's estimate of a side comes from the size of its files, before edges and tiles are listed from them.
    """
    return left.join(right.hint("merge"), on, how)


def boxes(edges: DataFrame) -> DataFrame:
    """Bounding box per polygon."""
    return edges.groupBy("poly_id").agg(
        F.min("x1").alias("min_x"), F.max("x1").alias("max_x"), F.min("y1").alias("min_y"), F.max("y1").alias("max_y")
    )


def _passed_tiles(edges: DataFrame, size: Column, margin: int = 0, crossings: bool = False) -> DataFrame:
    """Edges repeated for every tile they pass through, and the tiles up to ``margin`` around these.

    With ``crossings`` the column ``crosses`` is 1 in one tile of each row whose middle line the edge crosses.

    In each row of tiles an edge covers the range of x that it has there, so a long slanted edge is in a
    number of tiles that grows with its length. Rounding may add a tile, never lose one.
    """
    x1, y1, x2, y2 = (F.col(c).cast("double") for c in ("x1", "y1", "x2", "y2"))
    low, high = F.least(y1, y2), F.greatest(y1, y2)
    rows = edges.withColumn("_row", F.explode(F.sequence(F.floor(low / size), F.floor(high / size))))

    def x_at(y: Column) -> Column:
        return F.when(y2 != y1, x1 + (y - y1) * (x2 - x1) / (y2 - y1))

    ends = [x_at(F.greatest(low, F.col("_row") * size)), x_at(F.least(high, (F.col("_row") + 1) * size))]
    left, right = F.least(x1, x2), F.greatest(x1, x2)
    slack = size * 1e-9 + (F.abs(left) + F.abs(right)) * 1e-12
    begin = F.greatest(left, F.coalesce(F.least(*ends), left) - slack)
    end = F.least(right, F.coalesce(F.greatest(*ends), right) + slack)
    tiles = (
        rows.withColumn("ty", F.explode(F.sequence(F.col("_row") - margin, F.col("_row") + margin)) if margin else F.col("_row"))
        .withColumn("tx", F.explode(F.sequence(F.floor(begin / size) - margin, F.floor(end / size) + margin)))
    )
    if crossings:
        middle = (F.col("_row") + 0.5) * size
        # Any tile of the edge in this row will do: what lies between tiles without an edge is the same.
        place = F.least(F.greatest(F.floor(x_at(middle) / size), F.floor(begin / size)), F.floor(end / size))
        tiles = tiles.withColumn("crosses", ((low <= middle) & (middle < high) & (F.col("tx") == place)).cast("int"))
    return tiles.drop("_row")


def _level(width: Column, tile: float) -> Column:
    """The lowest level whose tiles are at least this wide."""
    return F.greatest(F.lit(0), F.ceil(F.log2(width / F.lit(float(tile))))).cast("int")


def _size(tile: float, level: Column | None = None) -> Column:
    return F.lit(float(tile)) * F.pow(F.lit(2.0), F.col("level") if level is None else level)


def _shapes(edges: DataFrame, tile: float) -> DataFrame:
    """Level and box of each polygon, in how many tiles of a row it can lie, and whether its box has few tiles."""
    length = F.hypot((F.col("x2") - F.col("x1")).cast("double"), (F.col("y2") - F.col("y1")).cast("double"))
    sums = _wide(edges).groupBy("poly_id").agg(
        F.min(F.least("x1", "x2")).alias("min_x"), F.max(F.greatest("x1", "x2")).alias("max_x"),
        F.min(F.least("y1", "y2")).alias("min_y"), F.max(F.greatest("y1", "y2")).alias("max_y"), _level(F.avg(length) / FINE, tile).alias("level"),
    )
    across, down = (F.floor(F.col(f"max_{c}") / _size(tile)) - F.floor(F.col(f"min_{c}") / _size(tile)) + 1 for c in XY)
    return sums.withColumns({"across": across, "boxed": across * down <= BOX_TILES})


def _cover(placed: DataFrame, tile: float) -> tuple[DataFrame, DataFrame]:
    """Tiles that polygons' edges (with their ``level``) pass, and runs of tiles inside that no edge passes.

    In a row of tiles what lies between two passed tiles is inside if an odd number of edges crosses the middle
    of the row before it. A run is given as its largest aligned pieces: ``k`` and the tile number shifted by ``k``.
    Passed tiles are at most a small multiple of the edges, and there are fewer runs than passed tiles.
    """
    passed = _passed_tiles(placed, _size(tile), crossings=True).groupBy("poly_id", "level", "ty", "tx").agg(F.sum("crosses").alias("crosses"))
    row = Window.partitionBy("poly_id", "level", "ty").orderBy("tx")
    odd = F.sum("crosses").over(row.rowsBetween(Window.unboundedPreceding, Window.currentRow)) % 2 == 1
    runs = passed.select("poly_id", "level", "ty", (F.col("tx") + 1).alias("a"), (F.lead("tx").over(row) - 1).alias("b"), odd.alias("odd"))
    runs = runs.filter("odd and b >= a")

    def whole(k: Column) -> tuple[Column, Column]:
        """First and last aligned piece of size 2^k that lies in the run."""
        step = F.pow(F.lit(2.0), k)
        return F.ceil(F.col("a") / step), F.floor((F.col("b") + 1) / step) - 1

    k = F.col("k")
    (first, last), (above, upto) = whole(k), whole(k + 1)
    largest = F.filter(F.array_distinct(F.array(first, last)), lambda i: (i >= first) & (i <= last) & ~F.floor(i / 2).between(above, upto))
    pieces = runs.withColumn("k", F.explode(F.sequence(F.lit(0), F.ceil(F.log2(F.col("b") - F.col("a") + 1)).cast("int"))))
    return passed.drop("crosses"), pieces.select("poly_id", "level", "ty", "k", F.explode(largest).alias("tk"))


def _edge_tiles(edges: DataFrame, size: float) -> DataFrame:
    """Edges repeated for every tile they pass through."""
    return _passed_tiles(edges, F.lit(float(size)))


def _side(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Positive left of the directed edge, negative right of it, zero on its line."""
    return (x2 - x1) * (py - y1) - (px - x1) * (y2 - y1)


def _within(value: Column, a: Column, b: Column) -> Column:
    return value.between(F.least(a, b), F.greatest(a, b))


def points_in_polygons(points: DataFrame, edges: DataFrame, tile: float) -> DataFrame:
    """Pairs ``x, y, poly_id`` of distinct points and the polygons they are in or on the border of.

    Points meet the tiles of the polygons, of all levels there are. A polygon whose box has few tiles has them all; of a
    wider one (on its level) those that an edge passes, and inner ones, where every point is inside. Elsewhere an odd
    number of edges to the right of the point in its row of tiles, or an edge through it, means inside.
    ``tile`` is the width of the smallest tiles.
    """
    shapes = _shapes(edges, tile)
    # A row or two a level: how many levels there are follows from the widths of polygons, not from their number.
    kinds = shapes.groupBy("level", "boxed").agg(F.max("across").alias("across")).collect()
    if not kinds:
        return points.select(*XY).crossJoin(edges.select("poly_id")).limit(0)
    x, y = F.col("x"), F.col("y")
    distinct = _wide(points.select(*XY)).na.drop().distinct()
    only = {r.level for r in kinds}
    plain = _wide(edges.select("poly_id", "x1", "y1", "x2", "y2"))
    placed = plain.withColumn("level", F.lit(only.pop())) if len(only) == 1 else _meet(plain, shapes.select("poly_id", "level"), "poly_id")

    def probed(pairs: list[tuple[int, int]]) -> DataFrame:
        """Points with the tile that they have on each level, and k."""
        at = [F.struct(F.lit(level).alias("level"), F.lit(float(tile) * 2**level).alias("size"), F.lit(k).alias("k")) for level, k in pairs]
        found = distinct.withColumn("at", at[0] if len(at) == 1 else F.explode(F.array(*at))).select("x", "y", "at.*")
        return found.withColumns({"ty": F.floor(y / F.col("size")), "tx": F.floor(x / F.col("size"))}).drop("size")

    def tiles(axis: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(f"min_{axis}") / _size(tile)), F.floor(F.col(f"max_{axis}") / _size(tile))))

    parts, inside = [], None
    if small := [(r.level, 0) for r in kinds if r.boxed]:
        covers = shapes.filter("boxed").withColumn("ty", tiles("y")).withColumn("tx", tiles("x"))
        near = _meet(probed(small), covers, ["level", "ty", "tx"])
        parts.append(near.filter(x.between(F.col("min_x"), F.col("max_x")) & y.between(F.col("min_y"), F.col("max_y"))))
    if large := [r for r in kinds if not r.boxed]:
        passed, inner = _cover(_meet(placed, shapes.filter("not boxed").select("poly_id"), "poly_id", "left_semi"), tile)
        parts.append(_meet(probed([(r.level, 0) for r in large]), passed, ["level", "ty", "tx"]))
        # A run is shorter than its polygon is wide by the two passed tiles at its ends.
        if shifts := [(r.level, k) for r in large if r.across > 2 for k in range(int(r.across - 2).bit_length())]:
            deep = probed(shifts).withColumn("tk", F.floor(F.col("tx") / F.pow(F.lit(2.0), F.col("k"))))
            inside = _meet(deep, inner, ["level", "ty", "k", "tk"]).select("x", "y", "poly_id")
    candidates = parts[0].select("x", "y", "ty", "poly_id")
    for part in parts[1:]:
        candidates = candidates.unionByName(part.select("x", "y", "ty", "poly_id"))
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    rows = placed.withColumn("ty", F.explode(F.sequence(F.floor(F.least(y1, y2) / _size(tile)), F.floor(F.greatest(y1, y2) / _size(tile)))))
    side = _side(x, y, x1, y1, x2, y2)
    crosses = ((y1 <= y) & (y < y2) & (side > 0)) | ((y2 <= y) & (y < y1) & (side < 0))
    touches = (side == 0) & _within(x, x1, x2) & _within(y, y1, y2)
    found = (
        _meet(candidates, rows.drop("level"), ["poly_id", "ty"])
        .groupBy("x", "y", "poly_id")
        .agg(F.count_if(crosses).alias("_crossed"), F.bool_or(touches).alias("_on_edge"))
        .filter((F.col("_crossed") % 2 == 1) | F.col("_on_edge"))
        .select("x", "y", "poly_id")
    )
    return found if inside is None else found.unionByName(inside)


def _give_cells(points: DataFrame, matches: DataFrame, ties: str) -> DataFrame:
    """Points with ``grid_id``; ``ties='first'`` keeps the lowest id of a point on a shared border."""
    if ties == "first":
        matches = matches.groupBy(*XY).agg(F.min("poly_id").alias("poly_id"))
    elif ties != "all":
        raise ValueError("ties must be 'first' or 'all'")
    return _meet(points, matches.withColumnRenamed("poly_id", "grid_id"), XY, "left")


def locate(points: DataFrame, edges: DataFrame, tile: float, ties: str = "all") -> DataFrame:
    """All points with the polygon they are in (``grid_id``, NULL outside all). Any polygons."""
    return _give_cells(points, points_in_polygons(points, edges, tile), ties)


def locate_on_grid(
    points: DataFrame, cells: DataFrame, origin: tuple[float, float], size: tuple[float, float], ties: str = "all"
) -> DataFrame:
    """Like :func:`locate` for a regular grid: ``cells(id, x0, y0)``, with ``x1, y1`` where they have them.

    Column and row follow from arithmetic, so the join is on two integers. A point that may be on a border,
    as far as rounding tells, meets the cells on both sides; the corners themselves then decide.
    """

    def index(value: Column, axis: int) -> Column:
        return F.floor((value - F.lit(origin[axis])) / F.lit(size[axis]))

    def choices(value: Column, axis: int) -> Column:
        i = index(value, axis)
        past = (value - F.lit(origin[axis])) / F.lit(size[axis]) - i
        near = F.when(past < 1e-6, F.array(i - 1, i)).when(past > 1 - 1e-6, F.array(i, i + 1))
        return F.explode(F.coalesce(near, F.array(i)))

    placed = points.select(*XY).na.drop().distinct()
    placed = placed.withColumn("ix", choices(F.col("x"), 0)).withColumn("iy", choices(F.col("y"), 1))
    half = [s / 2 for s in size]
    corners = [F.col(c) if c in cells.columns else F.col(low) + F.lit(s) for c, low, s in (("x1", "x0", size[0]), ("y1", "y0", size[1]))]
    numbered = cells.select(
        F.col("id").alias("poly_id"), "x0", "y0", corners[0].alias("x1"), corners[1].alias("y1"),
        index(F.col("x0") + F.lit(half[0]), 0).alias("ix"),
        index(F.col("y0") + F.lit(half[1]), 1).alias("iy"),
    )
    inside = F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1"))
    return _give_cells(points, _meet(placed, numbered, ["ix", "iy"]).filter(inside).select("x", "y", "poly_id"), ties)


def ring_points(edges: DataFrame) -> DataFrame:
    """One vertex of every ring: ``poly_id, x, y``."""
    keys = ["poly_id"] + (["ring_no"] if "ring_no" in edges.columns else [])
    vertex = F.min(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))).alias("v")
    return edges.groupBy(*keys).agg(vertex).select("poly_id", "v.x", "v.y")


def _touching_edges(left: DataFrame, right: DataFrame, tile: float) -> DataFrame:
    """Pairs ``left_id, right_id`` once for each pair of edges that meet.

    Each edge has a level on which it passes about ``MOST_TILES`` tiles at most, and is also laid out on all
    levels above; two edges meet in the tiles of the higher of their levels.
    """
    names = ["x1", "y1", "x2", "y2"]
    width = F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1"))).cast("double")
    own = _level(width / MOST_TILES, tile)
    top = left.select(own.alias("own")).unionByName(right.select(own.alias("own"))).agg(F.max("own")).first()[0] or 0

    def laid_out(edges: DataFrame, name: str) -> DataFrame:
        plain = _wide(edges.select(F.col("poly_id").alias(name), *names)).withColumn("own", own)
        levels = F.explode(F.sequence(F.col("own"), F.lit(top))) if top else F.lit(0)
        return _passed_tiles(plain.withColumn("level", levels), _size(tile))

    a = laid_out(left, "left_id")
    b = laid_out(right, "right_id").withColumnsRenamed({n: "r" + n for n in [*names, "own"]})
    p = [F.col(n) for n in names]
    q = [F.col("r" + n) for n in names]
    sides = [_side(p[0], p[1], *q), _side(p[2], p[3], *q), _side(q[0], q[1], *p), _side(q[2], q[3], *p)]

    def opposite(s: Column, t: Column) -> Column:
        return ((s > 0) & (t < 0)) | ((s < 0) & (t > 0))

    crossing = opposite(sides[0], sides[1]) & opposite(sides[2], sides[3])
    ends = [(p[0], p[1], q), (p[2], p[3], q), (q[0], q[1], p), (q[2], q[3], p)]
    resting = [
        (side == 0) & _within(x, e[0], e[2]) & _within(y, e[1], e[3]) for side, (x, y, e) in zip(sides, ends)
    ]
    condition = crossing | resting[0] | resting[1] | resting[2] | resting[3]
    return _meet(a, b, ["level", "tx", "ty"]).filter((F.greatest("own", "rown") == F.col("level")) & condition).select("left_id", "right_id")


def _rings_inside(inner: DataFrame, outer: DataFrame, tile: float) -> DataFrame:
    """Pairs ``poly_id, _outer`` where a ring of the first has a vertex in the second."""
    vertices = ring_points(inner)
    return _meet(vertices, points_in_polygons(vertices, outer, tile).withColumnRenamed("poly_id", "_outer"), XY)


def polygons_touch(left: DataFrame, right: DataFrame, tile: float) -> DataFrame:
    """Distinct pairs ``left_id, right_id`` of polygons that share at least one point.

    Two polygons meet when edges meet, or a ring of one lies inside the other.
    """
    left_in_right = _rings_inside(left, right, tile).select(F.col("poly_id").alias("left_id"), F.col("_outer").alias("right_id"))
    right_in_left = _rings_inside(right, left, tile).select(F.col("_outer").alias("left_id"), F.col("poly_id").alias("right_id"))
    edges_meet = _touching_edges(left, right, tile)
    return edges_meet.unionByName(left_in_right).unionByName(right_in_left).distinct()


def polygons_touching(edges: DataFrame, region: DataFrame, tile: float) -> DataFrame:
    """Ids of polygons that touch any part of a region, as ``poly_id``.

    Touching one part is touching the union, so the union is never built, nor are pairs: polygons with an edge
    that meets one of the region are done, and only the others are asked whether they lie inside or around.
    """
    met = cut_lineage(_touching_edges(edges, region, tile).select(F.col("left_id").alias("poly_id")).distinct())
    others = _meet(edges, met, "poly_id", "left_anti")
    within = _rings_inside(others, region, tile).select("poly_id")
    around = _rings_inside(region, others, tile).select(F.col("_outer").alias("poly_id"))
    return met.unionByName(within.unionByName(around).distinct())


def _distance2(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Squared distance of a point from a segment."""
    px, py, x1, y1, x2, y2 = (c.cast("double") for c in (px, py, x1, y1, x2, y2))
    dx, dy = x2 - x1, y2 - y1
    length2, along = dx * dx + dy * dy, (px - x1) * dx + (py - y1) * dy
    t = F.when(length2 > 0, F.least(F.greatest(along / length2, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return ex * ex + ey * ey


def _near_edges(polygons: DataFrame, targets: DataFrame) -> DataFrame | None:
    """Pairs of edges among which the nearest of every polygon is. None where there is nothing to pair.

    Tiles come in levels, each twice as wide as the one below. A polygon
    starts on the first level whose tiles are six diagonals of its own box wide. The first level from there
    at which a target edge passes through the 3 by 3 tiles around it bounds the distance by 2.83 tiles, so the nearest
    edge is in the 7 by 7 tiles of that level, which also cover the polygon's own extent. Both steps are
    equi-joins on level and tile; only that neighbourhood is measured. The lowest tiles follow from the polygon of median
    size, so a wide one looks at its own wide neighbourhood and changes nothing for the others.
    """
    polygons = cut_lineage(polygons.select("poly_id", "x1", "y1", "x2", "y2"))
    side = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y")).cast("double")
    extent = boxes(polygons).agg(
        F.percentile_approx(side, 0.5).alias("usual"),
        F.min("min_x").alias("min_x"),
        F.max("max_x").alias("max_x"),
        F.min("min_y").alias("min_y"),
        F.max("max_y").alias("max_y"),
    ).first()
    around = targets.agg(
        F.avg(F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1")))).alias("edge"),
        F.min("x1").alias("min_x"),
        F.max("x1").alias("max_x"),
        F.min("y1").alias("min_y"),
        F.max("y1").alias("max_y"),
    ).first()
    if extent["usual"] is None or around["edge"] is None:
        return None
    reach = 6.0 * math.sqrt(2)
    base = max(reach * float(extent["usual"]), float(around["edge"]), 1e-9)
    width = max(
        float(max(extent["max_x"], around["max_x"]) - min(extent["min_x"], around["min_x"])),
        float(max(extent["max_y"], around["max_y"]) - min(extent["min_y"], around["min_y"])),
    )
    # On the last level every polygon has found its neighbourhood, and the tiles suit one as wide as all.
    levels = max(math.ceil(math.log2(max(reach * width / base, 1.0))), 0) + 1
    size = _size(base)
    each_level = F.explode(F.sequence(F.lit(0), F.lit(levels)))

    def around_edges(margin: int) -> DataFrame:
        return _passed_tiles(targets.select("poly_id", "x1", "y1", "x2", "y2").withColumn("level", each_level), size, margin)

    near = around_edges(1).select("level", "tx", "ty").distinct()
    own = F.greatest(F.max("x1") - F.min("x1"), F.max("y1") - F.min("y1")).cast("double")
    anchors = polygons.groupBy("poly_id").agg(F.min(F.struct("x1", "y1")).alias("anchor"), _level(own * reach, base).alias("start"))
    looking = anchors.withColumn("level", F.explode(F.sequence(F.col("start"), F.lit(levels)))).drop("start")
    looking = looking.withColumns({"tx": F.floor(F.col("anchor.x1") / size), "ty": F.floor(F.col("anchor.y1") / size)})
    first_level = (
        _meet(looking, near, ["level", "tx", "ty"])
        .groupBy("poly_id")
        .agg(F.min(F.struct("level", "tx", "ty")).alias("found"))
        .select("poly_id", "found.*")
    )
    names = ["x1", "y1", "x2", "y2"]
    edges = _meet(polygons.select("poly_id", *names), first_level, "poly_id")
    candidates = around_edges(3).withColumnsRenamed({"poly_id": "target_id", **{n: "t" + n for n in names}})
    return _meet(edges, candidates, ["level", "tx", "ty"])


def nearest_polygon(polygons: DataFrame, targets: DataFrame) -> DataFrame:
    """Nearest target of every polygon: ``poly_id, target_id, distance``; a tie goes to the lowest id.

    For polygons that touch no target.
    """
    near = _near_edges(polygons, targets)
    if near is None:
        kinds = dict(polygons.dtypes)["poly_id"], dict(targets.dtypes)["poly_id"]
        return polygons.sparkSession.createDataFrame([], f"poly_id {kinds[0]}, target_id {kinds[1]}, distance double")
    names = ["x1", "y1", "x2", "y2"]
    p = [F.col(n) for n in names]
    q = [F.col("t" + n) for n in names]
    squared = F.least(_distance2(p[0], p[1], *q), _distance2(q[0], q[1], *p))
    # Distances are reduced per pair of polygons first: a minimum of plain numbers is a hash aggregate,
    # a minimum of structs needs sorted input and should only see one row per pair.
    pairs = near.groupBy("poly_id", "target_id").agg(F.min(squared).alias("d2"))
    return (
        pairs.groupBy("poly_id")
        .agg(F.min(F.struct("d2", F.col("target_id").alias("id"))).alias("best"))
        .select("poly_id", F.col("best.id").alias("target_id"), F.sqrt("best.d2").alias("distance"))
    )


def assign_districts(cells: DataFrame, districts: DataFrame, tile: float) -> DataFrame:
    """District of every cell: ``poly_id, admin_cd``; a cell that touches none gets the nearest.

    A cell that straddles districts has a row for each. ``cells`` and ``districts`` are edge rows.
    """
    touching = polygons_touch(cells, districts, tile).select(
        F.col("left_id").alias("poly_id"), F.col("right_id").alias("admin_cd")
    )
    touching = cut_lineage(touching)
    lost = _meet(cells, touching.select("poly_id"), "poly_id", "left_anti")
    filled = nearest_polygon(lost, districts).select("poly_id", F.col("target_id").alias("admin_cd"))
    return touching.unionByName(filled)


def within_radius(points: DataFrame, centres: DataFrame, radius: float, keep: list[str]) -> DataFrame:
    """Distinct ``keep`` columns and ``center`` of points closer than ``radius`` to a centre.

    ``points(x, y, ...)`` and ``centres(center, x, y)`` in metres. Tiles are as wide as the radius,
    so a place of centres is looked for in its own tile and the eight around it. Places near a point are its
    ``spots``; names are made distinct once for each set of spots, and then given to its points, so the pairs
    themselves, of which there may be far more than rows, are only made distinct for points in several sets.
    """
    named = centres.select("center", F.col("x").alias("cx"), F.col("y").alias("cy")).na.drop(subset=["cx", "cy"]).distinct()
    around = named.select("cx", "cy").distinct()
    around = around.withColumn("tx", _tile_range(F.col("cx"), F.col("cx"), radius, 1))
    around = around.withColumn("ty", _tile_range(F.col("cy"), F.col("cy"), radius, 1))
    places = points.select(*XY).na.drop().distinct().withColumns({"tx": _tile(F.col("x"), radius), "ty": _tile(F.col("y"), radius)})
    near = _meet(places, around, ["tx", "ty"]).filter(F.hypot(F.col("x") - F.col("cx"), F.col("y") - F.col("cy")) < F.lit(radius))
    near = cut_lineage(near.groupBy(*XY).agg(F.sort_array(F.collect_set(F.struct("cx", "cy"))).alias("spots")))
    each = near.select("spots").distinct().withColumn("s", F.explode("spots")).select("spots", "s.cx", "s.cy")
    names = _meet(each, named, ["cx", "cy"]).select("spots", "center").distinct()
    keys = list(dict.fromkeys(keep))
    placed = _meet(points.select(*dict.fromkeys([*keys, *XY])), near, XY).select(*keys, "spots").distinct()
    placed = cut_lineage(placed.withColumn("_sets", F.count(F.lit(1)).over(Window.partitionBy(*keys))))
    once = _meet(placed.filter("_sets = 1"), names, "spots").select(*keep, "center")
    return once.unionByName(_meet(placed.filter("_sets > 1"), names, "spots").select(*keep, "center").distinct())


def cell_edges(cells: DataFrame) -> DataFrame:
    """Edge rows of rectangles ``id, x0, y0, x1, y1``."""
    corners = [("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1")]
    segments = [
        F.struct(F.col(a).alias("x1"), F.col(b).alias("y1"), F.col(c).alias("x2"), F.col(d).alias("y2"))
        for (a, b), (c, d) in zip(corners, corners[1:] + corners[:1])
    ]
    return cells.select(F.col("id").alias("poly_id"), F.explode(F.array(*segments)).alias("e")).select("poly_id", "e.*")


def edges_from_rings(polygons: DataFrame, poly_id: str, rings: str = "rings") -> DataFrame:
    """Edge rows of polygons whose ``rings`` column is ``array<array<array<double>>>`` (lists of lon, lat).

    Rings of all parts of a multi-part polygon are in one list. A ring whose last point is not its first
    is closed.
    """
    ring = polygons.select(F.col(poly_id).alias("poly_id"), F.posexplode(rings).alias("ring_no", "ring"))
    corner = ring.select("poly_id", "ring_no", "ring", F.posexplode("ring").alias("at", "p"))
    following = F.try_element_at("ring", F.col("at") + 2)
    end = F.coalesce(following, F.col("ring")[0])
    return (
        corner.select(
            "poly_id",
            "ring_no",
            F.col("p")[0].alias("x1"),
            F.col("p")[1].alias("y1"),
            end[0].alias("x2"),
            end[1].alias("y2"),
        )
        .filter((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))
    )
