"""Spatial operators without a geometry library (J*, C2, C3, C6, D8-D10, D13).

Polygons are rows with ``rings ARRAY<ARRAY<STRUCT<x, y>>>`` (outer ring and
holes share the even-odd rule). Everything below is built from DataFrame
joins, aggregates and SQL higher-order functions:

* grid walk: an edge visits the cells that its line crosses, row by row, so the
  number of (edge, cell) rows follows the edges' length in cells;
* point-in-polygon: a *cell index* holds, per cell, the polygons that meet it: for
  each the edges that visit this cell and whether the cell's lower left corner is inside. A point
  joins the index on its cell (an equi-join, many-to-one, so a point never fans out); its
  parity is the corner's, changed by every edge of the cell that the way from the point
  to the corner crosses (left to the cell's border, then down). ``aggregate`` / ``exists``
  run over that short list in the JVM;
* ring nesting: a ring adds or takes away area by how many other rings of its polygon hold it,
  whichever way it turns;
* polygon adjacency (``touches``): an edge self-join bucketed by the same grid,
  with reference-cell de-duplication, plus a strict-interior probe for overlap.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoodcast.functions.columns import safe_div as C_safe

EDGE_T = "struct<x1:double,y1:double,x2:double,y2:double>"


# ---------------------------------------------------------------------------
# edges, bounds, validity
# ---------------------------------------------------------------------------

def _closed(ring: str) -> str:
    # append the first vertex when the ring is not closed
    return (f"IF(size({ring}) > 0 AND ({ring}[0].x != {ring}[size({ring})-1].x "
            f"OR {ring}[0].y != {ring}[size({ring})-1].y), concat({ring}, array({ring}[0])), {ring})")


def ring_edges_expr(rings_col: str = "rings") -> Column:
    """All edges of all rings of a polygon as ``ARRAY<STRUCT<x1,y1,x2,y2>>``."""
    return F.expr(
        f"flatten(transform(filter({rings_col}, r -> size(r) > 1), r -> transform(sequence(0, size({_closed('r')}) - 2), "
        f"i -> named_struct('x1', {_closed('r')}[i].x, 'y1', {_closed('r')}[i].y, "
        f"'x2', {_closed('r')}[i+1].x, 'y2', {_closed('r')}[i+1].y))))"
    )


def polygon_edges(polys: DataFrame, id_col: str = "nbhd_id") -> DataFrame:
    """``(poly_id, x1, y1, x2, y2)``: one row per edge (J5/J6 building block)."""
    return polys.select(F.col(id_col).alias("poly_id"),
                        F.explode(ring_edges_expr()).alias("e")).select("poly_id", "e.*")


def ring_edges(polys: DataFrame, id_col: str = "nbhd_id") -> DataFrame:
    """``(poly_id, ring, k, x1, y1, x2, y2)``: edge ``k`` of ring ``ring``."""
    # the outer form has no filter of its own on ``rings``: Spark moves that below what made the polygons (a distinct,
    # a join) and builds every outline there once per input row
    rings = polys.select(F.col(id_col).alias("poly_id"), F.posexplode_outer("rings").alias("ring", "r")).where("ring IS NOT NULL")
    return rings.select("poly_id", "ring", F.posexplode(ring_edges_expr("array(r)")).alias("k", "e")) \
        .select("poly_id", "ring", "k", "e.*")


#: Edges that a part of the polygons holds, about: what one task sorts and counts at a time.
PART_EDGES = 1 << 16
#: Parts that a task writes row by row; beyond Spark's spark.shuffle.sort.bypassMergeThreshold it holds them in memory.
STREAMED_PARTS = 200


def edge_parts(polys: DataFrame) -> int:
    """How many parts of about PART_EDGES edges the polygons make (one small job over the rings' sizes)."""
    points = F.expr("aggregate(rings, 0L, (n, r) -> n + coalesce(size(r), 0))")
    return max(1, math.ceil((polys.agg(F.sum(points).alias("n")).first()["n"] or 0) / PART_EDGES))


def walk_rows(e: DataFrame, sy: Column, to: str = "cy") -> DataFrame:
    """One row per edge and grid row that it visits."""
    return e.withColumn(to, F.explode(F.sequence(F.floor(F.least("y1", "y2") / sy), F.floor(F.greatest("y1", "y2") / sy))))


def walk_cells(e: DataFrame, sx: Column, sy: Column) -> DataFrame:
    """One row per edge and cell (``cx``, ``cy``) that its line crosses: about |dx| / sx + |dy| / sy + 1 of them.

    Within a row the columns are those between the places where the line enters and leaves it, rounded
    outwards: a cell too many does no harm, the tests are exact."""
    e = walk_rows(e, sy)
    lo, hi = F.greatest(F.least("y1", "y2"), F.col("cy") * sy), F.least(F.greatest("y1", "y2"), (F.col("cy") + 1) * sy)

    def at(y):
        return F.col("x1") + (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))

    slack = sx * 1e-9 + (F.abs("x1") + F.abs("x2")) * 4e-16
    left = F.greatest(F.least("x1", "x2"), F.coalesce(F.least(at(lo), at(hi)) - slack, F.least("x1", "x2")))
    right = F.least(F.greatest("x1", "x2"), F.coalesce(F.greatest(at(lo), at(hi)) + slack, F.greatest("x1", "x2")))
    return e.withColumn("cx", F.explode(F.sequence(F.floor(F.least(left, right) / sx), F.floor(F.greatest(left, right) / sx))))


def _own_grid(e: DataFrame) -> DataFrame:
    """Per polygon the cell size that fits its edges, their mean extent: all its edges together
    visit about three cells an edge, whatever their length and direction."""
    step = lambda v: F.greatest(F.avg(F.abs(F.col(f"{v}2") - F.col(f"{v}1"))),
                                (F.max(F.abs(f"{v}1")) + 1) * 1e-9).alias(f"s{v}")
    return e.groupBy("poly_id").agg(step("x"), step("y"))


def polygon_bounds(polys: DataFrame, id_col: str = "nbhd_id") -> DataFrame:
    """Per-polygon bounding box ``(poly_id, minx, miny, maxx, maxy)``."""
    pts = F.flatten(F.col("rings"))
    return polys.select(
        F.col(id_col).alias("poly_id"),
        F.array_min(F.transform(pts, lambda p: p["x"])).alias("minx"),
        F.array_min(F.transform(pts, lambda p: p["y"])).alias("miny"),
        F.array_max(F.transform(pts, lambda p: p["x"])).alias("maxx"),
        F.array_max(F.transform(pts, lambda p: p["y"])).alias("maxy"),
    )


def total_bounds(polys: DataFrame) -> DataFrame:
    """One row ``(minx, miny, maxx, maxy)`` over all polygons."""
    b = polygon_bounds(polys)
    return b.agg(F.min("minx").alias("minx"), F.min("miny").alias("miny"),
                 F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))


def bbox_filter(points: DataFrame, polys: DataFrame, x: str, y: str) -> DataFrame:
    """Keep points inside the polygons' total bounds (inclusive).

    The bounds are scalar subqueries over the polygon table (no join).
    """
    tb = total_bounds(polys).select(F.struct("*").alias("b")).scalar()
    return points.where(F.col(x).between(tb["minx"], tb["maxx"]) & F.col(y).between(tb["miny"], tb["maxy"]))


def valid_coords(df: DataFrame, lat: str = "Latitude", lon: str = "Longitude") -> DataFrame:
    """Numeric coercion, drop nulls, lat in [-90, 90], lon in [-180, 180]."""
    la, lo = F.col(lat).try_cast("double"), F.col(lon).try_cast("double")
    return (df.withColumn(lat, la).withColumn(lon, lo)
            .where(F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180)))


def valid_polygons(polys: DataFrame) -> DataFrame:
    """C6/J5 structural checks: non-null, every ring has >= 4 vertices and is
    closed, no proper self-crossing between two edges of the same polygon.

    Two edges meet in the cells that both lines cross, on a grid of the polygon's own mean
    edge extents: the rows are linear in the vertices.
    """
    ok_rings = F.expr(
        "rings IS NOT NULL AND size(rings) > 0 AND forall(rings, r -> r IS NOT NULL AND size(r) >= 4 "
        "AND r[0].x = r[size(r)-1].x AND r[0].y = r[size(r)-1].y)")
    structural = polys.where(ok_rings)
    e = edge_visits(structural)
    a, b = e.alias("a"), e.alias("b")
    cross = (a.join(b, (F.col("a.poly_id") == F.col("b.poly_id")) & (F.col("a.cx") == F.col("b.cx"))
                    & (F.col("a.cy") == F.col("b.cy"))
                    & (F.struct("a.ring", "a.k") < F.struct("b.ring", "b.k")))
             .where(_proper_cross("a", "b")).select(F.col("a.poly_id").alias("nbhd_id")).distinct())
    return structural.join(cross, "nbhd_id", "left_anti")


def edge_visits(polys: DataFrame, id_col: str = "nbhd_id") -> DataFrame:
    """Every edge with the cells it visits on its polygon's own grid."""
    e = ring_edges(polys, id_col)
    return walk_cells(e.join(_own_grid(e), "poly_id"), F.col("sx"), F.col("sy"))


# ---------------------------------------------------------------------------
# point-in-polygon via a cell index
# ---------------------------------------------------------------------------

def choose_cell_size(polys: DataFrame, per_side: int = 4) -> float:
    """Power-of-two cell size, about 1/``per_side`` of the median polygon extent.

    One scalar aggregate over the (bounded) polygon table.
    """
    b = polygon_bounds(polys)
    ext = b.select(F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")).alias("w"))
    w = ext.agg(F.percentile_approx("w", 0.5).alias("m")).first()["m"] or 1.0
    return 2.0 ** math.floor(math.log2(max(w / per_side, 1e-9)))


def cell_index(polys: DataFrame, cell: float, id_col: str = "nbhd_id") -> DataFrame:
    """``(cx, cy, polys ARRAY<STRUCT<poly_id, inside, corner, edges>>)`` sorted by poly id.

    Every polygon contributes the cells that its edges visit, with these edges and the parity of the cell's
    lower left corner (``corner``), and the cells that lie inside whole (``inside``, no
    edges). A corner's parity is a running count, along its row, of the edges that cross the row's
    lower border to the left of it. Nothing is compared edge by cell: the rows are those of
    the grid walk, the border crossings and the cells inside. A cell lists the few polygons that
    meet it, a bound of the geometry, not of the data's volume.
    """
    s = float(cell)
    size = F.lit(s)
    e = ring_edges(polys, id_col).select("poly_id", F.struct("x1", "y1", "x2", "y2").alias("e"), "x1", "y1", "x2", "y2")
    cells = walk_cells(e, size, size).select("poly_id", "cy", F.col("cx").alias("pos"), "e", F.lit(0).alias("add"))
    # where an edge crosses a row's lower border: between the corners j and j + 1
    up = walk_rows(e, size).where(f"(y1 > cy * {s!r}) != (y2 > cy * {s!r})")
    x = F.expr(f"x1 + (x2 - x1) * ((cy * {s!r} - y1) / (y2 - y1))")
    up = up.withColumn("j", F.floor(x / s))
    right_of = lambda j: F.expr(f"({_side('e', f'({j} * {s!r})', f'(cy * {s!r})')}) = (y2 < y1)")
    j = F.when(right_of("j"), F.col("j") - 1).when(~right_of("(j + 1)"), F.col("j") + 1).otherwise(F.col("j"))
    up = up.select("poly_id", "cy", (j + 1).alias("pos"), F.lit(None).cast(EDGE_T).alias("e"), F.lit(1).alias("add"))
    # dealt once by polygon and row: the places' sums and the rows' running counts need no other exchange
    places = cells.unionByName(up).repartition("poly_id", "cy").groupBy("poly_id", "cy", "pos").agg(
        F.sum("add").alias("add"), F.collect_list("e").alias("edges"))
    row = Window.partitionBy("poly_id", "cy").orderBy("pos")
    places = places.select("poly_id", "cy", "pos", "edges",
                           (F.sum("add").over(row.rowsBetween(Window.unboundedPreceding, 0)) % 2 == 1).alias("odd"),
                           F.lead("pos").over(row).alias("next"))
    # the place's own cell if edges visit it, and the cells up to the next place if they lie inside
    entries = F.expr(f"""concat(
        IF(size(edges) > 0, array(struct(pos AS cx, false AS inside, odd AS corner, edges)), array()),
        IF(odd AND next > pos + IF(size(edges) > 0, 1, 0), transform(sequence(pos + IF(size(edges) > 0, 1, 0), next - 1),
           c -> struct(c AS cx, true AS inside, true AS corner, cast(array() AS array<{EDGE_T}>) AS edges)), array()))""")
    per_cell = places.select("poly_id", "cy", F.explode(entries).alias("c")).select(
        "c.cx", "cy", F.struct("poly_id", "c.inside", "c.corner", "c.edges").alias("p"))
    return per_cell.groupBy("cx", "cy").agg(F.array_sort(F.collect_list("p")).alias("polys"))


def _side(e: str, x: str, y: str) -> str:
    """Whether a point lies to the left of an edge's line (SQL text). On the line it counts as moved up a
    little and right by less, as the half-open tests of ``_way_crossings`` do."""
    o = f"(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({e}.y2 - {e}.y1) * ({x} - {e}.x1))"
    return f"({o} > 0 OR ({o} = 0 AND ({e}.x2 > {e}.x1 OR ({e}.x2 = {e}.x1 AND {e}.y2 < {e}.y1))))"


def _way_crossings(edges: str, px: str, py: str, x0: str, y0: str) -> str:
    """How often the way from a point left to the cell's border and down to its corner (x0, y0) crosses the edges."""
    p, turn, corner = (_side("e", x, y) for x, y in ((px, py), (x0, py), (x0, y0)))
    return (f"aggregate({edges}, 0, (acc, e) -> acc "
            f"+ IF((e.y1 > {py}) != (e.y2 > {py}) AND {p} != {turn}, 1, 0) "
            f"+ IF((e.x1 > {x0}) != (e.x2 > {x0}) AND {turn} != {corner}, 1, 0))")


def _on_edge(edges: str, px: str, py: str) -> str:
    return (f"exists({edges}, e -> (e.x2 - e.x1) * ({py} - e.y1) - (e.y2 - e.y1) * ({px} - e.x1) = 0 "
            f"AND {px} BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) "
            f"AND {py} BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2))")


def inside_expr(entry: str, px: str, py: str, x0: str, y0: str, predicate: str) -> str:
    """Whether a point of the cell with lower left corner (x0, y0) matches an index entry with edges."""
    odd = f"(({_way_crossings(f'{entry}.edges', px, py, x0, y0)}) % 2 = 1) != {entry}.corner"
    on = _on_edge(f"{entry}.edges", px, py)
    if predicate == "within":
        return f"(({odd}) AND NOT {on})"
    if predicate == "intersects":
        return f"(({odd}) OR {on})"
    raise ValueError(predicate)


def assign_points(points: DataFrame, index: DataFrame, cell: float, x: str, y: str,
                  predicate: str = "within", single: bool = False,
                  out_col: str = "nbhd_id") -> DataFrame:
    """Inner spatial join of points to polygons.

    ``predicate='within'`` keeps points strictly inside (boundary excluded);
    ``'intersects'`` includes the boundary.  ``single=True`` keeps only the
    lowest polygon id per point (the reference keeps the first match);
    otherwise a point inside several overlapping polygons yields several rows.

    Spark's own size estimate decides whether the index is broadcast; otherwise
    the join shuffles on the cell and AQE splits hot cells (skew join).
    """
    s = float(cell)
    pts = points.withColumn("_cx", F.floor(F.col(x) / s)).withColumn("_cy", F.floor(F.col(y) / s))
    idx = index.withColumnRenamed("cx", "_cx").withColumnRenamed("cy", "_cy")
    j = pts.join(idx, ["_cx", "_cy"], "inner")
    test = inside_expr('p', f'`{x}`', f'`{y}`', f'(_cx * {s!r})', f'(_cy * {s!r})', predicate)
    hit = F.expr(f"transform(filter(polys, p -> p.inside OR {test}), p -> p.poly_id)")
    j = j.withColumn("_hits", hit).drop("polys", "_cx", "_cy")
    if single:
        return j.where(F.size("_hits") > 0).withColumn(out_col, F.col("_hits")[0]).drop("_hits")
    return j.withColumn(out_col, F.explode("_hits")).drop("_hits")


def spatial_join(points: DataFrame, polys: DataFrame, x: str, y: str, predicate: str = "within",
                 single: bool = False, cell: float | None = None, id_col: str = "nbhd_id",
                 out_col: str = "nbhd_id") -> DataFrame:
    """Convenience wrapper: build the cell index for ``polys`` and assign."""
    s = cell or choose_cell_size(polys)
    idx = cell_index(polys, s, id_col)
    return assign_points(points, idx, s, x, y, predicate, single, out_col)


# ---------------------------------------------------------------------------
# adjacency (touches)
# ---------------------------------------------------------------------------

def _orient(px, py, qx, qy, rx, ry) -> Column:
    return (F.col(qx) - F.col(px)) * (F.col(ry) - F.col(py)) - (F.col(qy) - F.col(py)) * (F.col(rx) - F.col(px))


def _on_seg(ax, ay, bx, by, px, py) -> Column:
    return (F.col(px).between(F.least(ax, bx), F.greatest(ax, bx))
            & F.col(py).between(F.least(ay, by), F.greatest(ay, by)))


def _orients(a: str, b: str):
    o1 = _orient(f"{a}.x1", f"{a}.y1", f"{a}.x2", f"{a}.y2", f"{b}.x1", f"{b}.y1")
    o2 = _orient(f"{a}.x1", f"{a}.y1", f"{a}.x2", f"{a}.y2", f"{b}.x2", f"{b}.y2")
    o3 = _orient(f"{b}.x1", f"{b}.y1", f"{b}.x2", f"{b}.y2", f"{a}.x1", f"{a}.y1")
    o4 = _orient(f"{b}.x1", f"{b}.y1", f"{b}.x2", f"{b}.y2", f"{a}.x2", f"{a}.y2")
    return o1, o2, o3, o4


def _proper_cross(a: str, b: str) -> Column:
    o1, o2, o3, o4 = _orients(a, b)
    return (o1 * o2 < 0) & (o3 * o4 < 0)


def _contact(a: str, b: str) -> Column:
    o1, o2, o3, o4 = _orients(a, b)
    A = [f"{a}.x1", f"{a}.y1", f"{a}.x2", f"{a}.y2"]
    B = [f"{b}.x1", f"{b}.y1", f"{b}.x2", f"{b}.y2"]
    return (_proper_cross(a, b)
            | ((o1 == 0) & _on_seg(*A, B[0], B[1]))
            | ((o2 == 0) & _on_seg(*A, B[2], B[3]))
            | ((o3 == 0) & _on_seg(*B, A[0], A[1]))
            | ((o4 == 0) & _on_seg(*B, A[2], A[3])))


def adjacency(polys: DataFrame, cell: float | None = None, id_col: str = "nbhd_id") -> DataFrame:
    """Directed ``(nbhd_id, adjacent_nbhd_id)`` pairs of polygons
    whose boundaries meet while their interiors do not (corner contact counts).

    Edge pairs are found by a grid-bucketed self equi-join; each pair is kept
    only in the cell holding the lower-left corner of the two boxes' overlap,
    so no pair is emitted twice. Interior overlap = a proper edge crossing, or
    a vertex / edge midpoint of one polygon strictly inside the other.
    """
    s = cell or choose_cell_size(polys)
    e = polygon_edges(polys, id_col).select(
        "poly_id", "x1", "y1", "x2", "y2",
        F.least("x1", "x2").alias("ex0"), F.greatest("x1", "x2").alias("ex1"),
        F.least("y1", "y2").alias("ey0"), F.greatest("y1", "y2").alias("ey1"))
    e = (e.withColumn("cx", F.explode(F.sequence(F.floor(F.col("ex0") / s), F.floor(F.col("ex1") / s))))
          .withColumn("cy", F.explode(F.sequence(F.floor(F.col("ey0") / s), F.floor(F.col("ey1") / s)))))
    a, b = e.alias("a"), e.alias("b")
    pairs = a.join(
        b,
        (F.col("a.cx") == F.col("b.cx")) & (F.col("a.cy") == F.col("b.cy"))
        & (F.col("a.poly_id") < F.col("b.poly_id"))
        & (F.col("a.ex0") <= F.col("b.ex1")) & (F.col("b.ex0") <= F.col("a.ex1"))
        & (F.col("a.ey0") <= F.col("b.ey1")) & (F.col("b.ey0") <= F.col("a.ey1")))
    ref_cx = F.floor(F.greatest("a.ex0", "b.ex0") / s)
    ref_cy = F.floor(F.greatest("a.ey0", "b.ey0") / s)
    pairs = pairs.where((ref_cx == F.col("a.cx")) & (ref_cy == F.col("a.cy")))
    rel = pairs.groupBy(F.col("a.poly_id").alias("p"), F.col("b.poly_id").alias("q")).agg(
        F.max(_contact("a", "b").cast("int")).alias("contact"),
        F.max(_proper_cross("a", "b").cast("int")).alias("crossing"))
    # probes: vertices and edge midpoints strictly inside another polygon
    edges = polygon_edges(polys, id_col)
    probes = edges.select("poly_id", F.col("x1").alias("px"), F.col("y1").alias("py")).unionByName(
        edges.select("poly_id", ((F.col("x1") + F.col("x2")) / 2).alias("px"),
                     ((F.col("y1") + F.col("y2")) / 2).alias("py")))
    idx = cell_index(polys, s, id_col)
    inside = (assign_points(probes, idx, s, "px", "py", "within", out_col="host")
              .where(F.col("host") != F.col("poly_id"))
              .select(F.least("poly_id", "host").alias("p"), F.greatest("poly_id", "host").alias("q"))
              .distinct())
    touching = (rel.where((F.col("contact") == 1) & (F.col("crossing") == 0))
                .join(inside, ["p", "q"], "left_anti"))
    both = touching.select(F.col("p").alias(id_col), F.col("q").alias("adjacent_nbhd_id")).unionByName(
        touching.select(F.col("q").alias(id_col), F.col("p").alias("adjacent_nbhd_id")))
    return both


def missing_reverse_pairs(adj: DataFrame, a: str = "nbhd_id", b: str = "adjacent_nbhd_id") -> DataFrame:
    """Directed edges (a, b) lacking (b, a)."""
    rev = adj.select(F.col(b).alias(a), F.col(a).alias(b))
    return adj.join(rev, [a, b], "left_anti")


def isolated_areas(areas: DataFrame, adj: DataFrame, id_col: str = "nbhd_id") -> DataFrame:
    """Areas with no neighbour."""
    return areas.join(adj.select(id_col).distinct(), id_col, "left_anti")


# ---------------------------------------------------------------------------
# centroid, clustering
# ---------------------------------------------------------------------------

def ring_signs(polys: DataFrame, id_col: str = "nbhd_id", parts: int | None = None) -> DataFrame:
    """``(poly_id, ring, sign)``: 1 for a ring that adds area, -1 for one that takes it away.

    A ring held by an even number of its polygon's other rings adds, whichever way it turns: outlines,
    parts, islands in holes. It is asked of a ring's edge midpoints, which meet the other rings'
    edges in the grid rows they share: a ring holds the midpoint if an odd number of its
    edges cross the way to the left. A midpoint on none of the other rings decides; if there is
    none, rings on it count as holding the later ones (of equal rings every other one adds).

    Edges are dealt by polygon, then by grid row, then by ring, in ``parts`` parts that follow their number
    (``edge_parts``): no task sorts or counts more of them as the polygons grow, however few files they come from.
    """
    parts = parts or edge_parts(polys)
    several = ring_edges(polys.where("size(rings) > 1").repartition(min(parts, STREAMED_PARTS), id_col), id_col)
    grid = _own_grid(several).select("poly_id", "sy")
    e = several.join(grid.hint("merge"), "poly_id")
    other = walk_rows(e, F.col("sy"), "row").select(
        "poly_id", "row", F.col("ring").alias("other"), F.struct("x1", "y1", "x2", "y2").alias("e")).repartition(parts, "poly_id", "row")
    middle = e.select("poly_id", "ring", "k", ((F.col("x1") + F.col("x2")) / 2).alias("mx"),
                      ((F.col("y1") + F.col("y2")) / 2).alias("my"), "sy").withColumn("row", F.floor(F.col("my") / F.col("sy")))
    # the probe's own ring keeps every probe in the join, and says nothing
    j = middle.repartition(parts, "poly_id", "row").join(other.hint("merge"), ["poly_id", "row"])
    own = F.col("ring") == F.col("other")
    on = F.expr(_on_edge("array(e)", "mx", "my")) & ~own
    crossed = F.expr(f"(e.y1 > my) != (e.y2 > my) AND {_side('e', 'mx', 'my')} = (e.y2 < e.y1)") & ~own
    # a probe lies in one row: its counts are whole where they were joined, and go on by ring
    held = j.groupBy("poly_id", "row", "ring", "k", "other").agg(F.max(on).alias("on"), F.count_if(crossed).alias("n"))
    held = held.repartition(parts, "poly_id", "ring").groupBy("poly_id", "ring", "k", "other").agg(
        F.max("on").alias("on"), F.sum("n").alias("n"))
    held = held.groupBy("poly_id", "ring", "k").agg(
        F.max("on").alias("on"), F.sum(F.when(F.col("on"), (F.col("other") < F.col("ring")).cast("int"))
                                       .otherwise((F.col("n") % 2).cast("int"))).alias("depth"))
    depth = held.groupBy("poly_id", "ring").agg(F.min_by("depth", F.struct("on", "k")).alias("depth"))
    return depth.select("poly_id", "ring", F.when(F.col("depth") % 2 == 0, 1).otherwise(-1).alias("sign"))


def _ring_sums(polys: DataFrame, id_col: str, project=None) -> DataFrame:
    """``(poly_id, a2, sx, sy)``: twice the area and six times the area's moments, the rings' shoelace sums
    over the edges (through ``project``, if given) added or taken away by their nesting."""
    parts = edge_parts(polys)
    e = ring_edges(polys.repartition(min(parts, STREAMED_PARTS), id_col), id_col)
    e = project(e) if project else e
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    rings = e.groupBy("poly_id", "ring").agg(
        F.sum(cross).alias("a2"), F.sum((F.col("x1") + F.col("x2")) * cross).alias("sx"),
        F.sum((F.col("y1") + F.col("y2")) * cross).alias("sy"))
    # a ring's sums and its sign meet in its polygon's part, without a join that picks its own number of parts
    signs = ring_signs(polys, id_col, parts)
    rings = rings.unionByName(signs, allowMissingColumns=True).repartition(parts, "poly_id").groupBy("poly_id", "ring").agg(
        *[F.max(c).alias(c) for c in ("a2", "sx", "sy", "sign")])
    sign = F.coalesce("sign", F.lit(1)) * F.signum("a2")
    return rings.groupBy("poly_id").agg(*[F.sum(sign * F.col(c)).alias(c) for c in ("a2", "sx", "sy")])


def centroids(polys: DataFrame, id_col: str = "nbhd_id") -> DataFrame:
    """Area-weighted centroid and area by shoelace sums over the edges (planar, in storage
    coordinates), holes taken away. A polygon without area has no centroid, one without edges no row."""
    g = _ring_sums(polys, id_col)
    return g.select(F.col("poly_id").alias(id_col),
                    C_safe(F.col("sx"), F.col("a2") * 3).alias("centroid_lon"),
                    C_safe(F.col("sy"), F.col("a2") * 3).alias("centroid_lat"),
                    (F.col("a2") / 2).alias("area"))


# ---------------------------------------------------------------------------
# the one projected CRS: Lambert conformal conic, two standard parallels
# ---------------------------------------------------------------------------

# NAD83 / Canada Atlas Lambert (EPSG:3978) on the GRS80 ellipsoid.
LCC_3978 = {"a": 6378137.0, "inv_f": 298.257222101, "lat1": 49.0, "lat2": 77.0, "lat0": 49.0,
            "lon0": -95.0, "x0": 0.0, "y0": 0.0}


def lcc_constants(p: dict = LCC_3978) -> dict:
    """Projection constants (Snyder's ellipsoidal LCC formulas); plain numbers."""
    f = 1.0 / p["inv_f"]
    e = math.sqrt(2 * f - f * f)

    def m(phi):
        return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

    def t(phi):
        return math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)

    p1, p2, p0 = (math.radians(p[k]) for k in ("lat1", "lat2", "lat0"))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    big_f = m(p1) / (n * t(p1) ** n)
    rho0 = p["a"] * big_f * t(p0) ** n
    return {"e": e, "n": n, "aF": p["a"] * big_f, "rho0": rho0, "lam0": math.radians(p["lon0"]),
            "x0": p["x0"], "y0": p["y0"]}


def lcc_forward(lon, lat, k: dict | None = None):
    """(lon, lat) degrees -> (x, y) metres as column expressions."""
    k = k or lcc_constants()
    e, n = F.lit(k["e"]), F.lit(k["n"])
    phi = F.radians(lat)
    es = e * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es), e / 2)
    rho = F.lit(k["aF"]) * F.pow(t, n)
    theta = n * (F.radians(lon) - F.lit(k["lam0"]))
    return F.lit(k["x0"]) + rho * F.sin(theta), F.lit(k["y0"]) + F.lit(k["rho0"]) - rho * F.cos(theta)


def lcc_inverse(x, y, k: dict | None = None, iterations: int = 6):
    """(x, y) metres -> (lon, lat) degrees; latitude by fixed-point iteration."""
    k = k or lcc_constants()
    e, n = F.lit(k["e"]), k["n"]
    dx = x - F.lit(k["x0"])
    dy = F.lit(k["rho0"]) - (y - F.lit(k["y0"]))
    rho = F.sqrt(dx * dx + dy * dy) * (1.0 if n > 0 else -1.0)
    t = F.pow(rho / F.lit(k["aF"]), F.lit(1.0 / n))
    theta = F.atan2(dx, dy)
    lam = theta / F.lit(n) + F.lit(k["lam0"])
    phi = F.lit(math.pi / 2) - F.atan(t) * 2
    for _ in range(iterations):
        es = e * F.sin(phi)
        phi = F.lit(math.pi / 2) - F.atan(t * F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es), e / 2)) * 2
    return F.degrees(lam), F.degrees(phi)


def projected_centroids(polys: DataFrame, id_col: str = "nbhd_id", digits: int = 6) -> DataFrame:
    """J3 (reference variant): centroid computed in the projected CRS, then
    returned to lon/lat; area in square kilometres."""
    x1, y1 = lcc_forward(F.col("x1"), F.col("y1"))
    x2, y2 = lcc_forward(F.col("x2"), F.col("y2"))
    g = _ring_sums(polys, id_col, lambda e: e.select(
        "poly_id", "ring", x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2")))
    cx, cy = C_safe(F.col("sx"), F.col("a2") * 3), C_safe(F.col("sy"), F.col("a2") * 3)
    lon, lat = lcc_inverse(cx, cy)
    return g.select(F.col("poly_id").alias(id_col), F.bround(lon, digits).alias("centroid_lon"),
                    F.bround(lat, digits).alias("centroid_lat"),
                    F.bround(F.col("a2") / 2 / 1e6, 3).alias("area_km2"))
