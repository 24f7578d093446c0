"""Queries for the spatial layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from hoodcast.functions.columns import coord_key
from hoodcast.operators import geo, graph
from hoodcast.plans import inputs as I
from hoodcast.plans.catalog import query
from hoodcast.plans.oracle_sql import sql
from hoodcast.sources import adapter as A
from hoodcast.sources.tables import read_table

CELL = I.ADAPTER_CELL


def _points(spark, sf):
    p = A.collision_points(spark, sf).select(F.col("LONG_WGS84").alias("lon"), F.col("LAT_WGS84").alias("lat"))
    return p


@query("spatial_within", sql(
    "SELECT CAST(s_nationkey + 1 AS INTEGER) AS nbhd_id, count(*) AS points FROM li_s "
    "WHERE l_partkey % 50 <> 0 GROUP BY 1"))
def spatial_within(spark, sf):
    """Points strictly inside each area (no bbox prefilter: (0, 0) points
    simply find no cell)."""
    j = geo.spatial_join(_points(spark, sf), A.area_polygons(spark, sf), "lon", "lat", "within", cell=CELL)
    return j.groupBy("nbhd_id").agg(F.count(F.lit(1)).alias("points"))


@query("spatial_intersects_single", sql(
    "SELECT CAST(s_nationkey + 1 AS INTEGER) AS nbhd_id, count(*) AS points FROM li_s "
    "WHERE l_partkey % 50 <> 0 GROUP BY 1"))
def spatial_intersects_single(spark, sf):
    """Boundary-inclusive join, one (lowest-id) area per point."""
    j = geo.spatial_join(_points(spark, sf), A.area_polygons(spark, sf), "lon", "lat", "intersects",
                         single=True, cell=CELL)
    return j.groupBy("nbhd_id").agg(F.count(F.lit(1)).alias("points"))


@query("bbox_filter", sql("""
  SELECT CAST(min(-80 + n_nationkey % 5) AS DOUBLE) AS minx, CAST(min(43 + n_nationkey // 5) AS DOUBLE) AS miny,
         CAST(max(-79 + n_nationkey % 5) AS DOUBLE) AS maxx, CAST(max(44 + n_nationkey // 5) AS DOUBLE) AS maxy,
         (SELECT count(*) FROM li_s WHERE l_partkey % 50 <> 0) AS kept,
         (SELECT count(*) FROM li_s WHERE l_partkey % 50 = 0) AS dropped
  FROM nation"""))
def bbox_filter(spark, sf):
    """J4 + C2: the polygons' total bounds and how many points the inclusive
    bounding-box filter keeps / drops."""
    polys = A.area_polygons(spark, sf)
    pts = _points(spark, sf)
    kept = geo.bbox_filter(pts, polys, "lon", "lat")
    nk = kept.select(F.count(F.lit(1))).scalar()
    nall = pts.select(F.count(F.lit(1))).scalar()
    return geo.total_bounds(polys).select("minx", "miny", "maxx", "maxy", nk.alias("kept"),
                                          (nall - nk).alias("dropped"))


@query("adjacency_touches", sql("SELECT nbhd_id, adjacent_nbhd_id FROM adj"))
def adjacency_touches(spark, sf):
    """Polygons whose boundaries meet (corner contact counts), both directions."""
    return I.adjacency(spark, sf)


@query("adjacency_symmetry", sql(
    "SELECT a.nbhd_id, a.adjacent_nbhd_id FROM adj a LEFT JOIN adj b "
    "ON b.nbhd_id = a.adjacent_nbhd_id AND b.adjacent_nbhd_id = a.nbhd_id WHERE b.nbhd_id IS NULL"))
def adjacency_symmetry(spark, sf):
    """Directed pairs lacking their reverse (expected: none)."""
    return geo.missing_reverse_pairs(I.adjacency(spark, sf))


@query("isolated_areas", sql(
    "SELECT nbhd_id, area_id, area_name FROM areas WHERE nbhd_id NOT IN (SELECT nbhd_id FROM adj)"))
def isolated_areas(spark, sf):
    """Areas without any neighbour (expected: none)."""
    return geo.isolated_areas(A.areas(spark, sf), I.adjacency(spark, sf))


@query("polygon_centroid", sql(
    "SELECT CAST(n_nationkey + 1 AS INTEGER) AS nbhd_id, CAST(-80 + n_nationkey % 5 + 0.5 AS DOUBLE) AS centroid_lon, "
    "CAST(43 + n_nationkey // 5 + 0.5 AS DOUBLE) AS centroid_lat, CAST(1.0 AS DOUBLE) AS area FROM nation"))
def polygon_centroid(spark, sf):
    """Area-weighted centroid and area by shoelace sums over the edges."""
    return geo.centroids(A.area_polygons(spark, sf))


@query("valid_polygons", sql("SELECT nbhd_id, area_id, area_name FROM areas"))
def valid_polygons(spark, sf):
    """Polygons passing the structural and self-crossing checks."""
    return geo.valid_polygons(A.area_polygons(spark, sf)).select("nbhd_id", "area_id", "area_name")


@query("valid_coords", sql(
    "SELECT source, count(*) AS n FROM dis GROUP BY 1"))
def valid_coords(spark, sf):
    """Disruption coordinates coerced and range-checked (all valid here)."""
    d = geo.valid_coords(A.disruptions(spark, sf), "Latitude", "Longitude")
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("coord_clusters", sql("""
  SELECT concat_ws('_', CAST(round_even(lat, 1) AS VARCHAR), CAST(round_even(lon, 1) AS VARCHAR)) AS coord_key,
         min(round_even(lat, 1)) AS cell_lat, min(round_even(lon, 1)) AS cell_lon, count(*) AS members
  FROM (SELECT (43 + c_nationkey // 5) + (o_orderkey % 89 + 1) / 90.0 AS lat,
               (-80 + c_nationkey % 5) + (o_custkey % 97 + 1) / 98.0 AS lon
        FROM orders JOIN customer ON o_custkey = c_custkey)
  GROUP BY 1"""))
def coord_clusters(spark, sf):
    """0.1-degree cells (half-even rounding), representative
    coordinate and member count per cell."""
    d = A.disruptions(spark, sf)
    k = d.select(coord_key("Latitude", "Longitude", 1).alias("coord_key"),
                 F.bround("Latitude", 1).alias("la"), F.bround("Longitude", 1).alias("lo"))
    return k.groupBy("coord_key").agg(F.min("la").alias("cell_lat"), F.min("lo").alias("cell_lon"),
                                      F.count(F.lit(1)).alias("members"))


def street_tables(spark, sf):
    """Streets: every customer is a node inside its nation's square, every order a segment from its customer to another
    one, of 20 to 519 metres. Most cross a border; what lies in one area falls into several parts."""
    c = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nodes = c.select(F.col("c_custkey").alias("node"),
                     (F.col("c_nationkey") % A.GRID_COLS + A.GRID_X0 + (F.col("c_custkey") % 97 + 1) / 98.0).alias("x"),
                     (F.floor(F.col("c_nationkey") / A.GRID_COLS) + A.GRID_Y0 + (F.col("c_custkey") % 89 + 1) / 90.0).alias("y"))
    n = c.select(F.max("c_custkey")).scalar()
    other = F.pmod(F.col("o_orderkey") * 7919 + F.col("o_custkey"), n) + 1
    segments = read_table(spark, sf, "orders").select(
        F.col("o_custkey").alias("u"), other.alias("v"), (F.col("o_orderkey") % 500 + 20).alias("length_m"))
    return nodes, segments


def road_exposure_frame(spark, sf):
    """The street network of each area."""
    nodes, segments = street_tables(spark, sf)
    return graph.street_network(nodes, segments, A.area_polygons(spark, sf), cell=CELL)


#: The street network in SQL: components by closure over the links inside an area.
STREETS = {
    "street": """SELECT o_custkey AS u, (o_orderkey * 7919 + o_custkey) % (SELECT max(c_custkey) FROM customer) + 1 AS v,
      o_orderkey % 500 + 20 AS length_m FROM orders""",
    "inner_street": """SELECT a.c_nationkey AS n, u, v, length_m FROM street JOIN customer a ON u = a.c_custkey
      JOIN customer b ON v = b.c_custkey WHERE a.c_nationkey = b.c_nationkey""",
    "way": """SELECT u, v FROM inner_street UNION SELECT v, u FROM inner_street UNION SELECT u, u FROM inner_street
      UNION SELECT v, v FROM inner_street""",
    "reach": """SELECT u AS node, v AS other FROM way UNION SELECT node, v FROM reach JOIN way ON other = u""",
    "part_of": "SELECT node, min(other) AS part FROM reach GROUP BY node",
    "degree": "SELECT k AS node, count(*) AS d FROM (SELECT u AS k FROM street UNION ALL SELECT v FROM street) GROUP BY k",
    "part_size": """SELECT c_nationkey AS n, part, count(*) AS nodes, count(*) FILTER (WHERE d > 1) AS crossings, avg(d) AS spn
      FROM part_of JOIN customer ON node = c_custkey JOIN degree USING (node) GROUP BY 1, 2""",
    "largest": "SELECT * FROM part_size QUALIFY row_number() OVER (PARTITION BY n ORDER BY nodes DESC, part) = 1",
    "streets": """SELECT a.nbhd_id, CAST(coalesce(l.crossings, 0) AS BIGINT) AS intersection_count,
      CAST(coalesce(s.c, 0) AS BIGINT) AS street_segment_count, coalesce(round_even(s.len_m / 1000.0, 4), 0.0) AS arterial_length_km,
      coalesce(round_even(l.spn, 4), 0.0) AS streets_per_node_avg
      FROM areas a LEFT JOIN largest l ON l.n = a.nbhd_id - 1
      LEFT JOIN (SELECT i.n, part, count(*) AS c, sum(length_m) AS len_m FROM inner_street i JOIN part_of ON u = node GROUP BY 1, 2) s
        ON s.n = l.n AND s.part = l.part""",
}


@query("road_exposure", sql("SELECT * FROM streets", STREETS, recursive=True))
def road_exposure(spark, sf):
    """Intersections, segments, length (km, 4 dp), mean streets per node (4 dp) of the largest connected part of each
    area's street graph; parts apart and segments across a border do not count."""
    return road_exposure_frame(spark, sf)


def _lcc_sql():
    k = geo.lcc_constants()

    def fwd(x, y):
        phi = f"radians({y})"
        es = f"({k['e']!r} * sin({phi}))"
        t = f"(tan(pi() / 4 - {phi} / 2) / pow((1 - {es}) / (1 + {es}), {k['e'] / 2!r}))"
        rho = f"({k['aF']!r} * pow({t}, {k['n']!r}))"
        theta = f"({k['n']!r} * (radians({x}) - {k['lam0']!r}))"
        return (f"({k['x0']!r} + {rho} * sin({theta}))", f"({k['y0']!r} + {k['rho0']!r} - {rho} * cos({theta}))")

    X1, Y1 = fwd("x1", "y1")
    X2, Y2 = fwd("x2", "y2")
    edges = " UNION ALL ".join(
        f"SELECT CAST(n_nationkey + 1 AS INTEGER) AS nbhd_id, CAST(-80 + n_nationkey % 5 + {a} AS DOUBLE) AS x1, "
        f"CAST(43 + n_nationkey // 5 + {b} AS DOUBLE) AS y1, CAST(-80 + n_nationkey % 5 + {c} AS DOUBLE) AS x2, "
        f"CAST(43 + n_nationkey // 5 + {d} AS DOUBLE) AS y2 FROM nation"
        for a, b, c, d in ((0, 0, 1, 0), (1, 0, 1, 1), (1, 1, 0, 1), (0, 1, 0, 0)))
    proj = f"SELECT nbhd_id, {X1} AS X1, {Y1} AS Y1, {X2} AS X2, {Y2} AS Y2 FROM ({edges})"
    sums = (f"SELECT nbhd_id, sum(X1 * Y2 - X2 * Y1) AS a2, sum((X1 + X2) * (X1 * Y2 - X2 * Y1)) AS sx, "
            f"sum((Y1 + Y2) * (X1 * Y2 - X2 * Y1)) AS sy FROM ({proj}) GROUP BY nbhd_id")
    cx, cy = "(sx / (a2 * 3))", "(sy / (a2 * 3))"
    dx = f"({cx} - {k['x0']!r})"
    dy = f"({k['rho0']!r} - ({cy} - {k['y0']!r}))"
    t = f"pow(sqrt({dx} * {dx} + {dy} * {dy}) / {k['aF']!r}, {1.0 / k['n']!r})"
    lam = f"(atan2({dx}, {dy}) / {k['n']!r} + {k['lam0']!r})"
    phi = f"(pi() / 2 - atan({t}) * 2)"
    for _ in range(6):
        es = f"({k['e']!r} * sin({phi}))"
        phi = f"(pi() / 2 - atan({t} * pow((1 - {es}) / (1 + {es}), {k['e'] / 2!r})) * 2)"
    return (f"SELECT nbhd_id, round_even(degrees({lam}), 6) AS centroid_lon, round_even(degrees({phi}), 6) "
            f"AS centroid_lat, round_even(abs(a2) / 2 / 1e6, 3) AS area_km2 FROM ({sums})")


@query("polygon_centroid_projected", _lcc_sql())
def polygon_centroid_projected(spark, sf):
    """J2 + J3: centroid computed in the projected CRS (Lambert conformal conic,
    EPSG:3978 parameters) and returned to lon/lat; area in km2."""
    return geo.projected_centroids(A.area_polygons(spark, sf))


# ----------------------------------------------------------------------------
# shapes from a table that grows: one polygon per customer, with planted faults
# ----------------------------------------------------------------------------

def customer_shapes(spark, sf):
    """One outline per customer by its key: 0 valid square, 1 concave arrow, 2 bow tie (crosses itself),
    3 open ring, 4 two parts, 5 ring of three points."""
    k = F.col("c_custkey")
    x, y = (k % 1000).cast("double") * 4, F.floor(k / 1000).cast("double") * 4

    def ring(*points):
        return F.array(*[F.struct((x + a).alias("x"), (y + b).alias("y")) for a, b in points])

    square = ring((0, 0), (2, 0), (2, 2), (0, 2), (0, 0))
    shapes = [F.array(square), F.array(ring((0, 0), (2, 0), (2, 2), (1, 1), (0, 2), (0, 0))),
              F.array(ring((0, 0), (2, 2), (2, 0), (0, 2), (0, 0))), F.array(ring((0, 0), (2, 0), (2, 2), (0, 2))),
              F.array(square, ring((2.5, 0), (3, 0), (3, 1), (2.5, 0))), F.array(ring((0, 0), (2, 0), (0, 0)))]
    pick = shapes[-1]
    for i, s in enumerate(shapes[:-1]):
        pick = F.when(k % 6 == i, s).otherwise(pick)
    return read_table(spark, sf, "customer").select(k.cast("int").alias("nbhd_id"), pick.alias("rings"))


@query("valid_shapes", "SELECT CAST(c_custkey AS INTEGER) AS nbhd_id FROM customer WHERE c_custkey % 6 IN (0, 1, 4)")
def valid_shapes(spark, sf):
    """Of one outline per customer the bow ties, open rings and two-point rings are refused."""
    return geo.valid_polygons(customer_shapes(spark, sf)).select("nbhd_id")


def shape_points(spark, sf):
    """Per customer four points: inside, on the edge, in the arrow's notch, outside."""
    k = F.col("c_custkey")
    x, y = (k % 1000).cast("double") * 4, F.floor(k / 1000).cast("double") * 4
    pts = [(0.5, 0.25, "inside"), (1.0, 0.0, "edge"), (1.0, 1.5, "notch"), (3.5, 3.5, "outside")]
    return read_table(spark, sf, "customer").select(k.cast("int").alias("cust"), F.inline(F.array(*[
        F.struct((x + a).alias("x"), (y + b).alias("y"), F.lit(n).alias("place")) for a, b, n in pts])))


def _shape_join(spark, sf, predicate):
    shapes = customer_shapes(spark, sf).where("nbhd_id % 6 IN (0, 1, 4)")
    return geo.spatial_join(shape_points(spark, sf), shapes, "x", "y", predicate=predicate, cell=2.0).select("cust", "place", "nbhd_id")


@query("shapes_within", """
  SELECT CAST(c_custkey AS INTEGER) AS cust, place, CAST(c_custkey AS INTEGER) AS nbhd_id
  FROM customer, (SELECT unnest(['inside', 'notch']) AS place)
  WHERE c_custkey % 6 IN (0, 1, 4) AND (place = 'inside' OR c_custkey % 6 <> 1)""")
def shapes_within(spark, sf):
    """D8 over concave and two-part outlines: the edge and the notch are not within."""
    return _shape_join(spark, sf, "within")


@query("shapes_intersects", """
  SELECT CAST(c_custkey AS INTEGER) AS cust, place, CAST(c_custkey AS INTEGER) AS nbhd_id
  FROM customer, (SELECT unnest(['inside', 'edge', 'notch']) AS place)
  WHERE c_custkey % 6 IN (0, 1, 4) AND (place <> 'notch' OR c_custkey % 6 <> 1)""")
def shapes_intersects(spark, sf):
    """The boundary counts."""
    return _shape_join(spark, sf, "intersects")


@query("adopted_predicate", """
  SELECT CASE WHEN w >= i THEN 'within' ELSE 'intersects' END AS adopted, w AS n_within, i AS n_intersects
  FROM (SELECT count(*) FILTER (WHERE c_custkey % 6 IN (0, 1, 4)) + count(*) FILTER (WHERE c_custkey % 6 IN (0, 4)) AS w,
               2 * count(*) FILTER (WHERE c_custkey % 6 IN (0, 1, 4)) + count(*) FILTER (WHERE c_custkey % 6 IN (0, 4)) AS i
        FROM customer)""")
def adopted_predicate(spark, sf):
    """The boundary-inclusive join is adopted when it matches more points."""
    counts = [_shape_join(spark, sf, p).agg(F.count(F.lit(1)).alias(f"n_{p}")) for p in ("within", "intersects")]
    w, i = (c.select(c.columns[0]).scalar() for c in counts)
    return spark.range(1).select(F.when(w >= i, "within").otherwise("intersects").alias("adopted"),
                                 w.alias("n_within"), i.alias("n_intersects"))


@query("neighbourless_shapes", "SELECT CAST(c_custkey AS INTEGER) AS nbhd_id FROM customer WHERE c_custkey % 6 = 0")
def neighbourless_shapes(spark, sf):
    """The customers' squares lie apart, so none has a neighbour."""
    squares = customer_shapes(spark, sf).where("nbhd_id % 6 = 0")
    return geo.isolated_areas(squares, geo.adjacency(squares, cell=4.0)).select("nbhd_id")


@query("one_way_pairs", sql("SELECT nbhd_id, adjacent_nbhd_id FROM adj WHERE nbhd_id < adjacent_nbhd_id AND nbhd_id % 3 = 0"))
def one_way_pairs(spark, sf):
    """D13 over planted faults: pairs whose reverse was taken away."""
    a = I.adjacency(spark, sf)
    return geo.missing_reverse_pairs(a.where(~((F.col("nbhd_id") > F.col("adjacent_nbhd_id")) & (F.col("adjacent_nbhd_id") % 3 == 0))))


# ----------------------------------------------------------------------------
# rings in rings, detailed outlines
# ----------------------------------------------------------------------------

def ringed_shapes(spark, sf):
    """One polygon per customer by its key, rings turning either way: 0 a hole, 1 a hole turning like its outline, 2 two
    parts of opposite turns, 3 an island in a hole, listed first, 4 an island along its hole's border, 5 a plain square."""
    k = F.col("c_custkey")
    x, y = (k % 1000).cast("double") * 8, F.floor(k / 1000).cast("double") * 8

    def box(a, b, w, h, back=False):
        p = [(a, b), (a + w, b), (a + w, b + h), (a, b + h), (a, b)]
        return F.array(*[F.struct((x + u).alias("x"), (y + v).alias("y")) for u, v in (p[::-1] if back else p)])

    shapes = [[box(0, 0, 6, 6), box(1, 1, 2, 4, True)], [box(0, 0, 6, 6, True), box(1, 1, 2, 4, True)],
              [box(0, 0, 2, 2), box(3, 0, 2, 4, True)], [box(2, 2, 1, 2), box(0, 0, 7, 7), box(1, 1, 5, 5)],
              [box(0, 0, 6, 6), box(1, 1, 4, 4), box(1, 1, 2, 4)], [box(0, 0, 4, 4)]]
    pick = F.array(*shapes[-1])
    for i, rings in enumerate(shapes[:-1]):
        pick = F.when(k % 6 == i, F.array(*rings)).otherwise(pick)
    return read_table(spark, sf, "customer").select(k.cast("int").alias("nbhd_id"), pick.alias("rings"))


#: (area, moments of it about the shape's own corner) of the six kinds
_RINGED = ((28, 36 * 3 - 8 * 2, 36 * 3 - 8 * 3), (28, 36 * 3 - 8 * 2, 36 * 3 - 8 * 3), (12, 4 * 1 + 8 * 4, 4 * 1 + 8 * 2),
           (26, 49 * 3.5 - 25 * 3.5 + 2 * 2.5, 49 * 3.5 - 25 * 3.5 + 2 * 3), (28, 36 * 3 - 16 * 3 + 8 * 2, 36 * 3 - 16 * 3 + 8 * 3),
           (16, 16 * 2, 16 * 2))


@query("ringed_centroids", "SELECT CAST(c_custkey AS INTEGER) AS nbhd_id, v[1]::DOUBLE AS area, "
       "round_even(c_custkey % 1000 * 8 + v[2] / v[1], 6) AS centroid_lon, "
       "round_even(c_custkey // 1000 * 8 + v[3] / v[1], 6) AS centroid_lat FROM (SELECT c_custkey, CASE c_custkey % 6 "
       + " ".join(f"WHEN {i} THEN [{a}::DOUBLE, {mx}, {my}]" for i, (a, mx, my) in enumerate(_RINGED)) + " END AS v FROM customer)")
def ringed_centroids(spark, sf):
    """Holes and islands by nesting, whichever way their rings turn."""
    c = geo.centroids(ringed_shapes(spark, sf))
    return c.select("nbhd_id", F.bround("area", 6).alias("area"), F.bround("centroid_lon", 6).alias("centroid_lon"),
                    F.bround("centroid_lat", 6).alias("centroid_lat"))


#: Vertices of a detailed outline, and of the zigzag: fixed by the fixture.
WHEEL, SPOKES = 10_000, 24


@query("detailed_outline", f"""
  SELECT c_custkey % {SPOKES} AS spoke, count(*) AS points, count(*) FILTER (WHERE c_custkey % 100 < 90) AS inside
  FROM customer GROUP BY 1""")
def detailed_outline(spark, sf):
    """D8 over one outline of 10,000 vertices (a regular polygon around the origin) per spoke: every customer is a
    point on the spoke's ray, inside unless it lies in the outer tenth beyond the rim."""
    spoke, k = F.col("c_custkey") % SPOKES, F.col("c_custkey")
    cx = F.lit(300.0)
    turn = F.expr(f"transform(sequence(0, {WHEEL}), i -> named_struct('x', nbhd_id * 300.0 + 100 * cos(2 * pi() * (i % {WHEEL}) / {WHEEL}), "
                  f"'y', 100 * sin(2 * pi() * (i % {WHEEL}) / {WHEEL})))")
    wheels = read_table(spark, sf, "customer").select(spoke.cast("int").alias("nbhd_id")).distinct() \
        .select("nbhd_id", F.array(turn).alias("rings"))
    r = F.when(k % 100 < 90, k % 100 + 9).otherwise(k % 100 + 12)
    angle = k * 0.7
    pts = read_table(spark, sf, "customer").select(spoke.alias("spoke"), (spoke * cx + r * F.cos(angle)).alias("x"), (r * F.sin(angle)).alias("y"))
    hit = geo.spatial_join(pts, wheels, "x", "y", "within", cell=4.0)
    inside = hit.where(F.col("nbhd_id") == F.col("spoke")).groupBy("spoke").agg(F.count("*").alias("inside"))
    return pts.groupBy("spoke").agg(F.count("*").alias("points")).join(inside, "spoke", "left") \
        .select("spoke", "points", F.coalesce("inside", F.lit(0)).cast("long").alias("inside"))
