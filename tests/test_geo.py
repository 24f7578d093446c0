import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hoodcast.operators import geo

SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
HOLE = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)]
# concave "U": notch between x in (1, 3), y in (1, 3]
U = [(10.0, 0.0), (13.0, 0.0), (13.0, 3.0), (12.0, 3.0), (12.0, 1.0), (11.0, 1.0), (11.0, 3.0), (10.0, 3.0),
     (10.0, 0.0)]


def _polys(spark, items):
    rows = [(pid, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]) for pid, rings in items]
    return spark.createDataFrame(rows, "nbhd_id int, rings array<array<struct<x:double,y:double>>>")


def _pip(x, y, rings):
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                inside = not inside
    return inside


def _on_boundary(x, y, rings):
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) == 0 and min(x1, x2) <= x <= max(x1, x2) \
                    and min(y1, y2) <= y <= max(y1, y2):
                return True
    return False


def test_within_intersects_edges_holes_notch(spark):
    polys = _polys(spark, [(1, [SQUARE, HOLE]), (2, [U])])
    pts = spark.createDataFrame([
        (1, 0.5, 0.5),   # inside square
        (2, 1.5, 1.5),   # inside the hole -> outside
        (3, 4.0, 2.0),   # on the square's edge
        (4, 0.0, 0.0),   # on a corner
        (5, 11.5, 2.0),  # in the U's notch -> outside
        (6, 10.5, 2.0),  # in the U's arm
        (7, 1.0, 1.5),   # on the hole's edge
    ], "pid int, x double, y double")
    w = {r["pid"]: r["nbhd_id"] for r in geo.spatial_join(pts, polys, "x", "y", "within", cell=1.0).collect()}
    assert w == {1: 1, 6: 2}
    i = {r["pid"]: r["nbhd_id"] for r in
         geo.spatial_join(pts, polys, "x", "y", "intersects", single=True, cell=1.0).collect()}
    assert i == {1: 1, 3: 1, 4: 1, 6: 2, 7: 1}


def test_intersects_single_assignment_lowest_id(spark):
    a = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
    b = [(1.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 1.0), (1.0, 0.0)]
    polys = _polys(spark, [(7, [b]), (3, [a])])
    pts = spark.createDataFrame([(1, 1.0, 0.5)], "pid int, x double, y double")
    r = geo.spatial_join(pts, polys, "x", "y", "intersects", single=True, cell=0.5).collect()
    assert [x["nbhd_id"] for x in r] == [3]
    assert geo.spatial_join(pts, polys, "x", "y", "within", cell=0.5).count() == 0


@settings(max_examples=5, deadline=None)
@given(st.integers(min_value=0, max_value=10_000))
def test_pip_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    polys = _polys(spark, [(1, [SQUARE, HOLE]), (2, [U])])
    pts = [(i, rnd.choice([rnd.uniform(-1, 14), float(rnd.randint(-1, 14))]),
            rnd.choice([rnd.uniform(-1, 5), float(rnd.randint(-1, 5))])) for i in range(300)]
    df = spark.createDataFrame(pts, "pid int, x double, y double")
    got = {(r["pid"], r["nbhd_id"]) for r in geo.spatial_join(df, polys, "x", "y", "within", cell=0.5).collect()}
    shapes = {1: [SQUARE, HOLE], 2: [U]}
    exp = {(i, p) for i, x, y in pts for p, rings in shapes.items()
           if _pip(x, y, rings) and not _on_boundary(x, y, rings)}
    assert got == exp


def test_adjacency_cases(spark):
    def sq(x, y, s=1.0):
        return [[(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]]
    polys = _polys(spark, [
        (1, sq(0, 0)), (2, sq(1, 0)),          # shared edge
        (3, sq(2, 1)),                          # corner contact with 2
        (4, sq(0.5, 0.5)),                      # overlaps 1 and 2 -> not touching them
        (5, sq(10, 10)),                        # disjoint
        (6, sq(3, 1, 2.0)), (7, sq(2, 3)),      # 3 meets 6 along part of an edge (T-junction); 7 meets 6 at a corner
    ])
    got = {(r["nbhd_id"], r["adjacent_nbhd_id"]) for r in geo.adjacency(polys, cell=0.5).collect()}
    assert (1, 2) in got and (2, 1) in got
    assert (2, 3) in got and (3, 2) in got
    assert not any(5 in p for p in got)
    assert (1, 4) not in got and (2, 4) not in got
    assert (3, 6) in got and (6, 7) in got and (3, 7) not in got
    assert geo.missing_reverse_pairs(geo.adjacency(polys, cell=0.5)).count() == 0


def test_centroid_and_validity(spark):
    polys = _polys(spark, [(1, [SQUARE]), (2, [U]), (3, [[(0.0, 0.0), (1.0, 1.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)]])])
    c = {r["nbhd_id"]: r for r in geo.centroids(polys).collect()}
    assert (c[1]["centroid_lon"], c[1]["centroid_lat"], c[1]["area"]) == (2.0, 2.0, 16.0)
    assert abs(c[2]["area"] - 7.0) < 1e-12
    ok = {r["nbhd_id"] for r in geo.valid_polygons(polys).collect()}
    assert ok == {1, 2}  # the bow-tie self-crosses


def test_lcc_round_trip(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(-79.38, 43.65), (-123.1, 49.28), (-95.0, 49.0), (-63.6, 44.65)], "lon double, lat double")
    x, y = geo.lcc_forward(F.col("lon"), F.col("lat"))
    p = df.select("lon", "lat", x.alias("x"), y.alias("y"))
    lon, lat = geo.lcc_inverse(F.col("x"), F.col("y"))
    r = p.select("lon", "lat", "x", "y", lon.alias("lon2"), lat.alias("lat2")).collect()
    for row in r:
        assert abs(row["lon"] - row["lon2"]) < 1e-9 and abs(row["lat"] - row["lat2"]) < 1e-9
    origin = [row for row in r if row["lon"] == -95.0][0]
    assert abs(origin["x"]) < 1e-6 and abs(origin["y"]) < 1e-6  # projection origin (lon0, lat0)


def test_lcc_against_its_definition(spark):
    """EPSG:3978 by its definition: origin 49 N 95 W, true scale along 49 N and 77 N, conformal between."""
    import math

    from pyspark.sql import functions as F
    a, e2 = 6378137.0, 0.00669438002290
    step = 1e-4
    pts = []
    for lat in (49.0, 77.0, 60.0):
        pts += [(-95.0, lat), (-95.0 + step, lat), (-95.0, lat + step), (-70.0, lat), (-120.0, lat)]
    df = spark.createDataFrame(pts, "lon double, lat double")
    x, y = geo.lcc_forward(F.col("lon"), F.col("lat"))
    at = {(r.lon, r.lat): (r.x, r.y) for r in df.select("lon", "lat", x.alias("x"), y.alias("y")).collect()}
    assert max(map(abs, at[-95.0, 49.0])) < 1e-6
    for lat in (49.0, 77.0, 60.0):
        phi = math.radians(lat)
        w = math.sqrt(1 - e2 * math.sin(phi) ** 2)
        east, north = a / w * math.cos(phi) * math.radians(step), a * (1 - e2) / w ** 3 * math.radians(step)
        k_east = math.dist(at[-95.0, lat], at[-95.0 + step, lat]) / east
        k_north = math.dist(at[-95.0, lat], at[-95.0, lat + step]) / north
        assert abs(k_east - k_north) < 1e-4
        assert (abs(k_east - 1) < 1e-4) == (lat != 60.0) and k_east < 1 + 1e-4
        (xe, ye), (xw, yw) = at[-70.0, lat], at[-120.0, lat]
        assert abs(xe + xw) < 1e-6 and abs(ye - yw) < 1e-6 and xe > 0


def _box(x, y, w, h, turn=1):
    ring = [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
    return ring[::turn]


def test_ring_nesting(spark):
    """Area and centroid by even-odd nesting, whichever way the rings turn."""
    cases = {
        1: [_box(0, 0, 2, 2), _box(5, 0, 2, 2, -1)],                              # parts of opposite orientation
        2: [_box(0, 0, 2, 2), _box(0.5, 0.5, 0.5, 0.5)],                          # hole turning like its outline
        3: [_box(0, 0, 2, 2), _box(0.5, 0.5, 0.5, 0.5, -1)],
        4: [_box(2, 2, 1, 1), _box(0, 0, 9, 9, -1), _box(1, 1, 6, 6, -1)],        # island in a hole, listed first
        5: [_box(0, 0, 8, 8), _box(2, 2, 4, 4), _box(2, 2, 2, 4)],                # island along three sides of its hole
        6: [_box(2, 2, 2, 4), _box(2, 2, 4, 4), _box(0, 0, 8, 8)],
        7: [_box(0, 0, 4, 4), _box(1, 1, 2, 2), _box(1, 1, 2, 2, -1)],            # a hole and an island that fills it
        8: [_box(0, 0, 3, 3), _box(3, 3, 3, 3, -1), _box(0, 3, 3, 3)],            # parts that meet at a corner and a side
        9: [_box(0, 0, 1, 0)],                                                    # no area
        10: [[(0, 0), (0, 0)], _box(0, 0, 1, 1, -1), [(5, 5)], []],
    }
    want = {1: (8, 3.5, 1.0), 2: (3.75, (4 - 0.25 * 0.75) / 3.75, (4 - 0.25 * 0.75) / 3.75), 3: (3.75, (4 - 0.25 * 0.75) / 3.75, (4 - 0.25 * 0.75) / 3.75),
            4: (46, (81 * 4.5 - 36 * 4 + 2.5) / 46, (81 * 4.5 - 36 * 4 + 2.5) / 46), 5: (56, (64 * 4 - 16 * 4 + 8 * 3) / 56, 4.0),
            6: (56, (64 * 4 - 16 * 4 + 8 * 3) / 56, 4.0), 7: (16, 2.0, 2.0), 8: (27, 7.5 / 3, 10.5 / 3), 9: (0, None, None), 10: (1, 0.5, 0.5)}
    got = {r.nbhd_id: r for r in geo.centroids(_polys(spark, cases.items())).collect()}
    assert set(got) == set(want)
    for k, (area, x, y) in want.items():
        assert abs(got[k].area - area) < 1e-9, k
        assert (x is None and got[k].centroid_lon is None) or abs(got[k].centroid_lon - x) + abs(got[k].centroid_lat - y) < 1e-9, k


@settings(max_examples=4, deadline=None)
@given(st.integers(min_value=0, max_value=10_000))
def test_cells_of_detailed_outlines(spark, seed):
    """Whole-number outlines and points on a fine and a coarse grid: borders, corners, cells inside."""
    rnd = random.Random(seed)

    def star(cx, cy, n):
        import math
        ring = [(round(cx + rnd.randint(1, 9) * math.cos(2 * math.pi * k / n)), round(cy + rnd.randint(1, 9) * math.sin(2 * math.pi * k / n)))
                for k in range(n)]
        return [*map(lambda p: (float(p[0]), float(p[1])), ring), (float(ring[0][0]), float(ring[0][1]))]

    shapes = {k: [star(10, 10, rnd.randint(3, 40)) for _ in range(rnd.randint(1, 3))] for k in range(1, 5)}
    pts = [(i, *rnd.choice([(rnd.uniform(0, 20), rnd.uniform(0, 20)), (float(rnd.randint(0, 20)), float(rnd.randint(0, 20))),
                            (rnd.randint(0, 40) / 2, rnd.uniform(0, 20))])) for i in range(400)]
    df = spark.createDataFrame(pts, "pid int, x double, y double")
    polys = _polys(spark, shapes.items())
    for cell in (0.5, 4.0):
        for predicate in ("within", "intersects"):
            got = {(r["pid"], r["nbhd_id"]) for r in geo.spatial_join(df, polys, "x", "y", predicate, cell=cell).collect()}
            exp = {(i, p) for i, x, y in pts for p, rings in shapes.items()
                   if (_on_boundary(x, y, rings) if _on_boundary(x, y, rings) else _pip(x, y, rings)) and
                   (predicate == "intersects" or not _on_boundary(x, y, rings))}
            assert got == exp


def test_rows_follow_edges_plus_cells(spark):
    """A 10,000-vertex zigzag and a 10,000-vertex ring."""
    import math
    teeth = [(float(k), float(100 * (k % 2))) for k in range(10_000)]
    zigzag = [*teeth, (10_000.0, -50.0), (0.0, -50.0), teeth[0]]
    wheel = [(1000 * math.cos(2 * math.pi * k / 10_000), 1000 * math.sin(2 * math.pi * k / 10_000)) for k in range(10_000)]
    polys = _polys(spark, [(1, [zigzag]), (2, [[*wheel, wheel[0]]])])
    visits = {r[0]: r[1] for r in geo.edge_visits(polys).groupBy("poly_id").count().collect()}
    assert all(n < 50_000 for n in visits.values())
    assert geo.valid_polygons(polys).count() == 2
    index = geo.cell_index(polys.where("nbhd_id = 2"), 16.0)
    from pyspark.sql import functions as F
    stored = index.select(F.explode("polys").alias("p")).agg(F.sum(F.size("p.edges")), F.count("*")).first()
    assert stored[0] < 12_000 and stored[1] < 14_000  # 10,000 edges; 12,300 cells inside
    pts = [(i, 700.0 * math.cos(i), 1.0 * i) for i in range(1500)]
    df = spark.createDataFrame(pts, "pid int, x double, y double")
    got = {r.pid for r in geo.assign_points(df, index, 16.0, "x", "y").collect()}
    assert got == {i for i, x, y in pts if _pip(x, y, [[*wheel, wheel[0]]])}


def test_outlines_are_not_built_per_row_below_a_distinct(spark):
    """A filter on ``rings`` must not move below the distinct that leaves few polygons of many rows."""
    turn = F.expr("transform(sequence(0, 50), i -> named_struct('x', nbhd_id + cos(i % 50), 'y', sin(i % 50)))")
    polys = spark.range(1000).select((F.col("id") % 3).cast("int").alias("nbhd_id")).distinct().select("nbhd_id", F.array(turn).alias("rings"))
    edges = geo.ring_edges(polys)
    plan = edges._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "transform" in line]
    assert edges.count() == 3 * 50


def test_polygons_without_rings_have_no_edges(spark):
    rings = "array<array<struct<x:double,y:double>>>"
    polys = spark.createDataFrame([(1, None), (2, []), (3, [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]), (4, [None])], f"nbhd_id int, rings {rings}")
    assert {(r.poly_id, r.ring, r.k) for r in geo.ring_edges(polys).collect()} == {(3, 0, 0), (3, 0, 1), (3, 0, 2)}


def test_ring_nesting_in_parts_that_follow_the_edges(spark, monkeypatch):
    """Polygons of one file: nothing is counted or sorted in the task that reads it, and no part of the rest grows with them."""
    monkeypatch.setattr(geo, "PART_EDGES", 256, raising=False)
    rings = spark.createDataFrame([([[tuple(map(float, p)) for p in ring] for ring in (_box(0, 0, 6, 6), _box(1, 1, 2, 4))],)],
                                  "rings array<array<struct<x:double,y:double>>>")
    polys = spark.range(0, 2400, numPartitions=1).select(F.col("id").cast("int").alias("nbhd_id")).join(F.broadcast(rings))
    lines = geo.centroids(polys)._jdf.queryExecution().executedPlan().toString().splitlines()
    for n in (i for i, line in enumerate(lines) if "- Range" in line):
        below = lines[max(i for i, line in enumerate(lines[:n]) if " Exchange " in line):n]
        assert not [line for line in below if "Aggregate" in line or "Sort" in line]
    for df, rows in ((geo.ring_signs(polys), 4800), (geo.centroids(polys), 2400)):
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == rows and max(sizes) < rows / 20
    got = geo.centroids(polys).agg(F.min("area"), F.max("area"), F.min("centroid_lat"), F.max("centroid_lon")).first()
    assert tuple(got) == (28.0, 28.0, 3.0, (36 * 3 - 8 * 2) / 28)
