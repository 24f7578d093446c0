"""Queries for the data-quality layer."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from hoodcast.config import ADAPTER
from hoodcast.operators import quality as Q
from hoodcast.plans import inputs as I
from hoodcast.plans.catalog import query
from hoodcast.plans.oracle_sql import sql
from hoodcast.sources import adapter as A
from hoodcast.sources import readers as Rd
from hoodcast.sources import state as St
from hoodcast.sources.tables import TABLES, read_table, table_path

S = ADAPTER


@query("dq_unique_key", sql(
    "SELECT date, nbhd_id, count(*) AS n FROM panel GROUP BY 1, 2 HAVING count(*) > 1"))
def dq_unique_key(spark, sf):
    """Duplicate (date, area) keys in the dense panel (expected: none)."""
    return Q.duplicate_keys(I.dense(spark, sf), ["date", "nbhd_id"])


@query("dq_duplicate_count", sql(
    "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) "
    "AS distinct_keys, CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS duplicates "
    "FROM lineitem"))
def dq_duplicate_count(spark, sf):
    """Rows beyond the first per (l_orderkey, l_linenumber) in lineitem."""
    return Q.duplicate_count(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_expected_entities", sql(
    f"SELECT count(DISTINCT nbhd_id) AS n, {S.expected_areas} AS expected, "
    f"count(DISTINCT nbhd_id) = {S.expected_areas} AS ok FROM panel"))
def dq_expected_entities(spark, sf):
    """The panel holds exactly the expected number of areas."""
    return Q.expected_entities(I.dense(spark, sf), S.expected_areas)


@query("dq_schema_range", sql(
    "SELECT CAST(sum(CASE WHEN date IS NOT NULL THEN 0 ELSE 1 END) AS BIGINT) AS date_not_null, "
    "CAST(sum(CASE WHEN nbhd_id >= 1 THEN 0 ELSE 1 END) AS BIGINT) AS nbhd_id_ge_1, "
    "CAST(sum(CASE WHEN collisions >= 0 THEN 0 ELSE 1 END) AS BIGINT) AS collisions_ge_0, "
    "CAST(sum(CASE WHEN tavg IS NOT NULL THEN 0 ELSE 1 END) AS BIGINT) AS weather_present, "
    "CAST(sum(CASE WHEN ksi_fatal_victims <= ksi_victim_count THEN 0 ELSE 1 END) AS BIGINT) AS fatal_le_victims "
    "FROM gold"))
def dq_schema_range(spark, sf):
    """N3 + N7: gold contract (non-null date, id >= 1, counts >= 0, weather
    present, fatal victims <= victims) as violation counts."""
    g = I.gold(spark, sf)
    out = Q.contract_violations(g, {
        "date_not_null": F.col("date").isNotNull(),
        "nbhd_id_ge_1": F.col("nbhd_id") >= 1,
        "collisions_ge_0": F.col("collisions") >= 0,
        "weather_present": F.col("tavg").isNotNull(),
        "fatal_le_victims": F.col("ksi_fatal_victims") <= F.col("ksi_victim_count"),
    })
    return out.select(*[F.col(c).cast("bigint").alias(c) for c in out.columns])


@query("dq_missing_lookup", sql("""
  SELECT HOOD_158, count(*) AS rows FROM (
    SELECT CASE WHEN l_partkey % 41 = 0 THEN 'NSA' ELSE CAST(s_nationkey + 1 AS VARCHAR) END AS HOOD_158
    FROM li_s WHERE l_quantity >= 40)
  WHERE HOOD_158 NOT IN (SELECT CAST(nbhd_id AS VARCHAR) FROM areas)
  GROUP BY 1 ORDER BY 1 LIMIT 10"""))
def dq_missing_lookup(spark, sf):
    """KSI hood codes without an area (``NSA``), up to 10 keys with counts."""
    k = A.ksi_persons(spark, sf).select("HOOD_158")
    dim = A.areas(spark, sf).select(F.col("nbhd_id").cast("string").alias("HOOD_158"))
    return Q.missing_lookup(k, dim, "HOOD_158", "HOOD_158")


@query("dq_coverage", sql("""
  SELECT count(DISTINCT nbhd_id) AS n_entities, count(DISTINCT date) AS n_days, count(*) AS n_rows,
         datediff('day', min(date), max(date)) + 1 AS span_days,
         (SELECT count(*) FROM areas WHERE nbhd_id NOT IN (SELECT nbhd_id FROM panel)) AS missing_entities,
         (SELECT count(*) FROM (SELECT DISTINCT nbhd_id FROM panel) WHERE nbhd_id NOT IN (SELECT nbhd_id FROM areas))
           AS extra_entities,
         count(*) = count(DISTINCT nbhd_id) * (datediff('day', min(date), max(date)) + 1) AS ok
  FROM panel"""))
def dq_coverage(spark, sf):
    """Expected areas present, none extra, rows = areas x days."""
    out = Q.coverage(I.dense(spark, sf), A.areas(spark, sf))
    return out.select("n_entities", "n_days", "n_rows", F.col("span_days").cast("bigint").alias("span_days"),
                      "missing_entities", "extra_entities", "ok")


@query("dq_density", sql("""
  SELECT nbhd_id, count(*) AS n, count(DISTINCT date) AS d, datediff('day', min(date), max(date)) + 1 AS span
  FROM coll_daily GROUP BY 1
  HAVING count(*) <> datediff('day', min(date), max(date)) + 1 OR count(DISTINCT date) <> count(*)"""))
def dq_density(spark, sf):
    """The sparse daily counts are not a dense series (lags would count
    rows, not days): areas with gaps."""
    out = Q.density_violations(I.collision_daily(spark, sf))
    return out.select("nbhd_id", "n", "d", F.col("span").cast("bigint").alias("span"))


@query("dq_prob_targets", sql(f"""
  SELECT CAST(sum(CASE WHEN score IS NOT NULL AND NOT (score BETWEEN 0 AND 1) THEN 1 ELSE 0 END) AS BIGINT)
           AS score_out_of_range,
         CAST(sum(CASE WHEN t IS NULL OR t NOT IN (0, 1) THEN 1 ELSE 0 END) AS BIGINT) AS target_bad
  FROM (SELECT ((nbhd_id * 7919 + datediff('day', DATE '1995-01-01', date) * 104729) % 1000) / 1000.0 AS score,
               CAST(coalesce(lead(collisions, 1) OVER (PARTITION BY nbhd_id ORDER BY date), 0) >= 1 AS INTEGER) AS t
        FROM panel)"""))
def dq_prob_targets(spark, sf):
    """Probabilities in [0, 1], targets binary and non-null."""
    from hoodcast.operators import windows as Wn
    p = I.dense(spark, sf)
    w = Wn.area_window()
    t = p.select(A.score_column().alias("score"),
                 (F.coalesce(Wn.lead("collisions", 1, w), F.lit(0)) >= 1).cast("int").alias("target"))
    out = Q.probability_target_checks(t, ["score"], ["target"])
    return out.select(F.col("score_out_of_range").cast("bigint"), F.col("target_bad").cast("bigint"))


REQUIRED = {"lineitem": ("l_orderkey", "l_suppkey", "l_shipdate", "l_quantity"),
            "orders": ("o_orderkey", "o_custkey", "o_orderdate"),
            "nation": ("n_nationkey", "n_name"), "supplier": ("s_suppkey", "s_nationkey"),
            "customer": ("c_custkey", "c_nationkey")}


def _audit_sql():
    parts = []
    for t in TABLES:
        parts.append(f"SELECT '{t}' AS name, CASE WHEN count(*) = 0 THEN 'BAD_ROWS' ELSE 'OK' END AS status, "
                     f"count(*) AS rows, (SELECT count(*) FROM (DESCRIBE {t})) AS n_columns FROM {t}")
    return " UNION ALL ".join(parts)


@query("dq_audit", _audit_sql())
def dq_audit(spark, sf):
    """Artefact audit over the input tables."""
    out = Q.audit(spark, {t: table_path(sf, t) for t in TABLES}, REQUIRED)
    return out.select("name", "status", "rows", F.col("n_columns").cast("bigint").alias("n_columns"))


@query("dq_set_difference", sql(
    "SELECT nbhd_id FROM areas EXCEPT SELECT DISTINCT nbhd_id FROM ksi_daily WHERE ksi_fatal_collisions > 0"))
def dq_set_difference(spark, sf):
    """H2: areas that never had a fatal KSI collision (expected minus actual)."""
    k = I.ksi_daily(spark, sf).where(F.col("ksi_fatal_collisions") > 0)
    return Q.set_difference(A.areas(spark, sf), k, ["nbhd_id"])


MERGE_SQL = sql("""
  SELECT date, tavg, tmin, load_seq FROM (
    SELECT *, row_number() OVER (PARTITION BY date ORDER BY load_seq DESC) AS rn FROM (
      SELECT date, tavg, tmin, 1 AS load_seq FROM weather_raw WHERE date < DATE '1998-01-01'
      UNION ALL
      SELECT date, tavg + 1, tmin, 2 AS load_seq FROM weather_raw WHERE date >= DATE '1997-07-01'))
  WHERE rn = 1""")


@query("incremental_merge", MERGE_SQL)
def incremental_merge(spark, sf):
    """Two overlapping weather loads merged, last load wins per date."""
    w = A.weather_raw(spark, sf)
    old = w.where(F.col("date") < F.lit("1998-01-01").cast("date")).select(
        "date", "tavg", "tmin", F.lit(1).alias("load_seq"))
    new = w.where(F.col("date") >= F.lit("1997-07-01").cast("date")).select(
        "date", (F.col("tavg") + 1).alias("tavg"), "tmin", F.lit(2).alias("load_seq"))
    return Q.incremental_merge(old, new, ["date"])


@query("dq_table_profile", sql(
    "SELECT count(*) AS rows, min(date) AS min_date, max(date) AS max_date, count(DISTINCT nbhd_id) AS n_entities "
    "FROM panel"))
def dq_table_profile(spark, sf):
    """Rows, date range, distinct areas of the panel."""
    return Q.table_profile(I.dense(spark, sf))


PROFILE_COLS = ["road_events_count", "road_construction_count", "ksi_collisions", "collisions"]


@query("dq_column_profile", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS n, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    f"count(*) FILTER (WHERE {c} <> 0) AS nonzero, avg(CAST({c} AS DOUBLE)) AS mean, "
    f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM gold" for c in PROFILE_COLS)))
def dq_column_profile(spark, sf):
    """Count / nulls / non-zeros / mean / min / max of gold measures."""
    return Q.column_profile(I.gold(spark, sf), PROFILE_COLS)


@query("dq_missing_rate", sql("""
  SELECT * , missing_rate > 0.05 AS above_threshold FROM (
    SELECT 'PlannedEndDate' AS "column", avg(CAST(end_date IS NULL AS DOUBLE)) AS missing_rate FROM dis
    UNION ALL
    SELECT 'Severity', avg(CAST((o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED'))
                                AS DOUBLE)) FROM orders JOIN customer ON o_custkey = c_custkey)"""))
def dq_missing_rate(spark, sf):
    """Missing rate of the planned end and the severity of disruptions."""
    return Q.missing_rate(A.disruptions(spark, sf), ["PlannedEndDate", "Severity"])


# ----------------------------------------------------------------------------
# the gates over rows with planted faults
# ----------------------------------------------------------------------------

def _faulty(spark, sf):
    """The dense panel with area 3's first days of a month twice, area 5's 13th days missing, area 7's
    counts negative on Christmas Day and area 9's id lost on New Year's Day."""
    p = I.dense(spark, sf).select("date", "nbhd_id", "collisions")
    day = F.dayofmonth("date")
    p = p.union(p.where((F.col("nbhd_id") == 3) & (day == 1))).where(~((F.col("nbhd_id") == 5) & (day == 13)))
    xmas = (F.month("date") == 12) & (day == 25) & (F.col("nbhd_id") == 7)
    new_year = (F.month("date") == 1) & (day == 1) & (F.col("nbhd_id") == 9)
    return p.select("date", F.when(~new_year, F.col("nbhd_id")).alias("nbhd_id"),
                    F.when(xmas, F.lit(-1)).otherwise(F.col("collisions")).cast("bigint").alias("collisions"))


FAULTY = {"faulty": """
  SELECT date, CASE WHEN NOT (month(date) = 1 AND day(date) = 1 AND nbhd_id = 9) THEN nbhd_id END AS nbhd_id,
         CASE WHEN month(date) = 12 AND day(date) = 25 AND nbhd_id = 7 THEN -1 ELSE collisions END AS collisions
  FROM (SELECT date, nbhd_id, collisions FROM panel
        UNION ALL SELECT date, nbhd_id, collisions FROM panel WHERE nbhd_id = 3 AND day(date) = 1)
  WHERE NOT (nbhd_id = 5 AND day(date) = 13)"""}


@query("gate_duplicate_keys", sql(
    "SELECT date, nbhd_id, count(*) AS n FROM faulty GROUP BY 1, 2 HAVING count(*) > 1", FAULTY))
def gate_duplicate_keys(spark, sf):
    """N1 over planted duplicates."""
    return Q.duplicate_keys(_faulty(spark, sf), ["date", "nbhd_id"])


@query("gate_density", sql("""
  SELECT nbhd_id, n, d, span FROM (SELECT nbhd_id, count(*) AS n, count(DISTINCT date) AS d,
         max(date) - min(date) + 1 AS span FROM faulty GROUP BY 1) WHERE n <> span OR d <> n""", FAULTY))
def gate_density(spark, sf):
    """T4 over planted gaps, duplicates and lost ids."""
    return Q.density_violations(_faulty(spark, sf)).select("nbhd_id", "n", "d", F.col("span").cast("bigint").alias("span"))


@query("gate_contract", sql("""
  SELECT CAST(sum(CASE WHEN date IS NOT NULL THEN 0 ELSE 1 END) AS BIGINT) AS date_not_null,
         CAST(sum(CASE WHEN nbhd_id >= 1 THEN 0 ELSE 1 END) AS BIGINT) AS nbhd_id_ge_1,
         CAST(sum(CASE WHEN collisions >= 0 THEN 0 ELSE 1 END) AS BIGINT) AS collisions_ge_0 FROM faulty""", FAULTY))
def gate_contract(spark, sf):
    """N3 over planted negative counts and lost ids."""
    rules = {k: v for k, v in Q.contract("gold").items() if k in ("date_not_null", "nbhd_id_ge_1", "collisions_ge_0")}
    out = Q.contract_violations(_faulty(spark, sf), rules)
    return out.select(*[F.col(c).cast("bigint").alias(c) for c in out.columns])


@query("gate_key_grid", sql("""
  SELECT date, nbhd_id FROM panel EXCEPT SELECT date, nbhd_id FROM faulty""", FAULTY))
def gate_key_grid(spark, sf):
    """Grid keys that the faulty table lacks."""
    return Q.set_difference(I.dense(spark, sf), _faulty(spark, sf), ["date", "nbhd_id"])


@query("gate_subset", sql("""
  SELECT (SELECT count(*) FROM (SELECT date, nbhd_id FROM panel EXCEPT SELECT date, nbhd_id FROM faulty)) = 0 AS subset""", FAULTY))
def gate_subset(spark, sf):
    """H4: the panel's keys are not all in the faulty table."""
    return Q.is_subset(I.dense(spark, sf), _faulty(spark, sf), ["date", "nbhd_id"])


@query("gate_lookup", sql("""
  SELECT n_name AS area_name, count(*) AS rows FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE n_nationkey >= 20 GROUP BY 1"""))
def gate_lookup(spark, sf):
    """customers' areas missing from a dimension that lacks the last five."""
    c = read_table(spark, sf, "customer").join(read_table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    dim = read_table(spark, sf, "nation").where("n_nationkey < 20").select(F.col("n_name").alias("name"))
    return Q.missing_lookup(c.select(F.col("n_name").alias("area_name")), dim, "area_name", "name")


@query("audit_statuses", """
  SELECT 'good' AS name, 'OK' AS status, (SELECT count(*) FROM customer) AS rows, 2::BIGINT AS n_columns
  UNION ALL SELECT 'empty', 'BAD_ROWS', 0, 2 UNION ALL SELECT 'narrow', 'BAD_SCHEMA', (SELECT count(*) FROM customer), 1
  UNION ALL SELECT 'none', 'MISSING', NULL, NULL""")
def audit_statuses(spark, sf):
    """Every status, over written tables: a good one, one without rows, one without a required column, none at all."""
    base = Rd.landing_dir(spark, "audit")
    c = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    for name, df in (("good", c), ("empty", c.limit(0)), ("narrow", c.select("c_custkey"))):
        Rd.write_parquet(df, f"{base}/{name}")
    names = ("good", "empty", "narrow", "none")
    out = Q.audit(spark, {n: f"{base}/{n}" for n in names}, {n: ("c_custkey", "c_nationkey") for n in names})
    return out.select("name", "status", "rows", F.col("n_columns").cast("bigint").alias("n_columns"))


@query("gate_prediction_contract", """
  SELECT CAST(count(*) FILTER (WHERE l_orderkey % 11 = 0) AS BIGINT) AS broken_date_not_null,
         CAST(count(*) FILTER (WHERE l_partkey % 13 IN (0, 1)) AS BIGINT) AS broken_nbhd_id_ge_1,
         CAST(count(*) FILTER (WHERE l_linenumber = 7) AS BIGINT) AS broken_proba_in_range,
         CAST(count(DISTINCT l_suppkey % 25 + 1) FILTER (WHERE l_partkey % 13 NOT IN (0, 1)) AS BIGINT) AS entities,
         CAST(count(*) FILTER (WHERE l_partkey % 13 IN (0, 1)) AS BIGINT) AS ids_out_of_range FROM lineitem""")
def gate_prediction_contract(spark, sf):
    """Landed predictions, all columns as text, with unreadable dates and ids and probabilities above 1, counted
    by the aggregates that the jobs observe while writing."""
    r = read_table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 11 == 0, "n/a").otherwise(F.to_date("l_shipdate").cast("string")).alias("date"),
        F.when(F.col("l_partkey") % 13 == 0, "north").when(F.col("l_partkey") % 13 == 1, "0")
        .otherwise((F.col("l_suppkey") % 25 + 1).cast("string")).alias("nbhd_id"),
        F.when(F.col("l_linenumber") == 7, "1.25").otherwise("0.5").alias("proba_collision_t1"))
    found = Q.contract_metrics("nbhd_predictions") | Q.entity_metrics()
    return Q.coerced(r, "nbhd_predictions").agg(*[m.cast("bigint").alias(k) for k, m in found.items()])


@query("gate_feature_contract", """
  SELECT CAST(count(*) FILTER (WHERE l_linenumber = 6) AS BIGINT) AS broken_lag_present,
         CAST(count(*) FILTER (WHERE l_linenumber IN (4, 5)) AS BIGINT) AS broken_targets_binary, 0::BIGINT AS broken_date_not_null,
         0::BIGINT AS broken_nbhd_id_ge_1 FROM lineitem""")
def gate_feature_contract(spark, sf):
    """Feature rows with lags missing and targets that are not 0 or 1."""
    k = F.col("l_linenumber")
    r = read_table(spark, sf, "lineitem").select(
        F.to_date("l_shipdate").alias("date"), (F.col("l_suppkey") % 25 + 1).cast("int").alias("nbhd_id"),
        F.when(k != 6, F.col("l_quantity")).alias("collisions_lag1"), F.when(k == 5, None).when(k == 4, 2).otherwise(k % 2).alias("target_collision_t1"))
    return Q.coerced(r, "features").agg(*[m.cast("bigint").alias(n) for n, m in Q.contract_metrics("features").items()])


@query("merge_loads", """
  WITH l AS (SELECT o_custkey, o_orderdate::DATE AS date, count(*) AS n, sum(o_orderkey % 7)::BIGINT AS v FROM orders GROUP BY 1, 2)
  SELECT o_custkey, date, n, v + CASE WHEN date >= DATE '1997-03-10' THEN 1 ELSE 0 END AS v,
         CASE WHEN date >= DATE '1997-03-10' THEN 2 ELSE 1 END AS load_seq, 'merged,merged,repeated' AS statuses FROM l""")
def merge_loads(spark, sf):
    """A13 by period: a first load up to a day in 1997, a second one that overlaps it, and the second once more."""
    o = read_table(spark, sf, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("date")).agg(
        F.count("*").alias("n"), F.sum(F.col("o_orderkey") % 7).alias("v"))
    path = Rd.landing_dir(spark, "orders-state")
    first = o.where("date < DATE'1997-04-01'").withColumn("load_seq", F.lit(1))
    second = o.where("date >= DATE'1997-03-10'").withColumn("v", F.col("v") + 1).withColumn("load_seq", F.lit(2))
    done = [St.merge_load(b, path, i, ["o_custkey", "date"])["status"] for b, i in ((first, "a"), (second, "b"), (second, "b"))]
    return St.read_state(spark, path).withColumn("statuses", F.lit(",".join(done)))


@query("merged_feeds", """
  SELECT coalesce(e.date, c.date) AS date, coalesce(e.custkey, c.custkey) AS custkey, coalesce(events, 0) AS events, coalesce(works, 0) AS works
  FROM (SELECT o_orderdate::DATE AS date, o_custkey AS custkey, count(*) AS events FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1, 2) e
  FULL JOIN (SELECT o_orderdate::DATE AS date, o_custkey AS custkey, count(*) AS works FROM orders WHERE o_orderkey % 2 <> 0 GROUP BY 1, 2) c
    ON e.date = c.date AND e.custkey = c.custkey""")
def merged_feeds(spark, sf):
    """The daily counts of two feeds, full outer join on the key, gaps 0."""
    o = read_table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date"), F.col("o_custkey").alias("custkey"), "o_orderkey")
    keys = ["date", "custkey"]
    e, w = (o.where(c).groupBy(*keys).agg(F.count("*").alias(n)) for c, n in (("o_orderkey % 2 = 0", "events"), ("o_orderkey % 2 <> 0", "works")))
    return e.join(w, keys, "full").na.fill(0, ["events", "works"])


@query("canonical_columns", """
  SELECT CAST(c_custkey AS INTEGER) AS nbhd_id, c_name AS area_name, c_nationkey FROM customer""")
def canonical_columns(spark, sf):
    """B3 + N6: aliases renamed to one name each, of columns then equal the first kept; the needed ones are there."""
    c = read_table(spark, sf, "customer").select(F.col("c_custkey").cast("int").alias("HOOD_ID"), F.col("c_name").alias("AREA_NAME"),
                                                 F.lit("later").alias("area_name"), "c_nationkey", F.lit(-1).alias("Nbhd_Id"))
    out = Q.canonical_columns(c, {"HOOD_ID": "nbhd_id", "Nbhd_Id": "nbhd_id", "AREA_NAME": "area_name"})
    Q.require_columns(out, ("nbhd_id", "area_name"))
    return out


@query("join_row_counts", """
  SELECT count(*) AS rows_before, (SELECT count(*) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) AS rows_after,
         (SELECT count(*) + count(*) FILTER (WHERE s_suppkey % 9 = 0) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) AS rows_doubled FROM lineitem""")
def join_row_counts(spark, sf):
    """Rows before a lookup join, after it, and after one whose dimension lists some keys twice, each observed in the
    pass that writes its join."""
    li = read_table(spark, sf, "lineitem").select("l_suppkey")
    s = read_table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"))
    count = {"rows": F.count(F.lit(1))}
    before = Observation()
    base = Rd.landing_dir(spark, "rows")
    after = Rd.write_observed(li.observe(before, count["rows"].alias("rows")).join(s, "l_suppkey", "left"), f"{base}/a", count)["rows"]
    doubled = Rd.write_observed(li.join(s.union(s.where("l_suppkey % 9 = 0")), "l_suppkey", "left"), f"{base}/b", count)["rows"]
    return spark.createDataFrame([(before.get["rows"], after, doubled)], "rows_before long, rows_after long, rows_doubled long")
