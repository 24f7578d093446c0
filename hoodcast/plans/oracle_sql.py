"""DuckDB oracle SQL: the adapter and the engine layers written as plain SQL
CTEs over the driver's tables, shared by every oracle query."""

from __future__ import annotations

BASE_CTES = {
    "areas": """
  SELECT CAST(n_nationkey + 1 AS INTEGER) AS nbhd_id,
         CAST(n_nationkey + 1000 AS VARCHAR) AS area_id,
         n_name AS area_name
  FROM nation""",
    "li_s": """
  SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, CAST(l_shipdate AS DATE) AS date,
         s_nationkey
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    # K2: (0, 0) points fall outside the bounding box; every other point lies
    # strictly inside its supplier nation's square.
    "coll_daily": """
  SELECT date, CAST(s_nationkey + 1 AS INTEGER) AS nbhd_id, count(*) AS collision_count
  FROM li_s WHERE l_partkey % 50 <> 0 GROUP BY 1, 2""",
    "days": """
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT min(date) AS lo, max(date) AS hi FROM coll_daily)""",
    "panel": """
  SELECT d.date, a.nbhd_id, a.area_id, a.area_name,
         CAST(coalesce(c.collision_count, 0) AS BIGINT) AS collisions
  FROM areas a CROSS JOIN days d
  LEFT JOIN coll_daily c ON c.date = d.date AND c.nbhd_id = a.nbhd_id""",
    "ksi_p": """
  SELECT l_orderkey AS accnum, date, CAST(s_nationkey + 1 AS INTEGER) AS nbhd_id,
         CASE WHEN l_quantity >= 49 THEN 1 ELSE 0 END AS is_fatal,
         CASE WHEN l_quantity >= 45 AND l_quantity < 49 THEN 1 ELSE 0 END AS is_serious
  FROM li_s WHERE l_quantity >= 40 AND l_partkey % 41 <> 0""",
    "ksi_acc": """
  SELECT accnum, date, nbhd_id, max(is_fatal) AS fatal_collision,
         max(is_serious) AS serious_collision, sum(is_fatal) AS fatal_victims,
         count(*) AS victim_count
  FROM ksi_p GROUP BY 1, 2, 3""",
    "ksi_daily": """
  SELECT date, nbhd_id, count(DISTINCT accnum) AS ksi_collisions,
         CAST(sum(fatal_collision) AS BIGINT) AS ksi_fatal_collisions,
         CAST(sum(serious_collision) AS BIGINT) AS ksi_serious_collisions,
         CAST(sum(fatal_victims) AS BIGINT) AS ksi_fatal_victims,
         CAST(sum(victim_count) AS BIGINT) AS ksi_victim_count,
         CAST(3 * sum(fatal_collision) + 2 * sum(serious_collision) AS BIGINT) AS ksi_weighted_score
  FROM ksi_acc GROUP BY 1, 2""",
    "wdays": """
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem)""",
    "weather_raw": """
  SELECT date,
         CAST(18 - abs(dayofyear(date) - 200) // 6 + 5 AS DOUBLE) AS tavg,
         CAST(18 - abs(dayofyear(date) - 200) // 6 AS DOUBLE) AS tmin,
         CAST(18 - abs(dayofyear(date) - 200) // 6 + 10 AS DOUBLE) AS tmax,
         CAST(greatest((dayofyear(date) * 7 + year(date)) % 13 - 7, 0) AS DOUBLE) AS prcp,
         CAST(CASE WHEN 18 - abs(dayofyear(date) - 200) // 6 <= 0
                   THEN 2 * greatest((dayofyear(date) * 7 + year(date)) % 13 - 7, 0) ELSE 0 END AS DOUBLE) AS snow,
         CAST((dayofyear(date) * 11 + year(date)) % 45 AS DOUBLE) AS wspd
  FROM wdays""",
    "weather": """
  SELECT *, CAST(tmin <= 0 AS INTEGER) AS freeze_day, CAST(snow > 0 AS INTEGER) AS snow_day,
         CAST(prcp > 0 AS INTEGER) AS rain_day
  FROM weather_raw""",
    "dis": """
  SELECT o_orderkey AS id, CAST(c_nationkey + 1 AS INTEGER) AS nbhd_id,
         CAST(o_orderdate AS DATE) AS start_date,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL
              ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 12 - 1 AS INTEGER) END AS end_date,
         CASE WHEN o_orderkey % 2 = 0 THEN 'construction' ELSE 'event' END AS source,
         CASE WHEN o_orderkey % 2 = 0 THEN 1
              WHEN o_orderpriority = '1-URGENT' THEN 3
              WHEN o_orderpriority = '2-HIGH' THEN 2 ELSE 1 END AS severity_weight,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS full_closure_flag
  FROM orders JOIN customer ON o_custkey = c_custkey""",
    "dis_days": """
  SELECT id, nbhd_id, source, severity_weight, full_closure_flag,
         CAST(unnest(generate_series(start_date, greatest(coalesce(end_date, start_date), start_date),
                                     INTERVAL 1 DAY)) AS DATE) AS date
  FROM dis WHERE start_date IS NOT NULL""",
    "road_daily": """
  SELECT date, nbhd_id,
         CAST(count(*) FILTER (WHERE source = 'event') AS BIGINT) AS events_count,
         CAST(coalesce(sum(severity_weight) FILTER (WHERE source = 'event'), 0) AS BIGINT) AS events_severity_weighted,
         CAST(coalesce(sum(full_closure_flag) FILTER (WHERE source = 'event'), 0) AS BIGINT) AS events_full_closure_count,
         CAST(count(*) FILTER (WHERE source = 'construction') AS BIGINT) AS construction_count,
         CAST(coalesce(sum(severity_weight) FILTER (WHERE source = 'construction'), 0) AS BIGINT) AS construction_severity_weighted,
         CAST(coalesce(sum(full_closure_flag) FILTER (WHERE source = 'construction'), 0) AS BIGINT) AS construction_full_closure_count
  FROM dis_days GROUP BY 1, 2""",
    "gold": """
  SELECT p.*,
         CAST(coalesce(k.ksi_collisions, 0) AS BIGINT) AS ksi_collisions,
         CAST(coalesce(k.ksi_fatal_collisions, 0) AS BIGINT) AS ksi_fatal_collisions,
         CAST(coalesce(k.ksi_serious_collisions, 0) AS BIGINT) AS ksi_serious_collisions,
         CAST(coalesce(k.ksi_fatal_victims, 0) AS BIGINT) AS ksi_fatal_victims,
         CAST(coalesce(k.ksi_victim_count, 0) AS BIGINT) AS ksi_victim_count,
         CAST(coalesce(k.ksi_weighted_score, 0) AS BIGINT) AS ksi_weighted_score,
         w.tavg, w.tmin, w.tmax, w.prcp, w.snow, w.wspd, w.freeze_day, w.snow_day, w.rain_day,
         CAST(coalesce(r.events_count, 0) AS BIGINT) AS road_events_count,
         CAST(coalesce(r.events_severity_weighted, 0) AS BIGINT) AS road_events_severity_weighted,
         CAST(coalesce(r.events_full_closure_count, 0) AS BIGINT) AS road_events_full_closure_count,
         CAST(coalesce(r.construction_count, 0) AS BIGINT) AS road_construction_count,
         CAST(coalesce(r.construction_severity_weighted, 0) AS BIGINT) AS road_construction_severity_weighted,
         CAST(coalesce(r.construction_full_closure_count, 0) AS BIGINT) AS road_construction_full_closure_count
  FROM panel p
  LEFT JOIN ksi_daily k ON k.date = p.date AND k.nbhd_id = p.nbhd_id
  LEFT JOIN weather w ON w.date = p.date
  LEFT JOIN road_daily r ON r.date = p.date AND r.nbhd_id = p.nbhd_id""",
    # 8-neighbourhood on the 5 x 5 grid (corner contact counts)
    "adj": """
  SELECT a.nbhd_id, b.nbhd_id AS adjacent_nbhd_id
  FROM areas a JOIN areas b
    ON a.nbhd_id <> b.nbhd_id
   AND abs(((a.nbhd_id - 1) % 5) - ((b.nbhd_id - 1) % 5)) <= 1
   AND abs(((a.nbhd_id - 1) // 5) - ((b.nbhd_id - 1) // 5)) <= 1""",
}


def sql(body: str, extra: dict | None = None, recursive: bool = False) -> str:
    """Prefix ``body`` with every base CTE (DuckDB drops the unused ones)."""
    ctes = dict(BASE_CTES)
    if extra:
        ctes.update(extra)
    parts = ",\n".join(f"{k} AS ({v}\n)" for k, v in ctes.items())
    return f"WITH {'RECURSIVE ' if recursive else ''}{parts}\n{body}"
