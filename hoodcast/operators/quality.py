"""Data-quality gates.

Each gate returns a small DataFrame of violations / counts so it can be
checked lazily, logged or written; ``require_empty`` and ``require_columns``
are the raising wrappers used by jobs (one bounded ``limit`` action).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys occurring more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def duplicate_count(df: DataFrame, keys) -> DataFrame:
    """Rows beyond the first per key: ``rows, distinct_keys, duplicates``."""
    d = df.select(*keys).groupBy(*keys).count()
    return d.agg(F.sum("count").alias("rows"), F.count(F.lit(1)).alias("distinct_keys")).select(
        "rows", "distinct_keys", (F.col("rows") - F.col("distinct_keys")).alias("duplicates"))


def expected_entities(df: DataFrame, expected: int, col: str = "nbhd_id") -> DataFrame:
    """Number of distinct entities vs the expected count."""
    return df.agg(F.count_distinct(col).alias("n")).select(
        "n", F.lit(expected).alias("expected"), (F.col("n") == expected).alias("ok"))


def contract_violations(df: DataFrame, rules: dict) -> DataFrame:
    """One row of violation counts, one column per named rule (a boolean
    column expression that must hold; null counts as a violation)."""
    return df.agg(*[F.sum(F.when(F.coalesce(cond, F.lit(False)), 0).otherwise(1)).alias(name)
                    for name, cond in rules.items()])


def contract(name: str) -> dict:
    """The named rules of a table's contract."""
    key = {"date_not_null": F.col("date").isNotNull()}
    area = key | {"nbhd_id_ge_1": F.coalesce(F.col("nbhd_id") >= 1, F.lit(False))}
    return {
        "gold": area | {"collisions_ge_0": F.col("collisions") >= 0, "weather_present": F.col("tavg").isNotNull(),
                        "fatal_le_victims": F.col("ksi_fatal_victims") <= F.col("ksi_victim_count")},
        "features": area | {"lag_present": F.col("collisions_lag1").isNotNull(),
                            "targets_binary": F.col("target_collision_t1").isin(0, 1)},
        "surge_predictions": key | {"proba_in_range": F.col("surge_proba_t1").isNull() | F.col("surge_proba_t1").between(0, 1)},
        "nbhd_predictions": area | {"proba_in_range": F.col("proba_collision_t1").isNull()
                                    | F.col("proba_collision_t1").between(0, 1)},
    }[name]


#: Columns a table needs (N6), and the types of its contract; a text that is no such value counts as null.
CONTRACT_TYPES = {
    "gold": {"date": "date", "nbhd_id": "int", "collisions": "bigint", "tavg": "double"},
    "features": {"date": "date", "nbhd_id": "int", "collisions_lag1": "double", "target_collision_t1": "int"},
    "surge_predictions": {"date": "date", "surge_proba_t1": "double"},
    "nbhd_predictions": {"date": "date", "nbhd_id": "int", "proba_collision_t1": "double"},
}


def coerced(df: DataFrame, name: str) -> DataFrame:
    """The contract's columns in its types before the rules are read; what cannot be converted becomes null,
    which the rules then refuse where a value is required. N6 first: the columns must exist."""
    types = CONTRACT_TYPES[name]
    require_columns(df, types)
    have = dict(df.dtypes)
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if have[c] != t}) if any(
        have[c] != t for c, t in types.items()) else df


def contract_metrics(name: str) -> dict:
    """N3 as aggregates: rows that break each rule of the contract (null counts as broken)."""
    return {f"broken_{rule}": F.count_if(~F.coalesce(cond, F.lit(False))) for rule, cond in contract(name).items()}


#: Ids that the entity count of ``entity_metrics`` covers: a fixed set of bits.
ENTITY_IDS = 32_768


def entity_metrics(col: str = "nbhd_id") -> dict:
    """N2 as aggregates of fixed size: distinct ids from 1 to ``ENTITY_IDS``, and rows with an id beyond."""
    good = F.col(col).between(1, ENTITY_IDS)
    return {"entities": F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(F.when(good, F.col(col).cast("bigint"))))),
            "ids_out_of_range": F.count_if(~F.coalesce(good, F.lit(False)))}


def refuse(found: dict, name: str, expected: int | None = None, rows: int | None = None) -> None:
    """Raise when the aggregates of ``contract_metrics`` / ``entity_metrics`` / ``rows`` say that a gate fails
    (N2, N3, N5)."""
    broken = {k.removeprefix("broken_"): n for k, n in found.items() if k.startswith("broken_") and n}
    if broken:
        raise ValueError(f"{name} contract: {broken}")
    if expected is not None and (found["entities"] != expected or found["ids_out_of_range"]):
        raise ValueError(f"{name} has {found['entities']} distinct nbhd_id and {found['ids_out_of_range']} rows with none; expected {expected}")
    if rows is not None and found["rows"] != rows:
        raise ValueError(f"{name}: {rows} rows before, {found['rows']} after")


def require_contract(df: DataFrame, name: str) -> None:
    """Raise with the violation counts when a rule of the contract is broken (types first, then rules)."""
    refuse(coerced(df, name).agg(*[m.alias(k) for k, m in contract_metrics(name).items()]).first().asDict(), name)


def require_panel(df: DataFrame, name: str, expected: int) -> None:
    """A panel's gates in one pass over its rows: contract (N3), expected areas (N2), unique key (N1) and one row per
    area and day (T4). Rows collapse per area first; what comes back is one row of counts."""
    df = coerced(df, name)
    area = df.groupBy("nbhd_id").agg(
        F.count("*").alias("n"), F.count_distinct("date").alias("d"), (F.datediff(F.max("date"), F.min("date")) + 1).alias("span"),
        *[m.alias(k) for k, m in contract_metrics(name).items()])
    total = area.agg(F.count("nbhd_id").alias("entities"), F.sum(F.when(F.col("nbhd_id").isNull(), F.col("n")).otherwise(0)).alias("ids_out_of_range"),
                     F.count_if(F.col("n") != F.col("d")).alias("repeated"), F.count_if(F.col("d") != F.col("span")).alias("gaps"),
                     *[F.sum(k).alias(k) for k in contract_metrics(name)]).first().asDict()
    if total["repeated"]:
        raise ValueError(f"{name} key: {total['repeated']} areas with a day twice, or without a date")
    refuse(total, name, expected)
    if total["gaps"]:
        raise ValueError(f"{name} days: {total['gaps']} areas with days missing")


def require_entities(df: DataFrame, expected: int, what: str, col: str = "nbhd_id") -> None:
    """N2 as a gate."""
    n = expected_entities(df, expected, col).first()["n"]
    if n != expected:
        raise ValueError(f"{what} has {n} distinct {col}; expected {expected}")


def require_same_rows(before: DataFrame, after: DataFrame, what: str) -> None:
    """A left join must not change the number of rows."""
    a, b = before.count(), after.count()
    if a != b:
        raise ValueError(f"{what}: {a} rows before, {b} after")


def require_lookup(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, what: str) -> DataFrame:
    """``facts`` when every key is in the dimension, which must be unique on it."""
    require_empty(duplicate_keys(dim, [dim_key]), f"{what} dimension key")
    require_empty(missing_lookup(facts, dim, fact_key, dim_key), f"{what} without a match")
    return facts


def missing_lookup(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                   limit: int = 10) -> DataFrame:
    """Fact keys without a dimension match (up to ``limit`` offending keys,
    with their row counts)."""
    d = dim.select(F.col(dim_key).alias(fact_key)).distinct()
    miss = facts.join(d, fact_key, "left_anti")
    return miss.groupBy(fact_key).agg(F.count(F.lit(1)).alias("rows")).orderBy(fact_key).limit(limit)


def require_empty(violations: DataFrame, what: str) -> None:
    """Raise with up to 10 offending rows when ``violations`` is not empty."""
    rows = violations.limit(10).collect()
    if rows:
        raise ValueError(f"{what}: {len(rows)}+ violations, e.g. {rows}")


def require_columns(df: DataFrame, cols) -> None:
    """Named columns must exist."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns {missing}")


def coverage(df: DataFrame, entities: DataFrame, key: str = "nbhd_id", date_col: str = "date") -> DataFrame:
    """Expected vs present groups and exact rows = entities x days."""
    present = df.select(key).distinct()
    n_missing = entities.select(key).distinct().join(present, key, "left_anti").select(
        F.count(F.lit(1))).scalar()
    n_extra = present.join(entities.select(key).distinct(), key, "left_anti").select(F.count(F.lit(1))).scalar()
    return df.agg(
        F.count_distinct(key).alias("n_entities"),
        F.count_distinct(date_col).alias("n_days"),
        F.count(F.lit(1)).alias("n_rows"),
        (F.datediff(F.max(date_col), F.min(date_col)) + 1).alias("span_days"),
    ).select("*", n_missing.alias("missing_entities"), n_extra.alias("extra_entities"),
             ((F.col("n_rows") == F.col("n_entities") * F.col("span_days"))
              & (n_missing == 0) & (n_extra == 0)).alias("ok"))


def density_violations(df: DataFrame, key: str = "nbhd_id", date_col: str = "date") -> DataFrame:
    """T4: areas whose rows do not form one row per consecutive day."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(date_col).alias("d"),
        (F.datediff(F.max(date_col), F.min(date_col)) + 1).alias("span")).where(
        (F.col("n") != F.col("span")) | (F.col("d") != F.col("n")))


def probability_target_checks(df: DataFrame, prob_cols, target_cols) -> DataFrame:
    """Probabilities in [0, 1] or null; targets binary and non-null."""
    aggs = [F.sum(F.when(F.col(c).isNotNull() & ~F.col(c).between(0, 1), 1).otherwise(0))
            .alias(f"{c}_out_of_range") for c in prob_cols]
    aggs += [F.sum(F.when(F.col(c).isNull() | ~F.col(c).isin(0, 1), 1).otherwise(0))
             .alias(f"{c}_bad") for c in target_cols]
    return df.agg(*aggs)


def audit(spark, tables: dict, required: dict) -> DataFrame:
    """Per table ``name, status, rows, n_columns`` with status OK,
    MISSING (unreadable), BAD_ROWS (empty) or BAD_SCHEMA (required columns absent)."""
    parts = []
    for name, path in tables.items():
        try:
            df = spark.read.parquet(path)
        except Exception:  # noqa: BLE001 - an unreadable artefact is reported, not raised
            parts.append(spark.range(1).select(F.lit(name).alias("name"), F.lit("MISSING").alias("status"),
                                               F.lit(None).cast("bigint").alias("rows"),
                                               F.lit(None).cast("int").alias("n_columns")))
            continue
        lacks = [c for c in required.get(name, ()) if c not in df.columns]
        n = df.select(F.count(F.lit(1)).alias("rows"))
        status = (F.lit("BAD_SCHEMA") if lacks else
                  F.when(F.col("rows") == 0, F.lit("BAD_ROWS")).otherwise(F.lit("OK")))
        parts.append(n.select(F.lit(name).alias("name"), status.alias("status"), "rows",
                              F.lit(len(df.columns)).alias("n_columns")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def set_difference(expected: DataFrame, actual: DataFrame, keys) -> DataFrame:
    """H2: expected keys absent from ``actual``."""
    return expected.select(*keys).distinct().join(actual.select(*keys).distinct(), list(keys), "left_anti")


def is_subset(part: DataFrame, whole: DataFrame, keys) -> DataFrame:
    """H4: one row ``subset`` = no key of ``part`` is missing from ``whole``."""
    n = set_difference(part, whole, keys).select(F.count(F.lit(1)).alias("n"))
    return n.select((F.col("n") == 0).alias("subset"))


def incremental_merge(old: DataFrame, new: DataFrame, keys, seq: str = "load_seq",
                      grid: DataFrame | None = None) -> DataFrame:
    """Idempotent merge, keep the last load per key.

    Old state is discarded when its schema, names or types, differs from the new batch (the
    reference's schema gate); otherwise ``old UNION new`` and the row with the highest
    ``seq`` per key. With ``grid`` (the expected keys) a batch with a key off the grid, or
    with a key twice in one load, is refused. The result is meant to be written to a new
    path (never over the input it was read from).
    """
    if grid is not None:
        require_empty(new.select(*keys).distinct().join(grid.select(*keys).distinct(), list(keys), "left_anti"),
                      "batch keys off the grid")
        require_empty(duplicate_keys(new, [*keys, seq]), "batch keys")
    if sorted(old.dtypes) != sorted(new.dtypes):
        return new
    w = Window.partitionBy(*keys).orderBy(F.col(seq).desc())
    u = old.unionByName(new)
    return u.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def table_profile(df: DataFrame, key: str = "nbhd_id", date_col: str = "date") -> DataFrame:
    """Rows, date range and distinct entities in one aggregate."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.min(date_col).alias("min_date"),
                  F.max(date_col).alias("max_date"), F.count_distinct(key).alias("n_entities"))


def column_profile(df: DataFrame, cols) -> DataFrame:
    """Per column count, nulls, non-zeros, mean, min, max (one pass,
    then unpivoted to one row per column)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.count_if(x.isNull()).alias(f"{c}__nulls"),
                 F.count_if(x != 0).alias(f"{c}__nonzero"), F.avg(x).alias(f"{c}__mean"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__n").alias("n"),
                              F.col(f"{c}__nulls").alias("nulls"), F.col(f"{c}__nonzero").alias("nonzero"),
                              F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__min").alias("min"),
                              F.col(f"{c}__max").alias("max")) for c in cols])
    return one.select(F.inline(rows))


def missing_rate(df: DataFrame, cols, threshold: float = 0.05) -> DataFrame:
    """Share of nulls per column and whether it exceeds ``threshold``."""
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing_rate")) for c in cols])
    return one.select(F.inline(rows)).withColumn("above_threshold", F.col("missing_rate") > threshold)


def canonical_columns(df: DataFrame, aliases: dict) -> DataFrame:
    """Rename known aliases to one canonical name; among equal names the
    first column wins (positional, so duplicate names are handled)."""
    names = [aliases.get(c, c) for c in df.columns]
    keep, seen = [], set()
    for i, n in enumerate(names):
        if n not in seen:
            seen.add(n)
            keep.append(i)
    tmp = df.toDF(*[f"__c{i}" for i in range(len(names))])
    return tmp.select(*[F.col(f"__c{i}").alias(names[i]) for i in keep])
