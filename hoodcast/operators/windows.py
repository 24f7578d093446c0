"""Window builders (F1-F9, F16): lags, leads and trailing windows per area.

All columns of one family are produced by a single ``select`` over windows
that share ``partitionBy(area).orderBy(date)``, so Spark plans one exchange
and one sort for the whole family (each distinct frame adds only a Window
operator over already-sorted data).  Lags count rows, so the input must be
dense (one row per area and day, see ``quality.density_violations``).
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType


def area_window(part: str | list = "nbhd_id", order: str = "date"):
    parts = [part] if isinstance(part, str) else list(part)
    return Window.partitionBy(*parts).orderBy(order)


def in_blocks(df, days: int, back: int, ahead: int, order: str = "date"):
    """Time blocks of ``days`` days, so that an area's history is the work of several tasks: ``_block`` is the block a row
    is worked in, ``_own`` whether it is its own. A block also gets the ``back`` days before it and the
    ``ahead`` days after it, as far as its windows look; these copies are dropped afterwards (``own_rows``).
    For dense input, where a row is a day; ``days`` exceeds ``back + ahead``."""
    if days <= back + ahead:
        raise ValueError("a block has to be longer than its windows look back and ahead")
    day = F.unix_date(order)
    block, at = F.floor(day / days), F.pmod(day, F.lit(days))
    copies = F.array_compact(F.array(block, F.when(at >= days - back, block + 1), F.when(at < ahead, block - 1)))
    return df.withColumn("_block", F.explode(copies)).withColumn("_own", F.col("_block") == block)


def own_rows(df):
    return df.where("_own").drop("_block", "_own")


def lag(c: str, n: int, w) -> Column:
    """value ``n`` rows back; null for the first ``n`` rows."""
    return F.lag(c, n).over(w)


def lead(c: str, n: int, w) -> Column:
    """value ``n`` rows ahead; null at the end."""
    return F.lead(c, n).over(w)


def trailing(c: str, width: int, w, how: str = "mean") -> Column:
    """sum/mean of the ``width`` rows before today (today excluded).

    Null unless all ``width`` prior values are present (pandas ``shift(1)
    .rolling(width)`` semantics: a window touching the series start or a null
    is null).
    """
    fw = w.rowsBetween(-width, -1)
    agg = F.sum(F.col(c).cast("double")) if how == "sum" else F.avg(F.col(c).cast("double"))
    return F.when(F.count(c).over(fw) == width, agg.over(fw))


def trailing_minp(c: str, width: int, min_periods: int, w, how: str = "mean") -> Column:
    """trailing mean/std over ``width`` prior rows with ``min_periods``."""
    fw = w.rowsBetween(-width, -1)
    x = F.col(c).cast("double")
    agg = {"mean": F.avg(x), "std": F.stddev_samp(x), "sum": F.sum(x)}[how]
    return F.when(F.count(c).over(fw) >= min_periods, agg.over(fw))


def lag_roll_columns(cols, lags, widths, w, present=None) -> list[Column]:
    """``{c}_lag{L}``, ``{c}_roll{W}_sum``, ``{c}_roll{W}_mean`` per column,
    skipping columns absent from ``present``."""
    out = []
    for c in cols:
        if present is not None and c not in present:
            continue
        out += [lag(c, L, w).alias(f"{c}_lag{L}") for L in lags]
        for W in widths:
            out.append(trailing(c, W, w, "sum").alias(f"{c}_roll{W}_sum"))
            out.append(trailing(c, W, w, "mean").alias(f"{c}_roll{W}_mean"))
    return out


def _is_integral(df, c: str) -> bool:
    return isinstance(df.schema[c].dataType, IntegralType)


def add_lag_roll(df, cols, lags, widths, w=None, extra=(), part: str | list = "nbhd_id", order: str = "date"):
    """K15 as a frame transform: ``{c}_lag{L}``, ``{c}_roll{W}_sum``,
    ``{c}_roll{W}_mean`` for each present column, plus ``extra`` columns.

    Integral columns use running totals: one unbounded-preceding sum and count
    per column (linear per area), after which every trailing window is the
    difference of two lags of the totals, exact in integer arithmetic.  Other
    columns use bounded ``ROWS BETWEEN W PRECEDING AND 1 PRECEDING`` frames.
    Either way the result is null unless all W prior values are present.

    The window expressions are generated as SQL text for one ``selectExpr``
    (dozens of columns become one call into the JVM instead of thousands of
    small Column calls); all share ``PARTITION BY part ORDER BY order``.
    """
    parts = [part] if isinstance(part, str) else list(part)
    spec = f"PARTITION BY {', '.join(f'`{p}`' for p in parts)} ORDER BY `{order}`"
    present = [c for c in cols if c in df.columns]
    integral = [c for c in present if _is_integral(df, c)]
    helpers = []
    for c in integral:
        helpers += [f"coalesce(sum(`{c}`) OVER ({spec} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) "
                    f"AS `__cs_{c}`",
                    f"count(`{c}`) OVER ({spec} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS `__cn_{c}`"]
    base = df.selectExpr("*", *helpers) if helpers else df
    out, means = [], []
    for c in present:
        out += [f"lag(`{c}`, {L}) OVER ({spec}) AS `{c}_lag{L}`" for L in lags]
        for W in widths:
            if c in integral:
                s_ = f"(lag(`__cs_{c}`, 1) OVER ({spec}) - lag(`__cs_{c}`, {W + 1}, 0) OVER ({spec}))"
                n_ = f"(lag(`__cn_{c}`, 1) OVER ({spec}) - lag(`__cn_{c}`, {W + 1}, 0) OVER ({spec}))"
                out.append(f"CASE WHEN {n_} = {W} THEN CAST({s_} AS DOUBLE) END AS `{c}_roll{W}_sum`")
            else:
                fr = f"({spec} ROWS BETWEEN {W} PRECEDING AND 1 PRECEDING)"
                out.append(f"CASE WHEN count(`{c}`) OVER {fr} = {W} THEN sum(CAST(`{c}` AS DOUBLE)) OVER {fr} END "
                           f"AS `{c}_roll{W}_sum`")
            # the window is full where the sum is present, so the mean is the sum over W
            means.append((f"{c}_roll{W}_sum", f"`{c}_roll{W}_sum` / {W} AS `{c}_roll{W}_mean`"))
    res = base.select("*", *extra) if extra else base
    if out:
        res = res.selectExpr("*", *out)
        after = dict(means)
        drop = {f"__cs_{c}" for c in integral} | {f"__cn_{c}" for c in integral}
        res = res.selectExpr(*[e for c in res.columns if c not in drop
                               for e in ([f"`{c}`", after[c]] if c in after else [f"`{c}`"])])
    return res
