"""Holiday dimension built from date rules.

The nine named statutory holidays are generated per year as date expressions:
New Year's Day (Jan 1), Family Day (third Monday of February, from 2008),
Good Friday (two days before Easter Sunday), Victoria Day (last Monday on or
before May 24), Canada Day (Jul 1), Labour Day (first Monday of September),
Thanksgiving (second Monday of October), Christmas (Dec 25), Boxing Day (Dec 26).
Observed (moved) dates are optional and off by default.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_holiday(d: str, include_observed: bool = False) -> Column:
    """Row expression: is the date ``d`` (SQL text) one of the nine holidays of its own year?
    With ``include_observed`` the Monday after a holiday on a weekend counts too."""
    def named(x: str) -> str:
        return f"array_contains({holidays_of_year_sql(f'year({x})')}, {x})"

    hit = named(d)
    if include_observed:
        hit = f"({hit} OR (weekday({d}) = 0 AND ({named(f'date_sub({d}, 1)')} OR {named(f'date_sub({d}, 2)')})))"
    return F.expr(hit)


def holidays_of_year_sql(y: str) -> str:
    """SQL text of :func:`holidays_of_year` for a year expression ``y`` (one
    expression string: a single call into the JVM instead of hundreds)."""
    a, b, c = f"({y} % 19)", f"({y} div 100)", f"({y} % 100)"
    d, e = f"({b} div 4)", f"({b} % 4)"
    f_ = f"(({b} + 8) div 25)"
    g = f"(({b} - {f_} + 1) div 3)"
    h = f"((19 * {a} + {b} - {d} - {g} + 15) % 30)"
    i, k = f"({c} div 4)", f"({c} % 4)"
    el = f"((32 + 2 * {e} + 2 * {i} - {h} - {k}) % 7)"
    m = f"(({a} + 11 * {h} + 22 * {el}) div 451)"
    s = f"({h} + {el} - 7 * {m} + 114)"
    easter = f"make_date(CAST({y} AS INT), CAST({s} div 31 AS INT), CAST({s} % 31 + 1 AS INT))"

    def md(mo, dy):
        return f"make_date(CAST({y} AS INT), {mo}, {dy})"

    def nth_monday(mo, n):
        first = md(mo, 1)
        return f"date_add({first}, pmod(7 - weekday({first}), 7) + {7 * (n - 1)})"

    rules = [md(1, 1), f"CASE WHEN {y} >= 2008 THEN {nth_monday(2, 3)} END", f"date_sub({easter}, 2)",
             f"date_sub({md(5, 24)}, weekday({md(5, 24)}))", md(7, 1), nth_monday(9, 1), nth_monday(10, 2),
             md(12, 25), md(12, 26)]
    return f"filter(array({', '.join(rules)}), x -> x IS NOT NULL)"


def holidays_of_year(y: str) -> Column:
    """Array of the holiday dates of the year ``y`` (SQL text); Family Day is absent before 2008."""
    return F.expr(holidays_of_year_sql(y))
