"""Column-expression helpers (B*, I*): everything stays a JVM expression."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from hoodcast.config import SEVERITY_WEIGHTS, TRUTHY_TOKENS


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c, dtype: str = "double") -> Column:
    """Lenient numeric coercion, bad text becomes null (ANSI-safe)."""
    return F.expr(f"try_cast({c} AS {dtype})") if isinstance(c, str) else col_(c).try_cast(dtype)


def safe_div(num, den) -> Column:
    """``num / nullif(den, 0)`` (plain division throws under ANSI)."""
    d = col_(den)
    return F.when(d != 0, col_(num) / d)


def flag(cond: Column) -> Column:
    """Boolean condition as 0/1 int; a null condition counts as 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def regex_flag(c, pattern: str) -> Column:
    """Case-insensitive regex contains, null text -> false."""
    return F.coalesce(col_(c).cast("string").rlike(f"(?i){pattern}"), F.lit(False))


def truthy_flag(c) -> Column:
    """trimmed/lower-cased text in {true, 1, yes} -> 1 else 0."""
    return F.coalesce(
        F.lower(F.trim(col_(c).cast("string"))).isin(*TRUTHY_TOKENS).cast("int"), F.lit(0))


def severity_weight(c, mapping: dict | None = None, default: int = 1) -> Column:
    """Map literal with default for unknown / null text."""
    mapping = mapping or SEVERITY_WEIGHTS
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    key = F.lower(F.trim(col_(c).cast("string")))
    return F.coalesce(F.element_at(m, key), F.lit(default)).cast("int")


def clip(c, lower=None, upper=None) -> Column:
    """Bound values (nulls stay null)."""
    x = col_(c)
    if lower is not None:
        x = F.when(x.isNull(), x).otherwise(F.greatest(x, F.lit(lower)))
    if upper is not None:
        x = F.when(x.isNull(), x).otherwise(F.least(x, F.lit(upper)))
    return x


def clean_feature(c) -> Column:
    """NaN and +-inf -> null -> 0."""
    x = col_(c).cast("double")
    bad = F.isnan(x) | x.isin(float("inf"), float("-inf"))
    return F.coalesce(F.when(~bad, x), F.lit(0.0))


def nan_to_null(c) -> Column:
    """NaN becomes null at ingestion."""
    x = col_(c)
    return F.when(~F.isnan(x), x)


def rfc1123_to_date(c) -> Column:
    """Text like ``Sun, 01 Jan 2006 10:00:00 GMT`` -> UTC date; bad -> null.

    The weekday prefix is skipped (``EEE`` is not accepted by Spark's parser);
    the rest is parsed with a fixed pattern, ``try_`` so bad text gives null.
    """
    body = F.substring(col_(c), 6, 20)
    return F.to_date(F.try_to_timestamp(body, F.lit("dd MMM yyyy HH:mm:ss")))


def rfc1123_text(d) -> Column:
    """Inverse of :func:`rfc1123_to_date` for a DATE/TIMESTAMP column (GMT)."""
    return F.date_format(col_(d), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")


def epoch_to_ts(c) -> Column:
    """Epoch seconds (any text/number) -> timestamp; bad -> null."""
    return F.timestamp_seconds(to_number(c, "bigint"))


def epoch_to_date(c) -> Column:
    """B9+B10: epoch seconds -> UTC calendar date without a session-time-zone hop."""
    secs = to_number(c, "bigint")
    return F.date_from_unix_date(F.floor(secs / 86400).cast("int"))


def days_between(a, b) -> Column:
    """Fractional days between two timestamps."""
    return (F.unix_seconds(col_(b)) - F.unix_seconds(col_(a))) / 86400.0


def coord_key(lat, lon, digits: int = 1) -> Column:
    """Rounded composite key, half-even like numpy."""
    return F.concat_ws("_", F.bround(col_(lat), digits).cast("string"),
                       F.bround(col_(lon), digits).cast("string"))


def cyclic(c, period: int):
    """sin/cos encoding of an ordinal."""
    ang = 2 * F.pi() * col_(c) / F.lit(period)
    return F.sin(ang), F.cos(ang)
