"""Exact quantiles of any number of rows (E8, E9): selection by refining value ranges.

``percentile`` and ``median`` keep every distinct value of a group in one buffer. Here a
wanted rank has a range of values that holds it; the range is cut by approximate quantiles of
the values in it (bounded sketches), the rows of every piece are counted exactly, and the piece with the
rank is the next range. A value that cuts is a piece of its own, so a frequent value ends the
search at once and every round leaves fewer values. Ranges of few rows are read out. Ranks in one
range share it: a value is looked at once per range, however many ranks are wanted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hoodcast.session import cut_lineage

#: Rows of a range that are read out at once; pieces a range is cut into; accuracy of the cuts.
READ_OUT, PIECES, ACCURACY = 1 << 14, 64, 1000
RANGE = ["g", "a", "b", "below"]


def quantiles(df: DataFrame, value: str, probs, by=(), read_out: int = READ_OUT, pieces: int = PIECES) -> DataFrame:
    """``(*by, p, n, quantile)``: linearly interpolated quantiles of ``value`` per group and probability.

    Nulls and NaN are left out; a group without values has no row; null group keys are a group. The values are
    written once, each round reads them once. The result agrees with ``percentile`` bit for bit.
    """
    by = [by] if isinstance(by, str) else list(by)
    keys = [f"_k{i}" for i in range(len(by))]
    v = F.col(value).cast("double")
    # group keys in a struct: null keys join, and no key is a constant one
    group = F.struct(*[F.col(c).alias(k) for c, k in zip(by, keys)], F.lit(0).alias("_"))
    vals = cut_lineage(df.where(v.isNotNull() & ~F.isnan(v)).select(group.alias("g"), v.alias("v")))
    total = vals.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("b"))
    at = F.inline(F.array(*[F.struct(F.lit(float(p)).alias("p"), ((F.col("n") - 1) * F.lit(float(p))).alias("h")) for p in probs]))
    wanted = cut_lineage(total.select("g", "n", "a", "b", at))
    ranks = wanted.select("g", "n", "a", "b", F.explode(F.array(F.floor("h"), F.ceil("h"))).alias("k")).distinct()
    ranks = cut_lineage(ranks.select("g", "k", "a", "b", F.lit(0).cast("long").alias("below"), F.col("n").alias("inside")))
    done = []
    while True:
        small = ranks.where(f"a = b OR inside <= {read_out}")
        done.append(small)
        ranks = ranks.where(f"NOT (a = b OR inside <= {read_out})")
        if ranks.isEmpty():
            break
        ranks = cut_lineage(_refined(vals, ranks, pieces))
    found = done[0]
    for d in done[1:]:
        found = found.unionByName(d)
    found = cut_lineage(found)
    lists = _inside(vals, found.where("a < b")).groupBy(*RANGE).agg(F.sort_array(F.collect_list("v")).alias("vs"))
    few = found.join(lists, RANGE).select("g", "k", F.element_at("vs", (F.col("k") - F.col("below") + 1).cast("int")).alias("x"))
    x = found.where("a = b").select("g", "k", F.col("a").alias("x")).unionByName(few)
    lower = x.select("g", F.col("k").alias("lo"), F.col("x").alias("low"))
    upper = x.select("g", F.col("k").alias("hi"), F.col("x").alias("high"))
    out = wanted.select("g", "p", "n", "h", F.floor("h").alias("lo"), F.ceil("h").alias("hi")) \
        .join(lower, ["g", "lo"]).join(upper, ["g", "hi"])
    q = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(
        (F.col("hi") - F.col("h")) * F.col("low") + (F.col("h") - F.col("lo")) * F.col("high"))
    return out.select(*[F.col("g").getField(k).alias(c) for c, k in zip(by, keys)], "p", "n", q.alias("quantile"))


def _inside(vals: DataFrame, ranks: DataFrame) -> DataFrame:
    """The values of every range that holds a rank, once per range."""
    return vals.join(ranks.select(*RANGE).distinct(), "g").where("v BETWEEN a AND b")


def _refined(vals: DataFrame, ranks: DataFrame, pieces: int) -> DataFrame:
    """Every range cut into pieces, for each rank the piece with it kept."""
    cuts = cut_lineage(_inside(vals, ranks).groupBy(*RANGE).agg(F.array_distinct(F.percentile_approx(
        "v", [i / pieces for i in range(1, pieces)], ACCURACY)).alias("cuts")))
    # an odd piece is a cut itself, an even one lies between two; the cuts below a value by halving steps
    steps = ", ".join(str(1 << i) for i in reversed(range(pieces.bit_length())))
    piece = F.expr(f"aggregate(array({steps}), 0, (acc, s) -> IF(get(cuts, acc + s - 1) < v, acc + s, acc), "
                   "acc -> 2 * acc + IF(get(cuts, acc) = v, 1, 0))")
    inside = vals.join(cuts, "g").where("v BETWEEN a AND b")
    counted = inside.groupBy(*RANGE, piece.alias("piece")).agg(
        F.count("*").alias("inside"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    w = Window.partitionBy(*RANGE).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("before", F.col("below") + F.coalesce(F.sum("inside").over(w), F.lit(0)))
    found = ranks.select("k", *RANGE).join(counted, RANGE).where("k >= before AND k < before + inside")
    return found.select("g", "k", F.col("lo").alias("a"), F.col("hi").alias("b"), F.col("before").alias("below"), "inside")


def median(df: DataFrame, value: str) -> DataFrame:
    """One row ``median``: null without values."""
    q = quantiles(df, value, [0.5])
    return q.agg(F.max("quantile").alias("median"))
