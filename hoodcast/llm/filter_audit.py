"""Filter interaction audit: what every order of a few filters removes at every step.

Each document becomes the set of filters it fails, in one projection; documents are counted
by (part, set, labels). The orders are the paths through the lattice of filter subsets: a
state is the set of filters already applied, an edge (state, filter) applies one more. What
an edge removes depends on nothing else, so a part needs one count per edge, 80 for five
filters, not one per order and step. ``ways`` counts the orders that reach a state (forward)
and that leave it for the end (backward); an edge's removals times the ways before and after
it add up to the filter's Shapley sum, and every order's steps are read from its edges.

Edge cases: a null text is empty and equals other empty texts; a null part is the
empty string; a null id has no smaller one and is no smaller one; rows that share id and
text fail filter E together or not at all; an id labelled twice counts as 1 if any
label is 1; labels of unknown ids say nothing; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hoodcast.llm.registry import query, table

FILTERS = "ABCDE"
#: Fewer words than this fail A; distinct words below this percentage fail B; capitals above this one fail C.
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
SYMBOLS = "[#$%&*|]"


def ways(n: int) -> tuple[list[int], list[int]]:
    """(orders that reach each subset of ``n`` filters, orders that go on from it to the end)."""
    size = 1 << n
    before, after = [0] * size, [0] * size
    before[0] = after[-1] = 1
    for state in range(size):
        for f in range(n):
            if not state >> f & 1:
                before[state | 1 << f] += before[state]
    for state in reversed(range(size)):
        for f in range(n):
            if not state >> f & 1:
                after[state] += after[state | 1 << f]
    return before, after


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(id, part, failed, digest): the filters A to D that a document's own text fails, as a bit set
    (A is 1), and the SHA-256 of its text."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    # one pass over the words for both figures
    found = F.transform(F.array(words), lambda w: F.struct(
        F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct"))).getItem(0)
    d = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                    text.alias("text")).withColumn("words", found)
    fails = [F.col("words.n") < MIN_WORDS,
             100 * F.col("words.distinct") < DISTINCT_PERCENT * F.col("words.n"),
             100 * F.regexp_count("text", F.lit("[A-Z]")).cast("long") > CAPITAL_PERCENT * F.char_length("text"),
             F.col("text").rlike(SYMBOLS)]
    failed = sum((f.cast("int") * (1 << k) for k, f in enumerate(fails)), F.lit(0))
    return d.select("id", "part", failed.alias("failed"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """One row per part, order and step; see the module's docstring and ``COLUMNS``."""
    own = failures(docs, id_col, text_col, part_col).groupBy("id", "digest", "part", "failed").agg(F.count("*").alias("n"))
    marked = labels.where(f"`{id_col}` IS NOT NULL").groupBy(F.col(f"`{id_col}`").alias("id")).agg(
        *[F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c) for c in ("quality", "toxic")])
    # a null id, which may be a hot one, meets no label: it takes no part in the join
    none = own.where("id IS NULL").withColumns({"quality": F.lit(False), "toxic": F.lit(False)})
    own = own.where("id IS NOT NULL").join(marked, "id", "left").na.fill(False, ["quality", "toxic"]).unionByName(none)
    # of equal texts the smallest id passes E; copies collapse before they are dealt
    own = own.groupBy("digest", "part", "failed", "quality", "toxic").agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("unnamed"))
    least = F.min("first.id").over(Window.partitionBy("digest"))
    own = own.withColumn("pass", F.col("unnamed") + F.when(F.col("first.id") == least, F.col("first.n")).otherwise(0))
    last = 1 << len(FILTERS) - 1
    own = own.select("part", "quality", "toxic", F.explode(F.array(
        F.struct(F.col("failed"), F.col("pass").alias("n")),
        F.struct((F.col("failed") + last).alias("failed"), (F.col("n") - F.col("pass")).alias("n")))).alias("c"))
    sets = own.groupBy("part", "c.failed").agg(
        F.sum("c.n").alias("n"), F.sum(F.when(F.col("quality"), F.col("c.n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("c.n")).otherwise(0)).alias("toxic"))
    return by_order(sets)


def by_order(sets: DataFrame) -> DataFrame:
    """``sets``: (part, failed, n, good, toxic), at most one row per part and set of filters."""
    n = len(FILTERS)
    before, after = ways(n)
    edges = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("f"), F.lit(1 << f).alias("bit"),
                               F.lit(before[s] * after[s | 1 << f]).alias("ways"))
                      for s in range(1 << n) for f in range(n) if not s >> f & 1])
    e = sets.select("*", F.explode(edges).alias("e")).select("*", "e.*")
    fails = e.bit.bitwiseAND(e.failed) != 0
    passed = e.state.bitwiseAND(e.failed) == 0  # by every filter applied so far

    def total(rows, what="n"):
        return F.coalesce(F.sum(F.when(rows, F.col(what))), F.lit(0)).cast("long")

    e = e.groupBy("part", "state", "f", "ways").agg(
        total(passed & ~fails).alias("kept"), total(passed & fails).alias("removed"), total(~passed & fails).alias("redundant"),
        total(e.failed == e.bit).alias("unique_fails"), total(passed & fails, "good").alias("good_lost"),
        total(passed & fails, "toxic").alias("toxic_lost"))
    e = e.withColumn("shapley", F.sum(F.col("ways") * F.col("removed")).over(Window.partitionBy("part", "f")))
    # the edges on every order's way: a constant table of n! * n rows
    steps = [("".join(FILTERS[f] for f in order), k + 1, sum(1 << f for f in order[:k]), order[k])
             for order in permutations(range(n)) for k in range(n)]
    steps = sets.sparkSession.createDataFrame(steps, "filter_order string, step int, state int, f int")
    return e.join(F.broadcast(steps), ["state", "f"]).select(*COLUMNS)


COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

#: Every order applied step by step to the counts of equal cases.
ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY text) AS low FROM d),
b AS (SELECT doc_id, part,
      CASE WHEN len(ws) < {MIN_WORDS} THEN 'A' ELSE '' END ||
      CASE WHEN 100 * len(list_distinct(ws)) < {DISTINCT_PERCENT} * len(ws) THEN 'B' ELSE '' END ||
      CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {CAPITAL_PERCENT} * length(text) THEN 'C' ELSE '' END ||
      CASE WHEN regexp_matches(text, '{SYMBOLS}') THEN 'D' ELSE '' END ||
      CASE WHEN doc_id > low THEN 'E' ELSE '' END AS fails FROM w),
l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS toxic
      FROM b LEFT JOIN l USING (doc_id) GROUP BY part, fails),
f AS (SELECT unnest(string_split('{"".join(FILTERS)}', '')) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = {len(FILTERS)}),
s AS (SELECT filter_order, unnest(range(1, {len(FILTERS) + 1})) AS step FROM o),
t AS (SELECT filter_order, step::INTEGER AS step, filter_order[step] AS x, filter_order[1:step - 1] AS done FROM s),
u AS (SELECT part, filter_order, step, x,
      CASE WHEN done = '' THEN false ELSE length(translate(fails, done, '')) < length(fails) END AS gone,
      contains(fails, x) AS hit, fails, n, good, toxic FROM c, t),
r AS (SELECT part, filter_order, step, x,
      sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END)::BIGINT AS kept,
      sum(CASE WHEN NOT gone AND hit THEN n ELSE 0 END)::BIGINT AS removed,
      sum(CASE WHEN gone AND hit THEN n ELSE 0 END)::BIGINT AS redundant,
      sum(CASE WHEN fails = x THEN n ELSE 0 END)::BIGINT AS unique_fails,
      sum(CASE WHEN NOT gone AND hit THEN good ELSE 0 END)::BIGINT AS good_lost,
      sum(CASE WHEN NOT gone AND hit THEN toxic ELSE 0 END)::BIGINT AS toxic_lost FROM u GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM r"""


@query("op13_filter_audit", ORACLE)
def op13(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
