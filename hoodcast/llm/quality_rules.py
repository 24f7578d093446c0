"""Quality rules: one threshold table, compiled into one Spark projection.

Native throughout: the counts are DataFrame expressions (arrays built and
sorted inside the row, no exchange at all) and every rule is a comparison in a
single ``select``. No user functions.

Edge cases: a null or empty text counts 0 for everything and fails the base
rules; a null id stays null; repeated rows give repeated rows; an empty table
gives an empty result; input columns other than id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoodcast.llm.registry import query, table

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

#: Frequent function words of the corpus languages, lower case.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "on", "with", "as", "be", "by", "are", "this",
    "from", "at", "or", "an", "a", "not", "he", "you", "have", "they", "which", "what", "than", "then",
    "der", "die", "das", "und", "ist", "den", "von", "zu", "mit", "sich", "dem", "ein", "eine", "nicht", "auf", "als",
    "auch", "es", "im", "für", "werden", "einer",
    "le", "la", "les", "de", "des", "et", "en", "un", "une", "du", "que", "qui", "dans", "est", "pour", "par", "sur",
    "pas", "plus", "ne", "au",
    "el", "los", "las", "y", "con", "no", "una", "por", "se", "su", "para", "lo", "del", "al", "como",
)


@dataclass(frozen=True)
class Rule:
    """``lower <= metric <= upper``; a missing bound is open. ``base`` rules alone set ``base_failed``."""
    name: str
    metric: str
    lower: float | None = None
    upper: float | None = None
    base: bool = False


#: The threshold table. Metrics are SQL over the counted columns.
RULES = (
    Rule("length", "n_words", lower=50, base=True),
    Rule("repeated_words", "100 * n_repeat_words - 50 * n_words", upper=0, base=True),
    Rule("word_length_low", "word_chars - 2 * n_words", lower=0),
    Rule("word_length_high", "word_chars - 15 * n_words", upper=0),
    Rule("symbols", "100 * n_symbols - 20 * n_words", upper=0),
    Rule("exclamations", "100 * n_exclaims - 30 * n_words", upper=0),
    Rule("capitals", "100 * n_capitals - 50 * word_chars", upper=0),
    Rule("stop_words", "100 * n_stop_words - 5 * n_words", lower=0),
    Rule("duplicate_lines", "100 * n_dup_lines - 50 * n_lines", upper=0),
)


def _without(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 3) -> DataFrame:
    """Per row: id, text and the counts the rules compare.

    ``n_repeat_words`` sorts the row's (window hash, position) pairs, keeps those
    with an equal neighbour and adds up the stretch each one newly covers:
    n log n in the row's words, no exchange. A window's hash is the 64-bit
    xxHash of its words, compared within one text only.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    d = d.withColumns({
        "words": F.array_remove(F.split("text", SPACES), ""),
        "lines": F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    hashed = F.transform(
        F.when(F.size("words") >= window, F.sequence(F.lit(0), F.size("words") - window)).otherwise(
            F.array().cast("array<int>")),
        lambda i: F.struct(F.xxhash64(*[F.get("words", i + k) for k in range(window)]).alias("h"), i.alias("i")))
    d = d.withColumn("sorted", F.sort_array(hashed))
    twice = F.filter("sorted", lambda x, k: F.get("sorted", k - 1)["h"].eqNullSafe(x["h"])
                     | F.get("sorted", k + 1)["h"].eqNullSafe(x["h"]))
    d = d.withColumn("at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        "at", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(window), p - acc["last"])).alias("n"), p.alias("last")))["n"]
    stripped = F.translate("text", " \t\n\x0b\x0c\r", "")
    stop = F.filter(F.transform("words", lambda x: F.rtrim(F.lower(x), F.lit(".,;:"))),
                    lambda x: x.isin(*STOP_WORDS))
    # As one inlined struct: a filter on a count then stays above this step instead of being
    # pushed below it, which would copy the array expressions into each other.
    return d.select("id", "text", F.inline(F.array(F.struct(
        F.size("words").cast("long").alias("n_words"),
        F.char_length(stripped).cast("long").alias("word_chars"),
        _without(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        _without(F.col("text"), "!").cast("long").alias("n_exclaims"),
        F.char_length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).cast("long").alias("n_capitals"),
        F.size(stop).cast("long").alias("n_stop_words"),
    ))))


def _passes(rule: Rule) -> str:
    bounds = (("<=", rule.upper), (">=", rule.lower))
    return "(" + " AND ".join(f"{rule.metric} {op} {v:g}" for op, v in bounds if v is not None) + ")"


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One projection over ``counts``: the counts, ``base_failed``, ``kept`` and the
    names of the rules each row fails (``failed``)."""
    base = " AND ".join(_passes(r) for r in rules if r.base) or "true"
    every = " AND ".join(_passes(r) for r in rules) or "true"
    failed = ", ".join(f"CASE WHEN NOT {_passes(r)} THEN '{r.name}' END" for r in rules)
    return counts(docs, id_col, text_col).selectExpr(
        f"id AS `{id_col}`", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
        "n_exclaims", "n_capitals", "n_stop_words", f"NOT ({base}) AS base_failed", f"({every}) AS kept",
        f"array_compact(array({failed})) AS failed")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all its columns) that pass every rule."""
    names = docs.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in names])
    c = counts(docs.select(whole.alias("row"), F.col(text_col).alias("text")), "row", "text")
    return c.where(" AND ".join(_passes(r) for r in rules) or "true").select(
        *[F.col("id").getField(n).alias(n) for n in names])


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL of the query, written over exploded words and lines instead of in-row arrays."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    base = " AND ".join(_passes(r) for r in rules if r.base)
    every = " AND ".join(_passes(r) for r in rules)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
word AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
tri AS (SELECT doc_id, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS g FROM word
        WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
rep AS (SELECT doc_id, i FROM tri WHERE g IS NOT NULL
        QUALIFY count(*) OVER (PARTITION BY doc_id, g) >= 2),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
per_word AS (SELECT doc_id, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars,
             (count(*) FILTER (WHERE rtrim(lower(word), '.,;:') IN ({stop}))) AS n_stop_words
             FROM word GROUP BY doc_id),
line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d),
per_line AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines FROM line
             WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
      length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
      length(text) - length(replace(text, '!', '')) AS n_exclaims,
      length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS n_capitals,
      coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
      coalesce(cov.n, 0) AS n_repeat_words, coalesce(n_stop_words, 0) AS n_stop_words
      FROM d LEFT JOIN per_word USING (doc_id) LEFT JOIN per_line USING (doc_id) LEFT JOIN cov USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       NOT ({base}) AS base_failed, ({every}) AS kept
FROM m"""


@query("op8_quality_rules", oracle())
def op8(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents")).select(*COLUMNS)
