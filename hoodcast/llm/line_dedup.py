"""Line dedup by a fixed-depth template tree.

A line's tokens lose their digits' words (``<*>``). The tree has two levels: the
number of tokens, then the leading tokens; a leaf holds the lines that agree on both.
Within a leaf a line goes by its backbone: the ``min_constant`` of its tokens that most
others share. Among the lines of one backbone a token is constant if at least half of
them have it at its place (a share, so that the verdict is the same at every size), any
other is a variable field; the line's template is what remains. Templates that recur
across documents are dropped from all of them.

Copies of a document are not recurrences: a template recurs when ``min_documents``
families or more have it, however many documents a family has. A family is a connected
component of near copies: the texts' word n-grams are cut into BINS parts by their hash,
the smallest of each part is kept, and texts that agree in all ``BINS / BANDS`` parts of a
band are linked. Texts that share one line only agree in a band when all its minima lie
in that line; those count as one family, the others stay apart.

Everything is grouped minima and counts over hashes; texts are read three times and
move once, to meet the lines they lose. A leaf, a template or a family is never gathered.

Edge cases: null texts stay null, empty ones empty; lines of fewer than ``min_tokens``
tokens stay; a line that repeats within one document counts once; the judgement depends
on texts only, so repeated rows and missing or repeated ids make no difference; an
empty table gives an empty result; other columns are carried along untouched.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hoodcast.llm import bitfilter
from hoodcast.llm.components import connected_components, staged
from hoodcast.llm.registry import query, table
from hoodcast.llm.text import combine, slices, window_hashes, window_starts, word_hashes, words
from hoodcast.session import ensure_checkpoint_dir

DEPTH, MIN_TOKENS, MIN_DOCUMENTS, MIN_CONSTANT = 3, 3, 8, 0.6
FILTER_BITS = 26
#: Words of an n-gram; parts of a text's n-grams (a power of two); bands of them, one of which near copies share.
GRAM, BINS, BANDS = 3, 64, 16
#: Rows of light tables that one task is to read.
LIGHT_ROWS = 20_000
#: Places of a line that are looked up together.
CHUNK = 16

_DIGIT = re.compile(rb"[0-9]")
_FIELD = re.compile(rb"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*")


def _hash(x: bytes) -> int:
    return int.from_bytes(blake2b(x, digest_size=8).digest(), "little", signed=True)


def canonical(text: bytes) -> list[list[bytes]]:
    """Tokens of every \\n-split line, words with a digit as ``<*>``."""
    return [(_FIELD.sub(b"<*>", line) if _DIGIT.search(line) else line).split() for line in text.split(b"\n")]


def line_key(tokens: list[bytes]) -> int:
    return _hash(b" ".join(tokens))


def leaf_key(tokens: list[bytes], depth: int) -> int:
    return _hash(b"%d %s" % (len(tokens), b" ".join(tokens[:depth])))


def _bands(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text and band the hash of its smallest n-grams (texts without n-grams: all alike)."""
    n = len(offsets) - 1
    w = words(data, offsets)
    h, at = window_hashes(word_hashes(data, w), GRAM), window_starts(w.first, GRAM)
    none = np.uint64(np.iinfo(np.uint64).max)
    low = np.full(n * BINS, none)
    if len(at):
        h = h[at]
        doc = np.searchsorted(w.first, at, "right") - 1
        np.minimum.at(low, doc * BINS + (h >> np.uint64(65 - BINS.bit_length())).astype(np.int64), h)
    low = low.reshape(n, BINS)
    # a part without n-grams takes the next one's
    step = 1
    while step < BINS:
        low = np.where(low == none, np.roll(low, -step, axis=1), low)
        step *= 2
    low = low.reshape(n, BANDS, BINS // BANDS)
    out = np.tile(np.arange(BANDS, dtype=np.uint64), (n, 1))
    for k in range(BINS // BANDS):
        out = combine(out, low[:, :, k])
    return out.view(np.int64)


def _occurrences(depth: int, min_tokens: int):
    """A row per line, and one with the bands per text that has lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests = b.column("digest").to_numpy()
            for s in slices(b.column("text")):
                bands = _bands(s.data, s.offsets)
                rows: list[tuple] = []
                for i in range(s.hi - s.lo):
                    found = {line_key(t): t for t in canonical(s.text(i)) if len(t) >= min_tokens}
                    rows += [(digests[s.lo + i], k, leaf_key(t, depth), None) for k, t in found.items()]
                    if found:
                        rows.append((digests[s.lo + i], None, None, bands[i]))
                if rows:
                    digest, line, leaf, own = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(digest, pa.int64()), pa.array(line, pa.int64()), pa.array(leaf, pa.int64()),
                         pa.array(own, pa.list_(pa.int64()))], ["digest", "line", "leaf", "bands"])
    return run


def _families(bands: DataFrame, path: str, tasks: int) -> DataFrame:
    """(digest, family) of the texts that share a band with another text."""
    bands = bands.select("digest", F.explode("bands").alias("band"))
    first = bands.groupBy("band").agg(F.min("digest").alias("first"), F.max("digest").alias("last"))
    first = staged(first.where("first <> last").select("band", "first"), path + "-bands", tasks)
    links = bands.join(first, "band").select(F.col("digest").alias("a"), F.col("first").alias("b"))
    return connected_components(links, path).select(F.col("node").alias("digest"), F.col("component").alias("family"))


def _tokens(depth: int, min_tokens: int, leaves):
    """(leaf, line, size, chunk, fields) of the lines whose leaf passes the filter, once a task.
    Tokens after the leading ones, hashed with their place, go in chunks of CHUNK places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            for s in slices(b.column("text")):
                lines = [t for i in range(s.hi - s.lo) for t in canonical(s.text(i)) if len(t) >= min_tokens]
                leaf = np.array([leaf_key(t, depth) for t in lines], np.int64)
                rows = []
                for k in np.flatnonzero(bitfilter.passes(leaves.value, leaf)):
                    key, t = line_key(lines[k]), lines[k]
                    if key not in seen:
                        seen.add(key)
                        rows += [(int(leaf[k]), key, len(t), c, [
                            _hash(b"%d %s" % (i, t[i])) for i in range(max(c * CHUNK, depth), min((c + 1) * CHUNK, len(t)))])
                            for c in range(-(-len(t) // CHUNK))]
                if rows:
                    columns = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.list_(pa.int64()))],
                        ["leaf", "line", "size", "chunk", "fields"])
    return run


def _support(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Families per field (one line's added to another's), added up within the task."""
    def rows(found: dict) -> pa.RecordBatch:
        keys = list(zip(*found)) if found else [(), (), ()]
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in keys],
                                           pa.array(list(found.values()), pa.int64())], ["leaf", "chunk", "field", "n"])
    found: dict[tuple[int, int, int], int] = {}
    for b in batches:
        for leaf, chunk, n, fields in zip(*(b.column(c).to_pylist() for c in ("leaf", "chunk", "families", "fields"))):
            for f in fields:
                found[leaf, chunk, f] = found.get((leaf, chunk, f), 0) + n
        if len(found) > 1 << 19:
            yield rows(found)
            found.clear()
    yield rows(found)


def recurring_lines(texts: DataFrame, path: str, depth: int = DEPTH, min_tokens: int = MIN_TOKENS,
                    min_documents: int = MIN_DOCUMENTS, min_constant: float = MIN_CONSTANT) -> tuple[DataFrame, DataFrame]:
    """(occurrences: digest, line, leaf; recurring: line, template, families) of a
    frame with a binary column ``text`` and a long ``digest`` of it."""
    at = lambda name: os.path.join(path, name)
    texts = texts.where("text is not null")
    rows = staged(texts.mapInArrow(_occurrences(depth, min_tokens),
                                   "digest long, line long, leaf long, bands array<long>"), at("occurrences"))
    few = 1 + rows.count() // LIGHT_ROWS
    seen = rows.where("line is not null").select("digest", "line", "leaf")
    family = _families(rows.where("line is null").dropDuplicates(["digest"]), at("components"), few)
    # sort-merge at every size: a broadcast would fit small inputs only
    by_family = seen.join(family.hint("merge"), "digest", "left") \
        .select("line", "leaf", F.coalesce("family", "digest").alias("family")).distinct()
    by_family = staged(by_family, at("families"), few)
    leaves = staged(by_family.select("leaf", "family").distinct().groupBy("leaf").count()
                    .where(F.col("count") >= min_documents).select("leaf"), at("leaves"), few)
    keep = texts.sparkSession.sparkContext.broadcast(bitfilter.build(leaves, "leaf", FILTER_BITS))
    lines = texts.select("text").mapInArrow(_tokens(depth, min_tokens, keep),
                             "leaf long, line long, size long, chunk long, fields array<long>") \
        .dropDuplicates(["line", "chunk"]).join(leaves, "leaf")
    weight = by_family.groupBy("line").agg(F.count("*").alias("families"))
    lines = staged(lines.join(weight, "line"), at("lines"))
    support = lines.select("leaf", "chunk", "families", "fields") \
        .mapInArrow(_support, "leaf long, chunk long, field long, n long") \
        .groupBy("leaf", "chunk", "field").agg(F.sum("n").alias("n")).where(F.col("n") >= min_documents)
    support = staged(support, at("support"), few)
    known = support.groupBy("leaf", "chunk").agg(F.collect_list("field").alias("known"))
    shared = lines.join(known, ["leaf", "chunk"], "left").select(
        "line", "leaf", "size", "families",
        F.coalesce(F.array_intersect("fields", "known"), F.array().cast("array<long>")).alias("shared"))
    shared = staged(shared, at("shared"), few)
    # tokens that the backbone takes beside the leading ones; a line with fewer shared ones cannot recur
    need = F.ceil(min_constant * F.col("size")) - F.least("size", F.lit(depth))
    able = shared.groupBy("line", "leaf", "families", need.alias("need")).agg(F.sum(F.size("shared")).alias("n"))
    able = staged(able.where("n >= need").drop("n"), at("able"), few)
    fields = shared.select("line", "leaf", F.explode("shared").alias("field")) \
        .join(able.select("line", "need"), "line").join(support.select("leaf", "field", "n"), ["leaf", "field"])
    by_support = Window.partitionBy("line").orderBy(F.desc("n"), "field")
    fields = staged(fields.select("line", "field", (F.row_number().over(by_support) <= F.col("need")).alias("backbone")),
                    at("fields"), few)
    # order-free hashes of fields, which carry their places
    together = F.bit_xor(F.xxhash64("field"))
    backbone = fields.where("backbone").groupBy("line").agg(together.alias("backbone"))
    groups = able.join(backbone, "line", "left").select(
        "line", "families", F.xxhash64("leaf", F.coalesce("backbone", F.lit(0).cast("long"))).alias("group"))
    groups = staged(groups, at("groups"), few)
    total = groups.groupBy("group").agg(F.sum("families").alias("total")).where(F.col("total") >= min_documents)
    grouped = fields.join(groups, "line")
    constant = grouped.groupBy("group", "field").agg(F.sum("families").alias("n")).join(total, "group") \
        .where((F.col("n") >= min_documents) & (2 * F.col("n") >= F.col("total"))).select("group", "field")
    constant = staged(constant, at("constants"), few)
    fixed = grouped.join(constant, ["group", "field"]).groupBy("line").agg(together.alias("fixed"))
    template = groups.join(fixed, "line", "left").select(
        "line", F.xxhash64("group", F.coalesce("fixed", F.lit(0).cast("long"))).alias("template"))
    template = staged(template, at("templates"), few)
    counted = by_family.join(template, "line").select("template", "family").distinct() \
        .groupBy("template").agg(F.count("*").alias("families")).where(F.col("families") >= min_documents)
    counted = staged(counted, at("counted"), few)
    return seen, staged(template.join(counted, "template").select("line", "template", "families"), at("recurring"), few)


def _rewrite(min_tokens: int, text_col: str):
    """Rows with their text without the lines in ``drop``; others as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("row").field(text_col).cast(pa.string())
            n_lines = pc.add(pc.cast(pc.count_substring(texts, "\n"), pa.int64()), 1)
            n_lines = pc.if_else(pc.equal(pc.binary_length(texts), 0), 0, n_lines).fill_null(0).to_numpy().copy()
            kept, n_dropped, left = {}, np.zeros(b.num_rows, np.int64), np.ones(b.num_rows, bool)
            for i, drop in enumerate(b.column("drop").to_pylist()):
                if not drop:
                    continue
                text, gone = texts[i].as_py().encode(), set(drop)
                tokens = canonical(text)
                stay = [not (len(t) >= min_tokens and line_key(t) in gone) for t in tokens]
                kept[i] = b"\n".join([x for x, ok in zip(text.split(b"\n"), stay) if ok]).decode("utf-8", "replace")
                n_dropped[i] = len(stay) - sum(stay)
                left[i] = any(ok and t for t, ok in zip(tokens, stay))
            if kept:
                changed = np.zeros(b.num_rows, bool)
                changed[list(kept)] = True
                texts = pc.replace_with_mask(texts, pa.array(changed), pa.array(list(kept.values()), pa.string()))
            yield pa.RecordBatch.from_arrays([b.column("row"), texts, pa.array(n_lines), pa.array(n_dropped),
                                              pa.array(left)], ["row", "kept", "n_lines", "n_dropped", "left"])
    return run


def drop_recurring(docs: DataFrame, text_col: str = "text", min_tokens: int = MIN_TOKENS, **options) -> DataFrame:
    """Every row of ``docs`` as ``row``, with ``kept`` (the text without recurring lines),
    ``n_lines``, ``n_dropped`` and ``left`` (false when no line with a word is left of a
    text that lost some)."""
    path = os.path.join(ensure_checkpoint_dir(docs.sparkSession), "lines", uuid.uuid4().hex)
    text = F.col(text_col).cast("binary")
    # a digest that two texts share would only join their lists of recurring lines
    seen, recurring = recurring_lines(docs.select(text.alias("text"), F.xxhash64(text).alias("digest")), path,
                                      min_tokens=min_tokens, **options)
    lost = staged(seen.join(recurring.select("line").distinct(), "line").groupBy("digest")
                  .agg(F.collect_set("line").alias("drop")), os.path.join(path, "lost"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(text).alias("digest"))
    kind = rows.schema["row"].dataType.simpleString()
    # sort-merge at every size: a broadcast would fit small inputs only
    return rows.join(lost.hint("merge"), "digest", "left").select("row", "drop").mapInArrow(
        _rewrite(min_tokens, text_col), f"row {kind}, kept string, n_lines long, n_dropped long, left boolean")


@query("op7_line_dedup")
def op7(spark, sf_dir):
    out = drop_recurring(table(spark, sf_dir, "documents"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
                      F.sha2("kept", 256).alias("kept_sha256"))
