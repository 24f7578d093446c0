"""Spelling variant grouping: words one edit apart, by dense prefix-suffix tiling.

The words of a tile stand in a padded matrix of code points. Every pair of a tile's rows
is compared at once: the length of the common prefix plus that of the common suffix
reaches the longer length less one exactly for a single insertion, deletion or replacement.

Two near words agree before and behind their first difference. So a word is dealt once for
every half of the longer word's places (as the longer and as the shorter one of the
pair), keyed by what lies outside that half, and a pair is counted in the half that
holds its first difference, hence once. A key with too many words is cut in half
again, for its words only. At a single place a key holds one word per letter at most, so
this ends, and no key, however common, makes a large tile. Words of other keys that fill up
a tile cannot be near ones.

Counting: words are counted per task first. Tiles give one row per word, the number of its
near words there and the best of them, never the pairs. Roots are found by pointer
doubling; a form has at least twice its word's count, so few rounds do.

Edge cases: a null text has no words; a null id leaves its words as they are (nothing
is deleted); repeated rows count as often as they are there; a run of any length is one
word; a form's ties go to the smallest word in code-point order; an empty table gives no rows.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoodcast.llm.components import staged
from hoodcast.llm.registry import query, table
from hoodcast.session import ensure_checkpoint_dir

#: Letters: A-Z, a-z and U+00C0 to U+00FF, in Latin-1; A-Z in lower case, all else is a border.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
DAMAGE_EVERY = 97
MIN_LENGTH, MIN_COUNT = 5, 3
#: Distinct words a task holds before it hands them on.
HELD = 1 << 18
#: Words and code points under one key beyond which it is cut in half.
KEY_WORDS, KEY_CHARS = 1024, 1 << 22
#: Words of small keys that share a tile; code points that one bucket of tiles is to hold.
TILE, BUCKET_CHARS = 96, 1 << 18


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage_every: int | None = DAMAGE_EVERY,
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the letter runs of all texts, lower-cased, with their counts. Where ``damage_every``
    divides crc32(``<id>:<run>``) the run loses the code point at crc32 % length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()),
                                               pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return rows

        crc = zlib.crc32
        for b in batches:
            ids, texts = b.column("id"), b.column("text")
            for i in range(b.num_rows):
                text, key = texts[i].as_py(), ids[i].as_py()
                if not text:
                    continue
                # what Latin-1 lacks becomes "?", a border like any other
                text = text.decode("utf-8", "replace").encode("latin-1", "replace").translate(LETTERS)
                own = Counter(text.split())
                if key is None or not damage_every:
                    held.update(own)
                else:
                    start = crc(f"{key}:".encode())
                    for w, n in own.items():
                        h = crc(w if w.isascii() else w.decode("latin-1").encode(), start)
                        if not h % damage_every:
                            k = h % len(w)
                            w = w[:k] + w[k + 1:]
                        held[w] += n
                if len(held) >= HELD:
                    yield out()
        yield out()

    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where((F.char_length("word") >= min_length) & (F.col("n") >= min_count))


def near(words: DataFrame, path: str, key_words: int = KEY_WORDS, key_chars: int = KEY_CHARS) -> DataFrame:
    """(word, n_near, best): for every word with words one edit away their number and the one
    of largest n, as (-n, word). ``words``: (word, n), distinct words."""
    # each word's places are cut in two, for itself as the longer word and for a longer one
    size = F.char_length("word")
    dealt = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("longer"))
    half = F.floor(F.col("longer") / 2).cast("int")
    dealt = _keyed(dealt, [(F.lit(0), half), (half, F.col("longer"))])
    parts, level = [], 0
    while True:
        level += 1
        dealt = staged(dealt, os.path.join(path, f"dealt{level}"))
        keys = dealt.groupBy("longer", "lo", "hi", "key").agg(F.count("*").alias("rows"))
        keys = keys.where((F.col("hi") - F.col("lo") > 1) & ((F.col("rows") > key_words) | (F.col("rows") * F.col("longer") > key_chars)))
        keys = staged(keys.drop("rows"), os.path.join(path, f"keys{level}"))
        on = ["longer", "lo", "hi", "key"]
        if keys.isEmpty():
            parts.append(dealt)
            break
        parts.append(dealt.join(keys, on, "left_anti"))
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        dealt = _keyed(dealt.join(keys, on, "left_semi"), [(F.col("lo"), mid), (mid, F.col("hi"))])
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    total = words.agg(F.sum(4 * size)).first()[0] or 0
    buckets = max(total // BUCKET_CHARS, 2 * int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bucket = F.pmod(F.xxhash64("longer", "lo", "hi", "key"), F.lit(buckets))
    rows = rows.select(F.encode("word", "ISO-8859-1").alias("word"), "n", "longer", "lo", "hi", "key", bucket.alias("bucket"))
    found = rows.groupBy("bucket").applyInArrow(_tiles, "word binary, n_near long, best_n long, best binary")
    return found.groupBy(F.decode("word", "ISO-8859-1").alias("word")).agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("best_n")).alias("minus"), F.decode("best", "ISO-8859-1").alias("word"))).alias("best"))


def _keyed(rows: DataFrame, ranges: list) -> DataFrame:
    """One row per word and range of places [lo, hi): the key is what lies before and behind it."""
    rows = rows.select("word", "n", "longer", F.explode(F.array(
        *[F.struct(lo.alias("lo"), hi.alias("hi")) for lo, hi in ranges])).alias("r"))
    before = F.expr("substring(word, 1, r.lo)")
    behind = F.expr("right(word, longer - r.hi)")
    return rows.select("word", "n", "longer", "r.lo", "r.hi", F.xxhash64(before, F.lit("\0"), behind).alias("key"))


def _tiles(group: pa.Table) -> pa.Table:
    """One bucket: its keys' tiles, a row per word that has near words in them."""
    group = group.combine_chunks()
    shape = np.stack([group.column(c).to_numpy().astype(np.int64) for c in ("longer", "lo", "hi", "key")])
    order = np.lexsort(shape[::-1])
    shape = shape[:, order]
    words = group.column("word").take(pa.array(order)).combine_chunks()
    n = group.column("n").to_numpy()[order]
    _, off, data = words.buffers()
    off = np.frombuffer(off, np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    ranges = np.flatnonzero(np.any(np.diff(shape[:3], axis=1, prepend=-1), axis=0))
    keys = np.flatnonzero(np.any(np.diff(shape, axis=1, prepend=-1), axis=0) | (np.arange(len(n)) == 0))
    found = []
    for a, z in zip(ranges, np.append(ranges[1:], len(n))):
        longer, lo, hi = (int(x) for x in shape[:3, a])
        own = np.append(keys[(keys >= a) & (keys < z)], z)
        for lo_row, hi_row in _cut(own):
            found += [(i + lo_row, j + lo_row) for i, j in compare(data, off[lo_row:hi_row + 1], longer, lo, hi)]
    i = np.concatenate([np.zeros(0, np.int64), *[f[0] for f in found]])
    j = np.concatenate([np.zeros(0, np.int64), *[f[1] for f in found]])
    i, j = np.concatenate([i, j]), np.concatenate([j, i])
    rank = np.empty(len(n), np.int64)
    rank[pc.sort_indices(words).to_numpy()] = np.arange(len(n))
    best = np.lexsort((rank[j], -n[j], i))
    first = np.flatnonzero(np.diff(i[best], prepend=-1))
    chosen = best[first]
    return pa.table({"word": words.take(pa.array(i[chosen])), "n_near": np.diff(np.append(first, len(best))),
                     "best_n": n[j[chosen]], "best": words.take(pa.array(j[chosen]))})


def _cut(borders: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows of whole keys that make up a tile: one key, or several small ones."""
    a = 0
    while a < len(borders) - 1:
        z = max(a + 1, int(np.searchsorted(borders, borders[a] + TILE, "right")) - 1)
        if borders[z] - borders[a] > 1:
            yield int(borders[a]), int(borders[z])
        a = z


def compare(data: np.ndarray, off: np.ndarray, longer: int, lo: int, hi: int, block: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a tile's words (i < j) that are one edit apart, their first difference in [lo, hi) of the
    longer word, which has ``longer`` code points; pairs of two shorter words are another tile's."""
    size = np.diff(off)
    width = max(longer, 1)
    at = np.arange(width)
    inside = at < size[:, None]
    left = np.where(inside, data[np.minimum(off[:-1, None] + at, max(len(data) - 1, 0))], 0)
    back = np.where(inside, data[np.maximum(off[1:, None] - 1 - at, 0)], 0)
    for a in range(0, len(size), block):
        for b in range(a, len(size), block):
            n, m = min(block, len(size) - a), min(block, len(size) - b)
            prefix = np.zeros((n, m), np.int32)
            alive = np.ones((n, m), bool)
            for k in range(hi):
                alive &= left[a:a + n, k, None] == left[None, b:b + m, k]
                prefix += alive
            suffix = np.zeros((n, m), np.int32)
            alive = np.ones((n, m), bool)
            for k in range(longer - lo):
                alive &= back[a:a + n, k, None] == back[None, b:b + m, k]
                suffix += alive
            ok = (prefix >= lo) & (prefix < hi) & (prefix + suffix >= longer - 1)
            ok &= (size[a:a + n, None] == longer) | (size[None, b:b + m] == longer)
            if a == b:
                ok &= np.arange(n)[:, None] < np.arange(m)
            i, j = np.nonzero(ok)
            if len(i):
                yield i + a, j + b


def roots(forms: DataFrame, path: str) -> DataFrame:
    """(word, root): where following ``forms`` (word, form) ends, by pointer doubling."""
    forms = staged(forms.select("word", F.col("form").alias("root")), os.path.join(path, "root0"))
    step = 0
    while True:
        step += 1
        further = forms.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = forms.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        after = staged(after, os.path.join(path, f"root{step}"))
        if after.where("moved").isEmpty():
            return after.drop("moved")
        forms = after.drop("moved")


def group(words: DataFrame, path: str) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``words`` (word, n)."""
    words = staged(words, os.path.join(path, "words"))
    rows = words.join(near(words, path), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.minus") >= 2 * F.col("n"), F.struct(F.col("best.word").alias("form"), (-F.col("best.minus")).alias("n"))).alias("f"))
    rows = staged(rows.select("word", "n", "n_near", F.col("f.form").alias("form"), F.col("f.n").alias("form_n")),
                  os.path.join(path, "forms"))
    to = roots(rows.where("form IS NOT NULL"), path)
    return rows.join(to, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: CRC-32 byte by byte; near words by what is left when a place is deleted, roots by following forms.
ORACLE = f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[a-zÀ-ÿ]+')) AS run FROM documents),
own AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
bytes AS (SELECT run, n, flatten(list_transform(string_split(doc_id || ':' || run, ''),
          lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END)) AS b FROM own),
hashed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
           lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM bytes, crc),
damaged AS (SELECT CASE WHEN h % {DAMAGE_EVERY} = 0
            THEN run[:(h % length(run))::INT] || run[(h % length(run))::INT + 2:] ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
cut AS (SELECT word, n, i, word[:i] || word[i + 2:] AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b USING (rest, i) WHERE a.word <> b.word
          UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
          UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, encode(other)) AS other,
         max(n) AS other_n FROM pairs GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form,
          CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n FROM words w LEFT JOIN best USING (word)),
ways AS (SELECT word, word AS here FROM forms
         UNION ALL SELECT ways.word, forms.form FROM ways JOIN forms ON ways.here = forms.word WHERE forms.form IS NOT NULL),
ends AS (SELECT ways.word, here AS root FROM ways JOIN forms ON ways.here = forms.word WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)"""


@query("op12_spelling_variants", ORACLE)
def op12(spark, sf_dir):
    path = os.path.join(ensure_checkpoint_dir(spark), "spelling", uuid.uuid4().hex)
    return group(count_words(table(spark, sf_dir, "documents")), path)
