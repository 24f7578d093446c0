"""N-gram Jaccard join by set relations: all links between documents whose word
n-gram sets have a Jaccard similarity of at least ``percent`` %, as components.

* Copies: documents with equal sets form a class; one row stands for it.
* Order: a sparse count-min sketch (``sketches``), whose size follows the data, tells each
  chunk of documents which n-grams may occur twice or more and how often; n-grams are ordered
  from rare to frequent by that. It only orders; any order gives the same links.
* Index: the first ``|x| - ceil(t |x|) + l`` n-grams of each set, with position and set size; l is
  a fifth of the set, 8 at least (small sets: what they must have in common). Those that occur
  once need no entry. Two sets that link share l of these, the smaller one's, so a set of which
  fewer occur elsewhere has no entry at all, and one found in fewer lists is done.
* Answers by relation: a set is compared with the one leader it shares most index lists
  with. The distance is kept: as 1 - Jaccard is a metric, a set's answers are among those
  of its leader's answers whose distances differ from its own by 1 - t at most.
* Block skip: the entries of a list that have one leader and one class of sizes form a
  block, known by its ranges of size, position and component. Two blocks whose ranges
  rule out a link, or that lie in one component, are skipped whole. What remains are pairs
  of groups (leader, size class) that meet in enough lists, each looked at once;
  within them the leader distances and then parity bitmaps, an upper bound of the
  intersection, rule out pairs before any set is read. Groups longer than ``block``
  are dealt to several tasks by pairs of parts.
* What is left is compared exactly, and the components are joined. First only the
  likeliest pairs of each set, then, between the components that are still apart, all.

Two links between the same components add nothing, so pairs within one are skipped;
no link between components is lost. Nothing is capped.

Edge cases: null, empty or wordless texts have an empty set, linked with nothing; with
fewer than ``n`` words the whole sequence is the one n-gram; repeated rows are copies;
a null id takes its copies' component; an empty table gives an empty result; other
columns are ignored. Ids are integers.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoodcast.llm import bitfilter
from hoodcast.llm.components import connected_components, staged
from hoodcast.llm.registry import query, table
from hoodcast.llm.sketches import LAST, Told, merged, open_chunk, widths, write_chunks
from hoodcast.llm.text import Slice, lower_ascii, slices, window_hashes, window_starts, word_hashes, words
from hoodcast.session import ensure_checkpoint_dir

#: log2 of the bits of the id filter, which only saves reading: its size is fixed.
FILTER_BITS = 26
#: Sets of one group compared by one task at most, and bytes of their bitmaps; least number of index
#: entries that two linked sets share.
BLOCK, BLOCK_BYTES, SHARED = 8192, 16 << 20, 8
#: Rows of light tables (an id and a few numbers) that one task is to read.
LIGHT_ROWS = 10_000
#: Rounds in which a set names its LIKELIEST pairs only, before the round that takes all that are left.
ROUNDS, LIKELIEST = 1, 2


def shingles(s: Slice, n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word n-grams, A-Z lowered."""
    data = lower_ascii(s.data)
    w = words(data, s.offsets)
    h = word_hashes(data, w)
    at = window_starts(w.first, n)
    g, count = window_hashes(h, n)[at], np.maximum(w.counts - n + 1, 0)
    out = [np.unique(x) for x in np.split(g, np.cumsum(count)[:-1])] if len(count) else []
    for i in np.flatnonzero((w.counts > 0) & (w.counts < n)):
        out[i] = window_hashes(h[w.first[i]:w.first[i + 1]], int(w.counts[i])) + w.counts[i:i + 1].astype(np.uint64)
    return out


def _digest(x: np.ndarray) -> bytes:
    return hashlib.blake2b(x.tobytes(), digest_size=16).digest()


def _describe(n: int):
    """A slice's items (n-grams of its sets), set sizes and digests."""
    def count(s: Slice) -> tuple[int, dict]:
        sets = shingles(s, n)
        sizes = [len(x) for x in sets]
        return sum(sizes), {"sizes": sizes, "digests": [_digest(x) if len(x) else None for x in sets]}
    return count


def _items(n: int):
    def items(s: Slice) -> np.ndarray:
        sets = shingles(s, n)
        return np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return items


def _least(size: int, percent: int) -> int:
    """Common items that a set of this size needs for a link."""
    return -(-percent * size // 100)


def _shared(size: int, percent: int) -> int:
    """Index entries that a set of this size shares with every linked set that is not smaller."""
    return min(_least(size, percent), max(SHARED, size // 5))


def _shared_sql(size: str, percent: int) -> str:
    return f"least(ceil({percent} * {size} / 100), greatest({SHARED}, floor({size} / 5)))"


def _prefix(n: int, percent: int, bits: int, block_bits: int):
    """A chunk's index entries (key, id, n, at): the n-grams of each set's prefix that may occur
    elsewhere. Of copies within the chunk the first is enough."""
    def run(chunk: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, ...]] = []
        if len(chunk) and len(told):
            row, known, seen = chunk.iloc[0], Told(told, bits, block_bits), set()
            for key, x in zip(row["ids"], shingles(open_chunk(row["lengths"], row["texts"]), n)):
                digest = _digest(x)
                if not len(x) or key == LAST or digest in seen:
                    continue
                seen.add(digest)
                least = _least(len(x), percent)
                rank = known.rank(x)
                order = np.lexsort((x, rank))[:len(x) - least + _shared(len(x), percent)]
                at = np.flatnonzero(rank[order])
                if len(at) >= _shared(least, percent):  # the smallest partner has ``least`` items
                    out.append((x[order[at]].view(np.int64), np.full(len(at), key), np.full(len(at), len(x)), at))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
        return pd.DataFrame(dict(zip(("key", "id", "n", "at"), columns)))
    return run


def _sets(n: int, members):
    """(rep, text, bits) of the documents that pass the filter: text compressed, parity bitmap of the set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for b in batches:
            mine = np.flatnonzero(bitfilter.passes(members.value, b.column("id").fill_null(-1).to_numpy()))
            if not len(mine):
                continue
            b = b.take(pa.array(mine))
            for s in slices(b.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(s.lo, s.hi - s.lo),
                     pa.array([squeeze.compress(s.text(i)) for i in range(s.hi - s.lo)], pa.binary()),
                     pa.array([bitmap(x) for x in shingles(s, n)], pa.binary())], ["rep", "text", "bits"])
    return run


def bitmap(x: np.ndarray) -> bytes:
    """Parity of the items by hash, eight bits an item or more (a power of two)."""
    m = max(64, 1 << (8 * len(x) - 1).bit_length()) if len(x) else 64
    parity = np.bincount((x & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def _compare(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                texts = [open_.decompress(x) for x in b.column("a_text").to_pylist() + b.column("b_text").to_pylist()]
                sets = [x for s in slices(pa.array(texts, pa.binary())) for x in shingles(s, n)]
                m = b.num_rows
                common = [len(np.intersect1d(sets[i], sets[m + i], assume_unique=True)) for i in range(m)]
                union = [len(sets[i]) + len(sets[m + i]) - common[i] for i in range(m)]
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(common, pa.int64()),
                                                  pa.array(union, pa.int64())], ["a", "b", "common", "union"])
    return run


def verify(pairs: DataFrame, sets: DataFrame, n: int) -> DataFrame:
    """(a, b, common, union) of each pair, exactly."""
    one = sets.select(F.col("rep").alias("a"), F.col("text").alias("a_text"))
    two = sets.select(F.col("rep").alias("b"), F.col("text").alias("b_text"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "a_text", "b_text") \
        .mapInArrow(_compare(n), "a long, b long, common long, union long")


_JOB = ["o_leader", "o_class", "kind", "p", "q"]


def _bundle(percent: int, likeliest: int | None):
    one = _block_pairs(percent, likeliest)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        g = rows.sort_values([*_JOB, "n", "rep"], kind="stable")
        jobs = g[_JOB].to_numpy()
        edges = np.flatnonzero((jobs[1:] != jobs[:-1]).any(1)) + 1
        columns = {c: g[c].to_numpy() for c in ("rep", "component", "n", "d", "leader", "side", "itself", "bits")}
        found = [one({c: v[lo:hi] for c, v in columns.items()})
                 for lo, hi in zip([0, *edges], [*edges, len(g)]) if hi - lo > 1]
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})
    return run


def _best(p: np.ndarray, q: np.ndarray, surplus: np.ndarray, k: int) -> np.ndarray:
    """For each set in ``p`` or ``q`` the places of its ``k`` pairs of the greatest surplus."""
    own, at = np.concatenate([p, q]), np.tile(np.arange(len(p)), 2)
    order = np.lexsort((-np.tile(surplus, 2), own))
    first = np.searchsorted(own[order], own[order])
    return np.unique(at[order[np.arange(len(order)) - first < k]])


def _block_pairs(percent: int, likeliest: int | None = None):
    """Pairs of sides 0 and 1, and of side 0 with ``itself``, that may link across components; the
    rows come sorted by size. ``likeliest``: only so many a set, by the bound on the intersection."""
    t = Fraction(percent, 100)

    def run(g: dict[str, np.ndarray]) -> np.ndarray:
        rep, comp, n, d, leader = (g[c] for c in ("rep", "component", "n", "d", "leader"))
        side, blobs, out = g["side"], g["bits"], []
        if (comp == comp[0]).all():
            return np.zeros((0, 2), np.int64)
        itself = bool(g["itself"][0])
        hi = np.searchsorted(n, n * 100 // percent, "right")
        length = np.array([len(x) for x in blobs])
        start = 0
        while start < len(n):  # stretches of equal bitmap length, rows a few at a time
            stop = start + int(np.argmax(length[start:] != length[start])) if (length[start:] != length[start]).any() \
                else len(n)
            words_ = length[start] // 8
            reach = int(hi[stop - 1])
            table_ = np.stack([fold(blobs[k], words_) for k in range(start, reach)])
            step = max(1, (1 << 22) // max(1, (reach - start) * words_))
            for lo in range(start, stop, step):
                up = min(lo + step, stop)
                i = np.arange(lo, up)[:, None]
                j = np.arange(lo + 1, int(hi[up - 1]))[None, :]
                if not j.size:
                    continue
                total = n[i] + n[j]
                need = -(-total * t.numerator // (t.numerator + t.denominator))
                ok = (j > i) & (j < hi[i]) & (comp[i] != comp[j])
                ok &= (side[i] != side[j]) | (itself & (side[i] + side[j] == 0))
                ok &= (leader[i] != leader[j]) | (np.abs(d[i] - d[j]) <= float(1 - t) + 1e-9)
                p, q = np.nonzero(ok)
                if not len(p):
                    continue
                p, q = p + lo, q + lo + 1
                differ = np.bitwise_count(table_[p - start] ^ table_[q - start]).sum(1, dtype=np.int64)
                surplus = (n[p] + n[q] - differ) // 2 - need[p - lo, q - lo - 1]
                may = surplus >= 0
                out.append(np.stack([p[may], q[may], surplus[may]], 1))
                if likeliest and sum(map(len, out)) > 1 << 20:  # a set's best so far are enough
                    every = np.concatenate(out)
                    out = [every[_best(*every.T, likeliest)]]
            start = stop
        if not out:
            return np.zeros((0, 2), np.int64)
        every = np.concatenate(out)
        if likeliest:
            every = every[_best(*every.T, likeliest)]
        a, b = rep[every[:, 0]], rep[every[:, 1]]
        return np.stack([np.minimum(a, b), np.maximum(a, b)], 1)
    return run


def fold(blob: bytes, size: int) -> np.ndarray:
    """A parity bitmap in ``size`` 64-bit words; a longer one's halves are added."""
    x = np.frombuffer(blob, np.uint64)
    while len(x) > size:
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x


def _met(lists: DataFrame, group: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups (x, y) that may hold a link across components: their blocks meet, not ruled out,
    in as many lists as two linked sets share."""
    blocks = lists.join(group, "rep").groupBy("key", "leader", "class").agg(
        *[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("n", "at", "component")])
    x = blocks.select("key", *[F.col(c).alias(f"x_{c}") for c in blocks.columns if c != "key"])
    y = blocks.select("key", *[F.col(c).alias(f"y_{c}") for c in blocks.columns if c != "key"])
    met = x.join(y, "key").where(f"""
        struct(x_leader, x_class) <= struct(y_leader, y_class)
        AND NOT (x_min_component = x_max_component AND y_min_component = y_max_component
                 AND x_min_component = y_min_component)
        AND {percent} * x_min_n <= 100 * y_max_n AND {percent} * y_min_n <= 100 * x_max_n
        AND least(x_max_at, y_max_at) + least(x_max_n - x_min_at, y_max_n - y_min_at)
            >= {percent} * (x_min_n + y_min_n) / (100.0 + {percent})""")
    least = F.expr(_shared_sql("min(least(x_min_n, y_min_n))", percent))
    met = met.groupBy("x_leader", "x_class", "y_leader", "y_class").agg(F.count("*").alias("lists"), least.alias("least"))
    return met.where("lists >= least").drop("lists", "least")


def _candidates(met: DataFrame, group: DataFrame, component: DataFrame, percent: int, block: int,
                likeliest: int | None) -> DataFrame:
    """Pairs (a, b) that the bitmaps leave. Of two groups that met the larger one owns the pair: its
    sets (side 0) go once to all sets of the smaller groups it met (side 1), in parts of bounded
    size, and to each other if the group met itself."""
    size = group.groupBy("leader", "class").agg(F.count("*").alias("count"), F.sum(F.octet_length("bits")).alias("bytes"))
    named = lambda k: size.select(*[F.col(c).alias(f"{k}_{c}") for c in size.columns])
    m = met.join(named("x"), ["x_leader", "x_class"]).join(named("y"), ["y_leader", "y_class"])
    first = F.expr("x_count >= y_count")
    pick = lambda yes, no, c: F.when(first, F.col(f"{yes}_{c}")).otherwise(F.col(f"{no}_{c}"))
    m = m.select(*[pick("x", "y", c).alias(f"o_{c}") for c in size.columns],
                 *[pick("y", "x", c).alias(f"m_{c}") for c in size.columns],
                 F.expr("x_leader = y_leader AND x_class = y_class").alias("alone"))
    parts = lambda n, b: F.greatest(F.ceil(n / block), F.ceil(b / BLOCK_BYTES), F.lit(1)).cast("int")
    other = F.expr("NOT alone")
    owners = m.groupBy("o_leader", "o_class").agg(
        parts(F.max("o_count"), F.max("o_bytes")).alias("own_parts"),
        parts(F.coalesce(F.sum(F.when(other, F.col("m_count"))), F.lit(0)),
              F.coalesce(F.sum(F.when(other, F.col("m_bytes"))), F.lit(0))).alias("other_parts"),
        F.max("alone").alias("alone"))
    zero = owners.select("*", F.col("o_leader").alias("leader"), F.col("o_class").alias("class"), F.lit(0).alias("side"))
    one = m.where(other).select("o_leader", "o_class", F.col("m_leader").alias("leader"), F.col("m_class").alias("class")) \
        .join(owners, ["o_leader", "o_class"]).withColumn("side", F.lit(1)).select(zero.columns)
    r = zero.union(one).join(group.join(component, "rep"), ["leader", "class"])
    r = r.withColumn("part", F.expr("pmod(xxhash64(rep), IF(side = 0, own_parts, other_parts))").cast("int"))
    # (kind, p, q): kind 0 own part p against others' part q (and itself, once), kind 1 own parts p < q
    r = r.withColumn("t", F.explode(F.expr("""CASE
        WHEN side = 1 THEN transform(sequence(0, own_parts - 1), p -> struct(0 AS kind, p AS p, part AS q, 1 AS side))
        ELSE concat(transform(sequence(0, other_parts - 1), q -> struct(0 AS kind, part AS p, q AS q, 0 AS side)),
            transform(filter(sequence(0, own_parts - 1), o -> alone AND o <> part), o -> struct(
                1 AS kind, least(part, o) AS p, greatest(part, o) AS q, IF(part < o, 0, 1) AS side))) END""")))
    # many jobs are tiny: some go to one call together
    bundles = 16 * int(group.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = r.select("o_leader", "o_class", "t.kind", "t.p", "t.q", "t.side", F.expr("alone AND t.kind = 0 AND t.q = 0").alias("itself"),
                 "rep", "component", "n", "d", "leader", "bits")
    r = r.withColumn("bundle", F.pmod(F.xxhash64(*_JOB), F.lit(bundles)))
    return r.groupBy("bundle").applyInPandas(_bundle(percent, likeliest), "a long, b long").distinct()


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, percent: int = 85,
         block: int = BLOCK) -> DataFrame:
    """(id, n_shingles, component_id) of every document."""
    spark = docs.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "jaccard", uuid.uuid4().hex)
    at = lambda name: os.path.join(path, name)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))

    chunks = write_chunks(rows, at("chunks"), _describe(n), ", sizes array<long>, digests array<binary>", "id", "text")
    every = chunks.select(F.explode(F.arrays_zip("ids", "sizes", "digests")).alias("x")).select(
        F.when(F.col("x.ids") < LAST, F.col("x.ids")).alias("id"), F.col("x.sizes").alias("n"),
        F.col("x.digests").alias("digest"))
    few = 1 + (chunks.agg(F.sum(F.size("ids"))).first()[0] or 0) // LIGHT_ROWS
    classes = staged(every.where("digest is not null").groupBy("digest").agg(F.min("id").alias("rep")), at("classes"), few)

    # index lists with two sets or more; an entry's document becomes its class
    bits, block_bits = widths(chunks)
    told = merged(chunks, _items(n), bits, block_bits)
    entries = chunks.select("chunk", "ids", "lengths", "texts").groupBy("chunk").cogroup(told.groupBy("chunk")) \
        .applyInPandas(_prefix(n, percent, bits, block_bits), "key long, id long, n long, at long")
    near = staged(entries, at("entries"))
    ids = every.where("digest is not null and id is not null").select("id", "digest").distinct() \
        .join(near.select("id").distinct(), "id")
    rep_of = staged(ids.join(classes, "digest").select("id", "rep"), at("reps"), few)
    some = 1 + near.count() // LIGHT_ROWS
    lists = staged(near.join(rep_of, "id").groupBy("key", "rep").agg(F.max("n").alias("n"), F.min("at").alias("at")),
                   at("lists"), some)
    # a set that may link is in this many lists with others; the smallest partner's need counts
    need = F.expr(_shared_sql(f"ceil({percent} * max(n) / 100)", percent))
    for k in range(2):
        full = staged(lists.groupBy("key").count().where("count > 1").select("key"), at(f"full{k}"), some)
        lists = lists.join(full, "key")
        busy = staged(lists.groupBy("rep").agg(F.count("*").alias("found"), need.alias("need"))
                      .where("found >= need").drop("need"), at(f"busy{k}"), some)
        lists = staged(lists.drop("found").join(busy, "rep"), at(f"lists{k}"), some)

    # every set against the one leader with which it shares most lists
    heads = staged(lists.groupBy("key").agg(F.max_by("rep", F.struct("found", -F.col("rep"))).alias("leader")), at("heads"), some)
    led = lists.join(heads, "key").groupBy("rep", "leader").agg(F.count("*").alias("count"), F.max("n").alias("n"))
    led = led.groupBy("rep").agg(
        F.coalesce(F.max_by("leader", F.when(F.col("rep") != F.col("leader"), F.struct("count", -F.col("leader")))),
                   F.first("rep")).alias("leader"), F.max("n").alias("n"))
    led = staged(led, at("led"), some)
    pairs = led.where("rep <> leader").select(F.col("rep").alias("a"), F.col("leader").alias("b"))
    members = spark.sparkContext.broadcast(bitfilter.build(led, "rep", FILTER_BITS))
    sets = staged(rows.mapInArrow(_sets(n, members), "rep long, text binary, bits binary").where("rep is not null")
                  .join(led.select("rep"), "rep").dropDuplicates(["rep"]), at("sets"))
    first = staged(verify(pairs, sets, n), at("verified1"))
    linked = F.expr(f"100 * common >= {percent} * union")
    # sets by group: leader, distance to it, size class
    known = first.select(F.col("a").alias("rep"), (1 - F.col("common") / F.col("union")).alias("d"))
    group = led.join(known, "rep", "left").join(sets.select("rep", "bits"), "rep").select(
        "rep", "n", "leader", F.coalesce("d", F.lit(0.0)).alias("d"),
        F.floor(F.log("n") / -np.log(percent / 100)).cast("int").alias("class"), "bits")
    group = staged(group, at("groups"), few)
    links = first.where(linked).select("a", "b")
    for k in range(ROUNDS + 1):
        label = connected_components(links, at(f"components{k}")).withColumnRenamed("node", "rep")
        component = staged(led.select("rep").join(label, "rep", "left")
                           .select("rep", F.coalesce("component", "rep").alias("component")), at(f"component{k}"), few)
        met = staged(_met(lists.select("key", "rep", "at"), group.drop("bits").join(component, "rep"), percent), at(f"met{k}"))
        pairs = _candidates(met, group, component, percent, block, LIKELIEST if k < ROUNDS else None)
        more = staged(verify(staged(pairs, at(f"pairs{k}")), sets, n), at(f"verified{k + 2}"))
        # a component found is a star from now on
        links = label.select(F.col("rep").alias("a"), F.col("component").alias("b")).union(more.where(linked).select("a", "b"))
    labels = connected_components(links, at("components"))
    named = staged(classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
                   .select("digest", F.coalesce("component", "rep").alias("component_id")), at("named"), few)
    out = every.join(named, "digest", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.coalesce("component_id", "id").alias("component_id"))


@query("op4_jaccard_join")
def op4(spark, sf_dir):
    return link(table(spark, sf_dir, "documents"))
