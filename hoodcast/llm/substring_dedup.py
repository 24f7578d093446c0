"""Substring dedup: remove words covered by a window that also starts earlier.

A window is ``n`` consecutive words of one document; "earlier" is a smaller id,
or an earlier start in the same document. Windows are judged on the input.

Count-min prefilter, then an exact pass, all by keys whose number grows with the
data and none of which gathers more than one entry per chunk of documents:

1. Documents are written as chunks (one row: some ids, their texts compressed).
2. Every chunk sketches its windows (``sketches``): a count for each cell of a count-min
   row ``2**bits`` wide, 256 cells a window over the whole corpus or more.
3. Sketches are merged block by block. Merged counts are never below a window's
   true count, so a cell counted once holds no repeated window; each chunk is told
   which of its cells were counted twice or more.
4. Chunks send an exact 96-bit digest of the windows in those cells, their earliest
   occurrence only; grouping the digests finds each window's first occurrence anywhere
   and tells the other chunks that theirs is not it.
5. Chunks drop the covered words: windows reported in 4, and all but the first of the
   equal windows within the chunk.

Edge cases: a null or empty text has no words; a null id comes after all others;
rows that share an id follow each other in the order they are read; a text of any
length is one chunk row at most; an empty table gives an empty result. Input
columns other than id and text are ignored. Ids are integers.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoodcast.llm.registry import query, table
from hoodcast.llm.sketches import (BLOCK_ENTRIES, CELL_BITS, LAST, Told, by_block, merged, open_chunk, pack, pack_sorted,
                                   unpack, unpack_sorted, widths, write_chunks)
from hoodcast.llm.text import Slice, Words, window_hashes, window_starts, word_hashes, words
from hoodcast.session import ensure_checkpoint_dir

WINDOW = 20


def _count(n: int):
    def count(s: Slice) -> tuple[int, dict]:
        return int(np.maximum(words(s.data, s.offsets).counts - n + 1, 0).sum()), {}
    return count


def _windows(data: np.ndarray, w: Words, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(word index at which each window starts, its 64-bit hash), in order of occurrence."""
    at = window_starts(w.first, n)
    return at, window_hashes(word_hashes(data, w, seed), n)[at]


def _items(n: int):
    def items(s: Slice) -> np.ndarray:
        return _windows(s.data, words(s.data, s.offsets), n, 0)[1]
    return items


def _exact(n: int, bits: int, block_bits: int):
    def run(chunk: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        names = ["block", "chunk", "head", "tail", "ids", "at"]
        if not len(chunk) or not len(told):
            return pd.DataFrame(columns=names)
        row = chunk.iloc[0]
        s = open_chunk(row["lengths"], row["texts"])
        data, w = s.data, words(s.data, s.offsets)
        at, h = _windows(data, w, n, 0)
        some = np.flatnonzero(Told(told, bits, block_bits).rank(h))
        tail = (_windows(data, w, n, 1)[1][some] >> np.uint64(32)).astype(np.uint32)
        order, first = _groups(h[some], tail)
        pick = order[first]
        head, tail, at = h[some][pick], tail[pick], at[some][pick]
        doc = np.searchsorted(w.first, at, "right") - 1
        ids = np.asarray(row["ids"], np.int64)[doc]
        out = [(block, row["chunk"], pack_sorted(head[s]), pack(tail[s]), pack(ids[s]), pack(at[s].astype(np.uint32)))
               for block, s in by_block(head, block_bits)]
        return pd.DataFrame(out, columns=names)
    return run


def _groups(head: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by digest, keeping the order of occurrence; places where a new digest begins."""
    order = np.argsort(head, kind="stable")
    equal = head[order][1:] == head[order][:-1]
    if equal.any() and (tail[order][1:] != tail[order][:-1])[equal].any():
        order = np.lexsort((tail, head))
    h, t = head[order], tail[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    return order, np.flatnonzero(new)


def _first_anywhere(group: pd.DataFrame) -> pd.DataFrame:
    """Group one block's digests; per chunk, the windows whose first occurrence is elsewhere."""
    heads = [unpack_sorted(x, np.uint64) for x in group["head"]]
    sizes = [len(x) for x in heads]
    head = np.concatenate(heads)
    tail = np.concatenate([unpack(x, np.uint32) for x in group["tail"]])
    ids = np.concatenate([unpack(x, np.int64) for x in group["ids"]])
    chunk = np.repeat(group["chunk"].to_numpy(), sizes)
    order = np.lexsort((chunk, ids, tail, head))
    h, t = head[order], tail[order]
    later = np.zeros(len(h), bool)
    later[order[1:]] = (h[1:] == h[:-1]) & (t[1:] == t[:-1])
    out = []
    for c, at, own in zip(group["chunk"], group["at"], np.split(later, np.cumsum(sizes)[:-1])):
        if own.any():
            out.append((c, pack_sorted(np.sort(unpack(at, np.uint32)[own]))))
    return pd.DataFrame(out, columns=["chunk", "at"])


def _cut(n: int):
    def run(chunk: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        row = chunk.iloc[0]
        s = open_chunk(row["lengths"], row["texts"])
        data, w = s.data, words(s.data, s.offsets)
        at, h = _windows(data, w, n, 0)
        order, first = _groups(h, (_windows(data, w, n, 1)[1] >> np.uint64(32)).astype(np.uint32))
        again = np.ones(len(h), bool)
        again[order[first]] = False
        edge = np.zeros(len(w.starts) + n + 1, np.int32)
        for starts in (at[again], *(unpack_sorted(x, np.uint32) for x in told["at"])):
            edge[starts] += 1
            edge[starts.astype(np.int64) + n] -= 1
        gone = np.cumsum(edge)[:len(w.starts)] > 0
        raw, out = data.tobytes(), []
        for k, key in enumerate(row["ids"]):
            lo, hi = int(w.first[k]), int(w.first[k + 1])
            kept = np.flatnonzero(~gone[lo:hi]) + lo
            text = b" ".join([raw[a:b] for a, b in zip(w.starts[kept].tolist(), w.ends[kept].tolist())])
            out.append((None if key == LAST else int(key), hi - lo, hi - lo - len(kept),
                        text.decode("utf-8", "replace")))
        df = pd.DataFrame(out, columns=["id", "n_words", "n_removed", "kept"])
        return df.astype({"id": "Int64"})
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WINDOW,
                   cell_bits: int = CELL_BITS, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """(id, n_words, n_removed, kept): ``kept`` is the remaining words joined by one space."""
    spark = docs.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "substring", uuid.uuid4().hex)
    chunks = write_chunks(docs, path, _count(n), id_col=id_col, text_col=text_col)
    bits, block_bits = widths(chunks, cell_bits, block_entries)
    told = merged(chunks, _items(n), bits, block_bits)
    texts = chunks.select("chunk", "ids", "lengths", "texts")
    digests = texts.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInPandas(
        _exact(n, bits, block_bits), "block int, chunk long, head binary, tail binary, ids binary, at binary")
    later = digests.groupBy("block").applyInPandas(_first_anywhere, "chunk long, at binary")
    out = texts.groupBy("chunk").cogroup(later.groupBy("chunk")).applyInPandas(
        _cut(n), "id long, n_words long, n_removed long, kept string")
    return out.withColumnRenamed("id", id_col)


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
later AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, (SELECT unnest(range(20)) AS k)),
word AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
         FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(kept.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


@query("op9_substring_dedup", ORACLE)
def op9(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
