"""Byte-level BPE encoding and decoding by a rank file.

A text is split by the vocabulary's pattern; every piece is encoded for itself. The bytes
of a piece are read as Latin-1, so that an Aho-Corasick automaton over the vocabulary
finds the longest token from every place in one pass. From left to right the longest
token is taken that goes with the one before it; where none does, the last token is taken
back and its next shorter prefix is tried. Two neighbours go together when merging their
bytes ends in just these two (memoised). A sequence whose neighbours all go together is the
merges' own result: the first merge across a border would also happen in that pair alone. (A token that merges never make is only
taken for a piece that it spells whole, as the library does.)
A place once left in failure is not entered again, so the work is linear in the piece.

Edge cases: a null or empty text has no ids; an id twice or null is a row like any
other; bytes that are no UTF-8 count as U+FFFD; texts are taken whole, whatever their
length; ids outside the vocabulary raise when decoded, a null list decodes to nothing.
"""

from __future__ import annotations

import base64
import functools
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoodcast.llm.registry import query, table

#: Entries that a worker's memo of pieces, or of token pairs, may hold before it starts anew.
MEMO = 1 << 18
#: Longer pieces are not kept in the memo.
MEMO_PIECE = 64
#: Ids that one output batch carries, a longer text aside.
BATCH_IDS = 1 << 20


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"{path}: every single byte needs a rank")
    return ranks


@functools.cache
def stand_ins() -> dict[int, str]:
    """Code points that this process's Unicode tables and tiktoken's put into different classes
    (letter, number, neither), with a code point of tiktoken's class to match instead.

    Only code points new to one of the tables can differ. A probe vocabulary tells tiktoken's class:
    it merges a lead byte with a letter or digit before it only if both are of one piece."""
    new = [c for c in range(0x80, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cn"]
    own = {c: k for k, cls in (("a", r"\p{L}"), ("1", r"\p{N}"))
           for c in map(ord, regex.findall(cls, "".join(map(chr, new))))}
    leads = sorted({chr(c).encode()[0] for c in new})
    pairs = [before + bytes([lead]) for before in (b"a", b"1") for lead in leads]
    ranks = {bytes([b]): b for b in range(256)} | {p: 256 + i for i, p in enumerate(pairs)}
    probe = tiktoken.Encoding("probe", pat_str=r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+", mergeable_ranks=ranks,
                              special_tokens={})
    out = {}
    for c in own:
        theirs = next((k for k in "a1" if probe.encode_ordinary(k + chr(c))[0] >= 256), "")
        if theirs != own[c]:
            out[c] = {"a": "ª", "1": "²"}.get(theirs, theirs)
    return out


class Memo(dict):
    """``make``'s results by argument, texts longer than ``MEMO_PIECE`` aside. When it is full
    it starts anew, and takes over from its last contents what is still asked for."""

    def __init__(self, make):
        super().__init__()
        self.make, self.last = make, {}

    def __missing__(self, key):
        found = self.last.get(key, self)
        if found is self:
            found = self.make(key)
        if not isinstance(key, str) or len(key) <= MEMO_PIECE:
            self[key] = found
        return found

    def bound(self, size: int) -> None:
        if len(self) >= size:
            self.last = dict(self)
            self.clear()


class Encoder:
    """``ids(text)`` by ranks and a splitting pattern, as tiktoken's ``encode_ordinary``."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token = {i: b for b, i in ranks.items()}
        self.split = regex.compile(pattern)
        self.other = stand_ins()
        self.odd = frozenset(map(chr, self.other))
        self.high = re.compile(f"[{min(self.odd, default=chr(sys.maxunicode))}-{chr(sys.maxunicode)}]")
        self.automaton = ahocorasick.Automaton()
        for b, i in ranks.items():
            self.automaton.add_word(b.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.size = {i: len(b) for b, i in ranks.items()}
        self.memo = Memo(self.piece)
        self.pairs: dict[int, bool] = {}
        self.shorter = Memo(self.prefix)
        self.made = Memo(lambda i: self._ends(self.token[i]) == 1)

    def pieces(self, text: str) -> list[str]:
        if text.isascii() or not self.high.search(text) or self.odd.isdisjoint(text):
            return self.split.findall(text)
        return [text[m.start():m.end()] for m in self.split.finditer(text.translate(self.other))]

    def ids(self, text: str) -> array:
        self.memo.bound(MEMO)
        return array("i", chain.from_iterable(map(self.memo.__getitem__, self.pieces(text))))

    def piece(self, piece: str) -> tuple[int, ...]:
        b = piece.encode()
        whole = self.ranks.get(b)
        return (whole,) if whole is not None else tuple(self.backtrack(b))

    def backtrack(self, b: bytes) -> list[int]:
        n, size, pairs = len(b), self.size, self.pairs
        longest: list[int | None] = [None] * n
        for end, i in self.automaton.iter(b.decode("latin-1")):
            longest[end - size[i] + 1] = i  # ends ascend: the last token seen from a place is the longest
        dead = bytearray(n + 1)
        out: list[int] = []
        at, last, nxt = 0, -1, longest[0]
        while True:
            while nxt is not None:
                end = at + size[nxt]
                if not dead[end]:
                    if last < 0:
                        if self.made[nxt]:
                            break
                        nxt = self.shorter[nxt]
                        continue
                    fits = pairs.get(last << 32 | nxt)
                    if self.together(last, nxt) if fits is None else fits:
                        break
                nxt = self.shorter[nxt]
            if nxt is None:
                if last < 0:
                    raise ValueError("no sequence of tokens spells this piece")
                dead[at] = 1
                at -= size[last]
                out.pop()
                last, nxt = out[-1] if out else -1, self.shorter[last]
                continue
            out.append(nxt)
            if end == n:
                return out
            at, last, nxt = end, nxt, longest[end]

    def prefix(self, i: int) -> int | None:
        """The longest token that is a proper prefix of token ``i``."""
        b = self.token[i]
        return next((self.ranks[b[:k]] for k in range(len(b) - 1, 0, -1) if b[:k] in self.ranks), None)

    def together(self, a: int, b: int) -> bool:
        if len(self.pairs) >= MEMO:
            self.pairs.clear()
        left = self.token[a]
        found = self.pairs[a << 32 | b] = self._ends(left + self.token[b], len(left)) == 2
        return found

    def _ends(self, b: bytes, border: int = 0) -> int:
        """How many tokens the merges over ``b`` end in; 0 if they merge across ``border``."""
        ranks = self.ranks
        cuts = list(range(len(b) + 1))
        while len(cuts) > 2:
            ranked = [ranks.get(b[cuts[k]:cuts[k + 2]], sys.maxsize) for k in range(len(cuts) - 2)]
            k = ranked.index(low := min(ranked))
            if low == sys.maxsize:
                break
            if cuts[k + 1] == border:
                return 0
            del cuts[k + 1]
        return len(cuts) - 1


@functools.cache
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(path), pattern)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """(id, ids array<int>) of every row of ``docs``. ``ranks`` is a path every worker can read."""
    ranks, pattern = ranks or default_ranks(), pattern or default_pattern()
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(ranks, pattern)
        for b in batches:
            text, lo, ids, ends = b.column("text"), 0, array("i"), [0]
            for i in range(b.num_rows):
                t = text[i].as_py()
                if t:
                    ids.extend(own.ids(t.decode("utf-8", "replace")))
                ends.append(len(ids))
                if len(ids) >= BATCH_IDS or i + 1 == b.num_rows:
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids, np.int32)))
                    yield pa.RecordBatch.from_arrays([b.column("id").slice(lo, i + 1 - lo), lists], ["id", "ids"])
                    lo, ids, ends = i + 1, array("i"), [0]

    out = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return out.mapInArrow(run, f"id {id_type}, ids array<int>").withColumnRenamed("id", id_col)


def decode(df: DataFrame, ids_col: str = "ids", to: str = "decoded", ranks: str | None = None) -> DataFrame:
    """``df`` with the bytes that its ids spell in place of the ids."""
    ranks = ranks or default_ranks()
    keep = [c for c in df.columns if c != ids_col]
    kinds = dict(df.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell = spelling(ranks)
        for b in batches:
            lists = b.column("ids")
            count = np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)
            ends, values = np.cumsum(count), lists.flatten().to_numpy()
            lo = 0
            while lo < len(count):
                first = ends[lo] - count[lo]
                hi = max(lo + 1, int(np.searchsorted(ends, first + BATCH_IDS, "right")))
                data, size = spell(values[first:ends[hi - 1]])
                off = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], ends[lo:hi] - first])]
                part = pa.LargeBinaryArray.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data)])
                part = pc.if_else(lists.slice(lo, hi - lo).is_null(), pa.scalar(None, pa.large_binary()), part).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([b.column("row").slice(lo, hi - lo), part], ["row", "decoded"])
                lo = hi

    row = F.struct(*[F.col(f"`{c}`") for c in keep])
    kind = "struct<" + ",".join(f"`{c}`:{kinds[c]}" for c in keep) + ">"
    out = df.select(row.alias("row"), F.col(f"`{ids_col}`").alias("ids")).mapInArrow(
        run, f"row {kind}, decoded binary")
    return out.select(*[F.col("row").getField(c).alias(c) for c in keep], F.col("decoded").alias(to))


@functools.cache
def spelling(path: str):
    """``ids -> (their bytes one after the other, the length of each)``."""
    ranks = read_ranks(path)
    size = np.full(max(ranks.values()) + 1, -1, np.int64)
    size[list(ranks.values())] = [len(b) for b in ranks]
    by_id = {i: b for b, i in ranks.items()}
    blob = np.frombuffer(b"".join(by_id.get(i, b"") for i in range(len(size))), np.uint8)
    start = np.cumsum(np.maximum(size, 0)) - np.maximum(size, 0)

    def spell(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(size) or (size[ids] < 0).any()):
            raise ValueError("an id outside the vocabulary")
        own = size[ids]
        at = np.repeat(start[ids] - (np.cumsum(own) - own), own)
        at += np.arange(len(at))
        return blob[at], own
    return spell


@query("op11_byte_level_bpe")
def op11(spark, sf_dir):
    ids = encode(table(spark, sf_dir, "documents"))
    text = decode(ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                             F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), "ids"))
    return text.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
