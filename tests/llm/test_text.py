import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from hoodcast.llm import text as T

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t\x0b\x0c\r\x1c é", max_size=40)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 6))
def test_words_hashes_and_windows(texts, n):
    column = pa.array([None if t is None else t.encode() for t in texts], pa.binary())
    seen = {}
    for s in T.slices(column, 16):
        w = T.words(s.data, s.offsets)
        want = [re.findall(rb"[^\x20\x09-\x0D]+", (texts[i] or "").encode()) for i in range(s.lo, s.hi)]
        assert w.counts.tolist() == [len(x) for x in want]
        flat = [x for doc in want for x in doc]
        assert [s.data[a:b].tobytes() for a, b in zip(w.starts, w.ends)] == flat
        h = T.word_hashes(s.data, w)
        for word, value in zip(flat, h.tolist()):
            assert seen.setdefault((word,), value) == value
        at = T.window_starts(w.first, n)
        windows = [tuple(doc[i:i + n]) for doc in want for i in range(len(doc) - n + 1)]
        assert [tuple(flat[i:i + n]) for i in at] == windows
        for key, value in zip(windows, T.window_hashes(h, n)[at].tolist()):
            assert seen.setdefault((n, key), value) == value
    assert len(set(seen.values())) == len({k if len(k) == 1 or k[0] != 1 else k[1] for k in seen})


def test_one_long_word_and_sliced_arrays():
    column = pa.array([b"skip", b"y" * 100_001, b"", b"y" * 100_001 + b" z"], pa.binary()).slice(1)
    hashes = []
    for s in T.slices(column):
        w = T.words(s.data, s.offsets)
        hashes += T.word_hashes(s.data, w).tolist()
    assert len(hashes) == 3 and hashes[0] == hashes[1] != hashes[2]


def test_lower_ascii_only():
    data = np.frombuffer("AZaz[É".encode(), np.uint8)
    assert T.lower_ascii(data).tobytes().decode() == "azaz[É"
