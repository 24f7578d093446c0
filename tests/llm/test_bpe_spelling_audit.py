import hashlib
import random
import re
import sys
import zlib
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from samples import MEDIUM, ODD, SMALL
from hoodcast.llm import byte_bpe, filter_audit, registry, spelling_variants


def library(name="byte_bpe_multi_50k.tiktoken"):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path(name)))


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.encoder(byte_bpe.default_ranks(), byte_bpe.default_pattern())


def test_encoding_is_the_librarys_and_round_trips(spark):
    texts = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text")
    enc = library()
    got = registry.QUERIES["op11_byte_level_bpe"](spark, MEDIUM)
    assert got.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    text = {r.doc_id: r.text or "" for r in texts.collect()}
    rows = got.collect()
    assert len(rows) == len(text) == 1000
    for r in rows:
        ids = enc.encode_ordinary(text[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_encoding_of_random_strings(coder):
    rng, enc = random.Random(7), library()
    letters = ["a", "b", "s", "t", "'", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", " ", "　", "1", "½", "!", "é", "ß",
               "é", "字", "の", "😀", "‍", "�", "\U00018da7", "\U00010ee7", "don't", " I'LL", "the", "ing", "\U0010ffff"]
    for _ in range(3000):
        s = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        assert coder.ids(s).tolist() == enc.encode_ordinary(s), ascii(s)
    for s in ("a" * 5000, "ab" * 3000, " " * 5000 + "x", "\n" * 3000, "é" * 3000, "😀" * 500, "=" * 4000, "aab" * 1000 + "c", "の" * 999):
        assert coder.ids(s).tolist() == enc.encode_ordinary(s), s[:9]


def test_splitting_classes_of_every_code_point(coder):
    """The pieces' borders around any code point are the library's."""
    probes = {k: tiktoken.Encoding("probe", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks={
        bytes([b]): b for b in range(256)} | {k.encode() + bytes([b]): 256 + b for b in range(0xC2, 0xF5)}) for k in "a1!"}
    wrong = []
    for c in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= c < 0xE000:
            continue
        for k, probe in probes.items():
            together = probe.encode_ordinary(k + chr(c))[0] >= 256
            if (len(coder.pieces(k + chr(c))) == 1) != together:
                wrong.append((k, hex(c)))
    assert wrong == []
    assert all(regex.fullmatch(r"\s", chr(c)) is None or coder.pieces(f"!{chr(c)}!") == ["!", chr(c), "!"] for c in range(33, 0x3100))


def test_encoding_by_another_vocabulary_that_merges_do_not_all_reach():
    """Tokens that no merges make are taken as a whole piece only; pairs merge by the joined bytes' rank."""
    words = [b"ab", b"bc", b"abc", b"cd", b"xyz", b"bcd", b"aa", b"aaa", b"aaaa", b"ca"]
    ranks = {bytes([b]): b for b in range(256)} | {w: 256 + i for i, w in enumerate(words)}
    enc = tiktoken.Encoding("tiny", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
    rng = random.Random(3)
    for _ in range(4000):
        s = "".join(rng.choice("abcdxyz") for _ in range(rng.randrange(1, 14)))
        assert own.ids(s).tolist() == enc.encode_ordinary(s), s


def test_encoding_of_odd_rows(spark, odd, nothing):
    got = byte_bpe.encode(odd)
    enc = library()
    want = Counter((i, tuple(enc.encode_ordinary(t or ""))) for i, t, *_ in ODD)
    assert Counter((r.doc_id, tuple(r.ids)) for r in got.collect()) == want
    back = byte_bpe.decode(got.withColumns({"row": F.lit("r"), "decoded2": F.lit(1)}))
    assert back.columns == ["doc_id", "row", "decoded2", "decoded"]
    assert Counter((r.doc_id, bytes(r.decoded)) for r in back.collect()) == Counter((i, (t or "").encode()) for i, t, *_ in ODD)
    assert byte_bpe.encode(nothing).count() == byte_bpe.decode(byte_bpe.encode(nothing)).count() == 0
    assert byte_bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).first().decoded is None
    with pytest.raises(Exception, match="outside the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([(1, [60_000])], "doc_id long, ids array<int>")).collect()


def near_pairs(words):
    """Every pair one inserted, deleted or replaced code point apart, by comparing places one by one."""
    def one(a, b):
        if len(a) < len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(a) == len(b) + 1 and any(a[:k] + a[k + 1:] == b for k in range(len(a)))
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    return {a: {b for k in (-1, 0, 1) for b in by_size.get(len(a) + k, []) if b != a and one(a, b)} for a in words}


def grouped(count):
    """The contract's columns by brute force."""
    near, form = near_pairs(list(count)), {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-count[x], x))
            if count[best] >= 2 * count[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {(w, form.get(w), root(w), n, len(near[w]), count.get(form.get(w))) for w, n in count.items()}


def counted(docs):
    found = Counter()
    for i, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{i}:{w}".encode())
            if h % 97 == 0 and i is not None:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            found[w] += 1
    return {w: n for w, n in found.items() if n >= 3 and len(w) >= 5}


def test_spelling_variants_by_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = registry.QUERIES["op12_spelling_variants"](spark, SMALL)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    want = grouped(counted(docs))
    assert len(rows) == len(want) and set(rows) == want
    assert sum(r[1] is not None for r in rows) > 500


def test_spelling_variants_match_sql(against_oracle):
    assert len(against_oracle("op12_spelling_variants", MEDIUM)) > 10_000


def test_spelling_variants_of_hot_keys(spark, tmp_path):
    """Keys with too many words are cut until they are small; every pair is still found once."""
    rng = random.Random(5)
    words = {"stem" + "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 7))) for _ in range(2500)}
    words |= {"".join(rng.choice("aß") for _ in range(rng.randrange(5, 9))) + "stem" for _ in range(200)} | {"x" * 300, "x" * 301}
    count = {w: rng.randrange(3, 200) for w in words}
    df = spark.createDataFrame(list(count.items()), "word string, n long")
    for k, limit in enumerate((4, 50, 10_000)):
        near = spelling_variants.near(df, str(tmp_path / str(k)), key_words=limit)
        want = {w: others for w, others in near_pairs(list(words)).items() if others}
        got = near.collect()
        assert len(got) == len(want)
        for r in got:
            assert r.n_near == len(want[r.word])
            assert r.best.word == min(want[r.word], key=lambda x: (-count[x], x))
    rows = spelling_variants.group(df, str(tmp_path / "all")).collect()
    assert {tuple(r) for r in rows} == grouped(count)


def test_spelling_variants_long_chain(spark, tmp_path):
    count = {"chain" + "a" * k: 3 * 2 ** k for k in range(20)} | {"alone": 5, "alones": 9}
    df = spark.createDataFrame(list(count.items()), "word string, n long")
    rows = {r.word: r for r in spelling_variants.group(df, str(tmp_path / "c")).collect()}
    assert rows["chain"].root == "chain" + "a" * 19 and rows["chain"].form == "chaina"
    assert rows["alone"].form is None and rows["alone"].root == "alone" and rows["alone"].n_near == 1


def test_spelling_variants_on_odd_rows(spark, odd, nothing, tmp_path):
    docs = [(i, t) for i, t, *_ in ODD] + [(20, "ÀÉÎõü×÷ÿ " * 3), (21, "Straße straßE STRASSE strasse strasse Ābcdefgh " * 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {tuple(r) for r in spelling_variants.count_words(df).collect()} == set(counted(docs).items())
    assert spelling_variants.count_words(odd).count() == len(counted([(i, t) for i, t, *_ in ODD]))
    assert spelling_variants.group(spelling_variants.count_words(nothing), str(tmp_path / "n")).count() == 0


def test_filter_audit_matches_sql(against_oracle):
    rows = against_oracle("op13_filter_audit", MEDIUM)
    assert len(rows) == 20 * 600


def audited(docs, labels):
    """Every order run over the rows themselves."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    seen = {}
    for i, text, _ in docs:
        if i is not None:
            seen[text or ""] = min(i, seen.get(text or "", i))
    rows = []
    for i, text, part in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0d]+", t)
        fails = (("A" if len(w) < 50 else "") + ("B" if 100 * len(set(w)) < 65 * len(w) else "")
                 + ("C" if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else "") + ("D" if re.search("[#$%&*|]", t) else "")
                 + ("E" if i is not None and t in seen and seen[t] < i else ""))
        rows.append((part or "", fails, i in good, i in toxic))
    out, shapley = [], Counter()
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            gone = []
            for k, f in enumerate(order):
                cut = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[part, f] += len(cut)
                out.append([part, "".join(order), k + 1, len(left), len(cut), sum(f in r[1] for r in gone),
                            sum(r[0] == part and r[1] == f for r in rows), sum(r[2] for r in cut), sum(r[3] for r in cut), f])
                gone += cut
    return {(*r[:9], shapley[r[0], r[9]]) for r in out}


def test_filter_audit_by_brute_force(spark, odd, nothing):
    rng = random.Random(11)
    texts = ["", None, "word " * 60, "Many Words HERE " * 3, " ".join(map(str, range(80))), "a$b " * 55, "#", "ÄÖÜ   X",
             " ".join(f"w{k}" for k in range(70)) + " %"]
    docs = [(rng.choice([None, *range(1, 60)]), rng.choice(texts), rng.choice([None, "", "a", "b'c"])) for _ in range(150)]
    labels = [(rng.choice([None, *range(1, 70)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    df = df.withColumns({"part": F.lit("x"), "failed": F.lit(3), "quality": F.lit(1), "id": F.lit(0), "words": F.lit("w")})
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("n", F.lit(1))
    got = filter_audit.audit(df, lab)
    assert got.columns == list(filter_audit.COLUMNS)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == 3 * 600 and set(rows) == audited(docs, labels)
    rows = [tuple(r) for r in filter_audit.audit(odd, lab, part_col="score").collect()]
    assert set(rows) == audited([(i, t, s) for i, t, s, _ in ODD], labels)
    assert filter_audit.audit(nothing, lab, part_col="score").count() == 0
    assert filter_audit.audit(df, lab.limit(0)).where("good_lost > 0 or toxic_lost > 0").count() == 0


def test_ways_count_the_orders():
    before, after = filter_audit.ways(5)
    assert before[-1] == after[0] == 120
    assert all(sum(before[s] * after[s | 1 << f] for s in range(32) if not s >> f & 1) == 120 for f in range(5))
