import base64
import hashlib
import json
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from samples import MEDIUM, ODD
from hoodcast.llm import chat_format, packing, registry, warc


def check_packing(rows, texts, capacity):
    """Pieces hold their documents' ids in order; sequences are gapless and not too long."""
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((str(k), tuple(tok.encode(t or "", add_special_tokens=False).ids) + (0,)) for k, t in texts)
    docs, sequences, total = defaultdict(list), defaultdict(list), 0
    for r in rows:
        docs[str(r.doc_id)].append(r)
        sequences[r.sequence_id].append(r)
        assert len(r.ids) == 4 * r.length and 1 <= r.length <= capacity
        assert r.piece == 0 or r.length == capacity
        total += r.length
    got = []
    for k, pieces in docs.items():
        pieces.sort(key=lambda r: (r.start, r.sequence_id))
        copies = sum(r.start == 0 for r in pieces)
        for c in range(copies):  # repeated rows: equal pieces
            own = pieces[c::copies]
            assert [r.piece for r in own] == list(range(len(own)))
            got.append((k, tuple(np.frombuffer(b"".join(r.ids for r in own), "<u4").tolist())))
    assert sorted(got) == want
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(sequences), total / capacity


def test_packing_is_exact_and_tight(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    made, bound = check_packing(packing.pack(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()], 2048)
    assert made <= 1.01 * bound + 1


def test_packing_on_odd_rows(odd, nothing):
    texts = [(r[0], r[1]) for r in ODD]
    check_packing(packing.pack(odd).collect(), texts, 2048)
    check_packing(packing.pack(odd, capacity=64, open_bins=2, look_ahead=3).collect(), texts, 64)
    assert packing.pack(nothing).count() == 0


def test_encoder_equals_the_files_own_library():
    tok = Tokenizer.from_file(packing.default_tokenizer())
    encode = packing.encoder(packing.default_tokenizer())
    rng = random.Random(5)
    texts = ["", "don't  stop\n\n now", "é漢字​😀", "a<|endoftext|>b", " " * 5000 + "x", "1234567 3.5kg"]
    texts += ["".join(rng.choice("ab \n'sé9!?\t漢") for _ in range(200)) for _ in range(50)]
    for t in texts:
        assert encode(t.encode()).tolist() == tok.encode(t, add_special_tokens=False).ids


def test_open_bins_brute_force():
    rng = random.Random(3)
    for limit in (1, 3, 50):
        bins, free = packing.OpenBins(20, limit), {}
        for _ in range(500):
            n = rng.randint(1, 20)
            number, offset = bins.place(n)
            fits = [f for f in free.values() if f >= n]
            if fits:
                assert free[number] == min(fits) and offset == 20 - free[number]
                left = free.pop(number) - n
            else:
                assert offset == 0
                left = 20 - n
            if left:
                free[number] = left
                if len(free) > limit:  # the fullest closes; of equals the one opened to it last
                    least = min(free.values())
                    gone = [k for k, f in free.items() if f == least]
                    still = {k for f in bins.by_free for k in f}
                    (closed,) = [k for k in gone if k not in still]
                    del free[closed]


def test_archive_matches_sql(against_oracle):
    against_oracle("op5_web_archive", MEDIUM)


def test_archive_round_trip_on_odd_rows(spark, tmp_path):
    pages = [(1, "http://a/", "<p>x</p>\r\n\r\n", 0), (2, None, "<p>x</p>\r\n\r\n", 0), (2, None, "<p>x</p>\r\n\r\n", 0),
             (3, "http://b/ c\r\nd", None, 0), (4, "u", "", 0), (5, "u", "é" * 100_000, 0), (None, "n", "<p>x</p>\r\n\r\n", 0),
             (None, "n", "only here", 0), (7, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc", 0)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, header int").repartition(4)
    path = str(tmp_path / "a")
    warc.write_archive(df, path)
    records = warc.read_archive(spark, path)
    rows = warc.describe(records).collect()
    assert len(rows) == len(pages)
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    got = sorted((r.payload_bytes, r.payload_digest, r.record_type, str(r.id), str(r.refers_to)) for r in rows)
    owner = {"<p>x</p>\r\n\r\n": 1, "": 3}
    want = []
    for k, _, html, _ in pages:
        o = owner.get(html or "", k)
        again = o is not None and k != o
        want.append((len((html or "").encode()), sha(html), "revisit" if again else "response", str(k),
                     str(o) if again else "None"))
    assert got == sorted(want)
    assert spark.read.parquet(f"{path}/payloads").count() == 5
    warc.export_warc(records, str(tmp_path / "w"), records_per_file=2)
    back = warc.read_warc(spark, str(tmp_path / "w"))
    key = lambda f: sorted((bytes(r.header), bytes(r.payload)) for r in f.collect())
    assert key(back) == key(records)
    warc.write_archive(df.limit(0), str(tmp_path / "e"))
    assert warc.read_archive(spark, str(tmp_path / "e")).count() == 0


def test_archive_min_bytes(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")],
                               "page_id long, url string, html string")
    warc.write_archive(df, str(tmp_path / "m"), min_bytes=3)
    kinds = {r.id: r.record_type for r in warc.describe(warc.read_archive(spark, str(tmp_path / "m"))).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


TOOLS = {
    "add": {"type": "object", "properties": {"x": {"type": "integer"}, "y": {"type": "integer", "maximum": 9}},
            "required": ["x", "y"], "additionalProperties": False},
    "get": {"type": "object", "properties": {"k": {"type": "string", "enum": ["v", "w"]}}, "required": ["k"]},
}
TURNS = [
    (1, 0, "user", 'Say "hi"\n é \x01 /'),
    (1, 1, "assistant", 'ok <tool_call>{"id":"b","name":"add","arguments":{"x":{"$ref":"a"},"y":2.0}}</tool_call>'
                        '<tool_call>{"id":"a","name":"get","arguments":{"k":"v"}}</tool_call> done'),
    (1, 2, "tool", '{"id":"a","content":{"z":1,"a":[1,2.5]}}'),
    (1, 3, "assistant", '<tool_result>{"id":"b","content":3}</tool_result><tool_call>nope</tool_call>'),
    (1, 4, "assistant", '<tool_call>{"id":"b","name":"get","arguments":{"k":"x"}}</tool_call>'),
    (2, 0, "assistant", '<tool_call>{"id":"p","name":"get","arguments":{},"after":["q"]}</tool_call>'
                        '<tool_call>{"id":"q","name":"nix","after":["p"]}</tool_call>'),
    (2, 1, "tool", '{"id":"zz","content":1}'), (2, 2, None, None), (None, 0, "user", "x"), (3, 0, "user", "y"),
    (3, 0, "user", "y"),
    (4, 0, "assistant", '<tool_call>{"id":"a","name":"add","arguments":{"x":true,"y":10,"z":1}}</tool_call>'),
]


def test_chat_matches_sql(against_oracle):
    against_oracle("op6_chat_formatting", MEDIUM)


def test_chat_links_orders_and_validates(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").repartition(3)
    rows = chat_format.format_chat(df, TOOLS).collect()
    at = {(r.conv_id, r.turn, r.place): r for r in rows}
    assert len(rows) == sum(len(chat_format.parse(r or "unknown", t or "")) for _, _, r, t in TURNS)
    assert at[1, 0, 0].json == '{"content":"Say \\"hi\\"\\n é \\u0001 /","role":"user"}'
    assert at[1, 1, 0].json == '{"content":"ok  done","role":"assistant"}'
    assert at[1, 1, 1].json == '{"call":{"arguments":{"x":{"$ref":"a"},"y":2},"name":"add"},"id":"b","role":"assistant"}'
    assert (at[1, 1, 1].level, at[1, 1, 2].level) == (1, 0) and at[1, 1, 1].linked and at[1, 2, 0].linked
    assert at[1, 2, 0].json == '{"content":{"a":[1,2.5],"z":1},"id":"a","role":"tool"}'
    assert at[1, 3, 0].problems == ["malformed call"]
    assert at[1, 4, 1].problems == ["arguments.k: not in enum", "repeated id"] and not at[1, 4, 1].linked
    assert at[2, 0, 1].problems == ["arguments.k: missing", "no result", "cycle"]
    assert at[2, 0, 2].problems == ["unknown tool", "no result", "cycle"]
    assert at[2, 1, 0].problems == ["no call"] and at[2, 2, 0].json == '{"content":"","role":"unknown"}'
    assert at[4, 0, 1].problems == ["arguments.x: not integer", "arguments.y: out of range", "arguments.z: unknown",
                                    "no result"]
    whole = {r.conv_id: r.json for r in chat_format.conversations(chat_format.format_chat(df, TOOLS)).collect()}
    assert whole[1].index('"id":"a"') < whole[1].index('"name":"add"')
    assert chat_format.format_chat(df.limit(0), TOOLS).count() == 0


def test_chat_hostile_markup(spark):
    """Half surrogates, deep nesting, huge integers, constants that are no JSON, odd schemas."""
    call = lambda i, a: f'<tool_call>{{"id":"{i}","name":"f","arguments":{a}}}</tool_call>'
    deep = "[" * 3000 + "]" * 3000
    turns = [(1, 0, "a", call("\\ud800", '{"v":"x\\udfffy","\\ud83d\\ude00":"\\ud83d\\ude00"}')), (1, 1, "tool", '{"id":"\\ud800","content":"\\udc00"}'),
             (1, 2, "a", call("d", f'{{"v":{deep}}}')), (1, 3, "a", call("n", f'{{"v":{"9" * 400}}}')),
             (1, 4, "a", call("c", '{"v":NaN}') + call("c", '{"v":-Infinity}') + call("c", '{"v":1e999}')),
             (1, 5, "a", call("m", f'{{"v":{"9" * 9000}}}')), (1, 6, "tool", f'{{"id":"d","content":{"[" * 100_000}'),
             (1, 7, "a", call("l", '{"v":null}')), (1, 8, "a", call("t", '{"v":"s"}')), (1, 9, "a", call("b", '{"v":true}'))]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    tools = {"f": {"properties": {"v": {"type": ["integer", "null"], "minimum": "x", "enum": None}}, "required": 3}}
    rows = chat_format.format_chat(df, tools).collect()
    at = {(r.turn, r.place): r for r in rows}
    assert at[0, 1].json == '{"call":{"arguments":{"v":"x\ufffdy","\U0001f600":"\U0001f600"},"name":"f"},"id":"\ufffd","role":"a"}'
    assert at[0, 1].linked and at[1, 0].linked and at[1, 0].json.startswith('{"content":"\ufffd"')
    assert at[2, 0].problems == ["too deep call"] and deep in at[2, 0].json
    assert at[3, 1].problems == ["no result"] and "9" * 400 in at[3, 1].json
    assert at[4, 0].problems == ["malformed call"] * 3 and at[5, 0].problems == ["malformed call"]
    assert (6, 0) in at and at[7, 1].problems == ["no result"]
    assert at[8, 1].problems == at[9, 1].problems == ["arguments.v: not integer or null", "no result"]
    for r in rows:
        json.loads(r.json)
    assert chat_format.violations(1, {"enum": [True]}) and not chat_format.violations(1.0, {"enum": [1]})
    assert not chat_format.violations(10 ** 400, {"type": "integer", "minimum": 0.5}) and chat_format.violations(1, {"type": "x"})


def test_chat_tools_declared_by_the_conversation(spark):
    declare = '<tools>[{"name":"f","parameters":{"type":"object","required":["k"]}},{"name":"g"}]</tools>'
    call = lambda n, a="{}": f'<tool_call>{{"id":"1","name":"{n}","arguments":{a}}}</tool_call>'
    turns = [(1, 0, "system", "Use " + declare), (1, 1, "a", call("f")), (2, 0, "system", declare), (2, 1, "a", call("h")),
             (3, 0, "user", declare), (3, 1, "a", call("f")), (4, 0, "system", "<tools>{}</tools>"), (4, 1, "a", call("f")),
             (5, 0, "system", declare), (5, 1, "a", call("f", '{"k":1}')), (None, 0, "system", declare), (None, 1, "a", call("f"))]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("wrong", F.lit("x"))
    rows = chat_format.format_chat(df).collect()
    got = {(r.conv_id, r.turn): r.problems for r in rows if r.place == 1}
    assert got[1, 1] == ["arguments.k: missing", "no result"] and got[2, 1] == ["unknown tool", "no result"]
    assert got[3, 1] == got[5, 1] == got[4, 1] == ["no result"] and got[None, 1] == ["no result"]
    texts = {(r.conv_id, r.turn): r for r in rows if r.place == 0}
    assert texts[4, 0].problems == ["malformed tools"] and "f" in texts[1, 0].json and len(rows) == 18
    rows = chat_format.format_chat(df, {}).collect()
    assert {tuple(r.problems) for r in rows if r.conv_id in (3, 4) and r.place == 1} == {("unknown tool", "no result")}
