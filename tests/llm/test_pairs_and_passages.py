import random
import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from hoodcast.llm import decontaminate, jaccard_join, line_dedup, substring_dedup
from hoodcast.llm.components import connected_components
from samples import MEDIUM, ODD, SMALL

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words_of(text, lower=False):
    raw = (text or "").encode()
    return WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in raw) if lower else raw)


def brute_components(docs, n, percent):
    """Every pair compared; union of the links."""
    sets, parent = {}, {}
    for key, text in docs:
        w = words_of(text, lower=True)
        sets[key] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
        parent[key] = key

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: (len(s), root(k)) for k, s in sets.items()}


def families(seed, bases=6, members=14):
    """Copies of a few texts with ever more words exchanged, chains among them."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for b in range(bases):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 30, 90, 200]))]
        for m in range(members):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if m % 4 == 3:
                base = text
            docs.append(" ".join(text))
    rng.shuffle(docs)
    return [(7 * i + 3, t) for i, t in enumerate(docs)] + [(1, docs[0]), (2, docs[1].upper())]


@pytest.mark.parametrize("seed,n,percent,block", [(1, 4, 85, 8192), (2, 5, 80, 8192), (3, 4, 85, 3), (4, 1, 60, 2)])
def test_join_brute_force(spark, seed, n, percent, block):
    docs = families(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_join.link(df, n=n, percent=percent, block=block).collect()}
    want = brute_components(docs, n, percent)
    assert got == want
    assert 1 < len({c for _, c in want.values()}) < len(docs)


def test_join_on_the_small_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link(docs).collect()}
    assert got == brute_components([(r.doc_id, r.text) for r in docs.collect()], 4, 85)


def test_join_on_odd_rows(odd, nothing):
    rows = jaccard_join.link(odd).collect()
    assert len(rows) == len(ODD)
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id].add((r.n_shingles, r.component_id))
    assert by[1] == {(0, 1)} and by[3] == {(0, 3)} and by[4] == {(1, 4)} and by[6] == {(1, 6)}
    assert by[7] == {(5, 7)} and by[8] == {(5, 7)} and len(by[5]) == 1
    assert jaccard_join.link(nothing).count() == 0


def test_components(spark, tmp_path):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(5, 5), (None, 3)]
    links += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in connected_components(df, str(tmp_path)).collect()}
    assert got == {k: root(k) for k in parent}
    assert connected_components(df.limit(0), str(tmp_path / "e")).count() == 0


def brute_repeats(docs, n):
    """Words left of each document, windows judged on the input."""
    seen, out = set(), {}
    for key, text in sorted(docs):
        w = words_of(text)
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            window = tuple(w[i:i + n])
            if window in seen:
                gone[i:i + n] = [True] * n
            seen.add(window)
        out[key] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


def test_repeats_match_sql(against_oracle):
    rows = against_oracle("op9_substring_dedup", MEDIUM)
    assert any(r[2] for r in rows)


@pytest.mark.parametrize("n,entries", [(3, 1), (1, 1 << 21), (7, 5)])
def test_repeats_brute_force(spark, n, entries):
    rng = random.Random(n)
    docs = [(i * 3 % 101, " ".join(rng.choice("a b c d e f g é".split()) for _ in range(rng.randint(0, 60)))) for i in range(90)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept)
           for r in substring_dedup.remove_repeats(df, n=n, block_entries=entries, cell_bits=1).collect()}
    assert got == brute_repeats(docs, n)


def test_repeats_on_odd_rows(odd, nothing):
    rows = substring_dedup.remove_repeats(odd).collect()
    assert len(rows) == len(ODD)
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append((r.n_words, r.n_removed))
    assert by[1] == by[2] == by[3] == [(0, 0)] and by[6] == [(1, 0)]
    # five windows begin a cycle of five words; the sixth start is the first repeat
    assert by[7] == [(100_000, 100_000 - 5)] and by[8] == [(100_000, 100_000)]
    assert by[5] == [(14, 0), (14, 0)] and by[None] == [(10, 0)]
    assert substring_dedup.remove_repeats(nothing).count() == 0


ITEMS = [
    (1, "A farmer named Tom has 5 red apples and gives 3 of them to his friend Ann before Tom walks home"),
    (2, "A train travels 60 km in 2 hours while another train covers 90 km in the same span of time"),
    (3, "too short"), (4, None), (2, "A train travels 60 km in 2 hours while another train covers 90 km in the same span of time"),
]


def test_decontamination_of_reparameterised_questions(spark, nothing):
    docs = [
        (10, "Intro. A farmer named Eva has 7 red apples and gives 2 of them to his friend Bob before Eva walks home."),
        (11, "A farmer named Eva has 7 red apples and gives 2 of them to his friend Bob before Ida walks home"),
        (12, "A train travels 80 miles in 4 days while another train covers 70 miles in the same span of time"),
        (13, "a train travels 60 km in 2 hours while another train covers 90 km in the same span of time, said Tom"),
        (14, None), (15, ""), (16, "Nothing of the sort is in here at all, only words that say little of any train or farmer."),
        (17, "A train travels 60 km in"), (19, ITEMS[1][1].upper()), (10, "again an id"), (None, ITEMS[1][1]),
        (18, "A farmer named Eva has 7 red apples and gives 2 of them to his friend Eva before Eva walks home"),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.exact for r in decontaminate.find(d, b).collect()}
    # 11: Tom stands for Eva and for Ida; 18: Tom and Ann both for Eva
    assert got == {(10, 1): False, (12, 2): False, (13, 2): True, (19, 2): True, (None, 2): True}
    assert decontaminate.find(nothing, b).count() == 0
    assert decontaminate.find(d, b.limit(0)).count() == 0
    left = decontaminate.drop_contaminated(d.withColumn("hash", F.lit(1)), b)
    assert left.columns == ["doc_id", "text", "hash"]
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(map(str, [11, 14, 15, 16, 17, 10, 18]))


def test_decontamination_of_a_copy_with_one_value_changed(spark):
    text = ("In spring a farmer named Tom plants 5 rows of beans and waters them every other morning until the "
            "first leaves have come out of the dark soil and then the old man called Tom sells 5 boxes")
    docs = [(1, text), (2, text.replace("called Tom", "called Sam")), (3, text.replace("sells 5", "sells 7")),
            (4, text.replace("named Tom", "named Eva").replace("called Tom", "called Eva")),
            (5, "In spring a farmer named Tom plants 5 rows of beans and then nothing else of it is here")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame([(1, text)], "item_id long, text string")
    got = {r.doc_id: r.exact for r in decontaminate.find(d, b).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False}


def test_decontamination_brute_force(spark):
    """Every document that holds an item literally is found, and no other."""
    docs, items = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "benchmark"))
    con = duckdb.connect()
    want = con.execute(f"""SELECT doc_id, item_id FROM '{MEDIUM}/documents.parquet' d, '{MEDIUM}/benchmark.parquet' b
                           WHERE contains(d.text, b.text)""").fetchall()
    got = {(r.doc_id, r.item_id) for r in decontaminate.find(docs, items).collect()}
    assert want and got == set(want)


def brute_template(text):
    """Template tokens and values, word by word."""
    out, number, opens = [], False, True
    for raw in re.split(r"([ \t\n\v\f\r]+)", text):
        core = re.sub(r"^[^0-9A-Za-z\u0080-\U0010ffff]+|[^0-9A-Za-z\u0080-\U0010ffff]+$", "", raw)
        if not core:
            opens |= any(c in ".?!:\n" for c in raw)
            continue
        lead, tail = raw[:raw.index(core)], raw[raw.index(core) + len(core):]
        opens |= any(c in ".?!:\n" for c in lead)
        low = "".join(c.lower() if c.isascii() else c for c in core)
        if core[0].isdigit():
            kind = "<num>"
        elif number and low in decontaminate.UNITS:
            kind = "<unit>"
        elif (core[0].isascii() and core[0].isupper() or "À" <= core[0] <= "Þ") and not opens \
                and not (core[1:2].isascii() and core[1:2].isupper()):
            kind = "<name>"
        else:
            kind = low
        out.append((kind, low))
        number, opens = core[0].isdigit(), any(c in ".?!:\n" for c in tail)
    return out


def test_template_brute_force():
    import numpy as np
    texts = ["Tom has 5 kg, and Ann 3.5 km. The Road (to Élan) is 10kg long!\nNow \"Eva\" -- 7 hours: Yes", "", "x 5 m Y",
             "km 5", "1,000 dollars? No Name here", "we saw NASA, ÉTAT and I go TO Élan A"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    token, value, t = decontaminate.template(data, offsets)
    names = {1: "<num>", 2: "<unit>", 3: "<name>"}
    for i, text in enumerate(texts):
        want = brute_template(text)
        own = slice(t.first[i], t.first[i + 1])
        assert [names.get(int(k)) for k in token[own]] == [k if k[0] == "<" else None for k, _ in want]
        got = [data[a:b].tobytes().decode() for a, b in zip(t.starts[own], t.ends[own])]
        assert ["".join(c.lower() if c.isascii() else c for c in w) for w in got] == [v for _, v in want]


def log_documents():
    rng = random.Random(4)
    names = [f"name{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(9))
    docs = []
    for i in range(60):
        own = [" ".join(word() for _ in range(12)) for _ in range(5)]
        own.insert(2, f"Printed on page {i} by user {names[i]} at the main desk")
        if i % 2:
            own.insert(0, "All rights reserved by the owner of this site")
        docs.append((i, "\n".join(own)))
    family = [" ".join(word() for _ in range(12)) for _ in range(6)]
    for i in range(40):  # copies with one word changed: not a recurrence
        text = [line.split() for line in family]
        text[rng.randrange(6)][rng.randrange(4, 12)] = word()
        docs.append((100 + i, "\n".join(map(" ".join, text))))
    docs += [(200 + i, docs[0][1].replace("Printed", "printed")) for i in range(30)]
    docs += [(300, None), (301, ""), (302, "All rights reserved by the owner of this site\n\n"), (302, "As is.")]
    return docs


def test_line_templates(spark, nothing):
    docs = log_documents()
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, kept string").repartition(5)
    out = line_dedup.drop_recurring(df).collect()
    assert len(out) == len(docs)
    for r in out:
        text, k = r.row.text, r.row.doc_id
        lines = (text or "").split("\n")
        stay = [x for x in lines if not x.startswith(("Printed on page", "All rights reserved"))]
        assert r.kept == (None if text is None else "\n".join(stay)), k
        assert (r.n_lines, r.n_dropped) == (len(lines) if text else 0, len(lines) - len(stay))
        assert r.left == (k != 302 or text == "As is.")
        assert r.row.kept == "x"
    assert line_dedup.drop_recurring(nothing).count() == 0


def test_line_dedup_on_odd_rows(odd):
    out = line_dedup.drop_recurring(odd).collect()
    assert sorted(str(r.row.text) for r in out) == sorted(str(r[1]) for r in ODD)
    assert all(r.kept == r.row.text and r.left for r in out)


def long_words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(n))


def dropped_lines(spark, docs, **options):
    """(id, kept text) of every document that loses a line."""
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    return {r.row.doc_id: r.kept for r in line_dedup.drop_recurring(df, **options).where("n_dropped > 0").collect()}


def test_line_recurs_however_many_documents_have_it(spark):
    """Documents of a small vocabulary: words that stand for them are soon all taken."""
    rng = random.Random(11)
    vocabulary = [long_words(rng, 1) for _ in range(60)]
    own = lambda: "\n".join(" ".join(rng.choice(vocabulary) for _ in range(12)) for _ in range(5))
    docs = [(i, f"{own()}\nAll rights reserved by the owner of this site") for i in range(900)]
    got = dropped_lines(spark, docs)
    assert got == {k: t[:t.rindex("\n")] for k, t in docs}


def test_near_copies_do_not_outvote_unrelated_documents(spark):
    rng = random.Random(12)
    notice = "\nLicensed to the reader under the terms of this site"
    docs = [(i, "\n".join(long_words(rng, 12) for _ in range(5)) + notice) for i in range(30)]
    base = [long_words(rng, 12) for _ in range(6)]
    for i in range(200):
        text = [line.split() for line in base]
        text[rng.randrange(6)][rng.randrange(4, 12)] = long_words(rng, 1)
        docs.append((100 + i, "\n".join(map(" ".join, text)) + notice))
    got = dropped_lines(spark, docs)
    assert got == {k: t[:-len(notice)] for k, t in docs}


def test_fields_whose_values_recur(spark):
    """Twenty values of either field, each in twenty documents, each pair in one."""
    rng = random.Random(13)
    a, b = ([long_words(rng, 1) for _ in range(20)] for _ in range(2))
    lines = [f"Posted in section {x} by author {y} on the main board" for x in a for y in b]
    docs = [(i, "\n".join(long_words(rng, 12) for _ in range(5)) + "\n" + line) for i, line in enumerate(lines)]
    alone = (1000, long_words(rng, 12) + "\nPosted in section one of an old book that nobody here")
    got = dropped_lines(spark, [*docs, alone])
    assert got == {k: t[:t.rindex("\n")] for k, t in docs}
