"""Vector codes, the conversation trie and language identification against brute force."""

import hashlib
import math
import pathlib
import pickle
import random
import re
import subprocess
import sys
import time
import zlib

import duckdb
import numpy as np
import pytest

from tidebar.llm import chat, conversation_trie, decontaminate, html_text, language, oracles, pii, quality, urls, vector_codes
from tidebar.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"

# vector codes --------------------------------------------------------------------------------------------------------


def brute_codes(rows, entries=256, rounds=4):
    kept = [(i, y, [math.floor(1024 * float(x)) for x in v]) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    size = -(-max(len(q) for _, _, q in kept) // 4)
    parts = [[tuple((q + [0] * (4 * size - len(q)))[p * size : (p + 1) * size]) for _, _, q in kept] for p in range(4)]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][2]))[:entries]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    code, error, digest = [""] * len(kept), [0] * len(kept), []
    for values in parts:
        book = [values[k] for k in first]
        for n in range(rounds + 1):
            best = [min((far(v, e), k) for k, e in enumerate(book)) for v in values]
            if n < rounds:
                groups = {}
                for v, (_, k) in zip(values, best):
                    groups.setdefault(k, []).append(v)
                book = [tuple(sum(x) // len(groups[k]) for x in zip(*groups[k])) if k in groups else e for k, e in enumerate(book)]
        digest += [x for e in book for x in e]
        code = [c + f"{k:02x}" for c, (_, k) in zip(code, best)]
        error = [a + d for a, (d, _) in zip(error, best)]
    of_label = {}
    for (_, y, _), e in zip(kept, error):
        of_label[y] = of_label.get(y, 0) + e
    sha = hashlib.sha256(",".join(map(str, digest)).encode()).hexdigest()
    held = lambda x: min(x, 2**63 - 1)
    return sorted(((i, c, e, held(of_label[y]), sha) for (i, y, _), c, e in zip(kept, code, error)), key=str)


def codes_of(spark, rows, width="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{width}>, label int, code string, id int")
    return sorted(map(tuple, vector_codes.compressed(df).collect()), key=str)


def some_vectors(n, seed=2):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 0.3) for _ in range(8)] for _ in range(5)]
    rows = [(i, [round(m + rng.gauss(0, 0.01), 3) for m in rng.choice(middles)], rng.choice([0, 1, None]), "own", 1) for i in range(n)]
    odd = [(5, None, 0), (6, [1.0, None], 0), (7, [math.nan] * 8, 0), (8, [math.inf], 1), (None, [0.1] * 8, 7), (9, [], None), (10, [0.5, -0.25, 0.125], None), (11, [0.1] * 8, 1), (11, [0.1] * 8, 1)]
    return rows + [(*r, "own", 1) for r in odd]


@pytest.mark.parametrize("entries", [256, 16, 3])
def test_codes_equal_brute_force(spark, monkeypatch, entries):
    monkeypatch.setattr(vector_codes, "BLOCK", 8)
    rows = some_vectors(150)
    book = lambda v: vector_codes.codebooks(v, entries=entries)
    vectors = vector_codes.quantised(spark.createDataFrame([r[:3] for r in rows], "vec_id long, embedding array<double>, label int"))
    found = book(vectors)
    got = sorted((r["id"], r["code"], r["error"], found.digest()) for r in vector_codes.codes(vectors, found).collect() if r["id"] is not None)
    assert got == sorted((i, c, e, sha) for i, c, e, _, sha in brute_codes([r[:3] for r in rows], entries) if i is not None)


def test_compressed_equals_brute_force_with_any_rows(spark):
    rows = some_vectors(60)
    assert codes_of(spark, rows, "double") == brute_codes([r[:3] for r in rows])
    assert codes_of(spark, []) == [] and codes_of(spark, [(1, None, 0, "", 0)]) == []
    huge = [(1, [1e6, 2e6], 0, "", 0), (2, [-3e6, 1.0], 0, "", 0), (3, [1e15, 0.0], 1, "", 0)] * 2
    got = codes_of(spark, huge, "double")
    assert len(got) == 6 and all(0 <= r[2] <= r[3] <= 2**63 - 1 for r in got)


def test_shortlists_keep_the_nearest_and_leave_others_out():
    rng = np.random.default_rng(0)
    book = rng.integers(-1000, 1000, (64, 3))
    short = 0
    for _ in range(50):
        values = rng.integers(-900, 900, 3) + rng.integers(-40, 40, (20, 3))
        chosen = vector_codes.shortlists(values.min(axis=0)[None], values.max(axis=0)[None], book)[0]
        exact = ((values[:, None] - book[None]) ** 2).sum(axis=2)
        assert chosen[exact.argmin(axis=1)].all()
        index, error = vector_codes.nearest(values, book, np.flatnonzero(chosen))
        assert (index == exact.argmin(axis=1)).all() and (error == exact.min(axis=1)).all()
        short += chosen.sum()
    assert short < 50 * 12


def test_places_go_along_a_hilbert_curve():
    """Of a whole grid every two places in a row are neighbours."""
    curve = vector_codes.Curve(np.zeros((1, 2)))
    curve.bits, curve.edges = 3, np.repeat(np.arange(1, 8)[:, None], 2, axis=1)
    grid = np.array([(x, y) for x in range(8) for y in range(8)])
    along = grid[np.argsort(curve.places(grid))]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


# conversation trie -----------------------------------------------------------------------------------------------------


def brute_trie(rows):
    found = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            found.setdefault(c, []).append(((turn is not None, turn or 0), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), (role, text)))
    found = {c: [m[2] for m in sorted(v, key=lambda m: m[:2])] for c, v in found.items()}
    whole = {}
    for c, own in found.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = found.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])[:h] + own[h:]
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids, leaves, saved = ({k: 0 for k in members} for _ in range(3))
    for k in members:
        if k:
            kids[k[:-1]] += 1
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
            leaves[k[:d]] += not kids[k]
    ends = {k: hashlib.sha256(",".join(map(str, sorted(c for c in m if len(whole[c]) == len(k)))).encode()).hexdigest() for k, m in members.items()}
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], ends[k]) for k, m in members.items()), key=str)


def some_conversations(seed=3):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", None, "bot"]), rng.choice(["a", "bb", "é", None, "a"])) for c in range(-7, 50) for t in range(rng.choice([0, 1, 2, 5, 12, 20]))]
    rows += [(c, t, "u", f"same{t}") for c in range(100, 140, 5) for t in range(25)]  # copies
    rows += [(200, t, "u", f"same{t % 7}") for t in range(40)]  # a long one
    return rows + [(None, 1, "u", "x"), (61, None, "u", "x"), (61, None, "u", "x"), (61, 3, "u", "x" * 5000), (61, 3, "", "y")]


def trie_of(spark, rows):
    return sorted(map(tuple, conversation_trie.trie(spark.createDataFrame([(*r, 1, "own") for r in rows], "conv_id long, turn long, role string, text string, depth int, prefix string")).collect()), key=str)


@pytest.mark.parametrize("sizes", [{}, {"SEGMENT": 4, "SLICE": 4}, {"BATCH": 3, "GROUP_TURNS": 40, "BUCKET_TURNS": 30}])
def test_trie_equals_brute_force(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(conversation_trie, name, value)
    rows = some_conversations()
    assert trie_of(spark, rows) == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert trie_of(spark, []) == [] and trie_of(spark, [(None, 0, "u", "x")]) == []


def test_fat_binary_search_finds_where_strings_leave():
    rng = random.Random(7)
    strings = [[rng.choice("ab") * 1 for _ in range(rng.randint(0, 40))] for _ in range(200)] + [list("a" * n) for n in range(0, 60, 7)]
    trie, kept = conversation_trie.Trie(), []
    hashed = lambda s: conversation_trie.prefixes("", [x.encode() for x in s])
    for s in strings:
        p = hashed(s)
        most = max((next((i for i, (x, y) in enumerate(zip(p, q)) if x != y), min(len(p), len(q))) - 1 for q in kept), default=0)
        assert trie.exit_of(p)[2] == most
        trie.insert("", p, [1] * len(s))
        kept.append(p)
    assert len(trie.handles) < 2 * len(strings) + 1
    for (f, _), node in trie.handles.items():
        assert node.start < f <= node.end and f == max(range(node.start + 1, node.end + 1), key=lambda n: n & -n)


# language ---------------------------------------------------------------------------------------------------------------


def network(states=4, seed=0):
    out = language.Network.fresh(["a", "b", "c"], states, seed)
    for name in ("bytes", "gates", "candidate", "out", "bias"):
        setattr(out, name, getattr(out, name).astype(np.float64))
    return out


def test_slopes_equal_differences():
    rng = np.random.default_rng(0)
    net, windows = network(), rng.integers(97, 105, (5, 7)).astype(np.uint8)
    lengths, wanted = np.array([7, 3, 7, 1, 5]), np.array([0, 1, 2, 1, 0])
    found = net.slopes(windows, lengths, wanted)[1]
    for weight, slope in zip(net.weights(), found):
        for at in np.argsort(-np.abs(slope), axis=None)[:6]:
            at = np.unravel_index(at, weight.shape)
            ends = []
            for step in (1e-5, -1e-5):
                weight[at] += step
                ends.append(net.slopes(windows, lengths, wanted)[0])
                weight[at] -= step
            assert abs((ends[0] - ends[1]) / 2e-5 - slope[at]) < 1e-6


def brute_probabilities(net, data):
    """Position by position, state by state."""
    h, size = net.candidate.shape[1], len(data)
    after = np.zeros((2, size, h))
    for way in (0, 1):
        state = np.zeros(h)
        for t in range(size) if way == 0 else range(size - 1, -1, -1):
            of_byte = net.bytes[way][:, data[t]]
            gates = np.clip(0.5 + language.SLOPE * (of_byte[: 2 * h] + net.gates[way] @ state), 0, 1)
            new = np.tanh(of_byte[2 * h :] + net.candidate[way] @ (gates[h:] * state))
            state = gates[:h] * state + (1 - gates[:h]) * new
            after[way, t] = state
    raw = after[0] @ net.out[0].T + after[1] @ net.out[1].T + net.bias[:, 0]
    e = np.exp(raw - raw.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def test_pooled_probabilities_equal_brute_force(monkeypatch):
    monkeypatch.setattr(language, "WINDOW", 16)
    monkeypatch.setattr(language, "ABREAST", 3)
    net, texts = network(), ["a", "hello world, this is longer than a window", None, "", "123 !?", "é" * 20, "x" * 16]
    for text, (lang, score) in zip(texts, language.pooled(net, texts)):
        if text is None or not any(map(str.isalpha, text)):
            assert (lang, score) == ("und", 0.0)
            continue
        data = text.encode()
        total = sum(brute_probabilities(net, data[at : at + 16].ljust(16, b"\0"))[: len(data) - at].sum(axis=0) for at in range(0, len(data), 16))
        assert lang == net.names[total.argmax()] and abs(score - total.max() / len(data)) < 1e-5


def test_languages_of_held_out_texts(spark):
    rng = random.Random(1)
    make = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n)) + "."
    kinds = {"xx": "aeioulmn", "yy": "bcdfkrtzäö", "zz": "aeiprstvw"}
    rows = [(i, make(kinds[k], rng.choice([4, 30, 200])), k, "own", 1.0) for i, k in enumerate(list(kinds) * 60)]
    odd = [(1000, None, "xx"), (1001, "", "xx"), (1002, "12 + 3 = ?", "yy"), (1003, make(kinds["yy"], 9), None), (None, make(kinds["zz"], 40), "zz"), (1004, make(kinds["xx"], 60_000), "xx")]
    docs = spark.createDataFrame(rows + [(*r, "own", 1.0) for r in odd] + rows[:1], "doc_id long, text string, lang string, lang_pred string, score double")
    out = [r.asDict() for r in language.identified(docs).collect()]
    assert len(out) == len(rows) + len(odd) + 1
    by = {r["doc_id"]: r for r in out}
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and by[1003]["lang_pred"] == "yy" and by[1004]["lang_pred"] == "xx" and by[None]["lang_pred"] == "zz"
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert all(by[r[0]]["held_out"] for r in held) and not by[None]["held_out"] and all(0 <= r["score"] <= 1 for r in out)
    assert sum(by[r[0]]["lang_pred"] == r[2] for r in held) >= 0.95 * len(held)
    assert language.identified(docs.limit(0)).count() == 0
    assert {r["lang_pred"] for r in language.identified(docs.withColumn("lang", docs["lang"].substr(10, 1)).where("doc_id = 0")).collect()} <= {"und", ""}


# queries ----------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("key", ["op11_vector_codes", "op12_conversation_trie"])
def test_new_queries_equal_their_sql(spark, key):
    con = duckdb.connect()
    for t in ("embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.execute(oracles.SQL[key])
    names = [c[0] for c in want.description]
    got = QUERIES[key](spark, SMALL)
    assert set(got.columns) == set(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_language_of_the_given_texts(spark):
    out = QUERIES["op13_language_id"](spark, SMALL).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").toPandas()
    right = [out.loc[r.doc_id, "lang_pred"] == r.lang for r in docs.itertuples() if r.lang is not None]
    assert sum(right) >= 0.97 * len(right)


# what earlier operators take in ------------------------------------------------------------------------------------------


def test_no_text_of_a_page_is_lost():
    blocks = lambda page: [b.text for b in html_text.leaf_blocks(page)]
    assert blocks("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be the value that we want.</p><xmp>code &amp; <b>here</b></xmp><p>more") == ["Let x=1 be the value that we want.", "code &amp; <b>here</b>", "more"]
    assert blocks("<!--><p>middle</p><!-- x --><p>b</p><!---><p>c</p><!-- a --!><p>d</p><!-- open <p>e") == ["middle", "b", "c", "d"]
    assert blocks("<p>a <svg><title>t</title><style>x{}</style><text>label</text></svg> b <script>x()</script> c</p>") == ["a label b c"]
    assert blocks("<p>x<plaintext>rest <b>of") == ["x", "rest <b>of"]
    assert blocks("<svg><![CDATA[a<b]]></svg>") == ["a<b"]


class Shared:
    """Stands for a broadcast block."""

    def __init__(self, items):
        self.value = pickle.dumps(decontaminate.Block([(i, 0, decontaminate.words_of(t), False) for i, t in items]))


def brute_matches(text, items):
    words, hit, out = decontaminate.words_of(text), set(), {}
    for item, t in items:
        own = decontaminate.words_of(t)
        n, best = min(13, len(own)), None
        for a in range(len(words) - n + 1 if n else 0):
            for b in range(len(own) - n + 1):
                if words[a : a + n] == own[b : b + n]:
                    hit.update(range(a, a + n))
                    m = n
                    while n == 13 and words[a + m : a + m + 1] == own[b + m : b + m + 1] != []:
                        m += 1
                    best = min(best or (0, 0, 0), (-m, a, b))
        if best and item is not None and (item not in out or -best[0] > out[item][0]):
            out[item] = [-best[0], *best[1:]]
    return len(hit), out


def test_matches_of_repetitive_texts_equal_brute_force(monkeypatch):
    rng = random.Random(1)
    for trial in range(40):
        make = lambda n: " ".join(rng.choice("ab" if trial % 2 else "abcdefgh") for _ in range(n))  # noqa: B023, E731
        items = [(i, make(rng.choice([0, 1, 3, 12, 13, 14, 30, 60]))) for i in range(6)] + [(None, make(14)), (21, "a " * 40), (22, "a b " * 20)]
        items.append((20, items[4][1]))
        texts = [" ".join(rng.choice([make(rng.randint(0, 20)), rng.choice(items)[1], "a " * rng.randint(0, 50)]) for _ in range(rng.randint(0, 5))) for _ in range(4)]
        monkeypatch.setattr(decontaminate, "PAIRS", rng.choice([1, 50, 10**6]))
        for text, found in zip(texts, decontaminate.found_in(texts, [Shared(items[:5]), Shared(items[5:])])):
            assert (found["n_hit"], {m["item_id"]: [m["words"], m["doc_word"], m["item_word"]] for m in found["items"]}) == brute_matches(text, items)


def test_one_word_a_million_times_takes_little():
    """In a process of its own, whose memory is all for this."""
    code = (
        "import resource, time; from tests.llm.test_new_operators import Shared; from tidebar.llm import decontaminate as d; began = time.time();"
        "r = d.found_in(['0 ' * 1_000_000], [Shared([(1, '0 ' * 200)])])[0];"
        "assert (r['n_hit'], r['items'][0]['words']) == (1_000_000, 200); print(time.time() - began, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024)"
    )
    seconds, mb = map(float, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=pathlib.Path(__file__).parents[2]).stdout.split()[-2:])
    assert seconds < 20 and mb < 500


def test_blocks_go_over_the_documents_in_passes(spark, monkeypatch):
    rng = random.Random(2)
    make = lambda n: " ".join(rng.choice("abcdefgh") for _ in range(n))
    items = [(i, make(20)) for i in range(7)]
    texts = [make(5) + " " + items[i % 7][1] + " " + items[(i * 3) % 7][1] for i in range(12)] + [None, ""]
    docs, bench = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(tuple, decontaminate.digests(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "PASS_BLOCKS", 2)
    few = decontaminate.blocks
    monkeypatch.setattr(decontaminate, "blocks", lambda b: few(b, size=20))
    assert sorted(map(tuple, decontaminate.digests(docs, bench).collect())) == want
    assert {r[0]: r[2] for r in want} == {i: brute_matches(t, items)[0] for i, t in enumerate(texts)}


@pytest.mark.parametrize(
    "html, hosts",
    [
        ('<a href=" http://bad.com/p">x</a>', ["bad.com"]),
        ('<a href="http:&#47;&#47;bad.com/p">x</a><a href="http&colon;&#x2f;&sol;b.com">', ["bad.com", "b.com"]),
        ('<a data-href="http://bad.com/p" href="/own">x</a>', []),
        ('<!-- <a href="http://bad.com/p">x</a> --><a href="http://b.com">', ["b.com"]),
        ('<!--><a href="http://b.com"><!-- <a href="http://c.com">', ["b.com"]),
        ("<script>var x = '<a href=\"http://bad.com\">'</script><A class='x'\nHREF = 'HTTP://B.com/?a=1&amp;b=2'>", ["b.com"]),
        ('<a title="> href=http://bad.com" href=//b.com/x>', ["b.com"]),
        ('<area shape=rect href="https://b.com#x"><abbr href="http://bad.com">', ["b.com"]),
        ('<a href="htt\np://b.com/\n">&#1114112;&#xD800;&unknown;', ["b.com"]),
        ("<a href=http://b.com>" * 3, ["b.com"] * 3),
        (None, []), ("", []), ("<a", []), ("<a ", []), ("<a href=", []), ('<a href="', []), ("<a " + "x" * 300_000 + " href=http://b.com>", ["b.com"]), ("<a x='y' " * 30_000, []),
    ],
)
def test_links_of_a_page(spark, html, hosts):
    pages = spark.createDataFrame([(1, "http://own.net/", html)], "page_id long, url string, html string")
    assert {r["dst"]: r["n"] for r in urls.links(pages).collect()} == {h: hosts.count(h) for h in hosts}


def test_references_of_any_characters(spark):
    texts = ["a&#233;b", "&#x1F600;x", "&#0;&#55296;", "&amp;amp;", "a&b&", "&#47", "&#x2f;&#x2F", None]
    want = ["aéb", "😀x", "&#0;&#55296;", "&amp;", "a&b&", "/", "//", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert [r[1] for r in df.select("i", urls.decoded(df["t"])).orderBy("i").collect()] == want


def test_lines_in_a_row_equal_brute_force(spark):
    rng = random.Random(4)
    line = lambda: " ".join(rng.choice(["a", "B", "c", ""]) for _ in range(rng.randint(0, 4)))
    texts = [(c, t, "\n".join(rng.choice([line(), "> " + line()]) for _ in range(rng.randint(0, 14)))) for c in range(3) for t in range(4)] + [(0, 1, "a\nB\nc\na b"), (0, 1, "a\nB\nc\na b")]
    lengths = [(0, 2), (0, 3), (1, 2), (2, 5), (9, 2)]
    plain = lambda rows: tuple(" ".join(rows).lower().split())
    want = {}
    for c, t, text in texts:
        own = [x for x in text.split("\n") if not re.match(r"[ \t]*>", x)]
        for n in [n for k, n in lengths if k == c]:
            for i in range(len(own) - n + 1):
                if said := plain(own[i : i + n]):
                    want[c, n, said] = min(t, want.get((c, n, said), t))
    messages, asked = spark.createDataFrame(texts, "conv_id long, turn long, text string"), spark.createDataFrame(lengths, "conv_id long, lines int")
    got = {(r["conv_id"], r["lines"], tuple(r["print"])): r["said"] for r in chat.lines_in_a_row(messages, asked).collect()}
    rows = spark.createDataFrame([(*k[:2], " ".join(k[2]), v) for k, v in want.items()], "conv_id long, lines int, said_text string, said long")
    prints = {(r["conv_id"], r["lines"], tuple(r["p"])): r["said"] for r in rows.select("*", chat.print_of(rows["said_text"]).alias("p")).collect()}
    assert got == prints and len(prints) == len(want)


def test_a_long_quotation_is_linked_in_little_time(spark):
    lines = [f"line {i} of many" for i in range(16_000)]
    quote = "\n".join("> " + x for x in lines[4000:12_000])
    rows = [(1, 0, "user", "\n".join(lines)), (1, 1, "user", "something else"), (1, 2, "assistant", quote + "\nI agree.")]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chat.answers(messages.limit(1)).collect()  # what is compiled once
    began = time.time()
    assert [tuple(r) for r in chat.answers(messages).collect()] == [(1, 2, 0)]
    assert time.time() - began < 25


def test_features_of_the_fit_are_made_where_texts_stand(spark, monkeypatch):
    """A text of 50 MB among the labelled ones goes through no sort."""
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows: seen.append(len(rows)))
    docs = spark.range(3).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), IF(id = 1, 10000000, 10)) AS text", "CAST(NULL AS STRING) AS lang", "'s' AS source", "1L AS n_chars")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(3)], "doc_id long, quality int, toxic int")
    quality.train(docs, labels)
    assert seen and seen[0] == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(3))


DATES = ["3/7/1984", "31-12-1999", "1984/07/03", "12 March 2024", "March 3rd, 2024", "3. März 2024", "12 de marzo de 2024", "1er", "5 mai 2021", "1 Jan 2020", "03.07.1984", "3.07.1984", "7-31-1999", "25/12/2020", "12/10/1984"]


def test_dates_and_addresses_of_more_formats():
    there, back = pii.Pseudonyms(b"k"), pii.Pseudonyms(b"k", back=True)
    texts = [f"born {d}, and so on" for d in DATES] + ["at 2001:db8::8a2e:370:7334 now", "2001:0DB8:0000:0000:0000:8A2E:0370:7334", "fe80::1", "jürgen.müller@example.de", "Иван7@пример.рф", "ssn 123 45 6789."]
    for text in texts:
        new = pii.replaced(text, there)[0]
        assert (new == text) == ("1er" in text), text
        assert pii.replaced(new, back)[0] == text, (text, new)
    name = pii.replaced("jürgen.müller@example.de", there)[0].split("@")[0]
    assert name[1] != "u" and not any(a == b == "ü" for a, b in zip(name, "jürgen.müller")) or name != "jürgen.müller"
    assert pii.replaced("at 12:34:56, ratio 1:2:3, a::b::c, v1.2.3", there)[0] == "at 12:34:56, ratio 1:2:3, a::b::c, v1.2.3"


def test_one_date_has_one_pseudonym_in_figures():
    there = pii.Pseudonyms(b"k")
    one = {tuple(int(x) for x in re.findall(r"\d+", pii.replaced(t, there)[0])) for t in ("1984-07-03", "1984/7/3", "1984.07.03")}
    assert len(one) == 1
    y, m, d = one.pop()
    assert pii.replaced("3.7.1984", there)[0] == f"{d}.{m}.{y}" and pii.replaced("7/3/1984", there)[0] == f"{m}/{d}/{y}"


def test_random_dates_come_back():
    rng, there, back = random.Random(6), pii.Pseudonyms(b"x"), pii.Pseudonyms(b"x", back=True)
    for _ in range(400):
        y, m, d = rng.randint(1900, 2099), rng.randint(1, 12), rng.randint(1, 28)
        sep, wide = rng.choice("-/."), rng.choice([1, 2])
        language = rng.choice(list(pii.MONTH_NAMES))
        text = rng.choice([f"{y}{sep}{m:0{wide}d}{sep}{d:0{wide}d}", f"{d:0{wide}d}{sep}{m:0{wide}d}{sep}{y}", f"{d} {pii.MONTH_NAMES[language][m - 1]} {y}"])
        new = pii.replaced(text, there)[0]
        assert pii.replaced(new, back)[0] == text, (text, new)
