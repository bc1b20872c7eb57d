"""Top-k, URL filters, chat formatting, the pipeline and the queries' SQL against brute force."""

import math
import random
import re

import duckdb
import numpy as np
import pytest

from tidebar.llm import chat, oracles, topk, urls
from tidebar.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"

# top-k -------------------------------------------------------------------------------------------------------------


def brute_top(rows, k=topk.K):
    fine = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(fine):
        if i % 20 == 0:
            found = sorted((-sum(a * b for a, b in zip(q, c)), j) for m, (j, c) in enumerate(fine) if m != n)
            out += [(i, r + 1, j, max(-(2**63), min(2**63 - 1, -s))) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


def vectors(n=130, seed=1):
    rng = random.Random(seed)
    rows = [(i, [round(rng.gauss(0, 0.3), 2) for _ in range(6)]) for i in rng.sample(range(500), n)]
    rows += [(20, None), (40, [1.0, None]), (60, [math.nan]), (80, [math.inf, 1.0]), (None, [1.0]), (500, []), (520, [1.0, 2.0]), (540, [3e6] * 3), (541, [3e6] * 3)]
    same = [(1000 + i, [0.5] * 6) for i in range(30)]  # ties, also with queries
    return rows + same + [(1000, [0.5] * 6), rows[0]]


@pytest.mark.parametrize("shard", [8192, 40])
def test_top_k_equals_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "BLOCK", shard)
    monkeypatch.setattr(topk, "FAN_IN", 2)
    rows = vectors()
    v = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = sorted(tuple(r) for r in topk.top_k(v, v.where("id % 20 = 0")).collect())
    assert got == brute_top(rows)


def test_top_k_of_few_and_none(spark):
    none = topk.quantised(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert topk.top_k(none, none).count() == 0
    one = topk.quantised(spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>"))
    assert topk.top_k(one, one).count() == 0


def test_products_beyond_doubles_are_exact():
    a, b = np.array([[2.0**40, 3.0]]), np.array([[2.0**20, 1.0], [2.0**40, 1.0]])
    assert topk._products(a, b).tolist() == [[2**60 + 3, 2**63 - 1]]


# URL filters -----------------------------------------------------------------------------------------------------------


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url)
    host, path = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]
    fits = [(h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=lambda f: len(f[0])) if fits else None


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.ORG/es/1", "https://example.org/en/12?x=1", "https://example.org/en/2", "https://other.org", "https://other.org/", "http://x.com/fr/a#b", "http://x.com/de/a", "http://x.com/DE/a",
    "http://notexample.org/es/", "http://org/x", "http://com?x=/fr/", "ftp://a.net/x://y/z", "http://Éa.com/fr/é", "http://x.com/" + "a" * 5000,
]


def test_rules_equal_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "<p>x", "own") for i, u in enumerate(URLS * 2)], "page_id long, url string, html string, salt string")
    for r in urls.judge(pages).collect():
        host, path, best = brute_rule((URLS * 2)[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[0])
        assert r["verdict"] == best[1] if best else r["verdict"] in ("allow", "block")
    assert urls.judge(pages.limit(0)).count() == 0


def test_trust_and_distrust_run_along_links(spark):
    link = lambda *hosts: "".join(f"<a class='x' href=\"http://{h}/p\">x</a>" for h in hosts)
    rows = [
        (1, "http://good.org/a", link("friend.net")), (2, "http://friend.net/a", link("good.org", "further.net")), (3, "http://further.net/a", None),
        (4, "http://bad.com/de/a", link("bad.com")), (5, "http://feeder.net/a", link("bad.com") * 3), (6, "http://both.net/a", link("bad.com", "good.org", "friend.net")), (7, "http://lone.net/a", ""),
    ]
    out = {r["page_id"]: r["verdict"] for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    # 6 gives a third of its links to the blocked host, 5 all: of 4 links to bad.com, 3 are from 5, so that 6 gets 0.85 * 0.25 of its distrust
    assert out == {1: "allow", 2: "allow", 3: "allow", 4: "block", 5: "block", 6: "allow", 7: "allow"}


def brute_verdicts(pages):
    """Verdicts of (page_id, url, html) by power iteration over all hosts in Python."""
    judged = [brute_rule(u) for _, u, _ in pages]
    hosts = {}
    for h, _, best in judged:
        if h:
            hosts.setdefault(h, []).append(best and best[1])
    links = {}
    for (_, _, html), (h, _, _) in zip(pages, judged):
        for target in re.findall(r"""(?i)<a\s[^>]*?href\s*=\s*["']?((?:https?:)?//[^"'\s>]+)""", html or ""):
            t = re.sub("[A-Z]", lambda c: c[0].lower(), re.match(r"(?:https?:)?//([^/?#]*)", target)[1])
            if h and t and h != t:
                links[h, t] = links.get((h, t), 0) + 1
    scores = {}
    for kind, edges in (("allow", links), ("block", {(b, a): n for (a, b), n in links.items()})):
        seed = {h: v.count(kind) / len(v) * (1 - urls.DAMPING) for h, v in hosts.items()}
        out, score = {}, dict(seed)
        for (a, _), n in edges.items():
            out[a] = out.get(a, 0) + n
        for _ in range(300):
            new = dict(seed)
            for (a, b), n in edges.items():
                new[b] = new.get(b, 0) + urls.DAMPING * score.get(a, 0) * n / out[a]
            score = new
        scores[kind] = score
    bad = {h: scores["block"].get(h, 0) > max(urls.BLOCK_RATIO * scores["allow"].get(h, 0), urls.BLOCK_LEAST * (1 - urls.DAMPING)) for h in hosts}
    return {p: best[1] if best else "block" if bad.get(h) else "allow" for (p, _, _), (h, _, best) in zip(pages, judged)}, scores


def test_verdicts_of_a_random_host_graph_equal_brute_force(spark, monkeypatch):
    from tidebar.llm import common

    monkeypatch.setattr(common, "HOT_SHARE", 5)  # hosts with a fifth of the edges are dealt out
    rng = random.Random(1)
    hosts = [f"{'a' if i % 3 else 'b'}{i}.{rng.choice(('net', 'net', 'com', 'org'))}" for i in range(30)]
    pages = []
    for i in range(120):
        to = [rng.choice(hosts[:3] if rng.random() < 0.4 else hosts) for _ in range(rng.randint(0, 4))]
        html = "".join(f'<A x=1 HREF={q}{rng.choice(("http:", "https:", ""))}//{t.upper()}/p{q}>x</a>' for t in to for q in (rng.choice(('"', "'")),))
        pages.append((i, f"http://{rng.choice(hosts)}{rng.choice(('/de/x', '/fr/x', '/x'))}", html if rng.random() < 0.95 else None))
    want, scores = brute_verdicts(pages)
    out = {r["page_id"]: r["verdict"] for r in urls.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert out == want and len(set(want.values())) == 2 and len({h for k in scores for h, s in scores[k].items() if s > 0}) > 10


def test_scores_equal_power_iteration(spark):
    edges = [("a", "b", 2), ("a", "c", 1), ("b", "c", 1), ("c", "a", 1), ("d", "a", 1)]
    seeds = {"a": 1.0, "d": 0.5}
    got = urls.spread(
        spark.createDataFrame([("allow", *e) for e in edges], "kind string, src string, dst string, n long"),
        spark.createDataFrame([("allow", h, s) for h, s in seeds.items()], "kind string, host string, seed double"),
    )
    score = {h: s * (1 - urls.DAMPING) for h, s in seeds.items()}
    out = {s: sum(n for x, _, n in edges if x == s) for s, _, _ in edges}
    for _ in range(urls.MOST_ROUNDS):
        new = {h: s * (1 - urls.DAMPING) for h, s in seeds.items()}
        for s, d, n in edges:
            new[d] = new.get(d, 0) + urls.DAMPING * score.get(s, 0) * n / out[s]
        score = new
    for r in got.collect():
        assert r["score"] == pytest.approx(score[r["host"]], abs=2 * urls.SETTLED)


def test_distrust_runs_on_whatever_other_hosts_there_are(spark):
    pages = [("http://bad.com/de/a", "")] + [(f"http://h{n}.net/a", f'<a href="{"http:" * (n % 2)}//{"bad.com" if n == 1 else f"h{n - 1}.net"}/p">x</a>') for n in range(1, 5)]
    pages += [(f"http://seed{n}.com/de/a", "") for n in range(200)]  # blocked, too, and without links
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    assert {r["host"]: r["verdict"] for r in urls.host_verdicts(rows).collect()} == dict.fromkeys((u.split("/")[2] for u, _ in pages), "block")


def test_small_moves_that_meet_at_one_host_count(spark):
    # what each page host hands on is far below the threshold, what meets at the hub is above it
    edges = [("block", "start", f"p{n}", 1) for n in range(300)] + [("block", f"p{n}", "hub", 1) for n in range(300)]
    got = urls.spread(
        spark.createDataFrame(edges, "kind string, src string, dst string, n long"),
        spark.createDataFrame([("block", "start", 1.0)] + [("block", f"s{n}", 1.0) for n in range(200)], "kind string, host string, seed double"),
    )
    assert {r["host"]: r["score"] for r in got.collect()}["hub"] == pytest.approx(0.15 * 0.85**2)


# chat formatting ---------------------------------------------------------------------------------------------------------

TALK = [
    (1, 0, "user", "How do I  start?\nSecond line"),
    (1, 1, "assistant", "> how do i start?\n> second line\n\nPress the button."),
    (1, 2, "user", "Something else"),
    (1, 3, "user", ">> How do I start?\n> Press the button.\nWhich one?"),
    (1, 4, "assistant", "> Something else\nYes."),
    (1, 5, "user", "> never said\nWell"),
    (1, 6, "user", "> Which one?\nThe red"),
    (2, 0, "user", None),
    (2, 1, None, "> Something else\nOther talk"),
    (2, 1, None, "> Something else\nOther talk"),
    (None, 3, "user", "> a\nb"),
    (3, None, "user", "x > y is no quote"),
]


def test_quotations_are_linked_and_left_out(spark):
    rows = spark.createDataFrame([(*r, "own") for r in TALK], "conv_id long, turn long, role string, text string, parent_turn string")
    out = chat.formatted(rows)
    found = {(r["conv_id"], r["turn"]): r for r in out.collect()}
    assert out.count() == len(TALK)
    assert {t: found[1, t]["parent_turn"] for t in range(7)} == {0: None, 1: 0, 2: None, 3: 1, 4: 2, 5: None, 6: 3}
    assert {t: found[1, t]["thread_turn"] for t in range(7)} == {0: 0, 1: 0, 2: 2, 3: 0, 4: 2, 5: 5, 6: 0}
    assert found[1, 1]["text"] == "Press the button." and found[1, 0]["text"] == TALK[0][3]
    assert found[2, 0]["text"] == "" and found[2, 1]["parent_turn"] is None and found[2, 1]["chat"].startswith("<|unknown|>\nOther talk")
    assert found[None, 3]["text"] == "b" and found[3, None]["text"] == "x > y is no quote"
    assert chat.formatted(rows.limit(0)).count() == 0


def test_lines_quoted_from_a_longer_paragraph(spark):
    talk = [(1, 0, "user", "a one\nb two\nc three\nd four\ne five"), (1, 1, "user", "b two\nother"), (1, 2, "user", "> b two\n> c three\nwhy?"), (1, 3, "user", ">c three\n>b two\nno")]
    out = {r["turn"]: r["parent_turn"] for r in chat.formatted(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")).collect()}
    assert out == {0: None, 1: None, 2: 0, 3: None}


def test_only_line_ends_of_the_format_begin_a_quotation(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a\u2028> b"), (1, 1, "user", "a\r> b"), (1, 2, "user", "a\r\n > b")], "conv_id long, turn long, role string, text string")
    assert [r["text"] for r in sorted(chat.formatted(rows).collect(), key=lambda r: r["turn"])] == ["a\u2028> b", "a", "a"]


@pytest.mark.parametrize("seed", range(3))
def test_places_of_random_reply_trees_equal_a_walk(spark, seed):
    rng = random.Random(seed)
    rows, parent = [], {}
    for conv in range(4):
        shape = rng.choice((1, 3, 30))  # a chain, a comb, a bush
        for turn in range(25):
            said = rng.randrange(max(0, turn - shape), turn) if turn and rng.random() < 0.8 else None
            parent[conv, turn] = said
            rows.append((conv, turn, "user", (f"> words of {said}\n" if said is not None else "") + f"words of {turn}"))
    got = {(r["conv_id"], r["turn"]): r for r in chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    for conv in range(4):
        def walk(turn):
            return [turn, *(x for child in range(25) if parent[conv, child] == turn for x in walk(child))]

        for root in (t for t in range(25) if parent[conv, t] is None):
            order = walk(root)
            assert [got[conv, t]["place"] for t in order] == list(range(len(order)))
            assert {got[conv, t]["conversation"] for t in order} == {f"{conv}:{root}"} and {got[conv, t]["thread_turn"] for t in order} == {root}
            assert all(got[conv, t]["text"] == f"words of {t}" and got[conv, t]["parent_turn"] == parent[conv, t] for t in order)


def brute_passages(text):
    out = []
    for line in (text or "").replace("\r\n", "\n").replace("\r", "\n").split("\n"):
        m = re.match(chat.MARKS, line)
        level, rest = (m[0].count(">"), line[m.end() :]) if m else (0, line)
        if out and out[-1][0] == level:
            out[-1][1] += "\n" + rest
        else:
            out.append([level, rest])
    return [tuple(x) for x in out]


def test_passages_equal_brute_force(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["> ", ">", "a", " b", "\n", "\n"]) for _ in range(rng.randint(0, 40))) for _ in range(60)] + ["", ">", "> \n>> x\r\n> y", "a\n" * 3000 + "> q\n" * 3000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for r in df.select("i", chat.passages(df["text"]).alias("p")).collect():
        assert [(x["level"], x["text"]) for x in r["p"]] == brute_passages(texts[r["i"]])


@pytest.mark.parametrize("name", ["op2_secret_scans", "op5_url_filters", "op10_chat_formatting"])
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# queries and pipeline ---------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.execute(oracles.SQL[name])
    columns = sorted(c[0] for c in want.description)
    df = QUERIES[name](spark, SMALL)
    assert sorted(df.columns) == columns
    order = [[c[0] for c in want.description].index(c) for c in columns]
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(str(tuple(r[i] for i in order)) for r in want.fetchall())


def test_pipeline_equals_its_stages(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for _, stage in p.STAGES[:-1]:
        before = docs
        docs = spark.createDataFrame(stage(spark, docs, SMALL).toPandas(), before.schema)
        assert docs.columns == columns
    want = {tuple(r) for r in p.STAGES[-1][1](spark, docs, SMALL).collect()}
    got = p.run(spark, SMALL).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) == docs.count() > 0


CLASHING = ("_own", "_kept", "_fp", "_hash", "_salt", "_hot", "_secret_spans", "_secret_id", "_contamination", "_made", "spans", "found", "fp", "n", "score")


def test_pipeline_stages_take_any_rows(spark):
    import corpus_pipeline as p

    good = spark.read.parquet(f"{SMALL}/documents.parquet").where("n_chars > 200").orderBy("doc_id").limit(4).collect()
    secret = " password=abcdefgh" + " AKIA" + "Q" * 16
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in good]
    rows += [rows[0], (rows[1][0], rows[0][1], "en", "other", None), (10**6, rows[2][1] + secret, None, None, None), (10**6 + 1, None, None, None, None), (10**6 + 2, "", "en", "s", 0)]
    rows += [(None, rows[3][1], "en", "s", 5), (None, None, None, None, None), (10**6 + 3, rows[3][1] + " and so on and on" * 20_000, "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    docs = spark.createDataFrame([(*r, *(f"{c} {i}" for c in CLASHING)) for i, r in enumerate(rows)], schema)
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        given = {r["spans"]: r for r in docs.collect()}
        for r in out.collect():  # each row is one of the given ones, with its own columns
            was = given[r["spans"]]
            assert all(r[c] == was[c] for c in docs.columns if c not in ("text", "n_chars")), name
            assert r["text"] == was["text"] or name == "secret scans" and "[secret]" in r["text"]
    near = [r for r in p.drop_near_duplicates(spark, docs, SMALL).collect()]
    assert sum(r["doc_id"] is None for r in near) == 2  # rows without an id stay
    assert sum(r["text"] == rows[0][1] for r in near) == 1 and sum(not r["text"] for r in near if r["doc_id"] is not None) == 1
    masked = {r["doc_id"]: r["text"] for r in p.mask_secrets(spark, docs, SMALL).collect()}
    assert masked[10**6] == rows[2][1] + " [secret] [secret]" and masked[10**6 + 1] is None
    assert p.encode(spark, docs, SMALL).count() == len(rows)
    for _, stage in p.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0
