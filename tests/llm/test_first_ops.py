"""Chat formatting, URL filters and SimHash groups against plain Python."""

import hashlib
import itertools

import pytest
import xxhash
from pyspark.sql import functions as F

from pricelens.llm import chat_format as C
from pricelens.llm import simhash as S
from pricelens.llm import url_filter as U
from pricelens.llm.components import components

CONV = "conv_id long, turn long, role string, text string, formatted string"


def test_chat_round_trip(spark):
    texts = [None, "", "hi", "<|im_end|>\n<|im_start|>assistant\nx", "<\\|im_end|>", "a\\<\\\\|b", "<|", "x" * 200_000, "%0A <n"]
    rows = [(c, t, ["user", "assistant", "a%0A\n<|x"][(c + t) % 3], texts[(c * 2 + t) % len(texts)], "z") for c in range(6) for t in range(5)]
    rows += [(None, 0, "user", "q", None), (None, None, None, None, None), rows[3], (7, 0, "user", "<|im_end|><|im_start|>assistant ok", "")]
    df = spark.createDataFrame(rows, CONV)
    out = C.format_conversations(df)
    assert all(r.round_trip for r in out.collect())
    got = {r.conv_id: r for r in C.digests(out).collect()}
    key = lambda r: tuple((x is not None, x if x is not None else 0) if not isinstance(x, str) else (1, x) for x in (r[1], r[2] or "", r[3] or ""))
    assert set(got) == {r[0] for r in rows}
    for conv, g in got.items():
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert g.n_turns == len(turns)
        assert g.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    plain = {r.conv_id: r.n_escaped for r in out.collect()}
    assert plain[7] == 1 and plain[None] == 0


def test_chat_empty(spark):
    assert C.digests(C.format_conversations(spark.createDataFrame([], CONV))).count() == 0


def rules(spark):
    return spark.createDataFrame(U.RULES, "verdict string, host string, path string")


def test_url_rules_and_aliases(spark):
    rows = [
        (1, "http://A.Example.ORG/es/x?q#f", None),
        (2, "https://example.org/en/15", ""),
        (3, "https://example.org/en/25", "<p>"),
        (4, "http://x.com/de/1", '<link rel="canonical" href="http://plain.net/a">'),
        (5, "http://plain.net/a#top", "x"),
        (6, "http://y.com/fr/1", '<meta http-equiv="refresh" content="0; url=http://plain.net/b">'),
        (7, "http://plain.net/b", '<LINK href=http://z.com/de/9 REL=canonical>'),
        (8, "no scheme", '<link rel="canonical" href="http://x.com/de/1">'),
        (9, None, None),
        (10, "http://chain.net/1", '<link rel=canonical href="/2">'),
        (10, "http://chain.net/2", '<link rel=canonical href="//plain.net/a">'),
        (11, "http://notexample.com.evil/de/", "p"),
        (12, "http://far.net", "p"),
        (None, "http://org", None),
    ]
    df = spark.createDataFrame([r + ("k",) for r in rows], "page_id long, url string, html string, rule string")
    red = spark.createDataFrame([("http://far.net", "http://x.com/de/1"), (None, "http://a/b")], "from_url string, to_url string")
    got = {}
    for r in U.filter_urls(df, rules(spark), red).collect():
        got.setdefault(r.page_id, []).append((r.host, r.path, r.rule, r.verdict))
    assert got[1] == [("a.example.org", "/es/x", "example.org/es/", "block")]
    assert got[2] == [("example.org", "/en/15", "example.org/en/1", "block")]
    assert got[3] == [("example.org", "/en/25", "org/", "allow")]
    assert got[4] == [("x.com", "/de/1", "com/de/", "block")]
    assert got[5] == [("plain.net", "/a", None, "block")]
    assert got[6] == [("y.com", "/fr/1", "com/fr/", "allow")]
    assert got[7] == [("plain.net", "/b", None, "allow")]  # an allow and a block rule among its aliases
    assert got[8] == [("", "", None, "allow")] and got[9] == [("", "", None, "allow")]
    assert sorted(x[3] for x in got[10]) == ["block", "block"]
    assert got[11][0][2:] == (None, "allow") and got[12][0] == ("far.net", "", None, "block")
    assert got[None] == [("org", "", None, "allow")]
    assert U.filter_urls(df.limit(0), rules(spark)).count() == 0


def test_components(spark):
    import random

    rnd = random.Random(1)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(None, 1), (5, 5)]
    want = {}
    nodes = {x for p in pairs if None not in p and p[0] != p[1] for x in p}
    for n in nodes:
        want[n] = n
    for _ in range(400):
        for a, b in pairs:
            if a in want and b in want:
                want[a] = want[b] = min(want[a], want[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got == want


def brute_fp(text):
    ws = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
    sh = [b" ".join(ws[i : i + 4]) for i in range(max(1, len(ws) - 3))] if ws else []
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups_of(fps, radius):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(fps), 2):
        if (a ^ b).bit_count() <= radius:
            root[find(b)] = find(a)
    return {f: find(f) for f in fps}


def test_simhash_groups(spark):
    docs = [(r.doc_id, r.text, "x") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs += [(9001, None, ""), (9002, "", ""), (9003, "one two", ""), (None, "one two", ""), (9004, "w " * 30_000, ""), docs[5], (9005, docs[7][1] + " end", "")]
    df = spark.createDataFrame(docs, "doc_id long, text string, fp string")
    got = S.simhash_groups(df).collect()
    assert len(got) == len(docs)
    fps = {}
    for i, t, _ in docs:
        fps.setdefault(brute_fp(t), []).append(i)
    root, first = groups_of(fps, 4), {}
    for f, ids in fps.items():
        for i in ids:
            if i is not None:
                first[root[f]] = min(first.get(root[f], i), i)
    want = sorted(((i, brute_fp(t), first.get(root[brute_fp(t)])) for i, t, _ in docs), key=str)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=str) == want
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    # one row of each group, also where a row is repeated
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({i for i, _, c in want if i is not None and i == c})
    assert [r.text for r in kept.where("doc_id is null").collect()] == []  # its copy 9003 has an id
    nulls = spark.createDataFrame([(None, "all alone here"), (None, "all alone here"), (4, "two words")], "doc_id long, text string")
    assert S.keep_one(nulls).count() == 2  # of copies without an id one stays
    assert S.simhash_groups(df.limit(0)).count() == 0


@pytest.mark.parametrize("tree_size,blocks", [(4096, 6), (40, 5), (7, 8)])
def test_bk_links_connect_like_brute_force(spark, tree_size, blocks):
    import random

    rnd = random.Random(blocks)
    base = [rnd.getrandbits(64) for _ in range(25)]
    fps = set(base) | {b ^ sum(1 << i for i in rnd.sample(range(64), rnd.randrange(1, 6))) for b in base[:3] * 60 + base for _ in range(2)} | {0, 2**64 - 1}
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    got = S.links(df, 4, blocks, tree_size).collect()
    for r in got:
        assert r.a != r.b
    joined = {r.node % 2**64: r.component % 2**64 for r in components(S.links(df, 4, blocks, tree_size), "a", "b").collect()}
    want = groups_of(fps, 4)
    same = lambda g: sorted(sorted(k for k in fps if g.get(k, k) == v) for v in {g.get(k, k) for k in fps})
    assert same(joined) == same(want)


LINKED = [
    # (url, html, target as a page): every link makes the page an alias of a blocked one
    ("http://b.net/dir/one", '<link rel="canonical" href="two">', "http://b.net/dir/two"),
    ("http://b1.net/dir/one", '<link rel="alternate canonical" href="http://x.com/de/1">', None),
    ("http://b2.net/dir/a/b", "<link href='../c' rel='canonical nofollow'>", "http://b2.net/dir/c"),
    ("http://b3.net/x?p=1", '<link rel="canonical" href="?p=2&amp;q=3">', "http://b3.net/x?p=2&q=3"),
    ("http://b4.net/a", '<link rel="canonical" href="/v?a=1&amp;b=2">', "https://b4.net/v?a=1&b=2#top"),
    ("http://b5.net/a/b/c", '<link rel="canonical" href="./d/../e">', "http://b5.net/a/b/e"),
    ("http://b6.net", '<link rel="canonical" href="index.html">', "http://b6.net/index.html"),
    ("http://b7.net/a", '<meta http-equiv="Refresh" content="5;URL=b.html">', "http://b7.net/b.html"),
    ("http://b8.net/a", '<meta content="0; url=\'/c d\'" http-equiv=refresh>', "http://b8.net/c d"),
    ("http://b9.net/a", '<link title="a > b" rel="canonical" href="/z">', "http://b9.net/z"),
    ("http://b10.net/a", '<link rel="canonical" href="http://b10.net">', "http://b10.net/"),
]
NOT_LINKED = [
    ("http://n1.net/a", '<!-- <link rel="canonical" href="http://x.com/de/1"> -->'),
    ("http://n2.net/a", '<script>var t = \'<link rel="canonical" href="http://x.com/de/1">\'</script>'),
    ("http://n3.net/a", '<link rel="non-canonical" href="http://x.com/de/1">'),
    ("http://n4.net/a", '<link rel="canonical" href="#x"><link rel=canonical href="mailto:a@b">'),
    ("http://n5.net/a", '<link rel="stylesheet canonicals" href="http://x.com/de/1"><a rel="canonical" href="http://x.com/de/1">'),
]


def test_urls_of_all_kinds_of_links(spark):
    import duckdb

    rows = [(1, "http://x.com/de/1", "")]
    for url, html, target in LINKED:
        rows.append((len(rows) + 1, url, html))
        if target:
            rows.append((len(rows) + 1, target, '<link rel="canonical" href="http://x.com/de/1">'))
    first_clean = len(rows) + 1
    rows += [(first_clean + i, url, html) for i, (url, html) in enumerate(NOT_LINKED)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in U.filter_urls(df, rules(spark)).collect()}
    for i, url, html in rows:
        assert got[i].verdict == ("block" if i < first_clean else "allow"), (url, html)
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    assert sorted(con.execute(U.OP6_SQL).fetchall(), key=str) == sorted((tuple(r) for r in got.values()), key=str)


def test_dots_in_paths(spark):
    paths = ["/a/b", "/a/./b", "/a/../b", "/a/b/..", "/..", "/../../a", "/a/.", "/a/...", "/a/..b/", "/a/b/../../../c/", "/"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    want = ["/a/b", "/a/b", "/b", "/a/", "/", "/a", "/a/", "/a/...", "/a/..b/", "/c/", "/"]
    assert [r[0] for r in df.select(U.without_dots(F.col("p"))).collect()] == want


def test_one_row_of_each_group_stays(spark):
    rows = [
        (1, "alpha beta gamma delta", "a"), (2, "one two three four", "b"), (2, "alpha beta gamma delta", "c"), (3, "one two three four", "d"),
        (3, "one two three four", "d"), (None, "alone without id here", "e"), (None, "alone without id here", "e"), (None, "one two three four", "f"),
        (7, None, "g"), (8, "", "h"), (9, "its own words entirely", "i"), (9, "its own words entirely", "i"), (10, "other words of ten", "j"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "", r.fingerprint) for r in S.keep_one(df).collect())
    assert got == [(-1, "alone without id here", "e"), (1, "alpha beta gamma delta", "a"), (2, "one two three four", "b"), (7, "", "g"), (9, "its own words entirely", "i"), (10, "other words of ten", "j")]
    assert S.keep_one(df.limit(0)).count() == 0
