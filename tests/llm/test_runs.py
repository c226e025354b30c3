"""Periodic runs against all stretches tried one by one."""

import hashlib
import random
import re
import zlib

import numpy as np

from pricelens.llm import runs as R

SMALL = "/root/testdata/sf0.001"


def runs_brute(s, min_words=6, min_repeats=4):
    """All maximal stretches with smallest period q, for every q."""
    n, out = len(s), set()
    for q in range(1, n // min_repeats + 1):
        i = 0
        while i + q < n:
            if s[i] != s[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            length = j - i + q
            smallest = not any(all(s[k] == s[k + p] for k in range(i, i + length - p)) for p in range(1, q))
            if smallest and length >= max(min_words, min_repeats * q):
                out.add((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed_brute(words, runs):
    gone = {k for a, n, p in runs for k in range(a + p, a + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def test_extension_and_ranks():
    rnd = random.Random(1)
    for _ in range(40):
        s = [rnd.randrange(1, rnd.choice((2, 3, 9)) + 1) for _ in range(rnd.randrange(1, 120))] + [0]
        ext = R.Extension(s)
        order = sorted(range(len(s)), key=lambda i: s[i:])
        assert [order.index(i) for i in range(len(s))] == ext.rank.tolist()
        i = np.array([rnd.randrange(len(s)) for _ in range(200)])
        j = np.array([rnd.randrange(len(s)) for _ in range(200)])
        i, j = i[i != j], j[i != j]
        for a, b, got in zip(i.tolist(), j.tolist(), ext(i, j).tolist()):
            want = 0
            while max(a, b) + want < len(s) and s[a + want] == s[b + want]:
                want += 1
            assert got == want


def test_runs_of_random_sequences():
    rnd = random.Random(2)
    for trial in range(400):
        s = []
        while len(s) < rnd.randrange(1, 90):
            root = [rnd.randrange(rnd.choice((1, 2, 3))) for _ in range(rnd.randrange(1, 7))]
            s += root * rnd.randrange(1, 7) + root[: rnd.randrange(len(root) + 1)]
        for least, repeats in ((6, 4), (2, 2), (1, 3)):
            got = sorted(map(tuple, R.runs_of(np.array(s), least, repeats).tolist()), key=lambda r: (r[0], r[2]))
            assert got == runs_brute(s, least, repeats), (s, least, repeats)


def test_find_runs(spark):
    rnd = random.Random(3)
    texts = [None, "", " \t\n", "one", "a a a a a", "a a a a a a", "a b " * 3 + "a b a", "\x0ba b\x0ca b\ra b\ta b\n", "é é é é é é é", "x y " * 20_000 + "z", "w " * 50_000]
    for _ in range(60):
        parts = []
        for _ in range(rnd.randrange(1, 5)):
            parts += [rnd.choice("abcdefgh") for _ in range(rnd.randrange(0, 12))]
            parts += [rnd.choice("abc") for _ in range(rnd.randrange(1, 5))] * rnd.randrange(1, 8)
        texts.append(" ".join(parts))
    rows = [(i, t, "r", 1) for i, t in enumerate(texts)] + [(None, texts[5], "r", 2), (4, texts[4], "r", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed int")
    for block in (4_000_000, 50):
        out = R.find_runs(df, block_bytes=block)
        assert out.columns == ["doc_id", "text", "runs", "collapsed", "runs_1", "collapsed_1"]
        got = out.collect()
        assert len(got) == len(rows)
        for r in got:
            words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
            if len(words) < 1000:
                want = runs_brute(words)
            else:
                want = [(0, len(words) - 1, 2)] if words[1] == "y" else [(0, len(words), 1)]
            assert [tuple(x) for x in r.runs_1] == want
            assert r.collapsed_1 == collapsed_brute(words, want)
    assert R.find_runs(df.limit(0)).count() == 0


def test_query(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = R.op12_periodic_runs(spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(rows)
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", rows[r.doc_id] or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        # brute force only where a word repeats often enough
        want = runs_brute(words) if n < 1200 else None
        if want is None:
            continue
        assert r.n_runs == len(want)
        if want:
            best = min(want, key=lambda x: (-x[1], x[0], x[2]))
            assert (r.start, r.length, r.period) == best and r.exponent_milli == 1000 * best[1] // best[2]
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in want).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed_brute(words, want).encode()).hexdigest()
