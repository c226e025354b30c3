"""Collocations against plain counting, with every way of dealing the prefixes."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from pricelens.llm import collocations as C

SMALL = "/root/testdata/sf0.001"


def brute(rows, min_count=10, max_words=3, inside=50, top=2000):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(low)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, max_words + 1):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= inside * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cand.items()):
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(out)


def texts():
    rnd = random.Random(5)
    words = ["the", "The", "of", "a", "New", "york", "é", "x\x01y", "x", "\x0by", "日本", "end.", "no,", "one-two", " "]
    rows = [(None, None), ("en", ""), (None, " \t . ,"), ("xx", "lone"), ("en", "a " * 3000)]
    for i in range(150):
        rows.append((rnd.choice(["en", "en", "fr", None, "und"]), "".join(rnd.choice(words) + rnd.choice([" ", " ", "\t", "  ", "\n", "; "]) for _ in range(rnd.randrange(0, 60)))))
    return rows


@pytest.mark.parametrize("budget, top, words", [(1_000_000, 2000, 3), (50, 2000, 3), (1, 5, 3), (300, 3, 2)])
def test_collocations(spark, budget, top, words):
    rows = texts() + texts()[:20]
    df = spark.createDataFrame([(i, lang, t, "c", 1) for i, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string, phrase string, a int").repartition(5)
    got = C.collocations(df, budget=budget, top=top, max_words=words)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, top=top, max_words=words)


def test_empty(spark):
    assert C.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert C.collocations(spark.createDataFrame([(None, None), ("a", "one two")], "lang string, text string")).count() == 0


@pytest.mark.parametrize("block_bytes", [10, 200, 16_000_000])
def test_blocks(monkeypatch, block_bytes):
    import pyarrow as pa

    monkeypatch.setattr(C, "BLOCK_BYTES", block_bytes)
    rows = texts()
    batches = [pa.RecordBatch.from_pydict({"lang": [r[0] for r in part], "text": [r[1] for r in part]}, pa.schema([("lang", pa.string()), ("text", pa.string())])) for part in (rows[:3], rows[3:100], [], rows[100:])]
    got, want = defaultdict(Counter), defaultdict(Counter)
    for block in C._blocks(batches):
        names = ["", *block.names.to_pylist()]
        suffixes, counts = block.suffixes(np.array([w != "of" for w in names[1:]], dtype=bool), 3)
        for row, n in zip(suffixes.tolist(), counts.tolist()):
            got[block.lang][" ".join(names[j] for j in row if j)] += n
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").lower()):
            w = re.findall(r"[^\x20\x09]+", piece)
            for i in range(len(w)):
                suffix = w[i : i + 3]
                suffix = suffix[: suffix.index("of")] if "of" in suffix else suffix
                if suffix:
                    want["und" if lang is None else lang][" ".join(suffix)] += 1
    assert {k: v for k, v in got.items() if v} == want


def test_distinct_rows_of_many_words():
    rnd = np.random.default_rng(3)
    columns = [rnd.integers(0, 4, 300) for _ in range(3)]
    weights = rnd.integers(1, 9, 300)
    small, large = C.distinct(columns, 4, weights), C.distinct(columns, 1 << 40, weights)
    assert (small[0] == large[0]).all() and (small[1] == large[1]).all() and small[1].sum() == weights.sum()
    assert (C.distinct(columns, 4)[1] == C.distinct(columns, 1 << 40)[1]).all()


def test_pack_groups():
    rnd = np.random.default_rng(0)
    weights = rnd.integers(0, 100, 500)
    groups = C.pack_groups(weights, 150)
    held = np.bincount(groups, weights=weights)
    assert held.max() <= 150 and len(held) <= 2 * weights.sum() / 150 + 1


def test_scores_pass_64_bits(spark):
    df = spark.createDataFrame([(3_000_000_000, 5_000_000_000, 4_000_000_000)], "a long, l long, r long")
    assert df.select(C._score("a", "l", "r")).first()[0] == 1000000 * 3_000_000_000**2 // (5_000_000_000 * 4_000_000_000)


def test_query(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert sorted(map(tuple, C.op11_collocations(spark, SMALL).collect())) == brute(rows)
