"""Line dedup, BPE and packing against plain Python and the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import tokenizers

from pricelens.llm import bpe, packing
from pricelens.llm import line_dedup as L

SMALL = "/root/testdata/sf0.001/documents.parquet"
ODD = [None, "", " ", "\n\n", "one\ntwo", "<|endoftext|> a <|endoftext|>", "x" * 30_000, "é ñandú ÑANDÚ İ ŉ 漢字 １２ ²", "It's we'll\t\r\n 12 a_b __", "a\x1cb\x85c\xa0d"]


def lines_brute(rows):
    blanks = " \t\n\x0b\x0c\r"
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(blanks).translate(low)
    held = {}
    bottom = -(2**63)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                held.setdefault(key(line), set()).add(bottom if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        own = bottom if i is None else i
        kept = [x for x in lines if len(held.get(key(x), ())) < 3 or max(held[key(x)]) == own]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_line_dedup(spark):
    shared = ["This Line is shared by documents", "  this line IS shared by documents\t", "shört bütlong enough ÄÖÜ", "short"]
    rnd = random.Random(0)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(SMALL).collect()]
    rows += [(1000 + i, "\n".join(rnd.choice(shared + [f"own line number {i} of the text"]) for _ in range(rnd.randrange(0, 6)))) for i in range(40)]
    rows += [(None, shared[0] + "\n" + shared[0]), (None, "only null ids hold this line"), (3000, None), (3001, ""), rows[-3], (1001, "a\n" + shared[1]), (3002, "w" * 300_000)]
    df = spark.createDataFrame([(i, t, "k", 5) for i, t in rows], "doc_id long, text string, lost string, n_lines long")
    for size, probes in ((262_144, 1_000_000), (50, 7)):
        out = L.dedup_lines(df, shard_size=size, probe_size=probes)
        assert out.columns == ["doc_id", "text", "lost", "n_lines", "n_lines_1", "n_dropped"]
        got = sorted(((r.doc_id, r.n_lines_1, r.n_dropped, r.text or "") for r in out.collect()), key=str)
        assert got == lines_brute(rows)
    assert L.dedup_lines(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    rnd = np.random.default_rng(n)
    h1, h2 = (rnd.integers(0, 2**64, n, dtype=np.uint64) for _ in range(2))
    h1[: n // 3] = 7
    mph = L.PerfectHash.build(h1, h2)
    assert sorted(mph.slots(h1, h2).tolist()) == list(range(n))


def reference(path):
    t = tokenizers.Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_codec(spark):
    t = reference(bpe.default_path())
    texts = ODD + [r.text for r in spark.read.parquet(SMALL).limit(60).collect()] + [ODD[5], "".join(map(chr, range(0x20, 0x3000)))]
    df = spark.createDataFrame([(i, x, "e") for i, x in enumerate(texts)], "doc_id long, text string, ids string")
    out = bpe.decode(bpe.encode(df, batch_bytes=5000).withColumn("decoded", bpe.F.lit(1)))
    assert out.columns == ["doc_id", "text", "decoded"]
    ids = {r.doc_id: r.ids for r in bpe.encode(df, batch_bytes=5000).collect()}
    back = {r.doc_id: r.decoded for r in out.collect()}
    assert len(back) == len(texts)
    for i, x in enumerate(texts):
        want = t.encode(x or "", add_special_tokens=False).ids
        assert ids[i] == want and back[i] == t.decode(want, skip_special_tokens=False) == (x or "")
    assert bpe.decode(bpe.encode(df.limit(0))).count() == 0


def test_bpe_trees_agree(spark):
    c = bpe.codec(bpe.default_path())
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdeéß-thein ") for _ in range(rnd.randrange(1, 40))).encode()[:64] for _ in range(2000)]
    one = [np.array(bpe.merge_ids([int(c.first[b]) for b in w], c.pairs), dtype="<i4").tobytes() for w in words]
    assert c.merger.merge(words, c.first) == one


def test_bpe_query(spark):
    from pricelens.llm.bpe import op8_bpe_codec

    t = reference(bpe.default_path())
    rows = {r.doc_id: r.text for r in spark.read.parquet(SMALL).collect()}
    for r in op8_bpe_codec(spark, "/root/testdata/sf0.001").collect():
        ids = t.encode(rows[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_packing(spark):
    t = reference(packing.default_path())
    texts = ODD + [r.text for r in spark.read.parquet(SMALL).collect()] + ["word and more " * 9000, "a b"]
    rows = [(i, x, 1) for i, x in enumerate(texts)] + [(None, "null id", 1), (5, texts[5], 1), (5, texts[5], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int")
    got = packing.pack_documents(df, max_len=512).collect()
    want = []
    for i, x, _ in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids + [1]
        for s in range(0, len(ids), 512):
            cut = ids[s : s + 512]
            want.append((i, s // 512, s, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes()), cut))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.input_ids) for r in got), key=str) == sorted(want, key=str)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
    bound = -(-sum(w[3] for w in want) // 512)
    assert len(sequences) <= 1.02 * bound + 1
    assert packing.pack_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["one", "few", "hot", "long", "spread"])
def test_packing_plan_uses_each_piece_once(kind):
    rnd = np.random.default_rng(5)
    lengths = {
        "one": [7],
        "few": [4096, 4095, 1, 1, 1],
        "hot": [1300] * 5000 + rnd.integers(1, 4097, 9000).tolist(),
        "long": rnd.integers(2100, 4097, 2000).tolist(),
        "spread": np.minimum(rnd.geometric(1 / 900, 40_000), 4096).tolist(),
    }[kind]
    h = np.bincount(lengths, minlength=4097)
    made = packing.plan(h, 4096)
    used = np.zeros_like(h)
    for lens, times in made:
        assert sum(lens) <= 4096 and times > 0
        np.add.at(used, list(lens), times)
    assert (used == h).all()
    n, bound = sum(t for _, t in made), -(-sum(lengths) // 4096)
    if kind in ("hot", "spread"):
        assert n <= {"hot": 1.02, "spread": 1.001}[kind] * bound + 1
    if kind == "long":
        assert n == 2000


def test_words_in_arrays_like_the_library():
    rnd = random.Random(1)
    bits = ["the", "'s", "'ll", "'re", "'ve", "'t", "'x", "'", "''", " ", "  ", "\n", "\n\n", " \n", "\t", "\r\n", "12", "3", "é", "É", "ß", "ÿ", "Ñandú", "!", "_", "a" * 70]
    bits += ["Z", "L", "l", "'LL", "<|endoftext|>", "<|", "×", "漢", "²", "\x1c", "\x00"]
    fixed = ["", "  ", "\n", "'s", "a", "a ", "a\n", " 's", "!'s", "''s", "'", "it's", "I'LL we'll", "a" * 5000]
    texts = fixed + ["".join(rnd.choice(bits[: n % 2 * 7 + 30]) for _ in range(rnd.randrange(30))) for n in range(3000)]
    codec, words = bpe.Codec(bpe.default_path(), keep=50), packing.Words(packing.default_path(), keep=50)
    codec.table.limit = words.table.limit = 300  # words come and go
    byte_level, word_level = reference(bpe.default_path()), reference(packing.default_path())
    for i in range(0, len(texts), 200):
        some = texts[i : i + 200]
        for t, a, b in zip(some, codec.encode_batch(some), words.encode_batch(some)):
            assert a.tolist() == byte_level.encode(t, add_special_tokens=False).ids, t
            assert np.frombuffer(b, "<u4").tolist() == word_level.encode(t, add_special_tokens=False).ids, t
    assert len(codec.table.keys) <= 300 + 400


def thue_morse(n: int, a: str, b: str) -> str:
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


#: Pairs of different words with one hash (polynomials modulo 2^64 cannot tell them apart).
TWINS = [(thue_morse(n, a, b), thue_morse(n, b, a)) for n in (512, 1024, 2048) for a, b in (("a", "b"), ("c", "z"))]


def test_words_of_one_hash(spark):
    from pricelens.llm.wordtable import Hasher

    text = np.frombuffer("".join(TWINS[3]).encode(), dtype=np.uint8)
    h = Hasher().hashes(text, np.array([0, 1024]), np.array([1024, 2048]))
    assert h[0] == h[1]  # the test is about what it says
    t, u = reference(bpe.default_path()), reference(packing.default_path())
    one = [" ".join(w for pair in TWINS for w in pair)]
    two = [w for pair in TWINS for w in pair]
    for texts in (one, two, two[::-1]):
        for batches in ([texts], [[x] for x in texts]):
            c, w = bpe.Codec(bpe.default_path()), packing.Words(packing.default_path())
            for batch in batches:
                for text, ids in zip(batch, c.encode_batch(batch)):
                    assert ids.tolist() == t.encode(text, add_special_tokens=False).ids
                for text, ids in zip(batch, w.encode_batch(batch)):
                    assert np.frombuffer(ids, dtype="<i4").tolist() == u.encode(text, add_special_tokens=False).ids
    df = spark.createDataFrame([(i, x) for i, x in enumerate(one + two)], "doc_id long, text string").coalesce(1)
    back = {r.doc_id: r for r in bpe.decode(bpe.encode(df)).collect()}
    assert [back[i].decoded for i in range(len(one + two))] == one + two


@pytest.mark.parametrize("limit, most_bytes", [(600_000, 32_000_000), (7, 32_000_000), (600_000, 20)])
def test_word_table_with_a_poor_hash(limit, most_bytes):
    from pricelens.llm.wordtable import WordTable

    class Poor:
        def hashes(self, text, start, end):
            return (end - start).astype(np.uint64) % np.uint64(3)

    def encode(text, start, end):
        words = [text[a:b] for a, b in zip(start, end)]
        return np.concatenate([w.astype(np.int32) for w in words]), np.array([len(w) for w in words])

    rnd = random.Random(8)
    table = WordTable(encode, limit, most_bytes, Poor())
    for _ in range(50):
        words = ["".join(rnd.choice("ab") for _ in range(rnd.choice([1, 2, 7, 8, 9, 16, 17, 30]))) for _ in range(rnd.randrange(1, 30))]
        text = np.frombuffer("".join(words).encode(), dtype=np.uint8)
        end = np.cumsum([len(w) for w in words])
        flat, size = table.ids(text, end - [len(w) for w in words], end)
        assert size.tolist() == [len(w) for w in words] and flat.tolist() == text.tolist()


def test_patterns_place_nearly_all(spark):
    h = np.zeros(4097, dtype=np.int64)
    pieces = packing.tokenize_pieces(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), with_ids=False)
    for r in pieces.groupBy("length").count().collect():
        h[r["length"]] = r["count"]
    rows = packing.patterns(h, 4096)
    assert (rows.sum(axis=1) == 4096).all() and len(np.unique(rows, axis=0)) == len(rows)
    made = packing.plan(h, 4096)
    full = sum(len(lengths) * times for lengths, times in made if sum(lengths) == 4096)
    assert full >= 0.9 * h.sum()
    total = int((h * np.arange(4097)).sum())
    assert sum(times for _, times in made) == -(-total // 4096)
    used = np.zeros(4097, dtype=np.int64)
    for lengths, times in made:
        np.add.at(used, list(lengths), times)
    assert (used == h).all()
    assert len(packing.patterns(h * 0, 4096)) == 0


def test_pack_with_clashing_names(spark):
    from pricelens.llm.common import written

    df = spark.range(500).selectExpr("7 AS doc_id", "CAST(10 + id % 3 AS BIGINT) AS length", "1 AS _salt", "2 AS row", "3 AS rank", "4 AS salt", "5 AS sequence_id")
    out = packing.pack(written(df, "clash"), max_len=64)
    assert out.columns == ["doc_id", "length", "_salt", "row", "rank", "salt", "sequence_id", "sequence_id_1", "offset"]
    rows = sorted((r.sequence_id_1, r.offset, r.length) for r in out.collect())
    assert len(rows) == 500 == len(set(rows))
    for (s, o, n), (s2, o2, _) in zip(rows, rows[1:]):
        assert (o2 == o + n) if s2 == s else (o2 == 0)
    assert all(o + n <= 64 for _, o, n in rows)
