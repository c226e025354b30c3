"""Byte-level BPE encoding and decoding.

A pre-token's symbols lie in the leaves of a segment tree over the ranks of
adjacent pairs; the root leads to the leftmost pair of the lowest rank. A merge
changes at most three leaves, each updated up to the root, until the root says
that no pair can merge. Trees of short pre-tokens are worked side by side, a
row of an array each (``Merger``); longer ones one by one (``merge_ids``).
Encoded pre-tokens are kept in bounded tables per Python worker; texts of
simple characters are cut and looked up in arrays (``wordtable``).
"""

from __future__ import annotations

import json
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from pricelens.llm.wordtable import WordTable, encode_plain, plain, spread, words_with_blanks

#: Fixed value: the pre-token pattern of the byte-level tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = 1 << 60
MANY = np.int32(2**31 - 1)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = [], 0
    for b in range(256):
        if b in shown:
            out.append(chr(b))
        else:
            out.append(chr(256 + n))
            n += 1
    return out


def merge_ids(ids: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """``ids`` after all merges; ``pairs``: (left, right) -> (rank, merged)."""
    n = len(ids)
    if n < 2:
        return ids
    size = 1 << (n - 1).bit_length()
    tree = [NONE] * (2 * size)
    for i in range(n - 1):
        if p := pairs.get((ids[i], ids[i + 1])):
            tree[size + i] = p[0]
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a <= b else b
    ids, before, after = list(ids), list(range(-1, n - 1)), list(range(1, n + 1))

    def put(i: int, rank: int) -> None:
        i += size
        tree[i] = rank
        while i > 1:
            i >>= 1
            a, b = tree[2 * i], tree[2 * i + 1]
            low = a if a <= b else b
            if tree[i] == low:
                return
            tree[i] = low

    while tree[1] != NONE:
        i, low = 1, tree[1]
        while i < size:
            i *= 2
            if tree[i] != low:
                i += 1
        i -= size
        j = after[i]
        ids[i] = pairs[ids[i], ids[j]][1]
        ids[j] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            p = pairs.get((ids[i], ids[k]))
            put(j, NONE)
            put(i, p[0] if p else NONE)
        else:
            put(j, NONE)
            put(i, NONE)
        h = before[i]
        if h >= 0:
            p = pairs.get((ids[h], ids[i]))
            put(h, p[0] if p else NONE)
    return [x for x in ids if x >= 0]


class Merger:
    """The same merges for many short words at once: one segment tree a row."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]], ids: int):
        self.ids, self.pairs = ids, pairs
        keys = np.array([a * ids + b for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(np.array([p[0] for p in pairs.values()], dtype=np.int32)[order], 0)
        self.merged = np.append(np.array([p[1] for p in pairs.values()], dtype=np.int32)[order], 0)
        self.by_rank = np.full(int(self.ranks.max(initial=0)) + 1, -1, dtype=np.int32)
        self.by_rank[self.ranks[:-1]] = self.merged[:-1]

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.ids + b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], MANY)

    def merge(self, words: list[bytes], first: np.ndarray, last: np.ndarray | None = None) -> list[bytes]:
        """Token ids (little-endian int32 bytes) of words of at least a byte.
        ``first``: the symbol of each byte; ``last``: that of a word's last byte."""
        size = np.array([len(w) for w in words], dtype=np.int64)
        text = np.frombuffer(b"".join(words), dtype=np.uint8)
        flat, n = self.merge_slices(text, np.cumsum(size) - size, np.cumsum(size), first, last)
        raw, ends = flat.astype("<i4").tobytes(), (4 * np.cumsum(n)).tolist()
        return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def merge_slices(self, text: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, last: np.ndarray | None = None):
        """The ids of words text[start:end], one after another, and how many each has."""
        lengths = end - start
        parts, order, counts = [], [], np.zeros(len(start), dtype=np.int64)
        for size in (2, 4, 8, 16, 32, 64):
            mine = np.flatnonzero((lengths <= size) & (lengths > (size >> 1 if size > 2 else 0)))
            for i in range(0, len(mine), 16384):
                some = mine[i : i + 16384]
                at = np.minimum(start[some][:, None] + np.arange(size), len(text) - 1)
                ids = self._merge(text[at], lengths[some], first, last, size)
                keep = ids >= 0
                counts[some] = keep.sum(1)
                order.append(some)
                parts.append(ids[keep])
        for i in np.flatnonzero(lengths > 64).tolist():
            symbols = first[text[start[i] : end[i]]].tolist()
            if last is not None:
                symbols[-1] = int(last[text[end[i] - 1]])
            parts.append(np.array(merge_ids(symbols, self.pairs), dtype=np.int32))
            counts[i] = len(parts[-1])
            order.append(np.array([i]))
        out = np.zeros(counts.sum(), dtype=np.int32)
        if parts:
            done = np.concatenate(order)
            out[spread((np.cumsum(counts) - counts)[done], counts[done])] = np.concatenate(parts)
        return out, counts

    def _merge(self, raw, lengths, first, last, size):
        n = len(raw)
        ids = first[raw]
        if last is not None:
            ids[np.arange(n), lengths - 1] = last[raw[np.arange(n), lengths - 1]]
        ids[np.arange(size) >= lengths[:, None]] = -1
        tree = np.full((n, 2 * size), MANY, dtype=np.int32)
        real = np.arange(size - 1) < lengths[:, None] - 1
        tree[:, size : 2 * size - 1][real] = self.rank(ids[:, :-1][real], ids[:, 1:][real])
        for i in range(size - 1, 0, -1):
            tree[:, i] = np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1])
        after = np.tile(np.arange(1, size + 1), (n, 1))
        after[after >= lengths[:, None]] = size
        before = np.tile(np.arange(-1, size - 1), (n, 1))
        rows = np.flatnonzero(tree[:, 1] != MANY)

        def put(rows, leaves, ranks):
            at = leaves + size
            tree[rows, at] = ranks
            while at[0] > 1:
                at = at >> 1
                tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])

        while len(rows):
            low, at = tree[rows, 1], np.ones(len(rows), dtype=np.int64)
            for _ in range(size.bit_length() - 1):
                at = 2 * at
                at += tree[rows, at] != low
            i = at - size
            j = after[rows, i]
            ids[rows, i] = self.by_rank[low]
            ids[rows, j] = -1
            k = after[rows, j]
            after[rows, i] = k
            put(rows, j, MANY)
            more = k < size
            right = np.full(len(rows), MANY, dtype=np.int32)
            before[rows[more], k[more]] = i[more]
            right[more] = self.rank(ids[rows[more], i[more]], ids[rows[more], k[more]])
            put(rows, i, right)
            h = before[rows, i]
            left = h >= 0
            if left.any():
                put(rows[left], h[left], self.rank(ids[rows[left], h[left]], ids[rows[left], i[left]]))
            rows = rows[tree[rows, 1] != MANY]
        return ids


class Recent:
    """A table of results in two generations of at most about ``keep`` entries
    together: what was not asked for during one generation is let go."""

    def __init__(self, keep: int):
        self.half, self.young, self.old = keep // 2, {}, {}

    def have(self, words: set[str], make) -> dict[str, bytes]:
        """A table that holds all ``words``; ``make(list)`` gives those that are not at hand."""
        if len(self.young) + len(words) > self.half:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new = words - young.keys()
        young.update({w: old[w] for w in new & old.keys()})
        missing = list(new - old.keys())
        young.update(zip(missing, make(missing)))
        return young


class Codec:
    """Encoder and decoder of one byte-level BPE file (json of tokenizers)."""

    def __init__(self, path: str, keep: int = 200_000):
        import re

        import regex

        spec = json.load(open(path, encoding="utf-8"))
        chars = byte_chars()
        byte_of = {c: i for i, c in enumerate(chars)}
        vocab = spec["model"]["vocab"]
        self.first = np.array([vocab[c] for c in chars], dtype=np.int32)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.pairs = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in reversed(list(enumerate(merges)))}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens with options are not supported")
        self.bytes_of = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.merger = Merger(self.pairs, len(self.bytes_of))
        cut = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self.cut = re.compile(f"({cut})") if cut else None
        self.words = regex.compile(PATTERN)
        self.kept = Recent(keep)
        self.table = WordTable(lambda text, start, end: self.merger.merge_slices(text, start, end, self.first))

    def parts(self, text: str):
        """Lists of pre-tokens of a text, of bounded length; a special token is a list of its own."""
        for part in self.cut.split(text) if self.cut else (text,):
            if part in self.special:
                yield part
                continue
            if len(part) <= 1_000_000:
                yield self.words.findall(part)
            else:
                found = (m.group() for m in self.words.finditer(part))
                while some := list(islice(found, 100_000)):
                    yield some

    def words_ids(self, words: list[str]) -> list[bytes]:
        return self.merger.merge([w.encode("utf-8", "replace") for w in words], self.first)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        raw = [t.encode("utf-8", "replace") for t in texts]
        out: list = [None] * len(texts)
        simple = [i for i, r in enumerate(raw) if plain(r) and not (self.cut and self.cut.search(texts[i]))]
        for i, ids in zip(simple, encode_plain(self.table, [raw[i] for i in simple], words_with_blanks)):
            out[i] = ids
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, self._encode_any([texts[i] for i in rest])):
            out[i] = ids
        return out

    def _encode_any(self, texts: list[str]) -> list[np.ndarray]:
        out: list[list[bytes]] = [[] for _ in texts]
        held, n = [], 0

        def flush():
            kept = self.kept.have(set().union(*[p for _, p in held if not isinstance(p, str)]), self.words_ids)
            for i, p in held:
                special = isinstance(p, str)
                out[i].append(np.array([self.special[p]], dtype="<i4").tobytes() if special else b"".join(map(kept.__getitem__, p)))
            held.clear()

        for i, text in enumerate(texts):
            for p in self.parts(text):
                held.append((i, p))
                n += len(p)
                if n >= 500_000:
                    flush()
                    n = 0
        flush()
        return [np.frombuffer(b"".join(x), dtype="<i4") for x in out]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_batch([text])[0]

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _with(df: DataFrame, leave: tuple, name: str, kind) -> StructType:
    return StructType([*[f for f in df.schema.fields if f.name not in leave], StructField(name, kind)])


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None, batch_bytes: int = 4_000_000) -> DataFrame:
    """``docs`` plus ``ids`` array<int>, which replaces a column of that name.

    Null text is encoded as empty (no ids). Special tokens in a text get their
    ids. Whole texts are encoded; rows, repeated ones too, stay; no rows give
    no rows. The file at ``path`` must be readable on every worker.
    """
    path = path or default_path()
    keep = [c for c in docs.columns if c != ids]
    text_name = "__text"
    while text_name in docs.columns:
        text_name += "_"

    def run(batches):
        c = codec(path)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(len(keep))), 0).to_numpy(zero_copy_only=False)
            turn = np.cumsum(sizes) // batch_bytes
            cuts = [0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(a, b - a)
                got = c.encode_batch([t or "" for t in part.column(len(keep)).to_pylist()])
                offsets = np.concatenate(([0], np.cumsum([len(g) for g in got]))).astype(np.int32)
                arr = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, "<i4"), *got]), pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], arr], names=[*keep, ids])

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias(text_name))
    return rows.mapInArrow(run, _with(docs, (ids,), ids, ArrayType(IntegerType())))


def decode(encoded: DataFrame, ids: str = "ids", text: str = "decoded", path: str | None = None) -> DataFrame:
    """``encoded`` with ``text`` (replacing a column of that name) in place of ``ids``; null ids give an empty text."""
    path = path or default_path()
    keep = [c for c in encoded.columns if c not in (ids, text)]

    def run(batches):
        c = codec(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                out = [c.decode(x.values.to_numpy().tolist()) if x.is_valid else "" for x in part.column(len(keep))]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(out, pa.string())], names=[*keep, text])

    rows = encoded.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ids}`"))
    return rows.mapInArrow(run, _with(encoded, (ids, text), text, StringType()))


def op8_bpe_codec(spark, sf_dir: str) -> DataFrame:
    from pricelens.llm.common import table

    ids = encode(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "ids")
    said = ids.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        "ids",
    )
    return decode(said).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
