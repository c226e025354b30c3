"""Packing of tokenized documents by length patterns.

The plan is made from the histogram of piece lengths alone (``max_len``
numbers): patterns of few lengths that fill a sequence exactly are enumerated,
non-negative least squares fits how often each is repeated, and the repeats are
rounded; this is done again for what the histogram has left, and the residue is
packed largest first, each time with the longest length that still fits. The plan says
for every length which sequence and offset its r-th piece gets. Pieces are
numbered within their length in parallel (salted groups and running sums), so a
length that a third of all pieces share is no hot key.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from pricelens.llm.bpe import Merger, Recent, byte_chars
from pricelens.llm.common import fresh, written
from pricelens.llm.wordtable import WordTable, encode_plain, lower, plain, words_without_blanks

END_ID = 1
PATTERN_TURNS = 12  # patterns are drawn and fitted again for what is left, at most so often


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Words:
    """Ids of whole texts by a tokenizer that lower-cases and drops white space.

    Texts of simple characters are cut, looked up and merged in arrays
    (``wordtable``, ``bpe.Merger``). Any other text (other scripts, marks,
    special tokens) is cut at blanks, and its chunks are encoded by the
    tokenizers library itself and kept (bounded).
    """

    def __init__(self, path: str, keep: int = 200_000):
        import json

        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        pieces, model = spec["pre_tokenizer"]["pretokenizers"], spec["model"]
        if pieces[0]["type"] != "Split" or pieces[0]["behavior"] != "Removed" or not pieces[0]["invert"]:
            raise ValueError("the tokenizer must drop white space")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kept = Recent(keep)
        vocab, chars, end = model["vocab"], byte_chars(), model["end_of_word_suffix"] or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        pairs = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in reversed(list(enumerate(merges)))}
        self.merger = Merger(pairs, max(vocab.values()) + 1)
        self.first = np.array([vocab[c] for c in chars], dtype=np.int32)
        self.last = np.array([vocab[c + end] for c in chars], dtype=np.int32)

        self.table = WordTable(lambda text, start, end: self.merger.merge_slices(text, start, end, self.first, self.last))

    def chunk_ids(self, chunks: list[str]) -> list[bytes]:
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        out = []
        for i in range(0, len(chunks), 10_000):
            out += [np.array(e.ids, dtype="<u4").tobytes() for e in encode(chunks[i : i + 10_000], add_special_tokens=False)]
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        raw = [t.encode("utf-8", "replace") for t in texts]
        out: list = [None] * len(texts)
        simple = [i for i, r in enumerate(raw) if plain(r) and b"<|" not in r]
        for i, ids in zip(simple, encode_plain(self.table, [raw[i] for i in simple], words_without_blanks, lower)):
            out[i] = ids.astype("<u4").tobytes()
        rest = [i for i, x in enumerate(out) if x is None]
        if rest:
            split = [texts[i].replace("\n", " ").replace("\t", " ").split(" ") for i in rest]
            kept = self.kept.have(set().union(*split), self.chunk_ids)
            for i, s in zip(rest, split):
                out[i] = b"".join(map(kept.__getitem__, s))
        return out


_words: dict[str, Words] = {}


def tokenize_pieces(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_len: int = 4096, path: str | None = None, with_ids: bool = True, batch_bytes: int = 4_000_000
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, input_ids]): the ids of every
    whole text and END_ID, cut into pieces of ``max_len`` where longer."""
    path = path or default_path()

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        w = _words.get(path) or _words.setdefault(path, Words(path))
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // batch_bytes)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(a, b - a)
                rows, blobs = [], []
                for doc, ids in zip(part.column(0).to_pylist(), w.encode_batch([t or "" for t in part.column(1).to_pylist()])):
                    ids += end
                    for start in range(0, len(ids) // 4, max_len):
                        piece = ids[4 * start : 4 * (start + max_len)]
                        rows.append((doc, start // max_len, start, len(piece) // 4, zlib.crc32(piece)))
                        if with_ids:
                            blobs.append(piece)
                if not rows:
                    continue
                doc, *numbers = zip(*rows)
                out = [pa.array(doc, pa.int64()), pa.array(numbers[0], pa.int32()), *[pa.array(x, pa.int64()) for x in numbers[1:]]]
                if with_ids:
                    offsets = np.concatenate(([0], np.cumsum(numbers[2]))).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(blobs), dtype="<i4"))))
                yield pa.RecordBatch.from_arrays(out, names=names)

    fields = [StructField("doc_id", LongType()), StructField("piece", IntegerType())]
    fields += [StructField(n, LongType()) for n in ("start", "length", "ids_crc32")]
    if with_ids:
        fields.append(StructField("input_ids", ArrayType(IntegerType())))
    names = [f.name for f in fields]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, StructType(fields))


def patterns(histogram: np.ndarray, max_len: int, most: int = 65_536, seed: int = 0) -> np.ndarray:
    """Rows of few lengths (largest first, 0: none) that fill a sequence exactly.

    For every length: with the one length that is missing, and with about
    ``most`` / all lengths others and the one then missing. For short pieces, of
    which a sequence holds many: lengths drawn as often as the histogram has
    them, as many as fit, and the one that is missing.
    """
    lengths = np.flatnonzero(histogram)
    total = int(histogram.sum())
    if not total:
        return np.zeros((0, 1), dtype=np.int64)
    there = np.append(histogram > 0, False)  # the last one: no such length
    rng = np.random.default_rng(seed)
    share = histogram[lengths] / total
    others = int(np.clip(min(most, 4 * total) // len(lengths), 1, 64))
    a = np.repeat(lengths, others + 1)
    b = np.column_stack([np.zeros(len(lengths), dtype=np.int64), rng.choice(lengths, size=(len(lengths), others), p=share)]).ravel()
    c = max_len - a - b
    ok = (c >= 0) & ((c == 0) | there[np.clip(c, -1, max_len)])
    wide = int(np.clip(2 * max_len * total / max((lengths * histogram[lengths]).sum(), 1), 3, 64))
    few = np.zeros((int(ok.sum()), wide + 1), dtype=np.int64)
    few[:, :3] = np.stack([a, b, c], axis=1)[ok]
    rows = rng.choice(lengths, size=(min(most, max(total, 64)), wide), p=share)
    rest = max_len - np.cumsum(rows, axis=1)
    fits = (rest >= 0) & ((rest == 0) | there[np.clip(rest, -1, max_len)])
    # the longest draw that one more length completes
    some = np.flatnonzero(fits.any(axis=1))
    last = wide - 1 - fits[some, ::-1].argmax(axis=1)
    many = np.column_stack([np.where(np.arange(wide) <= last[:, None], rows[some], 0), rest[some, last]])
    return np.unique(-np.sort(-np.concatenate([few, many]), axis=1), axis=0)


def fit(rows: np.ndarray, histogram: np.ndarray, rounds: int = 150) -> np.ndarray:
    """x >= 0 that makes rows.T x close to the histogram in least squares
    (multiplicative updates, which keep x from turning negative)."""
    n = len(histogram)
    real = rows > 0
    at = np.where(real, rows, 0)
    h = histogram.astype(np.float64)
    x = np.full(len(rows), max(h.sum() / max(real.sum(), 1), 1e-3))
    gain = (h[at] * real).sum(1)
    for _ in range(rounds):
        made = np.bincount(at.ravel(), weights=(x[:, None] * real).ravel(), minlength=n)
        x *= gain / np.maximum((made[at] * real).sum(1), 1e-12)
    return x


def plan(histogram: np.ndarray, max_len: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) that use every piece of the histogram exactly once:
    the plan of fewest sequences of those with many, one and no turn of fitted
    patterns (ties: more turns). Patterns take short pieces that long ones may
    need where few pieces of many lengths are to be packed."""
    plans = []
    bound = -(-int((histogram * np.arange(len(histogram))).sum()) // max_len)
    for turns in (PATTERN_TURNS, 1, 0):
        plans.append(_plan(histogram, max_len, turns))
        if sum(times for _, times in plans[-1]) == bound:
            break
    return min(plans, key=lambda made: sum(times for _, times in made))


def _plan(histogram: np.ndarray, max_len: int, turns: int) -> list[tuple[tuple[int, ...], int]]:
    """Fitted patterns as far as the histogram has their pieces, each turn for
    what it still has, and largest-first for the rest.

    Repeats are rounded so that running totals are kept, pattern by pattern from
    the one with the longest piece: what is cut off one goes to the next.
    """
    left = histogram.astype(np.int64).copy()
    out = []
    for turn in range(turns):
        before = int(left.sum())
        rows = patterns(left, max_len, seed=turn)
        if not len(rows):
            break
        rows = rows[::-1]
        carry = 0.0
        for row, x in zip(rows.tolist(), fit(rows, left).tolist()):
            carry += x
            if carry < 0.5:
                continue
            lengths = [v for v in row if v]
            times = min([int(carry + 0.5), *[int(left[v]) // lengths.count(v) for v in set(lengths)]])
            carry = min(carry - times, 1.0)
            if times:
                for v in lengths:
                    left[v] -= times
                out.append((tuple(lengths), times))
        if before - int(left.sum()) < before // 50:
            break
    there = np.flatnonzero(left).tolist()
    while there:
        lengths, room, used = [], max_len, {}
        while True:
            at = bisect_right(there, room) - 1
            while at >= 0 and used.get(there[at], 0) >= left[there[at]]:
                at -= 1
            if at < 0:
                break
            v = there[at]
            # as many of this length as fit and remain
            n = int(min(room // v, left[v] - used.get(v, 0)))
            lengths += [v] * n
            used[v] = used.get(v, 0) + n
            room -= v * n
        times = min(int(left[v]) // n for v, n in used.items())
        for v, n in used.items():
            left[v] -= times * n
            if not left[v]:
                there.remove(v)
        out.append((tuple(lengths), times))
    return out


def slots(made: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted: the r-th piece
    of a length has the last row at or below it, sequence first + (r - rank)."""
    rank, rows, first = {}, [], 0
    for lengths, times in made:
        offset = 0
        for v in lengths:
            rows.append((v, rank.get(v, 0), first, offset))
            rank[v] = rank.get(v, 0) + times
            offset += v
        first += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def pack(pieces: DataFrame, max_len: int = 4096, group_rows: int = 500_000) -> DataFrame:
    """``pieces`` (with ``length``, 1 to ``max_len``) plus sequence_id and offset
    (under other names if ``pieces`` has these).

    ``pieces`` must be a written table: it is read twice and its rows are told
    apart by their place in it. Equal rows are pieces of their own. What goes to the driver and to every task is the
    histogram and the plan made from it, whose size depends on ``max_len`` only.
    """
    counts = pieces.groupBy("length").count().collect()
    histogram = np.zeros(max_len + 1, dtype=np.int64)
    for r in counts:
        histogram[r["length"]] = r["count"]
    table = slots(plan(histogram, max_len))
    salts = max(16, int(histogram.sum()) // group_rows)
    row, salt, before, rank = fresh(pieces, "row", "salt", "before", "rank")
    salted = pieces.withColumn(row, F.monotonically_increasing_id())  # of a written table: always the same
    salted = salted.withColumn(salt, F.pmod(F.xxhash64(row), F.lit(salts)))
    sums = salted.groupBy("length", salt).count()
    sums = sums.select("length", salt, (F.sum("count").over(Window.partitionBy("length").orderBy(salt)) - F.col("count")).alias(before))
    local = F.row_number().over(Window.partitionBy("length", salt).orderBy(row))
    ranked = salted.withColumn(rank, local).join(sums, ["length", salt]).withColumn(rank, F.col(before) + F.col(rank) - 1)
    keep, new = pieces.columns, fresh(pieces, "sequence_id", "offset")
    shared = pieces.sparkSession.sparkContext.broadcast((table[:, 0] * (1 << 40) + table[:, 1], table))

    def run(batches):
        keys, t = shared.value
        at_length = keep.index("length")
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column(at_length).to_numpy(zero_copy_only=False).astype(np.int64)
            ranks = batch.column(len(keep)).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(keys, length * (1 << 40) + ranks, side="right") - 1
            placed = [pa.array(t[at, 2] + ranks - t[at, 1]), pa.array(t[at, 3])]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *placed], names=[*keep, *new])

    schema = StructType([*pieces.schema.fields, *[StructField(n, LongType()) for n in new]])
    return ranked.select(*keep, rank).mapInArrow(run, schema)


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_len: int = 4096, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    Null and empty texts are the end id alone; a null doc_id keeps its row;
    repeated rows are documents of their own; other columns are ignored; no
    rows give no rows.
    """
    return pack(written(tokenize_pieces(docs, doc_id, text, max_len, path, with_ids), "pieces"), max_len)


def op9_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    from pricelens.llm.common import table

    return pack_documents(table(spark, sf_dir, "documents"), with_ids=False)
