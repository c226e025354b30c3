"""Language ID by language-bitmask n-gram filters.

Learning: every text of a known language gives its letter n-grams (case folded,
other characters one blank); Spark sums them per (n-gram, language) over all
rows. An n-gram is in a language's set if it makes up at least ``min_share`` of
the language's n-grams and at least ``typical`` of its largest share in any
language. A set so holds at most 1/min_share n-grams whatever the input, and
the filter below is bounded by that and the number of languages.

Filter: a bit-sliced Bloom filter. Cell i holds a bitmask over languages; an
n-gram sets its languages' bits in ``hashes`` cells, and the AND of these cells
is the set of all languages that (seem to) contain it, in one look-up.

Decision: per language the number of a text's n-grams in its set, corrected for
the filter's false positives, (hits - p n) / (1 - p) with p the share of the
language's set cells to the power ``hashes``. The largest count decides (ties:
the language with more learned n-grams, then by name); the score is that count
over n, from 0 to 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import fresh, written

UNKNOWN = "und"
#: A letter's code in n-grams; 21 bits hold any code point, so three make an int64.
BITS = 21


class Letters:
    """Folds code points to lower-case letters and blanks."""

    def __init__(self):
        table = np.zeros(0x110000, dtype=np.int32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        self.table = table

    def grams(self, text: str | None, n: int) -> np.ndarray:
        """Codes of the n-grams of a text with blanks around its words; n is 1 to 3."""
        if not text:
            return np.zeros(0, dtype=np.int64)
        points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
        folded = self.table[points].astype(np.int64)
        folded = np.concatenate(([0], folded, [0]))
        folded = folded[np.concatenate(([True], (folded[1:] != 0) | (folded[:-1] != 0)))]
        if len(folded) < max(n, 2) or not folded.any():
            return np.zeros(0, dtype=np.int64)
        out = folded[: len(folded) - n + 1].copy()
        for i in range(1, n):
            out = out << BITS | folded[i : len(folded) - n + 1 + i]
        return out


_letters: list[Letters] = []


def letters() -> Letters:
    if not _letters:
        _letters.append(Letters())
    return _letters[0]


def count_ngrams(docs: DataFrame, text: str, lang: str, n: int) -> DataFrame:
    """(lang, gram, n) over all rows with a language; summed per batch, then by Spark."""

    def run(batches):
        for batch in batches:
            held: dict[str, list] = {}
            size = 0

            def flush():
                for name, parts in held.items():
                    grams, counts = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams)), pa.array(grams), pa.array(counts.astype(np.int64))], names=["lang", "gram", "n"])
                held.clear()

            for name, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                g = letters().grams(t.as_py(), n)
                if len(g):
                    held.setdefault(name, []).append(g)
                    size += len(g)
                    if size > 4_000_000:
                        yield from flush()
                        size = 0
            yield from flush()

    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    parts = rows.mapInArrow(run, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Filter:
    """Bit-sliced Bloom filter: (n-gram code) -> bitmask of languages, in as many
    mask words as the languages need."""

    def __init__(self, langs: list[str], masks: dict[int, int], bits: int, hashes: int, cells: np.ndarray | None = None, expected: dict[str, float] | None = None):
        self.langs, self.bits, self.hashes, self.expected = langs, bits, hashes, expected or {}
        kind, words = mask_words(len(langs))
        self.cells = np.zeros((words, 1 << bits), dtype=kind) if cells is None else cells
        if masks:
            grams = np.fromiter(masks, dtype=np.int64, count=len(masks))
            for w in range(words):
                values = np.array([m >> (64 * w) & (2**64 - 1) for m in masks.values()], dtype=np.uint64).astype(kind)
                for at in places(grams, bits, hashes):
                    np.bitwise_or.at(self.cells[w], at, values)
        full = np.array([float(((self.cells[i // 64] >> kind(i % 64)) & kind(1)).mean()) for i in range(len(langs))])
        self.wrong = full**hashes

    def languages(self, grams: np.ndarray) -> np.ndarray:
        """Masks of each n-gram (with several mask words: a row for each word)."""
        out = None
        for at in places(grams, self.bits, self.hashes):
            found = self.cells[:, at]
            out = found if out is None else out & found
        return out[0] if len(out) == 1 else out

    def decide(self, grams: np.ndarray, relative: bool = False) -> tuple[str, float]:
        n = len(grams)
        if not n or not self.langs:
            return UNKNOWN, 0.0
        found = self.languages(grams)
        if found.dtype == np.uint8:
            per_mask = np.bincount(found, minlength=256)
            hits = np.array([per_mask[[m for m in range(256) if m >> i & 1]].sum() for i in range(len(self.langs))], dtype=float)
        else:
            found = np.atleast_2d(found)
            hits = np.array([np.count_nonzero(found[i // 64] & np.uint64(1 << (i % 64))) for i in range(len(self.langs))], dtype=float)
        right = np.clip((hits - self.wrong * n) / np.maximum(1 - self.wrong, 1e-9), 0, n)
        best = int(np.argmax(right))
        share = float(right[best] / n)
        usual = self.expected.get(self.langs[best], 0.0) if relative else 0.0
        return self.langs[best], min(share / usual, 1.0) if usual else share


def mask_words(n_langs: int) -> tuple[type, int]:
    """Type of a mask word, and how many hold a bit for each language."""
    return (np.uint8, 1) if n_langs <= 8 else (np.uint64, -(-n_langs // 64))


def places(grams: np.ndarray, bits: int, hashes: int):
    """The cells of each n-gram, one array for each hash."""
    x = grams.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    step = (x * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(20) | np.uint64(1)
    for i in range(hashes):
        yield ((x + step * np.uint64(i)) & np.uint64((1 << bits) - 1)).astype(np.int64)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", n: int = 3, min_share: float = 1e-5, typical: float = 0.1, bits: int = 22, hashes: int = 3) -> Filter:
    """The filter learned from all rows with a language and a text.

    Languages (any number) are ordered by learned n-grams, then name. The cells
    are filled in Spark; what reaches the driver is their masks, ``2 ** bits``
    of them at most for every 64 languages, and a few numbers a language.
    """
    counts = written(count_ngrams(docs, text, lang, n), "ngrams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    names = [r["lang"] for r in sorted(totals.collect(), key=lambda r: (-r["total"], r["lang"]))]
    if not names:
        return Filter([], {}, 1, hashes)
    shares = counts.join(totals, "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("share"))
    best = shares.groupBy("gram").agg(F.collect_list(F.struct("lang", "share")).alias("all"), F.max("share").alias("best"))
    kept = best.select("gram", F.filter("all", lambda x: (x["share"] >= min_share) & (x["share"] >= typical * F.col("best"))).alias("in")).where(F.size("in") > 0)
    kept = written(kept, "ngram-languages")
    at = {name: i for i, name in enumerate(names)}
    kind, words = mask_words(len(names))

    def fill(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            grams, lists = batch.column(0).to_numpy(), batch.column(1)
            row = np.repeat(np.arange(len(grams)), pc.list_value_length(lists).to_numpy())
            number = np.array([at[x] for x in lists.flatten().to_pylist()], dtype=np.int64)
            cell = np.concatenate([place[row] for place in places(grams, bits, hashes)])
            word, bit = np.tile(number // 64, hashes), np.uint64(1) << np.tile(number % 64, hashes).astype(np.uint64)
            key = cell * words + word
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
            masks = np.bitwise_or.reduceat(bit[order], first).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key[order][first]), pa.array(masks)], names=["cell", "mask"])

    found = kept.select("gram", "in.lang").mapInArrow(fill, "cell long, mask long").groupBy("cell").agg(F.expr("bit_or(mask)").alias("mask")).toArrow()
    key, mask = found["cell"].to_numpy(), found["mask"].to_numpy().view(np.uint64)
    cells = np.zeros((words, 1 << bits), dtype=kind)
    cells[key % words, key // words] = mask.astype(kind)
    usual = kept.select(F.explode("in").alias("x")).groupBy("x.lang").agg(F.sum("x.share").alias("share"))
    return Filter(names, {}, bits, hashes, cells, {r["lang"]: r["share"] for r in usual.collect()})


def predict(docs: DataFrame, model: Filter, text: str = "text", n: int = 3, lang_pred: str = "lang_pred", score: str = "score", relative: bool = False) -> DataFrame:
    """``docs`` plus lang_pred and score (under other names if ``docs`` has these).

    Null texts and texts without a letter are ``und`` with score 0, and so is
    everything if nothing was learned. With ``relative`` the score is seen
    against what the language's own texts have (the share of their n-grams that
    was learned, which falls with scripts of many letters and with much text),
    at most 1. Whole texts count; rows, repeated ones too, and other columns
    stay; no rows give no rows.
    """
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    lang_pred, score = fresh(docs, lang_pred, score)
    names, at = [*docs.columns, lang_pred, score], docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        f = shared.value
        for batch in batches:
            said = [f.decide(letters().grams(t.as_py(), n), relative) for t in batch.column(at)]
            found = [pa.array([s for s, _ in said], pa.string()), pa.array([x for _, x in said], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=names)

    schema = StructType([*docs.schema.fields, StructField(lang_pred, StringType()), StructField(score, DoubleType())])
    return docs.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents kept from learning, by a checksum of the id; a null id is none of them."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    from pricelens.llm.common import table

    docs = table(spark, sf_dir, "documents")
    held = held_out()
    model = learn(docs.where(~held))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
