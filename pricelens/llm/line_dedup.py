"""Line dedup over a sharded minimal perfect hash.

1. Every text gives the distinct 128-bit hashes of its eligible lines.
2. Per distinct hash: number of documents and the largest doc_id. Both counts
   are summed on the map side first, so a line of a third of all documents is
   no hot key.
3. Distinct hashes are dealt into shards of about ``shard_size``; each shard
   becomes one row: a minimal perfect hash (bit levels), and arrays of 32-bit
   fingerprints, counts and largest ids at its slots. The rows are written to
   the shared folder.
4. Documents' hashes are sent to their shard and probe its arrays; texts and
   lines are not joined. A shard that many documents probe (a hot line) is
   copied to as many tasks as its probes need (``probe_size`` each).
5. The hashes that a document loses are joined back by doc_id and the text is
   rewritten.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import fresh, written

BLANKS = " \t\n\x0b\x0c\r"
ODD = [(2 * i + 1) * 0x9E3779B97F4A7C15 | 1 for i in range(64)]
NULL_ID = -(2**63)


def line_digest(line: str, min_chars: int) -> bytes | None:
    """16 bytes of an eligible line's key, else None."""
    import xxhash

    key = line.strip(BLANKS)
    return xxhash.xxh3_128_digest(key.encode("utf-8", "replace").lower()) if len(key) >= min_chars else None


def _place(h1: np.ndarray, h2: np.ndarray, level: int, m: int) -> np.ndarray:
    x = h1 + h2 * np.uint64(ODD[level] % 2**64)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return (x % np.uint64(m)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash of distinct (h1, h2): per level a bit marks each
    place that one key alone takes; the others go on to the next level. A key's
    slot is the number of marks before its own."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words).astype(np.int64))))
        self.starts = np.concatenate(([0], np.cumsum(sizes)))

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray, gamma: float = 1.5) -> PerfectHash:
        sizes, parts = [], []
        while len(h1):
            if len(sizes) >= len(ODD):
                raise ValueError("keys are not distinct")
            m = -(-int(gamma * len(h1) + 64) // 64) * 64
            at = _place(h1, h2, len(sizes), m)
            alone = np.bincount(at, minlength=m) == 1
            sizes.append(m)
            parts.append(np.packbits(alone, bitorder="little"))
            left = ~alone[at]
            h1, h2 = h1[left], h2[left]
        bits = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        return cls(np.array(sizes, dtype=np.int64), bits.view("<u8"))

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where no level has a mark for it."""
        out, todo = np.full(len(h1), -1, dtype=np.int64), np.arange(len(h1))
        for level, m in enumerate(self.sizes.tolist()):
            at = _place(h1[todo], h2[todo], level, m) + self.starts[level]
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            value = self.words[word]
            hit = (value >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(value & ((np.uint64(1) << bit) - np.uint64(1)))
            out[todo[hit]] = (self.before[word] + below)[hit]
            todo = todo[~hit]
        return out


def line_hashes(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """(h1, h2, doc): distinct eligible line hashes of each row; doc is NULL_ID for a null id."""

    def run(batches):
        for batch in batches:
            found, docs_of = [], []
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = {d for line in (t.as_py() or "").split("\n") if (d := line_digest(line, min_chars))}
                found.extend(own)
                docs_of.append((doc, len(own)))
            h = np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 2)
            ids = np.repeat(np.array([d for d, _ in docs_of], dtype=np.int64), [n for _, n in docs_of])
            yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(ids)], names=["h1", "h2", "doc"])

    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("doc"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "h1 long, h2 long, doc long")


def build_shards(index: DataFrame, n_shards: int) -> DataFrame:
    """One row per shard of (h1, h2, n, last): the perfect hash, its arrays, and the shard's number of probes."""
    schema = "shard int, sizes binary, bits binary, fps binary, counts binary, lasts binary, probes long"

    def one(shard: int, h1, h2, n, last):
        mph = PerfectHash.build(h1, h2)
        at = mph.slots(h1, h2)
        fps, counts, lasts = np.empty(len(at), "<u4"), np.empty(len(at), "<u4"), np.empty(len(at), "<i8")
        fps[at], counts[at], lasts[at] = h2 >> np.uint64(32), np.minimum(n, 2**32 - 1), last
        blobs = [x.tobytes() for x in (mph.sizes.astype("<i8"), mph.words, fps, counts, lasts)]
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), *[pa.array([b], pa.binary()) for b in blobs], pa.array([int(n.sum())])], names=["shard", "sizes", "bits", "fps", "counts", "lasts", "probes"])

    def run(batches):
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(cols[0])) + 1, [len(cols[0])]))
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = [c[a:b] for c in cols]
                if held and held[0][0][0] != part[0][0]:
                    yield finish(held)
                    held = []
                held.append(part)
        if held:
            yield finish(held)

    def finish(held):
        shard, h1, h2, n, last = [np.concatenate(x) for x in zip(*held)]
        return one(int(shard[0]), h1.view(np.uint64), h2.view(np.uint64), n, last)

    rows = index.select(F.pmod("h1", F.lit(n_shards)).cast("int").alias("shard"), "h1", "h2", "n", "last")
    return rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, schema)


def probe(hashes: DataFrame, shards: DataFrame, n_shards: int, min_docs: int, probe_size: int) -> DataFrame:
    """(doc, h1, h2) of lines to drop: found in ``min_docs`` documents, and doc is not the largest of them."""
    copies = F.greatest(F.ceil(F.col("probes") / probe_size), F.lit(1)).cast("int")
    asked = (
        hashes.withColumn("shard", F.pmod("h1", F.lit(n_shards)).cast("int"))
        .join(shards.select("shard", copies.alias("copies")), "shard")
        .select("shard", F.pmod(F.xxhash64("doc"), F.col("copies")).cast("int").alias("copy"), "h1", "h2", "doc")
    )
    sent = shards.select("shard", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"), "sizes", "bits", "fps", "counts", "lasts")

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        h1, h2, doc = (left.column(c).to_numpy() for c in ("h1", "h2", "doc"))
        if not len(h1) or not right.num_rows:
            return pa.table({"doc": pa.array([], pa.int64()), "h1": pa.array([], pa.int64()), "h2": pa.array([], pa.int64())})
        get = lambda c, t: np.frombuffer(right.column(c)[0].as_py(), dtype=t)
        fps, counts, lasts = get("fps", "<u4"), get("counts", "<u4"), get("lasts", "<i8")
        at = PerfectHash(get("sizes", "<i8"), get("bits", "<u8")).slots(h1.view(np.uint64), h2.view(np.uint64))
        known = (at >= 0) & (fps[at] == (h2.view(np.uint64) >> np.uint64(32)).astype(np.uint32))
        lost = known & (counts[at] >= min_docs) & (lasts[at] != doc)
        return pa.table({"doc": doc[lost], "h1": h1[lost], "h2": h2[lost]})

    return asked.groupBy("shard", "copy").cogroup(sent.groupBy("shard", "copy")).applyInArrow(look, "doc long, h1 long, h2 long")


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    shard_size: int = 262_144,
    probe_size: int = 1_000_000,
) -> DataFrame:
    """``docs`` with rewritten texts, plus ``n_lines`` (before) and ``n_dropped``
    (under other names if ``docs`` has these).

    Null and empty texts are one empty line and stay as they are. Rows with the
    same doc_id are one document; rows with a null doc_id are one document below
    all others. Other columns are kept; no rows give no rows.
    """
    hashes = written(line_hashes(docs, doc_id, text, min_chars).distinct(), "line-hashes")
    index = written(hashes.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc").alias("last")), "line-index")
    n_shards = max(1, -(-index.count() // shard_size))
    shards = written(build_shards(index, n_shards), "line-shards")
    lost = probe(hashes, shards, n_shards, min_docs, probe_size)
    doc_name, lost_name, n_lines, n_dropped = fresh(docs, "lost_doc", "lost", "n_lines", "n_dropped")
    per_doc = lost.groupBy(F.col("doc").alias(doc_name)).agg(F.collect_list(F.struct("h1", "h2")).alias(lost_name))
    joined = docs.join(per_doc, F.coalesce(docs[doc_id].cast("long"), F.lit(NULL_ID)) == F.col(doc_name), "left").drop(doc_name)
    at, names = docs.columns.index(text), [*docs.columns, n_lines, n_dropped]

    def rewrite(batches):
        for batch in batches:
            columns, texts, before, gone = list(batch.columns), [], [], []
            for t, lost_keys in zip(batch.column(at), batch.column(len(columns) - 1)):
                s, keys = t.as_py(), lost_keys.as_py()
                n = (s or "").count("\n") + 1
                before.append(n)
                if keys:
                    drop = {np.array([k["h1"], k["h2"]], dtype="<i8").tobytes() for k in keys}
                    kept = [line for line in s.split("\n") if line_digest(line, min_chars) not in drop]
                    gone.append(n - len(kept))
                    s = "\n".join(kept)
                else:
                    gone.append(0)
                texts.append(s)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns[:-1] + [pa.array(before, pa.int64()), pa.array(gone, pa.int64())], names=names)

    return joined.mapInArrow(rewrite, _schema(docs, n_lines, n_dropped))


def _schema(docs: DataFrame, *longs: str):
    from pyspark.sql.types import LongType, StructField, StructType

    return StructType([*docs.schema.fields, *[StructField(n, LongType()) for n in longs]])


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    from pricelens.llm.common import table

    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
h AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
d AS (SELECT k.*, coalesce(last != doc_id, false) AS lost FROM k LEFT JOIN h USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""
