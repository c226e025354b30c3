"""Periodic runs of words, by suffix trees and Lyndon roots.

A run is a stretch of words that repeats with a smallest period q at least
``min_repeats`` times, holds at least ``min_words`` words, and that no
neighbouring word extends with the same period.

1. Every word of a run occurs ``min_repeats`` times in it. A word that is rarer
   between two such rare words cannot be in a run, so it cuts the text; this is
   repeated until nothing more is cut. Runs lie whole within the stretches left.
2. Each stretch and its reversal get a suffix tree (Ukkonen), whose Euler tour
   answers the longest common extension of two places in constant time: the
   least depth between two leaves.
3. The order of the leaves ranks all suffixes. The longest Lyndon word that
   begins at a place ends before the next smaller rank (in the reversed order
   of words: the next greater one). Every run has such a word as its root, so
   these at most two candidates a place, extended to both sides, give all runs.

Time and memory are linear in a text. Texts are whole rows, so the work is
dealt by Spark where the texts are read and nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.llm.common import fresh, table

#: Bytes of text whose words are held at once (a longer text is one block).
BLOCK_BYTES = 4_000_000
RUN_TYPE = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
NEAR = 16  # places of the tour that a block of the minimum table holds


def suffix_tree(s: list[int]) -> tuple[list[int], list[int], list[dict]]:
    """Ukkonen's tree of ``s``, whose last symbol occurs once: per node the
    start and end of its edge and its children by first symbol; node 0 is the root."""
    n = len(s)
    start, end, link, kids = [0], [0], [0], [{}]
    node = edge = length = open_suffixes = 0
    for i, c in enumerate(s):
        waiting = 0  # inner node of this step that still has no suffix link
        open_suffixes += 1
        while open_suffixes:
            if not length:
                edge = i
            child = kids[node].get(s[edge])
            if child is None:
                kids[node][s[edge]] = len(start)
                parent = node
            else:
                size = end[child] - start[child]
                if length >= size:
                    edge, length, node = edge + size, length - size, child
                    continue
                at = start[child] + length
                if s[at] == c:
                    length += 1
                    if waiting:
                        link[waiting] = node
                    break
                parent = len(start)
                kids[node][s[edge]] = parent
                start.append(start[child])
                end.append(at)
                link.append(0)
                start[child] = at
                kids.append({s[at]: child, c: parent + 1})
            start.append(i)
            end.append(n)
            link.append(0)
            kids.append({})
            if waiting:
                link[waiting] = parent
            waiting = parent
            open_suffixes -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - open_suffixes + 1
    return start, end, kids


def euler_tour(s: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Depth (in symbols) at each step of the tour of the tree of ``s``, and per
    suffix its leaf's step and its rank. Children are visited by first symbol."""
    start, end, kids = suffix_tree(s)
    n = len(s)
    depths, place, rank = [0], [0] * n, [0] * n
    path, ranks = [(iter(sorted(kids[0].values(), key=lambda k: s[start[k]])), 0)], 0
    while path:
        children, depth = path[-1]
        child = next(children, None)
        if child is None:
            path.pop()
            if path:
                depths.append(path[-1][1])
            continue
        below = depth + end[child] - start[child]
        if kids[child]:
            path.append((iter(sorted(kids[child].values(), key=lambda k: s[start[k]])), below))
        else:
            place[n - below], rank[n - below] = len(depths), ranks
            ranks += 1
            depths += (below, depth)
            continue
        depths.append(below)
    return np.array(depths, dtype=np.int64), np.array(place), np.array(rank)


class Extension:
    """Longest common extension of two suffixes of one sequence, for arrays of pairs."""

    def __init__(self, s: list[int]):
        depths, self.place, self.rank = euler_tour(s)
        blocks = -(-len(depths) // NEAR)
        self.depths = np.full((blocks + 1) * NEAR, np.iinfo(np.int64).max)
        self.depths[: len(depths)] = depths
        rows = self.depths[: blocks * NEAR].reshape(blocks, NEAR)
        self.from_left = np.minimum.accumulate(rows, axis=1).ravel()
        self.to_right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        self.levels = [rows.min(axis=1)]  # least of 1, 2, 4, ... blocks
        while len(last := self.levels[-1]) > (half := 1 << (len(self.levels) - 1)):
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.place[i], self.place[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        first, last = a // NEAR, b // NEAR
        out = np.minimum(self.to_right[a], self.from_left[b])
        near = np.flatnonzero(first == last)
        if len(near):
            window = a[near, None] + np.arange(NEAR)
            out[near] = np.where(window <= b[near, None], self.depths[window], np.iinfo(np.int64).max).min(axis=1)
        between = last - first - 1
        level = np.frexp(np.maximum(between, 1).astype(np.float64))[1] - 1
        for k in np.unique(level[between > 0]).tolist():
            at = np.flatnonzero((between > 0) & (level == k))
            least = self.levels[k]
            out[at] = np.minimum(out[at], np.minimum(least[first[at] + 1], least[last[at] - (1 << k)]))
        return out


def lyndon_ends(rank: list[int]) -> tuple[list[int], list[int]]:
    """Per place the next one of smaller rank and the next one of greater rank
    (the end, if none): where the longest Lyndon words of both orders end."""
    n = len(rank)
    smaller, greater = [n] * n, [n] * n
    up, down = [], []
    for j, r in enumerate(rank):
        while up and rank[up[-1]] > r:
            smaller[up.pop()] = j
        while down and rank[down[-1]] < r:
            greater[down.pop()] = j
        up.append(j)
        down.append(j)
    return smaller, greater


def runs_of(s: np.ndarray, min_words: int, min_repeats: int) -> np.ndarray:
    """(start, length, period) rows of all runs of a sequence of non-negative numbers."""
    n = len(s)
    if n < max(min_words, min_repeats):
        return np.zeros((0, 3), dtype=np.int64)
    ahead = Extension([*(s + 1).tolist(), 0])
    smaller, greater = lyndon_ends(ahead.rank[:n].tolist())
    place = np.arange(n)
    i = np.concatenate([place, place])
    period = np.concatenate([smaller, greater]) - i
    fits = (period * min_repeats <= n) & (i + period < n)
    i, period = i[fits], period[fits]
    same = s[i] == s[i + period]
    i, period = i[same], period[same]
    if not len(i):
        return np.zeros((0, 3), dtype=np.int64)
    back = Extension([*(s[::-1] + 1).tolist(), 0])
    left = back(n - i, n - i - period)
    length = left + period + ahead(i, i + period)
    long = length >= np.maximum(min_words, min_repeats * period)
    return np.unique(np.stack([i - left, length, period], axis=1)[long], axis=0)


def stretches(words: np.ndarray, text: np.ndarray, min_words: int, min_repeats: int) -> list[tuple[int, int]]:
    """Start and end of what can hold runs: cut at words that are too rare in
    their stretch (at first: in their ``text``) until none is."""
    at = np.arange(len(words))
    part = text
    while len(at):
        _, inverse, count = np.unique(part * (int(words.max()) + 1) + words[at], return_inverse=True, return_counts=True)
        keep = count[inverse] >= min_repeats
        at, group = at[keep], part[keep]
        if not len(at):
            break
        new = np.concatenate([[True], (np.diff(at) > 1) | (np.diff(group) != 0)])
        part = np.cumsum(new) - 1
        big = np.bincount(part)[part] >= min_words
        if keep.all() and big.all():
            first = np.flatnonzero(new)
            return list(zip(at[first].tolist(), (at[np.append(first[1:], len(at)) - 1] + 1).tolist()))
        at, part = at[big], part[big]
    return []


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _block(texts: list[bytes], min_words: int, min_repeats: int) -> tuple[list[list[dict]], list[bytes]]:
    """Runs and collapsed text of each text."""
    words = [t.split() for t in texts]  # bytes split at exactly \x20 and \x09-\x0D
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    numbers = _Numbers()
    ids = np.fromiter((numbers[w] for doc in words for w in doc), dtype=np.int64, count=int(sizes.sum()))
    text = np.repeat(np.arange(len(texts)), sizes)
    begin = np.cumsum(sizes) - sizes
    found: dict[int, list] = {}
    for lo, hi in stretches(ids, text, min_words, min_repeats):
        _, dense = np.unique(ids[lo:hi], return_inverse=True)
        runs = runs_of(dense, min_words, min_repeats)
        if len(runs):
            doc = int(text[lo])
            found.setdefault(doc, []).extend((runs + [lo - begin[doc], 0, 0]).tolist())
    out, collapsed = [], []
    for doc, w in enumerate(words):
        rows = sorted(found.get(doc, ()), key=lambda r: (r[0], r[2]))
        if rows:
            drop = np.zeros(len(w) + 1, dtype=np.int64)
            for start, length, period in rows:
                drop[start + period] += 1
                drop[start + length] -= 1
            w = [w[k] for k in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]
        out.append([{"start": a, "length": b, "period": c} for a, b, c in rows])
        collapsed.append(b" ".join(w))
    return out, collapsed


def find_runs(docs: DataFrame, text_col: str = "text", min_words: int = 6, min_repeats: int = 4, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with two more columns (the last two; renamed if their names are
    taken): ``runs``, an array of (start, length, period) by start, then period,
    and ``collapsed``, the words that stay, joined by one space.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A word goes if any run
    holds it after that run's first ``period`` words. A null, empty or blank
    text has no runs and an empty ``collapsed``. Repeated rows, null ids and
    other columns pass through; an empty table gives an empty table.
    """
    if min_repeats < 2 or min_words < 1:
        raise ValueError("a run repeats at least twice")
    runs_name, collapsed_name = fresh(docs, "runs", "collapsed")
    schema = T.StructType([*docs.schema.fields, T.StructField(runs_name, RUN_TYPE), T.StructField(collapsed_name, T.StringType())])
    at = docs.columns.index(text_col)
    runs_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def search(batches):
        for batch in batches:
            column = batch.column(at)
            lo = 0
            while lo < batch.num_rows:
                texts, n, hi = [], 0, lo
                while hi < batch.num_rows and (hi == lo or n < block_bytes):
                    t = (column[hi].as_py() or "").encode()
                    texts.append(t)
                    n += len(t)
                    hi += 1
                runs, collapsed = _block(texts, min_words, min_repeats)
                part = batch.slice(lo, hi - lo)
                arrays = [*part.columns, pa.array(runs, runs_type), pa.array([c.decode() for c in collapsed], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, runs_name, collapsed_name])
                lo = hi

    return docs.mapInArrow(search, schema)


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the contract's periodic texts: where h % 10 = 0, word
    i >= a becomes word a + (i - a) % p (h, a and p from the id's CRC-32)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    d = docs.select("doc_id", "text", h.alias("h"))
    d = d.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w"))
    d = d.withColumn("g", F.floor(F.col("h") / 10))
    d = d.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    d = d.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    copies = F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int"))
    made = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(F.flatten(copies), F.lit(1), rest))
    return d.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(made, " ")).alias("text"))


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of every document, after the contract's repeats are put in."""
    found = find_runs(with_repeats(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), lines.alias("lines"), "collapsed")
    length, period = F.col("b.l"), -F.col("b.p")
    return out.select(
        "doc_id", "n_runs", (-F.col("b.s")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join("lines", ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
