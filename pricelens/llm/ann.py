"""Nearest neighbours by a forest of random-projection trees.

The trees are fitted on a bounded sample of rows (``sample_rows``): each node
splits its sample at the median of a projection onto the difference of two of
them. Every row is then sent to its leaf in every tree. A query walks all trees
through one priority queue (the next node is the one whose split planes lie
nearest) until the leaves it has taken hold ``search_share`` of the sample, and
``search_least`` rows of it (small tables are searched whole). In the leaves the queries meet the rows, and exact distances rank them; a leaf
whose rows would exceed ``leaf_rows`` is dealt into parts and its queries are
sent to each. Per query and leaf at most k rows go on, so no list grows with
the leaf.

High-dimensional vectors without clusters have no near and far leaves: the
share to search for a recall of 0.9 is then large whatever the index; it is a
parameter, set for that case.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import usable_vectors, written


def matrix(column) -> np.ndarray:
    """Rows of an Arrow list column as a float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(len(column), -1)


def sample_matrix(rows: DataFrame, n: int, limit: int) -> np.ndarray:
    """About ``limit`` vectors of (id, v), chosen by a hash of the id (all, if there are fewer), in id order."""
    share = min(1.0, limit / max(n, 1))
    some = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 53)) < math.ceil(share * (1 << 53)))
    t = some.toArrow()
    m = matrix(t.column("v"))
    return m[np.argsort(t.column("id").to_numpy(), kind="stable")]


class Tree:
    """planes: a row for each inner node, left/right: children (inner: >= 0, leaf i: -1 - i)."""

    def __init__(self, x: np.ndarray, leaf: int, rng: np.random.Generator):
        self.planes, self.offsets, self.left, self.right, self.members = [], [], [], [], []
        self.root = self._grow(x, np.arange(len(x)), leaf, rng)
        self.planes = np.array(self.planes).reshape(len(self.left), x.shape[1])

    def _leaf(self, idx) -> int:
        self.members.append(idx)
        return -len(self.members)

    def _grow(self, x, idx, leaf, rng) -> int:
        if len(idx) <= leaf:
            return self._leaf(idx)
        for _ in range(8):  # two equal picks, or a median that all share, do not split
            a, b = rng.choice(idx, 2, replace=False)
            w = x[a] - x[b]
            norm = np.sqrt(w @ w)
            if norm == 0:
                continue
            w = w / norm
            p = x[idx] @ w
            cut = np.median(p)
            low = p <= cut
            if not low.all():
                break
        else:
            return self._leaf(idx)
        at = len(self.left)
        self.planes.append(w)
        self.offsets.append(cut)
        self.left.append(0)
        self.right.append(0)
        self.left[at] = self._grow(x, idx[low], leaf, rng)
        self.right[at] = self._grow(x, idx[~low], leaf, rng)
        return at

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf number of each row."""
        out, todo = np.zeros(len(x), dtype=np.int64), [(self.root, np.arange(len(x)))]
        while todo:
            node, idx = todo.pop()
            if node < 0:
                out[idx] = -1 - node
            elif len(idx):
                low = x[idx] @ self.planes[node] <= self.offsets[node]
                todo += [(self.left[node], idx[low]), (self.right[node], idx[~low])]
        return out


class Forest:
    def __init__(self, x: np.ndarray, trees: int, leaf: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.n = len(x)
        self.trees = [Tree(x, leaf, rng) for _ in range(trees)] if len(x) else []
        sizes = [len(t.members) for t in self.trees]
        self.first = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)  # number of a tree's first leaf

    def sizes(self) -> np.ndarray:
        return np.array([len(m) for t in self.trees for m in t.members], dtype=np.int64)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): leaf numbers, counted through all trees."""
        return np.stack([t.leaves(x) + f for t, f in zip(self.trees, self.first)], 1)

    def search(self, q: np.ndarray, share: float, at_least: int) -> list[int]:
        """Leaves taken in the order of one queue through all trees, until they
        hold that share of the sample, and that many of it, or all of it."""
        sides = [t.planes @ q - np.array(t.offsets) for t in self.trees]
        queue = [(0.0, i, t.root) for i, t in enumerate(self.trees)]
        heapq.heapify(queue)
        got, enough, out = np.zeros(self.n, dtype=bool), min(self.n, max(share * self.n, at_least)), []
        have = 0
        while queue and have < enough:
            far, i, node = heapq.heappop(queue)
            t = self.trees[i]
            while node >= 0:
                s = sides[i][node]
                near, other = (t.left[node], t.right[node]) if s <= 0 else (t.right[node], t.left[node])
                heapq.heappush(queue, (max(far, abs(s)), i, other))
                node = near
            out.append(int(self.first[i]) - 1 - node)
            got[t.members[-1 - node]] = True
            have = int(got.sum())
        return out


def nearest(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, k: int):
    """Per query the k nearest rows but its own: (query_id, vec_id, distance), ties to smaller ids."""
    xx = (x * x).sum(1)
    for i in range(0, len(q), 256):
        qb, qi = q[i : i + 256], qids[i : i + 256]
        rough = xx[None, :] - 2 * (qb @ x.T) + (qb * qb).sum(1)[:, None]
        rough[qi[:, None] == ids[None, :]] = np.inf
        kth = np.partition(rough, min(k, rough.shape[1]) - 1, axis=1)[:, min(k, rough.shape[1]) - 1]
        slack = 1e-9 * (1 + xx.max() + (qb * qb).sum(1))
        for j in range(len(qb)):
            near = np.flatnonzero((rough[j] <= kth[j] + slack[j]) & np.isfinite(rough[j]))
            d = np.sqrt(((x[near] - qb[j]) ** 2).sum(1))
            order = np.lexsort((ids[near], d))[:k]
            yield np.full(len(order), qi[j]), ids[near][order], d[order]


def search(
    vectors: DataFrame,
    queries: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = 10,
    trees: int = 8,
    leaf: int = 128,
    sample_rows: int = 16_384,
    search_share: float = 0.65,
    search_least: int = 2048,
    leaf_rows: int = 20_000,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row of
    ``queries`` (same columns as ``vectors``), Euclidean, nearest first, ties to
    smaller ids.

    Vectors that are null, zero, not finite, or not of the table's common length
    take no part, nor rows with a null id. Rows with the query's own id are no
    candidates; of rows with one id the nearest counts. Other columns are
    ignored; no rows give no rows.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[vector].dataType.simpleString()
    part = lambda df: usable_vectors(df, vec_id, vector).withColumn("v", F.col("v").cast(kind))
    rows = written(part(vectors), "ann-rows")
    most = F.max(F.aggregate("v", F.lit(0.0).cast("double"), lambda m, x: F.greatest(m, F.abs(x).cast("double"))))
    n, largest = rows.agg(F.count("*"), most).first()
    # squares of such values would overflow: all are worked at a power of two of their size, which is exact
    scale = 2.0 ** -math.frexp(largest)[1] if n and largest > 1e140 else 1.0
    if scale != 1.0:
        kind = "array<double>"
        scaled = F.transform("v", lambda x: x.cast("double") * F.lit(scale))
        rows = written(rows.withColumn("v", scaled), "ann-rows")
    empty = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], empty)
    forest = Forest(sample_matrix(rows, n, sample_rows), trees, leaf)
    if not forest.n:  # so few rows that the hash chose none
        forest = Forest(matrix(rows.limit(sample_rows).toArrow().column("v")), trees, leaf)
    width = forest.trees[0].planes.shape[1]
    parts = np.maximum(1, np.ceil(forest.sizes() * (n / forest.n) / leaf_rows)).astype(np.int64)
    shared = spark.sparkContext.broadcast((forest, parts))

    def place(batches):
        f, split = shared.value
        for batch in batches:
            x = matrix(batch.column(1))
            if not len(x):
                continue
            at = f.leaves(x)
            take = np.repeat(np.arange(len(x)), at.shape[1])
            ids = batch.column(0).to_numpy()[take]
            cell = at.ravel()
            share = ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
            dealt = (share % split[cell].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(dealt), pa.array(ids), batch.column(1).take(pa.array(take))], names=["cell", "part", "id", "v"])

    def ask(batches):
        f, split = shared.value
        for batch in batches:
            x = matrix(batch.column(1))
            for i in range(len(x)):
                cells = np.array(f.search(x[i], search_share, max(search_least, 16 * (k + 1))), dtype=np.int64)
                cell = np.repeat(cells, split[cells])
                dealt = np.concatenate([np.arange(split[c]) for c in cells]) if len(cells) else cells
                one = batch.slice(i, 1)
                take = pa.array(np.zeros(len(cell), dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(dealt), one.column(0).take(take), one.column(1).take(take)], names=["cell", "part", "id", "v"])

    schema = f"cell long, part long, id long, v {kind}"
    asked = part(queries).where(F.size("v") == width)
    if scale != 1.0:
        asked = asked.withColumn("v", scaled)
    asked = asked.mapInArrow(ask, schema)

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            found = list(nearest(left.column("id").to_numpy(), matrix(left.column("v")), right.column("id").to_numpy(), matrix(right.column("v")), k))
        q, i, d = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"query_id": q, "vec_id": i, "score": d})

    near = rows.mapInArrow(place, schema).groupBy("cell", "part").cogroup(asked.groupBy("cell", "part")).applyInArrow(rank, "query_id long, vec_id long, score double")
    best = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    lists = best.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, k).alias("found"))
    return lists.select("query_id", F.posexplode("found").alias("pos", "f")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), "f.vec_id", (F.col("f.score") / scale if scale != 1.0 else F.col("f.score")).alias("score")
    )


def op3_ann_search(spark, sf_dir: str) -> DataFrame:
    from pricelens.llm.common import table

    rows = table(spark, sf_dir, "embeddings")
    return search(rows, rows.where("vec_id % 100 = 0"))
