"""Embedding near-duplicates by robust-pruned flat graphs.

1. Equal vectors are one class, whatever their number.
2. Centroids are fitted on a bounded sample, near ones joined (a dense group is
   not cut up). Every vector goes to the shards of its ``overlap`` nearest ones;
   a shard of more than ``part_rows`` vectors is dealt into parts, and each part
   meets each, so no group of rows grows with a shard.
3. In each shard a flat graph of its members is built: near candidates of a
   vector, robust pruned (a candidate goes when a kept one is ``alpha`` times
   nearer to it), with the reverse edges added.
4. Every member is searched for in it: greedy with a beam from the medoid and its
   own node, then every vector in range is expanded until no other is found.
   A pair counts in the first of the shards that both are in.
5. The lists of a vector's neighbours in range, of all its shards, are united
   (only where two neighbours differ in their shards). Range expansion goes on
   over them in rounds: neighbours of what is in range that share no shard with
   the query are verified, written and expanded again, until no link is new.
6. Cosines are double precision of the original vectors, so what is linked is
   verified. A task sends back numbers of links, spanning stars and such lists,
   never all pairs.
7. Every pass is audited: bounded samples of vectors with no, few and many links
   found are compared with brute force, vector by vector. Below ``min_recall``
   in any of them the whole is done again with a wider beam and twice the
   overlap, at last with all members of a shard in place of the graph and four
   times the overlap; if that is not enough, it is an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.ann import matrix, sample_matrix
from pricelens.llm.common import drop_written, usable_vectors, written
from pricelens.llm.components import components
from pricelens.llm.stars import Stars


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (first to 1 in the largest component, which keeps squares finite)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_centroids(x: np.ndarray, k: int, rounds: int = 6, seed: int = 0) -> np.ndarray:
    """Spherical k-means on unit rows."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = np.concatenate([np.argmax(x[i : i + 4096] @ c.T, axis=1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        norm = np.sqrt((sums * sums).sum(1, keepdims=True))
        c = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), c)
    return c


def build_graph(u: np.ndarray, pool: int = 48, degree: int = 24, alpha: float = 1.2) -> tuple[np.ndarray, np.ndarray]:
    """Directed edges (a, b) of the robust-pruned graph over unit rows, reverse edges added."""
    n = len(u)
    pool = min(pool, n - 1)
    if pool < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    out_a, out_b = [], []
    for i in range(0, n, 256):
        s = u[i : i + 256] @ u.T
        rows = np.arange(len(s))
        s[rows, i + rows] = -2
        cand = np.argpartition(-s, pool - 1, axis=1)[:, :pool]
        near = np.take_along_axis(s, cand, 1)
        order = np.argsort(-near, axis=1, kind="stable")
        cand, near = np.take_along_axis(cand, order, 1), np.take_along_axis(near, order, 1)
        vec = u[cand]
        own = np.sqrt(np.maximum(2 - 2 * near, 0))
        between = np.sqrt(np.maximum(2 - 2 * np.matmul(vec, vec.transpose(0, 2, 1)), 0))
        alive, kept = np.ones(cand.shape, dtype=bool), np.zeros(cand.shape, dtype=bool)
        for j in range(pool):
            take = alive[:, j] & (kept.sum(1) < degree)
            kept[take, j] = True
            alive &= ~(take[:, None] & (alpha * between[:, j] <= own))
        a, j = np.nonzero(kept)
        out_a.append(a + i)
        out_b.append(cand[a, j])
    a, b = np.concatenate(out_a), np.concatenate(out_b)
    both = np.unique(np.concatenate([a * n + b, b * n + a]))
    return both // n, both % n


def _spread(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges starts..ends: (which range, position), range by range."""
    size = ends - starts
    which = np.repeat(np.arange(len(size)), size)
    return which, np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + starts[which]


def range_search(u, a, b, medoid, queries, own, cosine, beam, add, block=256):
    """Nodes with at least that cosine to each query, but its ``own`` node (-1: none).

    Edges (a, b) sorted by a; ``add(query indices, nodes)`` gets what is found, each pair once.
    """
    n = len(u)
    first = np.searchsorted(a, np.arange(n + 1))
    for i in range(0, len(queries), block):
        q, mine = queries[i : i + block], own[i : i + block]
        m = len(q)
        seen = np.zeros((m, n), dtype=bool)
        beam_node = np.full((m, beam), -1, dtype=np.int64)
        beam_sim = np.full((m, beam), -9.0)
        beam_done = np.ones((m, beam), dtype=bool)
        found_q, found_n = [], []

        def meet(qi, node):
            """New (query, node) pairs, their cosines; keeps those in range."""
            key = np.unique(qi * n + node)
            qi, node = key // n, key % n
            new = ~seen[qi, node]
            qi, node = qi[new], node[new]
            seen[qi, node] = True
            sim = np.concatenate([np.einsum("ij,ij->i", q[qi[k : k + 65536]], u[node[k : k + 65536]]) for k in range(0, len(qi), 65536)] or [np.zeros(0)])
            hit = sim >= cosine
            found_q.append(qi[hit])
            found_n.append(node[hit])
            return qi, node, sim

        def into_beam(qi, node, sim):
            rows = np.unique(qi)
            allq = np.concatenate([np.repeat(rows, beam), qi])
            alln = np.concatenate([beam_node[rows].ravel(), node])
            alls = np.concatenate([beam_sim[rows].ravel(), sim])
            alld = np.concatenate([beam_done[rows].ravel(), np.zeros(len(qi), dtype=bool)])
            order = np.lexsort((-alls, allq))
            allq, alln, alls, alld = allq[order], alln[order], alls[order], alld[order]
            starts = np.searchsorted(allq, rows)
            take = starts[:, None] + np.arange(beam)
            beam_node[rows], beam_sim[rows], beam_done[rows] = alln[take], alls[take], alld[take]

        known = np.flatnonzero(mine >= 0)
        start_q = np.concatenate([np.arange(m), known])
        start_n = np.concatenate([np.full(m, medoid), mine[known]])
        into_beam(*meet(start_q, start_n))
        while True:
            open_ = np.where(beam_done, -9.0, beam_sim)
            pick = np.argmax(open_, axis=1)
            rows = np.flatnonzero(open_[np.arange(m), pick] > -9)
            if not len(rows):
                break
            beam_done[rows, pick[rows]] = True
            node = beam_node[rows, pick[rows]]
            which, at = _spread(first[node], first[node + 1])
            qi, nb, sim = meet(rows[which], b[at])
            if len(qi):
                into_beam(qi, nb, sim)
        # range expansion: every node in range gives all its neighbours
        done = 0
        while done < len(found_q):
            qi, node = np.concatenate(found_q[done:]), np.concatenate(found_n[done:])
            done = len(found_q)
            for k in range(0, len(qi), 20_000):
                which, at = _spread(first[node[k : k + 20_000]], first[node[k : k + 20_000] + 1])
                if len(which):
                    meet(qi[k : k + 20_000][which], b[at])
            if not sum(map(len, found_q[done:])):
                break
        qi, node = np.concatenate(found_q), np.concatenate(found_n)
        other = node != mine[qi]
        add(i + qi[other], node[other])


def scan(u, queries, own, cosine, add, block=256):
    """As range_search, but by looking at every node."""
    for i in range(0, len(queries), block):
        hit = queries[i : i + block] @ u.T >= cosine
        known = np.flatnonzero(own[i : i + block] >= 0)
        hit[known, own[i : i + block][known]] = False
        q, node = np.nonzero(hit)
        if len(q):
            add(i + q, node)


def apart(c: np.ndarray, cosine: float) -> np.ndarray:
    """Centroids of which no two are nearer than that, so that a dense group is
    not cut up: of two near ones the first stays."""
    kept: list[int] = []
    for i in range(len(c)):
        if not kept or (c[kept] @ c[i]).max() < cosine:
            kept.append(i)
    return c[kept]


def first_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per pair of rows of ascending numbers, the least number in both (-1: none)."""
    out = np.full(len(a), -1, dtype=a.dtype)
    for i in range(0, len(a), 65_536):
        both = (a[i : i + 65_536, :, None] == b[i : i + 65_536, None, :]).any(axis=2)
        at = both.argmax(axis=1)
        rows = np.arange(len(both))
        out[i : i + 65_536] = np.where(both[rows, at], a[i : i + 65_536][rows, at], -1)
    return out


def near_edges(u: np.ndarray, a: np.ndarray, b: np.ndarray, cosine: float, degree: int = 24) -> tuple[np.ndarray, np.ndarray]:
    """Of a graph's edges those in range, at most ``degree`` (the nearest) a node."""
    sim = np.concatenate([np.einsum("ij,ij->i", u[a[k : k + 65_536]], u[b[k : k + 65_536]]) for k in range(0, len(a), 65_536)] or [np.zeros(0)])
    a, b, sim = a[sim >= cosine], b[sim >= cosine], sim[sim >= cosine]
    order = np.lexsort((-sim, a))
    a, b = a[order], b[order]
    place = np.arange(len(a)) - np.searchsorted(a, a)
    return a[place < degree], b[place < degree]


LINK_SCHEMA = "a long, b long, n long, cell int, a_cells array<int>, b_cells array<int>"


def _links(classes: DataFrame, n: int, cosine: float, beam: int | None, overlap: int, shard_rows: int, part_rows: int, sample_rows: int, max_shards: int):
    """Written (a, b, n): b null: class a has n linked vectors more; else a star link. No beam: all nodes are looked at."""
    spark = classes.sparkSession
    k = int(min(max_shards, max(1, -(-n * overlap // shard_rows))))
    x = sample_matrix(classes.select("id", "v"), n, sample_rows)
    if not len(x):
        x = matrix(classes.limit(sample_rows).toArrow().column("v"))
    centroids = apart(fit_centroids(unit(x), k), min(cosine, np.cos(1.5 * np.arccos(cosine))))
    shared, overlap = spark.sparkContext.broadcast(centroids), min(overlap, len(centroids))
    kind = classes.schema["v"].dataType.simpleString()

    def assign(batches):
        c = shared.value
        for batch in batches:
            x = matrix(batch.column(1))
            for i in range(0, len(x), 1024):
                s = unit(x[i : i + 1024]) @ c.T
                cells = np.sort(np.argpartition(-s, overlap - 1, axis=1)[:, :overlap], axis=1).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(s) + 1) * overlap, pa.int32()), pa.array(cells.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.slice(i, 1024).columns, lists], names=["id", "v", "mult", "cells"])

    placed = classes.select("id", "v", "mult").mapInArrow(assign, f"id long, v {kind}, mult long, cells array<int>")
    placed = written(placed, "dedup-placed")
    size = np.zeros(len(centroids), dtype=np.int64)
    for r in placed.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect():  # at most max_shards rows
        size[r["cell"]] = r["count"]
    parts = np.maximum(1, -(-size // part_rows))

    def send(batches):
        """Each row goes to its shards; in a shard dealt into parts, to the tasks of its part with each."""
        for batch in batches:
            ids = batch.column(0).to_numpy()
            share = (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            cells = batch.column(3).flatten().to_numpy().reshape(len(ids), overlap) if len(ids) else np.zeros((0, overlap), np.int32)
            row = np.repeat(np.arange(len(ids)), overlap)
            cell = cells.ravel()
            which, other = _spread(np.zeros(len(cell), np.int64), parts[cell])
            for i in range(0, len(which), 16_384):
                w, o = which[i : i + 16_384], other[i : i + 16_384]
                r, c = row[w], cell[w]
                own = share[r] % parts[c]
                take = pa.array(r)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.astype(np.int32)), pa.array(np.minimum(own, o)), pa.array(np.maximum(own, o)), pa.array(own <= o), pa.array(own >= o), *[batch.column(j).take(take) for j in range(4)]],
                    names=["cell", "part", "other", "asks", "node", "id", "v", "mult", "cells"],
                )

    def look(t: pa.Table) -> pa.Table:
        """One shard (or a pair of its parts): its graph, and every row that asks searched for in it."""
        t = t.take(pa.array(np.lexsort((t.column("id").to_numpy(), ~t.column("node").to_numpy()))))  # nodes first, by id
        node, asks, ids, mult = (t.column(c).to_numpy() for c in ("node", "asks", "id", "mult"))
        cells = t.column("cells").combine_chunks().flatten().to_numpy().reshape(len(ids), overlap)
        cell, m, u = t.column("cell")[0].as_py(), int(node.sum()), unit(matrix(t.column("v")))
        ask = np.flatnonzero(asks)
        within = bool((node & asks).any())  # rows of one part with each other
        stars, counts = Stars(len(ids)), np.zeros(len(ids), dtype=np.int64)
        edge_a = edge_b = np.zeros(0, np.int64)
        if m and len(ask):

            def add(q, found):
                rows = ask[q]
                mine = first_common(cells[rows], cells[found]) == cell  # in their other shards the pair does not count
                counts[:] += np.bincount(rows[mine], mult[found[mine]], len(ids)).astype(np.int64)
                if not within:  # the others do not ask for it themselves
                    counts[:] += np.bincount(found[mine], mult[rows[mine]], len(ids)).astype(np.int64)
                for end in (rows, found):  # one link of each end first, which leaves few to join
                    _, at = np.unique(end, return_index=True)
                    stars.join(rows[at], found[at])
                    stars.settle()
                stars.join(rows, found)
                stars.settle()

            own = ask if within else np.full(len(ask), -1)
            a, b = build_graph(u[:m])
            if beam is None:
                scan(u[:m], u[ask], own, cosine, add)
            else:
                range_search(u[:m], a, b, int(np.argmax(u[:m] @ u[:m].mean(axis=0))), u[ask], own, cosine, beam, add)
            if within:
                edge_a, edge_b = near_edges(u[:m], a, b, cosine)
                differ = (cells[edge_a] != cells[edge_b]).any(axis=1)
                edge_a, edge_b = edge_a[differ], edge_b[differ]
        moved, to = stars.moved()
        got = np.flatnonzero(counts)
        n_got, n_star, n_edge = len(got), len(moved), len(edge_a)
        rows = n_got + n_star + n_edge
        is_edge = np.arange(rows) >= n_got + n_star
        ends = pa.array(np.concatenate([[0] * (n_got + n_star + 1), np.arange(1, n_edge + 1) * overlap]), pa.int32())
        lists = lambda x: pa.ListArray.from_arrays(ends, pa.array(cells[x].ravel()))
        return pa.table(
            {
                "a": np.concatenate([ids[got], ids[moved], ids[edge_a]]),
                "b": pa.array(np.concatenate([np.zeros(n_got, np.int64), ids[to], ids[edge_b]]), mask=np.arange(rows) < n_got),
                "n": np.concatenate([counts[got], np.zeros(n_star + n_edge, np.int64)]),
                "cell": pa.array(np.full(rows, cell, dtype=np.int32), mask=~is_edge),
                "a_cells": lists(edge_a),
                "b_cells": lists(edge_b),
            }
        )

    sent = placed.mapInArrow(send, f"cell int, part long, other long, asks boolean, node boolean, id long, v {kind}, mult long, cells array<int>")
    out = written(sent.groupBy("cell", "part", "other").applyInArrow(look, LINK_SCHEMA), "dedup-shards")
    found = [out.where("cell is null").select("a", "b", "n"), *_across(placed, out.where("cell is not null"), cosine, kind)]
    links = found[0]
    for part in found[1:]:
        links = links.unionByName(part)
    links = written(links, "dedup-links")
    drop_written(placed)
    drop_written(out)
    return links


def _across(placed: DataFrame, edges: DataFrame, cosine: float, kind: str) -> list[DataFrame]:
    """Links of vectors without a common shard: range expansion over the united lists.

    The lists of a node from all its shards are put together; from each vector
    in range of a query, its neighbours that the query's shards do not hold are
    candidates. They are verified, written, and are the next frontier, until no
    new link is found. Returns (a, b, n) tables as ``_links``."""
    lists = edges.groupBy("a", "b").agg(F.first("a_cells").alias("a_cells"), F.first("b_cells").alias("b_cells"))
    lists = written(lists, "dedup-lists")
    rounds: list[DataFrame] = []
    frontier = lists.select(F.col("a").alias("q"), F.col("a_cells").alias("q_cells"), F.col("b").alias("p"))
    vectors = placed.select("id", "v", "mult", "cells")

    def verify(batches):
        for batch in batches:
            if batch.num_rows:
                keep = np.einsum("ij,ij->i", unit(matrix(batch.column(1))), unit(matrix(batch.column(5)))) >= cosine
                yield batch.filter(pa.array(keep)).drop_columns(["va", "vb"])

    while True:
        near = frontier.join(lists, frontier["p"] == lists["a"]).where("b != q").where(~F.arrays_overlap("q_cells", "b_cells"))
        pairs = near.select(F.least("q", "b").alias("a"), F.greatest("q", "b").alias("b")).distinct()
        for known in rounds:
            pairs = pairs.join(known.select("a", "b"), ["a", "b"], "left_anti")
        side = lambda x: vectors.select(F.col("id").alias(x), F.col("v").alias(f"v{x}"), F.col("mult").alias(f"mult_{x}"), F.col("cells").alias(f"{x}_cells"))
        full = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "va", "mult_a", "a_cells", "b", "vb", "mult_b", "b_cells")
        new = written(full.mapInArrow(verify, "a long, mult_a long, a_cells array<int>, b long, mult_b long, b_cells array<int>"), "dedup-round")
        if new.isEmpty():
            break
        rounds.append(new)
        frontier = new.select(F.col("a").alias("q"), F.col("a_cells").alias("q_cells"), F.col("b").alias("p"))
        frontier = frontier.union(new.select("b", "b_cells", "a"))
    none = F.lit(None).cast("long")
    out = []
    for new in rounds:
        out.append(new.select("a", none.alias("b"), F.col("mult_b").alias("n")).union(new.select(F.col("b"), none, "mult_a")))
        out.append(new.select("a", "b", F.lit(0).cast("long").alias("n")))
    return out


def audit_recall(classes: DataFrame, counted: DataFrame, n: int, cosine: float, sample: int = 512, few: int = 16) -> float:
    """The mean share of its links (by brute force) that a vector with links has in
    ``counted`` (id, n): the lesser of those for vectors with up to ``few`` in
    ``counted``, none included, and with more. ``sample`` vectors are drawn of
    those with none, with few and with more, and weighted by how many there are."""
    spark = classes.sparkSession
    found = F.coalesce("n", F.lit(0))
    ids = classes.select("id").join(counted, "id", "left").select(
        "id", found.alias("n"), F.when(found == 0, 0).when(found <= few, 1).otherwise(2).alias("kind")
    )
    picked = [ids.where(F.col("kind") == i).orderBy(F.xxhash64("id", F.lit("audit"))).limit(sample) for i in range(3)]
    rows = picked[0].union(picked[1]).union(picked[2]).collect()
    if not rows:
        return 1.0
    some = spark.createDataFrame([(r["id"],) for r in rows], "id long")
    t = classes.join(F.broadcast(some), "id").select("id", "v").toArrow()
    shared = spark.sparkContext.broadcast((t.column("id").to_numpy(), unit(matrix(t.column("v")))))

    def run(batches):
        ids, q = shared.value
        total = np.zeros(len(ids), dtype=np.int64)
        for batch in batches:
            x = matrix(batch.column(1))
            for i in range(0, len(x), 1024):
                part = batch.slice(i, 1024)
                hit = (q @ unit(x[i : i + 1024]).T >= cosine) & (ids[:, None] != part.column(0).to_numpy()[None, :])
                total += hit @ part.column(2).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["id", "want"])

    want = classes.select("id", "v", "mult").mapInArrow(run, "id long, want long").groupBy("id").agg(F.sum("want").alias("want"))
    want = {r["id"]: r["want"] for r in want.collect()}  # at most three samples
    size = {r["kind"]: r["count"] for r in ids.groupBy("kind").count().collect()}
    weight = {k: s / min(s, sample) for k, s in size.items()}
    got, of = [0.0, 0.0], [0.0, 0.0]
    for r in rows:
        if want[r["id"]]:
            many = r["kind"] == 2
            got[many] += weight[r["kind"]] * min(r["n"] / want[r["id"]], 1.0)
            of[many] += weight[r["kind"]]
    return min((g / w for g, w in zip(got, of) if w), default=1.0)


def embedding_groups(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    cosine: float = 0.9,
    beam: int = 16,
    overlap: int = 6,
    shard_rows: int = 4096,
    part_rows: int = 8192,
    sample_rows: int = 16_384,
    max_shards: int = 4096,
    min_recall: float = 0.99,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``.

    Vectors that are null, zero, not finite, or not of the table's common length
    link with nothing, nor do rows with a null id (component null, kept). Equal
    vectors are linked. Repeated rows are vectors of their own with one id.
    Other columns are ignored; no rows give no rows. A shard has about
    ``shard_rows`` vectors, as long as ``max_shards`` of them suffice.
    """
    kind = vectors.schema[vector].dataType.simpleString()
    rows = usable_vectors(vectors, vec_id, vector).withColumn("v", F.col("v").cast(kind))
    rows = written(rows.select("id", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"), "v"), "dedup-rows")
    classes = rows.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.count("*").alias("mult"), F.first("v").alias("v"))
    # ids of classes are made distinct, as one id may stand for several vectors
    classes = written(classes.select(F.xxhash64("h1", "h2", "first").alias("id"), "first", "mult", "h1", "h2", "v"), "dedup-classes")
    n = classes.count()
    found = counted = None
    for width, more in ((beam, 1), (4 * beam, 2), (None, 4)) if n else ():
        found = _links(classes, n, cosine, width, more * overlap, shard_rows, part_rows, sample_rows, max_shards)
        counted = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
        recall = audit_recall(classes, counted, n, cosine)
        if recall >= min_recall:
            break
        if width is None:
            raise RuntimeError(f"link recall is {recall:.4f} in the audit, under {min_recall}")
        drop_written(found)
    base = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast(kind).alias("v"))
    if not n:
        return base.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    comp = written(components(found.where("b is not null"), "a", "b"), "dedup-components").withColumnRenamed("node", "id")
    named = classes.drop("v").join(counted, "id", "left").join(comp, "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = written(named, "dedup-named")
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    per_class = named.join(least, "component").select("h1", "h2", (F.col("mult") - 1 + F.coalesce("n", F.lit(0))).alias("links"), "component_id")
    size = classes.select(F.size("v").alias("size")).first()["size"]
    usable = (
        F.col("vec_id").isNotNull()
        & (F.size("v") == size)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    keyed = base.select(
        "vec_id", F.when(usable, F.xxhash64("v")).alias("h1"), F.when(usable, F.xxhash64(F.lit(1), "v")).alias("h2")
    )
    out = keyed.join(per_class, ["h1", "h2"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op5_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    from pricelens.llm.common import table

    return embedding_groups(table(spark, sf_dir, "embeddings"))
