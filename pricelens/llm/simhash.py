"""SimHash near-duplicates by BK-trees over shards of fingerprints.

Fingerprints that differ in at most ``radius`` of 64 bits agree on at least
``blocks - radius`` of ``blocks`` bit blocks, so each choice of that many
blocks is a shard key: a fingerprint goes to every choice's shard, and two
linked ones meet in at least one. In a shard a BK-tree (children keyed by the
integer Hamming distance to the parent) is built and searched along the edges
within the radius only. A shard of more than ``tree_size`` fingerprints is
dealt into trees of about that size, and each tree is sent to every chunk of
the shard's queries, so no task holds more than two chunks. Tasks send back a
spanning star per tree search, not pairs; components join the stars.

A shard holds about N / 2**(64 * (blocks - radius) / blocks) of N different
fingerprints: raise ``blocks`` with the corpus (6: two million shards for each
of 15 choices; 8: four billion for each of 70). The result is the same.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pricelens.llm.common import fresh, written
from pricelens.llm.components import components
from pricelens.llm.stars import Stars

SEED = 42


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of one text as an unsigned 64-bit integer."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: ASCII case and blanks only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    ends = (ends[shingle - 1 :] - 1).tolist()
    hash_ = xxhash.xxh64_intdigest
    hs = np.array([hash_(line[a:b], SEED) for a, b in zip(starts, ends)], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hs), 16384):
        bits = np.unpackbits(hs[i : i + 16384].view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    on = np.flatnonzero(2 * counts > len(hs)).tolist()
    return sum(1 << b for b in on)


def with_fingerprint(docs: DataFrame, text: str, fp: str, shingle: int = 4) -> DataFrame:
    """``docs`` plus the fingerprint as a signed long in the new column ``fp``; null text is empty."""
    names, at = [*docs.columns, fp], docs.columns.index(text)

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(at)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps.view(np.int64))], names=names)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(fp, LongType())]))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, fp) of every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return with_fingerprint(rows, "text", "fp", shingle).select("doc_id", "fp")


class Forest:
    """BK-trees of several shards side by side: one root per group."""

    def __init__(self, fps: np.ndarray, groups: np.ndarray):
        self.fps = fps
        self.child = np.full((len(fps), 65), -1, dtype=np.int32)
        self.roots: dict[int, int] = {}
        values, child = fps.tolist(), self.child
        for i, g in enumerate(groups.tolist()):
            at = self.roots.setdefault(g, i)
            while at != i:
                d = (values[i] ^ values[at]).bit_count()
                below = child[at, d]
                if below < 0:
                    child[at, d] = i
                    break
                at = int(below)

    def search(self, queries: np.ndarray, groups: np.ndarray, radius: int, at_once: int = 50_000):
        """Index pairs (query, node) within the radius; node by its index here.
        Of the pairs still to follow ``at_once`` are worked at a time, the latest
        first, so that a dense shard's pairs never lie in memory together."""
        at = np.array([self.roots.get(g, -1) for g in groups.tolist()], dtype=np.int32)
        todo = [(np.flatnonzero(at >= 0).astype(np.int32), at[at >= 0])]
        while todo:
            q, at = todo.pop()
            if len(q) > at_once:
                todo.append((q[at_once:], at[at_once:]))
                q, at = q[:at_once], at[:at_once]
            if not len(q):
                continue
            d = np.bitwise_count(queries[q] ^ self.fps[at]).astype(np.int32)
            hit = d <= radius
            yield q[hit], at[hit]
            nq, nat = [], []
            for step in range(-radius, radius + 1):
                e = d + step
                ok = (e >= 0) & (e <= 64)
                below = self.child[at[ok], e[ok]]
                found = below >= 0
                nq.append(q[ok][found])
                nat.append(below[found])
            todo.append((np.concatenate(nq), np.concatenate(nat)))


def _stars(fps, groups, roles, radius, block=512):
    """Spanning stars (a, b) of the links of complete groups; role 1: in the tree, 2: a query, 3: both."""
    tree, ask = roles != 2, roles != 1
    t_fp, q_fp, q_group = fps[tree], fps[ask], groups[ask]
    forest = Forest(t_fp, groups[tree])
    n_tree = len(t_fp)
    stars = Stars(len(fps))
    t_row, q_row = np.flatnonzero(tree), np.flatnonzero(ask)
    for i in range(0, len(q_fp), block) if n_tree else ():
        for q, at in forest.search(q_fp[i : i + block], q_group[i : i + block], radius):
            stars.join(q_row[i + q], t_row[at])
        stars.settle()
    moved, centre = stars.moved()
    return fps[moved], fps[centre]


def links(fps: DataFrame, radius: int = 4, blocks: int = 6, tree_size: int = 4096) -> DataFrame:
    """(a, b): links that connect all fingerprints (column ``fp``, distinct) within the radius."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), max(blocks - radius, 1)):
        m = sum(((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in chosen)
        masks.append(m - (1 << 64) if m >= 1 << 63 else m)
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks]))).select(
        "fp", F.xxhash64("pos", "col").alias("key")
    )
    sizes = keyed.groupBy("key").count().where(F.col("count") > 1)
    dealt = keyed.join(sizes, "key").select(
        "key", "fp", F.ceil(F.col("count") / tree_size).cast("int").alias("n")
    ).withColumn("c", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    copies = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda o: F.struct(
            F.least(o, F.col("c")).cast("int").alias("tree"),
            F.greatest(o, F.col("c")).cast("int").alias("ask"),
            F.when(o == F.col("c"), 3).when(o > F.col("c"), 1).otherwise(2).alias("role"),
        ),
    )
    sent = dealt.select("key", "fp", F.explode(copies).alias("x")).select(
        F.xxhash64("key", "x.tree", "x.ask").alias("shard"), "fp", "x.role"
    )

    def run(batches):
        held = None  # rows of the last shard, which may go on in the next batch

        def out(part):
            shard, fp, role = part
            # neighbouring shards are searched side by side, in turns of bounded size
            cuts = np.flatnonzero(np.diff(shard)) + 1
            bounds = np.concatenate(([0], cuts, [len(shard)]))
            i = 0
            while i < len(bounds) - 1:
                j = i + 1
                while j < len(bounds) - 1 and bounds[j + 1] - bounds[i] <= 16384:
                    j += 1
                s = slice(bounds[i], bounds[j])
                a, b = _stars(fp[s].view(np.uint64), shard[s], role[s], radius)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])
                i = j

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            last = np.searchsorted(cols[0], cols[0][-1])
            held = [c[last:] for c in cols]
            if last:
                yield from out([c[:last] for c in cols])
        if held is not None:
            yield from out(held)

    return sent.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "a long, b long")


def _grouped(docs: DataFrame, doc_id: str, text: str, shingle: int, radius: int, blocks: int, tree_size: int) -> DataFrame:
    """(doc_id, fp, component, component_id) of every row; ``component`` is a fingerprint of the group."""
    rows = written(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    comp = components(links(classes.select("fp"), radius, blocks, tree_size), "a", "b").select(F.col("node").alias("fp"), "component")
    named = written(
        classes.join(comp, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("component")), "fp-components"
    )
    firsts = named.groupBy("component").agg(F.min("first").alias("component_id"))
    return rows.join(named.join(firsts, "component").select("fp", "component", "component_id"), "fp", "left")


def simhash_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4, blocks: int = 6, tree_size: int = 4096
) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``docs``.

    Null and empty texts have fingerprint 0 and are linked like any other. A
    null doc_id keeps its row and never names a component unless all its
    members are null. Repeated rows stay; other columns are ignored; no rows
    give no rows.
    """
    return _grouped(docs, doc_id, text, shingle, radius, blocks, tree_size).select("doc_id", "fp", "component_id")


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4, blocks: int = 6, tree_size: int = 4096
) -> DataFrame:
    """``docs`` with one row of each group: one with the group's smallest doc_id
    (any other before null), of several the one with the smallest fingerprint,
    of rows equal in both any one."""
    id_name, fp, group = fresh(docs, "id_of_group", "fingerprint", "group")
    rows = written(_grouped(docs, doc_id, text, shingle, radius, blocks, tree_size), "fp-groups")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("fp"))
    first = rows.groupBy("component").agg(F.min(order).alias("f")).select(F.col("component").alias(group), F.col("f.doc_id").alias(id_name), F.col("f.fp").alias(fp))
    repeated = rows.groupBy("doc_id").count().where("count > 1 or doc_id is null").select("doc_id")
    first = written(_marked(first, repeated, id_name), "fp-firsts")
    # an id that occurs once is its row; of the others the fingerprint tells the rows apart
    own = docs[doc_id].cast("long")
    alone = docs.join(first.where("alone").select(id_name), own == F.col(id_name), "left_semi")
    some = first.where("not alone")
    mixed = docs.join(some.select(id_name).distinct(), own.eqNullSafe(F.col(id_name)), "left_semi")
    marked = with_fingerprint(mixed, text, fp, shingle)
    some = some.withColumnRenamed(fp, f"{fp}_of_group")
    both = marked[doc_id].cast("long").eqNullSafe(some[id_name]) & (marked[fp] == some[f"{fp}_of_group"])
    one = marked.join(some, both).dropDuplicates([group]).select(*[marked[c] for c in docs.columns])
    return alone.unionByName(one)


def _marked(first: DataFrame, repeated: DataFrame, id_name: str) -> DataFrame:
    """``first`` with ``alone``: its id is not null and occurs in one row only."""
    r = repeated.select(F.col("doc_id").alias("repeated_id"), F.lit(True).alias("again"))
    return first.join(r, F.col(id_name).eqNullSafe(F.col("repeated_id")), "left").withColumn("alone", F.col("again").isNull()).drop("repeated_id", "again")


def op2_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    from pricelens.llm.common import table

    out = simhash_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
