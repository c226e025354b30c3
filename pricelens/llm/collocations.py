"""Phrase collocations by vertical partitioning of the suffixes of all texts.

The suffixes of all pieces of text, cut off after ``max_words`` words, form one
large tree per language. It is built in parts that fit a memory budget:

1. Count every word (the prefixes of one word), summed on the map side first.
2. A prefix that occurs more often than the budget is made longer by a word and
   its extensions are counted, until each fits or has ``max_words`` words. There
   are at most total / budget such prefixes.
3. Prefixes are hashed into buckets; the buckets' counts are packed into groups
   of at most the budget. The map from bucket to group and the long list of
   step 2 are all that is broadcast, beside a bit map of frequent words.
4. The texts are read again: every task adds up equal suffixes and sends them to
   the group of their prefix, as numbers with the words they stand for. A
   suffix ends before a word that is too rare to be in a candidate.
5. Each group builds its subtrees by itself: suffixes in order are its leaves,
   the common prefix of neighbours gives the inner nodes, and a node's count is
   the total of its leaves. The counts of a node's own prefixes, the left parts
   of its cuts, are read from the nodes above it.
6. The right parts' counts are joined by phrase, candidates inside a longer one
   that is frequent enough are dropped, and the best of each language are kept.

Rows of a group are bounded by the budget in occurrences, so a frequent word or
a phrase of a third of all rows is never in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import drop_written, table, written

BLOCK_BYTES = 16_000_000  # of texts whose suffixes a task adds up before it sends them
MOST_WORDS = 3  # of a phrase: CHUNK times as many words have small numbers
OUT_ROWS = 200_000
CHUNK = 10_000  # suffixes in a row that is sent (their words are then fewer than 2 ** 15)
MOST_GROUPS = 1 << 22  # beyond that the budget grows with the corpus
MOST_FLAGS = 1 << 30
NO_LANG = "und"
BLANK, BREAK = 0x20, 0x0A
#: A-Z in lower case, tabs as blanks, and what ends a piece as a newline.
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)


def prefix_hash(lang: str, prefix: bytes) -> int:
    """What Spark's xxhash64(lang, prefix) gives, as an unsigned number."""
    import xxhash

    return xxhash.xxh64_intdigest(prefix, xxhash.xxh64_intdigest(lang.encode(), 42))


class Block:
    """Words of some texts of one language, cut out of one array of bytes:
    numbers into ``names`` (from 1) and whether the next word is in the same piece."""

    def __init__(self, lang: str, texts: pa.Array):
        self.lang = lang
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if pa.types.is_large_string(texts.type) else np.int32)
        offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = texts.buffers()[2]
        data = memoryview(data)[offsets[0] : offsets[-1]] if data is not None else b""
        text = np.frombuffer(bytes(data).translate(FOLD), dtype=np.uint8)
        begin = (offsets - offsets[0])[:-1]
        begin = begin[begin < len(text)]
        breaks = text == BREAK
        blank = breaks | (text == BLANK)
        before = np.ones(len(text), dtype=bool)  # a blank, or the begin of a text
        before[1:] = blank[:-1]
        before[begin] = True
        start = np.flatnonzero(~blank & before)
        after = np.ones(len(text), dtype=bool)
        after[:-1] = blank[1:]
        after[begin[begin > 0] - 1] = True
        size = np.flatnonzero(~blank & after) + 1 - start
        ends = np.zeros(len(start) + 1, dtype=np.int32)
        np.cumsum(size, out=ends[1:])
        words = pa.StringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(text[~blank].tobytes()))
        words = words.dictionary_encode()
        self.names = words.dictionary
        self.ids = words.indices.to_numpy().astype(np.int64) + 1
        breaks = breaks.astype(np.int32)
        breaks[begin] += 1
        piece = np.cumsum(breaks, dtype=np.int32)[start]
        self.joined = np.zeros(len(start), dtype=bool)
        self.joined[:-1] = piece[1:] == piece[:-1]

    def suffixes(self, known: np.ndarray, depth: int, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct suffixes of at most ``depth`` words, as rows of numbers (0:
        none), and their counts; a suffix ends before a word that is not
        ``known``. With ``only``, those that begin with such words."""
        ids = np.where(np.concatenate([[False], known])[self.ids], self.ids, 0)
        at = np.flatnonzero(ids if only is None else np.concatenate([[False], only])[ids])
        columns, alive = [ids[at]], np.ones(len(at), dtype=bool)
        ids = np.concatenate([ids, np.zeros(depth, dtype=np.int64)])
        joined = np.concatenate([self.joined, np.zeros(depth, dtype=bool)])
        for k in range(1, depth):
            alive &= joined[at + k - 1]
            following = np.where(alive, ids[at + k], 0)
            alive &= following > 0
            columns.append(following)
        return distinct(columns, len(self.names) + 1)


def distinct(columns: list[np.ndarray], below: int, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of columns of numbers less than ``below``, in order, with
    how many there are (the sum of ``weights``)."""
    bits = int(below).bit_length()
    if bits * len(columns) <= 63:
        code = columns[0]
        for c in columns[1:]:
            code = (code << bits) | c
        if weights is None:
            code, count = np.unique(code, return_counts=True)
        else:
            code, inverse = np.unique(code, return_inverse=True)
            count = np.bincount(inverse, weights=weights, minlength=len(code)).astype(np.int64)
        rows = np.empty((len(code), len(columns)), dtype=np.int64)
        for k in range(len(columns) - 1, -1, -1):
            rows[:, k] = code & ((1 << bits) - 1)
            code = code >> bits
        return rows, count
    table = np.stack(columns, axis=1)  # too many words for one number
    rows, inverse, count = np.unique(table, axis=0, return_inverse=True, return_counts=True)
    if weights is not None:
        count = np.bincount(inverse.ravel(), weights=weights, minlength=len(rows)).astype(np.int64)
    return rows, count


def _blocks(batches):
    """Blocks of the texts (lang, text) of a task, one per language and about BLOCK_BYTES."""
    held, size = [], 0
    for batch in batches:
        lo = 0
        while lo < batch.num_rows:
            hi, text = lo, batch.column(1)
            sizes = np.cumsum(pc.fill_null(pc.binary_length(text.slice(lo)), 0).to_numpy())
            hi = lo + max(1, int(np.searchsorted(sizes, BLOCK_BYTES - size, side="right")))
            held.append(batch.slice(lo, hi - lo))
            size += int(sizes[min(hi - lo, len(sizes)) - 1])
            lo = hi
            if size >= BLOCK_BYTES or lo < batch.num_rows:
                yield from _by_language(held)
                held, size = [], 0
    if held:
        yield from _by_language(held)


def _by_language(batches):
    rows = pa.Table.from_batches(batches).combine_chunks()
    if not rows.num_rows:
        return
    langs = pc.fill_null(rows.column(0).chunk(0), NO_LANG).dictionary_encode()
    texts = pc.fill_null(rows.column(1).chunk(0), "")
    code = langs.indices.to_numpy()
    order = np.argsort(code, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(code[order])) + 1):
        yield Block(langs.dictionary[int(code[part[0]])].as_py(), texts.take(pa.array(part)))


@dataclass
class Plan:
    """How suffixes are dealt: sent to the tasks that read the texts."""

    flags: np.ndarray  # bit map over hashes of words that may be frequent
    long: list[dict]  # per number of words: (language, prefix) -> count, of the prefixes made longer
    group_of: np.ndarray  # bucket -> group

    def hashes(self, block: Block) -> np.ndarray:
        import xxhash

        seed = xxhash.xxh64_intdigest(block.lang.encode(), 42)
        return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in block.names.cast(pa.binary()).to_pylist()), dtype=np.uint64, count=len(block.names))

    def known(self, hashes: np.ndarray) -> np.ndarray:
        h = hashes & np.uint64(len(self.flags) * 8 - 1)
        return (self.flags[(h >> np.uint64(3)).astype(np.int64)] >> (h & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def longer(self, block: Block) -> list[set[tuple]]:
        """Per number of words, the prefixes made longer, in the block's numbers."""
        out = []
        for long in self.long:
            prefixes = [p.decode().split(" ") for lang, p in long if lang == block.lang]
            words = sorted({w for p in prefixes for w in p})
            number = pc.index_in(pa.array(words, pa.string()), block.names).to_pylist()
            number = {w: k + 1 for w, k in zip(words, number) if k is not None}
            out.append({tuple(number[w] for w in p) for p in prefixes if all(w in number for w in p)})
        return out


def _starts_with(rows: np.ndarray, prefixes: set[tuple], size: int) -> np.ndarray:
    """Per row: are its first ``size`` words one of the prefixes?"""
    if not prefixes or not len(rows):
        return np.zeros(len(rows), dtype=bool)
    firsts = np.isin(rows[:, 0], [p[0] for p in prefixes])
    at = np.flatnonzero(firsts)
    if size > 1:
        heads, inverse = np.unique(rows[at, :size], axis=0, return_inverse=True)
        firsts[at] = np.array([tuple(h) in prefixes for h in heads.tolist()], dtype=bool)[inverse.ravel()]
    return firsts


def _strings(words: pa.Array, rows: np.ndarray) -> pa.Array:
    """Phrases of rows of numbers (from 1; 0: none), joined by one space."""
    columns = [words.take(pa.array(c - 1, mask=c == 0)) for c in rows.T]
    return pc.binary_join_element_wise(*columns, " ", null_handling="skip") if len(columns) > 1 else columns[0]


def _slices(columns: list, names: list[str]):
    rows = pa.RecordBatch.from_arrays(columns, names=names)
    for lo in range(0, rows.num_rows, OUT_ROWS):
        yield rows.slice(lo, OUT_ROWS)


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))


def prefix_counts(texts: DataFrame, words: int, plan=None) -> DataFrame:
    """(lang, prefix, f): all prefixes of that many words; with a plan, those
    of its long prefixes of one word less."""

    def count(batches):
        for block in _blocks(batches):
            if words == 1:
                counts = np.bincount(block.ids, minlength=len(block.names) + 1)[1:]
                rows = np.arange(1, len(block.names) + 1)[:, None]
            else:
                p: Plan = plan.value
                longer = p.longer(block)
                if len(longer) < words - 1 or not longer[words - 2]:
                    continue
                only = np.zeros(len(block.names), dtype=bool)
                only[[q[0] - 1 for q in longer[words - 2]]] = True
                rows, counts = block.suffixes(p.known(p.hashes(block)), words, only)
                whole = (rows[:, -1] > 0) & _starts_with(rows, longer[words - 2], words - 1)
                rows, counts = rows[whole], counts[whole]
            yield from _slices([pa.repeat(pa.scalar(block.lang, pa.string()), len(counts)), _strings(block.names, rows), pa.array(counts, pa.int64())], ["lang", "prefix", "f"])

    found = texts.mapInArrow(count, "lang string, prefix string, f long")
    return found.groupBy("lang", "prefix").agg(F.sum("f").alias("f"))


def _flags(words: DataFrame, min_count: int) -> np.ndarray:
    """Bit map of the hashes of words that occur often enough. A rare word may
    share a bit with a frequent one (it is then counted, and left out later);
    a frequent one is always marked."""
    often = words.where(F.col("f") >= min_count)
    size = 1 << 16
    n = often.count()
    while size < 16 * n and size < MOST_FLAGS:
        size *= 2
    place = F.xxhash64("lang", "prefix").bitwiseAND(F.lit(size - 1))
    bits = often.select(F.shiftright(place, 5).alias("at"), F.expr("1L").alias("one"), place.bitwiseAND(F.lit(31)).cast("int").alias("bit"))
    found = bits.groupBy("at").agg(F.expr("bit_or(shiftleft(one, bit))").alias("bits")).toArrow()
    out = np.zeros(size // 32, dtype="<u4")
    out[found["at"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def pack_groups(weights: np.ndarray, budget: int) -> np.ndarray:
    """Group of each bucket: the largest bucket left, then the smallest ones
    while they fit the budget."""
    order = np.argsort(-weights, kind="stable").tolist()
    w = weights.tolist()
    out = np.zeros(len(w), dtype=np.int32)
    lo, hi, group = 0, len(order) - 1, 0
    while lo <= hi:
        held = w[order[lo]]
        out[order[lo]] = group
        lo += 1
        while hi >= lo and held + w[order[hi]] <= budget:
            held += w[order[hi]]
            out[order[hi]] = group
            hi -= 1
        group += 1
    return out


def _send(texts: DataFrame, plan, depth: int) -> DataFrame:
    """Suffixes with their counts, some of them to a row: per block, group and
    ``own`` (the number of words of the prefixes that chose the group) their
    words, joined by spaces, per place of a suffix the number of its word (from
    1; 0: none), and the counts."""

    def send(batches):
        p: Plan = plan.value
        buckets = np.uint64(len(p.group_of) - 1)
        for block in _blocks(batches):
            hashes = p.hashes(block)
            longer = p.longer(block)
            rows, counts = block.suffixes(p.known(hashes), depth)
            own = np.ones(len(rows), dtype=np.int64)
            for size in range(1, min(depth, len(longer) + 1)):
                own[(own == size) & (rows[:, size] > 0) & _starts_with(rows, longer[size - 1], size)] = size + 1
            group = p.group_of[(hashes & buckets).astype(np.int64)][rows[:, 0] - 1] if len(rows) else np.zeros(0, dtype=np.int32)
            for size in range(2, depth + 1):
                at = np.flatnonzero(own == size)
                if len(at):
                    heads, inverse = np.unique(rows[at, :size], axis=0, return_inverse=True)
                    h = [prefix_hash(block.lang, t.encode()) for t in _strings(block.names, heads).to_pylist()]
                    group[at] = p.group_of[(np.array(h, dtype=np.uint64) & buckets).astype(np.int64)][inverse.ravel()]
            yield from _chunks(block, rows, counts, group, own)

    numbers = ", ".join(f"w{k} array<smallint>" for k in range(depth))
    return texts.mapInArrow(send, f"part int, lang string, own int, words string, {numbers}, n array<int>")


def _chunks(block: Block, rows: np.ndarray, counts: np.ndarray, group: np.ndarray, own: np.ndarray):
    """Rows of at most CHUNK suffixes, so that a number of a word in it is a small one."""
    if not len(rows):
        return
    depth = rows.shape[1]
    order = np.lexsort([own, group])
    rows, counts, group, own = rows[order], counts[order], group[order], own[order]
    new = np.concatenate([[True], (np.diff(group) != 0) | (np.diff(own) != 0)])
    begin = np.flatnonzero(new)
    new |= (np.arange(len(rows)) - begin[np.cumsum(new) - 1]) % CHUNK == 0
    first = np.flatnonzero(new)
    bounds = np.append(first, len(rows))
    used, numbers = [], []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        words, inverse = np.unique(rows[lo:hi], return_inverse=True)
        none = int(words[0] == 0)  # the number 0 is no word
        used.append(words[none:])
        numbers.append((inverse.reshape(-1, depth) + 1 - none).astype(np.int16))
    names = block.names.take(pa.array(np.concatenate(used) - 1))
    ends = pa.array(np.concatenate([[0], np.cumsum([len(u) for u in used])]), pa.int32())
    numbers = np.concatenate(numbers)
    bounds = pa.array(bounds, pa.int32())
    yield from _slices(
        [
            pa.array(group[first].astype(np.int32)),
            pa.repeat(pa.scalar(block.lang, pa.string()), len(first)),
            pa.array(own[first].astype(np.int32)),
            pc.binary_join(pa.ListArray.from_arrays(ends, names), " "),
            *[pa.ListArray.from_arrays(bounds, pa.array(np.ascontiguousarray(numbers[:, k]))) for k in range(depth)],
            pa.ListArray.from_arrays(bounds, pa.array(counts.astype(np.int32))),
        ],
        ["part", "lang", "own", "words", *[f"w{k}" for k in range(depth)], "n"],
    )


class Subtrees:
    """Suffix subtrees of one group, cut off at ``depth`` words: leaves in
    order, and per depth where each node's leaves begin and their total."""

    def __init__(self, group: pa.Table, depth: int):
        column = lambda name: group[name].combine_chunks()
        lang = column("lang").dictionary_encode()
        words, counts = pc.split_pattern(column("words"), " "), column("n")
        names = words.flatten().dictionary_encode()
        self.langs, self.words = lang.dictionary, names.dictionary
        sizes = pc.list_value_length(words).to_numpy()
        suffixes = pc.list_value_length(counts).to_numpy()
        base = np.repeat(np.cumsum(sizes) - sizes, suffixes)
        number = np.concatenate([[0], names.indices.to_numpy().astype(np.int64) + 1])
        columns = [np.repeat(lang.indices.to_numpy().astype(np.int64), suffixes)]
        for k in range(depth):
            ids = column(f"w{k}").flatten().to_numpy().astype(np.int64)
            columns.append(number[np.where(ids > 0, ids + base, 0)])
        columns.append(np.repeat(column("own").to_numpy().astype(np.int64), suffixes))
        below = max(len(self.words), len(self.langs), depth) + 1
        table, count = distinct(columns, below, counts.flatten().to_numpy())
        self.rows, self.own = table[:, :-1], table[:, -1]
        self.before = np.concatenate([[0], np.cumsum(count)])
        differs = np.zeros(len(table), dtype=bool)
        differs[:1] = True
        self.first, self.node = [], []
        for k in range(depth + 1):
            differs[1:] |= self.rows[1:, k] != self.rows[:-1, k]
            self.first.append(np.flatnonzero(differs))
            self.node.append(np.cumsum(differs) - 1)

    def totals(self, words: int) -> np.ndarray:
        """Count of each node of that many words."""
        first = self.first[words]
        return self.before[np.append(first[1:], len(self.rows))] - self.before[first]


def _nodes(depth: int, min_count: int, plan):
    """Group -> its nodes of two and more words that occur often enough."""

    def build(group: pa.Table) -> pa.Table:
        tree = Subtrees(group, depth)
        long = plan.value.long
        out = {name: [] for name in ("lang", "phrase", "words", "a", "left")}
        totals = [tree.totals(k) for k in range(depth + 1)]
        for words in range(2, depth + 1):
            leaf = tree.first[words]
            keep = (tree.rows[leaf, words] > 0) & (tree.own[leaf] <= words) & (totals[words] >= min_count)
            leaf, a = leaf[keep], totals[words][keep]
            rows, langs = tree.rows[leaf], tree.langs.take(pa.array(tree.rows[leaf, 0]))
            left = np.zeros((len(leaf), words - 1), dtype=np.int64)
            for k in range(1, words):
                left[:, k - 1] = totals[k][tree.node[k][leaf]]
                spread = np.flatnonzero(tree.own[leaf] > k)  # under a prefix that is spread over groups
                prefixes = _strings(tree.words, rows[spread, 1 : k + 1]).to_pylist()
                for i, lang, prefix in zip(spread.tolist(), langs.take(pa.array(spread)).to_pylist(), prefixes):
                    left[i, k - 1] = long[k - 1][(lang, prefix.encode())]
            out["lang"].append(langs)
            out["phrase"].append(_strings(tree.words, rows[:, 1 : words + 1]))
            out["words"].append(pa.array(np.full(len(leaf), words, dtype=np.int32)))
            out["a"].append(pa.array(a))
            out["left"].append(pa.ListArray.from_arrays(pa.array(np.arange(len(leaf) + 1) * (words - 1), pa.int32()), pa.array(left.ravel())))
        return pa.table({name: pa.chunked_array(parts) for name, parts in out.items()})

    return build


def phrase_counts(docs: DataFrame, min_count: int, max_words: int, budget: int, lang_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Two written tables: words (lang, prefix, f) and phrases of two and more
    words that occur ``min_count`` times (lang, phrase, words, a, left), where
    ``left`` has the counts of the phrase's first 1, 2, ... words."""
    spark = docs.sparkSession
    texts = _texts(docs, lang_col, text_col)
    words = written(prefix_counts(texts, 1), "words")
    total = words.agg(F.sum("f").alias("n")).first()["n"] or 0
    budget = max(budget, -(-total // MOST_GROUPS))
    buckets = 1024
    while buckets * budget < 8 * total:
        buckets *= 2
    flags = _flags(words, min_count)
    bucket = F.xxhash64("lang", "prefix").bitwiseAND(F.lit(buckets - 1)).alias("bucket")
    weights = np.zeros(buckets, dtype=np.int64)
    long, spread = [], []
    counts = words
    for size in range(1, max_words + 1):
        fits = counts.where(F.col("f") >= min_count)
        if size < max_words:
            rows = fits.where(F.col("f") > budget).collect()
            long.append({(r["lang"], r["prefix"].encode()): r["f"] for r in rows})
            fits = fits.where(F.col("f") <= budget)
        found = fits.groupBy(bucket).agg(F.sum("f").alias("f")).toArrow()
        np.add.at(weights, found["bucket"].to_numpy(), found["f"].to_numpy())
        if size > 1:
            spread.append(counts)
        if size == max_words or not long[-1]:
            break
        plan = spark.sparkContext.broadcast(Plan(flags, long, np.zeros(1, dtype=np.int32)))
        counts = written(prefix_counts(texts, size + 1, plan), "prefixes")
    plan = spark.sparkContext.broadcast(Plan(flags, long, pack_groups(weights, budget)))
    schema = "lang string, phrase string, words int, a long, left array<long>"
    phrases = _send(texts, plan, max_words).groupBy("part").applyInArrow(_nodes(max_words, min_count, plan), schema)
    for size, prefixes in enumerate(spread, start=2):  # nodes that are spread over groups: counted in step 2
        if size == max_words:
            continue
        phrases = phrases.unionByName(_long_phrases(prefixes.where((F.col("f") > budget) & (F.col("f") >= min_count)), size, plan))
    phrases = written(phrases, "phrases")
    for prefixes in spread:
        drop_written(prefixes)
    return words, phrases


def _long_phrases(prefixes: DataFrame, size: int, plan) -> DataFrame:
    """Prefixes that were made longer, as phrases; all their own prefixes were too."""

    def lefts(batches):
        long = plan.value.long
        for batch in batches:
            rows = batch.to_pylist()
            left = [[long[k - 1][(r["lang"], b" ".join(r["prefix"].encode().split(b" ")[:k]))] for k in range(1, size)] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([size] * len(rows), pa.int32()), batch.column(2), pa.array(left, pa.list_(pa.int64()))],
                names=["lang", "phrase", "words", "a", "left"],
            )

    return prefixes.select("lang", "prefix", "f").mapInArrow(lefts, "lang string, phrase string, words int, a long, left array<long>")


def _score(a: str, left: str, right: str):
    return F.expr(f"cast((cast(1000000 as decimal(38,0)) * cast({a} as decimal(38,0)) * {a}) div (cast({left} as decimal(38,0)) * {right}) as bigint)")


def collocations(
    docs: DataFrame, min_count: int = 10, max_words: int = 3, inside_percent: int = 50, top: int = 2000,
    budget: int = 1_000_000, lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased in A-Z and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces
    and those at blanks and tabs into words; a null text is empty, a null
    language ``und``. ``a`` is a phrase's count within pieces, ``l`` and ``r``
    those of its two parts at the cut of least score 1000000 a a / (l r) (floor;
    ties: the first cut), ``n`` the language's words. A candidate (at least
    ``min_count``, 2 to ``max_words`` words) is dropped if a longer candidate
    holds it and occurs at least ``inside_percent`` % as often. Ranks go by
    score, count (both descending) and phrase (by bytes). Repeated rows count
    as often as they occur; other columns are not read; no phrase, no row.
    """
    if not 2 <= max_words <= MOST_WORDS or min_count < 1:
        raise ValueError(f"phrases have 2 to {MOST_WORDS} words and occur at least once")
    words, phrases = phrase_counts(docs, min_count, max_words, budget, lang_col, text_col)
    counted = words.where(F.col("f") >= min_count).select("lang", F.col("prefix").alias("part"), F.col("f").alias("r"))
    counted = counted.unionByName(phrases.where(F.col("words") < max_words).select("lang", F.col("phrase").alias("part"), F.col("a").alias("r")))
    split = F.split("phrase", " ")
    cuts = phrases.select("lang", "phrase", "a", F.posexplode("left").alias("k", "l"), split.alias("w"))
    cuts = cuts.withColumn("part", F.array_join(F.expr("slice(w, k + 2, size(w))"), " "))
    cuts = cuts.join(counted, ["lang", "part"]).withColumn("score", _score("a", "l", "r"))
    best = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("c"))
    inner = F.expr("""flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), i -> array_join(slice(w, i, m), ' '))))""")
    longer = phrases.where(F.col("words") > 2).withColumn("w", split).select("lang", F.col("a").alias("f"), F.explode(inner).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(F.col("f").isNull() | (100 * F.col("f") < inside_percent * F.col("a")))
    kept = kept.select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), F.col("c.score").alias("score"))
    order = "ORDER BY score DESC, a DESC, phrase"
    # first the best of parts of a language, then of these
    kept = kept.withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(32)))
    kept = kept.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang, deal {order})")).where(F.col("rank") <= top).drop("rank", "deal")
    kept = kept.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang {order})")).where(F.col("rank") <= top)
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    out = kept.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    out = written(out, "collocations")
    drop_written(words)
    drop_written(phrases)
    return out


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
s AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, 1 AS k, unnest(w) AS phrase FROM s
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i+1], ' '))) FROM s WHERE len(w) >= 2
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))) FROM s WHERE len(w) >= 3),
c AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
size AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM c WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM c WHERE k >= 2 AND f >= 10),
cut AS (SELECT lang, phrase, a, w, 1 AS cut_at, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM cand
  UNION ALL SELECT lang, phrase, a, w, 2, array_to_string(w[1:2], ' '), w[3] FROM cand WHERE k = 3),
scored AS (SELECT cut.*, cl.f AS l, cr.f AS r,
    (1000000::HUGEINT * a * a) // (cl.f::HUGEINT * cr.f) AS score,
    row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY (1000000::HUGEINT * a * a) // (cl.f::HUGEINT * cr.f), cut_at) AS pick
  FROM cut JOIN c cl ON cl.lang = cut.lang AND cl.phrase = x JOIN c cr ON cr.lang = cut.lang AND cr.phrase = y),
inside AS (SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a AS f FROM cand WHERE k = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM cand WHERE k = 3) GROUP BY ALL),
kept AS (SELECT s.* FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE pick = 1 AND (i.f IS NULL OR 100 * i.f < 50 * s.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN size ON size.lang = ranked.lang WHERE rank <= 2000
"""
