"""Words of many texts encoded at once, in arrays.

Texts of printable ASCII, blanks and Latin-1 letters are joined into one byte
array, cut into words by byte classes, and each word is hashed to 64 bits
(prefix sums). Only words that the bounded table does not hold are merged; the
ids of all words are then gathered from the table. Hashes only find a word: its
bytes are compared with those in the table on every hit, and a word that shares
a hash with another one is encoded by itself.
"""

from __future__ import annotations

import numpy as np

#: Bytes of a text that the arrays can take: blanks, printable ASCII and, in UTF-8, Latin-1 letters.
SIMPLE = bytes([9, 10, 13, *range(32, 127), *range(0x80, 0xC0), 0xC3])
#: The two signs among these letters; such texts, and longer ones, are left to others.
SIGNS = (b"\xc3\x97", b"\xc3\xb7")
LARGEST, BLOCK = 4_000_000, 2_000_000
BLANK, LETTER, DIGIT, SIGN, GAP = range(5)
CLASS = np.full(256, SIGN, dtype=np.uint8)
CLASS[[9, 10, 13, 32]] = BLANK
CLASS[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), 0xC3]] = LETTER
CLASS[48:58] = DIGIT
CLASS[0] = GAP  # between texts


def plain(text: bytes) -> bool:
    """Of a text in valid UTF-8: can it be worked in arrays?"""
    return len(text) <= LARGEST and not text.translate(None, SIMPLE) and not any(s in text for s in SIGNS)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts with a gap after each, and where each begins."""
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    return np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8), np.cumsum(sizes) - sizes


def lower(text: np.ndarray) -> np.ndarray:
    out = text.copy()
    out[(text >= 65) & (text <= 90)] += 32
    second = np.flatnonzero(text[:-1] == 0xC3) + 1
    out[second[text[second] <= 0x9E]] += 32
    return out


def _runs(text: np.ndarray, single_digits: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and class of runs of one class."""
    kind = CLASS[text]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == GAP)
    if single_digits:
        new |= kind == DIGIT
    start = np.flatnonzero(new)
    return start, np.append(start[1:], len(text)), kind[start]


def _contractions(text, start, end, kind, free):
    """Give ``'s 't 'm 'd 're 've 'll`` their letters, where the quote is a run by itself (``free``)."""
    at = np.flatnonzero((kind == SIGN) & (end - start == 1) & (text[start] == 39) & free)
    p = start[at]
    one, two = text[np.minimum(p + 1, len(text) - 1)], text[np.minimum(p + 2, len(text) - 1)]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((two == 101) & ((one == 114) | (one == 118))) | ((one == 108) & (two == 108))
    size = np.where(short, 2, np.where(long, 3, 1))
    end, start = end.copy(), start.copy()
    end[at] = p + size
    hit = at[size > 1]
    start[hit + 1] = end[hit]  # the letters that follow
    return start, end


def words_without_blanks(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letter runs, single digits, sign runs and contractions; blanks are dropped."""
    start, end, kind = _runs(text, True)
    start, end = _contractions(text, start, end, kind, np.ones(len(start), dtype=bool))
    keep = (kind != BLANK) & (kind != GAP) & (end > start)
    return start[keep], end[keep]


def words_with_blanks(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The byte-level split: a run takes a space before it; of other blanks
    before a word the last one stands alone, those before it are one word."""
    start, end, kind = _runs(text, False)
    blank = kind == BLANK
    before_word = np.append(blank[:-1] & (kind[1:] != GAP), False)
    space_last = text[end - 1] == 32
    gives = before_word & space_last  # its last space goes to the next run
    takes = np.append(False, gives[:-1])
    free = ~takes
    s, e = _contractions(text, start, end, kind, free)
    s = s - takes
    first_end = np.where(before_word, e - 1, e)  # a blank run without its last
    main_end = np.where(blank, first_end, e)
    alone = before_word & ~space_last
    starts = np.concatenate([s, end[alone] - 1])
    ends = np.concatenate([main_end, end[alone]])
    kinds = np.concatenate([kind, kind[alone]])
    keep = (kinds != GAP) & (ends > starts)
    starts, ends = starts[keep], ends[keep]
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order]


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each range, range by range."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Hasher:
    """64-bit hashes of slices of an array by prefix sums of weighted bytes."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self):
        self.values = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.powers = self.inverse = np.zeros(0, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        def powers(base: int) -> np.ndarray:
            out = np.ones(1, dtype=np.uint64)
            while len(out) < n:
                out = np.concatenate([out, out * np.uint64(pow(base, len(out), 2**64))])
            return out

        self.powers, self.inverse = powers(self.BASE), powers(pow(self.BASE, -1, 2**64))

    def hashes(self, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if len(self.powers) < len(text):
            self._grow(len(text))
        sums = np.zeros(len(text) + 1, dtype=np.uint64)
        np.cumsum(self.values[text] * self.powers[: len(text)], out=sums[1:])
        h = (sums[end] - sums[start]) * self.inverse[start]
        return h ^ ((end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


LOW_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype="<u8")


def eights(text: np.ndarray) -> np.ndarray:
    """At each place of an array of bytes, the eight bytes from there as one number."""
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)])
    return np.ndarray((len(text) + 1,), dtype="<u8", buffer=padded, strides=(1,))


def same_bytes(a, a_start, b, b_start, size) -> np.ndarray:
    """Per pair of slices of one size, of two arrays given as ``eights``: are they equal?"""
    out = np.ones(len(size), dtype=bool)
    at, k = np.flatnonzero(size > 0), 0
    while len(at):
        differ = (a[a_start[at] + k] ^ b[b_start[at] + k]) & LOW_BYTES[np.minimum(size[at] - k, 8)]
        out[at[differ != 0]] = False
        k += 8
        at = at[(differ == 0) & (size[at] > k)]
    return out


class WordTable:
    """Words found by hash -> their ids, for at most about ``limit`` words and
    ``most_bytes`` of them; when full, words that were not asked for since the
    last time are let go."""

    def __init__(self, encode, limit: int = 600_000, most_bytes: int = 32_000_000, hasher=None):
        self.encode, self.limit, self.most_bytes, self.hasher = encode, limit, most_bytes, hasher or Hasher()
        none = np.zeros(0, np.int64)
        self._set(np.zeros(0, np.uint64), none, none, np.zeros(0, np.int32), none, none, np.zeros(0, np.uint8))

    def _set(self, keys, start, size, pool, at, length, text):
        """Sorted hashes, where their ids and their bytes are, ids, bytes."""
        self.keys, self.start, self.size, self.pool = keys, start, size, pool
        self.at, self.length, self.text, self.text8 = at, length, text, eights(text)
        self.asked = np.zeros(len(keys), dtype=bool)

    def _keep(self, chosen: np.ndarray) -> None:
        size, length = self.size[chosen], self.length[chosen]
        pool, text = self.pool[spread(self.start[chosen], size)], self.text[spread(self.at[chosen], length)]
        self._set(self.keys[chosen], np.cumsum(size) - size, size, pool, np.cumsum(length) - length, length, text)

    def _add(self, keys, flat, size, text, begin, length) -> None:
        to = np.searchsorted(self.keys, keys)
        asked = np.insert(self.asked, to, True)
        start, at = np.cumsum(size) - size + len(self.pool), np.cumsum(length) - length + len(self.text)
        self._set(
            np.insert(self.keys, to, keys), np.insert(self.start, to, start), np.insert(self.size, to, size), np.concatenate([self.pool, flat]),
            np.insert(self.at, to, at), np.insert(self.length, to, length), np.concatenate([self.text, text[spread(begin, length)]]),
        )
        self.asked = asked

    def ids(self, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in order, and how many each has."""
        length, text8 = end - start, eights(text)
        found, first, inverse = np.unique(self.hasher.hashes(text, start, end), return_index=True, return_inverse=True)
        if len(self.keys) + len(found) > self.limit or len(self.text) > self.most_bytes:
            self._keep(np.flatnonzero(self.asked) if self.asked.mean() < 0.5 and len(self.text) <= self.most_bytes else np.zeros(0, np.int64))
        at = np.searchsorted(self.keys, found)
        known = np.zeros(len(found), dtype=bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == found[inside]
        new = first[~known]
        if len(new):
            self._add(found[~known], *self.encode(text, start[new], end[new]), text, start[new], length[new])
            at = np.searchsorted(self.keys, found)
        self.asked[at] = True
        at = at[inverse]
        same = length == self.length[at]
        same[same] = same_bytes(text8, start[same], self.text8, self.at[at[same]], length[same])
        begin, size, pool = self.start[at], self.size[at], self.pool
        if not same.all():  # another word's hash
            other = np.flatnonzero(~same)
            flat, sizes = self.encode(text, start[other], end[other])
            begin[other], size[other] = np.cumsum(sizes) - sizes + len(pool), sizes
            pool = np.concatenate([pool, flat])
        return pool[spread(begin, size)], size


def encode_plain(table: WordTable, texts: list[bytes], cut, change=None):
    """Ids of each text, as views of one array a block; ``cut`` finds the words."""
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (j == i or n + len(texts[j]) <= BLOCK):
            n += len(texts[j]) + 1
            j += 1
        text, begin = joined(texts[i:j])
        if change is not None:
            text = change(text)
        start, end = cut(text)
        flat, size = table.ids(text, start, end)
        ends = np.concatenate(([0], np.cumsum(size)))
        bounds = ends[np.searchsorted(start, np.append(begin, len(text)))]
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            yield flat[a:b]
        i = j
