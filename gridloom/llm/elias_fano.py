"""Elias-Fano sequences and the levels of an n-gram trie over flat byte buffers."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import cached_property

import numpy as np

U64 = np.uint64
ONE = U64(1)
#: A sequence is decoded when a value was sought for every so many that it has.
DECODE_SHARE = 8


def pack(arrays: Mapping[str, np.ndarray]) -> bytes:
    """Arrays as one buffer that can be mapped: a header with types and offsets, then the data at multiples of 8."""
    head, body, at = {}, [], 0
    for name, array in arrays.items():
        raw = np.ascontiguousarray(array).tobytes()
        head[name] = [array.dtype.str, len(array), at]
        pad = -len(raw) % 8
        body.append(raw + bytes(pad))
        at += len(raw) + pad
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    return b"".join([len(text).to_bytes(8, "little"), text, *body])


def unpack(buffer, offset: int = 0) -> dict[str, np.ndarray]:
    """Views into a buffer that :func:`pack` made; nothing is copied."""
    size = int.from_bytes(bytes(buffer[offset : offset + 8]), "little")
    head = json.loads(bytes(buffer[offset + 8 : offset + 8 + size]))
    start = offset + 8 + size
    return {name: np.frombuffer(buffer, np.dtype(kind), count, start + at) for name, (kind, count, at) in head.items()}


def _select_in_word(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Position of the set bit number ``rank`` (from 0) of each 64-bit word, by halving."""
    at, rest, left = np.zeros(len(words), U64), words.copy(), rank.astype(np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        low = rest & ((ONE << U64(width)) - ONE)
        n = np.bitwise_count(low).astype(np.int64)
        beyond = left >= n
        left = np.where(beyond, left - n, left)
        at += np.where(beyond, U64(width), U64(0))
        rest = np.where(beyond, rest >> U64(width), low)
    return at.astype(np.int64)


class EliasFano:
    """A non-decreasing sequence of 64-bit values: packed low bits, unary high bits and their running counts."""

    def __init__(self, arrays: Mapping[str, np.ndarray], name: str):
        self.n, self.bits = (int(x) for x in arrays[f"{name}.shape"])
        self.low, self.high, self.ones = arrays[f"{name}.low"], arrays[f"{name}.high"], arrays[f"{name}.ones"]
        self.zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones  # before each word
        self.sought = 0  # values that were looked for so far

    @staticmethod
    def build(values: np.ndarray, universe: int, name: str) -> dict[str, np.ndarray]:
        """The arrays of a sequence with values below ``universe``."""
        n = len(values)
        bits = max(0, (universe // max(1, n)).bit_length() - 1)
        values = values.astype(U64)
        low = np.zeros(n * bits // 64 + 2, U64)
        if bits:
            part = values & U64((1 << bits) - 1)
            at = np.arange(n, dtype=np.int64) * bits
            word, off = at >> 6, (at & 63).astype(U64)
            np.bitwise_or.at(low, word, part << off)
            over = off.astype(np.int64) + bits > 64
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (U64(64) - off[over]))
        place = (values >> U64(bits)).astype(np.int64) + np.arange(n)
        size = (universe >> bits) + n + 1
        ones = np.zeros((size // 64 + 1) * 64, np.uint8)
        ones[place] = 1
        high = np.packbits(ones, bitorder="little").view(U64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high))[:-1]]).astype(np.int32)
        return {f"{name}.shape": np.array([n, bits]), f"{name}.low": low, f"{name}.high": high, f"{name}.ones": ones}

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), U64)
        at = i.astype(np.int64) * self.bits
        word, off = at >> 6, (at & 63).astype(U64)
        above = np.where(off > 0, self.low[word + 1] << ((U64(64) - off) & U64(63)), U64(0))
        return ((self.low[word] >> off) | above) & U64((1 << self.bits) - 1)

    def _select(self, running: np.ndarray, words: np.ndarray, k: np.ndarray, flip: bool) -> np.ndarray:
        word = np.searchsorted(running, k, side="right") - 1
        return word * 64 + _select_in_word(~words[word] if flip else words[word], k - running[word])

    def at(self, i: np.ndarray) -> np.ndarray:
        """The values at positions ``i``."""
        i = np.asarray(i, dtype=np.int64)
        high = self._select(self.ones, self.high, i, False) - i
        return (high.astype(U64) << U64(self.bits)) | self._low(i)

    @cached_property
    def values(self) -> np.ndarray:
        """All values, decoded."""
        i = np.arange(self.n)
        high = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))[: self.n] - i
        return (high.astype(U64) << U64(self.bits)) | self._low(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position of the first value that is at least ``x`` (n without one), and whether it equals ``x``.

        The high bits give the run of candidates, which is halved by the low bits. A sequence in which many
        values are sought, in one call or several, is decoded once instead.
        """
        x = x.astype(U64)
        self.sought += len(x)
        if self.sought >= self.n // DECODE_SHARE:
            at = np.searchsorted(self.values, x)
            same = at < self.n
            same[same] = self.values[at[same]] == x[same]
            return at, same
        top = (x >> U64(self.bits)).astype(np.int64)
        want = x & U64((1 << self.bits) - 1)
        before = np.maximum(top - 1, 0)
        lo = np.where(top > 0, self._select(self.zeros, self.high, before, True) - before, 0)
        end = self._select(self.zeros, self.high, top, True) - top
        hi = end.copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            less = np.zeros(len(x), bool)
            less[open_] = self._low(mid[open_]) < want[open_]
            lo = np.where(open_ & less, mid + 1, lo)
            hi = np.where(open_ & ~less, mid, hi)
        same = lo < end
        same[same] = self._low(lo[same]) == want[same]
        return lo, same


#: Bits of a follower's hash within its context: one in 10^9 unseen followers of a context of 1,000 is taken for a seen one.
FOLLOWER_BITS = 40


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """8-bit codes and their codebook: the means of 256 ranges with equally many values."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.float32)
    cuts = np.unique(np.quantile(values, np.linspace(0, 1, 257)[1:-1]))
    codes = np.searchsorted(cuts, values, side="right")
    n = np.bincount(codes, minlength=len(cuts) + 1)
    book = np.bincount(codes, values, len(cuts) + 1) / np.maximum(n, 1)
    return codes.astype(np.uint8), book.astype(np.float32)


def build_section(first: int, end: int, words: np.ndarray, counts: np.ndarray, backoff: np.ndarray, context: np.ndarray, follower: np.ndarray, gain: np.ndarray) -> bytes:
    """Two levels of a trie for the words with hashes in [first, end).

    Level 1: sorted word hashes, running counts, quantised backoff weights (log10 of what the followers of a word
    leave over) and monotone pointers into level 2. Level 2: per context the sorted follower hashes, offset so
    that the whole level increases, and quantised gains: log10 of the discounted share of a follower over its unigram.
    """
    order = np.argsort(words)
    words, counts, backoff = words[order], counts[order], backoff[order]
    parent = np.searchsorted(words, context)
    short = follower >> U64(64 - FOLLOWER_BITS)
    order = np.lexsort((short, parent))
    parent, short, gain = parent[order], short[order], gain[order]
    pointers = np.searchsorted(parent, np.arange(len(words) + 1))
    running = np.concatenate([[0], np.cumsum(counts)])
    codes, book = quantise(backoff)
    gain_codes, gain_book = quantise(gain)
    arrays = {"range": np.array([first, end - 1], U64), "backoff": codes, "backoff.book": book, "gain": gain_codes, "gain.book": gain_book}
    arrays |= EliasFano.build(words - U64(first), end - first, "words")
    arrays |= EliasFano.build(running, int(running[-1]) + 1, "counts")
    arrays |= EliasFano.build(pointers, len(parent) + 1, "pointers")
    arrays |= EliasFano.build((parent.astype(U64) << U64(FOLLOWER_BITS)) + short, max(1, len(words)) << FOLLOWER_BITS, "followers")
    return pack(arrays)


class Section:
    """A mapped section; queries are whole arrays."""

    def __init__(self, buffer, offset: int):
        a = unpack(buffer, offset)
        self.first, self.last = a["range"]
        self.words, self.counts, self.pointers, self.followers = (EliasFano(a, name) for name in ("words", "counts", "pointers", "followers"))
        self.backoff, self.backoff_book, self.gain, self.gain_book = a["backoff"], a["backoff.book"], a["gain"], a["gain.book"]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Node of each hash of this section's range (or -1), and its count."""
        at, same = self.words.successor(hashes - self.first)
        node, count = np.where(same, at, -1), np.zeros(len(hashes), np.int64)
        if same.any():
            hit = at[same]
            count[same] = (self.counts.at(hit + 1) - self.counts.at(hit)).astype(np.int64)
        return node, count

    def after(self, node: np.ndarray, follower: np.ndarray, left: float | None = None, seen: int = 1) -> np.ndarray:
        """What the bigram adds to the unigram's log10 probability: the backoff weight (log10 ``left``, where that is
        given), together with the gain of a known follower, divided by ``seen``.

        """
        value = self.backoff_book[self.backoff[node]].astype(float) if left is None else np.full(len(node), np.log10(left))
        at, same = self.follower(node, follower >> U64(64 - FOLLOWER_BITS))
        value[same] = np.log10(10.0 ** self.gain_book[self.gain[at[same]]].astype(float) / seen + 10.0 ** value[same])
        return value

    def follower(self, node: np.ndarray, short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the followers of contexts, given by the top ``FOLLOWER_BITS`` of their hashes, stand in the second level, and whether they do.

        The offset of a context is part of the values of the level, so an equal one is a follower of it.
        """
        return self.followers.successor((node.astype(U64) << U64(FOLLOWER_BITS)) + short)
