"""Words, n-grams and their 64-bit hashes for many texts at once.

A word is a run of bytes outside space, tab, line feed, vertical tab, form feed and carriage
return. Hashes depend on the bytes alone: a multilinear hash over the bytes of a word, a rolling
polynomial over the hashes of its n words, and a final mix.
"""

from __future__ import annotations

import numpy as np

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
_BASE = 0xD6E8FEB86659FD93


def mix(values: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the whole word."""
    z = values + _GOLDEN
    z = (z ^ (z >> np.uint64(30))) * _MIX_A
    z = (z ^ (z >> np.uint64(27))) * _MIX_B
    return z ^ (z >> np.uint64(31))


def encode(texts, lower: bool = False) -> list[bytes]:
    """UTF-8 bytes of each text (null: empty), A-Z lowered if asked."""
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    return [r.lower() for r in raw] if lower else raw


class Words:
    """Word hashes and byte ranges of a batch of texts.

    ``hashes``, ``starts`` and ``ends`` have one entry per word; the words of text ``i`` are those
    from ``first[i]`` up to ``first[i + 1]``. Byte ranges refer to ``data``.
    """

    def __init__(self, raw: list[bytes]):
        self.data = b" ".join(raw) + b" "
        sizes = np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))
        self.offsets = np.concatenate(([0], np.cumsum(sizes)))
        buffer = np.frombuffer(self.data, np.uint8)
        inside = np.ones(256, np.bool_)
        inside[[9, 10, 11, 12, 13, 32]] = False
        filled = inside[buffer]
        edge = np.flatnonzero(filled[1:] != filled[:-1]) + 1
        if len(buffer) and filled[0]:
            edge = np.concatenate(([0], edge))
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.starts, self.offsets)
        self.hashes = self._hash(buffer)

    def _hash(self, buffer: np.ndarray) -> np.ndarray:
        count = len(self.starts)
        if count == 0:
            return np.zeros(0, np.uint64)
        sizes = self.ends - self.starts
        factors = mix(np.arange(int(sizes.max()), dtype=np.uint64) * _GOLDEN) | np.uint64(1)
        hashes = mix(sizes.astype(np.uint64))
        # One step per byte position, over the words that reach it; few words are long.
        alive, at = np.arange(count), 0
        starts = self.starts
        while len(alive) > 64:
            hashes[alive] += (buffer[starts[alive] + at].astype(np.uint64) + np.uint64(1)) * factors[at]
            at += 1
            alive = alive[sizes[alive] > at]
        for i in alive:
            rest = buffer[starts[i] + at : starts[i] + sizes[i]].astype(np.uint64) + np.uint64(1)
            hashes[i : i + 1] += np.sum(rest * factors[at : sizes[i]], dtype=np.uint64)
        return mix(hashes)

    def counts(self) -> np.ndarray:
        """Number of words of each text."""
        return np.diff(self.first)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words that start at each place; empty if there are fewer words."""
    places = len(hashes) - size + 1
    if places <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(places, np.uint64)
    factor = 1
    for step in range(size):
        total += hashes[step : step + places] * np.uint64(factor)
        factor = factor * _BASE % (1 << 64)
    return mix(total)


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where the set of each text begins.

    A text with fewer than ``size`` words has its whole word sequence as one shingle; one without
    words has an empty set.
    """
    counts = words.counts()
    texts = len(counts)
    owner = np.repeat(np.arange(texts), counts)
    grams = windows(words.hashes, size)
    # A window belongs to a text if its first and last word do.
    whole = owner[: len(grams)] == owner[size - 1 : size - 1 + len(grams)]
    grams, owner = grams[whole], owner[: len(whole)][whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for i, text in enumerate(short):
            part = words.hashes[words.first[text] : words.first[text + 1]]
            extra[i] = windows(part, len(part))[0] ^ np.uint64(len(part))
        grams, owner = np.concatenate((grams, extra)), np.concatenate((owner, short))
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    keep = np.ones(len(grams), np.bool_)
    keep[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[keep], owner[keep]
    return grams, np.searchsorted(owner, np.arange(texts + 1))


def pieces(values, limit: int = 4 << 20):
    """Ranges of a list of texts with about ``limit`` characters each, for bounded work arrays."""
    begin, size = 0, 0
    for i, value in enumerate(values):
        size += len(value) if value else 0
        if size >= limit:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(values):
        yield begin, len(values)
