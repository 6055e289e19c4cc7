"""Vectorised word and n-gram hashes of UTF-8 texts.

Words are maximal runs of bytes other than the blank and 0x09 to 0x0D. A word's hash sums, over its
groups of eight bytes, a mixed value of the group and its place, and is mixed again with the length:
no sum of powers, so no two words are equal by their structure. An n-gram's hash is mixed from its
words' hashes in order. Hashes have 64 bits; where they travel as keys, ``key_bits`` tells how many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PIECE_BYTES = 1_000_000
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
#: What a load of eight bytes keeps of a group of so many.
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that every bit of the input reaches every bit of the output."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < size:
        size = max(size + size // 4, PIECE_BYTES + PIECE_BYTES // 4)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _powers


def _hash_piece(raw: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of the words of a text that ends with a separator."""
    b = np.frombuffer(raw, np.uint8)
    space = _SPACE[b]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[::2], edge[1::2]
    if lower:
        b = b + ((b >= 65) & (b <= 90)).astype(np.uint8) * np.uint8(32)
    size = end - start
    groups = np.lib.stride_tricks.sliding_window_view(np.concatenate((b, np.zeros(7, np.uint8))), 8)
    load = lambda at, n: groups[at].view("<u8")[:, 0] & _MASKS[np.minimum(n, 8)]
    h = mix(load(start, size))
    long = np.flatnonzero(size > 8)
    if len(long):
        n = (size[long] - 1) // 8
        word = np.repeat(long, n)
        place = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n) + 1
        rest = mix(load(start[word] + 8 * place, size[word] - 8 * place) + mix(place.astype(np.uint64) * np.uint64(_BASE)))
        h[long] += np.add.reduceat(rest, np.cumsum(n) - n)
    return mix(h + size.astype(np.uint64) * np.uint64(_BASE)), start


def _pieces(texts: list[bytes | None]) -> Iterator[tuple[bytes, list[int], list[int]]]:
    """Texts joined by separators to pieces of bounded size; with the number and offset of each text in a piece.

    Texts longer than a piece are cut at separators.
    """
    parts: list[bytes] = []
    numbers: list[int] = []
    offsets: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        text, at = text or b"", 0
        while True:
            stop = len(text)
            if stop - at > PIECE_BYTES:
                stop = max(text.rfind(s, at, at + PIECE_BYTES) for s in (b" ", b"\n", b"\t", b"\v", b"\f", b"\r")) + 1
                if stop <= at:  # a word longer than a piece
                    stop = min((k + 1 for s in (b" ", b"\n", b"\t", b"\v", b"\f", b"\r") if (k := text.find(s, at)) >= 0), default=len(text))
            numbers.append(i)
            offsets.append(size)
            parts.append(text[at:stop])
            size += stop - at + 1
            if size > PIECE_BYTES:
                yield b"\n".join(parts) + b"\n", numbers, offsets
                parts, numbers, offsets, size = [], [], [], 0
            if stop == len(text):
                break
            at = stop
    if parts:
        yield b"\n".join(parts) + b"\n", numbers, offsets


def word_hashes(texts: list[bytes | None], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the number of each word's text."""
    hashes, owners = [], []
    for raw, numbers, offsets in _pieces(texts):
        h, start = _hash_piece(raw, lower)
        hashes.append(h)
        owners.append(np.array(numbers, np.int64)[np.searchsorted(np.array(offsets), start, "right") - 1])
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def ngram_hashes(words: np.ndarray, owners: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams that lie within a text, and their texts."""
    if len(words) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    last = len(words) - n + 1
    h = np.full(last, n, np.uint64)
    for k in range(n):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + words[k : k + last])
    inside = owners[:last] == owners[n - 1 :]
    return h[inside], owners[:last][inside]


def shingles(words: np.ndarray, owners: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n-gram hashes; a text with fewer words, but some, has its whole sequence as one."""
    h, of = ngram_hashes(words, owners, n)
    if not len(words):
        return h, of
    first = np.flatnonzero(np.concatenate(([True], owners[1:] != owners[:-1])))
    size = np.diff(np.concatenate((first, [len(words)])))
    more_h, more_of = [h], [of]
    for m in range(1, n):
        at = first[size == m]
        x = np.full(len(at), m, np.uint64)
        for k in range(m):
            x = mix(x * np.uint64(0xD6E8FEB86659FD93) + words[at + k])
        more_h.append(x)
        more_of.append(owners[at])
    return np.concatenate(more_h), np.concatenate(more_of)


def key_bits(n_buckets: int) -> int:
    """Bits of a key with which, at any number of buckets of a million keys, no more than one in a million meets another of the same value."""
    return min(64, max(48, 40 + max(0, n_buckets - 1).bit_length()))


def keys(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - bits)
