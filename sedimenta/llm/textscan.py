"""Whole-array scans of bytes: word hashes, byte n-grams, lookups in a dictionary of 64-bit keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard

#: Bytes (or words) taken up at a time; a longer text is taken up in parts.
SEGMENT, WORDS = 2_000_000, 200_000
#: Bytes of texts whose words are held as objects at a time.
TOGETHER = 3_000_000
#: Bytes that no UTF-8 text holds: what stands before a text, and its end.
BEFORE, END = 0xFE, 0xFF


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over all places (a one-to-one map)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random number for every byte, and the multiplier of a byte's place in its word.
BYTE_VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
PLACE = np.uint64(0xD6E8FEB86659FD93)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, the same in every process: a polynomial over random byte values, then mixed with the length."""
    if not words:
        return np.empty(0, np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    start = np.cumsum(size) - size
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(size.max()), PLACE)]))
    place = np.arange(len(data)) - np.repeat(start, size)
    return mixed(np.add.reduceat(BYTE_VALUE[data] * power[place], start) + size.astype(np.uint64))


def runs(n: int, most: int) -> Iterator[slice]:
    return (slice(i, min(n, i + most)) for i in range(0, n, most))


def gathered(sizes: list[int], most: int) -> Iterator[slice]:
    """Consecutive items in runs of about ``most`` units, one at least."""
    begin, n = 0, 0
    for i, size in enumerate(sizes):
        n += size
        if n >= most:
            yield slice(begin, i + 1)
            begin, n = i + 1, 0
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def gram_keys(texts: list[bytes], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, owners, starts): a key for every byte of every text and for its end, with the ``depth`` bytes before it.

    The nearest byte before stands highest in a key, the byte itself lowest, so keys of one near context are next to each other in
    order. Keys of text ``owners[i]`` begin at ``starts[i]``.
    """
    parts: list[tuple[int, bytes, bytes]] = []
    edge = bytes([BEFORE]) * depth
    for owner, text in enumerate(texts):
        whole = text + bytes([END])
        for run in runs(len(whole), SEGMENT):
            before = whole[max(0, run.start - depth): run.start]
            parts.append((owner, (edge + before)[-depth:] if depth else b"", whole[run]))
    for some in gathered([len(p[2]) for p in parts], SEGMENT):
        held = parts[some]
        stream = np.frombuffer(b"".join(b + t for _, b, t in held), np.uint8)
        size = np.fromiter((len(t) for _, _, t in held), np.int64, len(held))
        keys = stream[depth:].astype(np.uint64)
        for j in range(1, depth + 1):
            keys |= stream[depth - j: len(stream) - j].astype(np.uint64) << np.uint64(8 * (depth + 1 - j))
        start = np.cumsum(size + depth) - (size + depth)
        inside = np.ones(len(keys), bool)
        for j in range(depth):  # what stands before a part is context only
            inside[start[1:] - depth + j] = False
        yield keys[inside], np.fromiter((p[0] for p in held), np.int64, len(held)), np.cumsum(size) - size


def shard_of_context(keys: np.ndarray, depth: int) -> np.ndarray:
    """The nearest two bytes before each key's byte; keys that share them belong together."""
    return keys >> np.uint64(8 * (depth - 1))


class Counts:
    """Keys with the sum of their counts, gathered bit by bit."""

    def __init__(self, most: int = 2_000_000):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held, self.most = 0, most

    def add(self, keys: np.ndarray, weight: int) -> None:
        keys = np.sort(keys)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        times = np.diff(np.concatenate([first, [len(keys)]])) * weight
        self.parts.append((keys[first], times))
        self.held += len(first)
        if self.held > self.most:
            self.parts = [self.total()]
            self.held, self.most = len(self.parts[0][0]), max(self.most, 2 * len(self.parts[0][0]))

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        return summed(np.concatenate([k for k, _ in self.parts]), np.concatenate([n for _, n in self.parts]))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


class Lookup:
    """Values of distinct 64-bit keys: a table of slots, and further tables for the keys whose slot is taken."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.tables: list[tuple[np.uint64, np.uint64, np.ndarray, np.ndarray, np.ndarray]] = []
        multiplier = 0x9E3779B97F4A7C15
        while len(keys):
            bits = max(4, int(4 * len(keys) - 1).bit_length())
            factor, shift = np.uint64(multiplier), np.uint64(64 - bits)
            slot = (keys * factor) >> shift
            owner = np.full(1 << bits, -1, np.int32)
            owner[slot] = np.arange(len(keys), dtype=np.int32)
            placed = owner[slot] == np.arange(len(keys))
            table, value = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, values.dtype)
            full = np.zeros(1 << bits, bool)
            table[slot[placed]], value[slot[placed]], full[slot[placed]] = keys[placed], values[placed], True
            self.tables.append((factor, shift, table, value, full))
            keys, values = keys[~placed], values[~placed]
            multiplier = (multiplier * 0xD1342543DE82EF95 + 2) % 2**64 | 1

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The values of ``keys``; an unknown key is an error."""
        out, rest = None, np.arange(0)
        for i, (factor, shift, table, value, full) in enumerate(self.tables):
            asked = keys if i == 0 else keys[rest]
            slot = (asked * factor) >> shift
            found = value[slot]
            missed = np.flatnonzero((table[slot] != asked) | ~full[slot])
            if i == 0:
                out, rest = found, missed
            else:
                out[rest] = found
                rest = rest[missed]
            if not len(rest):
                return out
        if len(keys):
            raise LookupError("a key of the documents is not in their block's dictionary: the documents changed between two reads")
        return np.empty(0)


def pack(values: np.ndarray, rising: bool = False) -> bytes:
    """An array as compressed planes of bytes; ``rising`` numbers as their differences."""
    if not len(values):
        return b""
    if rising:
        values = np.concatenate([values[:1], np.diff(values)])
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, dtype: type, rising: bool = False) -> np.ndarray:
    if not data:
        return np.empty(0, dtype)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    values = np.ascontiguousarray(planes.T).reshape(-1).view(dtype)
    return np.cumsum(values, dtype=dtype) if rising else values
