"""Suffixes in order by induction, with common-prefix values, through queues on disk.

The text is bytes without 254 and 255 (UTF-8 has neither), strings end with ``SEPARATOR``.
A suffix is smaller (S) or larger (L) than the one after it; S* are S suffixes after an L.

1. S* suffixes are sorted by their names: ranks of the pieces between them, refined by
   doubling, until they differ or agree in more than ``depth`` bytes.
2. Scanning upwards, every suffix in order puts the suffix before it, if L, into the queue of
   its first byte. Queues are drained in order, so this is a priority queue whose keys only
   grow; a queue's items come out as they went in, which is their order.
3. Scanning downwards, the same yields the S suffixes.

Items carry their common prefix with the item before them in the queue: one byte more than
the least value passed since that one was put in. Values stop at ``depth``. A queue keeps
little in memory and the rest in an unnamed temporary file of its task, gone with the task.
All steps work on whole runs of a queue at once.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

SEPARATOR = 0xFE
PAD = 0xFF
#: Bytes that a queue holds in memory before it goes on in a file.
QUEUE_BYTES = 1 << 20


class Queue:
    """Positions and common-prefix values, first in, first out, beyond memory on disk."""

    def __init__(self) -> None:
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, self.file, self.lengths = 0, None, []

    def put(self, positions: np.ndarray, prefixes: np.ndarray) -> None:
        self.held.append((positions, prefixes))
        self.size += len(positions) * 9
        if self.size > QUEUE_BYTES:
            self.file = self.file or tempfile.TemporaryFile()
            for p, c in self.held:
                self.file.write(p.astype(np.int64).tobytes())
                self.file.write(c.astype(np.uint8).tobytes())
                self.lengths.append(len(p))
            self.held, self.size = [], 0

    def take(self) -> tuple[np.ndarray, np.ndarray] | None:
        """All that is in it, at once."""
        parts = []
        if self.lengths:
            self.file.seek(0)
            for n in self.lengths:
                p = np.frombuffer(self.file.read(8 * n), np.int64)
                parts.append((p, np.frombuffer(self.file.read(n), np.uint8)))
            self.file.seek(0)
            self.file.truncate()
            self.lengths = []
        parts += self.held
        self.held, self.size = [], 0
        if not parts:
            return None
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


class Ranges:
    """Least values of ranges of an array, by a table of powers of two."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 * (1 << (len(self.rows) - 1)) <= len(values):
            step, last = 1 << (len(self.rows) - 1), self.rows[-1]
            row = last.copy()
            np.minimum(last[:-step], last[step:], out=row[:-step])
            self.rows.append(row)
        self.table = np.stack(self.rows)

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        power = np.log2(last - first + 1).astype(np.int64)
        return np.minimum(
            self.table[power, first], self.table[power, last - (1 << power) + 1])


class Text:
    """The bytes, which suffixes are S, and prefixes' comparison eight bytes at a time."""

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        self.bytes, self.depth = text, depth
        self.padded = np.concatenate([text, np.zeros(depth + 32, np.uint8)])
        self.words = np.ndarray((n + depth + 16,), ">u8", self.padded, strides=(1,))
        differs = np.full(n, n, np.int64)
        change = np.flatnonzero(text[:-1] != text[1:])
        differs[change] = change
        differs = np.minimum.accumulate(differs[::-1])[::-1]
        known = np.minimum(differs, max(n - 2, 0))
        self.smaller = (differs < n) & (self.padded[known] < self.padded[known + 1])

    def word(self, at: np.ndarray) -> np.ndarray:
        return self.words[np.minimum(at, len(self.words) - 1)].astype(np.uint64)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefixes of pairs of suffixes, up to ``depth``."""
        out = np.full(len(a), self.depth, np.uint8)
        alive = np.arange(len(a))
        for k in range(0, self.depth, 8):
            x = self.word(a[alive] + k) ^ self.word(b[alive] + k)
            apart = x != 0
            equal = sum((x[apart] < np.uint64(1 << s)).astype(np.int64)
                        for s in range(8, 64, 8))
            out[alive[apart]] = np.minimum(self.depth, k + equal)
            alive = alive[~apart]
            if not len(alive):
                break
        return out


def _split(rank: np.ndarray, some: np.ndarray, key: np.ndarray) -> None:
    """Order ``some``, whole groups of equal rank, by ``key``; ranks are places of groups."""
    order = np.lexsort((key, rank[some]))
    r, k = rank[some][order], key[order]
    place = np.arange(len(r))
    group = np.ones(len(r), bool)
    group[1:] = r[1:] != r[:-1]
    new = group.copy()
    new[1:] |= k[1:] != k[:-1]
    first = np.maximum.accumulate(np.where(group, place, 0))
    part = np.maximum.accumulate(np.where(new, place, 0))
    rank[some[order]] = r + part - first


def _tied(rank: np.ndarray) -> np.ndarray:
    return np.bincount(rank, minlength=len(rank))[rank] > 1


def sorted_seeds(text: Text) -> tuple[np.ndarray, np.ndarray]:
    """S* suffixes in order, and their common prefixes with the one before."""
    small = text.smaller
    at = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if not len(at):
        return at, np.zeros(0, np.uint8)
    ends = np.append(at[1:] + 1, len(text.bytes) + 1)
    length = ends - at

    def piece(some: np.ndarray, k: int) -> np.ndarray:
        """Eight bytes of the pieces; what is behind a piece is larger, as shorter ones are."""
        left = np.clip(length[some] - k, 0, 8).astype(np.uint64) * np.uint64(8)
        behind = np.where(left < 64, np.uint64(0xFFFFFFFFFFFFFFFF) >> np.minimum(left, 63), 0)
        return text.word(at[some] + k) | behind.astype(np.uint64)

    rank = np.zeros(len(at), np.int64)
    k = 0
    while True:
        some = np.flatnonzero(_tied(rank) & (length > k)) if k else np.arange(len(at))
        if not len(some):
            break
        _split(rank, some, piece(some, k))
        k += 8
    ahead = 1
    while 2 * ahead <= text.depth + 2:  # pieces advance two bytes each, at least
        some = np.flatnonzero(_tied(rank))
        if not len(some):
            break
        later = np.append(rank, np.full(ahead, -1))[ahead:]
        _split(rank, some, later[some])
        ahead *= 2
    at = at[np.argsort(rank, kind="stable")]
    prefixes = np.zeros(len(at), np.uint8)
    prefixes[1:] = text.common(at[1:], at[:-1])
    return at, prefixes


class _Scan:
    """One scan: takes suffixes in order, queues those before them of the wanted kind."""

    def __init__(self, text: Text, wanted: np.ndarray):
        self.text, self.wanted = text, wanted
        self.queues = [Queue() for _ in range(256)]
        self.passed = np.full(256, text.depth, np.uint8)  # least since the queue's last item
        self.used = np.zeros(256, bool)

    def see(self, positions: np.ndarray, prefixes: np.ndarray) -> None:
        before = positions - 1
        some = np.flatnonzero((before >= 0) & self.wanted[before])
        if len(some):
            first = self.text.bytes[before[some]]
            order = np.argsort(first, kind="stable")
            some, first = some[order], first[order]
            starts = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
            chars, ends = first[starts], np.r_[starts[1:], len(some)]
            since = np.empty(len(some), np.int64)
            since[1:] = some[:-1] + 1
            since[starts] = 0
            ranges = Ranges(prefixes)
            least = ranges.least(since, some)
            least[starts] = np.minimum(least[starts], self.passed[chars])
            value = np.minimum(least.astype(np.int64) + 1, self.text.depth).astype(np.uint8)
            value[starts[~self.used[chars]]] = 0
            for char, s, e in zip(chars, starts, ends, strict=True):
                self.queues[char].put(before[some[s:e]], value[s:e])
            self.used[chars] = True
        np.minimum(self.passed, prefixes.min(), out=self.passed)
        if len(some):
            last = some[ends - 1]
            rest = last + 1 < len(prefixes)
            self.passed[chars] = self.text.depth
            self.passed[chars[rest]] = ranges.least(
                last[rest] + 1, np.full(rest.sum(), len(prefixes) - 1))


def sorted_suffixes(data: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes in order, a first byte at a time: positions, common prefix with the one before.

    Common prefixes are cut at ``depth``; suffixes that agree so far are in any order.
    """
    if not len(data):
        return
    text = Text(data, depth)
    seeds, seed_prefixes = sorted_seeds(text)
    seed_chars = data[seeds]
    larger = [Queue() for _ in range(256)]
    tail: dict[int, int] = {}  # last L suffix of each first byte

    up = _Scan(text, ~text.smaller)
    end = np.array([len(data) - 1])
    up.queues[data[-1]].put(end, np.zeros(1, np.uint8))
    up.used[data[-1]] = True
    for char in range(256):
        while wave := up.queues[char].take():
            larger[char].put(*wave)
            tail[char] = int(wave[0][-1])
            up.see(*wave)
        low, high = np.searchsorted(seed_chars, [char, char + 1])
        if low < high:
            positions, prefixes = seeds[low:high], seed_prefixes[low:high].copy()
            prefixes[0] = (
                text.common(np.array([tail[char]]), positions[:1])[0] if char in tail else 0)
            up.see(positions, prefixes)

    down = _Scan(text, text.smaller)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for char in range(255, -1, -1):
        waves = []
        while wave := down.queues[char].take():
            waves.append(wave)
            down.see(*wave)
        found = larger[char].take()
        joint = np.zeros(1, np.uint8)
        if found:
            positions, prefixes = found
            if waves:
                joint = text.common(positions[-1:], waves[-1][0][-1:])
            down.see(positions[::-1], np.append(prefixes[1:], joint)[::-1])
        if waves:
            s_positions = np.concatenate([w[0] for w in waves])[::-1]
            s_prefixes = np.concatenate([w[1] for w in waves])
            s_prefixes = np.append(joint, s_prefixes[1:][::-1])
            if found:
                positions = np.concatenate([positions, s_positions])
                prefixes = np.concatenate([prefixes, s_prefixes])
            else:
                positions, prefixes = s_positions, s_prefixes
        if found or waves:
            out.append((positions, prefixes))
    yield from reversed(out)
