"""Word n-grams of a batch of texts, interned in an open-addressed NumPy table.

A gram is the bytes of consecutive words joined by one space. All occurrences of one length are hashed
together with xxhash64, lane by lane, and placed together by linear probing: occurrences that reach a free
slot claim it, one of them wins, and whoever meets a slot with its own key compares bytes with the slot's
holder before it takes the slot as its own. So two grams share a slot only if their bytes are equal.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_CODES = np.arange(256, dtype=np.uint8)
_CAPITAL = (_CODES >= 65) & (_CODES <= 90)
_LOWERED = np.where(_CAPITAL, _CODES + np.uint8(32), _CODES).astype(np.uint8)
#: Bytes of words once A-Z are lower-cased: digits, a-z and everything beyond ASCII.
_IN_WORD = ((_LOWERED >= 0x30) & (_LOWERED <= 0x39)) | ((_LOWERED >= 0x61) & (_LOWERED <= 0x7A)) | (_LOWERED >= 0x80)
#: Longer grams are hashed and compared one by one by the library.
LONG = 256
# Fixed values of xxhash64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p) for p in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
    )
)
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):  # the reflected polynomial of crc32
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)


@dataclass(frozen=True)
class Words:
    """Words of a batch: ``packed`` has them lower-cased with a space after each."""

    packed: np.ndarray
    start: np.ndarray
    length: np.ndarray
    text: np.ndarray  #: which text of the batch a word belongs to
    texts: int

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, text) of all runs of ``n`` words within one text, in order."""
        first = np.arange(max(0, len(self.start) - n + 1))
        first = first[self.text[first] == self.text[first + n - 1]]
        last = first + n - 1
        return self.start[first], self.start[last] + self.length[last] - self.start[first], self.text[first]


def words_of(texts: pa.Array) -> Words:
    """Words of all texts; NULL has none."""
    filled = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(filled.buffers()[1], dtype=np.int64)[filled.offset : filled.offset + len(filled) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    data = filled.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[low:high] if data is not None and high > low else np.zeros(0, np.uint8)
    offsets = offsets - low
    inside = _IN_WORD[raw]
    breaks = np.zeros(len(raw) + 1, dtype=bool)
    breaks[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | breaks[1:-1]
    last[:-1] &= ~inside[1:] | breaks[1:-1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    length = end - begin
    start = np.cumsum(length + 1) - (length + 1)
    packed = np.full(int((length + 1).sum()) + 8, 32, dtype=np.uint8)
    kept = np.flatnonzero(inside)
    packed[np.arange(len(kept)) + np.repeat(np.arange(len(length)), length)] = _LOWERED[raw[kept]]
    return Words(packed, start, length, np.searchsorted(offsets, begin, side="right") - 1, len(texts))


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _round(acc, lane: np.ndarray) -> np.ndarray:
    return _rotated(acc + lane * _P2, 31) * _P1


class _Lanes:
    """Little-endian integers at any byte of a buffer that has 8 spare bytes at its end."""

    def __init__(self, packed: np.ndarray):
        self.one = packed
        self.four = np.ndarray((len(packed) - 3,), dtype="<u4", buffer=packed, strides=(1,))
        self.eight = np.ndarray((len(packed) - 7,), dtype="<u8", buffer=packed, strides=(1,))


def xxh64(lanes: _Lanes, at: np.ndarray, length: int) -> np.ndarray:
    """xxhash64 (seed 0) of the ``length`` bytes from each place."""
    done = 0
    if length >= 32:
        with np.errstate(over="ignore"):
            sums = [np.full(len(at), s, dtype=np.uint64) for s in (_P1 + _P2, _P2, np.uint64(0), np.uint64(0) - _P1)]
        while done + 32 <= length:
            sums = [_round(s, lanes.eight[at + done + 8 * i]) for i, s in enumerate(sums)]
            done += 32
        acc = sum((_rotated(s, r) for s, r in zip(sums, (1, 7, 12, 18))), np.zeros(len(at), dtype=np.uint64))
        for s in sums:
            acc = (acc ^ _round(np.uint64(0), s)) * _P1 + _P4
    else:
        acc = np.full(len(at), _P5, dtype=np.uint64)
    acc += np.uint64(length)
    while done + 8 <= length:
        acc = _rotated(acc ^ _round(np.uint64(0), lanes.eight[at + done]), 27) * _P1 + _P4
        done += 8
    if done + 4 <= length:
        acc = _rotated(acc ^ lanes.four[at + done].astype(np.uint64) * _P1, 23) * _P2 + _P3
        done += 4
    for i in range(done, length):
        acc = _rotated(acc ^ lanes.one[at + i].astype(np.uint64) * _P5, 11) * _P1
    acc = (acc ^ (acc >> np.uint64(33))) * _P2
    acc = (acc ^ (acc >> np.uint64(29))) * _P3
    return acc ^ (acc >> np.uint64(32))


class GramTable:
    """Distinct grams of one batch: a slot for each, with its bucket and its count."""

    def __init__(self, words: Words, orders: tuple[int, ...], buckets: int):
        self.words, self._lanes = words, _Lanes(words.packed)
        parts = [words.grams(n) for n in orders]
        start, length, self.text = (np.concatenate(p) for p in zip(*parts))
        self.size = 1 << max(4, (2 * len(start)).bit_length())
        self._key = np.zeros(self.size, dtype=np.uint64)
        self._start = np.full(self.size, -1, dtype=np.int64)
        self._length = np.zeros(self.size, dtype=np.int64)
        self._claim = np.zeros(self.size, dtype=np.int64)
        self.bucket = np.zeros(self.size, dtype=np.int64)
        #: Slot of every occurrence, orders one after another, texts in order within each.
        self.slot = np.zeros(len(start), dtype=np.int64)
        by_length = np.argsort(length, kind="stable")
        edges = np.flatnonzero(np.diff(length[by_length], prepend=-1, append=-1))
        for low, high in zip(edges, edges[1:]):
            rows = by_length[low:high]
            self.slot[rows] = self._interned(start[rows], int(length[rows[0]]), buckets)
        self.count = np.bincount(self.slot, minlength=self.size)

    def _bytes(self, at: int, length: int) -> bytes:
        return self.words.packed[at : at + length].tobytes()

    def _keys(self, at: np.ndarray, length: int) -> np.ndarray:
        if length <= LONG:
            return xxh64(self._lanes, at, length)
        return np.array([xxhash.xxh64_intdigest(self._bytes(a, length)) for a in at.tolist()], dtype=np.uint64)

    def _equal(self, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
        """Whether the bytes from places ``a`` are those from places ``b``."""
        if length > LONG:
            pairs = zip(a.tolist(), b.tolist())
            return np.array([x == y or self._bytes(x, length) == self._bytes(y, length) for x, y in pairs], dtype=bool)
        eight = self._lanes.eight
        if length < 8:
            return (eight[a] ^ eight[b]) << np.uint64(64 - 8 * length) == 0
        same = eight[a + length - 8] == eight[b + length - 8]
        for i in range(0, length - 8, 8):
            same &= eight[a + i] == eight[b + i]
        return same

    def _crc(self, at: np.ndarray, length: int) -> np.ndarray:
        if length > LONG:
            return np.array([crc32(self._bytes(a, length)) for a in at.tolist()], dtype=np.int64)
        crc = np.full(len(at), 0xFFFFFFFF, dtype=np.uint32)
        for i in range(length):
            crc = _CRC[(crc ^ self._lanes.one[at + i]) & np.uint32(255)] ^ (crc >> np.uint32(8))
        return (crc ^ np.uint32(0xFFFFFFFF)).astype(np.int64)

    def _interned(self, at: np.ndarray, length: int, buckets: int) -> np.ndarray:
        """Slots of the grams of ``length`` bytes from each place; new grams get theirs."""
        keys, found = self._keys(at, length), np.empty(len(at), dtype=np.int64)
        place = (keys & np.uint64(self.size - 1)).astype(np.int64)
        open_rows = np.arange(len(at))
        while len(open_rows):
            slots = place[open_rows]
            free = np.flatnonzero(self._start[slots] < 0)
            if len(free):
                self._claim[slots[free]] = free
                winners = free[self._claim[slots[free]] == free]
                rows, taken = open_rows[winners], slots[winners]
                self._key[taken], self._start[taken], self._length[taken] = keys[rows], at[rows], length
                self.bucket[taken] = self._crc(at[rows], length) % buckets
            same = (self._key[slots] == keys[open_rows]) & (self._length[slots] == length)
            rows = np.flatnonzero(same)
            same[rows] = self._equal(at[open_rows[rows]], self._start[slots[rows]], length)
            found[open_rows[same]] = slots[same]
            open_rows = open_rows[~same]
            place[open_rows] = (place[open_rows] + 1) & (self.size - 1)
        return found

    def bucket_counts(self, buckets: int) -> np.ndarray:
        """Occurrences in each bucket."""
        used = np.flatnonzero(self.count)
        return np.bincount(self.bucket[used], weights=self.count[used], minlength=buckets).astype(np.int64)

    def gathered(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each text, and the sum of their buckets' gains."""
        per_slot = gains[self.bucket]
        total = np.zeros(self.words.texts, dtype=np.int64)
        np.add.at(total, self.text, per_slot[self.slot])
        return np.bincount(self.text, minlength=self.words.texts), total
