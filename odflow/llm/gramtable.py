"""An open-addressed NumPy table that interns byte strings, and the hashes it
needs: XXH64 for its keys and CRC-32 put together from parts.

The strings of one block of words are stretches of a byte array.  They are
hashed and looked up all together: every round, the strings without a slot yet
look at their next slot, claim it if it is free, and take it if its owner has
the same key, the same length and, compared eight bytes at a time, the same
bytes.  Equal keys alone never join two strings.
"""

from __future__ import annotations

import zlib

import numpy as np
import xxhash

_U = np.uint64
# The five primes of XXH64.
P1, P2, P3, P4, P5 = map(_U, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
#: Longer strings are hashed one by one by the xxhash library, with the same result.
VECTOR_BYTES = 256
PADDING = 8


#: The CRC-32 register after one byte of each value.
_CRC_STEP = np.array([zlib.crc32(bytes([b ^ 255])) ^ 0xFF000000 for b in range(256)], np.uint32)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << _U(by)) | (x >> _U(64 - by))


def _lane(state, value: np.ndarray) -> np.ndarray:
    return _turn(state + value * P2, 31) * P1


class Bytes:
    """A byte array, padded by eight zeros, read at any offset as numbers of
    one, four or eight bytes."""

    def __init__(self, data: np.ndarray) -> None:
        self.one = np.concatenate([data, np.zeros(PADDING, np.uint8)])
        n = len(data) + 1
        self.four = np.ndarray((n,), "<u4", self.one, strides=(1,))
        self.eight = np.ndarray((n,), "<u8", self.one, strides=(1,))

    def xxh64(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """XXH64 (seed 0) of the stretches."""
        with np.errstate(over="ignore"):
            return self._by_length(starts, lengths, _U, self._xxh64, xxhash.xxh64_intdigest)

    def crc32(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """CRC-32 of the stretches."""
        return self._by_length(starts, lengths, np.uint32, self._crc32, zlib.crc32)

    def _by_length(self, starts, lengths, kind, many, one) -> np.ndarray:
        """``many`` over all stretches of a length at a time, ``one`` for the few of over VECTOR_BYTES."""
        out = np.empty(len(starts), kind)
        if not len(starts):
            return out
        order = np.argsort(np.minimum(lengths, VECTOR_BYTES + 1).astype(np.uint16), kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
            size = int(lengths[group[0]])
            if size > VECTOR_BYTES:
                out[group] = [one(self.one[s:s + size]) for s in starts[group].tolist()]
            else:
                out[group] = many(starts[group], size)
        return out

    def _crc32(self, at: np.ndarray, size: int) -> np.ndarray:
        crc = np.full(len(at), 0xFFFFFFFF, np.uint32)
        for p in range(size):
            crc = _CRC_STEP[(crc ^ self.one[at + p]) & np.uint32(255)] ^ (crc >> np.uint32(8))
        return ~crc

    def _xxh64(self, at: np.ndarray, size: int) -> np.ndarray:
        if size >= 32:
            lanes = [np.full(len(at), s, _U) for s in (P1 + P2, P2, _U(0), _U(0) - P1)]
            for p in range(0, size - 31, 32):
                lanes = [_lane(v, self.eight[at + (p + 8 * i)]) for i, v in enumerate(lanes)]
            h = sum((_turn(v, by) for v, by in zip(lanes[1:], (7, 12, 18))), _turn(lanes[0], 1))
            for v in lanes:
                h = (h ^ _lane(_U(0), v)) * P1 + P4
        else:
            h = np.full(len(at), P5, _U)
        h = h + _U(size)
        p = size // 32 * 32
        while p + 8 <= size:
            h = _turn(h ^ _lane(_U(0), self.eight[at + p]), 27) * P1 + P4
            p += 8
        if p + 4 <= size:
            h = _turn(h ^ (self.four[at + p].astype(_U) * P1), 23) * P2 + P3
            p += 4
        for q in range(p, size):
            h = _turn(h ^ (self.one[at + q].astype(_U) * P5), 11) * P1
        h = (h ^ (h >> _U(33))) * P2
        h = (h ^ (h >> _U(29))) * P3
        return h ^ (h >> _U(32))

    def equal(self, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether the stretches at ``a`` and ``b`` hold the same bytes."""
        same = np.ones(len(a), bool)
        left, p = np.arange(len(a)), 0
        while len(left):
            rest = sizes[left] - p
            shift = (8 * np.clip(8 - rest, 0, 7)).astype(_U)
            x = self.eight[a[left] + p] ^ self.eight[b[left] + p]
            # a number's low bytes come first: those past the end are shifted out
            good = ((x << shift) == 0) | (rest <= 0)
            same[left[~good]] = False
            left = left[good & (rest > 8)]
            p += 8
        return same


class GramTable:
    """The strings of one block: ``slots`` of the occurrences, and for every
    slot in use ``owner`` (its first occurrence), ``count`` and ``bucket``."""

    def __init__(self, data: Bytes, starts: np.ndarray, lengths: np.ndarray) -> None:
        n = len(starts)
        size = 1 << max(4, int(2 * n).bit_length())
        keys = data.xxh64(starts, lengths)
        owner = np.full(size, -1, np.int64)
        slots = np.empty(n, np.int64)
        at, todo = (keys & _U(size - 1)).astype(np.int64), np.arange(n)
        while len(todo):
            here = at[todo]
            free = owner[here] < 0
            owner[here[free][::-1]] = todo[free][::-1]      # of several claims the first one stays
            own = owner[here]
            same = own == todo
            other = np.flatnonzero(~same)
            o, t = own[other], todo[other]
            alike = np.flatnonzero((keys[o] == keys[t]) & (lengths[o] == lengths[t]))
            alike = alike[data.equal(starts[o[alike]], starts[t[alike]], lengths[t[alike]])]
            same[other[alike]] = True
            slots[todo[same]] = here[same]
            todo = todo[~same]
            at[todo] = (at[todo] + 1) & (size - 1)
        self.used = np.flatnonzero(owner >= 0)
        self.owner = owner[self.used]
        self.slots = slots
        self.size = size
        self.count = np.bincount(slots, minlength=size)
        self.bucket = np.zeros(size, np.int64)


def _zero_bytes(longest: int) -> np.ndarray:
    """CRC-32 registers after 0, 1, ... zero bytes: [number, byte of the register, its value]."""
    step = _CRC_STEP
    first = np.arange(256, dtype=np.uint32)
    tables = [np.stack([first << np.uint32(8 * k) for k in range(4)])]
    for _ in range(longest):
        last = tables[-1]
        tables.append(step[last & np.uint32(255)] ^ (last >> np.uint32(8)))
    return np.stack(tables)


class Crc:
    """CRC-32 of joined strings from the CRC-32 of their parts."""

    LONGEST = 255

    def __init__(self) -> None:
        self.table = _zero_bytes(self.LONGEST).ravel()
        self.space = np.uint32(zlib.crc32(b" "))

    def joined(self, left: np.ndarray, right: np.ndarray, right_bytes: np.ndarray) -> np.ndarray:
        """CRC-32 of ``left`` followed by ``right`` of at most LONGEST bytes."""
        base = right_bytes * 1024
        out = right.copy()
        for k in range(4):
            out ^= self.table[base + 256 * k + ((left >> np.uint32(8 * k)) & np.uint32(255))]
        return out
