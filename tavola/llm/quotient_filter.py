"""Counting quotient filters of packed n-grams: sorted, compact, without loss.

An n-gram of word ids is packed into one number of ``order * word_bits`` bits. A Feistel network
permutes these numbers: invertible, so a stored number gives back its n-gram, and even, so equal
parts of the range hold about equally many n-grams. Of a permuted number the top ``shard_bits``
name the shard it is counted in, the next bits are its quotient inside the shard, and all the rest
is its remainder, kept in full. A block (the part of a filter that lies in one shard) stores its
entries in ascending order:

- the quotients in unary: for every quotient as many zeros as it has entries, then a one;
- the remainders, byte-aligned;
- the counters, one byte each, those of 255 and more as 64-bit integers behind.

Two blocks of one shard are merged as sorted lists, whatever filters they come from.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<IBB")
_SALTS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xAEF17502108EF2D9))
_FACTOR = np.uint64(0xFF51AFD7ED558CCD)


def _mixed(x: np.ndarray, salt: np.uint64, bits: int) -> np.ndarray:
    """``bits`` bits that depend on all bits of ``x``."""
    x = (x + salt) * _FACTOR
    x ^= x >> np.uint64(32)
    x *= salt
    return x >> np.uint64(64 - bits)


class Keys:
    """Numbers of up to 128 bits as high and low 64-bit halves; ``high`` is None below 65 bits."""

    def __init__(self, high: np.ndarray | None, low: np.ndarray):
        self.high, self.low = high, low

    def __len__(self) -> int:
        return len(self.low)

    def __getitem__(self, at) -> Keys:
        return Keys(None if self.high is None else self.high[at], self.low[at])

    @staticmethod
    def joined(parts: list[Keys]) -> Keys:
        high = None if parts[0].high is None else np.concatenate([p.high for p in parts])
        return Keys(high, np.concatenate([p.low for p in parts]))

    def order(self) -> np.ndarray:
        """The stable sort; runs that are sorted already are merged."""
        return np.argsort(self.low, kind="stable") if self.high is None else np.lexsort((self.low, self.high))

    def sorted(self) -> Keys:
        return Keys(None, np.sort(self.low)) if self.high is None else self[self.order()]

    def firsts(self) -> np.ndarray:
        """Where sorted keys differ from the one before."""
        new = np.ones(len(self), bool)
        new[1:] = self.low[1:] != self.low[:-1]
        if self.high is not None:
            new[1:] |= self.high[1:] != self.high[:-1]
        return new

    def top(self, drop: int) -> np.ndarray:
        """The keys without their ``drop`` lowest bits."""
        if drop >= 64:
            return np.zeros(len(self), np.uint64) if self.high is None else self.high >> np.uint64(drop - 64)
        low = self.low >> np.uint64(drop)
        return low if self.high is None or drop == 0 else self.high << np.uint64(64 - drop) | low

    def found_in(self, some: Keys) -> np.ndarray:
        """Whether each key is one of ``some``, which are sorted and distinct."""
        if not len(some):
            return np.zeros(len(self), bool)
        if self.high is None:
            at = np.minimum(np.searchsorted(some.low, self.low), len(some) - 1)
            return some.low[at] == self.low
        both = Keys.joined([some, self])
        order = both.order()  # stable: one of ``some`` stands first among its equals
        group = np.cumsum(both[order].firsts()) - 1
        has = np.zeros(group[-1] + 1, bool)
        has[group[order < len(some)]] = True
        out = np.empty(len(both), bool)
        out[order] = has[group]
        return out[len(some) :]


class Packing:
    """n-grams of ``order`` words, ids below 2**word_bits (at most 32), as permuted keys."""

    def __init__(self, order: int, word_bits: int):
        self.order, self.word_bits = order, word_bits
        self.left_words = order - order // 2
        self.left_bits, self.right_bits = self.left_words * word_bits, order // 2 * word_bits
        self.bits = order * word_bits

    def keys(self, grams: np.ndarray) -> Keys:
        """Permuted keys of n-grams, one a row."""
        halves = []
        for columns in (range(self.left_words), range(self.left_words, self.order)):
            half = np.zeros(len(grams), np.uint64)
            for c in columns:
                half = half << np.uint64(self.word_bits) | grams[:, c].astype(np.uint64)
            halves.append(half)
        left, right = halves
        for k, salt in enumerate(_SALTS):
            if k % 2:
                right ^= _mixed(left, salt, self.right_bits)
            else:
                left ^= _mixed(right, salt, self.left_bits)
        if self.bits <= 64:
            return Keys(None, left << np.uint64(self.right_bits) | right)
        if self.right_bits == 64:
            return Keys(left, right)
        return Keys(left >> np.uint64(64 - self.right_bits), left << np.uint64(self.right_bits) | right)

    def grams(self, keys: Keys) -> np.ndarray:
        """The n-grams that ``keys`` came from."""
        low_bits = np.uint64((1 << self.right_bits) - 1)
        right = keys.low & low_bits
        left = keys.top(self.right_bits)
        for k in range(len(_SALTS) - 1, -1, -1):
            if k % 2:
                right ^= _mixed(left, _SALTS[k], self.right_bits)
            else:
                left ^= _mixed(right, _SALTS[k], self.left_bits)
        word = np.uint64((1 << self.word_bits) - 1)
        out = np.empty((len(keys), self.order), np.int64)
        for half, columns in ((left, range(self.left_words)), (right, range(self.left_words, self.order))):
            for c in reversed(columns):
                out[:, c] = half & word
                half = half >> np.uint64(self.word_bits)
        return out


def counted(keys: Keys) -> tuple[Keys, np.ndarray]:
    """Distinct keys in ascending order and how often each occurs."""
    ordered = keys.sorted()
    first = np.flatnonzero(ordered.firsts())
    return ordered[first], np.diff(np.append(first, len(ordered)))


def blocks(packing: Packing, keys: Keys, counts: np.ndarray, shard_bits: int) -> list[tuple[int, bytes]]:
    """(shard, block) for every shard that holds some of the sorted, distinct ``keys``."""
    shards = keys.top(packing.bits - shard_bits).astype(np.int64)
    cuts = np.flatnonzero(np.diff(shards, prepend=-1))
    ends = np.append(cuts[1:], len(keys))
    return [(int(shards[s]), _block(packing, keys[s:e], counts[s:e], shard_bits)) for s, e in zip(cuts, ends, strict=True)]


def _block(packing: Packing, keys: Keys, counts: np.ndarray, shard_bits: int) -> bytes:
    n, free = len(keys), packing.bits - shard_bits
    # at most about one quotient an entry, and a whole number of remainder bytes
    width = min(free // 8, max(0, -(-(free - n.bit_length()) // 8)))
    quotient_bits = free - 8 * width
    quotients = keys.top(8 * width) & np.uint64((1 << quotient_bits) - 1)
    ends = np.cumsum(np.bincount(quotients.astype(np.int64), minlength=1 << quotient_bits))
    unary = np.zeros(n + (1 << quotient_bits), np.uint8)
    unary[ends + np.arange(1 << quotient_bits)] = 1
    parts = [] if keys.high is None else [keys.high.astype(">u8").view(np.uint8).reshape(n, 8)]
    whole = np.hstack([*parts, keys.low.astype(">u8").view(np.uint8).reshape(n, 8)])
    remainders = whole[:, whole.shape[1] - width :]
    large = counts[counts >= 255].astype("<u8")
    small = np.minimum(counts, 255).astype(np.uint8)
    return b"".join((_HEAD.pack(n, width, quotient_bits), np.packbits(unary).tobytes(), remainders.tobytes(), small.tobytes(), large.tobytes()))


def read_block(packing: Packing, shard: int, block: bytes) -> tuple[Keys, np.ndarray]:
    """The keys and counters that a block holds."""
    n, width, quotient_bits = _HEAD.unpack_from(block)
    at, bits = _HEAD.size, n + (1 << quotient_bits)
    size = -(-bits // 8)
    unary = np.unpackbits(np.frombuffer(block, np.uint8, size, at), count=bits)
    # an entry's quotient is the number of ones before its zero
    zeros = np.flatnonzero(unary == 0)
    top = (zeros - np.arange(n)).astype(np.uint64) | np.uint64(shard << quotient_bits)
    at += size
    wide = packing.bits > 64
    whole = np.zeros((n, 16 if wide else 8), np.uint8)
    if width:
        whole[:, whole.shape[1] - width :] = np.frombuffer(block, np.uint8, n * width, at).reshape(n, width)
    at += n * width
    counts = np.frombuffer(block, np.uint8, n, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(block, "<u8", -1, at + n).astype(np.int64)
    numbers = whole.reshape(-1).view(">u8").astype(np.uint64).reshape(n, -1)
    low, drop = numbers[:, -1], 8 * width
    low = low | top << np.uint64(drop) if drop < 64 else low.copy()
    if not wide:
        return Keys(None, low), counts
    high = numbers[:, 0]
    high = high | top << np.uint64(drop - 64) if drop >= 64 else (top >> np.uint64(64 - drop) if drop else np.zeros_like(low))
    return Keys(high, low), counts


def merged(parts: list[tuple[Keys, np.ndarray]]) -> tuple[Keys, np.ndarray, list[np.ndarray]]:
    """Distinct keys of sorted lists and their summed counters; and for each list, the places of
    its keys among them."""
    keys = Keys.joined([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = keys.order()
    ordered = keys[order]
    new = ordered.firsts()
    first = np.flatnonzero(new)
    totals = np.add.reduceat(counts[order], first) if len(first) else counts
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[first], totals, np.split(place, np.cumsum([len(k) for k, _ in parts])[:-1])
