"""Vectorised helpers over batches of texts: words, rolling hashes, bit counts.

A word is a maximal run of bytes outside space and 0x09-0x0D of the UTF-8 text, which is the same as
``[^\\x20\\x09-\\x0D]+`` on characters. Work arrays are bounded: a batch is cut into chunks of about
``CHUNK`` bytes (one longer document is a chunk of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 20
U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Odd multipliers of the rolling hashes and of the mixers; any odd 64-bit values would do.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
BYTE = np.random.default_rng(20240607).integers(0, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def _powers(n: int, base: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, or of its inverse."""
    have = _POWERS.get((base, inverse))
    if have is None or len(have) < n:
        step = pow(base, -1, 2**64) if inverse else base
        have = np.full(max(n, CHUNK + 4096), step, U)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if len(have) <= 4 * CHUNK:
            _POWERS[(base, inverse)] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def as_bytes(texts) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [t.encode() if isinstance(t, str) else b"" for t in texts]


def chunks(texts: list[bytes], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of consecutive texts of about ``limit`` bytes."""
    i, size = 0, 0
    for j, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield i, j
            i, size = j, 0
        size += len(t) + 1
    if i < len(texts):
        yield i, len(texts)


def byte_chunks(texts, limit: int = CHUNK) -> Iterator[tuple[int, int, list[bytes]]]:
    """Ranges [i, j) of consecutive texts with their UTF-8, encoded a chunk at a time; null is empty."""
    i, size, held = 0, 0, []
    for j, t in enumerate(texts):
        raw = t.encode() if isinstance(t, str) else b""
        if held and size + len(raw) > limit:
            yield i, j, held
            i, size, held = j, 0, []
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield i, i + len(held), held


class Words:
    """Word boundaries of a chunk of texts, in one byte buffer.

    ``start``/``end``: byte offsets of each word; ``first[k]:first[k+1]``: the words of text k.
    """

    def __init__(self, texts: list[bytes]):
        at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=at[1:])
        self._find(b" ".join([*texts, b""]), at)

    @classmethod
    def of_lines(cls, flat: bytes) -> Words:
        """Every line of a buffer that ends with a line feed counts as a text."""
        out = cls.__new__(cls)
        out._find(flat, np.concatenate([[0], np.flatnonzero(np.frombuffer(flat, np.uint8) == 10) + 1]))
        return out

    def _find(self, flat: bytes, at: np.ndarray) -> None:
        self.buf = np.frombuffer(flat, np.uint8)
        space = np.empty(len(self.buf) + 2, bool)
        space[0] = space[-1] = True
        space[1:-1] = SPACE[self.buf]
        edge = np.flatnonzero(space[1:] != space[:-1])
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.start, at)
        self.n = np.diff(self.first)
        self.text_of = np.repeat(np.arange(len(at) - 1), self.n)

    @staticmethod
    def counts(flat: bytes, cut: list[int]) -> np.ndarray:
        """How many words start in each flat[cut[k]:cut[k + 1]]."""
        space = SPACE[np.frombuffer(flat, np.uint8)]
        start = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
        return np.diff(np.searchsorted(start, cut))

    def hashes(self) -> np.ndarray:
        return span_hash(BYTE[self.buf], self.start, self.end, BASES[0])


def prefix(h: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(h) + 1, U)
    np.cumsum(h * _powers(len(h), base), out=out[1:])
    return out


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of each h[start:end], the same wherever the same values stand."""
    p = prefix(h, base)
    got = p[end] - p[start]
    got *= _powers(len(h) + 1, base, True)[start]
    return mix(got + mix((end - start).astype(U)))


_SPREAD = np.zeros(256, U)
for _b in range(256):
    _SPREAD[_b] = sum(((_b >> i) & 1) << (8 * i) for i in range(8))


def bit_counts(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set among the values of each group.

    ``h`` lists the groups' values one after the other, ``n`` their counts. Eight one-byte counters
    share a 64-bit lane, so groups are cut at 255 values and the cuts summed. Returns (groups, 64).
    """
    out = np.zeros((len(n), 64), np.int64)
    cuts = (n + 254) // 255
    if not cuts.sum():
        return out
    one_each = bool((cuts == 1).all())
    group = np.repeat(np.arange(len(n)), cuts)
    at = np.concatenate([[0], np.cumsum(n)[:-1]])
    nth = np.arange(len(group)) - np.repeat(np.concatenate([[0], np.cumsum(cuts)[:-1]]), cuts)
    start = at[group] + 255 * nth
    parts = h.astype("<u8").view(np.uint8).reshape(-1, 8)
    for byte in range(8):
        lanes = np.add.reduceat(_SPREAD[parts[:, byte]], start)
        sums = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        if one_each:
            out[:, 8 * byte : 8 * byte + 8] = sums
        else:
            np.add.at(out[:, 8 * byte : 8 * byte + 8], group, sums)
    return out


def simhash(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """64-bit fingerprint of each group: a bit is 1 if set in over half the values; none: 0."""
    on = 2 * bit_counts(h, n) > n[:, None]
    return np.packbits(on, axis=1, bitorder="little").view("<u8").ravel().astype(U)
