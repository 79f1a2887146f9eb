"""Simple-8b: as many ids as fit into the 60 data bits of a 64-bit word, told by a 4-bit selector.

Selector 0 is an escape: the next word holds one raw 64-bit id. Ids are coded in blocks of ``BLOCK``;
no word crosses a block's end, and the offset of each block's first word is kept, so any block can be
decoded by itself and all blocks of a buffer at once.
"""

from __future__ import annotations

import struct

import numpy as np

U = np.uint64
BLOCK = 256
#: Ids in a word for selectors 1 to 14, and the bits of each.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
MAGIC = b"S8B1"
_HEAD = struct.Struct("<4sQII")


def _bit_length(v: np.ndarray) -> np.ndarray:
    if not len(v) or v.max() < U(1) << U(53):  # exact as floats
        return np.frexp(v.astype(np.float64))[1].astype(np.uint8)
    out = np.zeros(len(v), np.uint8)
    rest = v.copy()
    for step in (32, 16, 8, 4, 2, 1):
        big = rest >= U(1) << U(step)
        out[big] += step
        rest[big] >>= U(step)
    return out + (rest > 0)


def encode(ids: np.ndarray) -> bytes:
    """A self-contained buffer of the ids (any unsigned 64-bit values)."""
    v = ids.astype(U)
    n = len(v)
    width = _bit_length(v)
    left = np.resize(np.arange(BLOCK, 0, -1, dtype=np.int16), n)
    tail = n - n // BLOCK * BLOCK
    left[n - tail :] -= BLOCK - tail
    best = np.where(width > 60, 0, 14).astype(np.uint8)
    most, have = width.copy(), 1
    for sel in range(13, 0, -1):
        for _ in range(int(COUNTS[sel]) - have):
            have += 1
            np.maximum(most[: max(0, n - have + 1)], width[have - 1 :], out=most[: max(0, n - have + 1)])
        fits = most <= int(WIDTHS[sel])
        if not fits.any():  # nor will more ids fit into fewer bits each
            break
        best[fits & (left >= int(COUNTS[sel]))] = sel
    first = np.arange(0, n, BLOCK)
    end, at, live, visited = np.minimum(first + BLOCK, n), first.copy(), np.arange(len(first)), []
    while len(live):
        visited.append(at[live])
        at[live] += COUNTS[best[at[live]]]
        live = live[at[live] < end[live]]
    p = np.sort(np.concatenate(visited)) if visited else np.zeros(0, np.int64)
    sel = best[p]
    size = np.where(sel == 0, 2, 1)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), U)
    for k in np.unique(sel):
        mine, to = p[sel == k], place[sel == k]
        if k == 0:
            words[to + 1] = v[mine]
            continue
        word = np.full(len(mine), k, U)
        for j in range(COUNTS[k]):
            word |= v[mine + j] << U(4 + j * WIDTHS[k])
        words[to] = word
    offsets = place[np.searchsorted(p, first)]
    return _HEAD.pack(MAGIC, n, len(first), len(words)) + offsets.astype("<u4").tobytes() + words.astype("<u8").tobytes()


def _decode_words(words: np.ndarray) -> np.ndarray:
    sel = (words & U(15)).astype(np.int64)
    if (sel == 0).any():  # the word after an escape is data; data may look like an escape, so go in order
        data = np.zeros(len(words), bool)
        escapes, taken = np.flatnonzero(sel == 0), -1
        for i in escapes.tolist():
            if i != taken:
                data[i + 1] = True
                taken = i + 1
        raw = np.flatnonzero(data)
        keep = ~data
        values, words, sel = words[raw], words[keep], sel[keep]
    count = COUNTS[sel]
    place = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), U)
    for k in np.unique(sel):
        mine, to = words[sel == k], place[sel == k]
        if k == 0:
            out[to] = values
            continue
        mask = (U(1) << U(WIDTHS[k])) - U(1)
        for j in range(COUNTS[k]):
            out[to + j] = (mine >> U(4 + j * WIDTHS[k])) & mask
    return out


def _parts(buffer: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    magic, n, blocks, n_words = _HEAD.unpack_from(buffer)
    if magic != MAGIC:
        raise ValueError("not a Simple-8b buffer")
    offsets = np.frombuffer(buffer, "<u4", blocks, _HEAD.size)
    return n, offsets, np.frombuffer(buffer, "<u8", n_words, _HEAD.size + 4 * blocks)


def decode(buffer: bytes) -> np.ndarray:
    n, _, words = _parts(buffer)
    out = _decode_words(words)
    if len(out) != n:
        raise ValueError(f"{len(out)} ids where {n} were written")
    return out


def decode_block(buffer: bytes, k: int) -> np.ndarray:
    """Ids BLOCK*k up to BLOCK*(k+1), reading only that block's words."""
    _, offsets, words = _parts(buffer)
    return _decode_words(words[int(offsets[k]) : int(offsets[k + 1]) if k + 1 < len(offsets) else len(words)])
