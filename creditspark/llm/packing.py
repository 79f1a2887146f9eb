"""Operator 8: vector bin packing of token sequences by the dot-product heuristic.

Examples are vectors (tokens, segments, loss-bearing tokens); a sequence has a limit on each. The
open sequence takes, among the pooled examples that fit, the one whose demand has the largest dot
product with what is left of the limits (each dimension as a share of its limit). Where documents may
be cut, one is cut to fill what no whole one fits. Each task packs its own rows with a pool of bounded
size, so nothing is shuffled and no sequence waits for another task; rows of one source or key may lie
anywhere. A task's sequences carry its partition number in the upper bits of ``sequence_id``.

Sequences of exactly the token limit need no padding, nor do those of a power of two: a sequence that
closes early is cut into powers of two, so there is no padding at all. Examples that may not be cut
stay whole, and their sequences are padded.

Defined results: null or empty text: the end id alone. Null doc_id stays null. Repeated rows are
packed each by itself. An example over a limit by itself (uncut) gets a sequence of its own, flagged
``oversize``. No documents: no pieces. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import byte_chunks
from .tokens import coder

CAPACITY, MAX_SEGMENTS, MAX_LOSS = 4096, 256, 4096
POOL = 512
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "loss_tokens long"
)
PACKED = "example_id long, tokens long, loss_tokens long, sequence_id long, offset long, oversize boolean"


class Packer:
    """Fills one sequence after the other from a pool of pending examples.

    ``add`` takes an example (a key, its tokens, its loss-bearing tokens: for documents all but the
    first id); ``pump`` yields sequences, each a list of (key, start, length), while more than
    ``pool`` examples wait (or until none is left, if ``last``).
    """

    def __init__(self, capacity: int, max_segments: int, max_loss: int, cut: bool, pool: int = POOL):
        self.limits = np.array([capacity, max_segments, max_loss], np.int64)
        self.cut, self.pool = cut, pool
        self.keys: list = []
        self.start = np.zeros(2 * pool, np.int64)
        self.need = np.zeros((2 * pool, 3), np.int64)
        self.room, self.open = self.limits.copy(), []

    @property
    def n(self) -> int:
        return len(self.keys)

    def add(self, key, start: int, tokens: int, loss: int) -> None:
        self.start[self.n], self.need[self.n] = start, (tokens, 1, loss)
        self.keys.append(key)

    def _drop(self, i: int) -> None:
        last = self.n - 1
        self.keys[i], self.start[i], self.need[i] = self.keys[last], self.start[last], self.need[last]
        self.keys.pop()

    def _close(self) -> list:
        got, self.open, self.room = self.open, [], self.limits.copy()
        return got

    def pump(self, last: bool = False) -> Iterator[list]:
        while self.n > self.pool or last and self.n:
            need = self.need[: self.n]
            score = (need / self.limits) @ (self.room / self.limits)
            fits = (need <= self.room).all(axis=1)
            i = int(np.argmax(np.where(fits, score, -1.0)))
            if fits[i] and not (self.cut and self.room[1] == 1 and need[i, 0] < self.room[0] and (need[:, 0] > self.room[0]).any()):
                self.open.append((self.keys[i], int(self.start[i]), int(need[i, 0])))
                self.room -= need[i]
                self._drop(i)
            elif self.cut and self.room[:2].min() > 0 and (take := int(min(self.room[0], self.room[2]))) > 0:
                i = int(np.argmax(need[:, 0]))
                take = min(take, int(need[i, 0]) - 1)
                if take <= 0:
                    yield self._close()
                    continue
                self.open.append((self.keys[i], int(self.start[i]), take))
                lost = min(int(need[i, 2]), take - int(self.start[i] == 0))
                self.room -= (take, 1, lost)
                self.start[i] += take
                self.need[i, 0] -= take
                self.need[i, 2] = min(self.need[i, 2] - lost, self.need[i, 0])
            elif not self.open:  # over a limit by itself
                yield [(self.keys[i := int(np.argmax(~fits))], int(self.start[i]), int(need[i, 0]))]
                self._drop(i)
            else:
                yield self._close()
            if self.room[:2].min() <= 0:
                yield self._close()
        if last and self.open:
            yield self._close()


def powers_of_two(sequence: list, capacity: int) -> Iterator[list]:
    """A sequence shorter than ``capacity`` as sequences whose lengths are powers of two."""
    left = sum(x[2] for x in sequence)
    if left == capacity:
        yield sequence
        return
    queue, part, room = [*sequence[::-1]], [], 1 << (left.bit_length() - 1) if left else 0
    while queue:
        key, start, length = queue.pop()
        take = min(length, room)
        part.append((key, start, take))
        room, left = room - take, left - take
        if take < length:
            queue.append((key, start + take, length - take))
        if room == 0:
            yield part
            part, room = [], 1 << (left.bit_length() - 1) if left else 0


def _pieces(frames: Iterator[pd.DataFrame], vocabulary: str, end_id: int, limits: tuple[int, int, int]) -> Iterator[pd.DataFrame]:
    code, end = coder(vocabulary), np.uint32(end_id).tobytes()
    capacity, number = limits[0], TaskContext.get().partitionId() << 32
    packer, rows = Packer(*limits, cut=True), []

    def emit(sequence: list) -> None:
        nonlocal number
        for part in powers_of_two(sequence, capacity):
            offset = 0
            for (doc, ids), start, length in part:
                crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
                rows.append((doc, start, length, crc, len(ids) // 4, number, offset, length - (start == 0)))
                offset += length
            number += 1

    def frame_of() -> pd.DataFrame:
        got = pd.DataFrame(rows, columns=[x.split()[0] for x in PIECES.split(", ")])
        got["doc_id"] = got["doc_id"].astype("Int64")
        rows.clear()
        return got

    for frame in frames:
        for i, j, raw in byte_chunks(frame["text"]):
            for doc, ids in zip(frame["doc_id"].iloc[i:j], code.encode_all(raw), strict=True):
                key, at, n = (None if pd.isna(doc) else int(doc), ids + end), 0, len(ids) // 4 + 1
                while n - at >= capacity:
                    emit([(key, at, capacity)])
                    at += capacity
                if at < n:
                    packer.add(key, at, n - at, n - at - (at == 0))
                for sequence in packer.pump():
                    emit(sequence)
            if len(rows) >= 20_000:
                yield frame_of()
    for sequence in packer.pump(last=True):
        emit(sequence)
    if rows:
        yield frame_of()


def pack_documents(
    docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = CAPACITY,
    max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_LOSS,
) -> DataFrame:
    """Pieces of ``docs(doc_id, text)`` in sequences of at most ``capacity`` ids, cut where needed."""
    limits = (capacity, max_segments, max_loss)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInPandas(lambda frames: _pieces(frames, vocabulary, end_id, limits), PIECES)


def _whole(frames: Iterator[pd.DataFrame], limits: tuple[int, int, int]) -> Iterator[pd.DataFrame]:
    number, packer = TaskContext.get().partitionId() << 32, Packer(*limits, cut=False)

    def placed(sequence: list) -> pd.DataFrame:
        nonlocal number
        size = [x[2] for x in sequence]
        got = pd.DataFrame({
            "example_id": pd.array([x[0][0] for x in sequence], dtype="Int64"), "tokens": size,
            "loss_tokens": [x[0][1] for x in sequence], "sequence_id": number,
            "offset": np.cumsum(size) - size,
            "oversize": [x[2] > limits[0] or x[0][1] > limits[2] for x in sequence],
        })
        number += 1
        return got

    for frame in frames:
        for key, tokens, loss in frame.itertuples(index=False):
            packer.add((None if pd.isna(key) else int(key), int(loss)), 0, int(tokens), int(loss))
            yield from map(placed, packer.pump())
    yield from map(placed, packer.pump(last=True))


def pack_examples(
    examples: DataFrame, capacity: int = CAPACITY, max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_LOSS,
) -> DataFrame:
    """Instruction examples ``(example_id, tokens, loss_tokens)`` placed whole; null counts are zero."""
    rows = examples.select(
        F.col("example_id").cast("long"),
        *(F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in ("tokens", "loss_tokens")),
    )
    limits = (capacity, max_segments, max_loss)
    return rows.mapInPandas(lambda frames: _whole(frames, limits), PACKED)
