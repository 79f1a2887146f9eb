"""Operator 12: best-fit packing by a configuration linear program over the histogram of lengths.

Pieces of at most ``CAPACITY`` ids are put whole into sequences of that capacity. What there is to pack
is a histogram of at most ``CAPACITY`` lengths, however many pieces there are. A configuration says how
many pieces of each length share a sequence. The program: as few sequences as possible whose
configurations together hold the histogram. Its dual gives each length a price such that no configuration
is worth more than one sequence.

Multiplicative weights: prices start as lengths. Each round prices the best configuration by a bounded
knapsack (dynamic programming over the capacity) and multiplies every price by ``exp(RATE * (1 - gain))``;
the gain of a length is the share of its pieces that this configuration would cover if all sequences were like
it, so lengths that lag become dear. The configurations of all rounds but the first, in equal parts, are
the solution. Any prices give a lower bound of the program: the value of all pieces over the value of the best
configuration; the best one found is ``Plan.bound``.
Rounding: whole copies are dealt out to the configurations, as far as there are pieces for all of a copy, and what
is left goes by best fit, longest first, into the open sequences and new ones. Each of ``SHARES`` of the solution is
rounded so, as what best fit is left with may suit it better; the plan with the fewest sequences counts.

Only the histogram reaches the driver (at most CAPACITY rows) and only the plan leaves it: groups of
equal sequences, whose number is bounded by the rounds, not by the data. Pieces are numbered by length within
their task; the counts before each task place the number in the whole, and the number finds its sequence in
the plan. Every step is a written table, so a lost executor repeats tasks of one step.

Defined results: null or empty text: the end id alone. Null doc_id stays null. Repeated rows are packed
each by itself. A document over the capacity: its first piece takes the remainder, the others are full
sequences. No documents: no pieces. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_tokens import byte_coder
from .shared import written

CAPACITY = 1024
ROUNDS, RATE = 240, 0.1
#: Parts of the solution that are rounded down; the rest is left to best fit.
SHARES = (1.0, 0.5, 0.25, 0.125)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def best_configuration(price: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, float]:
    """Counts by length of the dearest set of at most ``most`` pieces of each length that fits, and its value.

    A bounded knapsack: up to ``most`` pieces of a length are items of 1, 2, 4, ... pieces.
    """
    capacity = len(price) - 1
    items = []
    for length in np.flatnonzero(most)[::-1].tolist():
        left, size = min(int(most[length]), capacity // length), 1
        while left:
            size = min(size, left)
            items.append((length, size))
            left, size = left - size, 2 * size
    value = np.zeros(capacity + 1)
    taken = np.zeros((len(items), capacity + 1), bool)
    for i, (length, size) in enumerate(items):
        room = length * size
        other = value[: capacity + 1 - room] + size * price[length]
        better = other > value[room:]
        taken[i, room:] = better
        value[room:] = np.where(better, other, value[room:])
    counts, at = np.zeros(capacity + 1, np.int64), capacity
    for i in range(len(items) - 1, -1, -1):
        if taken[i, at]:
            length, size = items[i]
            counts[length] += size
            at -= length * size
    return counts, float(value[capacity])


class Plan:
    """Groups of equal sequences: ``copies`` of them, each with ``counts`` pieces by length."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.groups: list[tuple[int, np.ndarray]] = []
        self.bound = 0.0

    def sequences(self) -> int:
        return sum(n for n, _ in self.groups)

    def places(self) -> dict[int, np.ndarray]:
        """By length: rows (first number, pieces a sequence, first sequence, first offset), numbers ascending."""
        found: dict[int, list] = {}
        begun = np.zeros(self.capacity + 1, np.int64)
        base = 0
        for copies, counts in self.groups:
            offset = 0
            for length in np.flatnonzero(counts)[::-1].tolist():
                k = int(counts[length])
                found.setdefault(length, []).append((int(begun[length]), k, base, offset))
                begun[length] += k * copies
                offset += k * length
            base += copies
        return {length: np.array(rows, np.int64) for length, rows in found.items()}


def weighted_configurations(total: np.ndarray, rounds: int, rate: float) -> tuple[list[np.ndarray], float]:
    """The configuration of each round, and the best lower bound that any round's prices gave."""
    capacity = len(total) - 1
    lengths, have = np.arange(capacity + 1), total > 0
    most = np.where(have, np.minimum(total, capacity // np.maximum(lengths, 1)), 0)
    price, bound, found = lengths / capacity, float(total @ lengths) / capacity, []
    for _ in range(rounds):
        counts, value = best_configuration(price, most)
        bound = max(bound, float(total @ price) / value)
        found.append(counts)
        # the share of each length that this configuration alone would cover, had it all sequences
        gain = np.minimum(bound * counts[have] / total[have], 1 / rate)
        price[have] *= np.exp(rate * (1 - gain))
        price *= bound / float(total @ price)
    return found, bound


def _rounded(plan: Plan, left: np.ndarray, found: list[np.ndarray], sequences: float) -> None:
    """Whole copies of the configurations, ``sequences`` dealt out evenly among them, as long as there are pieces."""
    dealt = 0
    for k, counts in enumerate(found, 1):
        share, used = int(sequences * k / len(found)) - dealt, counts > 0
        dealt += share
        copies = min(share, int((left[used] // counts[used]).min()))
        if copies:
            plan.groups.append((copies, counts))
            left -= copies * counts


def _best_fit(plan: Plan, left: np.ndarray) -> None:
    """What is left, longest first, each piece into the fullest sequence that has room for it."""
    lengths = np.arange(len(left))
    open_: dict[int, list] = {}
    for copies, counts in plan.groups:
        open_.setdefault(plan.capacity - int(counts @ lengths), []).append((copies, counts))
    for length in np.flatnonzero(left)[::-1].tolist():
        while left[length]:
            room = min((r for r, groups in open_.items() if r >= length and groups), default=None)
            if room is None:
                room, group = plan.capacity, (int(left[length]), np.zeros_like(left))
            else:
                group = open_[room].pop()
            copies, counts = group
            each = min(room // length, -(-int(left[length]) // copies))  # pieces into each of them
            filled = min(copies, int(left[length]) // each)
            if filled < copies and room < plan.capacity:
                open_[room].append((copies - filled, counts))
            more = counts.copy()
            more[length] += each
            open_.setdefault(room - each * length, []).append((filled, more))
            left[length] -= filled * each
    plan.groups = [g for groups in open_.values() for g in groups]


def solve(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS, rate: float = RATE) -> Plan:
    """A plan for ``histogram`` (number of pieces by length, lengths up to the capacity)."""
    total, best = np.zeros(capacity + 1, np.int64), None
    for length, n in histogram.items():
        total[length] = n
    full, total[capacity] = int(total[capacity]), 0  # a piece of the whole capacity has one configuration only
    found, bound = weighted_configurations(total, rounds, rate) if total.any() else ([], 0.0)
    found = found[len(found) // 4 :]  # the first prices are still far off
    for share in SHARES if found else (1.0,):
        plan, left = Plan(capacity), total.copy()
        if found:
            _rounded(plan, left, found, share * bound)
        _best_fit(plan, left)
        if best is None or plan.sequences() < best.sequences():
            best = plan
    if full:
        best.groups.append((full, (np.arange(capacity + 1) == capacity).astype(np.int64)))
    best.bound = bound + full
    return best


def _pieces(frames: Iterator[pd.DataFrame], vocabulary: str, end_id: int, capacity: int) -> Iterator[pd.DataFrame]:
    code, end, part = byte_coder(vocabulary), np.uint32(end_id).tobytes(), TaskContext.get().partitionId()
    met = np.zeros(capacity + 1, np.int64)
    for frame in frames:
        rows = []
        for doc, text in zip(frame["doc_id"], frame["text"], strict=True):
            ids = (code.encode(text) if isinstance(text, str) else b"") + end
            n, key, start, k = len(ids) // 4, None if pd.isna(doc) else int(doc), 0, 0
            while start < n:
                size = (n - start) % capacity or capacity if start == 0 else capacity
                crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + size)])
                rows.append((key, k, start, size, crc, part, int(met[size])))
                met[size] += 1
                start, k = start + size, k + 1
        got = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])
        got["doc_id"] = got["doc_id"].astype("Int64")
        yield got


def _placed(frames: Iterator[pd.DataFrame], places: dict[int, np.ndarray]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        number, sequence = frame["number"].to_numpy(), np.zeros(len(frame), np.int64)
        offset = np.zeros(len(frame), np.int64)
        for length, at in frame.groupby("length").indices.items():
            rows = places[int(length)]
            row = rows[np.searchsorted(rows[:, 0], number[at], "right") - 1]
            nth = number[at] - row[:, 0]
            sequence[at] = row[:, 2] + nth // row[:, 1]
            offset[at] = row[:, 3] + nth % row[:, 1] * int(length)
        yield frame.drop(columns="number").assign(sequence_id=sequence, offset=offset)


def pack_whole(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of ``docs(doc_id, text)`` in sequences of at most ``capacity`` ids; only longer documents are cut."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    cut = written(rows.mapInPandas(lambda frames: _pieces(frames, vocabulary, end_id, capacity), PIECES), "pieces")
    counts = written(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    total = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    places = solve({r.length: r.n for r in total}, capacity).places()
    earlier = Window.partitionBy("length").orderBy("part")
    counts = counts.select("part", "length", (F.sum("n").over(earlier) - F.col("n")).alias("before"))
    numbered = cut.join(written(counts, "counts-before"), ["part", "length"]).select(
        *(c.split()[0] for c in PACKED.split(", ")[:5]), (F.col("before") + F.col("nth")).alias("number")
    )
    return numbered.mapInPandas(lambda frames: _placed(frames, places), PACKED)
