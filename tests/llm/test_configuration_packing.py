import itertools
import random
import zlib
from array import array

import numpy as np
import pytest
from conftest import CLASHES, frame

from creditspark.llm import configuration_packing as packing
from creditspark.llm.byte_tokens import byte_coder, byte_vocabulary_path
from creditspark.llm.queries import op12_configuration_packing


@pytest.fixture(scope="module")
def coder():
    return byte_coder(byte_vocabulary_path(None))


def ids_of(coder, text):
    return coder.tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def check(coder, docs, rows, capacity=1024):
    """The contract, piece by piece; returns the number of sequences."""
    left = sorted(docs, key=str)
    by_doc, bins = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append(r)
    want = {}
    for doc, text in left:
        ids, at, pieces = ids_of(coder, text), 0, []
        while at < len(ids):
            size = capacity if at or len(ids) % capacity == 0 else len(ids) % capacity
            pieces.append((len(pieces), at, size, zlib.crc32(array("I", ids[at : at + size]).tobytes())))
            at += size
        want.setdefault(doc, []).extend(pieces)
    assert {d: sorted((r.piece, r.start, r.length, r.ids_crc32) for r in x) for d, x in by_doc.items()} == {
        d: sorted(x) for d, x in want.items()
    }
    for members in bins.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(bins)


def test_ids_equal_the_whole_text(coder, awkward_rows, corpus):
    odd = ["x  ", "  x", "x \n y", "a\n b", "\n \ny", "it's  we'll x", "\x1c \x85   z", " ", "1234 ½ é́"]
    for text in [t for _, t in awkward_rows + corpus if t] + odd:
        got = np.frombuffer(coder.encode(text), np.uint32).tolist()
        assert got == ids_of(coder, text)[:-1]


def test_knapsack_against_all_sets():
    rng = random.Random(3)
    for _ in range(40):
        capacity = rng.randint(5, 14)
        price, most = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
        for length in rng.sample(range(1, capacity + 1), 4):
            price[length], most[length] = rng.random(), rng.randint(1, 3)
        lengths = np.flatnonzero(most).tolist()
        best = max(
            sum(n * price[x] for n, x in zip(k, lengths))
            for k in itertools.product(*(range(most[x] + 1) for x in lengths))
            if sum(n * x for n, x in zip(k, lengths)) <= capacity
        )
        counts, value = packing.best_configuration(price, most)
        assert value == pytest.approx(best) and (counts <= most).all()
        assert counts @ price == pytest.approx(best) and counts @ np.arange(capacity + 1) <= capacity


def least_sequences(pieces, capacity):
    """The fewest sequences, by trying all ways."""
    pieces, best = sorted(pieces, reverse=True), len(pieces)

    def put(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(pieces):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= pieces[i]}:
            at = rooms.index(room)
            put(i + 1, rooms[:at] + rooms[at + 1 :] + (room - pieces[i],))
        put(i + 1, rooms + (capacity - pieces[i],))

    put(0, ())
    return best


def test_plan_against_the_optimum():
    rng = random.Random(4)
    for _ in range(25):
        pieces = [rng.randint(1, 20) for _ in range(rng.randint(1, 9))]
        histogram = {x: pieces.count(x) for x in set(pieces)}
        plan = packing.solve(histogram, 20, 60)
        least = least_sequences(pieces, 20)
        assert plan.bound <= least + 1e-9 and least <= plan.sequences() <= least + 1


@pytest.mark.parametrize("n", [10, 300, 20_000])
def test_plan_holds_the_histogram_near_the_bound(n):
    rng = np.random.default_rng(n)
    sizes, counts = np.unique(np.minimum(rng.lognormal(5.5, 1, n).astype(int) % 1023 + 1, 1024), return_counts=True)
    plan = packing.solve(dict(zip(sizes.tolist(), counts.tolist())))
    held = sum(copies * c for copies, c in plan.groups)
    assert held[sizes].tolist() == counts.tolist() and held.sum() == n
    assert all(c @ np.arange(1025) <= 1024 and copies > 0 for copies, c in plan.groups)
    assert plan.sequences() <= plan.bound * 1.01 + 2
    # pieces are in no two places, and the plan's size does not follow the data's
    for length, rows in plan.places().items():
        assert rows[0, 0] == 0 and (np.diff(rows[:, 0]) > 0).all()
    assert len(plan.groups) < 4000


def test_multiplied_histogram_has_no_larger_plan():
    rng = np.random.default_rng(1)
    sizes, counts = np.unique(rng.integers(1, 1024, 3000), return_counts=True)
    small = packing.solve(dict(zip(sizes.tolist(), (10 * counts).tolist())))
    large = packing.solve(dict(zip(sizes.tolist(), (1_000_000 * counts).tolist())))
    assert len(large.groups) < 2 * len(small.groups) + 1000
    assert large.sequences() <= large.bound * 1.03


def test_pieces(spark, coder, docs, corpus):
    got = packing.pack_whole(docs, byte_vocabulary_path(None)).collect()
    total = sum(len(ids_of(coder, t)) for _, t in corpus)
    assert check(coder, corpus, got) <= -(-total // 1024) * 1.05 + 2


def test_small_capacity(spark, coder, docs, corpus):
    check(coder, corpus, packing.pack_whole(docs, byte_vocabulary_path(None), capacity=64).collect(), 64)


def test_awkward(spark, coder, awkward_rows):
    df = frame(spark, awkward_rows, (*CLASHES, "part", "nth", "length", "number", "before", "n")).repartition(3)
    check(coder, awkward_rows, packing.pack_whole(df, byte_vocabulary_path(None)).collect())


def test_empty(spark, empty):
    assert packing.pack_whole(empty, byte_vocabulary_path(None)).collect() == []


def test_query(spark, coder, sf_small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = op12_configuration_packing(spark, sf_small).collect()
    total = sum(len(ids_of(coder, t)) for _, t in rows)
    assert check(coder, rows, got) <= -(-total // 1024) * 1.02 + 2
