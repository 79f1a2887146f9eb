import random
import re
import zlib
from collections import Counter

import pytest
from conftest import frame, passage

from creditspark.llm import spelling


def one_edit(a, b):
    """Exactly one inserted, deleted or replaced code point, by trying them."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = 1 if doc is None else zlib.crc32(f"{doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def run(df):
    return sorted((tuple(r) for r in spelling.variants(df).collect()), key=str)


@pytest.fixture(scope="module")
def typo_rows():
    """Words of very different frequency, with typos at every place, chains of them, ties and other scripts."""
    rng = random.Random(8)
    letters = "abcdexyzéÀ"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 12))) for _ in range(60)]
    text = []
    for k, w in enumerate(base):
        text += [w] * rng.choice([5, 30, 200])
        for _ in range(6):
            i, kind = rng.randrange(len(w)), rng.randrange(3)
            typo = w[:i] + ("" if kind == 0 else rng.choice(letters)) + w[i + (kind < 2) :]
            text += [typo] * rng.choice([4, 5, 6, 40])
            if k % 5 == 0:
                text += [typo[:2] + "q" + typo[2:]] * 5
    text += ["commonhead" + a + b for a in letters for b in letters for _ in range(5)]
    text += ["ſtraße", "straſse", "ÉCOLES", "école×x", "x" * 3000, "x" * 2999 + "y", "x" * 2999] * 5
    rng.shuffle(text)
    return [(i, rng.choice([" ", "\n", "-", "7"]).join(text[i * 40 : i * 40 + 40])) for i in range(len(text) // 40 + 1)]


def test_against_brute_force(spark, typo_rows):
    want = brute(typo_rows)
    assert run(frame(spark, typo_rows).repartition(4)) == want
    assert any(r[1] and r[2] != r[1] for r in want)  # a chain
    assert max(r[4] for r in want) > 15


@pytest.mark.parametrize(("rows", "cells"), [(3, 1 << 19), (512, 40), (1, 1)])
def test_tiles_of_many_blocks(spark, typo_rows, monkeypatch, rows, cells):
    """Cut tiles find the same pairs, each once."""
    words = spark.createDataFrame([(r[0], r[3]) for r in brute(typo_rows)], "word string, n long").cache()
    whole = sorted(map(tuple, spelling.near_words(words).collect()))
    monkeypatch.setattr(spelling, "ROWS", rows)
    monkeypatch.setattr(spelling, "CELLS", cells)
    dealt = spelling.tiles(words, 6)
    assert dealt.where("not own").count() > 0
    if rows == 3:
        assert dealt.groupBy("tile").count().agg({"count": "max"}).first()[0] < 40
    assert sorted(map(tuple, spelling.near_words(words).collect())) == whole
    assert len(set(whole)) == len(whole)


def test_every_single_edit_meets(spark):
    """Every insertion, deletion and replacement at every place, for all lengths from 6 to 11."""
    words = {"abcdefghijk"[:n] for n in range(6, 12)}
    for w in sorted(words):
        words |= {w[:i] + "z" + w[i + k :] for i in range(len(w) + 1) for k in (0, 1)}
        words |= {w[:i] + w[i + 1 :] for i in range(len(w))}
    words = sorted(w for w in words if len(w) >= 6)
    got = spelling.near_words(spark.createDataFrame([(w, 9) for w in words], "word string, n long")).collect()
    want = {(a, b) for a in words for b in words if a != b and one_edit(a, b)}
    assert sorted((r.word, r.other) for r in got) == sorted(want)


def test_real_words(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    assert run(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_awkward(spark, awkward, awkward_rows):
    assert run(awkward) == brute(awkward_rows)


def test_many_copies_and_null_ids(spark):
    rng = random.Random(2)
    text = passage(rng, 300) + " éstblé Éstble " * 3
    rows = [(7, text)] * 30 + [(None, text)] * 20 + [(8, None), (9, "")]
    assert run(frame(spark, rows).repartition(3)) == brute(rows)


def test_empty(spark, empty):
    assert run(empty) == []
    assert run(frame(spark, [(1, "short ones"), (2, None)])) == []
