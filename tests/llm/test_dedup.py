import hashlib
import random

import brute
import numpy as np
import pytest
from conftest import CLASHES, frame, passage
from pyspark.sql import functions as F

from creditspark.llm import simhash_dedup as sd
from creditspark.llm.graph import connected_components
from creditspark.llm.line_dedup import KEYS, drop_repeated_lines, edit_distance, without_repeated_lines
from creditspark.llm.substring_dedup import remove_repeats, sliding_min


def digest(df):
    return {
        r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in df.collect()
    }


def test_substrings(docs, corpus):
    want = brute.substring_dedup(corpus)
    assert digest(remove_repeats(docs)) == want
    assert sum(x[1] for x in want.values()) > 500


@pytest.mark.parametrize("k, gram", [(4, 2), (5, 5), (7, 3)])
def test_substrings_short_windows(spark, k, gram):
    rng = random.Random(k)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 40)))) for i in range(60)]
    assert digest(remove_repeats(frame(spark, rows), k, gram)) == brute.substring_dedup(rows, k)


def test_substrings_awkward(awkward, awkward_rows, empty):
    got = [tuple(r) for r in remove_repeats(awkward).collect()]
    assert len(got) == len(awkward_rows)
    by = {}
    for doc, n, removed, kept in got:
        assert len(brute.words(kept)) == n - removed
        by.setdefault(doc, []).append((n, removed))
    assert sorted(by[None]) == [(0, 0), (60, 0)]  # without an id nothing is removed
    assert by[4] == [(60, 60)] * 2 and sorted(by[5]) == [(60, 0), (60, 60)]  # after -12
    assert by[-12] == [(61, 0)] and by[11] == [(180, 180)] and by[14] == [(3000, 0)]
    assert by[1] == by[2] == by[3] == [(0, 0)]
    assert remove_repeats(empty).count() == 0


def test_sliding_min():
    x = np.random.default_rng(1).integers(0, 99, 50)
    for w in range(1, 20):
        assert sliding_min(x, w).tolist() == [x[i : i + w].min() for i in range(51 - w)]


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(i, i + 1) for i in range(500, 700)]
    edges += [(1000, i) for i in range(1001, 1300)] + [(2, None), (None, None), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    links = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    nodes = sorted({x for e in links for x in e})
    at = {n: i for i, n in enumerate(nodes)}
    near = {}
    for a, b in links:
        near.setdefault(at[a], []).append(at[b])
    assert got == brute.components(nodes, lambda i: near.get(i, []))
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def groups(df):
    rows = df.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("h"), "component_id").collect()
    return {r.doc_id: (r.h, r.component_id) for r in rows}


def test_simhash(docs, corpus):
    want = brute.simhash_groups(corpus)
    assert groups(sd.near_duplicates(docs)) == want
    assert sum(d != c for d, (_, c) in want.items()) >= 8
    kept = sd.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, (_, c) in want.items() if d == c)


def test_simhash_equals_spark_xxhash(spark):
    h, n = sd.shingle_hashes([b"one two  three\tfour", b"x", b""], 3)
    want = spark.sql("select xxhash64('one two three') a, xxhash64('two three four') b, xxhash64('x') c").first()
    assert h.view(np.int64).tolist() == list(want) and n.tolist() == [2, 1, 0]


def test_simhash_awkward(awkward, awkward_rows, empty):
    got = [tuple(r) for r in sd.near_duplicates(awkward).drop("version").collect()]
    assert len(got) == len(awkward_rows)
    fps = np.array([brute.fingerprint(t) for _, t in awkward_rows], np.uint64)
    near = lambda i: np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3)
    comp = brute.components(list(range(len(fps))), near)
    least = {}
    for i, (d, _) in enumerate(awkward_rows):
        if d is not None:
            least[comp[i]] = min(d, least.get(comp[i], d))
    want = [(d, int(fps[i].astype(np.int64)), least.get(comp[i])) for i, (d, _) in enumerate(awkward_rows)]
    none = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(got, key=none) == sorted(want, key=none)
    assert sd.near_duplicates(empty).count() == 0
    kept = sd.one_of_each(awkward)
    assert kept.columns == awkward.columns and kept.where("doc_id is null").count() == 2
    ids = [r.doc_id for r in kept.where("doc_id is not null").collect()]
    assert len(ids) == len(set(ids)) and sd.one_of_each(empty).count() == 0


@pytest.mark.parametrize("limit", [32, 64, 4096])
def test_shards_lose_no_pair(spark, limit):
    rng = random.Random(limit)
    centre = rng.getrandbits(64)
    near = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(120)}
    values = sorted(near | {rng.getrandbits(64) for _ in range(100)})
    fps = np.array(values, np.uint64)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    seen = {}
    for r in sd.shards(df, 3, limit).collect():
        seen.setdefault(r.shard, set()).add(r.fp & (2**64 - 1))
    pairs = {(a, b) for s in seen.values() for a in s for b in s if a < b and (a ^ b).bit_count() <= 3}
    want = {(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= 3}
    assert pairs == want and len(want) > 50


def test_bk_tree_follows_what_it_must():
    rng = random.Random(1)
    values = [rng.getrandbits(10) for _ in range(300)]
    tree = sd.BKTree()
    for v in values:
        tree.add(v)
    for q in values[:50]:
        assert sorted(tree.within(q, 2)) == [i for i, v in enumerate(values) if (v ^ q).bit_count() <= 2]
    distinct = sorted(set(values))
    edges = sd.forest(distinct, 1)
    near = {}
    for a, b in edges:
        near.setdefault(a, []).append(b)
    want = brute.components(distinct, lambda i: [j for j, v in enumerate(distinct) if (v ^ distinct[i]).bit_count() <= 1])
    assert brute.components(distinct, lambda i: near.get(i, [])) == want and len(edges) < len(distinct)


def test_lines(docs, corpus):
    want = brute.line_groups(corpus)
    got = {r.doc_id: r.text for r in drop_repeated_lines(docs).collect()}
    assert got == want and sum(len(t) for _, t in corpus) > sum(map(len, got.values())) + 1000
    sizes = {r.doc_id: (r.n_chars, len(r.text)) for r in drop_repeated_lines(docs).collect()}
    assert all(a == b for a, b in sizes.values())


def test_fuzzy_lines_are_found_and_verified(spark):
    rng = random.Random(2)
    line = passage(rng, 40)
    w = line.split()
    rows = [(1, line), (2, line.upper() + "!!"), (3, line.replace(" ", ",  ", 2)), (4, "new\n" + " ".join(w[:20] + ["zz"] + w[20:]))]
    rows += [(5, " ".join(reversed(w)))]  # the same words, but no similar text
    got = {r.doc_id: r.text for r in drop_repeated_lines(frame(spark, rows)).collect()}
    assert got == brute.line_groups(rows)
    assert got[2] == got[3] == "" and got[5] == rows[4][1]


def test_lines_equal_plain_edit_similarity(spark, corpus):
    """Against all pairs of distinct normalised lines, without any condition on fingerprints or keys."""
    rng = random.Random(8)
    rows = list(corpus)
    for i, n in enumerate([10, 10, 15, 15, 20, 20, 20, 30, 30, 40, 40]):
        w = passage(rng, n).split()
        rows.append((1000 + i, " ".join(w)))
        for k in range(1, 3 if n >= 20 else 2):
            for at in rng.sample(range(n), k):
                w[at] = "other"
            rows.append((1100 + 2 * i + k, " ".join(w)))
    kinds = {}
    for doc, text in sorted(rows):
        for k, line in enumerate(text.split("\n")):
            if x := brute.normal_line(line):
                kinds.setdefault(x, []).append((doc, k))
    lines = list(kinds)

    def linked(i):
        for j in range(i):
            longest = max(len(lines[i]), len(lines[j]))
            if abs(len(lines[i]) - len(lines[j])) <= 0.2 * longest and longest - edit_distance(lines[i], lines[j]) >= 0.8 * longest:
                yield j

    group, places = brute.components(lines, linked), {}
    for x in lines:
        places.setdefault(group[x], []).extend(kinds[x])
    gone = {p for all_ in places.values() for p in sorted(all_)[1:]}
    want = {d: "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone) for d, t in rows}
    got = {r.doc_id: r.text for r in drop_repeated_lines(frame(spark, rows), keys=KEYS).collect()}
    assert got == want and want != brute.line_groups(rows)


def test_lines_awkward(awkward, awkward_rows, empty):
    cut = without_repeated_lines(awkward)
    got = [(r.row.doc_id, r.text, r.n_lines, r.n_removed) for r in cut.collect()]
    assert len(got) == len(awkward_rows)
    by = {}
    for d, *rest in got:
        by.setdefault(d, []).append(tuple(rest))
    assert by[1] == [(None, 0, 0)] and by[2] == [("", 1, 0)] and (None, 0, 0) in by[None]
    assert {x[2] for x in by[None]} == {0}
    assert by[4] == [by[4][0]] * 2 and by[11][0][2] == 3
    kept = drop_repeated_lines(awkward)
    assert kept.columns == awkward.columns and kept.count() == len(awkward_rows)
    assert {r.row for r in kept.select("row").collect()} == {"own row"}
    assert drop_repeated_lines(empty).count() == 0


@pytest.mark.parametrize("rows", [1024, 3])
def test_short_and_hot_lines_meet(spark, monkeypatch, rows):
    """Typos in lines of a few words, and a meeting of many lines that is cut into blocks."""
    from creditspark.llm import line_dedup

    monkeypatch.setattr(line_dedup, "ROWS", rows)
    rng = random.Random(12)
    texts = ["internationalisation", "internationalization", "contact us", "contact uss", "Subscribe to newsletter",
             "subscribe tu newsletter!", "=====", "=====", "all rights reserved 2019", "all rights reserved 2024"]
    tail = passage(rng, 8)
    # one shard: the same few words over and over, some similar and some not
    texts += [f"{tail} {passage(rng, 1)}" for _ in range(25)] + [f"{tail.split()[0]} {passage(rng, 9)}" for _ in range(10)]
    docs = list(enumerate(texts))
    got = {r.doc_id: r.text for r in drop_repeated_lines(frame(spark, docs), keys=KEYS).collect()}
    assert got == brute.edit_groups(docs)
    assert got[1] == got[3] == got[5] == got[9] == "" and got[7] == "====="


def test_keys_do_not_depend_on_the_other_lines():
    from creditspark.llm.line_dedup import line_keys

    rng = random.Random(1)
    lines = [passage(rng, n) for n in (1, 2, 3, 4, 5, 6, 9, 40)] + ["a", "éé x"]
    alone = [line_keys(f"{x}\n".encode(), KEYS)[0].tolist() for x in lines]
    assert [x.tolist() for x in line_keys("\n".join([*lines, "", ""]).encode(), KEYS)] == alone
    assert [len(x) for x in alone] == [7, 7, 7, 14, 14, 7, 7, 7, 7, 7]
    assert [x & 7 for x in alone[3]] == [*range(7)] * 2


def test_run_counts_never_differ_by_more_than_the_edits():
    from creditspark.llm.line_dedup import run_counts

    rng = random.Random(4)
    for _ in range(300):
        a = "".join(rng.choice("abé x") for _ in range(rng.randint(0, 30)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at, kind = rng.randint(0, len(b)), rng.randrange(3)
            b[at : at + (kind > 0)] = [] if kind == 2 else [rng.choice("abé x")]
        b = "".join(b)
        counts = run_counts([a, b, "other"])
        assert np.abs(counts[0] - counts[1]).sum() <= 6 * brute.levenshtein(a, b)
        assert counts.sum(axis=1).tolist() == [len(a), len(b), 5]


def _pairs(rng, count):
    """Texts and edited copies of them, from none to far too many edits, and their parts in another order."""
    for k in range(count):
        a = passage(rng, rng.randint(3, 60))
        b = list(a)
        for _ in range(rng.randint(0, 1 + len(a) // 3) if k % 3 else 2):
            at, kind = rng.randint(0, len(b)), rng.randrange(3)
            b[at : at + (kind > 0)] = [] if kind == 2 else [rng.choice("abé x")]
        cut = rng.randint(0, len(b)) if k % 4 == 0 else 0
        yield a, "".join(b[cut:] + b[:cut])


def test_bounds_of_the_distance_lose_no_similar_pair():
    from creditspark.llm.line_dedup import allowed, at_most, runs_in_place, similar

    rng, found, left = random.Random(5), 0, 0
    for a, b in _pairs(rng, 600):
        d, most = edit_distance(a, b), allowed(a, b)
        assert at_most(a, b, most) >= d and at_most(a, a, most) == 0
        stay = runs_in_place(a, [b, a], 0.8).tolist()
        assert stay[1] and (stay[0] or d > most)
        assert similar(a, b) == (d <= most)
        found, left = found + (at_most(a, b, most) <= most), left + (not stay[0])
    assert found > 150 and left > 50


def test_links_of_a_meeting_are_stars(spark):
    """However often near copies meet, their links are one star: as many as there are lines but one."""
    import pandas as pd

    from creditspark.llm.line_dedup import _verified

    rng = random.Random(9)
    w = passage(rng, 40).split()
    texts = [" ".join([*w[:k], f"new{k}", *w[k + 1 :]]) for k in range(12)] + [passage(rng, 40)]
    nodes = rng.sample(range(-(10**6), 10**6), 13)
    rows = [(shard, nth, x, x, 0, 0, t) for shard, nth in ((1, 0), (2, 1), (3, 6)) for x, t in rng.sample(list(zip(nodes, texts, strict=True)), 13)]
    frame_ = pd.DataFrame(rows, columns=["shard", "nth", "node", "component", "block", "fp", "normal"])
    edges = pd.concat(list(_verified(iter([frame_]), 3, 0.8, KEYS)))
    least = min(nodes[:12])
    assert sorted(set(zip(edges.a, edges.b, strict=True))) == sorted((x, least) for x in nodes[:12] if x != least)
    assert len(edges) == 3 * 11


def test_lines_awkward_with_keys(awkward, awkward_rows, empty):
    cut = without_repeated_lines(awkward, keys=KEYS)
    got = [(r.row.doc_id, r.text, r.n_lines, r.n_removed) for r in cut.collect()]
    assert len(got) == len(awkward_rows)
    by = {}
    for d, *rest in got:
        by.setdefault(d, []).append(tuple(rest))
    assert by[1] == [(None, 0, 0)] and by[2] == [("", 1, 0)] and (None, 0, 0) in by[None]
    assert {x[2] for x in by[None]} == {0}
    assert by[4] == [by[4][0]] * 2 and by[11][0][2] == 3
    kept = drop_repeated_lines(awkward, keys=KEYS)
    assert kept.columns == awkward.columns and kept.count() == len(awkward_rows)
    assert {r.row for r in kept.select("row").collect()} == {"own row"}
    assert drop_repeated_lines(empty, keys=KEYS).count() == 0


def test_edit_distance():
    rng = random.Random(6)
    for _ in range(400):
        a, b = ("".join(rng.choice("abé ") for _ in range(rng.randint(0, 40))) for _ in range(2))
        assert edit_distance(a, b) == brute.levenshtein(a, b)
    assert CLASHES


def test_edit_distance_up_to_a_bound():
    from creditspark.llm.line_dedup import similar

    rng = random.Random(7)
    for _ in range(600):
        a = "".join(rng.choice("abé x") for _ in range(rng.randint(0, 50)))
        b = list(a)
        for _ in range(rng.randint(0, 1 + len(a) // 3)):
            at, kind = rng.randint(0, len(b)), rng.randrange(3)
            b[at : at + (kind > 0)] = [] if kind == 2 else [rng.choice("abé x")]
        b, most = "".join(b), rng.randint(0, 20)
        d, longest = brute.levenshtein(a, b), max(len(a), len(b))
        got = edit_distance(a, b, most)
        assert got == d if d <= most else got > most
        assert similar(a, b) == (10 * (longest - d) >= 8 * longest)


def _edited(rng, count, longest):
    """Lines of words and copies of them with edits anywhere or at one place, from none to more than are allowed."""
    words = [passage(rng, 1) + rng.choice(("", "é", "x", "ly")) for _ in range(200)]
    for k in range(count):
        a = " ".join(rng.choice(words) for _ in range(rng.choice((0, 1, 4, 12, 40, 120))))[:longest]
        b, place = list(a), rng.randint(0, len(a))
        for _ in range(rng.randint(0, int(len(a) * rng.choice((0.05, 0.2, 0.24, 0.4))) + 1)):
            at, kind = min(place, len(b)) if k % 3 == 0 else rng.randint(0, len(b)), rng.randrange(3)
            b[at : at + (kind > 0)] = [] if kind == 2 else [rng.choice("abé x")]
        yield a, "".join(b)


def test_distances_of_many_pairs_equal_single_ones():
    from creditspark.llm.line_dedup import LONG, _all_similar, allowed, enough_in_place, run_bits, within

    pairs = list(_edited(random.Random(6), 700, 600))
    a, b = (np.array(x, object) for x in zip(*pairs, strict=True))
    most = np.array([allowed(x, y) for x, y in pairs])
    d = np.array([edit_distance(x, y) for x, y in pairs])
    assert 200 < (d <= most).sum() < 650
    assert within(list(a), list(b), most).tolist() == (d <= most).tolist()
    assert _all_similar(a, b, 0.8).tolist() == (d <= most).tolist()
    assert enough_in_place(a, b, most)[d <= most].all()
    other = np.roll(b, 1)
    wrong = np.array([allowed(x, y) for x, y in zip(a, other, strict=True)])
    long_ = np.array([min(len(x), len(y)) > 60 for x, y in zip(a, other, strict=True)])
    assert enough_in_place(a, other, wrong)[long_].mean() < 0.5  # what does not belong together is ruled out
    bits = run_bits([*a, *b])
    apart = np.bitwise_count(bits[: len(a)] ^ bits[len(a) :]).sum(axis=1, dtype=np.int64)
    assert (apart <= 6 * d - np.abs([len(x) - len(y) for x, y in pairs])).all()
    rng = random.Random(7)
    text = passage(rng, LONG // 4)
    far = np.array([text, text, "é" * 3], object), np.array([text[:-9] + "x", text[::-1], "é" * 3], object)
    assert len(text) > LONG and _all_similar(*far, 0.8).tolist() == [True, False, True]


def test_false_meetings_need_few_distances(monkeypatch):
    """Long lines that meet without being similar are ruled out together, before any single edit distance."""
    import pandas as pd

    from creditspark.llm import line_dedup

    rng, called = random.Random(10), []
    plain_distance = line_dedup.edit_distance
    monkeypatch.setattr(line_dedup, "edit_distance", lambda *x: called.append(x) or plain_distance(*x))
    texts = [passage(rng, 60) for _ in range(150)]
    texts += [t.replace(t.split()[5], "other") for t in texts[:20]]
    rows = [(1, 2, k, k, 0, 0, t) for k, t in enumerate(texts)]
    frame_ = pd.DataFrame(rows, columns=["shard", "nth", "node", "component", "block", "fp", "normal"])
    edges = pd.concat(list(line_dedup._verified(iter([frame_]), 3, 0.8, KEYS)))
    assert sorted(zip(edges.a, edges.b, strict=True)) == [(150 + k, k) for k in range(20)]
    assert len(called) < 500  # of 14,000 pairs


def test_memo_of_pieces_is_bounded():
    """A worker keeps the ids of about two generations of pieces, and gives the same ids after dropping some."""
    from creditspark.llm import tokens

    coder = tokens.WordCoder(tokens.vocabulary_path(None))
    assert 2 * tokens.MEMO_WORDS <= 400_000  # at about 0.6 KB each
    rng = random.Random(12)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(200)).encode() for _ in range(20)]
    first = coder.encode_all(texts)
    coder.known, coder.older = {}, {}
    assert coder.encode_all(texts) == first


def test_counts_rule_pairs_out_and_lose_none(monkeypatch):
    """Counts of characters and runs stay within what edits can change; lines of the same runs in other numbers are not compared."""
    import pandas as pd

    from creditspark.llm import line_dedup
    from creditspark.llm.line_dedup import _differ, _profiles, allowed, edit_distance, within

    rng = random.Random(21)
    a = [passage(rng, rng.randint(1, 60)) + rng.choice(["", "é", "￾￿", "\U0001f600" * 3, "e" * 400]) for _ in range(80)]
    b = []
    for x in a:
        for _ in range(rng.randint(0, len(x) // 4)):
            i = rng.randrange(len(x) + 1)
            x = x[:i] + rng.choice(["", "q", "\U0001f600"]) + x[i + rng.randint(0, 1) :]
        b.append(x or "q")
    d = np.array([edit_distance(x, y) for x, y in zip(a, b, strict=True)])
    apart = np.array([abs(len(x) - len(y)) for x, y in zip(a, b, strict=True)])
    _, runs, marks = _profiles(a + b)
    i = np.arange(80)
    assert (_differ(marks, i, i + 80) <= 2 * d - apart).all() and (_differ(runs, i, i + 80) <= 6 * d - apart).all()
    most = np.array([allowed(x, y) for x, y in zip(a, b, strict=True)])
    assert within(a, b, most).tolist() == (d <= most).tolist()
    compared = []
    monkeypatch.setattr(line_dedup, "_all_similar", lambda x, y, least: compared.append(len(x)) or np.zeros(len(x), bool))
    texts = [("ab " * 60 + "cd " * 6 + "ab cd").strip(), ("cd " * 60 + "ab " * 6 + "cd ab").strip()]
    frame_ = pd.DataFrame([(1, 0, k, k, 0, 0, t) for k, t in enumerate(texts)], columns=["shard", "nth", "node", "component", "block", "fp", "normal"])
    assert pd.concat(list(line_dedup._verified(iter([frame_]), 3, 0.8, KEYS))).empty and not compared


def test_false_meetings_of_like_lines_are_compared_together(monkeypatch):
    """Long lines of the same few syllables, which counts of runs do not tell apart, need no work pair by pair."""
    import pandas as pd

    from creditspark.llm import line_dedup

    rng, called = random.Random(31), []
    bound = line_dedup.at_most
    monkeypatch.setattr(line_dedup, "at_most", lambda *x: called.append(x) or bound(*x))
    words = ["".join(rng.choices(["on", "er", "th", "ti", "es", "in", "an", "re"], k=rng.randint(1, 3))) for _ in range(60)]
    texts = [" ".join(rng.choices(words, k=rng.randint(90, 110))) for _ in range(120)]
    texts += [t.replace(t.split()[7], "other", 1) for t in texts[:15]]
    frame_ = pd.DataFrame([(1, 2, k, k, 0, 0, t) for k, t in enumerate(texts)], columns=["shard", "nth", "node", "component", "block", "fp", "normal"])
    edges = pd.concat(list(line_dedup._verified(iter([frame_]), 3, 0.8, KEYS)))
    assert sorted(zip(edges.a, edges.b, strict=True)) == [(120 + k, k) for k in range(15)]
    assert len(called) < 200  # of some thousand pairs that counts leave


def test_bands_of_any_width_and_alphabet(monkeypatch):
    """Bands of one and of several words, a second pass, more letters than are told apart, and bounds other than a fifth."""
    from creditspark.llm import line_dedup

    rng = random.Random(32)
    for letters in ("ab", "abcdefgh é", "".join(map(chr, range(0x4E00, 0x4E00 + 300))), "a\U0001f600￾￿"):
        pairs = []
        for _ in range(150):
            a = rng.choices(letters, k=max(1, rng.choice([1, 40, 64, 300, 330, 700]) + rng.randint(-2, 2)))
            b = list(a)
            for _ in range(rng.randint(0, int(len(a) * rng.choice([0.05, 0.2, 0.3]))) + 1):
                at, kind = rng.randint(0, len(b)), rng.randrange(3)
                b[at : at + (kind > 0)] = [] if kind == 2 else [rng.choice(letters)]
            pairs.append(rng.sample(["".join(a), "".join(b)], 2))
        a, b = (list(x) for x in zip(*pairs, strict=True))
        most = np.array([line_dedup.allowed(x, y, rng.choice([0.8, 0.9, 0.5])) for x, y in pairs])
        want = [edit_distance(x, y) <= d for x, y, d in zip(a, b, most, strict=True)]
        assert line_dedup.within(a, b, most).tolist() == want
        with monkeypatch.context() as small:
            for name, value in (("PAIRS", 32), ("FEW_PAIRS", 8), ("ALONE", 1), ("LOOK", 8)):
                small.setattr(line_dedup, name, value)
            assert line_dedup.within(a, b, most).tolist() == want
