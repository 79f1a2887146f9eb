import itertools
import math
import random
import re

import pytest
from conftest import CLASHES, frame, passage
from pyspark.sql import functions as F

from creditspark.llm import decontamination as dc
from creditspark.llm import secret_ledger as sl
from creditspark.llm.shared import fresh_path

PATTERNS = [
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def spans(text):
    return sorted((m.start(), k, kind, m.end()) for k, (kind, p, ok) in enumerate(PATTERNS) for m in p.finditer(text or "") if ok(m))


def secret_rows(n=250):
    rng = random.Random(9)
    bits = ["password", "TOKEN", "api_key", "apikey", "=", ":", " ", '"', "'", "abc", "deadbeef0123", "AKIA", "AKIAABCDEFGH", "XY12", "é", "中", "=x", "secret", "\n", "0a" * 13, "longvalue/1"]
    return [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(n)]


def reported(df):
    return sorted(((r.doc_id, [tuple(x) for x in r.findings]) for r in df.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))


def test_secret_spans(spark):
    rows = secret_rows()
    got = reported(sl.scan_versions(frame(spark, rows, CLASHES), fresh_path(spark, "t"), sl.BASE_RULES))
    assert got == [(d, spans(t)) for d, t in rows]
    assert sum(len(spans(t)) for _, t in rows) > 150


def test_more_rules_only_add(spark):
    rows = [(1, "x ghp_" + "a1B2" * 10 + " -----BEGIN RSA PRIVATE KEY----- password=hunter22")]
    (found,) = [f for _, f in reported(sl.scan_versions(frame(spark, rows), fresh_path(spark, "t")))]
    assert [x[2] for x in found] == ["forge", "pem", "assign"] and [x for x in found if x[1] < 3] == spans(rows[0][1])


def test_ledger_scans_unseen_pairs_only(spark):
    ledger, rows = fresh_path(spark, "t"), secret_rows(60)
    sl.scan_versions(frame(spark, rows[:40]), ledger, sl.BASE_RULES[:2])
    scanned = lambda: spark.read.schema(sl.SCANNED).parquet(f"{ledger}/scanned")
    first = scanned().count()
    assert first == 2 * len({t for _, t in rows[:40]})
    spark.createDataFrame([("0" * 64, "assign@1", "assign", 1, 2)], sl.FINDINGS).write.mode("append").parquet(f"{ledger}/findings")
    again = reported(sl.scan_versions(frame(spark, rows[:40]), ledger, sl.BASE_RULES[:2]))
    assert scanned().count() == first  # nothing new
    assert again == [(d, [x for x in spans(t) if x[1] < 2]) for d, t in rows[:40]]
    # new blobs, a further rule, and old blobs under new paths
    moved = rows + [(1000 + d, t) for d, t in rows[:10]]
    got = reported(sl.scan_versions(frame(spark, moved), ledger, sl.BASE_RULES))
    assert got == [(d, spans(t)) for d, t in moved]
    assert scanned().count() == scanned().distinct().count() == 3 * len({t for _, t in rows})
    # a new version of a rule is scanned anew and replaces the old one's findings
    newer = (sl.Rule("hex", r"[0-9a-f]{30,}", version=2),)
    got = reported(sl.scan_versions(frame(spark, rows), ledger, newer))
    assert all(e - s >= 30 for _, f in got for s, _, _, e in f)
    assert scanned().where("rule = 'hex@2'").count() == len({t for _, t in rows})


def test_secrets_awkward(awkward, awkward_rows, empty, spark):
    got = sl.scan_versions(awkward, fresh_path(spark, "t"))
    assert got.count() == len(awkward_rows)
    assert got.where("doc_id in (1, 2) or doc_id is null and blob = sha2('', 256)").select("blob").distinct().count() == 1
    assert got.where(F.size("findings") > 0).count() == 0
    assert sl.scan_versions(empty, fresh_path(spark, "t")).count() == 0


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def overlaps(doc, item):
    a, b = words(doc), words(item)
    n = min(dc.OVERLAP, len(b))
    if len(b) < dc.SPAN or len(a) < dc.SPAN:
        return False
    for shift in range(-len(b) + 1, len(a)):
        same = [0 <= shift + i < len(a) and a[shift + i] == b[i] for i in range(len(b))]
        if any(sum(same[i : i + n]) >= math.ceil(0.8 * n) for i in range(len(b) - n + 1)):
            return True
    return False


def leak_rows():
    rng = random.Random(21)
    items = [(i, passage(rng, rng.choice([9, 12, 15, 16, 30, 50]))) for i in range(12)]
    items += [(50, passage(rng, 600)), (51, items[3][1]), (52, "too short"), (53, None)]
    docs = []
    for i in range(60):
        text = passage(rng, rng.randint(0, 60))
        if i % 2:
            w = rng.choice(items[:13])[1].split()
            w = w[rng.randint(0, max(0, len(w) - 40)) :][:40]
            for _ in range(rng.randint(0, len(w) // 4)):
                w[rng.randrange(len(w))] = "other"
            text += " " + ", ".join(w).capitalize() + " " + passage(rng, rng.randint(0, 20))
        docs.append((i, text))
    return docs, items


@pytest.mark.parametrize("block", [2, 4096])
def test_contaminated(spark, monkeypatch, block):
    monkeypatch.setattr(dc, "BLOCK_PASSAGES", block)
    docs, items = leak_rows()
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, words string")
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(frame(spark, docs, CLASHES), bench).collect()}
    want = {(d, i) for d, t in docs for i, x in items if i != 51 and overlaps(t, x)}
    assert got == want and len({d for d, _ in want}) > 15
    kept = dc.without_benchmark(frame(spark, docs, CLASHES), bench)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in want}


@pytest.mark.parametrize("n", [12, 13, 14, dc.OVERLAP])
def test_masks_are_sensitive(n):
    """Every way of substituting as many words as verification lets pass leaves a hit."""
    assert all(len(m) == dc.SPAN and m[0] == m[-1] == "1" for m in dc.MASKS)
    for wrong in itertools.combinations(range(n), n - math.ceil(dc.EQUAL * n)):
        assert any(
            all(p + i not in wrong for i, c in enumerate(m) if c == "1")
            for m in dc.MASKS for p in range(n - dc.SPAN + 1)
        )


@pytest.mark.parametrize("n", range(1, dc.SHORT))
def test_short_masks_are_sensitive(n):
    for wrong in itertools.combinations(range(n), n - math.ceil(dc.EQUAL * n)):
        assert any(all(i not in wrong for i, c in enumerate(m) if c == "1") for m in dc.short_masks(n))


def test_short_items_are_searched_for(spark):
    """Every substitution that passes, and one more, in the middle of a text, at its ends, and alone."""
    rng = random.Random(4)
    items = [(n, " ".join(f"{w}{n}" for w in passage(rng, n).split())) for n in range(1, dc.SHORT)]
    docs, want = [], set()
    for n, item in items:
        may = n - math.ceil(dc.EQUAL * n)
        for wrong in [c for k in range(may + 2) for c in itertools.combinations(range(n), k)]:
            w = ["other" if i in wrong else x for i, x in enumerate(item.split())]
            for before, after in ((12, 12), (0, 3), (3, 0), (0, 0)):
                doc = " ".join(["pad"] * before + w + ["pad"] * after)
                if len(wrong) <= may:
                    want.add((len(docs), n))
                docs.append((len(docs), doc))
        for w in (item.split()[may:], item.split()[: n - may]):  # the text begins or ends within the item
            want.add((len(docs), n))
            docs.append((len(docs), " ".join(w)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = frame(spark, docs)
    assert {(r.doc_id, r.item_id) for r in dc.contaminated(df, bench).collect()} == want
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan(dc.report(df, bench)))


def test_decontamination_awkward(spark, awkward, awkward_rows, empty):
    bench = spark.createDataFrame([(1, awkward_rows[3][1]), (2, None), (3, ""), (None, "x " * 20)], "item_id long, text string")
    got = dc.report(awkward, bench)
    assert got.count() == len(awkward_rows)
    assert {r.doc_id for r in got.where("contaminated").collect()} == {4, 5, 11, -12}
    kept = dc.without_benchmark(awkward, bench)
    assert kept.columns == awkward.columns and kept.where("doc_id is null").count() == 2
    assert dc.report(empty, bench).count() == 0
    assert dc.report(awkward, bench.where("false")).where("contaminated").count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_native_plans_hold_no_python(spark, docs):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p")], "item_id long, text string")
    for df in (dc.report(docs, bench), sl.scan_versions(docs, fresh_path(spark, "t"))):
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan(df))
