import random
import re
from collections import Counter

import brute
import numpy as np
from conftest import CLASHES, frame, passage

from creditspark.llm import quality_rules as q
from creditspark.llm import toxicity as t

SF = "/root/testdata/sf0.01"


def counted(text):
    text = text or ""
    w = brute.words(text)
    lines = [x for x in text.split("\n") if brute.words(x)]
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    twice = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(twice),
        len(lines), len(re.findall("[A-Z]", text)), len(re.findall("[0-9]", text)), len(re.findall("[!?]", text)),
    )


def test_counts(corpus, awkward_rows):
    rng = random.Random(1)
    texts = [x for _, x in corpus + awkward_rows] + ["".join(rng.choice("ab #|\n\té中!7") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    got = q.count_texts(texts)
    assert [tuple(r) for r in got.itertuples(index=False)] == [counted(x) for x in texts]
    assert tuple(got.columns) == q.COUNTS


def test_covering_finds_the_rules():
    rng = np.random.default_rng(3)
    x = {k: rng.random(3000) for k in ("symbols", "upper", "words")}
    bad = (x["symbols"] > 0.8) | (x["upper"] > 0.9) & (x["words"] < 0.5)
    rules = q.learn(x, bad)
    told = np.zeros(3000, bool)
    for r in rules:
        told |= np.logical_and.reduce([c.holds(x) for c in r])
    assert (told == bad).mean() > 0.98 and bad[told].mean() > 0.98
    assert q.learn(x, rng.random(3000) < 0.1) == []  # nothing to be found
    assert q.learn(x, np.zeros(3000, bool)) == []


def judged(spark, docs, labels):
    return q.verdicts(q.statistics(docs), q.learn_rules(docs, labels))


def test_held_out_accuracy(spark):
    sf = SF.replace("0.01", "0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rules = q.learn_rules(docs, labels.where("doc_id % 3 <> 0"))
    rows = q.verdicts(q.statistics(docs), rules).join(labels.where("doc_id % 3 = 0"), "doc_id").where("not base_failed").collect()
    assert len(rows) > 80
    assert sum((r.quality == 1) == r.kept for r in rows) / len(rows) > 0.95
    assert not any(r.quality == 1 and not r.kept for r in rows)


def test_quality_awkward(spark, awkward, awkward_rows, empty):
    labels = spark.createDataFrame([(4, 1), (9, 0), (None, 0), (10, None), (99, 1)], "doc_id long, quality int")
    got = [tuple(r) for r in judged(spark, awkward, labels).select("doc_id", *q.COUNTS, "base_failed", "kept").collect()]
    want = []
    for doc, text in awkward_rows:
        c = counted(text)
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        want.append((doc, *c, failed, not failed))
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    kept = q.keep_good(awkward, labels)
    assert kept.columns == awkward.columns and kept.count() == sum(r[-1] for r in want)
    assert judged(spark, empty, labels).count() == 0 and q.keep_good(empty, labels).count() == 0
    assert q.keep_good(awkward, labels.where("false")).count() == kept.count()


def test_list_is_one_ordered_expression():
    rules = [(q.Condition("symbols", True, 0.3), q.Condition("words", False, 400.0)), (q.Condition("upper", True, 0.5),)]
    text = str(q.decision(rules))
    assert text.index("THEN 1") < text.index("THEN 2")


def test_features_levels():
    of, f = t.features(["Bad bad, BAD worse", None, "ok"])
    known = np.unique(f[of == 0])
    doc, at = t.Vocabulary(known).find(of, f)
    assert set(doc.tolist()) == {0}
    assert sorted(Counter((at[doc == 0] // t.LEVELS).tolist()).values())[-1] == 3  # "bad" three times
    assert len(at) == len(set(at.tolist()))


def test_nnpu_recovers_what_is_hidden():
    rng = np.random.default_rng(4)
    n, prior = 4000, 0.3
    toxic = rng.random(n) < prior
    rows = [np.flatnonzero(rng.random(20) < np.where(np.arange(20) < 4, 0.6 if y else 0.03, 0.2)) for y in toxic]
    p = [r for r, y in zip(rows[:1500], toxic) if y]
    w, b = t.fit_nnpu(p, rows[1500:3000], 20, prior)
    f = np.array([b + w[r].sum() for r in rows[3000:]])
    assert ((f > 0) == toxic[3000:]).mean() > 0.9


def test_toxicity_on_held_out_rows(spark):
    sf = SF.replace("0.01", "0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = t.scores(docs, t.train(docs, labels)).join(labels, "doc_id").where(t.held_out()).select("score", "toxic").toPandas()
    hit = scored.score >= t.CUT
    assert len(scored) > 1000 and scored.score.between(0, 1).all()
    assert (hit == (scored.toxic == 1)).mean() > 0.96
    assert hit[scored.toxic == 1].mean() > 0.85 and hit[scored.toxic == 0].mean() < 0.03


def test_held_out_is_crc32_mod_3(spark):
    import zlib

    rows = spark.range(-5, 60).toDF("doc_id").select("doc_id", t.held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert spark.sql("select cast(null as long) as doc_id").select(t.held_out().alias("h")).first().h is False


def test_toxicity_awkward(spark, awkward, awkward_rows, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert t.train(awkward, none) is None
    assert {r.score for r in t.scores(awkward, None).collect()} == {0.0}
    few = spark.createDataFrame([(4, 1), (9, 0), (11, 0), (None, 1), (2, 0)], "doc_id long, toxic int")
    rng = random.Random(1)
    more = frame(spark, awkward_rows + [(i, passage(rng, 60)) for i in range(100, 140)], CLASHES)
    got = t.scores(more, t.train(more, few)).collect()
    assert len(got) == len(awkward_rows) + 40 and all(0 <= r.score <= 1 for r in got)
    assert t.scores(empty, t.train(empty, few)).count() == 0
