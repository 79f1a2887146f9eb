import zlib
from hashlib import sha256

import pytest
from conftest import frame
from pyspark.sql import functions as F

from creditspark.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, lower=False):
    doc, source, lang, n, text = row
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    parts = ["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc, source, lang, n, text)]
    return h("".join(parts))


def tree(nodes):
    """(root, the siblings on every leaf's way, as (left, right) from below) by the definition."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for k, i in enumerate(at):
            run = runs[i // 16]
            proofs[k].append(("".join(run[: i % 16]), "".join(run[i % 16 + 1 :])))
            at[k] = i // 16
        nodes = [h(*run) for run in runs]
    return nodes[0], proofs


def brute(rows):
    """Rows (doc_id, source, lang, n_chars, text) -> sorted manifest rows."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    mine = {
        s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources
    }
    sub = {s: tree([leaf(r) for r in mine[s]]) for s in sources}
    root, above = tree([sub[s][0] for s in sources])
    out = []
    for s, up in zip(sources, above):
        for r, proof in zip(mine[s], sub[s][1]):
            proof = proof + up
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            got = leaf(r, tampered)
            for left, right in proof:
                got = h(left, got, right)
            out.append((r[0], leaf(r), sub[s][0], root, h(*(a + b for a, b in proof)), got, got == root))
    return sorted(out, key=str)


def run(df):
    return sorted((tuple(r) for r in merkle.manifest(df).collect()), key=str)


def rows_of(df):
    return [tuple(r) for r in df.select(*merkle.FIELDS).collect()]


@pytest.mark.parametrize("sizes", [[1], [300, 1, 16, 17, 257, 33], [1] * 40])
def test_shapes(spark, sizes):
    rows = [(i * 7 + 100 * s, f"s{s}", "en", 3, f"Text {i} of {s}") for s, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    assert run(df) == brute(rows)


def test_blocks_of_more_than_one_pass(spark, monkeypatch):
    """Passes of one level each: the block's borders fall between every two levels."""
    rows = [(i, "hot" if i % 3 else f"s{i % 50}", "en", i, f"A{i}") for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    full = run(df)
    assert full == brute(rows)
    # the block is a parameter of the work only; workers read it from the module, so it is tried in this process
    digests = [h(str(i)) for i in range(700)]
    root, proofs = tree(digests)
    monkeypatch.setattr(merkle, "LEVELS", 1)
    nodes, tables = digests, []
    while len(nodes) > 1:
        blocks = [merkle.forward(nodes[i : i + 16], 1) for i in range(0, len(nodes), 16)]
        tables.append((nodes, blocks))
        nodes = [b[0] for b in blocks]
    assert nodes == [root]
    suffixes = [[]]
    for _, blocks in tables[::-1]:
        suffixes = [p for s, b in zip(suffixes, blocks) for p in list(merkle.backward(b[1], 1, s))[::-1]]
    assert suffixes == [[x for pair in p for x in pair] for p in proofs]


def test_more_than_a_block(spark):
    """A source of over 4,096 documents takes two passes."""
    df = spark.range(9000).select(
        F.col("id").alias("doc_id"), F.lit("one").alias("source"), F.lit(None).cast("string").alias("lang"),
        F.lit(1).cast("long").alias("n_chars"), F.concat(F.lit("T"), "id").alias("text"),
    )
    df = df.unionByName(df.where("doc_id < 20").withColumn("source", F.lit(None).cast("string")))
    assert run(df) == brute(rows_of(df))


def test_awkward(spark, awkward):
    mixed = awkward.withColumn("source", F.expr("case when doc_id is null then null when doc_id % 2 = 0 then '' else 'Ä' end"))
    mixed = mixed.withColumn("n_chars", F.expr("if(doc_id = 6, null, n_chars)"))
    got = run(mixed)
    assert got == brute(rows_of(mixed))
    assert len(got) == 19


def test_empty(spark, empty):
    assert merkle.manifest(empty).collect() == []


def test_tampering_shows(spark, corpus):
    got = merkle.manifest(frame(spark, corpus)).collect()
    upper = {d for d, t in corpus if zlib.crc32(str(d).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in t)}
    assert upper and {r.doc_id for r in got if not r.verified} == upper
    assert {r.folded_root for r in got if r.verified} == {got[0].root}
