import random

import pytest

WORDS = [a + b + c for a in ("th", "er", "on", "re", "st") for b in ("a", "ea", "ou", "i") for c in ("n", "ble", "sh", "t", "r")]
CLASHES = ("version", "row", "words", "starts", "fp", "least", "blob", "todo", "kept", "n_words", "component_id", "at", "seed")


def passage(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text): fresh texts, exact copies, near copies, shared passages and repeated lines."""
    rng = random.Random(11)
    shared = [passage(rng, 70) for _ in range(3)]
    line = passage(rng, 12).capitalize() + "."
    rows = []
    for i in range(90):
        text = "\n".join(passage(rng, rng.randint(20, 90)) for _ in range(rng.randint(1, 4)))
        kind = i % 9
        if kind == 1 and i > 9:
            text = rows[rng.randrange(len(rows))][1]
        elif kind == 2 and i > 9:
            w = rows[rng.randrange(len(rows))][1].split(" ")
            w[rng.randrange(len(w))] = "changed"
            text = " ".join(w)
        elif kind == 3:
            text = text + " " + rng.choice(shared) + "\n" + passage(rng, 9)
        elif kind == 4:
            text = line + "\n" + text + "\n" + line.upper()
        elif kind == 5:
            text = rng.choice(shared)[: rng.randint(200, 500)] + " " + text
        rows.append((i * 3, text))
    rng.shuffle(rows)
    return rows


def frame(spark, rows, extra=()):
    """documents of (doc_id, text) rows, with further columns whose names operators may use inside."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    data = [(d, t, "en", "src0", None if t is None else len(t)) for d, t in rows]
    df = spark.createDataFrame(data, schema)
    from pyspark.sql import functions as F

    for c in extra:
        df = df.withColumn(c, F.lit(f"own {c}"))
    return df


@pytest.fixture(scope="session")
def awkward_rows():
    """Nulls, empty and blank texts, repeated rows, one id with two texts, a very long text."""
    rng = random.Random(5)
    same = passage(rng, 60)
    return [
        (1, None), (2, ""), (3, " \t\n\x0b \r"), (4, same), (4, same), (5, same), (5, passage(rng, 60)),
        (None, same), (None, None), (6, "one"), (7, "one two"), (8, "é" * 50 + " ﬁ Ǆ x y"),
        (9, passage(rng, 60_000)), (10, "x" * 200_000), (11, "\n".join([same] * 3)), (-12, same + " tail"),
        (2**62, "<|endoftext|> and <|ENDOFTEXT|>"), (13, "a\x00b \x1c\x85 c"), (14, "word " * 3000),
    ]


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    return frame(spark, awkward_rows, CLASHES).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [], CLASHES)


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return frame(spark, corpus).repartition(5).cache()
