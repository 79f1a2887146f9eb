"""Operator 11: spelling variants grouped by dense prefix-suffix tiling.

Words of the whole corpus are counted; two are near if one code point is inserted, deleted or replaced. A
word's form is its most frequent near word, where that is much more frequent, and its root is where the
forms lead to.

Tiling: words of a tile are rows of a padded matrix of code points, aligned left, and of another, aligned
right. A block of rows is compared with another block at once: the first column that differs gives the common
prefix and, in the other matrix, the common suffix of each pair; two words are one edit apart if both
together reach the longer length less one. Which blocks have to meet follows from the same rule: of
two near words the shorter one's first half is common, or its second half is. A word thus lies in a tile for each
half, as the shorter (or equal) and as the longer word: four at most. No pair is lost, and none is met twice: the second
half's tile leaves out pairs whose first half is common.

A tile with too many words (``ROWS``, or ``CELLS`` code points) is cut into blocks, and every pair of blocks becomes a
task's tile of its own, so a frequent half is spread over many tasks. Only near pairs leave a tile, and they are
counted on the map side. Roots follow by pointer doubling; a form is at least ``RATIO`` times as frequent, so chains are
short. Counts are summed within tasks before they are shuffled.

Defined results: null or empty text: no words. Null doc_id: no letter is deleted. Repeated rows count each by
itself. A run without end (a text of one run) is a word like others. Empty table: no rows. Other columns
are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written
from .simhash_dedup import whole_groups

RUN = re.compile("[A-Za-zÀ-ÿ]+")
DELETE_EVERY, LEAST_LENGTH, LEAST_COUNT, RATIO = 199, 6, 5, 5
#: Words and code points in a block of a tile; words counted in a task before they are handed on.
ROWS, CELLS, HELD = 512, 1 << 19, 200_000
MAX_ROUNDS = 20
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _runs(frames: Iterator[pd.DataFrame], every: int, shortest: int) -> Iterator[pd.DataFrame]:
    """(word, n): the task's words, some with a code point deleted, counted."""
    held: Counter[str] = Counter()
    for frame in frames:
        for doc, text in zip(frame["doc_id"], frame["text"], strict=True):
            if not isinstance(text, str):
                continue
            runs = Counter(RUN.findall(text.encode().translate(_LOWER).decode()))
            head = None if pd.isna(doc) else b"%d:" % int(doc)
            for run, n in runs.items():
                if len(run) < shortest:
                    continue
                h = 1 if head is None else zlib.crc32(head + run.encode())
                if h % every == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < shortest:
                        continue
                held[run] += n
            if len(held) > HELD:
                yield pd.DataFrame(held.items(), columns=["word", "n"])
                held.clear()
    yield pd.DataFrame(held.items(), columns=["word", "n"])


def vocabulary(
    docs: DataFrame, every: int = DELETE_EVERY, shortest: int = LEAST_LENGTH, least: int = LEAST_COUNT
) -> DataFrame:
    """(word, n): distinct words of enough code points and occurrences."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    counted = rows.mapInPandas(lambda frames: _runs(frames, every, shortest), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def tiles(words: DataFrame, shortest: int) -> DataFrame:
    """(tile, half, short, block, other, word, n): every word once for each pair of blocks that it belongs to.

    ``short``: length of the tile's shorter words. ``tile`` names a pair of blocks (block <= other in it).
    """
    size = F.char_length("word")

    def keys(less: int):
        short = size - less
        first = F.floor(short / 2).cast("int")
        affix = (F.col("word").substr(F.lit(1), first), F.col("word").substr(first + less + 1, short - first))
        return F.when(short >= shortest, F.array(*(
            F.struct(short.alias("short"), F.lit(half).alias("half"), F.xxhash64(x).alias("affix"))
            for half, x in enumerate(affix, 1)
        )))

    halves = F.concat(keys(0), F.coalesce(keys(1), F.array().cast("array<struct<short:int,half:int,affix:bigint>>")))
    placed = written(words.select("word", "n", F.explode(halves).alias("k")).select("k.*", "word", "n"), "word-halves")
    rows = F.least(F.lit(ROWS), F.greatest(F.lit(1), F.floor(F.lit(CELLS) / (F.col("short") + 1))))
    counts = placed.groupBy("short", "half", "affix").agg(F.count("*").alias("all")).where("all > 1")
    counts = written(counts.withColumn("blocks", F.ceil(F.col("all") / rows).cast("int")).drop("all"), "tile-sizes")
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    dealt = placed.join(counts, ["short", "half", "affix"]).withColumn("block", block)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    tile = F.concat_ws(":", F.lpad("short", 10, "0"), "half", F.hex("affix"), low, high)
    return dealt.select(tile.alias("tile"), "half", "short", "block", (low == high).alias("own"), "word", "n")


def matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points aligned left and right, padded with zeros, and lengths."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(words)), size)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    left, right = np.zeros((len(words), width), np.uint32), np.zeros((len(words), width), np.uint32)
    left[row, column] = flat
    right[row, np.repeat(size, size) - 1 - column] = flat
    return left, right, size


def _tile_pairs(tile: np.ndarray, half: np.ndarray, short: np.ndarray, block: np.ndarray, own: np.ndarray, words: list[str]):
    """Indices of near pairs; rows of a tile stand side by side. Each step compares two shifted blocks of rows."""
    left, right, size = matrices(words, int(short.max()) + 1)
    found_a, found_b = [], []
    at, step = np.arange(len(words) - 1), 1
    while len(at := at[at < len(words) - step]) and len(at := at[tile[at + step] == tile[at]]):
        a, b = at, at + step
        # pairs of two longer words meet in another tile, and those of one block in its own tile
        ok = (size[a] + size[b] <= 2 * short[a] + 1) & (own[a] | (block[a] != block[b]))
        a, b = a[ok], b[ok]
        if len(a):
            prefix = (left[a] != left[b]).argmax(axis=1)
            suffix = (right[a] != right[b]).argmax(axis=1)
            near = prefix + suffix >= np.maximum(size[a], size[b]) - 1
            near &= (half[a] == 1) | (prefix < short[a] // 2)
            found_a.append(a[near])
            found_b.append(b[near])
        step += 1
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def _near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(word, other, n): both directions of every near pair; n is the other's."""
    for frame in whole_groups(frames, "tile"):
        tile = pd.factorize(frame["tile"])[0]
        cells = np.cumsum(frame["short"].to_numpy() + 1)
        begin = 0
        edges = np.flatnonzero(np.concatenate([tile[1:] != tile[:-1], [True]])) + 1
        for end, after in zip(edges.tolist(), [*edges[1:].tolist(), None], strict=True):
            held = cells[(after or end) - 1] - (cells[begin - 1] if begin else 0)
            if after is not None and held <= 4 * CELLS:
                continue
            part, begin = frame.iloc[begin:end], end
            words, n = part["word"].tolist(), part["n"].to_numpy()
            a, b = _tile_pairs(
                tile[end - len(part) : end], *(part[c].to_numpy() for c in ("half", "short", "block", "own")), words
            )
            if len(a):
                name = part["word"].to_numpy()
                yield pd.DataFrame({
                    "word": np.concatenate([name[a], name[b]]), "other": np.concatenate([name[b], name[a]]),
                    "n": np.concatenate([n[b], n[a]]),
                })


def near_words(words: DataFrame, shortest: int = LEAST_LENGTH) -> DataFrame:
    """(word, other, n): every word with each of its near words and that one's count."""
    dealt = tiles(words, shortest).repartition("tile").sortWithinPartitions("tile")
    return dealt.mapInPandas(_near, "word string, other string, n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of ``forms(word, form)`` from each word, by pointer doubling."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(MAX_ROUNDS):
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        moved = written(now.join(ahead, "root", "left"), "roots")
        if moved.where("ahead is not null").isEmpty():
            return now
        now = moved.select("word", F.coalesce("ahead", "root").alias("root"))
    raise RuntimeError(f"chains of forms did not end in {MAX_ROUNDS} rounds")


def variants(
    docs: DataFrame, every: int = DELETE_EVERY, shortest: int = LEAST_LENGTH, least: int = LEAST_COUNT, ratio: int = RATIO
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the corpus."""
    words = written(vocabulary(docs, every, shortest, least), "words")
    best = near_words(words, shortest).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("n"), "other")).alias("best")
    )
    best = written(best.select("word", "n_near", (-F.col("best.n")).alias("near_n"), F.col("best.other").alias("other")), "near-words")
    much = F.col("near_n") >= ratio * F.col("n")
    joined = written(words.join(best, "word", "left").select(
        "word", F.when(much, F.col("other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(much, F.col("near_n")).alias("form_n"),
    ), "forms")
    found = roots(joined.where("form is not null"))
    return joined.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
