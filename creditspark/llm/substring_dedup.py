"""Operator 1: substring dedup by a Relative Lempel-Ziv parse against all smaller documents.

Every document is part of the reference and is parsed against it. The reference is indexed in blocks
whose limits follow from the words themselves: each window of ``K`` words is anchored at its least
``GRAM``-word hash, and a block is a run of consecutive windows with one anchor. Equal windows have
equal anchors wherever they stand, so equal text is cut into equal blocks.

The parse is greedy: a block that occurs whole in a smaller document is copied whole, and neighbouring
copied blocks join into one long factor. Where a factor begins, ends or holds an edit, its outermost
blocks share their anchor with the reference but are not equal to a block of it; these boundary blocks
are checked window by window. Only one document for each distinct block takes part in that (the least;
all others are covered already). A factor has at least ``K`` words, being made of whole windows.

Blocks are about one row for every 20 words; they are grouped by hash with partial aggregation, so a
passage that stands in a third of all documents costs one row for each task. The hashes of blocks and
windows have 128 bits. Texts are shuffled by doc_id, for the boundary check and for the removal.

Defined results: null or empty text: no words, kept text empty. Null doc_id: neither removes nor loses
words. Rows with one doc_id are one document's versions: they do not remove from each other.
Empty table: no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import text_key, written
from .text import BASES, U, Words, byte_chunks, mix, signed, span_hash

K, GRAM = 50, 10
_AT = 26  # bits for a word's position within a chunk
BLOCKS = "anchor long, block long, doc_id long, version long, start int, n int"
WINDOWS = "w1 long, w2 long, doc_id long, version long, start int"


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    done = 1
    while 2 * done <= width:
        x, done = np.minimum(x[:-done], x[done:]), 2 * done
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def _cut(texts: list[bytes], k: int, gram: int):
    """Blocks of a chunk: text number, first window, number of windows, anchor hash, block hash."""
    w = Words(texts)
    if len(w.start) < k:
        return None
    h = w.hashes()
    at = np.arange(len(h) - gram + 1)
    grams = span_hash(h, at, at + gram, BASES[0])
    low = U((1 << _AT) - 1)
    least = sliding_min(grams & ~low | at.astype(U), k - gram + 1)
    window = np.flatnonzero(w.text_of[: len(h) - k + 1] == w.text_of[k - 1 :])
    if not len(window):
        return None
    anchor = (least[window] & low).astype(np.int64)
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)])
    first = np.flatnonzero(new)
    start, n = window[first], np.diff(np.append(first, len(window)))
    text = w.text_of[start]
    return text, start - w.first[text], n, mix(grams[anchor[first]]), span_hash(h, start, start + n + (k - 1), BASES[1])


def _blocks(frames: Iterator[pd.DataFrame], k: int, gram: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        ids = frame["doc_id"].to_numpy()
        for i, j, raw in byte_chunks(frame["text"]):
            got = _cut(raw, k, gram)
            if got is None:
                continue
            text, start, n, anchor, block = got
            version = np.array([zlib.crc32(t) for t in raw], np.int64)
            yield pd.DataFrame({
                "anchor": signed(anchor), "block": signed(block), "doc_id": ids[i:j][text],
                "version": version[text], "start": start.astype(np.int32), "n": n.astype(np.int32),
            })


def _windows(frames: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """The hashes of all windows in the listed blocks of each document."""
    for frame in frames:
        ids, version = frame["doc_id"].to_numpy(), frame["version"].to_numpy()
        for i, j, raw in byte_chunks(frame["text"]):
            w = Words(raw)
            h = w.hashes()
            starts = [x for x in frame["starts"].iloc[i:j]]
            sizes = [x for x in frame["sizes"].iloc[i:j]]
            text = np.repeat(np.arange(j - i), [len(x) for x in starts])
            start, n = np.concatenate(starts).astype(np.int64), np.concatenate(sizes).astype(np.int64)
            one = np.repeat(np.arange(len(n)), n)
            local = start[one] + np.arange(len(one)) - np.repeat(np.cumsum(n) - n, n)
            at = local + w.first[text[one]]
            yield pd.DataFrame({
                "w1": signed(span_hash(h, at, at + k, BASES[0])), "w2": signed(span_hash(h, at, at + k, BASES[1])),
                "doc_id": ids[i:j][text[one]], "version": version[i:j][text[one]], "start": local.astype(np.int32),
            })


def repeated_spans(docs: DataFrame, k: int = K, gram: int = GRAM) -> DataFrame:
    """(doc_id, version, start, n): runs of n windows of k words, from word ``start``, that a document
    with a smaller doc_id holds too. ``version`` is the crc32 of the text."""
    texts = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    blocks = written(texts.mapInPandas(lambda frames: _blocks(frames, k, gram), BLOCKS), "blocks")
    index = blocks.groupBy("anchor", "block").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    index = written(index, "block-index")
    edges = index.groupBy("anchor").agg(
        F.count("*").alias("blocks"), F.min("least").alias("least_any"), F.max("most").alias("most_any")
    ).where("blocks > 1 and least_any < most_any").select("anchor", F.lit(True).alias("boundary"))
    # blocks that matter: those of more than one document, and those whose anchor has several blocks
    known = index.join(edges, "anchor", "left").where("least < most or boundary").drop("most")
    found = written(blocks.join(known, ["anchor", "block"]), "found-blocks")
    copied = found.where("least < doc_id").select("doc_id", "version", "start", "n")
    unsure = found.where("least = doc_id and boundary").groupBy("doc_id", "version").agg(
        F.collect_list(F.struct("start", "n")).alias("at")
    ).select("doc_id", "version", F.col("at.start").alias("starts"), F.col("at.n").alias("sizes"))
    checked = _with_version(docs).join(unsure, ["doc_id", "version"])
    checked = checked.select("doc_id", "version", "text", "starts", "sizes")
    windows = written(checked.mapInPandas(lambda frames: _windows(frames, k), WINDOWS), "boundary-windows")
    first = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    first = first.where("least < most").drop("most")
    edge = windows.join(first, ["w1", "w2"]).where("least < doc_id")
    return copied.unionByName(edge.select("doc_id", "version", "start", F.lit(1).alias("n")))


def _with_version(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), text_key().alias("version"), "text")


def _without(frames: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for text, starts, sizes in zip(frame["text"], frame["starts"], frame["sizes"], strict=True):
            words, removed = text.encode().split() if isinstance(text, str) else [], 0
            n = len(words)
            if starts is not None and len(starts):
                step = np.zeros(n + 1, np.int64)
                np.add.at(step, starts, 1)
                np.add.at(step, np.asarray(starts) + np.asarray(sizes) + (k - 1), -1)
                keep = np.cumsum(step[:-1]) == 0
                removed = n - int(keep.sum())
                words = [words[i] for i in np.flatnonzero(keep).tolist()]
            out.append((n, removed, b" ".join(words).decode()))
        got = pd.DataFrame(out, columns=["n_words", "n_removed", "kept_text"])
        yield got.assign(doc_id=frame["doc_id"].astype("Int64").to_numpy())[["doc_id", "n_words", "n_removed", "kept_text"]]


def remove_repeats(docs: DataFrame, k: int = K, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) for each row of ``docs(doc_id, text)``.

    A word goes if a window of k words that covers it stands in a document with a smaller doc_id too;
    kept words are joined by one space.
    """
    spans = repeated_spans(docs, k, gram).groupBy("doc_id", "version").agg(
        F.collect_set(F.struct("start", "n")).alias("at")
    ).select("doc_id", "version", F.col("at.start").alias("starts"), F.col("at.n").alias("sizes"))
    marked = _with_version(docs).join(spans, ["doc_id", "version"], "left").select("doc_id", "text", "starts", "sizes")
    return marked.mapInPandas(
        lambda frames: _without(frames, k), "doc_id long, n_words long, n_removed long, kept_text string"
    )
