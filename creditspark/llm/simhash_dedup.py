"""Operator 9: SimHash near-duplicates, searched with BK-trees.

A document's fingerprint has a bit for each position set in over half the XXH64 hashes of its word
shingles. Fingerprints link at ``radius`` or fewer differing bits; a component is what links reach.

Two fingerprints within the radius agree on at least one of radius + 1 blocks of bits, so the distinct
fingerprints are dealt into shards by the value of each block, and each shard is searched with a
BK-tree: children are keyed by their Hamming distance to the parent, and a search follows only edges
within the radius of its own distance. Trees are built where their shard lies; they grow with the
corpus, so they are never broadcast. A shard with more than ``SHARD_LIMIT`` members is dealt anew by
the blocks of its remaining free bits, which again loses no pair; as every step fixes more bits, this
ends. Each shard yields a spanning forest of its links, never all pairs, and the forests are joined by
``connected_components``. Exact copies meet as one fingerprint before any of this.

Defined results: null or empty text: fingerprint 0, linked like any other. Null doc_id: fingerprinted;
its component is the least doc_id reachable, or null. Repeated rows: one result each. Empty table: no
rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .graph import connected_components
from .shared import text_key, written
from .text import U, Words, byte_chunks, signed, simhash

SHINGLE, RADIUS = 3, 3
SHARD_LIMIT = 4096


def shingle_hashes(texts: list[bytes], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of every shingle of each text in turn, and their numbers by text."""
    from xxhash import xxh64_intdigest

    w = Words(texts)
    buf = b" ".join(b" ".join(texts).split())
    size = w.end - w.start
    at = np.cumsum(size + 1) - size - 1
    count = np.where(w.n >= shingle, w.n - shingle + 1, (w.n > 0).astype(np.int64))
    nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    first = np.repeat(w.first[:-1], count) + nth
    last = first + np.repeat(np.minimum(shingle, w.n), count) - 1
    starts, ends = at[first].tolist(), (at[last] + size[last]).tolist()
    h = np.fromiter((xxh64_intdigest(buf[a:b], 42) for a, b in zip(starts, ends, strict=True)), U, len(starts))
    return h, count


def _fingerprints(frames: Iterator[pd.DataFrame], shingle: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        got = [
            simhash(*shingle_hashes([t.lower() for t in raw], shingle))  # of bytes: A-Z only
            for _, _, raw in byte_chunks(frame["text"])
        ]
        if got:
            kept = frame[["doc_id", "version"]].astype("Int64")
            yield kept.assign(fp=signed(np.concatenate(got)))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, version, fp) for each row of ``docs(doc_id, text)``; version is the crc32 of the text."""
    rows = docs.select(F.col("doc_id").cast("long"), text_key().alias("version"), "text")
    return rows.mapInPandas(lambda frames: _fingerprints(frames, shingle), "doc_id long, version long, fp long")


class BKTree:
    """Integers under Hamming distance."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        at = 0
        self.values.append(value)
        self.children.append({})
        new = len(self.values) - 1
        while at != new:
            at = self.children[at].setdefault((value ^ self.values[at]).bit_count(), new)

    def within(self, value: int, radius: int) -> list[int]:
        """Indices of the values at most ``radius`` bits away."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (value ^ self.values[at]).bit_count()
            if d <= radius:
                found.append(at)
            for edge, child in self.children[at].items():
                if d - radius <= edge <= d + radius:
                    todo.append(child)
        return found


def forest(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Spanning edges (by index) of the links among ``values``."""
    tree, root, edges = BKTree(), list(range(len(values))), []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, v in enumerate(values):
        for j in tree.within(v, radius):
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                edges.append((i, j))
        tree.add(v)
    return edges


def whole_groups(frames: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Batches of rows sorted by ``key``, cut so that no key spans two batches."""
    held = []
    for frame in frames:
        if not len(frame):
            continue
        new = frame[key].ne(frame[key].iloc[-1])
        cut = int(np.flatnonzero(new.to_numpy())[-1]) + 1 if new.any() else 0
        if cut or held and held[0][key].iloc[0] != frame[key].iloc[0]:
            yield pd.concat([*held, frame.iloc[:cut]], ignore_index=True)
            held = []
        held.append(frame.iloc[cut:])
    if held:
        yield pd.concat(held, ignore_index=True)


def _links(frames: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    for frame in whole_groups(frames, "shard"):
        key, fp = frame["shard"].to_numpy(), frame["fp"].to_numpy()
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        a, b = [], []
        for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            values = np.unique(fp[i:j]).view(U).tolist()
            for x, y in forest(values, radius):
                a.append(values[x])
                b.append(values[y])
        yield pd.DataFrame({"a": signed(np.array(a, U)), "b": signed(np.array(b, U))})


def block_masks(free: int, blocks: int) -> list[int]:
    """The set bits of ``free`` in ``blocks`` runs of about equal length."""
    bits = [i for i in range(64) if free >> i & 1]
    return [sum(1 << i for i in part.tolist()) for part in np.array_split(np.array(bits, np.int64), blocks)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def shards(fps: DataFrame, radius: int = RADIUS, limit: int = SHARD_LIMIT) -> DataFrame:
    """(shard, fp) such that any two fps of ``fps(fp)`` within the radius share a shard.

    Every turn deals the members of shards beyond the limit anew by the blocks of the bits that their
    shard leaves free, until at most ``limit`` values can differ.
    """
    spark = fps.sparkSession
    fixed, rows, ready = {0: 0}, fps.select("fp"), None
    while True:
        paths = [
            (parent, parent * (radius + 1) + k + 1, mask | block)
            for parent, mask in fixed.items()
            for k, block in enumerate(block_masks(~mask & (2**64 - 1), radius + 1))
        ]
        fixed = {path: mask for _, path, mask in paths}
        if ready is None:  # all start from one path
            long = lambda x, name: F.lit(x).cast("long").alias(name)
            each = F.array(*(F.struct(long(c, "child"), long(_signed(m), "mask")) for _, c, m in paths))
            stepped = rows.select("fp", F.inline(each))
        else:
            steps = spark.createDataFrame([(p, c, _signed(m)) for p, c, m in paths], "path long, child long, mask long")
            stepped = rows.join(F.broadcast(steps), "path")  # at most (radius + 1) ** turns rows
        dealt = stepped.select(
            F.xxhash64("child", F.col("fp").bitwiseAND(F.col("mask"))).alias("shard"), "fp", F.col("child").alias("path")
        )
        sizes = dealt.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > limit)
        hot = written(sizes.select("shard"), "hot-shards")
        free = 64 - min(mask.bit_count() for mask in fixed.values())
        last = 2**free <= limit or free <= radius + 1 or hot.isEmpty()
        now = (dealt if last else dealt.join(hot, "shard", "left_anti")).select("shard", "fp")
        ready = now if ready is None else ready.unionByName(now)
        if last:
            return ready
        rows = written(dealt.join(hot, "shard", "left_semi").select("fp", "path").distinct(), "hot-fingerprints")
        fixed = {r.path: fixed[r.path] for r in rows.select("path").distinct().collect()}  # of those in steps


def fingerprint_groups(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(node, component) of the distinct ``fps(fp)`` that link to another one."""
    members = shards(fps, radius).repartition("shard").sortWithinPartitions("shard")
    return connected_components(members.mapInPandas(lambda frames: _links(frames, radius), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, version, fp, component_id) for each row; component_id is the least doc_id reachable."""
    marked = written(fingerprints(docs, shingle), "fingerprints")
    fps = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    nodes = fingerprint_groups(fps.select("fp"), radius).withColumnRenamed("node", "fp")
    grouped = written(nodes.join(fps, "fp"), "grouped-fingerprints")
    # both are written, so that the adaptive planner can split the joins at a hot component or fingerprint
    least = written(grouped.groupBy("component").agg(F.min("least").alias("group_least")), "least-of-groups")
    labels = grouped.join(least, "component").select("fp", "group_least")
    labels = fps.join(labels, "fp", "left").select("fp", F.coalesce("group_least", "least").alias("component_id"))
    return marked.join(written(labels, "fingerprint-groups"), "fp").select("doc_id", "version", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents with the least doc_id of their group, one row for each; rows without doc_id stay.

    Of rows that share the winning doc_id, one whose text has the least crc32 stays.
    """
    winners = near_duplicates(docs, shingle, radius).where("doc_id = component_id")
    winners = winners.groupBy("doc_id").agg(F.min("version").alias("least"))
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(own, F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("version"))
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("row.text"))
    # versions are compared beside the join, so that texts are dealt by doc_id once, for it and the window
    named = rows.where("doc_id is not null").join(winners, "doc_id").where("version - least = 0")
    kept = named.withColumn("nth", first).where("nth = 1").select("row")
    return kept.unionByName(rows.where("doc_id is null").select("row")).select("row.*")
