"""Operator 13: Merkle manifest of a data set, by time-forward processing.

Every row is a leaf, the SHA-256 of its columns. Leaves of a source stand in order of doc_id; every
``FAN`` consecutive nodes become their hash until one node, the source's subroot, is left. Subroots in
order of source make the root in the same way. A leaf's proof lists the siblings on its way to the root.

Time-forward processing: nodes are labelled so that a parent's label is above its children's. A node's
digest is a message to its parent, kept in a priority queue ordered by label; a node is hashed once all
its messages are at the head of the queue. The queue is external: Spark's shuffle and sort deliver the
messages of ``LEVELS`` levels at a time to the block of nodes that they meet in (at most FAN ** LEVELS
nodes), and a heap orders them inside a block. The sweep is then reversed: from the root down, each node
sends its children what their proofs have in common, and each leaf receives the end of its proof.

A pass shrinks the table by FAN ** LEVELS = 4,096, so three passes serve 10^10 documents. Every pass is a
table in the shared folder. A source that holds a third of all rows is many blocks, and leaves are
numbered by a range sort, not in one window. Texts are read once; only digests are shuffled.

Defined results: null column: ``-``, an empty text is ``0:``. Null doc_id: before the others of its
source, never tampered with. Null source: the first subtree; an empty source is another one. Rows equal
in source and doc_id are ordered by their digest, and rows equal in all five columns stand side by side as
leaves of their own. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written
from .simhash_dedup import whole_groups

FAN, LEVELS = 16, 3
BLOCK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Every so many documents (by crc32 of doc_id) are tampered with when proofs are tried.
TAMPER_EVERY = 5
TOP = "top"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(text: Column | None = None) -> Column:
    """SHA-256 of the fields, each ``-`` or its length in UTF-8 bytes, a colon and its value."""
    def part(name: str) -> Column:
        value = (text if text is not None and name == "text" else F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(part, FIELDS)), 256))


def leaves(docs: DataFrame, every: int = TAMPER_EVERY) -> DataFrame:
    """(tree, doc_id, digest, tampered): one row for each document; the tree's label orders as its source does."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    lowered = leaf_digest(F.translate("text", _UPPER, _LOWER))
    rows = docs.select(*(F.col(c) for c in FIELDS))
    return rows.select(
        F.coalesce(F.concat(F.lit(":"), "source"), F.lit("-")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"), leaf_digest().alias("digest"),
        F.when(chosen & (F.col("text") != F.translate("text", _UPPER, _LOWER)), lowered).alias("tampered"),
    )


def numbered(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with idx, their place (from 0) in their tree in order of ``by``, and n, the tree's size.

    A range sort deals the rows out; each range counts its own trees, and only these counts are summed up.
    The row's place in the file, last in the order, lets rows alike in all else be split as well.
    """
    rows = written(rows.withColumn("place", F.monotonically_increasing_id()), "unordered")
    order = ["tree", *by, "place"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("place").withColumns(
        {"range": F.spark_partition_id(), "seq": F.monotonically_increasing_id()}
    )
    dealt = written(dealt, "ordered")
    runs = dealt.groupBy("tree", "range").agg(F.min("seq").alias("first"), F.count("*").alias("here"))
    tree = Window.partitionBy("tree")
    runs = runs.select(
        "tree", "range", "first", F.sum("here").over(tree).alias("n"),
        (F.sum("here").over(tree.orderBy("range")) - F.col("here")).alias("before"),
    )
    found = dealt.join(written(runs, "runs"), ["tree", "range"])
    return found.withColumn("idx", F.col("before") + F.col("seq") - F.col("first")).drop("range", "seq", "first", "before")


def _levels(n: int) -> int:
    """Levels of hashing in a block of a tree with n nodes."""
    k = 0
    while n > 1 and k < LEVELS:
        n, k = -(-n // FAN), k + 1
    return k


def _label(level: int, i: int) -> int:
    return level << 40 | i


def forward(digests: list[str], levels: int) -> tuple[str, dict[int, list[str]]]:
    """The digest of a block's root, and the digests that each inner node received, by label."""
    received: dict[int, list[str]] = {}
    queue = [(_label(1, i // FAN), i, d) for i, d in enumerate(digests)] if levels else []
    last = digests[0]
    while queue:
        label = queue[0][0]
        came = []
        while queue and queue[0][0] == label:
            came.append(heapq.heappop(queue)[2])
        received[label] = came
        last = sha256("".join(came).encode()).hexdigest()
        level, i = label >> 40, label & (1 << 40) - 1
        if level < levels:
            heapq.heappush(queue, (_label(level + 1, i // FAN), i, last))
    return last, received


def backward(received: dict[int, list[str]], levels: int, suffix: list[str]) -> Iterator[list[str]]:
    """The proof of each of a block's nodes in turn: siblings left and right of each step, from below."""
    queue = [(-_label(levels, 0), suffix)]
    while queue:
        label, above = heapq.heappop(queue)
        level, i = -label >> 40, -label & (1 << 40) - 1
        if not level:
            # labels fall, so the last leaf comes first
            yield above
            continue
        came = received[-label]
        run = "".join(came)
        for k in range(len(came)):
            child = [run[: 64 * k], run[64 * (k + 1) :], *above]
            heapq.heappush(queue, (-_label(level - 1, FAN * i + k), child))


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows of one block side by side, in order of their place."""
    block = F.floor(F.col("idx") / BLOCK)
    named = rows.withColumn("block", F.concat_ws("/", block.cast("string"), "tree"))
    return named.repartition("block").sortWithinPartitions("block", "idx")


def _groups(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in whole_groups(frames, "block"):
        for _, rows in frame.groupby("block", sort=False):
            yield rows


def _up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out = []
    for rows in _groups(frames):
        n = int(rows["n"].iloc[0])
        root, _ = forward([bytes(x).hex() for x in rows["digest"]], _levels(n))
        out.append((rows["tree"].iloc[0], int(rows["idx"].iloc[0]) // BLOCK, bytes.fromhex(root), -(-n // BLOCK)))
    yield pd.DataFrame(out, columns=["tree", "idx", "digest", "n"])


def forward_sweep(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The tables of nodes pass by pass, and (tree, digest, top) of each tree: its root and its last pass."""
    passes, roots = [nodes.select("tree", "idx", "digest", "n")], []
    roots.append(passes[0].where("n = 1").select("tree", "digest", F.lit(0).alias("top")))
    while not passes[-1].where("n > 1").isEmpty():
        k = len(passes) - 1
        up = _blocks(passes[-1].where("n > 1")).mapInPandas(_up, "tree string, idx long, digest binary, n long")
        passes.append(written(up, "tree-nodes"))
        roots.append(passes[-1].where("n = 1").select("tree", "digest", F.lit(k).alias("top")))
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return passes, found


def _received(rows: pd.DataFrame) -> Iterator[tuple[pd.Series, list[str]]]:
    """Each node row of a block with its proof; the block's first row brings the suffix."""
    head, nodes = rows.iloc[0], rows.iloc[1:]
    levels = _levels(int(head["n"]))
    _, received = forward([bytes(x).hex() for x in nodes["digest"]], levels)
    proofs = backward(received, levels, list(head["suffix"]))
    return zip(list(nodes.itertuples(index=False))[::-1], proofs, strict=True)


def _down(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in _groups(frames):
        head = rows.iloc[0]
        got = [(x.tree, x.idx, proof, head["subroot"], head["root"]) for x, proof in _received(rows)]
        yield pd.DataFrame(got, columns=["tree", "idx", "suffix", "subroot", "root"])


def _folded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The proof of every leaf, hashed, and the root that it leads to from the leaf as it is found."""
    for rows in _groups(frames):
        head, out = rows.iloc[0], []
        for x, proof in _received(rows):
            found = bytes(x.digest if x.tampered is None else x.tampered).hex()
            for left, right in zip(proof[::2], proof[1::2], strict=True):
                found = sha256(f"{left}{found}{right}".encode()).hexdigest()
            out.append((
                None if pd.isna(x.doc_id) else int(x.doc_id), bytes(x.digest).hex(), head["subroot"], head["root"],
                sha256("".join(proof).encode()).hexdigest(), found, found == head["root"],
            ))
        got = pd.DataFrame(out, columns=[c.split()[0] for c in MANIFEST.split(", ")])
        got["doc_id"] = got["doc_id"].astype("Int64")
        yield got


MANIFEST = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)
_SUFFIX = "tree string, idx long, suffix array<string>, subroot string, root string"


def reversed_sweep(passes: list[DataFrame], arrived: DataFrame, leaf_rows: DataFrame, last, schema: str) -> DataFrame:
    """Deliver suffixes pass by pass down to ``leaf_rows``, whose blocks ``last`` turns into rows of ``schema``.

    ``arrived``: (tree, suffix, subroot, root, top, n), what the roots of the trees have received.
    """
    columns = ["tree", "idx", "suffix", "subroot", "root"]
    down = None
    for k in range(len(passes) - 1, -1, -1):
        nodes = leaf_rows if k == 0 else passes[k].where("n > 1")
        heads = arrived.where(F.col("top") == k).select("tree", F.lit(0).cast("long").alias("idx"), *columns[2:])
        heads = heads if down is None else heads.unionByName(down)
        # a block's suffix stands before its nodes
        heads = heads.join(passes[k].groupBy("tree").agg(F.max("n").alias("n")), "tree")
        heads = heads.withColumn("idx", F.col("idx") * BLOCK).withColumn("kind", F.lit(0))
        both = heads.unionByName(nodes.withColumn("kind", F.lit(1)), allowMissingColumns=True)
        block = F.concat_ws("/", F.floor(F.col("idx") / BLOCK).cast("string"), "tree")
        both = both.withColumn("block", block).repartition("block").sortWithinPartitions("block", "kind", "idx")
        if k == 0:
            return both.mapInPandas(last, schema)
        down = written(both.mapInPandas(_down, _SUFFIX), "suffixes")
    raise ValueError("no passes")


def manifest(docs: DataFrame, every: int = TAMPER_EVERY) -> DataFrame:
    """For each document its leaf, its source's subroot, the root, and the proof tried on the (tampered) leaf."""
    leaf_rows = written(numbered(leaves(docs, every), ["doc_id", "digest"]), "leaves")
    passes, subroots = forward_sweep(leaf_rows)
    subroots = written(subroots, "subroots")
    upper = subroots.select(
        F.lit(TOP).alias("tree"), F.col("tree").alias("name"), F.lower(F.hex("digest")).alias("subroot"), "digest", "top"
    )
    upper = written(numbered(upper, ["name"]), "upper-leaves")
    upper_passes, root = forward_sweep(upper)
    start = root.select(
        "tree", F.array().cast("array<string>").alias("suffix"), F.lit(None).cast("string").alias("subroot"),
        F.lower(F.hex("digest")).alias("root"), "top",
    )
    suffixes = reversed_sweep(upper_passes, start, upper.drop("name", "subroot", "top"), _down, _SUFFIX)
    arrived = suffixes.drop("tree", "subroot").join(upper.select("idx", "name", "subroot", "top"), "idx")
    arrived = written(arrived.select(F.col("name").alias("tree"), "suffix", "subroot", "root", "top"), "arrived")
    return reversed_sweep(passes, arrived, leaf_rows, _folded, MANIFEST)
