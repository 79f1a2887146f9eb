"""Operator 2: token ids as Simple-8b files, in ascending document order.

``write_tokens`` range-partitions the documents by id, tokenises whole texts inside the tasks and
writes segments: rows of a Parquet table, each with the ids of consecutive whole documents in one
self-contained Simple-8b buffer (block offsets, escapes), the documents' ids and counts, and the
number of ids before it in its range. Spark's output commit makes the files whole even if tasks are
retried. ``read_tokens`` decodes them again. No task holds more than one segment of ids.

Defined results: null or empty text: only the end id. Null doc_id: sorts before all others.
Repeated doc_ids: one entry for each row, side by side, ordered by text. No documents: no segments.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import simple8b
from .text import byte_chunks
from .tokens import coder

SEGMENT_IDS = 1 << 18
SEGMENT = (
    "part int, segment long, start_in_part long, n_ids long, "
    "doc_ids array<long>, doc_tokens array<long>, payload binary"
)
TOKENS = "part int, doc_id long, start_in_part long, n_tokens long, ids_crc32 long"


def _segments(frames: Iterator[pd.DataFrame], vocabulary: str, end_id: int) -> Iterator[pd.DataFrame]:
    part, code, end = TaskContext.get().partitionId(), coder(vocabulary), np.uint32(end_id).tobytes()
    number, before, held, docs, size = 0, 0, [], [], 0

    def row() -> pd.DataFrame:
        ids = np.frombuffer(b"".join(held), "<u4")
        return pd.DataFrame({
            "part": [part], "segment": [number], "start_in_part": [before], "n_ids": [len(ids)],
            "doc_ids": [docs], "doc_tokens": [[len(x) // 4 for x in held]], "payload": [simple8b.encode(ids)],
        })

    for frame in frames:
        for i, j, raw in byte_chunks(frame["text"]):
            for doc, ids in zip(frame["doc_id"].iloc[i:j], code.encode_all(raw), strict=True):
                docs.append(None if pd.isna(doc) else int(doc))
                held.append(ids + end)
                size += len(held[-1]) // 4
                if size >= SEGMENT_IDS:
                    yield row()
                    number, before, held, docs, size = number + 1, before + size, [], [], 0
    if held:
        yield row()


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 1) -> None:
    """Write the ids of ``docs(doc_id, text)`` to ``path``; ``end_id`` ends each document."""
    ordered = docs.select(F.col("doc_id").cast("long"), "text")
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInPandas(lambda frames: _segments(frames, vocabulary, end_id), SEGMENT).write.parquet(path)


def _documents(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for row in frame.itertuples(index=False):
            raw = simple8b.decode(row.payload).astype("<u4").tobytes()
            ends = np.cumsum(row.doc_tokens)
            starts = ends - row.doc_tokens
            yield pd.DataFrame({
                "part": row.part, "doc_id": pd.array(row.doc_ids, dtype="Int64"),
                "start_in_part": row.start_in_part + starts, "n_tokens": row.doc_tokens,
                "ids_crc32": [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)],
            })


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The sums before each range come from one row for each range, which is bounded by the number of
    partitions that wrote the files, so they are summed in one small window and broadcast.
    """
    files = spark.read.schema(SEGMENT).parquet(path)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    found = files.select("part", "start_in_part", "doc_ids", "doc_tokens", "payload").mapInPandas(_documents, TOKENS)
    return found.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("part_start") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32"
    )


def _ids(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for row in frame.itertuples(index=False):
            cut = np.split(simple8b.decode(row.payload).astype(np.int64), np.cumsum(row.doc_tokens)[:-1])
            yield pd.DataFrame({"doc_id": pd.array(row.doc_ids, dtype="Int64"), "ids": [x.tolist() for x in cut]})


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files its ids, for training readers."""
    files = spark.read.schema(SEGMENT).parquet(path)
    return files.select("doc_ids", "doc_tokens", "payload").mapInPandas(_ids, "doc_id long, ids array<long>")
