"""The folder all machines share, and tables written there to cut lineage.

Nothing is kept in executor-local storage: every intermediate result that is read more than once
is a Parquet table below ``spark.checkpoint.dir`` (set by the cluster; a local folder is chosen only
where it is unset and the master is local), so a lost executor costs a re-read, not a recomputation.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Spark removes a query's shuffle files as soon as the query ends, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; on a local master without one, a fresh folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    made = "file://" + tempfile.mkdtemp(prefix="creditspark-llm-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the application's own folder, which may go once its results are read."""
    return f"{shared_dir(spark)}/creditspark-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it as read from there; its shuffle files are gone then."""
    spark = df.sparkSession
    path, before = fresh_path(spark, name), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: str = "text"):
    """Tells apart rows of one doc_id that hold different texts (repeated ids)."""
    return F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))


