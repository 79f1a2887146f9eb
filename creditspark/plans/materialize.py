"""Write the scored loan book once, then report from the written tables.

At scale the shuffle join of orders to customers should run once per reporting
date. ``write_book`` runs it once, into a narrow table, and scores from that:

* ``tape``: every loan with its borrower attributes (the only join of the book);
* ``part_a``: PIT PD, default, LGD, EAD, 12m / lifetime ECL, PD-band stage;
* ``part_bc``: origination / current PD, flags, SICR stage, ECL, multiplicative
  stress and re-staging, standardised and IRB capital;

as Parquet under a shared path, partitioned by reporting date and booking year.
Rows are rebalanced by booking year before they are written, so a year is a few
files of a good size (Spark splits large years). A reporting date that is written
again replaces its own partitions and no others; a lost executor re-reads files
instead of re-running the join. ``read_book`` returns the two scored tables;
every summary in ``operators.reports`` / ``capital`` runs on them as a scan plus
a partial→final aggregate, and filters on year or date prune whole directories.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import capital, states
from .book import Book

#: States, and loans as of a date, beside the book's tables.
STATES, SNAPSHOTS = "states", "snapshots"


def _join(path: str, name: str) -> str:
    return path.rstrip("/") + "/" + name if "://" in path else os.path.join(path, name)


def _write(df: DataFrame, path: str, reporting_date: str) -> None:
    out = df.withColumn("reporting_date", F.lit(reporting_date)).hint("rebalance", "booking_year")
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("reporting_date", "booking_year").parquet(path))


def _read(spark: SparkSession, path: str, reporting_date: str | None) -> DataFrame:
    out = spark.read.parquet(path)
    out = out.withColumn("reporting_date", F.col("reporting_date").cast("string"))
    return out if reporting_date is None else out.where(F.col("reporting_date") == reporting_date)


def write_book(book: Book, path: str, reporting_date: str) -> dict[str, str]:
    """Score the book and write its tables; returns their paths.

    ``reporting_date`` is an ISO date; it names the partition that is replaced.
    """
    out = {name: _join(path, name) for name in ("tape", "part_a", "part_bc")}
    _write(book.tape, out["tape"], reporting_date)
    tape = _read(book.spark, out["tape"], reporting_date).select(*book.tape.columns)
    stored = Book(book.spark, book.sf_dir, book.calendar, tape)
    part_a = stored.part_a().drop("default_draw", "ead_factor")
    part_bc = capital.basel_standardised(capital.basel_irb(stored.part_b_stressed()))
    part_bc = part_bc.drop("default_draw", "ead_factor", "pd_mult", "life_mult")
    _write(part_a, out["part_a"], reporting_date)
    _write(part_bc, out["part_bc"], reporting_date)
    return out


def read_book(spark: SparkSession, path: str, reporting_date: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The written ``part_a`` and ``part_bc`` tables, of one reporting date or of all."""
    return tuple(_read(spark, _join(path, name), reporting_date) for name in ("part_a", "part_bc"))


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _partition_files(part_bc: DataFrame) -> DataFrame:
    """(reporting_date, booking_year, files): a checksum of each partition's files; reads no data column."""
    names = part_bc.select("reporting_date", "booking_year", F.xxhash64(
        "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").alias("file")).distinct()
    return names.groupBy("reporting_date", "booking_year").agg(F.sum(F.col("file").cast("decimal(38,0)")).alias("files"))


def refresh_states(spark: SparkSession, path: str) -> list[tuple[str, int | None]]:
    """Bring the states below ``path`` up to date; returns the (reporting date, booking year) that were made anew.

    A partition of the book whose files are those that its states were made from is not read.
    """
    part_bc, target = _read(spark, _join(path, "part_bc"), None), _join(path, STATES)
    now = _partition_files(part_bc)
    stale = now
    if _exists(spark, target):
        old = _read(spark, target, None).select("reporting_date", F.col("booking_year"), F.col("files").alias("made_from")).distinct()
        same = (now["reporting_date"] == old["reporting_date"]) & now["booking_year"].eqNullSafe(old["booking_year"])
        stale = now.join(old, same & (now["files"] == old["made_from"]), "left_anti")
    todo = [(r["reporting_date"], r["booking_year"], r["files"]) for r in stale.collect()]  # a row a date and year at most
    if todo:
        chosen = F.lit(False)
        for date, year, _ in todo:
            chosen = chosen | ((F.col("reporting_date") == date) & F.col("booking_year").eqNullSafe(F.lit(year)))
        made = states.ecl_states(part_bc.where(chosen))
        marks = spark.createDataFrame(todo, "d string, y int, files decimal(38,0)")
        made = made.join(F.broadcast(marks), (F.col("reporting_date") == F.col("d")) & F.col("booking_year").eqNullSafe(F.col("y")))
        (made.drop("d", "y").coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("reporting_date", "booking_year").parquet(target))
    return sorted(((d, y) for d, y, _ in todo), key=str)


def read_states(spark: SparkSession, path: str, reporting_date: str | None = None) -> DataFrame:
    return _read(spark, _join(path, STATES), reporting_date)


def write_snapshot(loans: DataFrame, path: str, reporting_date: str) -> None:
    """Loans as of a date: ``loan_id, stage, allowance``, replacing that date's partition only."""
    out = loans.select("loan_id", F.col("stage").cast("int").alias("stage"), F.col("allowance").cast("double").alias("allowance"))
    out = out.withColumn("reporting_date", F.lit(reporting_date)).hint("rebalance")
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("reporting_date").parquet(_join(path, SNAPSHOTS)))


def read_migration(spark: SparkSession, path: str, earlier: str, later: str) -> DataFrame:
    """``states.migration`` between two written dates; only their partitions are read."""
    table = _join(path, SNAPSHOTS)
    return states.migration(_read(spark, table, earlier), _read(spark, table, later))


def read_vintages(spark: SparkSession, path: str, reporting_date: str, selected: DataFrame) -> DataFrame:
    """Part A of the vintages in ``selected(booking_year)``, whose other partitions are pruned as the query runs.

    ``selected`` has at most one row a calendar year, so it is broadcast.
    """
    part_a, _ = read_book(spark, path, reporting_date)
    return part_a.join(F.broadcast(selected.select("booking_year").distinct()), "booking_year")
