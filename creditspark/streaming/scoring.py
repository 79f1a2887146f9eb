"""Structured Streaming: score and stage loans as orders arrive.

The loan-grain operators are stateless projections, so they run unchanged on a
streaming DataFrame: new order files are read incrementally, joined to the
static customer table (stream–static equi-join), scored (origination PD,
current PD, default, DPD flags, SICR stage, EAD, LGD, ECL) and either

* appended to a Parquet table per micro-batch (``foreachBatch``; each batch
  overwrites its own ``batch_id`` partition, so a replayed batch after a
  failure rewrites the same files instead of duplicating them), or
* folded into a running per-stage ECL table (a streaming aggregate whose state
  — three groups — lives in the state store under the checkpoint folder).

Checkpoints go under the session's ``spark.checkpoint.dir`` (shared storage on
a cluster), never a machine-local temp folder.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import risk, staging
from ..session import ensure_checkpoint_dir
from ..sources.loan_tape import CUSTOMER_COLS, ORDER_COLS, BookCalendar, loan_tape, with_draws
from ..sources.tables import read_table


def read_order_stream(spark: SparkSession, orders_dir: str, *, file_glob: str = "orders*.parquet",
                      max_files_per_trigger: int = 64) -> DataFrame:
    """New order files under ``orders_dir`` as a stream (schema taken from the files, not inferred per batch)."""
    schema = spark.read.option("pathGlobFilter", file_glob).parquet(orders_dir).schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(orders_dir)
            .select(*ORDER_COLS))


def score_stream(orders: DataFrame, customer: DataFrame, calendar: BookCalendar, **stage_params) -> DataFrame:
    """Part-B scoring and SICR staging of a stream of orders (stateless)."""
    tape = loan_tape(orders, customer.select(*CUSTOMER_COLS), calendar)
    df = with_draws(tape, "B")
    df = risk.origination_pd(df)
    df = risk.current_pd(df)
    df = risk.simulate_default(df, scale=2.0, cap=0.5)
    df = risk.pd_ratio_and_flags(df)
    df = staging.sicr_stage(df, **stage_params)
    df = risk.ead(df)
    return risk.ecl_multiplier(df)


def running_stage_ecl(scored: DataFrame) -> DataFrame:
    """Running loans, EAD, 12m and lifetime ECL and allowance per stage (stateful, complete mode)."""
    agg = scored.groupBy("stage_ifrs9").agg(
        F.count(F.lit(1)).alias("loans"), F.sum("ead").alias("ead"),
        F.sum("ecl_12m").alias("ecl_12m"), F.sum("ecl_lifetime").alias("ecl_lifetime"))
    return agg.withColumn("reported_loss_allowance",
                          F.when(F.col("stage_ifrs9") == 1, F.col("ecl_12m")).otherwise(F.col("ecl_lifetime")))


def checkpoint_location(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark).replace("file:", ""), "streams", name)


def start_scored_sink(scored: DataFrame, out_path: str, name: str = "scored_loans", *,
                      available_now: bool = True):
    """Append scored loans to Parquet, one idempotent directory per micro-batch."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .parquet(os.path.join(out_path, f"batch_id={batch_id}")))

    w = scored.writeStream.foreachBatch(write_batch).option(
        "checkpointLocation", checkpoint_location(scored.sparkSession, name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def start_running_stage_ecl(scored: DataFrame, query_name: str = "running_stage_ecl", *,
                            sink: str = "memory", available_now: bool = True):
    """Run :func:`running_stage_ecl` into ``sink`` (memory table named ``query_name`` by default)."""
    w = (running_stage_ecl(scored).writeStream.outputMode("complete").format(sink).queryName(query_name)
         .option("checkpointLocation", checkpoint_location(scored.sparkSession, query_name)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def static_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer", CUSTOMER_COLS)
