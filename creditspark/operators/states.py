"""A5–A10, A3/T4 — mergeable states of the scored book, reports from them, and migration between dates.

A state is one row for each reporting date, booking year, base stage and stressed
stage: sums and counts that every stage and allowance report is made of, and a checksum
of the loans behind it. The table has a few hundred rows however large the book is. States merge
by addition, so a report over any years or dates reads the states only, and a change
of one partition of the book replaces that partition's states alone (``plans.materialize.refresh_states``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import require_columns
from .reports import sort_small

KEYS = ("reporting_date", "booking_year", "stage_ifrs9", "stage_ifrs9_stressed")
SUMS = ("ead", "ecl_12m", "ecl_lifetime", "ecl_12m_stressed")
MEANS = ("pd_12m", "lgd")
# states of a loan's migration besides its stages
NEW, CLOSED = "new", "closed"


def ecl_states(df: DataFrame, keys=KEYS) -> DataFrame:
    """One row for each combination of ``keys``: loans, sums, sums and counts of means, and the loans' checksum."""
    require_columns(df, "loan_id", *keys, *SUMS, *MEANS)
    loan = F.xxhash64("loan_id", *(c for c in keys), *SUMS)
    return df.groupBy(*keys).agg(
        F.count("loan_id").alias("loans"),
        *(F.sum(c).alias(c) for c in SUMS),
        *(F.sum(c).alias(f"{c}_sum") for c in MEANS), *(F.count(c).alias(f"{c}_n") for c in MEANS),
        F.sum(loan.cast("decimal(38,0)")).alias("checksum"),
    )


def _total(c: str) -> F.Column:
    return F.coalesce(F.sum(c), F.lit(0.0))


def stage_ecl_of(states: DataFrame, stage_col: str = "stage_ifrs9") -> DataFrame:
    """A5 + A6 — ``reports.stage_ecl`` from states."""
    mean = lambda c: F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}_n"))
    out = states.where(F.col(stage_col).isNotNull()).groupBy(stage_col).agg(
        F.sum("loans").alias("loans"), _total("ead").alias("ead"), mean("pd_12m").alias("avg_pd"), mean("lgd").alias("avg_lgd"),
        _total("ecl_12m").alias("ecl_12m"), _total("ecl_lifetime").alias("ecl_lifetime"))
    allowance = F.when(F.col(stage_col) == 1, F.col("ecl_12m")).otherwise(F.col("ecl_lifetime"))
    return sort_small(out.withColumn("reported_loss_allowance", allowance), stage_col)


def allowance_of(states: DataFrame) -> DataFrame:
    """A7, A10 — base and stressed allowance and the increase in percent, from states."""
    base = F.when(F.col("stage_ifrs9") == 1, F.col("ecl_12m")).otherwise(F.col("ecl_lifetime"))
    stressed = F.when(F.col("stage_ifrs9_stressed") == 1, F.col("ecl_12m_stressed")).otherwise(F.col("ecl_lifetime"))
    one = states.agg(
        F.coalesce(F.sum(F.when(F.col("stage_ifrs9").isNotNull(), base)), F.lit(0.0)).alias("total_loss_allowance"),
        F.coalesce(F.sum(F.when(F.col("stage_ifrs9_stressed").isNotNull(), stressed)), F.lit(0.0)).alias("stressed_loss_allowance"))
    ratio = F.try_divide(F.col("stressed_loss_allowance"), F.col("total_loss_allowance"))
    return one.withColumn("allowance_increase_pct", (ratio - F.lit(1.0)) * F.lit(100.0))


def migration(earlier: DataFrame, later: DataFrame, *, key: str = "loan_id") -> DataFrame:
    """A3/T4 — from each state of the earlier date to each of the later: loans and both allowances.

    ``earlier``, ``later``: ``<key>, stage, allowance``, one row a loan. A loan without an
    earlier row is ``new``, one without a later row ``closed``; a loan without a stage is in state
    ``none``. The sums over a row or column of the matrix are the allowances of the two dates. The full outer join
    deals both dates by loan once; nothing is collected.
    """
    def named(df: DataFrame, suffix: str) -> DataFrame:
        stage = F.coalesce(F.col("stage").cast("string"), F.lit("none"))
        return df.select(key, stage.alias(f"stage_{suffix}"), F.col("allowance").alias(f"allowance_{suffix}"))

    both = named(earlier, "from").join(named(later, "to"), key, "full_outer")
    return both.groupBy(F.coalesce("stage_from", F.lit(NEW)).alias("stage_from"),
                        F.coalesce("stage_to", F.lit(CLOSED)).alias("stage_to")).agg(
        F.count(F.lit(1)).alias("loans"), _total("allowance_from").alias("allowance_from"),
        _total("allowance_to").alias("allowance_to"),
    ).transform(sort_small, "stage_from", "stage_to")
