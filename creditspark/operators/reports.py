"""A1–A15, W2, L1, L2 — portfolio summaries.

Every summary is a hash aggregate (partial on the map side, final after a
shuffle of at most one row per group per task), so a stage that holds a third
of the book is no hotter than any other. Shares (W2) are windows over the
already-aggregated table of a handful of rows, never over loans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import require_columns
from .ordered import SKETCH_MARGIN, checkpointed, column_states, exact_quantiles, merged_states, number

# ---- fixed values: KPI labels ----
KPI_LABELS = ("Number of loans", "Portfolio EAD", "Portfolio 12m ECL", "Portfolio Lifetime ECL",
              "12m Default Rate")


def sort_small(df: DataFrame, *cols: str) -> DataFrame:
    """Order a summary with a bounded number of groups (stages, vintages, grades).

    One partition and a local sort: no range-partition sampling job and no extra
    exchange, which a global ``orderBy`` would add for a handful of rows.
    """
    return df.coalesce(1).sortWithinPartitions(*cols)


def _sum0(c: str) -> F.Column:
    """pandas ``sum`` of an all-NULL column is 0."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def portfolio_kpis(df: DataFrame) -> DataFrame:
    """A1 — named KPI vector as ``kpi, value`` rows (one global aggregate, then unpivot)."""
    require_columns(df, "ead", "ecl_12m", "ecl_lifetime", "default_12m")
    one = df.agg(
        F.count(F.lit(1)).cast("double").alias(KPI_LABELS[0]),
        _sum0("ead").alias(KPI_LABELS[1]),
        _sum0("ecl_12m").alias(KPI_LABELS[2]),
        _sum0("ecl_lifetime").alias(KPI_LABELS[3]),
        F.avg(F.col("default_12m").cast("double")).alias(KPI_LABELS[4]),
    )
    return one.unpivot([], list(KPI_LABELS), "kpi", "value")


def vintage_stats(df: DataFrame) -> DataFrame:
    """A2 — mean PD, default rate, mean 12m ECL and booking unemployment per vintage."""
    require_columns(df, "vintage_index", "pd_12m", "default_12m", "ecl_12m", "booking_unemp")
    return (df.where(F.col("vintage_index").isNotNull()).groupBy("vintage_index").agg(
        F.avg("pd_12m").alias("avg_pd"),
        F.avg(F.col("default_12m").cast("double")).alias("default_rate"),
        F.avg("ecl_12m").alias("ecl_12m"),
        F.avg("booking_unemp").alias("booking_unemp"),
    ).transform(sort_small, "vintage_index"))


def stage_mix(df: DataFrame, stage_col: str = "stage", out_col: str | None = None) -> DataFrame:
    """A3/W2 — share of loans per stage; NULL stages excluded from the denominator."""
    require_columns(df, stage_col)
    counts = df.where(F.col(stage_col).isNotNull()).groupBy(stage_col).agg(F.count(F.lit(1)).alias("loans"))
    share = F.col("loans") / F.sum("loans").over(Window.partitionBy(F.lit(1)))
    return sort_small(counts.select(F.col(stage_col).alias(out_col or stage_col), "loans",
                                    share.alias("share")), out_col or stage_col)


def stage_mix_migration(df: DataFrame, base_col: str = "stage_ifrs9",
                        stressed_col: str = "stage_ifrs9_stressed") -> DataFrame:
    """A3 for two stagings of one book: ``scenario, stage_ifrs9, loans, share``.

    One aggregate by (base, stressed) stage, at most 16 rows, which are then unfolded;
    the loans themselves are not.
    """
    require_columns(df, base_col, stressed_col)
    moved = df.groupBy(base_col, stressed_col).agg(F.count(F.lit(1)).alias("n"))
    sides = F.array(*[F.struct(F.lit(name).alias("scenario"), F.col(c).alias("stage_ifrs9"))
                      for name, c in (("base", base_col), ("stressed", stressed_col))])
    long = moved.select("n", F.inline(sides)).where(F.col("stage_ifrs9").isNotNull())
    counts = long.groupBy("scenario", "stage_ifrs9").agg(F.sum("n").alias("loans"))
    share = F.col("loans") / F.sum("loans").over(Window.partitionBy("scenario"))
    return sort_small(counts.withColumn("share", share), "scenario", "stage_ifrs9")


def stage3_rate(df: DataFrame, stage_col: str = "stage_ifrs9") -> DataFrame:
    """A4 — share of all loans in stage 3; a loan without a stage is not in stage 3."""
    in_3 = F.coalesce(F.col(stage_col) == 3, F.lit(False))
    return df.agg(F.avg(in_3.cast("double")).alias("stage3_rate"))


def stage_ecl(df: DataFrame, stage_col: str = "stage_ifrs9") -> DataFrame:
    """A5 + A6 — per stage: loans, Σead, mean pd, mean lgd, Σ12m/lifetime ECL, reported allowance."""
    require_columns(df, stage_col, "loan_id", "ead", "pd_12m", "lgd", "ecl_12m", "ecl_lifetime")
    agg = df.where(F.col(stage_col).isNotNull()).groupBy(stage_col).agg(
        F.count("loan_id").alias("loans"),
        _sum0("ead").alias("ead"),
        F.avg("pd_12m").alias("avg_pd"),
        F.avg("lgd").alias("avg_lgd"),
        _sum0("ecl_12m").alias("ecl_12m"),
        _sum0("ecl_lifetime").alias("ecl_lifetime"),
    )
    allowance = F.when(F.col(stage_col) == 1, F.col("ecl_12m")).otherwise(F.col("ecl_lifetime"))
    return sort_small(agg.withColumn("reported_loss_allowance", allowance), stage_col)


def stage_ecl_stressed(df: DataFrame, stage_col: str = "stage_ifrs9_stressed") -> DataFrame:
    """A8 — stressed table: Σead, Σstressed 12m ECL, Σ(base) lifetime ECL, stressed allowance."""
    require_columns(df, stage_col, "ead", "ecl_12m_stressed", "ecl_lifetime")
    agg = df.where(F.col(stage_col).isNotNull()).groupBy(stage_col).agg(
        _sum0("ead").alias("ead"),
        _sum0("ecl_12m_stressed").alias("ecl_12m_stressed"),
        _sum0("ecl_lifetime").alias("ecl_lifetime"),
    )
    allowance = F.when(F.col(stage_col) == 1, F.col("ecl_12m_stressed")).otherwise(F.col("ecl_lifetime"))
    return sort_small(agg.withColumn("reported_loss_allowance_stressed", allowance)
                      .withColumnRenamed(stage_col, "stage_ifrs9"), "stage_ifrs9")


def total_allowance(df: DataFrame, stage_col: str = "stage_ifrs9", stressed_stage_col: str | None = None) -> DataFrame:
    """A7 (+A10) — total loss allowance straight from loans (Σ over stages of the A6 rule).

    With ``stressed_stage_col`` also the stressed allowance and the increase in %.
    The allowance picks 12m or lifetime ECL per loan by its stage, which equals
    summing the per-stage table, in one aggregate.
    """
    base = F.when(F.col(stage_col) == 1, F.col("ecl_12m")).otherwise(F.col("ecl_lifetime"))
    aggs = [F.coalesce(F.sum(F.when(F.col(stage_col).isNotNull(), base)), F.lit(0.0))
            .alias("total_loss_allowance")]
    if stressed_stage_col:
        st = F.when(F.col(stressed_stage_col) == 1, F.col("ecl_12m_stressed")).otherwise(F.col("ecl_lifetime"))
        aggs.append(F.coalesce(F.sum(F.when(F.col(stressed_stage_col).isNotNull(), st)), F.lit(0.0))
                    .alias("stressed_loss_allowance"))
    out = df.agg(*aggs)
    if stressed_stage_col:
        out = out.withColumn("allowance_increase_pct",
                             (F.try_divide(F.col("stressed_loss_allowance"), F.col("total_loss_allowance"))
                              - F.lit(1.0)) * F.lit(100.0))
    return out


def stress_totals(df: DataFrame) -> DataFrame:
    """A9 — base and stressed total 12m ECL and the uplift."""
    require_columns(df, "ecl_12m", "ecl_12m_stressed")
    out = df.agg(_sum0("ecl_12m").alias("base_ecl"), _sum0("ecl_12m_stressed").alias("stressed_ecl"))
    return out.withColumn("uplift", F.col("stressed_ecl") - F.col("base_ecl"))


def scenario_totals(df: DataFrame, names) -> DataFrame:
    """A9 per scenario from one aggregate: ``scenario, base_ecl, stressed_ecl, uplift``."""
    names = list(names)
    one = df.agg(_sum0("ecl_12m").alias("base_ecl"), *[_sum0(f"ecl_12m_{n}").alias(n) for n in names])
    rows = F.inline(F.array(*[F.struct(F.lit(n).alias("scenario"), F.col(n).alias("stressed_ecl")) for n in names]))
    return one.select("base_ecl", rows).select("scenario", "base_ecl", "stressed_ecl",
                                               (F.col("stressed_ecl") - F.col("base_ecl")).alias("uplift"))


def describe(df: DataFrame, cols: list[str], *, probs=(0.25, 0.5, 0.75), approx_accuracy: int | None = None,
             buckets: int | None = None, by: str | None = "booking_year", states: DataFrame | None = None) -> DataFrame:
    """A11 — count, mean, std (n−1), min, quartiles (linear), max per column; NULL/NaN ignored.

    Output rows: ``variable, count, mean, std, min, p25, p50, p75, max``. The first
    pass makes mergeable states (``ordered.column_states``: moments and a KLL sketch for each
    booking year); merged, they give the moments and bracket the quartiles, which a second pass makes
    exact. With kept ``states`` only the second pass runs. ``approx_accuracy`` asks for
    ``percentile_approx`` in place of that: one pass and no exact quartiles.
    """
    names = [f"p{int(round(p * 100))}" for p in probs]
    if states is None:
        states = checkpointed(column_states(df, cols, by if by in df.columns else None))
    shares = {c: [p + s * SKETCH_MARGIN for p in probs for s in (-1, 1)] for c in cols}
    state = merged_states(states, cols, shares)
    counts = {c: state[c]["n"] for c in cols}
    if approx_accuracy:
        row = df.agg(*[F.percentile_approx(number(c), list(probs), approx_accuracy).alias(c) for c in cols]).first()
        quantiles = {c: row[c] for c in cols}
    else:
        # a bracket that reaches the end takes it in: sketches keep the least and the largest value
        near = {c: state[c]["at"] for c in cols if counts[c]}
        quantiles = exact_quantiles(df, cols, probs, counts=counts, buckets=buckets, near=near)
    out = [(c, float(counts[c]), state[c]["mean"], state[c]["std"], state[c]["min"], *quantiles[c], state[c]["max"])
           for c in cols if counts[c]]
    return df.sparkSession.createDataFrame(
        out, "variable string, count double, mean double, std double, min double, "
             + ", ".join(f"{n} double" for n in names) + ", max double")


def shape(df: DataFrame) -> DataFrame:
    """A15 — rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def head(df: DataFrame, n: int = 5, order_col: str = "loan_id") -> DataFrame:
    """L2 — first ``n`` rows by key (planned as a top-k, not a full sort)."""
    return df.orderBy(order_col).limit(n)
