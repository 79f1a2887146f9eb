"""S5 — final loan table sink (CSV with header, Parquet beside it)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import require_columns

# ---- fixed values: exported columns, in order ----
FINAL_COLS = (
    "loan_id", "booking_month", "booking_year", "vintage_index",
    "age", "annual_income", "credit_score", "employment_years",
    "dti_ratio", "utilization_ratio", "num_inquiries_12m",
    "loan_amount", "term_months", "interest_rate",
    "booking_unemp", "booking_gdp_growth", "booking_hpi",
    "pd_12m", "pd_lifetime", "default_12m",
    "lgd", "ead",
    "realized_loss_12m", "ecl_12m", "ecl_lifetime",
    "stage",
)


def final_table(df: DataFrame) -> DataFrame:
    """P17 — fixed-order projection; the month is written as ``yyyy-MM``."""
    require_columns(df, *FINAL_COLS)
    return df.select(*[F.date_format("booking_month", "yyyy-MM").alias(c) if c == "booking_month" else F.col(c)
                       for c in FINAL_COLS])


def write_final_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite",
                      partition_by: str | None = None) -> None:
    """Write the final table; every executor writes its own part files (no driver collect).

    ``partition_by="booking_year"`` lays Parquet out for partition pruning.
    """
    out = final_table(df)
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError("fmt must be 'csv' or 'parquet'")
