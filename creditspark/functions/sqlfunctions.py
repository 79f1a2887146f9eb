"""SQL-callable versions of the core helpers (Spark SQL temporary functions).

``register_sql_functions(spark)`` defines ``cs_clip``, ``cs_sigmoid``, ``cs_norm_cdf``,
``cs_norm_ppf`` and ``cs_uniform`` with ``CREATE TEMPORARY FUNCTION … RETURN expr``.
These are SQL-bodied functions: Catalyst inlines the body into the calling plan, so
they run as native expressions (no Python worker), exactly like the DataFrame helpers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import gaussian as G
from . import sqltext as X


def _ppf_body(p: str) -> str:
    q = f"({p} - {X.num(0.5)})"
    rc = f"({X.num(0.180625)} - {q} * {q})"
    rt = f"sqrt(-ln(CASE WHEN {q} < 0 THEN {p} ELSE {X.num(1.0)} - {p} END))"
    central = f"{q} * {X.horner_low(rc, G.PPND16_A)} / {X.horner_low(rc, G.PPND16_B)}"
    t1, t2 = f"({rt} - {X.num(1.6)})", f"({rt} - {X.num(5.0)})"
    mag = (f"(CASE WHEN {rt} <= {X.num(5.0)} THEN {X.horner_low(t1, G.PPND16_C)} / {X.horner_low(t1, G.PPND16_D)} "
           f"ELSE {X.horner_low(t2, G.PPND16_E)} / {X.horner_low(t2, G.PPND16_F)} END)")
    sign = f"(CASE WHEN {q} < 0 THEN {X.num(-1.0)} ELSE {X.num(1.0)} END)"
    return (f"CASE WHEN {p} IS NULL OR isnan({p}) OR {p} <= 0 OR {p} >= 1 THEN CAST(NULL AS DOUBLE) "
            f"WHEN abs({q}) <= {X.num(0.425)} THEN {central} ELSE {sign} * {mag} END")


def _cdf_body(x: str) -> str:
    a = f"abs({x})"
    e = f"exp(-({a} * {a}) / {X.num(2.0)})"
    near = f"{e} * {X.horner_high(a, G.CDF_NUM)} / {X.horner_high(a, G.CDF_DEN)}"
    cf = f"({a} + {X.num(0.65)})"
    for k in (4.0, 3.0, 2.0, 1.0):
        cf = f"({a} + {X.num(k)} / {cf})"
    far = f"{e} / {cf} / {X.num(G.SQRT_2PI)}"
    lower = (f"(CASE WHEN {a} > {X.num(G.CDF_CUTOFF)} THEN {X.num(0.0)} WHEN {a} < {X.num(G.CDF_SPLIT)} "
             f"THEN {near} ELSE {far} END)")
    return f"CASE WHEN {x} > 0 THEN {X.num(1.0)} - {lower} ELSE {lower} END"


def register_sql_functions(spark: SparkSession) -> list[str]:
    defs = {
        "cs_clip": ("x DOUBLE, lo DOUBLE, hi DOUBLE",
                    "CASE WHEN x IS NULL OR isnan(x) THEN CAST(NULL AS DOUBLE) ELSE least(greatest(x, lo), hi) END"),
        "cs_sigmoid": ("z DOUBLE", X.sigmoid("z", 10.0)),
        "cs_norm_cdf": ("x DOUBLE", _cdf_body("x")),
        "cs_norm_ppf": ("p DOUBLE", _ppf_body("p")),
        "cs_uniform": ("k BIGINT, salt INT",
                       "CAST(CAST(conv(substring(md5(concat(CAST(k AS STRING), ':', CAST(div(salt, 4) AS STRING))), "
                       "1 + 8 * (salt % 4), 8), 16, 10) AS BIGINT) AS DOUBLE) / 4294967296.0D"),
    }
    for name, (params, body) in defs.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS DOUBLE RETURN {body}")
    return list(defs)


#: Columns of the scored book that the table functions read, from the temporary view ``cs_loans``.
LOAN_COLUMNS = ("loan_id", "pd_12m", "pd_ratio", "default_12m", "dpd_30_plus", "dpd_90_plus", "ead", "lgd", "ecl_12m", "ecl_lifetime")


def register_table_functions(spark: SparkSession, part_b: DataFrame, *, pd_ratio: float, abs_pd: float) -> list[str]:
    """SQL table functions over a scored book: staging (T2) and the stage table (A5, A6) with thresholds as arguments.

    ``SELECT * FROM cs_stage(pd_ratio => 2.0D)`` and ``SELECT * FROM cs_stage_ecl()``. Both are
    SQL bodies that Catalyst inlines; ``pd_ratio`` and ``abs_pd`` are the defaults of their thresholds.
    """
    part_b.select(*LOAN_COLUMNS).createOrReplaceTempView("cs_loans")
    params = (f"pd_ratio_from DOUBLE DEFAULT {X.num(pd_ratio)}, abs_pd_from DOUBLE DEFAULT {X.num(abs_pd)}, "
              "backstop_30dpd BOOLEAN DEFAULT true, default_90dpd BOOLEAN DEFAULT true")
    stage = ("CASE WHEN coalesce(default_12m = 1, false) OR default_90dpd AND coalesce(dpd_90_plus = 1, false) THEN 3 "
             "WHEN coalesce(pd_ratio >= pd_ratio_from, false) OR coalesce(pd_12m >= abs_pd_from, false) "
             "OR backstop_30dpd AND coalesce(dpd_30_plus = 1, false) THEN 2 ELSE 1 END")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION cs_stage({params}) RETURNS TABLE (loan_id BIGINT, stage_ifrs9 INT) "
              f"RETURN SELECT loan_id, {stage} FROM cs_loans")
    columns = ("stage_ifrs9 INT, loans BIGINT, ead DOUBLE, avg_pd DOUBLE, avg_lgd DOUBLE, ecl_12m DOUBLE, "
               "ecl_lifetime DOUBLE, reported_loss_allowance DOUBLE")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION cs_stage_ecl({params}) RETURNS TABLE ({columns}) RETURN "
              "SELECT stage, count(loan_id), sum(ead), avg(pd_12m), avg(lgd), sum(ecl_12m), sum(ecl_lifetime), "
              "CASE WHEN stage = 1 THEN sum(ecl_12m) ELSE sum(ecl_lifetime) END "
              f"FROM (SELECT *, {stage} AS stage FROM cs_loans) GROUP BY stage")
    return ["cs_stage", "cs_stage_ecl"]
