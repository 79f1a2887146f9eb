"""Named queries over the driver's tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads ``orders`` and ``customer`` (and, for the mapping checks, the
table the spec names) under ``sf_dir``; its work grows with those tables.
Doubles are rounded at the output edge, money to 4 places and ratios to 9, so
results compare across engines despite floating-sum order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import with_norm_cdf, with_norm_ppf
from ..functions.sqlfunctions import register_table_functions
from ..operators import backtest, capital, catalog, reports, risk, staging, states, stress
from ..operators.joins import range_lookup
from ..session import ensure_checkpoint_dir
from ..sources.loan_tape import reconciliation
from ..sources.sinks import final_table
from ..sources.specs import read_mapping_spec
from ..sources.tables import read_table, table_path
from . import materialize
from .book import Book

SPEC_DIR = Path(__file__).resolve().parent.parent / "specs"
MAPPING_SPEC = str(SPEC_DIR / "loan_book_dm.json")
CATALOGUE = str(SPEC_DIR / "loan_model_vars.json")
DESCRIBE_COLS = ["pd_12m_origination", "pd_12m", "pd_ratio", "default_12m", "dpd_30_plus", "dpd_90_plus"]
# alternative SICR thresholds exercised by ``stage_sicr_params``
ALT_SICR = {"pd_ratio_threshold": 2.0, "abs_pd_threshold": 0.3, "backstop_30dpd": True, "default_90dpd": False}

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_BOOKS: dict[tuple, tuple[tuple, Book]] = {}


#: Columns in money; every other double is a ratio, a rate or a score.
MONEY = frozenset((
    "annual_income", "loan_amount", "ead", "ecl_12m", "ecl_lifetime", "ecl_12m_stressed", "realized_loss_12m",
    "reported_loss_allowance", "reported_loss_allowance_stressed", "total_loss_allowance", "stressed_loss_allowance",
    "base_ecl", "stressed_ecl", "uplift", "rwa_standardised", "capital_required_std", "portfolio_rwa",
    "portfolio_capital", "order_value", "allowance_from", "allowance_to", "rwa_irb", "capital_required_irb", "total_rwa_irb", "total_capital_irb",
))
MONEY_PLACES, RATIO_PLACES = 4, 9
RATE_KPI = reports.KPI_LABELS[4]


def places(column: str) -> int:
    return MONEY_PLACES if column in MONEY else RATIO_PLACES


def present(df: DataFrame) -> DataFrame:
    """Round double columns for cross-engine comparison (+0.0 folds −0.0 into 0.0)."""
    def shown(f: T.StructField) -> str:
        if not isinstance(f.dataType, T.DoubleType):
            return f"`{f.name}`"
        text = f"round(`{f.name}`, {places(f.name)})"
        if f.name == "value" and "kpi" in df.columns:  # a column of money, but for one rate
            text = f"CASE WHEN kpi = '{RATE_KPI}' THEN round(value, {RATIO_PLACES}) ELSE round(value, {MONEY_PLACES}) END"
        return f"{text} + 0.0D AS `{f.name}`"

    return df.selectExpr(*map(shown, df.schema.fields))


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """When the folders of orders and customer were last changed: one look at each, however many files they hold."""
    out = []
    for name in ("orders", "customer"):
        path = spark._jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, name))
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        out += [status.getModificationTime(), status.getLen()]
    return tuple(out)


def book(spark: SparkSession, sf_dir: str) -> Book:
    """The folder's book, opened once for as long as the application and the folder's stamp stay the same.

    No query lists the folder's files again. In stores that keep no folder times, files that come later are seen
    after :func:`refresh`.
    """
    k, stamp = (spark.sparkContext.applicationId, sf_dir), _stamp(spark, sf_dir)
    if k not in _BOOKS or _BOOKS[k][0] != stamp:
        _BOOKS[k] = (stamp, Book.open(spark, sf_dir))
    return _BOOKS[k][1]


def refresh(spark: SparkSession, sf_dir: str) -> Book:
    """Open the folder's book anew, with the files and the calendar as they are now."""
    for name in ("orders", "customer"):
        spark.catalog.refreshByPath(table_path(sf_dir, name))
    _BOOKS.pop((spark.sparkContext.applicationId, sf_dir), None)
    return book(spark, sf_dir)


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(book(spark, sf_dir)))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


# ---- sources, macro, joins ---------------------------------------------------------------

@query("loan_tape")
def _loan_tape(b: Book):
    """S1, D1, D3 — the loan tape."""
    return b.tape


@query("loan_tape_bucketed")
def _loan_tape_bucketed(b: Book):
    """S1 — the loan tape from orders and customers kept bucketed by customer: a join without exchange."""
    return b.bucketed().tape(b.calendar)


@query("tape_reconciliation")
def _tape_reconciliation(b: Book):
    """S1 — orders, loans and orders without customer or date, by booking year."""
    return reconciliation(*b.sources())


@query("macro_path")
def _macro_path(b: Book):
    """S2, M1–M4, W1 — macro series over the book's calendar."""
    return b.macro()


@query("macro_at_booking")
def _macro_at_booking(b: Book):
    """J1 — macro values at each loan's booking month."""
    return b.tape_with_macro().select("loan_id", "booking_month", "booking_unemp", "booking_gdp_growth",
                                      "booking_hpi")


@query("vintage_index")
def _vintage_index(b: Book):
    """W3 — years since the book's first booking year."""
    return b.tape.select("loan_id", "booking_year", "vintage_index")


# ---- PD, LGD, EAD, ECL -------------------------------------------------------------------

@query("pit_pd")
def _pit_pd(b: Book):
    """P2–P4, M6, D2 — PIT 12m PD at the last macro month and the default outcome."""
    return b.part_a().select("loan_id", "pd_12m", "default_12m")


@query("origination_pd")
def _origination_pd(b: Book):
    """P5 — PD at origination."""
    return risk.origination_pd(b.tape).select("loan_id", "pd_12m_origination")


@query("current_pd")
def _current_pd(b: Book):
    """P6, D2 — current PD by deterioration factor; default with p = min(2·pd, 0.5)."""
    return b.part_b().select("loan_id", "pd_12m_origination", "pd_12m", "default_12m")


@query("pd_ratio_flags")
def _pd_ratio_flags(b: Book):
    """P7, P8 — zero-safe PD ratio and DPD proxies."""
    return b.part_b().select("loan_id", "pd_ratio", "dpd_30_plus", "dpd_90_plus")


@query("lgd_ead")
def _lgd_ead(b: Book):
    """P9, P10 — LGD from score and booking macro; EAD."""
    return b.part_a().select("loan_id", "lgd", "ead")


@query("ecl_term")
def _ecl_term(b: Book):
    """P11–P14 — realised loss, 12m ECL, lifetime PD, lifetime ECL."""
    return b.part_a().select("loan_id", "realized_loss_12m", "ecl_12m", "pd_lifetime", "ecl_lifetime")


@query("ecl_multiplier")
def _ecl_multiplier(b: Book):
    """P10, P12, P15 — part B EAD, LGD, 12m ECL, lifetime ECL by multiplier."""
    return b.part_b().select("loan_id", "ead", "lgd", "ecl_12m", "ecl_lifetime")


@query("realized_loss")
def _realized_loss(b: Book):
    """P11 — realised 12m loss and defaults per booking year."""
    return b.part_a().groupBy("booking_year").agg(
        F.count(F.lit(1)).alias("loans"), F.sum("default_12m").cast("long").alias("defaults"),
        F.sum("realized_loss_12m").alias("realized_loss_12m")).transform(reports.sort_small, "booking_year")


# ---- staging -----------------------------------------------------------------------------

@query("stage_pd_bands")
def _stage_pd_bands(b: Book):
    """T1 — PD-band stage."""
    return b.part_a().select("loan_id", "pd_12m", "stage")


@query("stage_sicr")
def _stage_sicr(b: Book):
    """T3 — SICR stage at default thresholds."""
    return b.part_b().select("loan_id", "stage_ifrs9")


@query("stage_sicr_params")
def _stage_sicr_params(b: Book):
    """T2 — SICR stage with non-default thresholds and switches."""
    return b.part_b(**ALT_SICR).select("loan_id", "stage_ifrs9")


@query("stage3_rate")
def _stage3_rate(b: Book):
    """A4 — share of loans in stage 3."""
    return reports.stage3_rate(b.part_b())


# ---- summaries ---------------------------------------------------------------------------

@query("portfolio_kpis")
def _portfolio_kpis(b: Book):
    """A1 — KPI vector."""
    return reports.portfolio_kpis(b.part_a())


@query("vintage_stats")
def _vintage_stats(b: Book):
    """A2 — vintage statistics."""
    return reports.vintage_stats(b.part_a())


@query("stage_mix")
def _stage_mix(b: Book):
    """A3, W2, L1 — share of loans per PD-band stage."""
    return reports.stage_mix(b.part_a(), "stage")


@query("describe_pd")
def _describe_pd(b: Book):
    """A11 — describe() of PDs, ratio and flags (exact quartiles)."""
    return reports.describe(b.part_b(), DESCRIBE_COLS)


@query("tape_head")
def _tape_head(b: Book):
    """L2 — first five rows of the final table by loan id."""
    return reports.head(final_table(b.part_a()), 5)


@query("tape_shape")
def _tape_shape(b: Book):
    """A15 — rows and columns of the final table."""
    return reports.shape(final_table(b.part_a()))


@query("stage_ecl")
def _stage_ecl(b: Book):
    """A5, A6 — ECL by IFRS 9 stage and the reported allowance."""
    return reports.stage_ecl(b.part_b())


def _table_functions(b: Book) -> SparkSession:
    register_table_functions(b.spark, b.part_b(), pd_ratio=staging.SICR_PD_RATIO, abs_pd=staging.SICR_ABS_PD)
    return b.spark


@query("sql_stage_sicr_params")
def _sql_stage_sicr_params(b: Book):
    """T2 as a SQL table function with its thresholds as arguments."""
    return _table_functions(b).sql("SELECT * FROM cs_stage(pd_ratio_from => 2.0D, abs_pd_from => 0.3D, default_90dpd => false)")


@query("sql_stage_ecl")
def _sql_stage_ecl(b: Book):
    """A5, A6 as a SQL table function."""
    return _table_functions(b).sql("SELECT * FROM cs_stage_ecl()")


@query("total_allowance")
def _total_allowance(b: Book):
    """A7 — total loss allowance."""
    return reports.total_allowance(b.part_b())


# ---- the written book --------------------------------------------------------------------

def stored(b: Book) -> tuple[str, str, str]:
    """(path, earlier date, date) of the book written to the shared folder once: tables, states and two snapshots.

    The later date is the last booking month with the stressed stages, less loans that have matured; the
    earlier one is the start of its year with the base stages, less loans booked since.
    """
    def build():
        path = f"{ensure_checkpoint_dir(b.spark).rstrip('/')}/book-{uuid.uuid4().hex}"
        date, earlier = b.calendar.last_month, b.calendar.last_month.replace(month=1)
        materialize.write_book(b, path, date.isoformat())
        materialize.refresh_states(b.spark, path)
        _, loans = materialize.read_book(b.spark, path, date.isoformat())
        base = F.when(F.col("stage_ifrs9") == 1, F.col("ecl_12m")).otherwise(F.col("ecl_lifetime"))
        stressed = F.when(F.col("stage_ifrs9_stressed") == 1, F.col("ecl_12m_stressed")).otherwise(F.col("ecl_lifetime"))
        then = loans.where(F.col("booking_month") < F.lit(earlier))
        now = loans.where(F.add_months("booking_month", F.col("term_months")) > F.lit(date))
        materialize.write_snapshot(then.select("loan_id", F.col("stage_ifrs9").alias("stage"), base.alias("allowance")),
                                   path, f"{earlier.isoformat()}-base")
        materialize.write_snapshot(now.select("loan_id", F.col("stage_ifrs9_stressed").alias("stage"), stressed.alias("allowance")),
                                   path, f"{date.isoformat()}-stressed")
        return path, f"{earlier.isoformat()}-base", f"{date.isoformat()}-stressed"
    return b._plan("stored", build)


def _date(b: Book) -> str:
    return b.calendar.last_month.isoformat()


@query("book_stage_ecl")
def _book_stage_ecl(b: Book):
    """S5, A5, A6 — ECL by stage from the written book, read back."""
    return reports.stage_ecl(materialize.read_book(b.spark, stored(b)[0], _date(b))[1])


@query("stage_ecl_from_states")
def _stage_ecl_from_states(b: Book):
    """A5, A6 — ECL by stage from the written book's states."""
    return states.stage_ecl_of(materialize.read_states(b.spark, stored(b)[0], _date(b)))


@query("allowance_from_states")
def _allowance_from_states(b: Book):
    """A7, A10 — base and stressed allowance from the written book's states."""
    return states.allowance_of(materialize.read_states(b.spark, stored(b)[0], _date(b)))


@query("stage_migration")
def _stage_migration(b: Book):
    """A3, T4 — migration between the stages of two written dates, with new and closed loans."""
    return materialize.read_migration(b.spark, *stored(b))


@query("vintage_stats_selected")
def _vintage_stats_selected(b: Book):
    """W3, A2 — statistics of the vintages booked in years of above-average unemployment, from the written book."""
    path = stored(b)[0]
    years = b.macro().groupBy(F.year("month").alias("booking_year")).agg(F.avg("unemployment_rate").alias("u"))
    table = f"{path}/unemployment-by-year"
    level = b.macro().agg(F.avg("unemployment_rate")).first()[0]
    years.write.mode("overwrite").parquet(table)
    chosen = b.spark.read.parquet(table).where(F.col("u") > F.lit(level))
    return reports.vintage_stats(materialize.read_vintages(b.spark, path, _date(b), chosen))


# ---- stress ------------------------------------------------------------------------------

@query("stress_additive")
def _stress_additive(b: Book):
    """M7, M8 — PIT PD and 12m ECL re-scored at the shocked last macro month."""
    return b.part_a_stressed().select("loan_id", "pd_12m_stressed", "ecl_12m_stressed")


@query("stress_totals")
def _stress_totals(b: Book):
    """A9 — base vs stressed 12m ECL and uplift."""
    return reports.stress_totals(b.part_a_stressed())


@query("stress_scenarios")
def _stress_scenarios(b: Book):
    """M7–M9 — base and stressed 12m ECL under three shocks, in one pass over the book."""
    return reports.scenario_totals(b.part_a_scenarios(), stress.SCENARIOS)


@query("stress_multiplier")
def _stress_multiplier(b: Book):
    """M5, M6, M9, T4 — ramp scenario, multiplicative PD stress, re-staging."""
    return b.part_b_stressed().select("loan_id", "pd_12m_stressed", "ecl_12m_stressed", "pd_ratio_stressed",
                                      "stage_ifrs9_stressed")


@query("stage_mix_stressed")
def _stage_mix_stressed(b: Book):
    """A3 — base and stressed stage mix from one pass over the book."""
    return reports.stage_mix_migration(b.part_b_stressed())


@query("stage_ecl_stressed")
def _stage_ecl_stressed(b: Book):
    """A8 — stressed ECL by stressed stage."""
    return reports.stage_ecl_stressed(b.part_b_stressed())


@query("allowance_increase")
def _allowance_increase(b: Book):
    """A7, A10 — base and stressed total allowance and the increase in percent."""
    return reports.total_allowance(b.part_b_stressed(), stressed_stage_col="stage_ifrs9_stressed")


# ---- capital -----------------------------------------------------------------------------

_STD_COLS = ["loan_id", "basel_grade", "basel_rw", "rwa_standardised", "capital_required_std"]


@query("basel_standardised")
def _basel_standardised(b: Book):
    """B1–B3 — grade, risk weight, RWA, capital."""
    return b.standardised().select(*_STD_COLS)


@query("basel_grade_band_join")
def _basel_grade_band_join(b: Book):
    """J3 + B3 — the same from a band table through a range join."""
    return capital.basel_standardised_by_bands(b.part_b(), capital.grade_bands(b.spark)).select(*_STD_COLS)


@query("income_band_lookup")
def _income_band_lookup(b: Book):
    """J3 — the customers' incomes as a band table of any size: the band that each loan's amount lies in."""
    bands = b.sources()[1].where("c_custkey IS NOT NULL").groupBy(F.round(F.col("c_acctbal") * 12.0, 2).alias("lo")).agg(
        F.min("c_custkey").alias("band"))
    loans = b.tape.select("loan_id", "loan_amount")
    return range_lookup(loans, bands, "loan_amount").select("loan_id", "loan_amount", "band", F.col("lo").alias("band_start"))


@query("basel_std_totals")
def _basel_std_totals(b: Book):
    """A12 — standardised totals."""
    return capital.standardised_totals(b.standardised())


@query("norm_functions")
def _norm_functions(b: Book):
    """B4, B5 — Φ⁻¹ of each loan's PD and Φ of that (round trip)."""
    df = with_norm_ppf(b.part_b().select("loan_id", "pd_12m"), "pd_12m", "z_pd", barrier=False)
    return with_norm_cdf(df, "z_pd", "cdf_z")


@query("irb_correlation")
def _irb_correlation(b: Book):
    """B6, B7 — asset correlation and maturity slope b per loan."""
    p = F.least(F.greatest(F.col("pd_12m"), F.lit(capital.IRB_PD_BOUNDS[0])), F.lit(capital.IRB_PD_BOUNDS[1]))
    return b.part_b().select("loan_id", capital.irb_correlation(F.col("pd_12m")).alias("irb_rho"),
                             (F.lit(capital.B_A) - F.lit(capital.B_B) * F.ln(p)).alias("maturity_b"))


@query("irb_capital")
def _irb_capital(b: Book):
    """B8, B9, P16 — IRB K, RWA and capital per loan."""
    return b.irb().select("loan_id", "effective_maturity_years", "irb_cap_ratio_per_ead", "rwa_irb",
                          "capital_required_irb")


@query("irb_totals")
def _irb_totals(b: Book):
    """A13 — IRB totals."""
    return capital.irb_totals(b.irb())


@query("irb_by_stage")
def _irb_by_stage(b: Book):
    """A14 — IRB capital by IFRS 9 stage."""
    return capital.irb_by_stage(b.irb())


# ---- back-test ---------------------------------------------------------------------------

@query("auc")
def _auc(b: Book):
    """K4 — exact ROC AUC of the current PD against the default outcome (one plan at every size)."""
    return backtest.auc(b.part_b(), "pd_12m", "default_12m")


@query("brier")
def _brier(b: Book):
    """K5 — Brier score of the current PD."""
    return backtest.brier(b.part_b(), "pd_12m", "default_12m")


@query("stratified_split")
def _stratified_split(b: Book):
    """K1 — class × split counts of the 70/30 split."""
    return backtest.split_table(b.part_a()).groupBy("default_12m", "split") \
        .agg(F.count(F.lit(1)).alias("loans")).transform(reports.sort_small, "default_12m", "split")


@query("champion_scores")
def _champion_scores(b: Book):
    """K1, K3 — split and score of each loan under the documented coefficient vector."""
    return backtest.champion_score(backtest.split_table(b.part_a())).select("loan_id", "split", "pd_model")


@query("champion_metrics")
def _champion_metrics(b: Book):
    """K3–K5 — out-of-sample AUC and Brier score of the documented coefficient vector."""
    return backtest.metrics(backtest.champion_score(backtest.split_table(b.part_a())))


@query("pd_coefficients")
def _pd_coefficients(b: Book):
    """K2 — coefficients of the logistic regression fitted on the training rows."""
    return backtest.fitted(b.part_a())[0].table(b.spark)


@query("pd_backtest")
def _pd_backtest(b: Book):
    """K1–K5 — logistic-regression back-test (out-of-sample AUC, Brier)."""
    return backtest.pd_backtest(b.part_a())


# ---- sink, mapping spec --------------------------------------------------------------------

@query("final_table")
def _final_table(b: Book):
    """S5, P17 — the exported 26-column table."""
    return final_table(b.part_a())


@query("direct_mapping")
def _direct_mapping(b: Book):
    """C2 — orders mapped to the loan target fields by the spec."""
    spec = read_mapping_spec(b.spark, MAPPING_SPEC)
    return catalog.direct_mapping(read_table(b.spark, b.sf_dir, "orders"), spec, "orders")


@query("pk_check")
def _pk_check(b: Book):
    """C3 — primary-key checks of orders and customer per the spec (single integer keys by bitmaps)."""
    spec = read_mapping_spec(b.spark, MAPPING_SPEC)
    out = None
    for t in ("orders", "customer"):
        pk = catalog.primary_key_columns(spec, t, target=False)
        keys = read_table(b.spark, b.sf_dir, t, pk)
        whole = len(pk) == 1 and keys.dtypes[0][1] in ("tinyint", "smallint", "int", "bigint")
        r = catalog.pk_check_bitmap(keys, pk[0], t) if whole else catalog.pk_check(keys, pk, t)
        out = r if out is None else out.unionByName(r)
    return out
