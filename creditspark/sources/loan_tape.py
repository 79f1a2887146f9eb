"""S1 — the loan tape: one row per loan, derived from ``orders ⋈ customer``.

Every order is a loan (``loan_id = o_orderkey``) booked in the month of its
order date; borrower attributes come from the customer row, and attributes the
tables do not carry come from keyed draws (see ``functions.draws``), so the
same loan always gets the same value.

Scale notes
-----------
* The join keeps every order (left join on the customer key); an order whose
  customer is missing fails the query, as an unmatched index lookup does in the
  reference, and :func:`reconciliation` counts such orders without failing.
  Neither side has a proven size bound, so neither is broadcast whole: customers
  that hold a large share of a sample of orders are joined against a broadcast
  of just their own rows (at most 1/share of them); how all others are joined is
  the planner's choice by measured sizes. ``sources.bucketed`` keeps both sides
  bucketed by customer, so that the join needs no exchange at all.
* The book's calendar (first/last booking month, first booking year) is a
  one-row aggregate over one column of ``orders``; it is brought to the driver
  as three scalars so downstream expressions fold them as literals.
* Dates outside ``CALENDAR_LIMITS`` (typing errors such as year 9999) do not
  stretch the calendar. Their loans keep their booking month and are looked up,
  and given a vintage, at the calendar's nearest end; no loan is lost.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sqltext as X
from ..functions.core import with_exprs
from .tables import read_table

ORDER_COLS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
CUSTOMER_COLS = ["c_custkey", "c_acctbal"]

# ---- fixed values: draw salts (one independent uniform per attribute) ----
SALT = {
    "credit_score": 1, "dti_ratio": 2, "utilization_ratio": 3, "num_inquiries_12m": 4,
    "employment_years": 5, "term_months": 6, "pd_mult": 7, "ead_factor": 8,
    "default": 9, "lgd": 10, "life_mult": 11, "interest_rate": 12, "lgd_noise": 13,
    "split": 14,
}
# term choices and weights: the portfolio section's set and the capital section's
TERM_CHOICES_A = (24, 36, 48, 60)
TERM_CHOICES = (12, 24, 36, 60)
TERM_WEIGHTS = (0.2, 0.3, 0.3, 0.2)
# dates that may set the calendar; macro tables have a row for each month between them at most
CALENDAR_LIMITS = (dt.date(1900, 1, 1), dt.date(2099, 12, 31))
MAX_BOOK_MONTHS = 2400
# a customer with this share of the sampled orders is joined apart
HOT_SHARE, SAMPLE_FRACTION, MIN_SAMPLED = 0.01, 0.001, 20


@dataclass(frozen=True)
class BookCalendar:
    first_month: dt.date
    last_month: dt.date

    @property
    def n_months(self) -> int:
        return (self.last_month.year - self.first_month.year) * 12 + \
            (self.last_month.month - self.first_month.month) + 1

    @property
    def first_year(self) -> int:
        return self.first_month.year


def book_calendar(orders: DataFrame) -> BookCalendar:
    """First and last booking month of the book (a one-row aggregate), within ``CALENDAR_LIMITS``."""
    lo, hi = CALENDAR_LIMITS

    def ends(rows: DataFrame):
        row = rows.agg(F.min("o_orderdate").cast("date").alias("lo"), F.max("o_orderdate").cast("date").alias("hi")).first()
        return row["lo"], row["hi"]

    first, last = ends(orders)
    if first is not None and (first < lo or last > hi):
        first, last = ends(orders.where(F.col("o_orderdate").cast("date").between(F.lit(lo), F.lit(hi))))
    if first is None:
        raise ValueError("orders has no booking dates")
    return BookCalendar(first.replace(day=1), last.replace(day=1))


def heavy_customers(orders: DataFrame, share: float = HOT_SHARE, fraction: float = SAMPLE_FRACTION) -> list:
    """Customers with at least ``share`` of a sample of orders: at most 1/share of them."""
    s = orders.select("o_custkey").where("o_custkey is not null").sample(fraction=fraction, seed=17)
    n = s.count()
    counts = s.groupBy("o_custkey").agg(F.count("*").alias("n"))
    rows = counts.where(F.col("n") >= F.lit(max(float(MIN_SAMPLED), share * n))).collect()
    return sorted(r["o_custkey"] for r in rows)


def join_orders_customers(orders: DataFrame, customer: DataFrame, hot: list | None = None) -> DataFrame:
    """Every order with its customer's columns (NULL if there is none) and ``customer_found``.

    ``hot`` customers (see :func:`heavy_customers`) meet a broadcast of their own rows.
    """
    o = orders.select(*ORDER_COLS)
    c = customer.select(*CUSTOMER_COLS, F.lit(True).alias("customer_found"))
    found = F.coalesce("customer_found", F.lit(False))

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, left["o_custkey"] == right["c_custkey"], "left").withColumn("customer_found", found)

    if not hot:
        return joined(o, c)
    is_hot = F.col("o_custkey").isin(hot)
    hot_part = joined(o.where(is_hot), F.broadcast(c.where(F.col("c_custkey").isin(hot))))  # len(hot) rows
    rest = joined(o.where(~is_hot | F.col("o_custkey").isNull()), c)
    return hot_part.unionByName(rest)


def reconciliation(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Per booking year: orders, those that become loans, and those without customer or date.

    Nothing is lost on the way: ``orders = loans + no_customer`` in every year, and
    orders without a date stand in the row whose year is NULL.
    """
    j = join_orders_customers(orders, customer)
    year = F.year(F.col("o_orderdate").cast("date")).alias("booking_year")
    return j.groupBy(year).agg(
        F.count(F.lit(1)).alias("orders"),
        F.count(F.when(F.col("customer_found"), 1)).alias("loans"),
        F.count(F.when(~F.col("customer_found"), 1)).alias("no_customer"),
        F.count(F.when(F.col("o_orderdate").isNull(), 1)).alias("no_date"),
    )


def term_sql(key: str, choices=TERM_CHOICES, weights=TERM_WEIGHTS) -> str:
    return f"CAST({X.choice(key, SALT['term_months'], list(choices), list(weights))} AS INT)"


def loan_tape(orders: DataFrame, customer: DataFrame, calendar: BookCalendar | None = None, *,
              term_choices=TERM_CHOICES, term_weights=TERM_WEIGHTS, hot: list | None = None) -> DataFrame:
    """Loan-grain table (columns of FIXTURES ``loan_tape_a`` minus the macro lookup).

    Every order is a loan. An order without a customer row fails the query when
    its attributes are read; :func:`reconciliation` tells how many there are.
    """
    cal = calendar or book_calendar(orders)
    return tape_of_join(join_orders_customers(orders, customer, hot), cal, term_choices=term_choices, term_weights=term_weights)


def tape_of_join(j: DataFrame, cal: BookCalendar, *, term_choices=TERM_CHOICES, term_weights=TERM_WEIGHTS) -> DataFrame:
    """The loan tape from orders joined with customers and ``customer_found``."""
    j = j.where(F.assert_true(F.col("customer_found"), F.lit("order without a customer row")).isNull())
    k = "o_orderkey"
    bm = "trunc(CAST(o_orderdate AS DATE), 'month')"
    y, lo, hi = f"year({bm})", cal.first_month.year, cal.last_month.year
    year = f"{y} + greatest({lo} - {y}, 0) - greatest({y} - {hi}, 0)"  # the nearest year of the calendar; NULL stays
    cols = {
        "loan_id": k,
        "customer_id": "o_custkey",
        "booking_month": bm,
        "booking_year": f"year({bm})",
        "vintage_index": f"{year} - {int(cal.first_year)}",
        "age": "CAST(21 + c_custkey % 54 AS DOUBLE)",
        "annual_income": X.clip(f"{X.num(15000.0)} + (c_acctbal + {X.num(1000.0)}) * {X.num(12.0)}",
                                15000.0, 300000.0),
        "credit_score": f"CAST({X.num(300.0)} + floor({X.num(550.0)} * ({X.num(0.35)} + {X.num(0.65)} * "
                        f"{X.uniform(k, SALT['credit_score'])})) AS DOUBLE)",
        "employment_years": f"CAST(floor({X.num(35.0)} * {X.uniform(k, SALT['employment_years'])}) AS DOUBLE)",
        "dti_ratio": X.uniform_between(k, SALT["dti_ratio"], 0.1, 0.4),
        "utilization_ratio": X.uniform(k, SALT["utilization_ratio"]),
        "num_inquiries_12m": f"CAST(floor({X.num(6.0)} * {X.uniform(k, SALT['num_inquiries_12m'])}) AS INT)",
        "loan_amount": X.clip(f"o_totalprice / {X.num(5.0)}", 10000.0, 100000.0),
        "term_months": term_sql(k, term_choices, term_weights),
        "interest_rate": X.uniform_between(k, SALT["interest_rate"], 5.0, 19.0),
    }
    return j.select(*[F.expr(f"{text} AS {name}") for name, text in cols.items()])


def with_draws(tape: DataFrame, part: str = "B") -> DataFrame:
    """Per-loan factors the reference drew at random, as keyed input columns.

    part "A": EAD factor 0.6..1.1 and the portfolio section's terms. part "B": EAD factor 0.8..1.2, PD deterioration
    0.8..2.5, lifetime multiplier 2..5 and LGD = 0.8·u⁴ (mean 0.16, the mean of
    0.8·Beta(0.1, 0.4)). Unused columns are pruned by Catalyst.
    """
    k = "loan_id"
    cols = {"default_draw": X.uniform(k, SALT["default"])}
    if part.upper() == "A":
        cols["ead_factor"] = X.uniform_between(k, SALT["ead_factor"], 0.6, 0.5)
        cols["term_months"] = term_sql(k, TERM_CHOICES_A)
    else:
        cols["ead_factor"] = X.uniform_between(k, SALT["ead_factor"], 0.8, 0.4)
        cols["pd_mult"] = X.uniform_between(k, SALT["pd_mult"], 0.8, 1.7)
        cols["life_mult"] = X.uniform_between(k, SALT["life_mult"], 2.0, 3.0)
        cols["lgd"] = f"({X.num(0.8)} * power({X.uniform(k, SALT['lgd'])}, {X.num(4.0)}))"
    return with_exprs(tape, cols)


def read_loan_tape(spark: SparkSession, sf_dir: str, calendar: BookCalendar | None = None,
                   **kw) -> tuple[DataFrame, BookCalendar]:
    orders = read_table(spark, sf_dir, "orders", ORDER_COLS)
    customer = read_table(spark, sf_dir, "customer", CUSTOMER_COLS)
    cal = calendar or book_calendar(orders.select("o_orderdate"))
    return loan_tape(orders, customer, cal, hot=heavy_customers(orders), **kw), cal
