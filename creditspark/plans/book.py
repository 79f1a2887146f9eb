"""End-to-end compositions of the operators, one per section of the reference.

* part A: macro path → tape + macro at booking → PIT PD, default → LGD, EAD,
  ECL → PD-band stage (KPIs, vintage stats, additive stress on top);
* part B: origination PD → current PD, default, PD ratio, DPD flags → SICR
  stage → EAD, LGD, 12m / lifetime ECL (multiplicative stress, re-staging);
* part C: standardised and IRB capital on part B's book.

All loan-grain steps are projections of one scan + one join, so each part is a
single stage up to its first aggregate; summaries add one shuffle each.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions.core import pushdown_barrier
from ..operators import capital, risk, staging, stress
from ..operators.joins import lookup_macro_at_booking
from ..session import ensure_checkpoint_dir
from ..sources.bucketed import Bucketed, write_bucketed
from ..sources.loan_tape import BookCalendar, read_loan_tape, with_draws
from ..sources.macro import book_macro, ramp_scenario, snapshot
from ..sources.tables import read_table


@dataclass
class Book:
    """Per-directory context: the loan tape plus the scalars every part needs."""

    spark: SparkSession
    sf_dir: str
    calendar: BookCalendar
    tape: DataFrame
    _cache: dict = field(default_factory=dict)

    @classmethod
    def open(cls, spark: SparkSession, sf_dir: str, **tape_kw) -> "Book":
        tape, cal = read_loan_tape(spark, sf_dir, **tape_kw)
        return cls(spark, sf_dir, cal, tape)

    # ---- macro ----------------------------------------------------------
    def macro(self) -> DataFrame:
        return book_macro(self.spark, self.calendar)

    def macro_snapshot(self) -> dict:
        if "snap" not in self._cache:
            self._cache["snap"] = snapshot(self.macro(), "month")
        return self._cache["snap"]

    def shocked_snapshot(self) -> dict:
        """Last month of the macro table with the parallel shock added (M7)."""
        if "shocked" not in self._cache:
            row = snapshot(stress.shock_macro(self.macro()), "month",
                           ("unemployment_rate_stressed", "gdp_growth_stressed"))
            self._cache["shocked"] = {k.removesuffix("_stressed"): v for k, v in row.items()}
        return self._cache["shocked"]

    def ramp_snapshot(self) -> dict:
        if "ramp" not in self._cache:
            self._cache["ramp"] = snapshot(ramp_scenario(self.spark), "date")
        return self._cache["ramp"]

    def _plan(self, key, build):
        """Memoise a composed plan (a DataFrame object, no data) so queries reuse its analysis."""
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    # ---- part A -----------------------------------------------------------
    def tape_with_macro(self) -> DataFrame:
        ends = (self.calendar.first_month, self.calendar.last_month)
        return self._plan("tape_macro", lambda: lookup_macro_at_booking(self.tape, self.macro(), limits=ends))

    def sources(self) -> tuple[DataFrame, DataFrame]:
        return read_table(self.spark, self.sf_dir, "orders"), read_table(self.spark, self.sf_dir, "customer")

    def bucketed(self) -> Bucketed:
        """Orders and customers bucketed by customer, written once to the shared folder."""
        def build():
            path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/bucketed-{uuid.uuid4().hex}"
            return write_bucketed(*self.sources(), path, buckets=int(self.spark.conf.get("spark.sql.shuffle.partitions")),
                                  name=f"book_{uuid.uuid4().hex[:12]}")
        return self._plan("bucketed", build)

    def part_a(self, lgd_noise_sd: float = 0.0) -> DataFrame:
        return self._plan(("part_a", lgd_noise_sd), lambda: self._part_a(lgd_noise_sd))

    def _part_a(self, lgd_noise_sd: float) -> DataFrame:
        df = with_draws(self.tape_with_macro(), "A")
        df = risk.pit_pd(df, self.macro_snapshot())
        df = risk.simulate_default(df)
        df = risk.lgd_from_score(df, noise_sd=lgd_noise_sd)
        df = risk.ead(df)
        df = risk.ecl_term(df)
        return staging.stage_by_pd_band(df)

    def part_a_stressed(self) -> DataFrame:
        return self._plan("part_a_stressed", lambda: stress.stress_additive(self.part_a(), self.shocked_snapshot()))

    def part_a_scenarios(self) -> DataFrame:
        """Part A re-scored under every scenario of ``stress.SCENARIOS``."""
        def build():
            table = self.macro()
            shocked = {}
            for name, (u, g) in stress.SCENARIOS.items():
                row = snapshot(stress.shock_macro(table, unemp_shock=u, gdp_shock=g), "month",
                               ("unemployment_rate_stressed", "gdp_growth_stressed"))
                shocked[name] = {k.removesuffix("_stressed"): v for k, v in row.items()}
            return stress.stress_scenarios(self.part_a(), shocked)
        return self._plan("part_a_scenarios", build)

    # ---- part B -----------------------------------------------------------
    def part_b(self, **stage_params) -> DataFrame:
        key = ("part_b",) + tuple(sorted(stage_params.items()))
        return self._plan(key, lambda: self._part_b(**stage_params))

    def _part_b(self, **stage_params) -> DataFrame:
        df = with_draws(self.tape, "B")
        df = risk.origination_pd(df)
        df = risk.current_pd(df)
        df = risk.simulate_default(df, scale=2.0, cap=0.5)
        df = risk.pd_ratio_and_flags(df)
        df = staging.sicr_stage(df, **stage_params)
        df = risk.ead(df)
        return risk.ecl_multiplier(df)

    def part_b_stressed(self, refresh_flags: bool = False) -> DataFrame:
        def build():
            df = stress.stress_multiplier(self.part_b(), self.ramp_snapshot())
            return staging.restage_stressed(df, refresh_flags=refresh_flags)
        return self._plan(("part_b_stressed", refresh_flags), build)

    # ---- part C -----------------------------------------------------------
    def standardised(self) -> DataFrame:
        return self._plan("standardised", lambda: capital.basel_standardised(self.part_b()))

    def irb(self, **kw) -> DataFrame:
        # not memoised: each call gets its own observation (pushdown barrier) name
        # a barrier before it as well: the book and the IRB formula are two generated stages, each JIT-sized
        return capital.basel_irb(pushdown_barrier(self.part_b(), "irb_input"), **kw)
