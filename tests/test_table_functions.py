"""SQL table functions with thresholds as arguments: results, defaults, and plans without Python."""

import pytest

from creditspark.functions.sqlfunctions import register_table_functions
from creditspark.operators import reports, staging
from creditspark.plans.book import Book


@pytest.fixture(scope="module")
def book(spark, sf_small):
    b = Book.open(spark, sf_small)
    assert register_table_functions(spark, b.part_b(), pd_ratio=staging.SICR_PD_RATIO, abs_pd=staging.SICR_ABS_PD) == [
        "cs_stage", "cs_stage_ecl"]
    return b


@pytest.mark.parametrize("params", [{}, {"pd_ratio_threshold": 2.0}, {"abs_pd_threshold": 0.4, "default_90dpd": False},
                                    {"pd_ratio_threshold": 9.0, "abs_pd_threshold": 0.9, "backstop_30dpd": False}])
def test_thresholds_are_arguments(spark, book, params):
    name = {"pd_ratio_threshold": "pd_ratio_from", "abs_pd_threshold": "abs_pd_from"}
    args = ", ".join(f"{name.get(k, k)} => {str(v).lower()}{'D' if isinstance(v, float) else ''}" for k, v in params.items())
    want = book.part_b(**params)
    got = spark.sql(f"SELECT * FROM cs_stage({args}) ORDER BY loan_id").collect()
    assert got == want.select("loan_id", "stage_ifrs9").orderBy("loan_id").collect()
    table = spark.sql(f"SELECT * FROM cs_stage_ecl({args}) ORDER BY stage_ifrs9")
    for a, b in zip(table.collect(), reports.stage_ecl(want).orderBy("stage_ifrs9").collect(), strict=True):
        assert list(a) == pytest.approx(list(b), rel=1e-11)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_functions_join_like_tables(spark, book):
    moved = spark.sql("SELECT count(*) AS n FROM cs_stage() a JOIN cs_stage(pd_ratio_from => 100D) b USING (loan_id) "
                      "WHERE a.stage_ifrs9 > b.stage_ifrs9").first().n
    assert 0 < moved < book.tape.count()
