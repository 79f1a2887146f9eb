"""Reports from the written book equal reports from the live plan."""

import os

import pytest

from creditspark.operators import capital, reports
from creditspark.plans.book import Book
from creditspark.plans.materialize import read_book, write_book


def _rows(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_written_book_reports_match(spark, sf_small, scratch):
    book = Book.open(spark, sf_small)
    path = os.path.join(scratch, "book")
    write_book(book, path, "2026-06-30")
    write_book(book, path, "2026-03-31")
    write_book(book, path, "2026-06-30")  # again: replaces its own partitions only
    assert all(t.groupBy("reporting_date").count().collect() for t in read_book(spark, path))
    assert [t.count() for t in read_book(spark, path)] == [3000, 3000]
    part_a, part_bc = read_book(spark, path, "2026-06-30")
    assert part_a.count() == part_bc.count() == 1500
    live = _rows(reports.stage_ecl(book.part_b()), "stage_ifrs9")
    stored = _rows(reports.stage_ecl(part_bc), "stage_ifrs9")
    assert live.keys() == stored.keys()
    for k in live:
        for c, v in live[k].items():
            assert stored[k][c] == pytest.approx(v, rel=1e-12)
    assert _rows(reports.stage_mix(part_a), "stage") == _rows(reports.stage_mix(book.part_a()), "stage")
    a = capital.irb_by_stage(part_bc).collect()
    b = capital.irb_by_stage(capital.basel_irb(book.part_b())).collect()
    assert [r["rwa_irb"] for r in a] == pytest.approx([r["rwa_irb"] for r in b], rel=1e-12)
    # vintage filters prune partitions
    plan = part_a.where("booking_year = 1996")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters:" in plan and "booking_year" in plan.split("PartitionFilters:")[1].split("]")[0]
    years = [d for d in os.listdir(os.path.join(path, "part_a", "reporting_date=2026-06-30")) if "=" in d]
    files = [f for d in years for f in os.listdir(os.path.join(path, "part_a", "reporting_date=2026-06-30", d))
             if f.endswith(".parquet")]
    assert len(files) <= 2 * len(years)
