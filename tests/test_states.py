"""States of the written book, migration between written dates, pruned vintages, sketches that merge."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditspark.operators import ordered, reports, states
from creditspark.plans import materialize as M
from creditspark.plans.book import Book


@pytest.fixture(scope="module")
def written(spark, sf_small, tmp_path_factory):
    book, path = Book.open(spark, sf_small), str(tmp_path_factory.mktemp("book"))
    M.write_book(book, path, "2026-06-30")
    first = M.refresh_states(spark, path)
    return book, path, first


def close(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x.asDict().keys() == y.asDict().keys()
        assert list(x.asDict().values()) == pytest.approx(list(y.asDict().values()), rel=1e-11)


def test_reports_from_states(spark, written):
    book, path, first = written
    _, loans = M.read_book(spark, path, "2026-06-30")
    made = M.read_states(spark, path, "2026-06-30")
    assert made.count() < 100 and {y for _, y in first} == {r[0] for r in loans.select("booking_year").distinct().collect()}
    close(states.stage_ecl_of(made).collect(), reports.stage_ecl(loans).collect())
    close(states.allowance_of(made).collect(), reports.total_allowance(loans, stressed_stage_col="stage_ifrs9_stressed").collect())
    year = F.col("booking_year") == first[1][1]
    close(states.stage_ecl_of(made.where(year)).collect(), reports.stage_ecl(loans.where(year)).collect())


def test_states_merge(spark, written):
    """States of two halves, added, are the states of the whole."""
    loans = M.read_book(spark, written[1], "2026-06-30")[1]
    halves = [states.ecl_states(loans.where(F.col("loan_id") % 2 == k)) for k in (0, 1)]
    both = halves[0].unionByName(halves[1])
    close(states.stage_ecl_of(both).collect(), states.stage_ecl_of(states.ecl_states(loans)).collect())
    sums = lambda df: {tuple(r)[:2]: r.c for r in df.groupBy("booking_year", "stage_ifrs9").agg(F.sum("checksum").alias("c")).collect()}
    assert sums(both) == sums(states.ecl_states(loans))


def test_only_changed_partitions_are_made_anew(spark, sf_small, tmp_path):
    book, path = Book.open(spark, sf_small), str(tmp_path)
    M.write_book(book, path, "2026-03-31")
    assert len(M.refresh_states(spark, path)) > 1
    assert M.refresh_states(spark, path) == []
    part = f"{path}/part_bc"
    year = spark.read.parquet(part).agg(F.min("booking_year")).first()[0]
    changed = spark.read.parquet(part).where(F.col("booking_year") == year).withColumn("ead", F.col("ead") * 2)
    rows = changed.collect()
    (spark.createDataFrame(rows, changed.schema).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("reporting_date", "booking_year").parquet(part))
    assert M.refresh_states(spark, path) == [("2026-03-31", year)]
    loans = M.read_book(spark, path, "2026-03-31")[1]
    close(states.stage_ecl_of(M.read_states(spark, path)).collect(), reports.stage_ecl(loans).collect())
    M.write_book(book, path, "2026-06-30")  # another date: its partitions only
    assert {d for d, _ in M.refresh_states(spark, path)} == {"2026-06-30"}


def test_migration_by_hand(spark):
    then = spark.createDataFrame([(1, 1, 10.0), (2, 1, 20.0), (3, 2, 5.0), (4, None, 1.0)], "loan_id long, stage int, allowance double")
    now = spark.createDataFrame([(1, 1, 11.0), (2, 2, 40.0), (5, 1, 3.0), (4, 3, None)], "loan_id long, stage int, allowance double")
    got = [tuple(r) for r in states.migration(then, now).collect()]
    assert got == [("1", "1", 1, 10.0, 11.0), ("1", "2", 1, 20.0, 40.0), ("2", "closed", 1, 5.0, 0.0),
                   ("new", "1", 1, 0.0, 3.0), ("none", "3", 1, 1.0, 0.0)]
    none = then.limit(0)
    assert states.migration(none, none).collect() == []
    assert {r.stage_to for r in states.migration(then, none).collect()} == {"closed"}


def test_migration_reads_its_two_dates_only(spark, tmp_path):
    for k, date in enumerate(("2026-01-31", "2026-02-28", "2026-03-31")):
        loans = spark.range(10 * (k + 1)).selectExpr("id AS loan_id", f"int(1 + id % {k + 1}) AS stage", "double(id) AS allowance")
        M.write_snapshot(loans, str(tmp_path), date)
    M.write_snapshot(loans.limit(0), str(tmp_path), "2026-04-30")
    got = M.read_migration(spark, str(tmp_path), "2026-01-31", "2026-03-31")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(reporting_date") == 2
    rows = got.collect()
    assert sum(r.loans for r in rows) == 30 and sum(r.loans for r in rows if r.stage_from == "new") == 20
    assert sum(r.allowance_from for r in rows) == 45.0 and sum(r.allowance_to for r in rows) == sum(range(30))


def test_vintages_are_pruned_at_run_time(spark, written, tmp_path):
    _, path, _ = written
    spark.range(1990, 2030).selectExpr("int(id) AS booking_year", "double(id % 4) AS u").write.parquet(f"{tmp_path}/years")
    chosen = spark.read.parquet(f"{tmp_path}/years").where("u = 2")
    got = M.read_vintages(spark, path, "2026-06-30", chosen)
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    years = {r.booking_year for r in chosen.collect()}
    part_a, _ = M.read_book(spark, path, "2026-06-30")
    want = part_a.where(F.col("booking_year").isin(list(years)))
    assert 0 < got.count() == want.count() < part_a.count()


def test_sketch_states_merge_and_bracket(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.gamma(2.0, size=6000), np.full(3000, 0.25), [1e9, -1e9]])
    rows = [(int(i % 3), float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "booking_year int, v double")
    kept = ordered.column_states(df, ["v"], "booking_year").cache()
    assert kept.count() == 3
    got = ordered.merged_states(kept, ["v"], {"v": [0.246, 0.254]})["v"]
    assert (got["n"], got["min"], got["max"]) == (len(x), -1e9, 1e9)
    assert got["mean"] == pytest.approx(x.mean(), rel=1e-9) and got["std"] == pytest.approx(x.std(ddof=1), rel=1e-9)
    assert got["at"][0] <= np.quantile(x, 0.25) <= got["at"][1]
    row = reports.describe(df, ["v"], states=kept).first()
    assert [row.p25, row.p50, row.p75] == pytest.approx(np.quantile(x, [0.25, 0.5, 0.75]).tolist(), rel=1e-12)
    # brackets that miss are widened: the result stays exact
    wrong = ordered.exact_quantiles(df, ["v"], (0.5,), near={"v": [100.0, 200.0]})
    assert wrong["v"] == pytest.approx([float(np.median(x))])
