"""Streaming scoring equals the batch book; the running stage table equals the batch summary."""

import os
import uuid

import pytest

from creditspark.operators import reports
from creditspark.plans.book import Book
from creditspark.streaming import (read_order_stream, score_stream, start_running_stage_ecl,
                                   start_scored_sink, static_customers)


def test_running_stage_ecl_matches_batch(spark, sf_small):
    book = Book.open(spark, sf_small)
    stream = read_order_stream(spark, sf_small)
    assert stream.isStreaming
    scored = score_stream(stream, static_customers(spark, sf_small), book.calendar)
    name = f"stage_ecl_{uuid.uuid4().hex[:8]}"
    q = start_running_stage_ecl(scored, name)
    q.awaitTermination(300)
    got = {r["stage_ifrs9"]: r for r in spark.sql(f"SELECT * FROM {name}").collect()}
    want = {r["stage_ifrs9"]: r for r in reports.stage_ecl(book.part_b()).collect()}
    assert set(got) == set(want)
    for s, w in want.items():
        assert got[s]["loans"] == w["loans"]
        assert got[s]["reported_loss_allowance"] == pytest.approx(w["reported_loss_allowance"], rel=1e-9)


def test_scored_sink_is_complete(spark, sf_small, scratch):
    book = Book.open(spark, sf_small)
    scored = score_stream(read_order_stream(spark, sf_small), static_customers(spark, sf_small), book.calendar)
    out = os.path.join(scratch, "scored")
    q = start_scored_sink(scored, out, name=f"scored_{uuid.uuid4().hex[:8]}")
    q.awaitTermination(300)
    written = spark.read.parquet(out)
    batch = book.part_b().select("loan_id", "stage_ifrs9", "ecl_12m")
    assert written.count() == batch.count()
    diff = written.select("loan_id", "stage_ifrs9", "ecl_12m").exceptAll(batch).count()
    assert diff == 0
