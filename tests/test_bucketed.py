"""S1 — the bucketed copy: same rows, no exchange below the join, hot customers apart, reopened from its files."""

import pytest
from pyspark.sql import functions as F

from creditspark.plans.book import Book
from creditspark.plans.registry import book, refresh
from creditspark.sources.bucketed import open_bucketed, write_bucketed
from creditspark.sources.tables import read_table


@pytest.fixture(scope="module")
def tables(spark, sf_small):
    return read_table(spark, sf_small, "orders"), read_table(spark, sf_small, "customer")


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_join_has_no_exchange(spark, sf_small, tables, scratch, no_broadcast):
    b = Book.open(spark, sf_small)
    tape = write_bucketed(*tables, scratch, buckets=6, name="nox").tape(b.calendar)
    text = plan(tape)
    assert "SortMergeJoin [o_custkey" in text and "Exchange" not in text
    assert "SelectedBucketsCount: 6 out of 6" in text
    assert rows(tape) == rows(b.tape)
    assert tape.columns == b.tape.columns and tape.schema == b.tape.schema


@pytest.mark.parametrize("hot", [[], None])
def test_hot_customers_lie_apart(spark, sf_small, tables, scratch, no_broadcast, hot):
    orders, customer = tables
    key = customer.agg(F.min("c_custkey")).first()[0]
    skewed = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, key).otherwise(F.col("o_custkey")))
    copy = write_bucketed(skewed, customer, scratch, buckets=4, name=f"hot{'x' if hot is None else ''}",
                          hot=[key] if hot is None else [])
    b = Book.open(spark, sf_small)
    from creditspark.sources.loan_tape import loan_tape

    assert rows(copy.tape(b.calendar)) == rows(loan_tape(skewed, customer, b.calendar))
    if hot is None:
        assert copy.hot == (key,) and copy.orders.where(F.col("o_custkey") == key).isEmpty()
        assert "Exchange hashpartitioning" not in plan(copy.tape(b.calendar))


def test_a_later_session_reopens_the_files(spark, sf_small, tables, scratch, no_broadcast):
    b = Book.open(spark, sf_small)
    first = rows(write_bucketed(*tables, scratch, buckets=5, name="first").tape(b.calendar))
    again = open_bucketed(spark, scratch, name="second").tape(b.calendar)
    assert rows(again) == first and "Exchange" not in plan(again)


def test_orders_without_customer_or_key(spark, tables, scratch, sf_small):
    orders, customer = tables
    odd = orders.limit(3).withColumn("o_custkey", F.when(F.col("o_orderkey") % 2 == 0, F.lit(-5).cast("long")))
    copy = write_bucketed(orders.limit(20).unionByName(odd), customer, scratch, buckets=3, name="odd", hot=[])
    assert copy.joined().where("not customer_found").count() == 3 and copy.joined().count() == 23
    with pytest.raises(Exception, match="order without a customer row"):
        copy.tape(Book.open(spark, sf_small).calendar).collect()


def test_book_is_opened_once_until_refreshed(spark, sf_small, scratch):
    for t in ("orders", "customer"):
        read_table(spark, sf_small, t).write.parquet(f"{scratch}/{t}.parquet")
    b = book(spark, scratch)
    n = b.tape.count()
    assert book(spark, scratch) is b
    read_table(spark, sf_small, "orders").limit(7).write.mode("append").parquet(f"{scratch}/orders.parquet")
    assert book(spark, scratch) is not b  # the folder's time tells
    fresh = refresh(spark, scratch)
    assert book(spark, scratch) is fresh and fresh.tape.count() == n + 7
