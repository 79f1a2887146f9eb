"""S1 — orders and customers kept bucketed by customer, so that their join needs no exchange.

Written once, read by every run: both tables are Parquet, bucketed and sorted by
the customer key with the same number of buckets, so a join on the key merges
bucket with bucket where the files lie. Customers that hold a large share of the
orders would make one bucket hot, and a bucket is not split; their orders are a plain
table of their own, joined with a broadcast of just their customers' rows (at most
1/share of them).

The files are what counts; :func:`open_bucketed` names them in the session's
catalog again, so a later session (or another cluster) joins them without an
exchange, too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .loan_tape import CUSTOMER_COLS, ORDER_COLS, BookCalendar, heavy_customers, tape_of_join

ORDERS, HOT_ORDERS, CUSTOMERS, LAYOUT = "orders", "hot_orders", "customers", "layout"


@dataclass(frozen=True)
class Bucketed:
    """The tables of one bucketed copy: orders by customer, orders of hot customers, customers."""

    orders: DataFrame
    hot_orders: DataFrame
    customers: DataFrame
    hot: tuple

    def joined(self) -> DataFrame:
        """Every order with its customer's columns (NULL if there is none) and ``customer_found``."""
        found = F.coalesce("customer_found", F.lit(False))
        customers = self.customers.withColumn("customer_found", F.lit(True))

        def join(left: DataFrame, right: DataFrame) -> DataFrame:
            return left.join(right, left["o_custkey"] == right["c_custkey"], "left").withColumn("customer_found", found)

        rest = join(self.orders, customers)
        if not self.hot:
            return rest
        own = customers.where(F.col("c_custkey").isin(list(self.hot)))  # one row for each hot customer
        return rest.unionByName(join(self.hot_orders, F.broadcast(own)))

    def tape(self, calendar: BookCalendar, **kw) -> DataFrame:
        return tape_of_join(self.joined(), calendar, **kw)


def write_bucketed(orders: DataFrame, customer: DataFrame, path: str, *, buckets: int, name: str,
                   hot: list | None = None) -> Bucketed:
    """Write both tables below ``path`` in ``buckets`` buckets; ``name`` is their prefix in the catalog.

    ``hot``: customers kept apart (:func:`loan_tape.heavy_customers` by default).
    """
    spark, path = orders.sparkSession, path.rstrip("/")
    hot = sorted(heavy_customers(orders) if hot is None else hot)
    is_hot = F.coalesce(F.col("o_custkey").isin(hot), F.lit(False)) if hot else F.lit(False)
    narrow = orders.select(*ORDER_COLS)

    def put(df: DataFrame, table: str, key: str) -> None:
        # dealt by the key first: a bucket is one file, not one for each task that met it
        (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
         .option("path", f"{path}/{table}").saveAsTable(f"{name}_{table}"))

    put(narrow.where(~is_hot), ORDERS, "o_custkey")
    put(customer.select(*CUSTOMER_COLS), CUSTOMERS, "c_custkey")
    narrow.where(is_hot).write.mode("overwrite").parquet(f"{path}/{HOT_ORDERS}")
    key = dict(orders.select("o_custkey").dtypes)["o_custkey"]
    layout = spark.createDataFrame([(buckets, [int(k) for k in hot])], f"buckets int, hot array<{key}>")
    layout.write.mode("overwrite").parquet(f"{path}/{LAYOUT}")  # last: without it the copy is not complete
    return open_bucketed(spark, path, name=name)


def open_bucketed(spark: SparkSession, path: str, *, name: str) -> Bucketed:
    """The bucketed copy below ``path``, named in the catalog of this session."""
    path = path.rstrip("/")
    layout = spark.read.parquet(f"{path}/{LAYOUT}").first()

    def table(kind: str, key: str) -> DataFrame:
        if not spark.catalog.tableExists(f"{name}_{kind}"):
            columns = ", ".join(f"`{c}` {t}" for c, t in spark.read.parquet(f"{path}/{kind}").dtypes)
            spark.sql(f"CREATE TABLE {name}_{kind} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
                      f"INTO {layout['buckets']} BUCKETS LOCATION '{path}/{kind}'")
        return spark.table(f"{name}_{kind}")

    return Bucketed(table(ORDERS, "o_custkey"), spark.read.parquet(f"{path}/{HOT_ORDERS}"),
                    table(CUSTOMERS, "c_custkey"), tuple(layout["hot"]))
