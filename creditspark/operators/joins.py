"""J1/J3 — lookups against small, size-checked tables.

A side is broadcast only after its row count is checked against a bound; past
the bound the same join runs as a regular shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordered import checkpointed

DEFAULT_BROADCAST_ROWS = 100_000
BAND_BLOCK = 10_000


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Broadcast ``df`` only when it has at most ``max_rows`` rows."""
    n = df.limit(max_rows + 1).count()
    return (F.broadcast(df), True) if n <= max_rows else (df, False)


def lookup_macro_at_booking(loans: DataFrame, macro: DataFrame, *, month_col: str = "booking_month",
                            macro_month_col: str = "month",
                            mapping: dict | None = None, strict: bool = True,
                            max_rows: int = DEFAULT_BROADCAST_ROWS, limits: tuple | None = None) -> DataFrame:
    """J1 — attach macro values at each loan's booking month (many-to-one).

    ``limits`` (first and last month of the macro table) look up months outside at the nearest end.

    ``strict`` reproduces an index lookup: duplicate months are rejected up
    front (the macro table is small), and a loan whose month is missing fails
    the query at run time through ``assert_true`` instead of getting NULLs.
    """
    mapping = mapping or {"unemployment_rate": "booking_unemp", "gdp_growth": "booking_gdp_growth",
                          "house_price_index": "booking_hpi"}
    m = macro.select(F.col(macro_month_col).alias("_m_key"),
                     *[F.col(src).alias(dst) for src, dst in mapping.items()],
                     F.lit(True).alias("_m_hit"))
    if strict:
        dup = m.groupBy("_m_key").count().where("count > 1").limit(1).count()
        if dup:
            raise ValueError("macro table has duplicate months")
    side, _ = broadcast_if_small(m, max_rows)
    month = loans[month_col]
    if limits:
        inside = F.least(F.greatest(month, F.lit(limits[0])), F.lit(limits[1]))
        month = F.when(month.isNotNull(), inside)
    out = loans.join(side, month == side["_m_key"], "left")
    if strict:
        out = out.withColumn("_m_hit", F.assert_true(F.col("_m_hit").isNotNull(),
                                                     F.lit("booking month missing from macro table")))
        out = out.where(F.col("_m_hit").isNull())  # assert_true returns NULL: keeps every row
    return out.drop("_m_key", "_m_hit")


def band_join(df: DataFrame, bands: DataFrame, value_col: str, *, lo_col: str = "lo", hi_col: str = "hi",
              block: int = BAND_BLOCK) -> DataFrame:
    """J3 — range lookup ``lo <= value < hi`` against a table of bands that do not overlap.

    NULL bounds are open ends. The bounds cut the number line into intervals; a
    binary search (``Bucketizer``) gives each value its interval, and a broadcast
    hash join on the interval's number fetches the band. Band tables of more than
    ``block`` rows are neither collected nor broadcast: :func:`range_lookup` finds them
    (only the smaller ones are checked for overlaps). A value in no band (or NULL) gets NULLs.
    """
    from pyspark.ml.feature import Bucketizer

    inf = float("inf")
    few = bands.limit(block + 1).collect()
    if len(few) > block:
        return range_lookup(df, bands, value_col, lo_col=lo_col, hi_col=hi_col)
    rows = sorted(few, key=lambda r: -inf if r[lo_col] is None else r[lo_col])
    span = [(-inf if r[lo_col] is None else float(r[lo_col]), inf if r[hi_col] is None else float(r[hi_col])) for r in rows]
    for (_, hi), (lo, _) in zip(span, span[1:]):
        if lo < hi:
            raise ValueError("bands overlap")
    out, spark = df, df.sparkSession
    fields = [f for f in bands.schema.fields]
    value = F.when(~F.isnan(F.col(value_col).cast("double")), F.col(value_col).cast("double"))
    out = out.withColumn("_v", value)
    cuts = sorted({x for pair in span for x in pair if abs(x) != inf})
    place = {x: k for k, x in enumerate([-inf, *cuts, inf])}
    data = [(place[lo], *row) for (lo, hi), row in zip(span, rows) if lo < hi]
    side = spark.createDataFrame(data, T.StructType([T.StructField("_i", T.IntegerType()), *[
        T.StructField(f"_b_{f.name}", f.dataType) for f in fields]]))
    if cuts:
        found = Bucketizer(splits=[-inf, *cuts, inf], inputCol="_v", outputCol="_at", handleInvalid="keep")
        out = found.transform(out).withColumn("_at", F.when(F.col("_v").isNotNull(), F.col("_at").cast("int")))
    else:
        out = out.withColumn("_at", F.when(F.col("_v").isNotNull(), F.lit(0)))
    out = out.join(F.broadcast(side), F.col("_at") == F.col("_i"), "left").drop("_at", "_i")
    out = out.select(*[c for c in out.columns if not c.startswith("_b_") and c not in bands.columns],
                     *[F.col(f"_b_{f.name}").alias(f.name) for f in fields])
    return out.drop("_v")


def range_lookup(df: DataFrame, bands: DataFrame, value_col: str, *, lo_col: str = "lo", hi_col: str | None = None,
                 ranges: int | None = None) -> DataFrame:
    """J3 for band tables of any size — the band with the largest ``lo <= value`` (and ``value < hi``, if bands have ends).

    Values and band starts are united and range-partitioned by number, starts before
    equal values; a window over each range carries the last start seen, and the
    last start of the ranges before it is one row a range. Neither side is collected or
    broadcast whole, and a value that a third of all rows share is spread over ranges (its rows differ in a
    hash of the row). NULL ``lo`` is an open end. A value in no band (or NULL, NaN) gets NULLs. Of
    bands with one ``lo`` any may be found; give each ``lo`` once.
    """
    fields = [f.name for f in bands.schema.fields]
    low = F.coalesce(F.col(lo_col).cast("double"), F.lit(float("-inf")))
    starts = bands.select(low.alias("_v"), F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_spread"),
                          F.struct(*fields).alias("_band"))
    value = F.col(value_col).cast("double")
    rows = df.select(F.when(~F.isnan(value), value).alias("_v"), F.lit(1).alias("_kind"),
                     F.monotonically_increasing_id().alias("_spread"), F.struct(*df.columns).alias("_row"))
    both = checkpointed(starts.unionByName(rows, allowMissingColumns=True))  # read twice: ranges are sampled
    order = ["_v", "_kind", "_spread"]
    dealt = both.repartitionByRange(ranges, *order) if ranges else both.repartitionByRange(*order)
    dealt = checkpointed(dealt.withColumn("_range", F.spark_partition_id()))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # one row a range: the last start in it, then the last one in all ranges before
    ends = dealt.groupBy("_range").agg(F.max_by("_band", F.when(F.col("_kind") == 0, F.col("_v"))).alias("_end"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("_range", F.last("_end", ignorenulls=True).over(before).alias("_before"))
    found = F.coalesce(F.last("_band", ignorenulls=True).over(within), F.col("_before"))
    out = dealt.join(F.broadcast(ends), "_range").select("_kind", "_v", "_row", found.alias("_found")).where("_kind = 1")
    inside = F.col("_v").isNotNull()
    if hi_col:
        end = F.col(f"_found.`{hi_col}`").cast("double")
        inside = inside & (end.isNull() | (F.col("_v") < end))
    kept = [F.col(f"_row.`{c}`").alias(c) for c in df.columns if c not in fields]
    return out.select(*kept, *[F.when(inside, F.col(f"_found.`{c}`")).alias(c) for c in fields])
