"""C1–C4, J4 — operators driven by the mapping spec and the variable catalogue.

A spec has one row per column of a table; its rows are brought to the driver to
build one ``select`` — the data itself never leaves the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: spec field-type names → Spark SQL types ----
TYPE_NAMES = {"string": "string", "int": "int", "integer": "int", "bigint": "bigint", "long": "bigint",
              "double": "double", "float": "double", "decimal": "decimal(38,10)", "date": "date",
              "timestamp": "timestamp", "boolean": "boolean"}


def flatten_mapping_spec(spec: DataFrame) -> DataFrame:
    """C1 — spec as a flat typed table (``_metadata`` fields promoted to columns)."""
    meta = ["row_number", "source_file", "sheet_name", "converted_at"]
    base = [c for c in spec.columns if c != "_metadata"]
    return spec.select(*base, *[F.col("_metadata").getField(m).alias(f"meta_{m}") for m in meta])


def _spec_rows(spec: DataFrame, source_table: str | None) -> list:
    rows = spec.where(F.coalesce(F.col("MODELLED"), F.lit(False)))
    if source_table is not None:
        rows = rows.where(F.col("SOURCE_TABLENAME_AWS") == source_table)
    return sorted(rows.collect(), key=lambda r: (r["_metadata"]["row_number"] if r["_metadata"] else 0))


def direct_mapping(df: DataFrame, spec: DataFrame, source_table: str | None = None) -> DataFrame:
    """C2 — apply every modelled "direct mapping" row: ``cast(source) AS target``.

    Other transformation kinds are rejected rather than silently skipped.
    """
    cols = []
    for r in _spec_rows(spec, source_table):
        kind = (r["TRANSFORMATION"] or "").strip().lower()
        if kind != "direct mapping":
            raise ValueError(f"unsupported transformation {r['TRANSFORMATION']!r} for {r['TARGET_FIELDNAME']}")
        tname = (r["TARGET_FIELDTYPE"] or "string").strip().lower()
        spark_type = TYPE_NAMES.get(tname, tname)
        cols.append(F.col(r["SOURCE_VARIABLE_AWS"]).cast(spark_type).alias(r["TARGET_FIELDNAME"]))
    if not cols:
        raise ValueError("no modelled direct-mapping rows for this table")
    return df.select(*cols)


def primary_key_columns(spec: DataFrame, source_table: str | None = None, *, target: bool = True) -> list[str]:
    name = "TARGET_FIELDNAME" if target else "SOURCE_VARIABLE_AWS"
    return [r[name] for r in _spec_rows(spec, source_table) if (r["PRIMARY_KEY"] or "").upper() == "PK"]


def bitmap_keys(df: DataFrame, key: str) -> DataFrame:
    """(bucket, n, kinds): rows and distinct keys of each bucket of 32,768 consecutive integer keys.

    A bucket is a bitmap of its keys, built within each task and merged after the shuffle: a few kilobytes for up to
    32,768 keys, where a grouping shuffles each key.
    """
    k = F.col(key).cast("long")
    return df.where(k.isNotNull()).groupBy(F.bitmap_bucket_number(k).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(k))).alias("kinds"))


def pk_check_bitmap(df: DataFrame, key: str, table: str = "table", *, fill: float = 1 / 64) -> DataFrame:
    """C3 for one integer key — :func:`pk_check` by bitmaps.

    A bucket with as many rows as set bits holds no repeated key; only the keys of
    other buckets are grouped. Bitmaps pay where keys are dense: if the rows would
    fill less than ``fill`` of the key range (a bitmap then outweighs its keys), keys are grouped as in ``pk_check``.
    """
    k = F.col(key).cast("long")
    span = df.agg(F.min(k).alias("lo"), F.max(k).alias("hi"), F.count(k).alias("keys"), F.count(F.lit(1)).alias("rows")).first()
    if not span["keys"] or span["keys"] < fill * (span["hi"] - span["lo"] + 1):
        return pk_check(df, [key], table)
    doubtful = bitmap_keys(df, key).where("n <> kinds").select("bucket")
    rows = df.where(k.isNotNull()).select(k.alias("_k"), F.bitmap_bucket_number(k).alias("bucket"))
    repeated = rows.join(doubtful, "bucket", "left_semi").groupBy("_k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("duplicate_keys")).select(
        F.lit(table).alias("table_name"), F.lit(key).alias("pk_columns"), F.lit(span["rows"]).cast("long").alias("rows"),
        F.lit(span["rows"] - span["keys"]).cast("long").alias("null_key_rows"), "duplicate_keys")


def pk_check(df: DataFrame, pk_cols: list[str], table: str = "table") -> DataFrame:
    """C3 — rows, rows with a NULL key part, and keys that occur more than once.

    One hash aggregate on the key (map-side combine collapses a repeated key
    before the shuffle), then a global sum of the per-key result.
    """
    if not pk_cols:
        raise ValueError("no primary-key columns")
    any_null = F.lit(False)
    for c in pk_cols:
        any_null = any_null | F.col(c).isNull()
    per_key = df.groupBy(*pk_cols).agg(F.count(F.lit(1)).alias("_n"),
                                       F.max(any_null.cast("int")).alias("_null"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("_null") == 1, F.col("_n"))), F.lit(0)).cast("long").alias("null_key_rows"),
        F.coalesce(F.sum(F.when((F.col("_null") == 0) & (F.col("_n") > 1), 1)), F.lit(0)).cast("long")
        .alias("duplicate_keys"),
    ).select(F.lit(table).alias("table_name"), F.lit(",".join(pk_cols)).alias("pk_columns"),
             "rows", "null_key_rows", "duplicate_keys")


def lineage_coverage(catalogue: DataFrame, spec: DataFrame) -> DataFrame:
    """C4/J4 — per model category: variables, mapped (semi join), unmapped (anti join), no lineage doc."""
    fields = spec.select(F.col("TARGET_FIELDNAME").alias("Variable")).distinct()
    mapped = catalogue.join(fields, "Variable", "left_semi").withColumn("_mapped", F.lit(1))
    unmapped = catalogue.join(fields, "Variable", "left_anti").withColumn("_mapped", F.lit(0))
    both = mapped.unionByName(unmapped)
    return both.groupBy("Model_cat").agg(
        F.count(F.lit(1)).alias("variables"),
        F.sum("_mapped").cast("long").alias("mapped"),
        F.sum(F.lit(1) - F.col("_mapped")).cast("long").alias("unmapped"),
        F.sum(F.col("`Lineage doc`").isNull().cast("int")).cast("long").alias("missing_lineage_doc"),
    ).orderBy("Model_cat")


def unmapped_variables(catalogue: DataFrame, spec: DataFrame) -> DataFrame:
    """J4 — catalogue variables with no mapped target field (anti join)."""
    fields = spec.select(F.col("TARGET_FIELDNAME").alias("Variable"))
    return catalogue.join(fields, "Variable", "left_anti")
