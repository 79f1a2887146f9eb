"""S3/S4 — JSON-lines specification files.

Container format: the first line is the literal header ``raw_json``; each later
line is one JSON object (a one-column export). ``spark.read.json`` alone would
turn the header into a ``_corrupt_record`` row and ``read.csv`` splits inside
the objects, so the files are read as text, the header dropped, and each line
parsed with an explicit schema (no inference).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADER = "raw_json"

# ---- fixed values: field layout of the data-model mapping spec ----
MAPPING_SCHEMA = T.StructType([
    T.StructField("MODELLED", T.BooleanType()),
    T.StructField("CONCEPT", T.StringType()),
    T.StructField("SOURCE_DATABASENAME_AWS", T.StringType()),
    T.StructField("SOURCE_TABLENAME_AWS", T.StringType()),
    T.StructField("SOURCE_VARIABLE_AWS", T.StringType()),
    T.StructField("SOURCE_VARIABLE_TYPE_AWS", T.StringType()),
    T.StructField("PRIMARY_KEY", T.StringType()),
    T.StructField("TRANSFORMATION", T.StringType()),
    T.StructField("HISTORICAL_VARIABLE_CATEGORY", T.StringType()),
    T.StructField("TARGET_DATABASENAME", T.StringType()),
    T.StructField("TARGET_TABLE", T.StringType()),
    T.StructField("TARGET_FIELDNAME", T.StringType()),
    T.StructField("TARGET_FIELDTYPE", T.StringType()),
    T.StructField("NOTES", T.StringType()),
    T.StructField("_metadata", T.StructType([
        T.StructField("row_number", T.LongType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("sheet_name", T.StringType()),
        T.StructField("converted_at", T.TimestampNTZType()),
    ])),
])

# ---- fixed values: field layout of the model-variable catalogue ----
CATALOGUE_SCHEMA = T.StructType([
    T.StructField("Variable", T.StringType()),
    T.StructField("Purpose", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Lineage doc", T.StringType()),
    T.StructField("Model_cat", T.StringType()),
])


def _spec_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a spec file as a ``value`` column.

    A plain path that exists on the driver (e.g. a spec shipped inside this
    package) is read on the driver — executors on a cluster cannot see the
    driver's disk; anything else (shared storage URIs) is read by Spark.
    """
    if "://" not in path and os.path.isfile(path):
        with open(path, encoding="utf-8") as fh:
            lines = [(line.rstrip("\n"),) for line in fh]
        return spark.createDataFrame(lines, "value string")
    return spark.read.text(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a ``raw_json`` container into typed columns (one row per object line)."""
    lines = _spec_lines(spark, path)
    body = lines.where((F.trim("value") != F.lit(HEADER)) & (F.length(F.trim("value")) > 0))
    # PERMISSIVE: the predicate above and the parse may be evaluated in either
    # order (common-subexpression elimination), so the header must not raise.
    parsed = body.select(F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("j"))
    return parsed.select(*[F.col("j").getField(f.name).alias(f.name) for f in schema.fields])


def read_mapping_spec(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, MAPPING_SCHEMA)


def read_variable_catalogue(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, CATALOGUE_SCHEMA)
