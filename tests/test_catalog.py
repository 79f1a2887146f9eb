"""JSON-lines specs (S3/S4) and the mapping-driven operators (C1–C4, J4)."""

import pytest

from creditspark.operators import catalog
from creditspark.plans.registry import CATALOGUE, MAPPING_SPEC
from creditspark.sources.specs import read_mapping_spec, read_variable_catalogue


def test_spec_header_dropped_and_typed(spark):
    spec = read_mapping_spec(spark, MAPPING_SPEC)
    rows = spec.collect()
    assert len(rows) == 10
    assert all(r["CONCEPT"] is not None for r in rows)
    flat = catalog.flatten_mapping_spec(spec)
    assert "meta_row_number" in flat.columns and "_metadata" not in flat.columns
    assert dict(flat.dtypes)["meta_converted_at"] == "timestamp_ntz"
    assert sorted(r["meta_row_number"] for r in flat.collect()) == list(range(1, 11))


def test_catalogue_reads_spaced_column(spark):
    cat = read_variable_catalogue(spark, CATALOGUE)
    assert "Lineage doc" in cat.columns
    assert cat.count() == 9


def test_direct_mapping_casts_and_renames(spark, sf_small):
    spec = read_mapping_spec(spark, MAPPING_SPEC)
    cust = spark.read.parquet(f"{sf_small}/customer.parquet")
    out = catalog.direct_mapping(cust, spec, "customer")
    assert out.columns == ["customer_id", "nation_id", "account_balance", "segment"]  # c_name is not modelled
    assert dict(out.dtypes)["nation_id"] == "int"
    assert out.count() == cust.count()


def test_pk_check_finds_nulls_and_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,), (3,), (3,)], "k long")
    r = catalog.pk_check(df, ["k"], "t").first()
    assert (r["rows"], r["null_key_rows"], r["duplicate_keys"]) == (7, 1, 2)


def test_primary_keys_from_spec(spark):
    spec = read_mapping_spec(spark, MAPPING_SPEC)
    assert catalog.primary_key_columns(spec, "orders", target=False) == ["o_orderkey"]
    assert catalog.primary_key_columns(spec, "customer") == ["customer_id"]


def test_lineage_coverage(spark):
    spec = read_mapping_spec(spark, MAPPING_SPEC)
    cat = read_variable_catalogue(spark, CATALOGUE)
    got = {r["Model_cat"]: (r["variables"], r["mapped"], r["unmapped"], r["missing_lineage_doc"])
           for r in catalog.lineage_coverage(cat, spec).collect()}
    assert got == {"Retail_IFRS9": (6, 4, 2, 4), "Retail_IRB": (3, 2, 1, 2)}
    missing = {r["Variable"] for r in catalog.unmapped_variables(cat, spec).collect()}
    assert missing == {"credit_score", "dti_ratio", "effective_maturity_years"}


def test_unsupported_transformation_rejected(spark, tmp_path):
    p = tmp_path / "spec.json"
    p.write_text('raw_json\n{"MODELLED": true, "SOURCE_TABLENAME_AWS": "t", "SOURCE_VARIABLE_AWS": "a", '
                 '"TRANSFORMATION": "lookup", "TARGET_FIELDNAME": "b", "TARGET_FIELDTYPE": "string", '
                 '"_metadata": {"row_number": 1}}\n')
    spec = read_mapping_spec(spark, str(p))
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(ValueError):
        catalog.direct_mapping(df, spec, "t")


def test_spec_from_spark_readable_uri(spark, tmp_path):
    p = tmp_path / "spec.json"
    p.write_text(open(MAPPING_SPEC).read())
    a = read_mapping_spec(spark, "file://" + str(p)).count()
    b = read_mapping_spec(spark, MAPPING_SPEC).count()
    assert a == b == 10
