import brute
import pytest
from conftest import frame
from test_native import leak_rows, overlaps
from test_tokens_and_packing import check_pieces

import corpus_pipeline
from creditspark.llm import oracle, queries

SF = "/root/testdata/sf0.001"


def test_names():
    found = queries.queries()
    assert [n.split("_")[0] for n in found] == [f"op{i}" for i in range(1, 14)]
    assert set(oracle.oracle_sql()) <= set(found)


def test_entry_has_them_all():
    import __spark_entry__

    assert set(queries.queries()) | {"pipeline"} <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", list(queries.queries()))
def test_whole_tables(spark, name):
    got = queries.queries()[name](spark, SF)
    if name.startswith("op11"):
        assert got.count() == got.select("word").distinct().count() > 500
        return
    rows = spark.read.parquet(f"{SF}/{'pages' if name.startswith('op5') else 'documents'}.parquet").count()
    assert got.count() >= rows if name.startswith(("op8", "op12")) else got.count() == rows


@pytest.mark.parametrize("name", list(oracle.oracle_sql()))
def test_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(oracle.oracle_sql()[name]).df()
    got = queries.queries()[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda df: sorted(df[sorted(df.columns)].astype(str).itertuples(index=False, name=None))
    assert rows(got) == rows(want)


def test_stages(spark, tmp_path):
    """Each stage on its predecessor's rows, as the pipeline writes them, against brute force."""
    docs, rows = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            rows[k] = sorted((r.doc_id, r.text) for r in docs.collect())
    assert len(rows[0]) > 100
    assert rows[1] == sorted(brute.edit_groups(rows[0]).items())
    assert [d for d, _ in rows[2]] == sorted(d for d, (_, c) in brute.simhash_groups(rows[1]).items() if c == d)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert rows[3] == [(d, t) for d, t in rows[2] if not any(overlaps(t, x) for _, x in items)]
    check_pieces(rows[3], docs.collect())
    again = corpus_pipeline.run(spark, SF).collect()
    check_pieces(rows[3], again)
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_keep_clean_documents(spark):
    docs, items = leak_rows()
    clean = [(d, t) for d, t in docs if not any(overlaps(t, x) for _, x in items)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    from creditspark.llm.decontamination import without_benchmark

    assert sorted(r.doc_id for r in without_benchmark(frame(spark, docs), bench).collect()) == [d for d, _ in clean]
