from creditspark.llm.shared import CLEANUP, written


def test_written_tables_leave_no_shuffle_files(spark):
    before = spark.conf.get(CLEANUP, "false")
    ids = spark.range(1000).selectExpr("id % 7 AS a").repartition(5, "a").groupBy("a").count()
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    known = tracker.shuffleStatuses().size()
    assert {r["count"] for r in written(ids, "counts").collect()} == {142, 143}
    assert tracker.shuffleStatuses().size() <= known and spark.conf.get(CLEANUP, "false") == before
