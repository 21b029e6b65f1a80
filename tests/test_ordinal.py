"""Places of rows in a total order."""

import random

from pyspark.sql import functions as F

from soldscope.operators.ordinal import numbered, page


def _rows(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([None, 1, 2, 3, 500]), i % 7) for i in range(n)]
    return spark.createDataFrame(rows + [(9, 9)] * n, "a int, b int").repartition(5)


def test_places_follow_the_order(spark):
    df = _rows(spark, 2_000)
    got = sorted(numbered(df, [F.col("a").desc_nulls_last(), F.col("b").asc()]).collect(), key=lambda r: r.place)
    assert [r.place for r in got] == list(range(1, 4_001))
    order = [(r.a is None, -(r.a or 0), r.b) for r in got]
    assert order == sorted(order)


def test_equal_rows_are_spread_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        held = numbered(_rows(spark, 4_000).select("b"), [F.col("b").asc()])
        parts = held.inputFiles()
        assert len(parts) == 4 and max(spark.read.parquet(p).count() for p in parts) < 4_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_pages_are_filters(spark):
    df = numbered(_rows(spark, 100), [F.col("a").asc_nulls_first(), F.col("b").desc()])
    assert sorted(r.place for r in page(df, "place", 30, 7).collect()) == list(range(181, 201))
    assert page(df, "place", 30, 8).count() == 0
    assert numbered(df.limit(0), [F.col("a").asc()], "p").count() == 0
