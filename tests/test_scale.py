"""How jobs spread and how often they work: what keeps their cost in proportion to the rows."""

import os

from pyspark.sql import functions as F

from soldscope.plans import reformat as R
from soldscope.plans.registry import QUERIES
from soldscope.schema import SHOPS
from soldscope.session import checkpoint_root, written
from soldscope.sources import landing
from soldscope.sources.store import SnapshotStore
import soldscope.plans.registry_delivery  # noqa: F401
import soldscope.plans.registry_fields  # noqa: F401
import soldscope.plans.registry_jobs  # noqa: F401


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _part(spark, folder):
    rows = [(i, "red bag", "Brand#11", "LARGE TIN", 7, 900.0 + i) for i in range(8)]
    names = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame(rows, names).coalesce(1).write.parquet(f"{folder}/part.parquet")
    return str(folder)


def test_part_queries_are_dealt_over_tasks(spark, tmp_path):
    folder = _part(spark, tmp_path)
    for name in ("landing_records", "prepare_import", "parse_payload"):
        done = QUERIES[name](spark, folder)
        assert done.rdd.getNumPartitions() == 4, name
        assert done.count() == 8, name


def test_each_header_is_named_once(spark):
    pairs = [("ID", "1"), (None, "x"), (" ", "y"), ("品牌", "A"), ("filler", "z"), (" 品牌 ", "B")]
    schema = "shop string, file_name string, pairs array<struct<key:string,value:string>>"
    cells = spark.createDataFrame([("F", "_20260501_a.csv", pairs), ("F", "b.csv", [("ID", " ")]), ("R", "c.csv", None)], schema)
    rows = landing.records(cells)
    assert [(r.item_id, r.brand) for r in rows.collect()] == [("1", "B")]
    assert _optimized(rows).count(".key") == 1


def _titles(spark):
    rows = [("F", 1, "1", "Hermes", "Birkin 30 Noir"), ("V", 2, "2", "Hermes", "Kelly 28"), ("F", 3, "3", None, None)]
    df = spark.createDataFrame(rows, "shop string, id long, item_id string, brand string, model string")
    return df.withColumns({c: F.lit(None).cast("string") for c in ("condition", "color", "material", "year", "other", "old_data")})


def test_titles_are_parsed_before_rows_are_formatted(spark):
    done = R.format_rows(_titles(spark))
    assert done.count() == 3
    assert "Aggregate" not in _optimized(done)


def test_refill_reads_entries_twice(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.overwrite_dates(_titles(spark).withColumn("snapshot_date", F.lit("2026-05-01").cast("date")))
    read = spark.sparkContext.accumulator(0)

    def seen(table):
        read.add(1)
        return table

    entries = R.preview(store.read()).withColumn("old_data", F.when(F.col("id") != 3, F.col("old_data")))
    entries = entries.withColumn("table", F.udf(seen).asNondeterministic()("table"))
    counts = {r.shop: tuple(r)[1:] for r in R.refill(store, entries).collect()}
    assert counts == {"F": (1, 1, 1), "V": (1, 1, 0)}
    assert read.value == 6


def _shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_shuffles_of_a_write_go_with_it(spark, tmp_path):
    rows = _titles(spark).withColumn("snapshot_date", F.lit("2026-05-01").cast("date"))
    before = _shuffle_files(spark)
    written(rows.repartition(3, "id"), "dealt")
    SnapshotStore(spark, str(tmp_path / "store")).overwrite_dates(rows)
    assert _shuffle_files(spark) <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def _refilled(spark, path):
    store = SnapshotStore(spark, str(path))
    day = F.when(F.col("id") % 4 > 0, F.concat(F.lit("2026-05-0"), (F.col("id") % 4).cast("string")))
    rows = spark.range(1, 41).select(
        F.element_at(F.array(*map(F.lit, SHOPS)), (F.col("id") % 3 + 1).cast("int")).alias("shop"),
        "id",
        F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("item_id"),
        F.lit("Hermes").alias("brand"),
        F.concat(F.lit("Birkin 30 Noir "), F.col("id").cast("string")).alias("model"),
        day.cast("date").alias("snapshot_date"),
    )
    blank = F.lit(None).cast("string")
    store.overwrite_dates(rows.withColumns({c: blank for c in ("condition", "color", "material", "year", "other", "old_data")}))
    entries = R.preview(store.read())
    # an entry that comes twice, one of no stored row and some without raw fields
    entries = entries.unionByName(entries.where("id = 5")).unionByName(entries.where("id = 6").withColumn("id", F.lit(60).cast("long")))
    entries = entries.withColumn("old_data", F.when(F.col("id") % 5 != 1, F.col("old_data")))
    counts = sorted(tuple(r) for r in R.refill(store, entries).collect())
    return counts, sorted(map(str, store.read().collect()))


def test_refill_by_parts_gives_the_same_store(spark, tmp_path, monkeypatch):
    whole = _refilled(spark, tmp_path / "whole")
    assert [c[1:] for c in whole[0]] == [(11, 11, 3), (11, 11, 3), (12, 12, 2)]
    writes = []
    kept = SnapshotStore.overwrite_dates
    monkeypatch.setattr(SnapshotStore, "overwrite_dates", lambda self, rows: (writes.append(1), kept(self, rows))[1])
    monkeypatch.setattr(R, "SLICES", 3)
    monkeypatch.setattr(R, "SLICE_BYTES", 1)
    assert _refilled(spark, tmp_path / "parts") == whole
    assert len(writes) == 4


def test_refill_of_no_usable_entry_and_what_it_leaves(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "SLICE_BYTES", 1)
    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.overwrite_dates(_titles(spark).withColumn("snapshot_date", F.lit("2026-05-01").cast("date")))
    folder = checkpoint_root(spark)
    left = lambda: {n for n in os.listdir(folder) if n.startswith("refill-")} if os.path.isdir(folder) else set()
    before = left()
    entries = R.preview(store.read()).withColumn("old_data", F.when(F.col("id") > 3, F.col("old_data")))
    assert {tuple(r) for r in R.refill(store, entries).collect()} == {("F", 0, 0, 2), ("V", 0, 0, 1)}
    assert R.refill(store, entries.where("id > 3")).collect() == []
    assert store.read().where("brand = 'Hermes'").count() == 2 and left() == before


def test_rewritten_rows_are_written_as_columns(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    rows = _titles(spark).withColumns({"snapshot_date": F.lit("2026-05-01").cast("date"), "color": F.lit("['Reds']")})
    store.overwrite_dates(rows)
    folder = checkpoint_root(spark)
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    assert [tuple(r) for r in R.repair_colors(store).collect()] == [("F", 2, 2)]
    assert any(name.startswith("rewritten-") for name in set(os.listdir(folder)) - before)
    assert sorted(r.color for r in store.read().collect()) == ["['Reds']", "red", "red"]
