"""Tables beside a store stay true to the store's rows."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from soldscope.operators import facets
from soldscope.operators.catalogue import integrated_range
from soldscope.operators.trends import model_price_trend
from soldscope.params import Search
from soldscope.schema import SOLD
from soldscope.sources.rollup import PriceRollup, TitleIndex
from soldscope.sources.store import SnapshotStore

SPAN = date(2026, 1, 1), date(2026, 12, 31)


def _rows(spark, *rows):
    names = ("shop", "snapshot_date", "item_id", "brand", "model", "currency", "price")
    made = [dict(zip(names, r)) for r in rows]
    return spark.createDataFrame([tuple(r.get(f.name) for f in SOLD.fields) for r in made], SOLD)


def _row(shop, day, item, price, model="ring", brand="b"):
    return shop, date(2026, 5, day) if day else None, item, brand, model, None, None if price is None else Decimal(price)


def _same(store, prices):
    key = lambda df: sorted(map(str, df.collect()))
    for report in (
        lambda df: integrated_range(df, *SPAN, by_day=True),
        lambda df: integrated_range(df, *SPAN, detail="catalog"),
        lambda df: integrated_range(df, *SPAN),
        lambda df: model_price_trend(df, *SPAN, "ring"),
    ):
        assert key(report(prices.read())) == key(report(store.read()))


def test_rollup_follows_the_store(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "sold"))
    prices = PriceRollup(store)
    assert prices.refresh().count() == 0 and prices.read().count() == 0
    store.overwrite_dates(_rows(spark, *[_row("F", 1, str(i), i % 3) for i in range(1, 8)], _row("F", 2, "x", None), _row("V", 1, "y", 5), _row("F", None, "z", 4)))
    assert prices.refresh().count() == 4
    assert prices.read().agg(F.sum("n")).first()[0] == store.read().count()
    _same(store, prices)
    assert prices.refresh().count() == 0  # nothing changed

    store.overwrite_dates(_rows(spark, _row("F", 1, "1", 9), _row("F", 1, "2", 9)))  # overwritten
    store.overwrite_dates(_rows(spark, _row("R", 3, "3", 7), _row("R", 3, "4", 8)))  # late
    assert sorted((r.shop, r.snapshot_date.day) for r in prices.stale().collect()) == [("F", 1), ("R", 3)]
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "sold_prices" / "rows").rglob("*.parquet")}
    before = files()
    prices.refresh()
    _same(store, prices)
    kept = [p for p in before if p in files()]
    assert len(kept) == len(before) - 1  # only the overwritten date was counted anew
    assert prices.refresh().count() == 0


def test_title_index_rules_partitions_out(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "sold"))
    titles = ["Kelly Sellier 28", "Birkin 30", "Alma BB", "x"]
    store.overwrite_dates(_rows(spark, *[_row("F", d, str(d), d, titles[d % 4], "Hermès") for d in range(1, 9)], _row("V", None, "n", 3, "Kelly 25")))
    index = TitleIndex(store)
    everything = store.read()
    assert len(index.partitions(["kelly"])) == 9  # not indexed yet: all of them
    index.refresh()
    assert index.partitions(["KELLY"]) == [("F", date(2026, 5, 4)), ("F", date(2026, 5, 8)), ("V", None)]
    assert index.partitions(["kelly", "sell%28"]) == [("F", date(2026, 5, 4)), ("F", date(2026, 5, 8))]
    assert index.partitions(["bb"]) is None and index.partitions(["nowhere"]) == []
    for words in (("kelly",), ("HERM", "30"), ("a b",), ("al_a", "bb"), ("hermès x",), ("nowhere",), ("k%y", "28")):
        search = Search(keywords=words)
        rows = index.rows(words)
        assert facets.summary(facets.matching(rows, search)).collect() == facets.summary(facets.matching(everything, search)).collect()
    assert len(index.rows(["birkin"]).inputFiles()) <= len(everything.inputFiles())
    plan = index.rows(["birkin"])._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [" in plan.toString() and "2026-05-01" in plan.toString()
    store.overwrite_dates(_rows(spark, _row("R", 2, "late", 7, "Birkin 25")))
    assert ("R", date(2026, 5, 2)) in index.partitions(["kelly"])  # until it is indexed
    index.refresh()
    assert ("R", date(2026, 5, 2)) not in index.partitions(["kelly"]) and ("R", date(2026, 5, 2)) in index.partitions(["birkin"])
