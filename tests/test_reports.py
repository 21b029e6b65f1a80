"""Reports and search on a fixture of edge rows, and against the SQL oracle at the smallest scale."""

import math
import os
import statistics
from datetime import date

import pytest
from pyspark.sql import functions as F

import oracle
from __spark_entry__ import entry, oracle_sql, queries
from conftest import TESTDATA
from soldscope import params
from soldscope.operators import catalogue, coverage, facets, images, lexicon, pairing, parse_results, projections, trends
from soldscope.plans import comparisons, named_sql, search
from soldscope.sources.sinks import shown

SCHEMA = (
    "shop string, id long, item_id string, brand string, model string, condition string, price decimal(18,2), "
    "color string, material string, year string, currency string, image string, image_path string, "
    "image_urls string, snapshot_date date"
)
D = date(2026, 5, 10)


def row(shop, id, brand, model, condition, price, color=None, currency=None, day=D, image=None):
    from decimal import Decimal

    return (shop, id, str(id), brand, model, condition, None if price is None else Decimal(price), color, None, None, currency, image, None, None, day)


@pytest.fixture(scope="module")
def sold(spark):
    rows = [
        row("F", 1, None, "kelly", "", "10", "blue/white"),
        row("F", 2, "", "kelly", None, "20", "blue"),
        row("F", 3, "h", "100%_wool", "A", None, None),
        row("F", 4, "h", "kelly", "A", "0", "red"),
        row("F", 5, "h", "kelly", "A", "7.50", "red", day=None),
        row("F", 6, None, None, "A", "10", " "),
        row("R", 7, "", "kelly", "", "30", "red", day=date(2026, 5, 12)),
        row("R", 8, "h", "kelly", "A", "12.25", "red", day=date(2026, 5, 8)),
        row("R", 9, "h", "kelly", "A", "1", "red", day=date(2026, 5, 13)),
        row("V", 10, "h", "kelly", "A", "5", "red", "—", image="see https://a.com/1.jpg, x"),
        row("V", 11, "h", "kelly", "A", "6", "red", None),
        row("V", 12, "h", "kelly", "A", "9", "red", "USD"),
    ]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.mark.parametrize("metrics", [catalogue.price_metrics_with_median, catalogue.price_metrics_wide])
def test_median_against_brute_force(spark, metrics):
    rows = [(k, None if i % 11 == 0 else (i * i * 37 % 100003) / 100) for k in "abc" for i in range(ord(k) - 96, 400, ord(k) - 95)]
    rows += [("hot", float(i % 7)) for i in range(999)] + [("none", None)]
    df = spark.createDataFrame(rows, "k string, price double").withColumn("price", F.col("price").cast("decimal(18,2)"))
    out = {r.k: r for r in metrics(df, ["k"]).collect()}
    for k in {r[0] for r in rows}:
        prices = [p for key, p in rows if key == k and p is not None]
        assert out[k].item_count == sum(1 for key, _ in rows if key == k)
        if not prices:
            assert out[k].median_price is None and out[k].avg_price is None
            continue
        assert math.isclose(out[k].median_price, statistics.median(prices), abs_tol=1e-6)
        assert math.isclose(float(out[k].total_price), sum(prices), abs_tol=1e-4)


def test_nearest_date(spark):
    cases = [
        (date(2025, 3, 1), ["2025-02-28"], "2025-02-28"),
        (date(2025, 3, 1), ["2025-02-26"], "2025-02-26"),
        (date(2025, 3, 1), ["2025-02-25"], None),
        (date(2025, 3, 1), [], None),
        (date(2025, 3, 1), ["2025-02-20", "2025-02-28", "2025-03-03"], "2025-02-28"),
        (date(2025, 3, 10), ["2025-03-13", "2025-03-07"], "2025-03-07"),
    ]
    for anchor, dates, want in cases:
        df = spark.createDataFrame([(d,) for d in dates], "s string").select(F.col("s").cast("date").alias("snapshot_date"))
        got = pairing.nearest_date(df, anchor).first().paired_date
        assert (got.isoformat() if got else None) == want
        anchors = spark.createDataFrame([(anchor,)], "snapshot_date date")
        every = pairing.nearest_dates(anchors, df).first().paired_date
        assert (every.isoformat() if every else None) == want


def test_compare_two_keys_and_unpaired(sold):
    out = comparisons.compare_two(sold, D)
    rows = out.collect()
    assert {str(r.r_date) for r in rows} == {"2026-05-08"}
    assert {(r.brand, r.model, r.condition, r.f_item_count, r.r_item_count) for r in rows} == {
        (None, "kelly", "", 1, None), ("", "kelly", None, 1, None), ("h", "100%_wool", "A", 1, None),
        ("h", "kelly", "A", 1, 1), (None, None, "A", 1, None),
    }
    assert comparisons.compare_two(sold, date(2026, 5, 20)).count() == 0
    # NULL and '' match each other and fan out
    fan = comparisons.compare_two(sold.withColumn("snapshot_date", F.lit(D)), D)
    assert fan.where("model = 'kelly' and r_item_count = 1 and coalesce(brand, '') = ''").count() == 2


def test_compare_reference(sold):
    left = comparisons.compare_reference(sold, D)
    assert {(r.shop, r.currency, r.shop_item_count) for r in left.collect()} == {
        ("竞品F", c, 1) for c in ("—", None, "USD")
    } | {("竞品R", c, 1) for c in ("—", None, "USD")}
    full = comparisons.compare_reference(sold, D, how="full")
    assert full.count() == left.count() + 4
    assert comparisons.compare_reference(sold, date(2026, 6, 20)).count() == 0


def test_named_sql_agrees(spark, sold):
    plain = lambda df: sorted(str([float(v) if hasattr(v, "quantize") else v for v in r]) for r in df.collect())
    assert plain(named_sql.run_named(spark, sold, "shop_comparison", D)) == plain(comparisons.compare_two(sold, D))
    assert plain(named_sql.run_named(spark, sold, "reference_comparison", D)) == plain(comparisons.compare_reference(sold, D))
    for text in ("select {{anchor_date}}::date as d", "select :'anchor_date'::date as d"):
        assert named_sql.run_named(spark, sold, text, D).first().d == D


def test_trend_keeps_null_and_dash_apart(sold):
    out = trends.model_price_trend(sold, D, date(2026, 5, 1), " KEL_Y ")
    day = [(r.currency, r.item_count, float(r.total_price)) for r in out.where(F.col("snapshot_date") == D).collect()]
    assert sorted(day) == [("USD", 1, 9.0), ("—", 1, 5.0), ("—", 3, 36.0)]
    kpi = trends.period_summary(out).first()
    assert (kpi.item_count, kpi.snapshot_days, float(kpi.min_price)) == (6, 2, 5.0)
    assert [r.currency for r in trends.currencies(out).collect()] == ["USD", "—"]
    assert trends.chart_by_currency(out, "USD").count() == 1
    assert projections.for_delivery(out).columns[0] == "快照日期"


def test_range_and_missing_day(sold):
    assert catalogue.integrated_single(sold, {"F": D, "R": None, "V": None}, detail="catalog").where("shop <> 'F'").count() == 0
    spans = catalogue.integrated_range(sold, D, date(2026, 5, 1)).where("shop = 'R'").collect()
    assert [(r.brand, r.snapshot_days) for r in spans] == [("h", 1)]


def test_coverage(spark, sold):
    bounds = {r.shop: (r.min_date, r.max_date) for r in coverage.table_bounds(sold.where("shop <> 'R'")).collect()}
    assert bounds["R"] == (None, None) and bounds["all"] == (D, D)
    totals = {r.shop: r.row_count for r in coverage.shop_totals(sold.where("shop <> 'R'")).collect()}
    assert totals == {"F": 6, "R": 0, "V": 3, "total": 9}
    one = spark.createDataFrame([("F", date(2026, 5, 1)), ("F", date(2026, 5, 21))], "shop string, snapshot_date date")
    w = coverage.default_window(coverage.table_bounds(one), 30).first()
    assert (w.start_date, w.end_date) == (date(2026, 5, 1), date(2026, 5, 21))
    assert coverage.default_window(coverage.table_bounds(one.limit(0)), 30).selectExpr("datediff(end_date, start_date) d").first().d == 30
    first = coverage.snapshot_summary(sold, 1).where("shop = 'F'").collect()
    assert [r.snapshot_date for r in first] == [None]


def test_search_edges(sold):
    find = lambda **k: {r.id for r in facets.matching(sold, params.Search(**k)).select("id").collect()}
    assert find(colors=("white",)) == {1}
    assert 6 in find(exclude_colors=("red", "blue"))
    assert find(keywords=("KELLY", "h"), shops=("v", "x")) == {10, 11, 12}
    assert find(keywords=("k_lly",), shops=("R",)) == {7, 8, 9}
    assert find(brand="h", product="kelly", shops=("F",)) == {5}
    out = {str(r.snapshot_date): r for r in facets.trend(facets.matching(sold, params.Search())).collect()}
    assert "None" not in out
    assert (out["2026-05-10"].min_price_products, out["2026-05-10"].max_price_products) == ("h kelly", "kelly")
    assert facets.summary(facets.matching(sold, params.Search())).first().sample_count == 10
    page = facets.sample_page(sold, params.Search(), params.Page(1, 100)).collect()
    assert len(page) == 9 and {r.total for r in page} == {9}
    assert [r.image_url for r in page if r.id == 10] == ["https://a.com/1.jpg"]
    assert [r.label for r in page if r.id == 6] == ["—"]
    options = {(r.attribute, r.value) for r in facets.filter_options(sold, params.Search(keywords=("kelly",))).collect()}
    assert {("color", "blue"), ("color", "white"), ("color", "red")} <= options


def test_analysis_agrees_with_direct_answers(sold):
    s = params.Search(keywords=("kelly",), colors=("red",), conditions=("A",), brand="h", product="kelly")
    got = search.product_analysis(sold, s)
    rows = lambda df: [tuple(map(str, r)) for r in df.collect()]
    assert rows(got["summary"]) == rows(facets.summary(facets.matching(sold, s)))
    assert rows(got["trend"]) == rows(facets.trend(facets.matching(sold, s)))
    assert rows(got["products"]) == rows(facets.matched_products(facets.matching(sold, s.query_scope())))
    assert rows(got["scope_counts"]) == rows(facets.scope_counts(sold, s))
    assert rows(got["by_condition"]) == rows(facets.condition_breakdown(facets.matching(sold, s.condition_scope())))
    assert rows(got["by_color"]) == rows(facets.color_breakdown(facets.matching(sold, s.color_scope())))
    assert got["top_products"].first().percentage == 100
    assert search.product_analysis(sold, params.Search(keywords=("nothing",)))["summary"].first().sample_count == 0


def test_request_parsing():
    s = params.parse_search({"q": ["a b，c,d "], "color": [" red ", ""], "start": [" "], "brand": ["x"]})
    assert (s.keywords, s.colors, s.start, s.brand) == (("a", "b", "c", "d"), ("red",), None, "x")
    assert params.parse_page({"page": ["0"], "pageSize": ["500"]}) == params.Page(1, 100)
    assert params.parse_page({"page": ["3x"], "pageSize": ["z"]}) == params.Page(3, 20)
    assert params.resolve_shops([" v", "q"]) == ("V",) and params.resolve_shops([]) == ("F", "R", "V")


def test_payload_and_reuse(spark):
    body = '```json\n{"tokens": [{"text": "Hermes", "role": "brand"}, {"text": "Birkin", "role": "model"}, {"text": "with", "role": "odd"}, {"text": " ", "role": "model"}, {"text": "35", "role": "SIZE"}, {"text": "Sellier", "role": "modifier"}], "material": "null", "model": null, "color": " N/A ", "other": ""}\n```'
    df = spark.createDataFrame([(1, body), (2, "[1]"), (3, None), (4, '{"model": "x  y"}')], "i int, p string")
    out = {r.i: r.f for r in df.select("i", parse_results.result_fields(parse_results.payload("p")).alias("f")).collect()}
    assert (out[1].model, out[1].material, out[1].color, out[1].other) == ("Birkin 35", None, None, "Sellier")
    assert [t.role for t in out[1].tokens] == ["brand", "model", "other", "size", "modifier"]
    assert out[2] is None and out[3] is None and out[4].model == "x y"
    results = spark.createDataFrame(
        [("hermes", "birkin 35", None, None, '{"model": "old"}', 1.0), ("Hermes ", " Birkin 35", None, None, '{"model": "new"}', 2.0)],
        "brand string, title string, color string, condition string, payload string, created_at double",
    )
    asked = spark.createDataFrame(
        [("Hermes", "Birkin 35", None, None), ("Hermes", "Birkin 35", "black", "A"), ("x", "y", None, None)],
        "brand string, title string, color string, condition string",
    )
    hit = parse_results.attach_results(asked, results)
    assert sorted((r.hit_level, r.result_model) for r in hit.collect()) == [("exact", "new"), ("none", None), ("title", "new")]
    assert parse_results.open_requests(hit).count() == 1


def test_lexicon(spark, tmp_path):
    (tmp_path / "words.txt").write_text("# note\n Deep Sea Blue \nrose gold\n", encoding="utf-8")
    lex = lexicon.read_lexicon(spark, str(tmp_path / "words.txt"))
    assert lex.count() == 9
    titles = spark.createDataFrame([("Alma Deep Sea, Blue",), ("Alma deepsea blue",), ("Rose Gold Kelly",)], "title string")
    hits = {r.title: r.lexicon_words for r in lexicon.lexicon_hits(titles, lex).collect()}
    assert hits == {"Alma Deep Sea, Blue": ["deep sea blue"], "Rose Gold Kelly": ["rose gold"]}
    words = ["Ring"] * 30 + ["deep"] * 30 + ["Neon"] * 30 + ["ABC"] * 30 + ["Noirmont"] * 30 + ["WOC"] * 30 + ["travel"] * 30 + ["dark"] * 30 + ["Pivoine"] * 9 + ["Rare"] * 7 + ["Bag"] * 30 + ["MM"] * 30 + ["Ecru"] * 9
    df = spark.createDataFrame([(f"Some {w}",) for w in words], "title string")
    report = lexicon.new_words(lexicon.mine_tail_words(df, lexicon.default_skip_words(spark)), lex)
    assert [r.word for r in report.collect()] == ["ABC", "dark", "Neon", "Noirmont", "Ecru"]
    assert {r.word for r in lexicon.words_to_add(report).collect()} == {"dark", "Noirmont"}
    lexicon.write_report(report, str(tmp_path / "report"))
    lexicon.append_words(report, str(tmp_path / "added"))
    assert spark.read.text(str(tmp_path / "added")).count() == 5


def test_lexicon_in_titles(spark):
    from soldscope.plans.reformat import format_rows

    lex = spark.createDataFrame([("sunset blaze", "Sunset Blaze")], "word string, phrase string")
    rows = spark.createDataFrame([("F", "h", "Alma BB Sunset Blaze", None, None, None, None, None)], "shop string, brand string, model string, condition string, color string, material string, other string, old_data string")
    out = format_rows(rows, lexicon=lex).first()
    assert (out.new_model, out.new_color) == ("alma bb", "sunset blaze")


def test_url_swap(spark):
    df = spark.createDataFrame([("a https://x.com/1.png; https://x.com/2.png",), (None,), ("none",)], "cell string")
    seen = spark.createDataFrame([("https://x.com/1.png", "m1")], "url string, mirrored_url string")
    assert {r.cell for r in images.replace_urls(df, seen, "cell").collect()} == {"a m1; https://x.com/2.png", None, "none"}


def test_shown(spark):
    df = spark.range(150).select("id", F.lit(None).cast("string").alias("x"))
    out = shown(df)
    assert out.count() == 100 and out.first().x == ""


@pytest.mark.skipif(not os.path.isdir(f"{TESTDATA}/sf0.001"), reason="test tables missing")
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracle(spark, name):
    sf = f"{TESTDATA}/sf0.001"
    assert oracle.compare(queries()[name](spark, sf), oracle.connect(sf), oracle_sql()[name]) is None


@pytest.mark.skipif(not os.path.isdir(f"{TESTDATA}/sf0.001"), reason="test tables missing")
def test_entry(spark):
    assert entry(spark).count() > 0
