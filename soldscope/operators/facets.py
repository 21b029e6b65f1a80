"""Faceted product search: summary, daily trend, matched products, facets, options, sample pages.

Every answer is read off a roll-up of the matching rows (count, price sum, minimum, maximum per
key set). Roll-ups merge, so one roll-up on all keys can serve a whole request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soldscope.operators import predicates as P
from soldscope.operators import projections as S
from soldscope.operators.ordinal import numbered
from soldscope.operators.ordinal import page as page_of
from soldscope.params import Page, Search
from soldscope.session import written

TOP_PRODUCTS = 200
TOP_CONDITIONS = 12
TOP_COLORS = 8
LABEL_SEPARATOR = "、"
FACETS = ("color", "condition", "material", "year")


def matching(sold: DataFrame, search: Search) -> DataFrame:
    return sold.where(P.matches(search))


def rollup(rows: DataFrame, *keys: str) -> DataFrame:
    """Mergeable price figures per key set, of rows or of a finer roll-up."""
    merged = "n" in rows.columns
    n = F.sum("n") if merged else F.count("*")
    return rows.groupBy(*keys).agg(
        F.coalesce(n, F.lit(0)).alias("n"),
        F.sum("price_sum" if merged else "price").cast("decimal(28,2)").alias("price_sum"),
        F.min("price_min" if merged else "price").alias("price_min"),
        F.max("price_max" if merged else "price").alias("price_max"),
    )


def _prices() -> list[Column]:
    return [
        (F.col("price_sum").cast("double") / F.nullif(F.col("n"), F.lit(0))).alias("avg_price"),
        F.col("price_min").cast("double").alias("min_price"),
        F.col("price_max").cast("double").alias("max_price"),
    ]


def summary(rows: DataFrame) -> DataFrame:
    """One row even when nothing matches."""
    return rollup(rows).select(F.col("n").alias("sample_count"), *_prices())


def _labels_at(edge: str) -> Column:
    labels = F.collect_list(F.when(F.col(f"label_{edge}") == F.col(edge), F.col("label")))
    return F.nullif(F.array_join(F.array_sort(labels), LABEL_SEPARATOR), F.lit(""))


def _day_labels(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Figures per day and label, and per day."""
    labelled = rows.where("snapshot_date is not null").withColumn("label", S.product_label())
    per_label = rollup(labelled, "snapshot_date", "label")
    return per_label, rollup(per_label, "snapshot_date")


def edge_labels(rows: DataFrame) -> DataFrame:
    """``(snapshot_date, edge, rank, label)``: every product at a day's lowest and highest price, in order.

    The full set as rows: a day with very many products at one price is spread over tasks.
    """
    per_label, per_day = _day_labels(rows)
    edges = per_day.select("snapshot_date", F.col("price_min").alias("low"), F.col("price_max").alias("high"))
    met = per_label.where("label is not null").join(edges, "snapshot_date")
    at = lambda edge, figure: met.where(F.col(figure) == F.col(edge)).select("snapshot_date", F.lit(edge).alias("edge"), "label")
    both = written(at("low", "price_min").unionByName(at("high", "price_max")), "edges")
    placed = numbered(both, [F.col(c).asc() for c in ("snapshot_date", "edge", "label")], "place")
    first = placed.groupBy("snapshot_date", "edge").agg(F.min("place").alias("first"))
    return placed.join(first, ["snapshot_date", "edge"]).select(
        "snapshot_date", "edge", (F.col("place") - F.col("first") + 1).alias("rank"), "label"
    )


def edge_heads(labels: DataFrame, most: int) -> DataFrame:
    """For display: the first ``most`` labels of each day and edge, joined, and how many there are."""
    shown = F.array_sort(F.collect_list(F.when(F.col("rank") <= most, F.struct("rank", "label"))))
    return labels.groupBy("snapshot_date", "edge").agg(
        F.array_join(F.transform(shown, lambda x: x["label"]), LABEL_SEPARATOR).alias("labels"), F.max("rank").alias("label_count")
    )


def trend(rows: DataFrame) -> DataFrame:
    """Per day: figures and the sorted labels of the products at the day's lowest and highest price.

    Rows reduce to one per day and label first; the day's extremes then meet those labels by an
    equi-join on the day, so a day with very many rows is never gathered.
    """
    per_label, per_day = _day_labels(rows)
    edges = per_day.select(
        "snapshot_date", F.col("price_min").alias("low"), F.col("price_max").alias("high")
    )
    at_edge = (
        per_label.where("label is not null")
        .select(
            "snapshot_date",
            "label",
            F.col("price_min").alias("label_low"),
            F.col("price_max").alias("label_high"),
        )
        .join(edges, "snapshot_date")
        .where("label_low = low or label_high = high")
        .groupBy("snapshot_date")
        .agg(_labels_at("low").alias("min_price_products"), _labels_at("high").alias("max_price_products"))
    )
    return (
        per_day.join(at_edge, "snapshot_date", "left")
        .select(
            "snapshot_date",
            F.col("n").alias("item_count"),
            *_prices(),
            "min_price_products",
            "max_price_products",
        )
        .orderBy("snapshot_date")
    )


def matched_products(rows: DataFrame, top: int = TOP_PRODUCTS) -> DataFrame:
    """Most frequent products with the shops that sold them and the number of all products."""
    n = F.sum("n") if "n" in rows.columns else F.count("*")
    grouped = (
        rows.where(P.named_product())
        .groupBy("brand", "model")
        .agg(n.alias("sample_count"), F.array_sort(F.collect_set("shop")).alias("shops"))
    )
    total = grouped.agg(F.count("*")).scalar()
    return (
        grouped.orderBy(F.col("sample_count").desc(), "brand", "model")
        .limit(top)
        .select(
            "brand",
            F.col("model").alias("product_name"),
            "sample_count",
            "shops",
            total.alias("matched_product_count"),
        )
    )


def breakdown(rows: DataFrame, column: str, top: int, *, collation: str | None = None) -> DataFrame:
    """Most frequent values of a facet with their share of all rows, one decimal."""
    counted = rollup(rows.withColumn("label", S.bucket(column)), "label").select("label", F.col("n").alias("count"))
    total = counted.agg(F.sum("count")).scalar()
    first = counted.orderBy(F.col("count").desc(), "label").limit(top)
    out = first.select(
        "label", "count", (F.floor(F.col("count") / total * 1000 + 0.5) / 10).alias("percentage")
    )
    if collation:
        out = out.orderBy(F.col("count").desc(), F.collate("label", collation))
    return out


def condition_breakdown(rows: DataFrame) -> DataFrame:
    return breakdown(rows, "condition", TOP_CONDITIONS, collation="zh")


def color_breakdown(rows: DataFrame) -> DataFrame:
    return breakdown(rows, "color", TOP_COLORS)


def scope_counts(sold: DataFrame, search: Search) -> DataFrame:
    """Row counts of the query, condition and color scope in one pass over their union."""
    n = F.sum if "n" in sold.columns else F.count
    weight = F.col("n") if "n" in sold.columns else F.lit(1)
    scopes = {
        "query_scope": search.query_scope(),
        "condition_scope": search.condition_scope(),
        "color_scope": search.color_scope(),
    }
    rows = sold if "n" in sold.columns else matching(sold, search.shared_scope())
    picks = [
        F.coalesce(n(F.when(narrowing(search, scope), weight)), F.lit(0)).alias(name)
        for name, scope in scopes.items()
    ]
    return rows.agg(*picks)


def narrowing(search: Search, scope: Search) -> Column:
    """What a scope asks beyond the widest one: includes of condition and color, brand, product."""
    parts = [P.includes_any("condition", scope.conditions), P.includes_any("color", scope.colors)]
    if scope.brand:
        parts.append(F.col("brand") == scope.brand)
    if scope.product:
        parts.append(F.col("model") == scope.product)
    return P.all_of(parts)


def top_share(products: DataFrame, scope_total: Column, top: int = 5) -> DataFrame:
    """Leading products with their percentage of the scope and the combined percentage."""
    lead = products.orderBy(F.col("sample_count").desc(), "brand", "product_name").limit(top)
    percent = lambda n: F.floor(n / scope_total * 100 + 0.5).cast("long")
    combined = lead.agg(F.sum("sample_count")).scalar()
    return lead.where(scope_total > 0).select(
        "brand",
        "product_name",
        F.concat_ws(" ", F.trim("brand"), F.trim("product_name")).alias("label"),
        "sample_count",
        F.greatest(F.lit(1).cast("long"), percent(F.col("sample_count"))).alias("percentage"),
        percent(combined).alias("combined_percentage"),
    )


def filter_options(sold: DataFrame, search: Search, *, collation: str | None = "zh") -> DataFrame:
    """Selectable values per attribute under the keywords and shops only, slash lists split.

    One scan: the four attributes are unpivoted and made distinct before the lists are split.
    """
    rows = sold.where(P.in_shops(search.shops) & P.matches_keywords(search.keywords))
    pairs = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).alias("value")) for a in FACETS])
    raw = rows.select(F.inline(pairs)).where("value is not null and value <> ''").distinct()
    tokens = (
        raw.select("attribute", F.explode(F.split("value", "/")).alias("value"))
        .withColumn("value", F.trim("value"))
        .where("value <> ''")
        .distinct()
    )
    key = F.collate("value", collation) if collation else F.col("value")
    return tokens.orderBy("attribute", key)


def _newest_first() -> list[Column]:
    """Order of the samples; the id alone may repeat, so the remaining columns settle it."""
    return [
        F.col("snapshot_date").desc_nulls_last(),
        F.col("shop").asc(),
        F.col("id").desc(),
        F.col("price").desc(),
        F.col("brand").asc_nulls_last(),
        F.col("product_name").asc_nulls_last(),
        F.col("condition").asc_nulls_last(),
    ]


def placed_samples(sold: DataFrame, search: Search) -> DataFrame:
    """Shaped sample rows with their ``place`` in the order; written once, it serves every page of a request."""
    return numbered(S.sample_rows(matching(sold, search)), _newest_first())


def placed_sample_page(placed: DataFrame, number: int, size: int) -> DataFrame:
    """Page ``number`` of placed samples; the total counts the same rows."""
    total = placed.agg(F.count("*")).scalar()
    return page_of(placed, "place", size, number).drop("place").withColumn("total", total)


def sample_page(sold: DataFrame, search: Search, page: Page = Page()) -> DataFrame:
    """One page of shaped sample rows, newest first; the total counts the same rows.

    A page near the front is the head of a sort; deep pages come from ``placed_samples``.
    """
    rows = S.sample_rows(matching(sold, search))
    total = rows.agg(F.count("*")).scalar()
    return rows.orderBy(*_newest_first()).offset(page.offset).limit(page.size).withColumn("total", total)
