"""Row predicates as Columns, composed by callers so that the scan can push them down."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from soldscope.params import Search, ordered_range, resolve_shops, split_keywords


def all_of(parts: Iterable[Column]) -> Column:
    parts = list(parts)
    return reduce(and_, parts) if parts else F.lit(True)


def any_of(parts: Iterable[Column]) -> Column:
    parts = list(parts)
    return reduce(or_, parts) if parts else F.lit(False)


def in_range(start: date, end: date, column: str = "snapshot_date") -> Column:
    """Closed range; reversed bounds are swapped."""
    lo, hi = ordered_range(start, end)
    return F.col(column).between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))


def in_open_range(start: date | str | None, end: date | str | None, column: str = "snapshot_date") -> Column:
    """Inclusive range whose bounds may each be absent."""
    parts = []
    if start:
        parts.append(F.col(column) >= F.lit(start).cast("date"))
    if end:
        parts.append(F.col(column) <= F.lit(end).cast("date"))
    return all_of(parts)


def shop_days(days: dict[str, date | None]) -> Column:
    """One date per shop; a shop without a date yields no rows."""
    return any_of(
        (F.col("shop") == shop) & (F.col("snapshot_date") == F.lit(day).cast("date"))
        for shop, day in days.items()
        if day is not None
    )


def title_contains(keyword: str, column: str = "model") -> Column:
    """Case-insensitive; ``%`` and ``_`` typed by the user stay wildcards."""
    return F.col(column).ilike(f"%{keyword.strip()}%")


def search_text() -> Column:
    return F.concat(F.coalesce("brand", F.lit("")), F.lit(" "), F.coalesce("model", F.lit("")))


def matches_keywords(keywords: Iterable[str] | str) -> Column:
    if isinstance(keywords, str):
        keywords = split_keywords(keywords)
    return all_of(search_text().ilike(f"%{k}%") for k in keywords)


def includes_any(column: str, values: Iterable[str]) -> Column:
    """At least one value is contained; NULL never matches."""
    values = [v.strip() for v in values if v.strip()]
    return any_of(F.trim(column).ilike(f"%{v}%") for v in values) if values else F.lit(True)


def excludes_all(column: str, values: Iterable[str]) -> Column:
    """No value is contained; NULL passes."""
    values = [v.strip() for v in values if v.strip()]
    text = F.coalesce(F.trim(column), F.lit(""))
    return all_of(~text.ilike(f"%{v}%") for v in values)


def has_price(column: str = "price") -> Column:
    return F.col(column).isNotNull() & (F.col(column) > 0)


def in_shops(codes: Iterable[str] | None) -> Column:
    return F.col("shop").isin(*resolve_shops(codes))


def on_dates(dates: Iterable[date | None] | None, column: str = "snapshot_date") -> Column:
    """Member of a date set that may contain NULL; an empty or absent set does not filter."""
    wanted = set(dates or ())
    if not wanted:
        return F.lit(True)
    concrete = sorted(d for d in wanted if d is not None)
    parts = [F.col(column).isin(*concrete)] if concrete else []
    if None in wanted:
        parts.append(F.col(column).isNull())
    return any_of(parts)


def is_list_literal(column: str = "brand") -> Column:
    return F.col(column).startswith("[")


def list_valued_color(column: str = "color") -> Column:
    return F.col(column).rlike(r"^\[")


def named_product() -> Column:
    """Brand and title both present and not empty."""
    return (
        F.col("brand").isNotNull()
        & (F.col("brand") != "")
        & F.col("model").isNotNull()
        & (F.col("model") != "")
    )


def lacks_image() -> Column:
    """Image columns blank: both of a two-column shop, the single one otherwise."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    return F.when(F.col("shop") == "V", blank("image")).otherwise(blank("image_urls") & blank("image_path"))


def matches(search: Search) -> Column:
    """All filters of a search together, priced rows only."""
    parts = [in_shops(search.shops), has_price()]
    if search.start or search.end:
        parts.append(in_open_range(search.start, search.end))
    if search.keywords:
        parts.append(matches_keywords(search.keywords))
    for column, include, exclude in (
        ("color", search.colors, search.exclude_colors),
        ("condition", search.conditions, search.exclude_conditions),
        ("material", search.materials, search.exclude_materials),
        ("year", search.years, search.exclude_years),
    ):
        if include:
            parts.append(includes_any(column, include))
        if exclude:
            parts.append(excludes_all(column, exclude))
    if search.brand:
        parts.append(F.col("brand") == search.brand)
    if search.product:
        parts.append(F.col("model") == search.product)
    return all_of(parts)


def in_partitions(partitions: Iterable[tuple[str, date | None]]) -> Column:
    """Rows of the given (shop, date) partitions: plain conditions on the partition columns, so they prune."""
    by_shop: dict[str, list[date | None]] = {}
    for shop, day in partitions:
        by_shop.setdefault(shop, []).append(day)
    parts = [
        (F.col("shop") == shop) & any_of([F.col("snapshot_date").isin([d for d in days if d is not None]), F.lit(None in days) & F.col("snapshot_date").isNull()])
        for shop, days in by_shop.items()
    ]
    return any_of(parts) if parts else F.lit(False)
