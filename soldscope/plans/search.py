"""A whole product search request answered from one roll-up of the matching rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soldscope.operators import facets
from soldscope.params import Page, Search
from soldscope.session import reliable_checkpoint

CUBE_KEYS = ("shop", "snapshot_date", "brand", "model", "condition", "color")


def search_cube(sold: DataFrame, search: Search) -> DataFrame:
    """Rows of the widest scope rolled up to every key that an answer or a narrower scope needs."""
    return facets.rollup(facets.matching(sold, search.shared_scope()), *CUBE_KEYS)


def product_analysis(sold: DataFrame, search: Search) -> dict[str, DataFrame]:
    """All answers of a search. The table is scanned once; the answers read the checkpointed roll-up."""
    cube = reliable_checkpoint(sold.sparkSession, search_cube(sold, search))
    within = lambda scope: cube.where(facets.narrowing(search, scope))
    products = facets.matched_products(within(search.query_scope()))
    query_total = within(search.query_scope()).agg(F.sum("n")).scalar()
    return {
        "summary": facets.summary(within(search)),
        "trend": facets.trend(within(search)),
        "products": products,
        "top_products": facets.top_share(products, query_total),
        "scope_counts": facets.scope_counts(cube, search),
        "by_condition": facets.condition_breakdown(within(search.condition_scope())),
        "by_color": facets.color_breakdown(within(search.color_scope())),
    }


def product_samples(sold: DataFrame, search: Search, page: Page = Page()) -> DataFrame:
    return facets.sample_page(sold, search, page)


def filter_options(sold: DataFrame, search: Search) -> DataFrame:
    return facets.filter_options(sold, search)
