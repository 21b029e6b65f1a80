"""URL work around image mirroring: what to fetch, and swapping fetched URLs in the cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soldscope.functions.urls import extract_urls, needs_login, url_key

CELLS = ("image", "image_path", "image_urls")


def urls_to_fetch(rows: DataFrame, prefix: str) -> DataFrame:
    """Each distinct URL of the image cells once, with its object key and whether it needs a login."""
    cells = F.array(*[F.coalesce(extract_urls(c), F.array().cast("array<string>")) for c in CELLS])
    return (
        rows.select(F.explode(F.flatten(cells)).alias("url"))
        .distinct()
        .select("url", url_key("url", prefix).alias("object_key"), needs_login("url").alias("needs_login"))
    )


def replace_urls(rows: DataFrame, mirrored: DataFrame, column: str, most: int | None = None) -> DataFrame:
    """Swap the URLs of each cell (the first ``most``, if given) for their mirrored form; unknown ones stay.

    Distinct cells are worked on once: their URLs meet the map by an equi-join and come back in
    cell order.
    """
    cells = rows.select(F.col(column).alias("_cell")).where("_cell is not null").distinct()
    urls = extract_urls("_cell") if most is None else F.slice(extract_urls("_cell"), 1, most)
    found = cells.select("_cell", F.posexplode(urls).alias("_at", "_url"))
    target = mirrored.groupBy(F.col("url").alias("_url")).agg(F.max("mirrored_url").alias("_new"))
    pairs = found.join(target, "_url").groupBy("_cell").agg(
        F.array_sort(F.collect_list(F.struct("_at", "_url", "_new"))).alias("_pairs")
    )
    swapped = pairs.select(
        "_cell",
        F.aggregate("_pairs", F.col("_cell"), lambda acc, p: F.replace(acc, p["_url"], p["_new"])).alias("_swapped"),
    )
    return (
        rows.join(swapped, F.col(column) == F.col("_cell"), "left")
        .withColumn(column, F.coalesce("_swapped", column))
        .drop("_cell", "_swapped")
    )
