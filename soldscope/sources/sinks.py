"""Small result outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHOWN_ROWS = 100


def shown(df: DataFrame, rows: int = SHOWN_ROWS) -> DataFrame:
    """First rows of a result as text, NULL as empty."""
    return df.limit(rows).select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])
