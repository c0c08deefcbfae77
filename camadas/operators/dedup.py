"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of every key in the given order.

    Spark limits each key to one row per map task before the shuffle (WindowGroupLimit), so a key
    that holds a third of the table sends one row per task, not its whole group. The order should
    be total; otherwise equal rows are interchangeable.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
