"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[Column | str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order.

    Planned as a window with a group limit: each task keeps one row per key
    before the shuffle, so a key that holds a third of all rows sends one row per
    map task, not its rows. ``order_by`` must end in a unique column for a
    repeatable choice.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def at_latest(df: DataFrame, date_col: str = "SCRAPE_DATE") -> DataFrame:
    """Rows of the latest date in ``df``.

    The maximum is a scalar subquery (partial and final aggregate), evaluated
    before the scan and applied as a partition filter. A ``max() over ()`` would
    move the whole relation into one task.
    """
    latest = df.agg(F.max(date_col)).scalar()
    return df.where(F.col(date_col) == latest)
