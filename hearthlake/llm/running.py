"""Running totals over an order of all rows, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthlake.session import Staging


def running_total(staging: Staging, df: DataFrame, order: list[str], value: str, name: str, group: str | None = None) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` up to and with each row in ``order``.

    With ``group``, which must lead ``order``, totals start anew in each group. Rows are
    range-partitioned by the order and stored; a partition's total is carried to those
    behind it, and rows are summed within their partition. A group that holds most rows
    is spread over as many partitions as it needs. Only the table of partition totals
    (one row per partition and group in it) is ordered in one place.
    Rows that tie in ``order`` get their totals in any order. An empty frame gives none.
    """
    own = [group] if group else []
    ranged = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).withColumn("_part", F.spark_partition_id())
    kept = staging.keep(ranged, name)
    totals = kept.groupBy("_part", *own).agg(F.sum(value).alias("_own"))
    before = Window.partitionBy(*(own or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("_part", *own, F.coalesce(F.sum("_own").over(before), F.lit(0)).alias("_before"))
    within = (
        Window.partitionBy("_part", *own)
        .orderBy(*[F.col(c).asc_nulls_first() for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = kept.withColumn("_within", F.sum(value).over(within))
    left, right = summed.alias("l"), carried.alias("r")
    on: Column = F.col("l._part") == F.col("r._part")
    for c in own:
        on = on & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return left.join(right, on).select(*[F.col(f"l.{c}") for c in df.columns], (F.col("_before") + F.col("_within")).alias(name))
