"""Dimension upkeep: attributes overwritten, first insert time kept, vanished keys
flagged instead of deleted."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLAG, INSERTED, UPDATED = "IN_LAST_SCRAPE_FLAG", "AUD_INS_TS", "AUD_UPD_TS"


def as_ts(run_ts: datetime | str) -> Column:
    """The run's time, one value for all rows of a run."""
    return F.lit(str(run_ts)).cast("timestamp")


def with_audit(source: DataFrame, run_ts: datetime | str) -> DataFrame:
    """First load: every row is active and inserted now."""
    return source.select("*", F.lit(True).alias(FLAG), as_ts(run_ts).alias(INSERTED), as_ts(run_ts).alias(UPDATED))


def active_rows(source: DataFrame, target: DataFrame, keys: Sequence[str], run_ts: datetime | str) -> DataFrame:
    """Source rows, with the first insert time of those the target knows."""
    known = target.select(*keys, F.col(INSERTED).alias("_first"))
    return source.join(known, list(keys), "left").select(
        *source.columns,
        F.lit(True).alias(FLAG),
        F.coalesce("_first", as_ts(run_ts)).alias(INSERTED),
        as_ts(run_ts).alias(UPDATED),
    )


def filter_active(target: DataFrame) -> DataFrame:
    return target.where(F.col(FLAG))


def deactivated_rows(source: DataFrame, target: DataFrame, keys: Sequence[str], run_ts: datetime | str) -> DataFrame:
    """Target rows that were active and are gone from the source."""
    gone = filter_active(target).join(source.select(*keys), list(keys), "left_anti")
    return gone.select(
        *source.columns, F.lit(False).alias(FLAG), F.col(INSERTED), as_ts(run_ts).alias(UPDATED)
    )


def _compare(source: DataFrame, target: DataFrame, keys: Sequence[str], run_ts: datetime | str) -> DataFrame:
    """Source and target matched once; ``_changed`` marks the rows to upsert."""
    s = source.withColumn("_in_source", F.lit(True)).alias("s")
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    on = [F.col(f"s.{k}") == F.col(f"t.{k}") for k in keys]
    here = F.col("s._in_source").isNotNull()
    was_active = F.col(f"t.{FLAG}")
    changed = here | F.coalesce(was_active, F.lit(False))
    return s.join(t, on, "full_outer").select(
        *[F.when(here, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in source.columns],
        here.alias(FLAG),
        F.coalesce(f"t.{INSERTED}", as_ts(run_ts)).alias(INSERTED),
        F.when(changed, as_ts(run_ts)).otherwise(F.col(f"t.{UPDATED}")).alias(UPDATED),
        changed.alias("_changed"),
    )


def scd1_soft_delete(source: DataFrame, target: DataFrame, keys: Sequence[str], run_ts: datetime | str) -> DataFrame:
    """Rows to upsert: ``active_rows`` and ``deactivated_rows`` in one full outer
    join, so both sides are read and shuffled once."""
    return _compare(source, target, keys, run_ts).where("_changed").drop("_changed")


def scd1_next(source: DataFrame, target: DataFrame, keys: Sequence[str], run_ts: datetime | str) -> DataFrame:
    """The dimension's whole next version: the same join, unchanged rows included,
    so that no separate merge pass is needed."""
    return _compare(source, target, keys, run_ts).drop("_changed")
