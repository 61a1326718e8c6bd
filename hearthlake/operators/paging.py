"""Which pages and snapshots of a search count.

A search is one (site, city, property type), possibly per date. A single search
may hold a third of all pages, so nothing here sorts or collects a whole search:
presence is settled per (search, page) and only then reduced to one bound per
search with map-side aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthlake.operators.extract import OK
from hearthlake.operators.pick import first_per_key
from hearthlake.schemas import BRONZE_PARTITION

SEARCH = ("site", "city", "property_type")
BY_DATE = (*SEARCH, "file_date")


def latest_snapshot(snapshots: DataFrame, keys: Sequence[str] = (*BY_DATE, "page")) -> DataFrame:
    """The most recently modified snapshot of each page and date (ties: path)."""
    return first_per_key(snapshots, keys, [F.desc("modified_ts"), F.desc("blob")])


def page_bounds(df: DataFrame, start_page: int, max_page: int | None) -> DataFrame:
    """Pages from ``start_page`` to ``max_page``; no or a non-positive maximum is unbounded."""
    wanted = F.col("page") >= start_page
    if max_page is not None and max_page > 0:
        wanted &= F.col("page") <= max_page
    return df.where(wanted)


def first_missing_page(
    df: DataFrame, search: Sequence[str], start_page: int, usable: Column | None = None
) -> DataFrame:
    """Per search, the first page from ``start_page`` on that is absent or not ``usable``."""
    present = F.lit(True) if usable is None else usable
    offer = lambda page, here: F.struct(page.cast("bigint").alias("page"), here.alias("here"))
    # Every row vouches for its page and asks for the next one; the start page is
    # always asked for. A page asked for but not vouched for is missing.
    asked = df.where(F.col("page") >= start_page).select(
        *search,
        F.inline(
            F.array(
                offer(F.col("page"), present),
                offer(F.col("page") + 1, F.lit(False)),
                offer(F.lit(start_page), F.lit(False)),
            )
        ),
    )
    return (
        asked.groupBy(*search, "page")
        .agg(F.bool_or("here").alias("here"))
        .where(~F.col("here"))
        .groupBy(*search)
        .agg(F.min("page").alias("first_missing"))
    )


def before_first_missing(df: DataFrame, bounds: DataFrame, search: Sequence[str], start_page: int) -> DataFrame:
    """Pages from ``start_page`` up to the search's first missing page.

    ``bounds`` has one row per search. It is not hinted: the planner broadcasts it
    if it is small, and otherwise splits a hot search's partition at run time.
    """
    return (
        df.where(F.col("page") >= start_page)
        .join(bounds, list(search))
        .where(F.col("page") < F.col("first_missing"))
        .select(*df.columns)
    )


def contiguous_pages(
    snapshots: DataFrame, start_page: int = 1, search: Sequence[str] = BY_DATE
) -> DataFrame:
    """Drop the pages behind the first page without a snapshot."""
    bounds = first_missing_page(snapshots, search, start_page)
    return before_first_missing(snapshots, bounds, search, start_page)


def stop_at_first_empty_page(extracted: DataFrame, start_page: int = 1, search: Sequence[str] = SEARCH) -> DataFrame:
    """Drop the first page that is missing, empty or malformed, and all behind it."""
    bounds = first_missing_page(extracted, search, start_page, usable=F.col("status") == OK)
    return before_first_missing(extracted, bounds, search, start_page)


def loaded_blobs(bronze: DataFrame, file_date=None) -> DataFrame:
    """Distinct snapshot paths bronze already holds (for one date, if given)."""
    if file_date is not None:
        bronze = on_date(bronze, file_date)
    return bronze.select(F.col("SRC_BLOB").alias("blob")).distinct()


def skip_loaded(snapshots: DataFrame, loaded: DataFrame) -> DataFrame:
    """Snapshots whose path bronze does not hold yet."""
    return snapshots.join(loaded, "blob", "left_anti")


def on_date(bronze: DataFrame, file_date) -> DataFrame:
    """Bronze rows of one UTC date; prunes partitions where the table has them."""
    if BRONZE_PARTITION in bronze.columns:
        return bronze.where(F.col(BRONZE_PARTITION) == F.lit(file_date))
    return bronze.where(F.to_date("SRC_EXECUTED_AT_TS") == F.lit(file_date))
