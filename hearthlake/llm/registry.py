"""Where the operators' queries and their SQL are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` and, where there is one, the SQL that gives the same rows."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def without_text(documents: DataFrame) -> Column:
    """All columns but text as one struct, so that no other name can clash with them."""
    rest = [F.col(f"`{c}`") for c in documents.columns if c != "text"]
    return F.struct(*rest) if rest else F.struct(F.lit(1).alias("_"))
