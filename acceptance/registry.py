from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def case(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` and the SQL that gives the same rows."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(configure(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def _plain(name: str, kind: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(kind, T.DateType):
        return column.cast("string").alias(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        pair = lambda f: F.concat(F.coalesce(f["NAME"], F.lit("~")), F.lit("="), F.coalesce(f["VALUE"], F.lit("~")))
        return F.array_join(F.transform(column, pair), ";").alias(name)
    if isinstance(kind, T.ArrayType):
        return F.to_json(column).alias(name)
    if isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
        return column.cast("bigint").alias(name)
    return column


def portable(df: DataFrame) -> DataFrame:
    """Dates, times and arrays as text, so both engines print them alike."""
    return df.select(*[_plain(f.name, f.dataType) for f in df.schema.fields])
