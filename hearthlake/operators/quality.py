"""Column tests. Each returns the failures as rows; empty means passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake.schemas import TableSpec


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, failures) for every column, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("failures")) for c in columns])
        )
    )


def unique(df: DataFrame, column: str) -> DataFrame:
    """(value, occurrences) of every non-NULL value that is not unique."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count("*").alias("occurrences"))
        .where("occurrences > 1")
    )


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """(value, occurrences) of every non-NULL value outside the list."""
    return (
        df.where(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("occurrences"))
    )


def foreign_key(
    fact: DataFrame, fact_key: Column | str, dimension: DataFrame, dimension_key: str
) -> DataFrame:
    """(value, occurrences) of every fact key the dimension lacks.

    The fact is reduced to its distinct keys first, so a hot key is one row in
    the join. An array of keys is given as an exploded column.
    """
    used = fact.select((F.col(fact_key) if isinstance(fact_key, str) else fact_key).alias("value"))
    counted = used.where("value is not null").groupBy("value").agg(F.count("*").alias("occurrences"))
    return counted.join(dimension.select(F.col(dimension_key).alias("value")), "value", "left_anti")


def foreign_keys(fact: DataFrame, keys: Mapping[str, Column], dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """(fk, value, occurrences) of every key of the fact that its dimension lacks.

    ``keys``: name -> the fact's key, or an array of keys. ``dimensions``: name -> the
    dimension's key, one column. The fact is read once: all its keys are counted together,
    so a hot key is one row in the join.
    """
    entry = lambda name, value: F.struct(F.lit(name).alias("fk"), value.alias("value"))
    named = lambda name: lambda value: entry(name, value)
    arrays = [
        F.transform(key, named(name))
        if isinstance(fact.select(key).schema[0].dataType, T.ArrayType)
        else F.array(entry(name, key))
        for name, key in keys.items()
    ]
    used = fact.select(F.inline(F.concat(*arrays))).where("value is not null")
    counted = used.groupBy("fk", "value").agg(F.count("*").alias("occurrences"))
    known = [d.select(F.lit(name).alias("fk"), F.col(d.columns[0]).alias("value")) for name, d in dimensions.items()]
    return counted.join(reduce(DataFrame.unionByName, known), ["fk", "value"], "left_anti")


def _declared(spec: TableSpec) -> list[tuple[str, str]]:
    return [
        *[("not_null", c) for c in spec.not_null],
        *[("unique", c) for c in spec.unique],
        *[("accepted_values", c) for c, _ in spec.accepted],
    ]


def _breaches(spec: TableSpec) -> Column:
    """What a row has for the tests of its table, as an array of (test, column, value): its NULLs where none may be,
    the values that must be unique, and the values outside a list. Most rows have the unique ones only."""
    entry = lambda test, c, value: F.struct(F.lit(test).alias("test"), F.lit(c).alias("column"), value.cast("string").alias("value"))
    found = [F.when(F.col(c).isNull(), entry("not_null", c, F.lit(None))) for c in spec.not_null]
    found += [F.when(F.col(c).isNotNull(), entry("unique", c, F.col(c))) for c in spec.unique]
    found += [F.when(~F.col(c).isin(*values), entry("accepted_values", c, F.col(c))) for c, values in spec.accepted]
    return F.array_compact(F.array(*found))


def run_contract(df: DataFrame, spec: TableSpec) -> DataFrame:
    """(test, column, failures) for every test a table declares, from one pass over it.

    Failures are rows for ``not_null``, repeated values for ``unique`` and strange values for ``accepted_values``.
    Entries are counted per (test, column, value), within each task before they are shuffled, so a value that most
    rows have is one row; then per (test, column).
    """
    counted = df.select(F.inline(_breaches(spec))).groupBy("test", "column", "value").agg(F.count("*").alias("n"))
    weight = F.when(F.col("test") == "not_null", F.col("n")).when((F.col("test") == "unique") & (F.col("n") == 1), 0).otherwise(1)
    failed = counted.groupBy("test", "column").agg(F.sum(weight).alias("failures"))
    names = [F.struct(F.lit(test).alias("test"), F.lit(c).alias("column")) for test, c in _declared(spec)]
    tests = df.sparkSession.range(1).select(F.inline(F.array(*names)))
    return tests.join(failed, ["test", "column"], "left").select("test", "column", F.coalesce("failures", F.lit(0)).alias("failures"))


def run_contracts(tables: Mapping[TableSpec, DataFrame]) -> DataFrame:
    """(table, test, column, failures) for every test of several tables; each table is read once."""
    parts = [run_contract(df, spec).select(F.lit(spec.name).alias("table"), "test", "column", "failures") for spec, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
