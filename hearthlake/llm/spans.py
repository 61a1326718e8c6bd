"""Matches of patterns with their places and surroundings, from built-in functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthlake.session import Staging

#: Characters kept before and after a match.
BEFORE, AFTER = 40, 12


def matches(text: Column, pattern: str, when: Column) -> Column:
    """Array of (value, gap, before, after) of the leftmost non-overlapping matches, in order.

    ``gap`` is the number of characters since the last match. Only texts that fulfil ``when``
    are searched; the others, and NULL, have no match. The pattern must not match nothing.
    """
    values, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    own = lambda value, i: F.struct(
        value.alias("value"),
        F.length(gaps[i]).alias("gap"),
        F.right(gaps[i], F.lit(BEFORE)).alias("before"),
        F.left(gaps[i + 1], F.lit(AFTER)).alias("after"),
    )
    return F.when(when, F.transform(values, own)).otherwise(F.array().cast("array<struct<value:string,gap:int,before:string,after:string>>"))


def candidates(staging: Staging, documents: DataFrame, generators: dict[str, tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): every row of ``documents`` (doc_id, text) with a number ``row``; a span for each match.

    ``generators``: name -> (pattern, condition on the text). Spans have row, doc_id, generator,
    value, start, end (code points, end exclusive), before and after. Texts are read once;
    places are running sums over the matches of one text and generator.
    """
    text = F.col("text")
    found = [matches(text, pattern, F.coalesce(when, F.lit(False))).alias(name) for name, (pattern, when) in generators.items()]
    kept = staging.keep(documents.select("doc_id", F.monotonically_increasing_id().alias("row"), *found), "matches")
    some = kept.filter(reduce(lambda a, b: a | b, [F.size(name) > 0 for name in generators]))
    named = F.array(*[F.struct(F.lit(name).alias("generator"), F.col(name).alias("own")) for name in generators])
    each = some.select("doc_id", "row", F.explode(named).alias("g")).select("doc_id", "row", "g.generator", F.posexplode("g.own").alias("place", "m"))
    up_to = Window.partitionBy("row", "generator").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("m.gap") + F.length("m.value")).over(up_to)
    placed = each.select("doc_id", "row", "generator", "m.value", end.alias("end"), "m.before", "m.after")
    return kept.select("doc_id", "row"), placed.withColumn("start", F.col("end") - F.length("value"))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def count_of(value: Column, pattern: str) -> Column:
    return F.length(value) - F.length(F.regexp_replace(value, pattern, ""))
