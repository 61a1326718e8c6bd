"""JSON as VARIANT: parse once, then read members without parsing again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_json(text: Column) -> Column:
    """VARIANT, or NULL where ``text`` does not start with a JSON value."""
    return F.try_parse_json(text)


def parse_json_strict(texts: Column) -> Column:
    """Array of JSON texts -> array of VARIANT, NULL for every text that is not
    exactly one JSON value.

    ``try_parse_json`` ignores what follows the first value, so each text is
    parsed as the first of two array elements: stray content then either breaks
    the array or changes its length. Two transforms, because a lambda that
    mentioned the parsed value twice would parse twice.
    """
    wrapped = F.transform(
        texts,
        lambda t: F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), t, F.lit(',"end"]'))), "$", "array<variant>"),
    )
    return F.transform(wrapped, lambda w: F.when(F.size(w) == 2, F.get(w, F.lit(0))))


def member(value: Column, path: str, as_type: str) -> Column:
    """Typed member of a VARIANT; NULL where absent, JSON null or not castable.

    Numbers are read through the variant cast, so ``2.0`` is a bigint and
    ``"2000"`` a double.
    """
    return F.try_variant_get(value, path, as_type)


def non_empty_object(value: Column, path: str) -> Column:
    """True where ``path`` holds an object with at least one member."""
    return F.coalesce(F.size(member(value, path, "map<string,variant>")) > 0, F.lit(False))
