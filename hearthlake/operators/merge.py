"""Keyed upsert and column sync on plain files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake.operators.pick import first_per_key


class DuplicateKeyError(ValueError):
    """Several source rows claim the same target row."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).count().where("count > 1")


def require_mergeable(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail loudly where several source rows would update one target row.

    Repeated keys the target does not hold are inserted side by side, as on a
    first load. Runs a job: pass a materialised source.
    """
    clash = duplicate_keys(source, keys).join(target.select(*keys), list(keys), "left_semi").head(1)
    if clash:
        raise DuplicateKeyError(f"more than one source row for {clash[0].asDict()}")
    return source


class SchemaConflictError(TypeError):
    """A column or nested field has kinds of values that cannot be kept in one type."""


#: Types in which a narrower one's values are kept exactly.
_WIDER = [(T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.FloatType, T.DoubleType), (T.ByteType, T.ShortType, T.IntegerType, T.DoubleType)]


def _merged_type(old: T.DataType, new: T.DataType, path: str) -> T.DataType:
    """The new type, with whatever is wider in the old one; nested fields likewise."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merged_schema(old, new, f"{path}.")
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(_merged_type(old.elementType, new.elementType, f"{path}[]"))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(new.keyType, _merged_type(old.valueType, new.valueType, f"{path}[]"))
    if old == new:
        return new
    for chain in _WIDER:
        if type(old) in chain and type(new) in chain:
            return max(old, new, key=lambda kind: chain.index(type(kind)))
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        scale = max(old.scale, new.scale)
        digits = max(old.precision - old.scale, new.precision - new.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    raise SchemaConflictError(f"{path}: {old.simpleString()} and {new.simpleString()}")


def merged_schema(old: T.StructType, new: T.StructType, path: str = "") -> T.StructType:
    """The columns of ``new`` (those only in ``old`` go), each wide enough for both."""
    have = {f.name: f.dataType for f in old}
    return T.StructType(
        [T.StructField(f.name, _merged_type(have[f.name], f.dataType, path + f.name) if f.name in have else f.dataType) for f in new]
    )


def _conformed(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return value
    if isinstance(want, T.StructType):
        kinds = {f.name: f.dataType for f in have}
        fields = [
            (_conformed(value[f.name], kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name) for f in want
        ]
        return F.when(value.isNotNull(), F.struct(*fields)).otherwise(F.lit(None).cast(want))
    if isinstance(want, T.ArrayType):
        return F.transform(value, lambda e: _conformed(e, have.elementType, want.elementType)).cast(want)
    if isinstance(want, T.MapType):
        return F.transform_values(value, lambda _, v: _conformed(v, have.valueType, want.valueType)).cast(want)
    return value.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly these columns: what it lacks, also within structs and arrays of structs, is NULL,
    what it has beyond them goes, narrower numbers are widened."""
    have = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            (_conformed(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def sync_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """Give ``target`` the columns of ``source``: new ones are NULL, vanished ones go, at any depth. A type is
    widened where either side needs it."""
    return conform(target, merged_schema(target.schema, source.schema))


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], on_duplicate: Sequence[Column] | None = None
) -> DataFrame:
    """Target after the merge: source rows, plus target rows whose key is not in source.

    ``on_duplicate`` (an ordering) keeps the first source row of a repeated key.
    Without it the caller checks for ambiguous keys, see ``require_mergeable``.
    """
    if on_duplicate is not None:
        source = first_per_key(source, keys, on_duplicate)
    schema = merged_schema(target.schema, source.schema)
    kept = conform(target.join(source.select(*keys), list(keys), "left_anti"), schema)
    return kept.unionByName(conform(source, schema))
