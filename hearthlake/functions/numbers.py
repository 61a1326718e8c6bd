from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to_long(number: Column) -> Column:
    """Nearest integer, halves away from zero (a plain cast would cut off)."""
    return F.round(number).cast("bigint")
