from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what stands between the parts of a key.
SEPARATOR = "||"


def surrogate_key(*parts: Column | str, arrays: tuple[Column | str, ...] = ()) -> Column:
    """MD5 hex of the joined parts. A NULL counts as empty text and keeps its
    place (``concat_ws`` would drop it); array parts are written as JSON."""

    def as_column(part: Column | str) -> Column:
        return F.col(part) if isinstance(part, str) else part

    texts = [as_column(p).cast("string") for p in parts] + [F.to_json(as_column(a)) for a in arrays]
    pieces: list[Column] = []
    for text in texts:
        pieces += [F.lit(SEPARATOR), F.coalesce(text, F.lit(""))]
    return F.md5(F.concat(*pieces[1:]))
