"""Words of a text as UTF-8 byte strings, cut at C speed.

UTF-8 never uses a byte below 0x80 inside a longer character, so patterns that tell
only ASCII characters apart can be applied to bytes.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER_TO_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
ALNUM_ONLY = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
#: Words between ASCII white space, for built-in functions.
SPACED = r"[^\x20\x09-\x0D]+"


def encoded(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def spaced_words(text: str | None) -> list[bytes]:
    """`[^\\x20\\x09-\\x0D]+` of the text with A-Z lower-cased."""
    return encoded(text).translate(UPPER_TO_LOWER).split()


def alnum_words(text: str | None) -> list[bytes]:
    """`[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased."""
    return encoded(text).translate(ALNUM_ONLY).split()


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; NULL counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACED)), F.lit(0)).cast("bigint")


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scramble (shifts and odd multipliers) of unsigned values."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x


_CLEAN = re.compile(r"^file:/*")


def posix_path(uri: str) -> str:
    """The mounted path of a folder that every executor reaches; other stores are refused."""
    if uri.startswith("file:"):
        return "/" + _CLEAN.sub("", uri)
    if uri.startswith("/"):
        return uri
    raise ValueError(f"{uri}: archives and shards are written to a mounted shared folder (spark.checkpoint.dir)")
