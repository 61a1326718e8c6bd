from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthlake.schemas import OTHER_SITE_RANK, SITE_RANK

# Fixed value: a word starts after white space or any of these characters.
_AFTER_DELIMITER = r'(?<=[\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+-])'

# Fixed value: how a snapshot file is named after its run time.
STEM_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def initcap_words(text: Column) -> Column:
    """Capitalise every word. Unlike ``F.initcap`` words also end at punctuation."""
    words = F.split(F.lower(text), _AFTER_DELIMITER)
    capital = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))
    return F.array_join(F.transform(words, capital), "")


def regexp_extract_or_null(text: Column, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` with NULL, not an empty string, where nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def site_rank(site: Column) -> Column:
    rank = F.lit(OTHER_SITE_RANK)
    for name, value in reversed(SITE_RANK.items()):
        rank = F.when(site == name, F.lit(value)).otherwise(rank)
    return rank


def parse_stem_ts(stem: Column) -> Column:
    """Run time held in a snapshot's file name; NULL where it does not parse."""
    return F.try_to_timestamp(stem, F.lit(STEM_FORMAT))
