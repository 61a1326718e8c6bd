"""Column functions. Each returns a plain Spark expression; none is a UDF."""

from hearthlake.functions.json import lenient_json, member, non_empty_object, parse_json_strict
from hearthlake.functions.keys import surrogate_key
from hearthlake.functions.numbers import round_to_long
from hearthlake.functions.text import initcap_words, parse_stem_ts, regexp_extract_or_null, site_rank

__all__ = [
    "initcap_words",
    "lenient_json",
    "member",
    "non_empty_object",
    "parse_json_strict",
    "parse_stem_ts",
    "regexp_extract_or_null",
    "round_to_long",
    "site_rank",
    "surrogate_key",
]
