"""Personal data in whole texts: wide generators, boosted trees, calibrated thresholds.

Everything that runs on the data is a built-in function. Base spans (exact patterns and
their checks) always count. Wider generators propose more spans, which may overlap; boosted
trees score them by format and context. Labels come from what is no feature: a candidate within a
base span of its kind, or with the check sum of an account number, is one; one within a span of
another kind, or with a failing check sum, or that is a date or a book number, is none. A phone number's plus sign and
country code, by which base spans are known, are cut off before its features are taken. Each kind has
a threshold of its own, the lowest that keeps the wanted precision on held-out candidates;
a kind without such a threshold adds nothing. Trees are fitted on counts of binned features over all
labelled candidates and applied as CASE expressions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthlake.llm import trees
from hearthlake.llm.spans import candidates, count_of, digits
from hearthlake.session import Staging

KINDS = ("email", "ip", "card", "phone")
#: Kinds that only wide generators find; they come after the others.
ADDED_KINDS = ("iban",)
PRECISION = 0.95
FOLDS = 4

# The base patterns. A run of name characters or digits is entered only at its
# start (or where the last match ended) and never given back, which finds the same matches
# in linear time.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Wider patterns: addresses with written-out signs, numbers with separators, numbers grouped
# like phone numbers, account numbers, addresses of version 6. Digits within a word are no number.
WIDE_EMAIL = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:@|\x20?[\[({]at[\])}]\x20?)[A-Za-z0-9-]{1,63}+"
    r"(?:(?:\.|\x20?[\[({]dot[\])}]\x20?)[A-Za-z0-9-]{1,63}+){1,8}+"
)
WIDE_NUMBER = r"(?<![0-9A-Za-z_])\+?\(?[0-9](?:[\x20()./-]{0,3}+[0-9]){6,19}+(?![0-9A-Za-z_])"
SPOKEN_EMAIL = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20(?:at|AT)\x20[A-Za-z0-9-]{1,63}+(?:\x20(?:dot|DOT)\x20[A-Za-z0-9-]{1,63}+){1,8}+"
)
GROUPED_NUMBER = (
    r"(?<![0-9A-Za-z_+.(-])(?:\+?[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20./-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9A-Za-z_]|[.-][0-9])"
)
ACCOUNT = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
IPV6 = (
    r"(?<![0-9A-Za-z:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])"
)
#: Wide generators: the kind of their spans and their number as a feature, those of a kind side by side.
WIDE = {
    "wide_email": ("email", 0),
    "wide_spoken": ("email", 1),
    "wide_account": ("iban", 2),
    "wide_ipv6": ("ip", 3),
    "wide_grouped": ("phone", 4),
    "wide_number": ("phone", 5),
}
#: A country code in front of a number, with or without its sign.
COUNTRY = r"^(?:\+(?:[0-9]{1,3}[\x20.-]+)?|[0-9]{1,3}[\x20.-]*(?=\())"
DATE = r"^(?:[0-9]{4}[./-][01]?[0-9][./-][0-3]?[0-9]|[0-3]?[0-9][./-][01]?[0-9][./-][0-9]{4})(?:[^0-9].*)?$"

IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
FEATURES = ("wide", "n_digits", "n_seps", "n_groups", "paren", "dots", "dashes", "letters", "word", "edge", "size")


def generators() -> dict[str, tuple[str, Column]]:
    text = F.col("text")
    number = text.rlike("[0-9]")
    written = text.rlike(r"[\[({]at[\])}]")
    return {
        "email": (EMAIL, text.contains("@")),
        "ip": (IP, number & text.contains(".")),
        "card": (CARD, number),
        "phone": (PHONE, text.contains("+") & number),
        "wide_email": (WIDE_EMAIL, text.contains("@") | written),
        "wide_number": (WIDE_NUMBER, number),
        "wide_grouped": (GROUPED_NUMBER, number),
        "wide_spoken": (SPOKEN_EMAIL, F.lower(text).contains(" dot ")),
        "wide_account": (ACCOUNT, number),
        "wide_ipv6": (IPV6, text.contains(":")),
    }


def luhn(number: Column) -> Column:
    """True if the digits pass the check sum."""
    back = F.reverse(number)
    digit = lambda i: F.substring(back, i, F.lit(1)).cast("int")
    add = lambda total, i: total + F.when(i % 2 == 0, digit(i) * 2 - F.when(digit(i) > 4, 9).otherwise(0)).otherwise(digit(i))
    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def account_holds(value: Column) -> Column:
    """True if an account number's check digits are right: letters count from 10, the whole leaves 1 modulo 97."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.left(plain, F.lit(4))), "")
    step = lambda rest, c: F.when(c.rlike("[0-9]"), rest * 10 + F.ascii(c) - 48).otherwise(rest * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(F.filter(turned, lambda c: c != ""), F.lit(0), step) == 1


def book_number(number: Column) -> Column:
    """True for thirteen digits that begin like a book's and have its check sum."""
    weighted = lambda rest, i: rest + F.substring(number, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 3).otherwise(1)
    return number.rlike("^97[89][0-9]{10}$") & (F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), weighted) % 10 == 0)


def passes(kind: Column, value: Column) -> Column:
    """Whether a match of a base pattern passes its kind's check."""
    n = F.length(digits(value))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", value.rlike(IP_PARTS))
        .when(kind == "card", F.when(n.between(12, 19), luhn(digits(value))).otherwise(False))
        .when(kind == "phone", n.between(9, 15))
        .otherwise(False)
    )


def with_features(spans: DataFrame) -> DataFrame:
    """Binned format and context features of candidates; none tells whether a number had a plus sign."""
    before, after = F.lower(F.col("before")), F.col("after")
    value = F.regexp_replace("value", COUNTRY, "")
    capped = lambda column, most: F.least(column, F.lit(most)).cast("int")
    word = (
        F.when(before.rlike(r"(?:phone|tel|call|fax|mobile|whatsapp|sms)[^a-z]{0,12}$"), 3)
        .when(before.rlike(r"(?:mail|contact|write|reach)[^a-z]{0,12}$"), 2)
        .when(before.rlike(r"(?:id|no|nr|order|invoice|version|date|isbn|page)[^a-z]{0,4}$"), 1)
        .otherwise(0)
    )
    open_left = (F.length("before") == 0) | F.col("before").rlike(r"[\s\"'(<:,;]$")
    open_right = (F.length("after") == 0) | after.rlike(r"^[\s\"')>.,;:!?]")
    return spans.withColumns(
        {
            "wide": sum((F.when(F.col("generator") == name, number).otherwise(0) for name, (_, number) in WIDE.items()), F.lit(0)).cast("int"),
            "n_digits": capped(count_of(value, "[0-9]"), 20),
            "n_seps": capped(count_of(value, r"[\x20()./-]"), 8),
            "n_groups": capped(F.size(F.split(F.regexp_replace(value, "^[^0-9]+", ""), "[^0-9]+")), 8),
            "paren": value.contains("(").cast("int"),
            "dots": capped(count_of(value, r"\."), 4),
            "dashes": capped(count_of(value, "-"), 4),
            "letters": capped(F.floor(count_of(value, "[A-Za-z]") / 4), 8),
            "word": word,
            "edge": open_left.cast("int") + open_right.cast("int"),
            "size": capped(F.floor(F.length(value) / 4), 16),
        }
    )


def label() -> Column:
    """1 or 0 where a candidate's place or a check of its format settles it, else NULL."""
    value, generator = F.col("value"), F.col("generator")
    number = F.col("kind") == "phone"
    return (
        F.when(generator == "wide_account", account_holds(value).cast("int"))
        .when(generator == "wide_ipv6", F.when(~value.contains("::"), 1).when(~value.rlike("[0-9]"), 0))
        .when(F.col("within_own"), 1)
        .when(F.col("within_other"), 0)
        .when(number & (value.rlike(DATE) | book_number(digits(value))), 0)
    )


def fit(labelled: DataFrame) -> Column:
    """A condition on features and kind: the candidates to add. ``labelled`` has FEATURES, label and fold.

    Precision is counted as if a kind's labels were at most half ones: their share tells nothing of the free candidates'.
    """
    x, ones, zeros, fold = trees.feature_counts(labelled, list(FEATURES))
    learn = fold != 0
    if not ones[learn].sum():
        return F.lit(False)
    part = {k: v[learn] for k, v in x.items()}
    model = trees.boosted(part, ones[learn], zeros[learn])
    score = np.round(sum(t.values(x, len(ones)) for t in model), 6)
    taken = F.lit(False)
    for kind in sorted({kind for kind, _ in WIDE.values()}):
        held = ~learn & np.isin(x["wide"], [number for own, number in WIDE.values() if own == kind])
        even = max(1.0, ones[held].sum() / max(zeros[held].sum(), 1.0))
        above = trees.threshold(score[held], ones[held], zeros[held] * even, PRECISION) if ones[held].sum() else None
        if above is not None:
            taken = taken | ((F.col("kind") == kind) & (F.round(trees.total(model), 6) >= above))
    return taken


def find_spans(staging: Staging, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): spans have row, kind, start, end, value, base (True for base spans).

    ``documents``: doc_id, text. NULL and empty texts have none. Added spans meet no base span
    and no wide span taken that begins before them, nor a shorter one that begins with them. A candidate that a
    check rules out is never added. Equal rows are told apart by their number.
    """
    rows, found = candidates(staging, documents, generators())
    wide = F.col("generator").startswith("wide_")
    checked = found.withColumn("valid", wide | passes(F.col("generator"), F.col("value")))
    # A wide candidate meets a base span if one that begins before its end ends behind its start.
    in_order = Window.partitionBy("row").orderBy("start", "end")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    behind = in_order.rowsBetween(1, Window.unboundedFollowing)
    kind = F.coalesce(*[F.when(F.col("generator") == name, own) for name, (own, _) in WIDE.items()], F.col("generator"))
    is_base = ~wide & F.col("valid")
    base_end, base_start = F.when(is_base, F.col("end")), F.when(is_base, F.col("start"))
    up_to = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reaches = lambda kinds: F.coalesce(F.max(F.when(F.col("generator").isin(*kinds), base_end)).over(up_to), F.lit(-1)) >= F.col("end")
    met = checked.withColumn("kind", kind).withColumns(
        {
            "meets": (F.coalesce(F.max(base_end).over(before), F.lit(-1)) > F.col("start"))
            | (F.coalesce(F.min(base_start).over(behind), F.lit(2**62)) < F.col("end")),
            "within_own": F.when(F.col("kind") == "email", reaches(["email"])).when(F.col("kind") == "phone", reaches(["phone"])).otherwise(False),
            "within_other": F.when(F.col("kind") == "email", reaches(["ip", "card", "phone"])).when(F.col("kind") == "phone", reaches(["ip", "card"])).otherwise(False),
        }
    )
    met = staging.keep(met.filter("valid"), "met")
    featured = with_features(met.filter(wide)).withColumn("label", label())
    keep = fit(featured.filter("label is not null").withColumn("fold", F.pmod(F.crc32(F.col("value").cast("binary")), F.lit(FOLDS)).cast("int")))
    added = featured.filter(keep & ~F.col("meets") & F.coalesce(F.col("label") != 0, F.lit(True)))
    first = F.coalesce(F.max("end").over(before), F.lit(-1)) <= F.col("start")
    added = added.withColumn("first", first).filter("first")
    columns = ["row", "kind", "start", "end", "value"]
    return rows, met.filter(~wide).select(*columns, F.lit(True).alias("base")).unionByName(added.select(*columns, F.lit(False).alias("base")))


def personal_data(staging: Staging, documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans (all spans), n_added (those of the wide generators)."""
    rows, spans = find_spans(staging, documents.select("doc_id", "text"))
    place = F.array_position(F.array(*map(F.lit, KINDS + ADDED_KINDS)), F.col("kind"))
    name = F.concat_ws(":", "kind", "start", "end")
    entry = F.struct("start", place.alias("place"), "end", name.alias("name"))
    listed = lambda items: F.array_join(F.transform(F.array_sort(items), lambda e: e["name"]), ",")
    counts = [F.sum(F.when(F.col("base") & (F.col("kind") == k), 1).otherwise(0)).alias(f"n_{k}") for k in KINDS]
    per_row = spans.groupBy("row").agg(
        *counts,
        F.count("*").alias("n_spans"),
        F.count_if(~F.col("base")).alias("n_added"),
        listed(F.collect_list(F.when(F.col("base"), entry))).alias("base"),
        listed(F.collect_list(entry)).alias("spans"),
    )
    out = rows.join(per_row, "row", "left")
    return out.select(
        "doc_id",
        *[F.coalesce(F.col(f"n_{k}"), F.lit(0)).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce(F.col("base"), F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce(F.col("spans"), F.lit("")).alias("spans"),
        *[F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n) for n in ("n_spans", "n_added")],
    )


def redacted(staging: Staging, documents: DataFrame) -> DataFrame:
    """``documents`` (doc_id, text) with each span's characters replaced by its kind in brackets.

    The text is cut at the spans' merged places and put together again, with built-in functions.
    """
    numbered = staging.keep(documents.select("doc_id", "text", F.monotonically_increasing_id().alias("own")), "texts")
    rows, spans = find_spans(staging, numbered.select(F.col("own").alias("doc_id"), "text"))
    spans = spans.join(rows.withColumnRenamed("doc_id", "own"), "row").drop("row").withColumnRenamed("own", "row")
    numbered = numbered.withColumnRenamed("own", "row")
    reach = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("from", F.greatest("start", F.coalesce(F.max("end").over(reach), F.lit(0)))).filter(F.col("from") < F.col("end"))
    cuts = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("from", "end", "kind"))).alias("cuts"))
    text = F.col("text")
    cut = lambda c, i: F.concat(
        F.substring(text, F.when(i == 0, 0).otherwise(F.col("cuts")[i - 1]["end"]).cast("int") + 1, (c["from"] - F.when(i == 0, F.lit(0)).otherwise(F.col("cuts")[i - 1]["end"])).cast("int")),
        F.lit("["), F.upper(c["kind"]), F.lit("]"),
    )
    tail = F.substring(text, F.element_at("cuts", -1)["end"].cast("int") + 1, F.length(text))
    clean = F.concat(F.array_join(F.transform("cuts", cut), ""), tail)
    return numbered.join(cuts, "row", "left").select("doc_id", F.when(F.col("cuts").isNull(), text).otherwise(clean).alias("text"))
