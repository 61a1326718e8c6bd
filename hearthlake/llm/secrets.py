"""Secrets in whole texts: wide candidates, false positives removed by a random forest.

Everything that runs on the data is a built-in function. Candidates are long tokens with a
digit and values assigned to a telling name. Findings whose format settles the matter are the
labels (a provider's key format or an assigned random value: secret; identifiers, numbers,
placeholders, words and paths: not). The forest learns from them and decides on all
candidates, by length, character transitions, dictionary coverage, path and neighbouring
words. It is fitted on counts of binned features and applied as CASE expressions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthlake.llm import trees
from hearthlake.llm.spans import candidates, count_of
from hearthlake.session import Staging

PRECISION, FOLDS, SEED = 0.95, 4, 7

# Candidate patterns, and the formats that settle a label.
TOKEN = r"(?<![A-Za-z0-9+/_.@-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{12,}+={0,2}"
ASSIGNED = r"(?i)(?<=(?:password|passwd|secret|token|api_key|apikey|api-key)[\"']?\x20{0,3}[=:]\x20{0,3}[\"']?)[^\s\"',;=:]{6,}+"
NAMES = r"(?i)password|passwd|secret|token|api.?key"
PROVIDER = (
    r"^(?:A[KS]IA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abpr]-[0-9A-Za-z-]{10,}|AIza[0-9A-Za-z_-]{35}"
    r"|sk_live_[0-9A-Za-z]{16,}|eyJ[0-9A-Za-z_-]{20,})$"
)
UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your|xxx|1234|abcd|test|todo"
COMMON = r"(?i)(?:the|and|ing|ion|user|name|page|file|data|home|index|image|view|list|item|post|time|date|page|id|www|com|net|org)"
FEATURES = ("size", "moves", "digits", "uppers", "covered", "path", "named", "quoted", "hexed", "assigned")


def generators() -> dict[str, tuple[str, Column]]:
    text = F.col("text")
    return {"token": (TOKEN, text.rlike("[0-9]")), "assigned": (ASSIGNED, text.rlike(NAMES))}


def with_features(spans: DataFrame) -> DataFrame:
    """Binned features of candidates."""
    value, before, after, n = F.col("value"), F.lower(F.col("before")), F.lower(F.col("after")), F.length("value")
    tenths = lambda part: F.least(F.floor(10 * part / n), F.lit(10)).cast("int")
    moves = F.size(F.split(value, r"(?<=[0-9])(?=[^0-9])|(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])")) - 1
    named = F.when(before.rlike(r"(?:password|passwd|secret|token|api.?key|auth|credential)[\"'\x20]{0,4}[=:]?[\"'\x20]{0,4}$"), 2).when(before.rlike("key|login|account"), 1)
    return spans.withColumns(
        {
            "size": F.least(F.floor(n / 4), F.lit(20)).cast("int"),
            "moves": tenths(moves),
            "digits": tenths(count_of(value, "[0-9]")),
            "uppers": tenths(count_of(value, "[A-Z]")),
            "covered": tenths(n - F.length(F.regexp_replace(F.regexp_replace(value, COMMON, ""), "[a-z]{4,}", ""))),
            "path": (value.contains("/").cast("int") + before.rlike("(?:https?:|www|/|\\\\)[^\\s]*$").cast("int")).cast("int"),
            "named": F.coalesce(named, F.lit(0)).cast("int"),
            "quoted": (before.rlike("[\"']$") & after.rlike("^[\"']")).cast("int"),
            "hexed": value.rlike("^[0-9a-f]+$").cast("int"),
            "assigned": before.rlike("[=:]\\s{0,3}[\"']?$").cast("int"),
        }
    )


def label() -> Column:
    """1 or 0 where a finding's format settles it, else NULL."""
    value = F.col("value")
    plain = value.rlike(UUID) | value.rlike(PLACEHOLDER) | value.rlike("^[0-9+/_=-]+$") | ~value.rlike("[0-9]") | (F.col("covered") >= 6) | (F.col("path") == 2)
    random = (F.col("named") == 2) & (F.col("digits") >= 1) & (F.col("covered") <= 4)
    return F.when(value.rlike(PROVIDER), 1).when(plain, 0).when(random, 1)


def fit(featured: DataFrame) -> Column:
    """A condition on features that holds for secrets, fitted on the findings with a label."""
    fold = F.pmod(F.crc32(F.col("value").cast("binary")), F.lit(FOLDS)).cast("int")
    labelled = featured.withColumn("label", label()).filter("label is not null").withColumn("fold", fold)
    x, ones, zeros, fold = trees.feature_counts(labelled, list(FEATURES))
    if not ones.sum():
        return F.lit(False)
    learn, held = fold != 0, fold == 0
    if not ones[learn].sum():  # all labelled secrets lie in one fold: all findings are learned from
        learn = held = np.ones(len(fold), bool)
    part = {k: v[learn] for k, v in x.items()}
    model = trees.forest(part, ones[learn], zeros[learn], SEED)
    score = np.round(sum(t.values(x, len(ones)) for t in model), 6)
    test = held if ones[held].sum() else learn
    above = trees.threshold(score[test], ones[test], zeros[test], PRECISION)
    return F.lit(False) if above is None else F.round(trees.total(model), 6) >= max(above, len(model) / 2)


def find_secrets(staging: Staging, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, candidates) of ``documents`` (doc_id, text); candidates have row, start, end, value and secret.

    Where two candidates overlap the one that begins first, and of these the longest, stays.
    NULL and empty texts have none. A provider's key format is a secret whatever else the table holds; all
    other candidates are decided by the forest.
    """
    rows, found = candidates(staging, documents, generators())
    order = Window.partitionBy("row").orderBy("start", F.col("end").desc(), "generator")
    before = F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    single = found.withColumn("apart", before <= F.col("start")).filter("apart")
    featured = staging.keep(with_features(single), "candidates")
    return rows, featured.withColumn("secret", F.col("value").rlike(PROVIDER) | fit(featured)).select("row", "start", "end", "value", "secret")


def secret_report(staging: Staging, documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_candidates, n_secrets, spans (start:end of each secret, comma-joined)."""
    rows, found = find_secrets(staging, documents.select("doc_id", "text"))
    entry = F.when(F.col("secret"), F.struct("start", "end"))
    listed = F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.concat_ws(":", e["start"], e["end"]))
    per_row = found.groupBy("row").agg(
        F.count("*").alias("n"), F.sum(F.col("secret").cast("int")).alias("hits"), F.array_join(listed, ",").alias("spans")
    )
    return rows.join(per_row, "row", "left").select(
        "doc_id",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_candidates"),
        F.coalesce("hits", F.lit(0)).cast("bigint").alias("n_secrets"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
