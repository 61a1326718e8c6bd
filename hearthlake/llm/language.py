"""Language of whole texts by the cross-entropy of character models, one per language."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthlake.llm import kneser_ney as kn
from hearthlake.llm.words import posix_path
from hearthlake.session import Staging

UNKNOWN = "und"
#: Documents with this remainder of crc32(doc_id) are not learned from.
FOLDS, HELD_OUT = 4, 2
#: Rows of the models' tables in a shard, about, and the least shards (as a power of two).
SHARD_ROWS, LEAST_BITS = 1 << 20, 4
#: How much a nat per character counts when scores are formed.
SHARPNESS = 25.0
#: How many standard deviations above the mean entropy of its language a text may lie, and as
#: how many texts the deviation within all languages counts beside a language's own.
DEVIATIONS, FEW = 4.0, 20
#: A model per language from all its learned documents, and two from halves of them.
HALVES = 2
PARTS = HALVES + 1
#: Characters looked up together; counted 4-grams that a task holds before it merges them.
TOGETHER, HELD = 1 << 20, 1 << 22

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def letter_units(units: np.ndarray) -> np.ndarray:
    """Which UTF-16 units belong to letters: both halves of a pair or none, never a half alone."""
    out = letters()[units]
    first = np.flatnonzero(units[:-1] & 0xFC00 == 0xD800)
    first = first[units[first + 1] & 0xFC00 == 0xDC00]
    if len(first):
        point = 0x10000 + ((units[first].astype(np.int64) & 0x3FF) << 10) + (units[first + 1] & 0x3FF)
        out[first] = out[first + 1] = letters()[point]
    return out


def grams(text: str | None) -> np.ndarray:
    """The text's 4-grams in order: lower case, all between letters as one space, a space at each end; none without a letter."""
    if not text:
        return np.zeros(0, np.uint64)
    units = np.frombuffer(text.lower().encode("utf-16-le", "surrogatepass"), "<u2")
    letter = letter_units(units)
    if not letter.any():
        return np.zeros(0, np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first unit after a letter stands for what is between
    kept, is_letter = units[keep], letter[keep]
    line = np.full(len(kept) + 4, 32, np.uint64)
    line[3:-1] = np.where(is_letter, kept, 32)
    if not is_letter[-1]:
        line = line[:-1]
    out = line[: len(line) - 3] << np.uint64(48)
    for j, shift in ((1, 32), (2, 16), (3, 0)):
        out |= line[j : len(line) - 3 + j] << np.uint64(shift)
    return out


def _count(batches):
    held: dict[tuple[str, int], list[np.ndarray]] = {}
    merged: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
    waiting = 0

    def merge():
        for key, parts in held.items():
            codes, counts = np.unique(np.concatenate(parts), return_counts=True)
            if key in merged:
                both = np.concatenate([merged[key][0], codes])
                codes, place = np.unique(both, return_inverse=True)
                counts = np.bincount(place, np.concatenate([merged[key][1], counts])).astype(np.int64)
            merged[key] = (codes, counts)
        held.clear()

    for batch in batches:
        for lang, half, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            own = grams(text.as_py())
            if len(own):
                held.setdefault((lang, half), []).append(own)
                waiting += len(own)
        if waiting >= HELD:
            merge()
            waiting = 0
    merge()
    for (lang, half), (codes, counts) in merged.items():
        for i in range(0, len(codes), 1 << 16):
            part = codes[i : i + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(part), "half": pa.array([half] * len(part), pa.int32()), "code": part.view(np.int64), "n": counts[i : i + (1 << 16)]})


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def _with_shard(bits, batches):
    for batch in batches:
        shard = kn.shard_of(batch.column(1).to_numpy().view(np.uint64), bits)
        yield batch.append_column("shard", pa.array(shard.astype(np.int32)))


def _write_shard(folder, rows: pa.Table) -> pa.Table:
    column = lambda name: rows.column(name).to_numpy()
    shard = int(rows.column("shard")[0].as_py())
    kn.Shard.of(column("place"), column("code").view(np.uint64), column("n"), column("kinds")).save(kn.shard_place(folder, shard))
    return pa.table({"shard": pa.array([shard], pa.int32()), "rows": pa.array([len(rows)], pa.int64())})


def write_models(counts: DataFrame, folder: str) -> kn.Models:
    """The models of ``counts`` (model, code, n): every counted 4-gram and all that follows from it.

    Lower orders, contexts' totals and the numbers that discounts need are aggregates; rows
    meet by shard, a range of scrambled codes, whatever model they belong to.
    """
    tables, once = [], []
    for order in range(kn.ORDER, 0, -1):
        place = F.col("model") * kn.TABLES
        context = counts.groupBy("model", F.shiftrightunsigned("code", 16).alias("code")).agg(F.sum("n").alias("n"), F.count("*").alias("kinds"))
        own = counts.select("model", "code", "n", F.lit(0).cast("bigint").alias("kinds"))
        for rows, table in ((own, kn.grams_table(order)), (context, kn.contexts_table(order))):
            tables.append(rows.select((place + table).cast("int").alias("place"), "code", "n", "kinds"))
        once.append(counts.groupBy("model").agg(F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2), F.count("*")).select(F.lit(order), "*"))
        shorter = F.col("code").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1))
        counts = counts.groupBy("model", shorter.alias("code")).agg(F.count("*").alias("n"))
    union = lambda frames: reduce(DataFrame.unionAll, frames)
    found = union(once).collect()
    bits = max(LEAST_BITS, (2 * sum(r[4] for r in found) // SHARD_ROWS).bit_length())
    dealt = union(tables).mapInArrow(lambda b: _with_shard(bits, b), "place int, code bigint, n bigint, kinds bigint, shard int")
    dealt.groupBy("shard").applyInArrow(lambda rows: _write_shard(folder, rows), "shard int, rows bigint").collect()
    return kn.Models({(r[1], r[0]): kn.discount(r[2], r[3]) for r in found}, bits, folder)


def half() -> Column:
    """Which half of the learned documents one is in."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(HALVES)).cast("int").alias("half")


def learn(staging: Staging, documents: DataFrame) -> tuple[list[str], kn.Models]:
    """(languages, models) of ``documents`` (doc_id, lang, text), from all their texts.

    The k-th language in order of name has the models k * PARTS, from all its texts, and one
    more for each half, after it. 4-grams are counted in each task, then summed; none is
    dropped. A language, or a half of one, without a letter has no model.
    """
    counted = documents.filter("lang is not null and text is not null").select("lang", half(), "text")
    counted = counted.mapInArrow(_count, "lang string, half int, code bigint, n bigint")
    each = [F.coalesce(F.sum(F.when(F.col("half") == h, F.col("n"))), F.lit(0)) for h in range(HALVES)]
    sums = staging.keep(counted.groupBy("lang", "code").agg(F.array(F.sum("n"), *each).alias("n")), "grams")
    names = sorted(r[0] for r in sums.select("lang").distinct().collect())
    if not names:
        return names, kn.Models({})
    number = F.create_map(*[F.lit(x) for pair in zip(names, range(len(names)), strict=True) for x in pair])[F.col("lang")]
    parts = sums.select(number.alias("number"), "code", F.posexplode("n").alias("part", "n")).filter("n > 0")
    counts = parts.select((F.col("number") * PARTS + F.col("part")).alias("model"), "code", "n")
    return names, write_models(counts, posix_path(f"{staging.root}/models"))


def entropies(texts: list[str | None], models: kn.Models, chosen: list[int]) -> np.ndarray:
    """(texts, chosen models): nats per character; NaN without a letter."""
    out = np.full((len(texts), len(chosen)), np.nan)
    own, numbers, waiting = [], [], 0

    def flush():
        if not own:
            return
        lengths = np.array([len(g) for g in own])
        codes, place = np.unique(np.concatenate(own), return_inverse=True)
        first = np.cumsum(lengths) - lengths
        for m, logs in enumerate(models.logs(codes, chosen)):
            out[numbers, m] = -np.add.reduceat(logs[place], first) / lengths

    for i, text in enumerate(texts):
        g = grams(text)
        if len(g):
            own.append(g)
            numbers.append(i)
            waiting += len(g)
        if waiting >= TOGETHER:
            flush()
            own, numbers, waiting = [], [], 0
    flush()
    return out


def choose(entropy: np.ndarray, names: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, its entropy) per text: the lowest entropy, the first name at a tie; the score is its share."""
    if not names:
        return [UNKNOWN] * len(entropy), np.zeros(len(entropy)), np.full(len(entropy), np.nan)
    blank = np.isnan(entropy[:, 0])
    filled = np.where(np.isnan(entropy), 0, entropy)
    best = filled.argmin(axis=1)
    lowest = filled[np.arange(len(filled)), best]
    share = 1 / np.exp(np.clip(-SHARPNESS * (filled - lowest[:, None]), -700, 0)).sum(axis=1)
    return [UNKNOWN if b else names[k] for b, k in zip(blank, best, strict=True)], np.where(blank, 0.0, share), np.where(blank, np.nan, lowest)


def predicted(documents: DataFrame, names: list[str], models: kn.Models) -> DataFrame:
    """(doc_id, lang_pred, score, entropy) of every row of ``documents`` (doc_id, text)."""
    sent = documents.sparkSession.sparkContext.broadcast(models)

    def predict(batches):
        chosen = [k * PARTS for k in range(len(names))]
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                lang, score, lowest = choose(entropies(part.column(1).to_pylist(), sent.value, chosen), names)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "lang_pred": lang, "score": score, "entropy": pa.array(lowest, from_pandas=True)})

    return documents.select("doc_id", "text").mapInArrow(predict, "doc_id bigint, lang_pred string, score double, entropy double")


def limits(documents: DataFrame, names: list[str], models: kn.Models) -> dict[str, float]:
    """The highest accepted entropy by language, from all learned ``documents`` (doc_id, lang, text).

    Each text is measured by the model of its language from the half that it is not in. A
    limit is the mean plus ``DEVIATIONS`` deviations; the variance within all languages
    counts as ``FEW`` texts beside a language's own, so one with few texts has a limit much like
    the others'. A language of which only one half has texts gets the highest limit of the others.
    """
    sent = documents.sparkSession.sparkContext.broadcast(models)

    def measure(batches):
        numbers = {name: k for k, name in enumerate(names)}
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part, by_model = batch.slice(i, 1024), {}
                texts = part.column(2)
                for row, (lang, own) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)):
                    by_model.setdefault((lang, numbers.get(lang, -1) * PARTS + HALVES - own), []).append(row)
                for (lang, model), rows in by_model.items():
                    if (model, kn.ORDER) in sent.value.discounts:
                        entropy = entropies([texts[row].as_py() for row in rows], sent.value, [model])[:, 0]
                        yield pa.RecordBatch.from_pydict({"lang": [lang] * len(rows), "entropy": pa.array(entropy, from_pandas=True)})

    measured = documents.select("lang", half(), "text").mapInArrow(measure, "lang string, entropy double").filter("entropy is not null")
    found = measured.groupBy("lang").agg(F.count("*"), F.avg("entropy"), F.var_pop("entropy")).collect()
    pooled = sum(n * var for _, n, _, var in found) / max(1, sum(r[1] for r in found))
    out = {lang: mean + DEVIATIONS * ((n * var + FEW * pooled) / (n + FEW)) ** 0.5 for lang, n, mean, var in found}
    return {name: out.get(name, max(out.values(), default=float("inf"))) for name in names}


def identify(documents: DataFrame) -> DataFrame:
    """Per row of ``documents`` (doc_id, text, lang): doc_id, held_out, lang_pred, score, accepted.

    Learned from rows with a lang outside the held-out quarter; only the text is looked at
    for a prediction. NULL texts and texts without a letter are `und` with score 0, and so is
    every text if nothing can be learned. ``accepted``: the cross-entropy is no higher than
    the limit of the language, see ``limits``.
    """
    known = documents.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    names, models = learn(Staging(documents.sparkSession), known)
    limit = F.coalesce(*[F.when(F.col("lang_pred") == k, F.lit(float(v))) for k, v in limits(known, names, models).items()], F.lit(float("inf")))
    accepted = (F.col("lang_pred") != UNKNOWN) & (F.col("entropy") <= limit)
    return predicted(documents, names, models).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.coalesce(accepted, F.lit(False)).alias("accepted")
    )
