"""Toxicity of whole texts: a recurrent network scores every overlapping window of words.

A document's score is that of its worst window, calibrated on labelled documents.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake.llm.gru import GRAM_SLOTS, INPUT, WORD_SLOTS, Adam, Network, WordTable
from hearthlake.llm.words import alnum_words

WINDOW, STRIDE = 48, 24
#: Labelled documents used for training, of class 0 and 1, in an order that a hash of the
#: id fixes, and the longest text used.
SAMPLE, LONGEST = (3000, 1500), 20_000
#: Rounds go on until the network has been updated so often, so a small sample is seen more often.
UPDATES = 400
#: Every so many-th labelled document is kept from training to calibrate scores.
CALIBRATION = 5
HELD_OUT = 5
ROUNDS, BATCH, RATE, SEED = 5, 256, 0.03, 20_260_101
#: z values up to this are taken as chance.
BY_CHANCE = 4.0
#: Windows scored together; words whose inputs a worker keeps.
WINDOWS_TOGETHER, WORDS_KEPT = 4096, 1 << 16


def window_starts(words: int) -> np.ndarray:
    """Starts of windows that cover the text, each overlapping the next; one for a short text, none for an empty one."""
    if words <= WINDOW:
        return np.zeros(1 if words else 0, np.int64)
    starts = np.arange(0, words - WINDOW, STRIDE)
    return np.append(starts, words - WINDOW)


class Numbers:
    """Numbers for words, from 1 on, in the order in which they are met."""

    def __init__(self):
        self.of: dict[bytes, int] = defaultdict(count(1).__next__)

    def places(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(places (WINDOW, windows), document of each window, words not met before)."""
        number, seen = self.of.__getitem__, len(self.of)
        ids, starts, docs, at = [], [], [], 0
        for d, text in enumerate(texts):
            words = alnum_words(text)
            known = np.fromiter(map(number, words), np.int32, len(words))
            own = window_starts(len(words))
            starts.append(own + at)
            docs.append(np.full(len(own), d))
            if 0 < len(words) < WINDOW:
                known = np.concatenate([known, np.zeros(WINDOW - len(words), np.int32)])
            ids.append(known)
            at += len(known)
        all_ids = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        places = all_ids[start[None, :] + np.arange(WINDOW)[:, None]] if len(start) else np.zeros((WINDOW, 0), np.int32)
        return places, np.concatenate(docs) if docs else start, list(islice(self.of, seen, None))


@dataclass
class Scorer:
    """The trained network, its calibration (slope, offset) and the score of a text without words."""

    network: Network
    slope: float
    offset: float
    empty: float

    def __getstate__(self):
        return self.network, self.slope, self.offset, self.empty

    def __setstate__(self, state):
        self.network, self.slope, self.offset, self.empty = state
        self._start()

    def __post_init__(self):
        self._start()

    def _start(self):
        """Forgets all words."""
        self.numbers, self.rows = Numbers(), None

    def window_logits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(logit, document) of every window."""
        if len(self.numbers.of) > WORDS_KEPT:
            self._start()
        places, docs, new = self.numbers.places(texts)
        self._know(new)
        logits = [self.network.logits(self.rows, places[:, i : i + WINDOWS_TOGETHER]) for i in range(0, places.shape[1], WINDOWS_TOGETHER)]
        return np.concatenate(logits) if logits else np.zeros(0, np.float32), docs

    def _know(self, new: list[bytes]) -> None:
        """Adds the projected inputs of words not met before; room for more is made by doubling."""
        used = len(self.numbers.of) + 1 - len(new)
        if self.rows is None:
            pad, used = self.network.projected(np.zeros((1, self.network.p["in_f"].shape[0]), np.float32)), 1
            self.rows = tuple(np.concatenate([p, np.empty((1 << 12, p.shape[1]), p.dtype)]) for p in pad)
        need = used + len(new)
        if need > len(self.rows[0]):
            more = max(need, 2 * len(self.rows[0])) - len(self.rows[0])
            self.rows = tuple(np.concatenate([r, np.empty((more, r.shape[1]), r.dtype)]) for r in self.rows)
        if new:
            for rows, fresh in zip(self.rows, self.network.projected(self.network.inputs(WordTable.of(new))), strict=True):
                rows[used:need] = fresh

    def worst(self, texts: list[str | None]) -> np.ndarray:
        """The highest window logit of each text, NaN without words."""
        logits, docs = self.window_logits(texts)
        out = np.full(len(texts), -np.inf)
        np.maximum.at(out, docs, logits)
        return np.where(np.isneginf(out), np.nan, out)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        logit = self.worst(texts)
        calibrated = 1 / (1 + np.exp(-np.clip(self.slope * np.nan_to_num(logit) + self.offset, -30, 30)))
        # Six digits: what other texts of a batch do to the last bits does not show.
        return np.round(np.where(np.isnan(logit), self.empty, calibrated), 6)


def calibrate(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope (at least a little above 0) and offset of a weighted logistic fit by Newton steps, held near 1 and 0."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
        w = weights * p * (1 - p)
        d = weights * (p - labels)
        grad = np.array([(d * logits).sum() + 0.1 * (a - 1), d.sum() + 0.1 * b])
        curve = np.array([[(w * logits**2).sum() + 0.1, (w * logits).sum()], [(w * logits).sum(), w.sum() + 0.1]])
        step = np.linalg.solve(curve, grad)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return max(a, 1e-3), b


def associations(table: WordTable, places: np.ndarray, docs: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How surely each word slot and each n-gram slot goes with class 1: the z value of its
    share of documents, beyond what chance gives. Documents are counted one by one."""
    counts = {name: np.zeros((2, size), np.int64) for name, size in (("word", WORD_SLOTS), ("gram", GRAM_SLOTS))}
    order = np.argsort(docs, kind="stable")
    first = np.searchsorted(docs[order], np.arange(len(y) + 1))
    lengths = table.counts()
    for d in np.unique(docs).tolist():
        words = np.unique(places[:, order[first[d] : first[d + 1]]])
        words = words[words > 0] - 1
        n = lengths[words]
        grams = table.gram[np.repeat(table.first[words] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        counts["word"][int(y[d]), np.unique(table.word[words])] += 1
        counts["gram"][int(y[d]), np.unique(grams)] += 1
    n1, n0 = (max(1, int((y[np.unique(docs)] == c).sum())) for c in (1, 0))
    out = []
    for zeros, ones in counts.values():
        share = (ones + zeros + 1) / (n1 + n0 + 2)
        z = (ones / n1 - zeros / n0) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
        out.append((np.sign(z) * np.clip((np.abs(z) - BY_CHANCE) / BY_CHANCE, 0, 3)).astype(np.float32))
    return tuple(out)


def train(texts: list[str], labels: list[int], shares: tuple[float, float]) -> Scorer | None:
    """A scorer for the labelled texts, or None if one class is missing.

    The first two input features are a word's and its n-grams' association with the label; the
    others tell n-grams apart.
    Each round trains one window of every document, the one that scores highest (at first by
    association), and for class 0 another by chance.
    ``shares``: weight of a document of either class that restores its true share.
    """
    y = np.array(labels, np.float32)
    if len(set(labels)) < 2:
        return None
    rng = np.random.default_rng(SEED)
    network, adam = Network.new(SEED), Adam(RATE)
    places, docs, words = Numbers().places(texts)
    table = WordTable.of(words)
    calibration = (np.arange(len(texts)) % CALIBRATION == 0) if len(texts) >= 10 * CALIBRATION else np.zeros(len(texts), bool)
    learn = np.flatnonzero(~calibration[docs])
    word, gram = associations(table, places[:, learn], docs[learn], y)
    network.p["word"][:, 0] = word
    network.p["gram"][:, :2] = 0
    network.p["gram"][:, 1] = gram
    x = np.concatenate([np.zeros((1, INPUT), np.float32), network.inputs(table)])
    logits = x[:, :2].sum(axis=1)[places[:, learn]].max(axis=0)
    round_ = 0
    while round_ < ROUNDS or adam.step < UPDATES:
        order = learn[np.lexsort((-logits, docs[learn]))]
        top = order[np.unique(docs[order], return_index=True)[1]]
        shuffled = rng.permutation(learn[y[docs[learn]] == 0])
        by_chance = shuffled[np.unique(docs[shuffled], return_index=True)[1]]
        chosen = rng.permutation(np.concatenate([top, by_chance]))
        classes = y[docs[chosen]]
        balance = np.where(classes == 1, 0.5 / max(1e-9, classes.mean()), 0.5 / max(1e-9, 1 - classes.mean())).astype(np.float32)
        size = min(BATCH, max(32, len(chosen) // 8))
        for i in range(0, len(chosen), size):
            some = chosen[i : i + size]
            adam.update(network.p, network.gradients(x, places[:, some], classes[i : i + size], balance[i : i + size]))
        adam.rate = RATE * 0.1 ** min(1.0, adam.step / UPDATES)
        round_ += 1
        if round_ < ROUNDS or adam.step < UPDATES:
            rows = network.projected(x)
            logits = np.concatenate([network.logits(rows, places[:, learn[i : i + WINDOWS_TOGETHER]]) for i in range(0, len(learn), WINDOWS_TOGETHER)])
    prior = shares[1] * y.sum() / (shares[1] * y.sum() + shares[0] * (1 - y).sum())
    scorer = Scorer(network, 1.0, 0.0, float(min(prior, 0.49)))
    held = np.flatnonzero(calibration) if calibration.any() and len(set(y[calibration])) == 2 else np.arange(len(texts))
    worst = np.nan_to_num(scorer.worst([texts[i] for i in held]))
    scorer.slope, scorer.offset = calibrate(worst, y[held], np.where(y[held] == 1, shares[1], shares[0]))
    return scorer


def labelled_sample(documents: DataFrame, labels: DataFrame) -> tuple[list[str], list[int], tuple[float, float]]:
    """Texts and labels to learn from, and the weights of the classes.

    Only labels 0 and 1 of documents outside the held-out fifth count; a document with
    both is toxic. At most ``SAMPLE`` of either class reach the driver.
    """
    own = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    own = own.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = dict(own.groupBy("toxic").count().collect())
    by_hash = F.xxhash64(F.lit(SEED), "doc_id")
    picks = [own.filter(F.col("toxic") == c).orderBy(by_hash, "doc_id").limit(SAMPLE[c]) for c in (0, 1)]
    rows = picks[0].union(picks[1]).collect()
    spark = documents.sparkSession
    chosen = spark.createDataFrame([tuple(r) for r in rows], "doc_id bigint, toxic int")
    found = documents.select("doc_id", "text").filter(F.length("text") <= LONGEST).join(F.broadcast(chosen), "doc_id")
    found = sorted(found.select("doc_id", "text", "toxic").collect(), key=lambda r: (hash((r[0], SEED)), r[1]))
    y = [r[2] for r in found]
    shares = tuple(totals.get(c, 0) / max(1, y.count(c)) for c in (0, 1))
    return [r[1] for r in found], y, shares


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT == 0


def with_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(row, text, score) for every document; ``row`` holds all its columns but text.

    Every window of every text is scored. NULL and empty texts, and texts without a word,
    get the share of toxic documents, kept below 0.5. Without labels of both classes every
    score is 0. The network has a fixed size, whatever it learned from.
    """
    scorer = train(*labelled_sample(documents, labels))
    sent = documents.sparkSession.sparkContext.broadcast(scorer)
    rest = [F.col(f"`{c}`") for c in documents.columns if c != "text"]
    packed = documents.select((F.struct(*rest) if rest else F.struct(F.lit(1).alias("_"))).alias("row"), "text", F.lit(0.0).alias("score"))

    def score(batches):
        own = sent.value
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = part.column(1).to_pylist()
                scores = np.zeros(len(texts)) if own is None else own.scores(texts)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(scores, pa.float64())], names=part.schema.names)
        if own is not None:
            own._start()  # the worker lives on

    return packed.mapInArrow(score, packed.schema)


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 from 0.5 on)."""
    scored = with_scores(documents.select("doc_id", "text"), labels)
    doc_id = F.col("row.doc_id")
    return scored.select(
        doc_id.alias("doc_id"), F.coalesce(held_out(doc_id), F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


def accepted_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below 0.5, all columns."""
    kept = with_scores(documents, labels).filter("score < 0.5")
    return kept.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in documents.columns])
