"""Nearest neighbours by multi-index hashing of learned binary codes.

Vectors are turned by learned rotations and their signs kept as codes. A code is split into
substrings; a code within radius r of the query's has at least one substring within
r / (number of substrings), so probing each substring's index finds all of them. What is
within the radius is ranked by cosine on the original vectors, in double precision.

The index is kept in shards, each with its substrings; queries go to all shards in
blocks, and each shard returns its best few per query.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake.llm.jaccard import Batches
from hearthlake.session import Staging

K, EVERY = 5, 50
#: Rotations learned, steps of each, substring bits.
ROTATIONS, STEPS, SUB_BITS = 4, 30, 16
#: Rows the rotations and the radius are fitted on, by a hash of the id, and queries among them.
SAMPLE, TRIALS = 20_000, 400
#: Trial queries that meet the sample at once; the sample is cut off by this many leading bits of the hash.
TRIAL_BLOCK, PLACE_BITS = 40, 12
#: Share of the sample's true neighbours that the radius takes in.
REACH = 0.97
SHARD_ROWS, BLOCK_QUERIES = 8192, 2048
SEED = 11


@dataclass
class Codes:
    """Learned rotations and the search radius in bits."""

    mean: np.ndarray
    rotations: list[np.ndarray]
    radius: int = 0

    def of(self, unit: np.ndarray) -> np.ndarray:
        """(rows, substrings) of 16-bit substrings of the codes of unit vectors."""
        bits = np.concatenate([(unit - self.mean) @ r > 0 for r in self.rotations], axis=1)
        pad = -bits.shape[1] % SUB_BITS
        bits = np.concatenate([bits, np.zeros((len(bits), pad), bool)], axis=1)
        return np.packbits(bits, axis=1).view(">u2").astype(np.uint16)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors, each times a power of two, so that squares neither overflow nor vanish; cosines stay the same to the last bit."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0.0))
    return np.ldexp(vectors, -exponent[:, None])


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    return vectors / np.linalg.norm(vectors, axis=1)[:, None]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(rows of a, rows of b) Hamming distances."""
    out = np.zeros((len(a), len(b)), np.uint16)
    for j in range(a.shape[1]):
        out += np.bitwise_count(a[:, j, None] ^ b[None, :, j])
    return out


def learn(vectors: np.ndarray) -> Codes:
    """Rotations that bring the sample's signs close to its values, each from its own start, and the radius.

    The radius takes in ``REACH`` of the true nearest of sample rows among the sample. In the
    whole table neighbours are no farther than in a sample of it.
    """
    unit = unit_vectors(vectors)
    mean = unit.mean(axis=0)
    centred, rng, size = unit - mean, np.random.default_rng(SEED), unit.shape[1]
    rotations = []
    for _ in range(ROTATIONS):
        turn = np.linalg.qr(rng.standard_normal((size, size)))[0]
        for _ in range(STEPS):
            u, _, v = np.linalg.svd(centred.T @ np.where(centred @ turn > 0, 1.0, -1.0))
            turn = u @ v
        rotations.append(turn)
    codes = Codes(mean, rotations)
    trials = rng.permutation(len(unit))[:TRIALS]
    own, parts = codes.of(unit), []
    for some in np.split(trials, range(TRIAL_BLOCK, len(trials), TRIAL_BLOCK)):
        cosine = unit[some] @ unit.T
        cosine[np.arange(len(some)), some] = -np.inf
        nearest = np.argsort(-cosine, axis=1)[:, : min(K, len(unit) - 1)]
        parts.append(np.take_along_axis(distances(own[some], own), nearest, axis=1))
    apart = np.concatenate(parts)
    codes.radius = int(np.quantile(apart, REACH, method="higher")) if apart.size else 0
    return codes


def _words(codes: np.ndarray) -> np.ndarray:
    """(words, rows): the substrings four at a time, so that bits are counted in few steps."""
    return np.ascontiguousarray(np.pad(codes, ((0, 0), (0, -codes.shape[1] % 4))).view(np.uint64).T)


@dataclass
class Shard:
    """Some rows with the substrings of their codes."""

    ids: np.ndarray
    vectors: np.ndarray
    codes: np.ndarray
    #: No id comes twice here.
    single: bool

    @classmethod
    def of(cls, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray) -> Shard:
        return cls(ids, vectors, codes, len(np.unique(ids)) == len(ids))

    def packed(self) -> bytes:
        """To be kept and sent; vectors that single precision holds to the last bit take half the room."""
        narrow = self.vectors.astype(np.float32)
        return pickle.dumps(replace(self, vectors=narrow if (narrow == self.vectors).all() else self.vectors), protocol=5)

    @classmethod
    def unpacked(cls, data: bytes) -> Shard:
        own = pickle.loads(data)
        return replace(own, vectors=own.vectors.astype(np.float64, copy=False))

    def distinct(self, rows: np.ndarray) -> int:
        """How many ids some rows have."""
        return len(rows) if self.single else len(np.unique(self.ids[rows]))

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """The rows' values by substring, and their whole codes by word."""
        return np.ascontiguousarray(self.codes.T), _words(self.codes)

    def within(self, code: np.ndarray, radius: int, tables) -> np.ndarray:
        """All rows whose code is within ``radius``: some substring is within its share of it."""
        substrings, words = tables
        rows = np.flatnonzero(np.bitwise_count(substrings ^ code[:, None]).min(axis=0, initial=SUB_BITS) <= radius // len(code))
        return rows[np.bitwise_count(words.take(rows, axis=1) ^ _words(code[None])).sum(axis=0, dtype=np.uint16) <= radius]

    def nearest(self, query_id: int, vector: np.ndarray, code: np.ndarray, radius: int, k: int, tables) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cosines) of the best ``k`` ids within the radius, which grows until there are ``k`` or no more."""
        others = self.distinct(np.flatnonzero(self.ids != query_id))
        while True:
            rows = self.within(code, radius, tables)
            rows = rows[self.ids[rows] != query_id]
            if self.distinct(rows) >= min(k, others):
                break
            radius += self.codes.shape[1]
        own = self.vectors[rows]
        cosine = (own * vector).sum(axis=1) / (np.sqrt((own * own).sum(axis=1)) * np.sqrt((vector * vector).sum()))
        best = np.lexsort((self.ids[rows], -cosine))
        if not self.single:  # one answer an id: its best row
            best = best[np.sort(np.unique(self.ids[rows[best]], return_index=True)[1])]
        best = best[:k]
        return self.ids[rows[best]], cosine[best]


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector of floats where the column has these, else of doubles) of the rows that take part.

    Vectors that are null, empty, zero, hold a null or non-finite part, or have not the most
    common length take no part, nor do rows without id.
    """
    single = embeddings.schema["embedding"].dataType == T.ArrayType(T.FloatType(), embeddings.schema["embedding"].dataType.containsNull)
    vector = F.col("embedding").cast(f"array<{'float' if single else 'double'}>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = embeddings.select("vec_id", vector.alias("v")).filter(F.col("vec_id").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0))
    sizes = good.groupBy(F.size("v").alias("size")).count().orderBy(F.col("count").desc(), "size").first()
    return good.filter(F.size("v") == (sizes[0] if sizes else 0))


def first_by_hash(staging: Staging, good: DataFrame, rows: int) -> np.ndarray:
    """The vectors of the first ``rows`` rows of ``usable`` by a hash of the id, in that order.

    An ordered limit that is collected would have every task send its own first ``rows`` to the driver, so what the
    driver holds would grow with the table. Here rows are counted by the hash's leading bits, only those up to the
    place that holds the last one wanted are put in order, by the executors, and the driver reads the result.
    """
    keyed = good.select(F.xxhash64("vec_id").alias("h"), "vec_id", "v")
    place = F.shiftright("h", 64 - PLACE_BITS)
    counts = sorted(keyed.groupBy(place.alias("place")).count().collect())
    reached = np.cumsum([r["count"] for r in counts])
    last = counts[min(int(np.searchsorted(reached, rows)), len(counts) - 1)]["place"]
    first = staging.keep(keyed.filter(place <= last).orderBy("h", "vec_id", "v").limit(rows), "sample").toArrow()
    order = np.lexsort([first[c].to_numpy() for c in ("vec_id", "h")])
    return first["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(order), -1)[order]


def _packed(frame: pd.DataFrame, codes: Codes) -> bytes:
    vectors = scaled(np.stack(frame["v"].to_numpy()).astype(np.float64))
    return Shard.of(frame["vec_id"].to_numpy(), vectors, codes.of(unit_vectors(vectors))).packed()


def _search(k, radius, batches):
    for batch in batches:
        for row in range(batch.num_rows):
            shard, queries = (Shard.unpacked(batch.column(c)[row].as_py()) for c in range(2))
            tables, out = shard.tables(), []
            for query_id, vector, code in zip(queries.ids.tolist(), queries.vectors, queries.codes, strict=True):
                ids, cosines = shard.nearest(query_id, vector, code, radius, k, tables)
                out.append((np.full(len(ids), query_id), ids, cosines))
            columns = [np.concatenate([o[i] for o in out]) for i in range(3)]
            yield pa.RecordBatch.from_pydict(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))


def search(staging: Staging, embeddings: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row whose id is divisible by ``every``.

    All rows of other ids are candidates; fewer than ``k`` ids are all returned. Ties go to the
    smaller vec_id. Rows may repeat an id: each of its vectors is a candidate, and one answer per query and
    id is returned, the best; a query whose id has several vectors is asked once, with the least of them. An
    empty table gives no row.
    """
    spark = staging.spark
    good = staging.keep(usable(embeddings).dropDuplicates(["vec_id", "v"]), "vectors")
    n = good.count()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    codes = learn(first_by_hash(staging, good, SAMPLE).astype(np.float64))
    sent = spark.sparkContext.broadcast(codes)
    questions = good.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    n_queries = questions.count()
    shards, blocks = -(-n // SHARD_ROWS), max(1, -(-n_queries // BLOCK_QUERIES))
    pack = lambda frame: pd.DataFrame({"shard": [frame["shard"].iloc[0]], "data": [_packed(frame, sent.value)]})
    dealt = good.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.col("v").cast("array<double>")), F.lit(shards)))
    index = staging.keep(dealt.groupBy("shard").applyInPandas(pack, "shard bigint, data binary"), "index")
    asked = questions.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    queries = staging.keep(asked.groupBy("shard").applyInPandas(pack, "shard bigint, data binary"), "queries")
    # Every shard meets every block where it lies: a join by shard would write each block once a shard.
    met = index.select("data").crossJoin(queries.select(F.col("data").alias("asked")))
    with Batches(spark, 2):
        found = staging.keep(met.mapInArrow(lambda b: _search(k, codes.radius, b), "query_id bigint, vec_id bigint, score double"), "found")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    single = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = single.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
