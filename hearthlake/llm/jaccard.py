"""Links between documents whose sets of word n-grams are alike, by a token-group matrix.

Equal sets are taken as one. Sets that can have a partner are put into groups of similar
ones; each group keeps the union of its tokens and, as a matrix, which set has which. A set
can be linked with a member of a group only if enough of its tokens are in the union, so
only groups for which some set passes this bound are opened and their sets compared.

Which groups meet at all follows from prefixes: with all tokens in one order, two sets that
are alike share a token among the first few of both. The order is by frequency (rarest
first), so that passages that many documents share come last. Any order gives all links; the
frequencies are counted for all tokens in a table of fixed size. Prefixes are a few tokens
longer than one shared token asks for, so that two sets alike share not one but ``SHARED``
tokens there; a line that two documents have in common does not make them candidates.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake.llm.components import components
from hearthlake.llm.words import UPPER_TO_LOWER, encoded, mix64
from hearthlake.session import Staging

NGRAM, PERCENT = 4, 85
#: Tokens that two sets alike share in their prefixes, unless the smaller has fewer.
SHARED = 16
#: Counters for token frequencies, and bits of the filters; both of fixed size.
COUNTERS, BITS = 1 << 22, 1 << 26
#: Such tables are added up in so many parts.
PARTS = 256
#: A group holds about so many sets, and about so many tokens with repeats.
GROUP_SETS, GROUP_TOKENS = 256, 1 << 17
#: Sets with a possible partner (three numbers each) up to which their table is sent to every
#: task; above, it is joined by a shuffle.
SENT_ROWS = 1 << 21
#: Texts that are cut into words together.
TOGETHER = 256
#: Tokens of two groups that are compared at a time.
COLUMNS = 1 << 12

_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BASE = np.uint64(0x9E3779B97F4A7C15)


def word_codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit code of each word, words before each text and after all) of texts, A-Z lower-cased.

    A code is the word's bytes as a polynomial, scrambled; all words are summed up at once.
    """
    parts = [encoded(t).translate(UPPER_TO_LOWER) for t in texts]
    data = np.frombuffer(b" ".join([*parts, b""]), np.uint8)
    blank = _SPACE[data]
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]])) if len(data) else np.zeros(0, np.int64)
    begins = np.cumsum([0, *(len(p) + 1 for p in parts)])
    before = np.searchsorted(starts, begins)
    if not len(starts):
        return np.zeros(0, np.uint64), before
    run = np.diff(np.append(starts, len(data)))
    at = np.arange(starts[0], len(data)) - np.repeat(starts, run)
    powers = np.cumprod(np.full(int(run.max()), _BASE, np.uint64))
    own = np.where(blank[starts[0] :], np.uint64(0), (data[starts[0] :].astype(np.uint64) + np.uint64(1)) * powers[at])
    return mix64(np.add.reduceat(own, starts - starts[0])), before


def token_sets(texts: list[str | None], n: int = NGRAM) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit codes of its word n-grams; of all its words if they are fewer."""
    out: list[np.ndarray] = []
    for i in range(0, len(texts), TOGETHER):
        codes, before = word_codes(texts[i : i + TOGETHER])
        grams = _grams(codes, n)
        for low, high in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
            own = grams[low : high - n + 1] if high - low >= n else _grams(codes[low:high], high - low)
            out.append(np.unique(own))
    return out


def _grams(codes: np.ndarray, width: int) -> np.ndarray:
    if not width:
        return np.zeros(0, np.uint64)
    out = np.full(max(0, len(codes) - width + 1), width, np.uint64)
    for j in range(width):
        out = (out ^ codes[j : j + len(out)]) * _BASE
        out ^= out >> np.uint64(29)
    return mix64(out)


def signature(own: np.ndarray) -> int:
    """A signed 64-bit code of a token set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(own.tobytes())).view(np.int64))


def counter_of(own: np.ndarray) -> np.ndarray:
    return (own % np.uint64(COUNTERS)).astype(np.int64)


def least_overlap(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The smallest share of a set of size ``n`` that a set alike has with it."""
    return -(-percent * n // 100)


def shared_tokens(n: int, percent: int) -> int:
    """How many tokens of the prefix of a set of size ``n`` any set alike has in its own, if as large."""
    return min(SHARED, least_overlap(n, percent))


def prefix(own: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The rarest tokens: with any set alike, ``shared_tokens`` of them are in the prefixes of both."""
    n = len(own)
    length = n - least_overlap(n, percent) + shared_tokens(n, percent)
    order = np.lexsort((own, counts[counter_of(own)]))
    return own[order[:length]]


def _rows(table: np.ndarray):
    """A table in ``PARTS`` parts, those that are not empty, packed."""
    for place, part in enumerate(table.reshape(PARTS, -1)):
        if part.any():
            yield pa.RecordBatch.from_pydict({"place": pa.array([place], pa.int64()), "data": [zlib.compress(part.tobytes(), 1)]})


def _combined(kind, combine, batches):
    parts: dict[int, np.ndarray] = {}
    for batch in batches:
        for place, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = np.frombuffer(zlib.decompress(data), kind)
            parts[place] = combine(parts[place], own) if place in parts else own
    for place, part in parts.items():
        yield pa.RecordBatch.from_pydict({"place": pa.array([place], pa.int64()), "data": [zlib.compress(part.tobytes(), 1)]})


_TABLE = "place bigint, data binary"


def collected(rows: DataFrame, size: int, kind: str, combine) -> np.ndarray:
    """The sum (or union) of the tasks' tables of ``size`` entries; combined by part before it is collected."""
    out = np.zeros((PARTS, size // PARTS), kind)
    for place, data in rows.repartition("place").mapInArrow(lambda b: _combined(kind, combine, b), _TABLE).collect():
        out[place] = np.frombuffer(zlib.decompress(data), kind)
    return out.reshape(-1)


def token_counts(documents: DataFrame, n: int) -> np.ndarray:
    """Documents per counter, over all documents; the table has ``COUNTERS`` entries at any size."""

    def count(batches):
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, TOGETHER):
                own = token_sets(batch.column(0).slice(i, TOGETHER).to_pylist(), n)
                np.add.at(counts, counter_of(np.concatenate(own)), 1)
        yield from _rows(counts)

    return collected(documents.select("text").mapInArrow(count, _TABLE), COUNTERS, "<i8", np.add)


class Filter:
    """A set of 64-bit codes as bits: no member is missed, some others pass."""

    def __init__(self, bits: np.ndarray | None = None):
        self.bits = np.zeros(BITS // 8, np.uint8) if bits is None else bits

    def add(self, codes: np.ndarray) -> None:
        at = codes % np.uint64(BITS)
        np.bitwise_or.at(self.bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def has(self, codes: np.ndarray) -> np.ndarray:
        at = codes % np.uint64(BITS)
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _codes_of(ids: np.ndarray) -> np.ndarray:
    return mix64(ids.astype(np.int64).view(np.uint64))


def filter_of(rows: DataFrame, column: str) -> np.ndarray:
    """The bits of a filter of a column of ids; NULL counts as 0."""

    def mark(batches):
        found = Filter()
        for batch in batches:
            found.add(_codes_of(pa.compute.fill_null(batch.column(0), 0).to_numpy(zero_copy_only=False)))
        yield from _rows(found.bits)

    return collected(rows.select(column).mapInArrow(mark, _TABLE), BITS // 8, "u1", np.bitwise_or)


def _deal(buckets, batches):
    """The prefix tokens of each batch with the lowest and highest signature that has them, dealt by token."""
    for batch in batches:
        for i in range(0, batch.num_rows, 2048):
            part = batch.slice(i, 2048)
            lists = part.column(1)
            token = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            owner = np.repeat(part.column(0).to_numpy(zero_copy_only=False), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
            if not len(token):
                continue
            order = np.lexsort((owner, token))
            token, owner = token[order], owner[order]
            edge = token[1:] != token[:-1]
            ends = np.concatenate([[True], edge]) | np.concatenate([edge, [True]])
            token, owner = token[ends], owner[ends]
            bucket = (token >> np.uint64(32)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            token, owner, bucket = token[order], owner[order], bucket[order]
            first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            for low, high in zip(first.tolist(), [*first[1:].tolist(), len(token)], strict=True):
                yield pa.RecordBatch.from_pydict(
                    {"bucket": pa.array([int(bucket[low])], pa.int64()), "tokens": [token[low:high].tobytes()], "owners": [owner[low:high].tobytes()]}
                )


def _meeting(batches):
    """A filter of the tokens that different sets have, from all postings of some buckets."""
    own: dict[int, list[tuple[bytes, bytes]]] = {}
    for batch in batches:
        for bucket, tokens, owners in zip(*[batch.column(c).to_pylist() for c in range(3)], strict=True):
            own.setdefault(bucket, []).append((tokens, owners))
    found = Filter()
    for parts in own.values():
        token = np.frombuffer(b"".join(p[0] for p in parts), np.uint64)
        owner = np.frombuffer(b"".join(p[1] for p in parts), np.int64)
        order = np.lexsort((owner, token))
        token, owner = token[order], owner[order]
        found.add(np.unique(token[1:][(token[1:] == token[:-1]) & (owner[1:] != owner[:-1])]))
    yield from _rows(found.bits)


def _may_meet(percent, sent, batches):
    """The prefixes of sets that may share enough tokens with another, without tokens that no other set has."""
    for batch in batches:
        lists = batch.column("prefix")
        token = lists.flatten().to_numpy(zero_copy_only=False)
        lengths = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(batch.num_rows), lengths)
        hit = Filter(sent.value).has(token.view(np.uint64))
        n = batch.column("n_shingles").to_numpy(zero_copy_only=False)
        shared = np.minimum(SHARED, least_overlap(n, percent))
        enough = np.bincount(owner[hit], minlength=batch.num_rows) >= shared
        some = hit & enough[owner]
        yield pa.RecordBatch.from_pydict(
            {
                "signature": batch.column("signature").to_numpy(zero_copy_only=False)[owner[some]],
                "n": n[owner[some]],
                "shared": shared[owner[some]],
                "token": token[some],
            }
        )


def _describe(n, percent, counts, batches):
    for batch in batches:
        for i in range(0, batch.num_rows, 1024):
            part = batch.slice(i, 1024)
            own = token_sets(part.column(1).to_pylist(), n)
            prefixes = [prefix(t, counts, percent).view(np.int64) for t in own]
            ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
            flat = np.concatenate([*prefixes, np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column(0),
                    "n_shingles": pa.array(list(map(len, own)), pa.int64()),
                    "signature": pa.array([signature(t) if len(t) else None for t in own], pa.int64()),
                    "prefix": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                }
            )


def _own_tokens(n, sent, batches):
    """(signature, tokens) of the documents whose id passes the filter."""
    for batch in batches:
        codes = _codes_of(pa.compute.fill_null(batch.column(0), 0).to_numpy(zero_copy_only=False))
        wanted = batch.filter(pa.array(Filter(sent.value).has(codes)))
        for i in range(0, wanted.num_rows, TOGETHER):
            part = wanted.slice(i, TOGETHER)
            own = token_sets(part.column(1).to_pylist(), n)
            data = [(i, signature(t), t.tobytes()) for i, t in zip(part.column(0).to_pylist(), own, strict=True) if len(t)]
            columns = list(zip(*data, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())], names=["id", "own", "tokens"]
            )


def pack_group(signatures: list[int], sets: list[np.ndarray]) -> dict[str, bytes]:
    """A group's row: the union of its tokens, and for each set where its tokens are in it."""
    union = np.unique(np.concatenate(sets))
    places = np.concatenate([np.searchsorted(union, s) for s in sets])
    kind = "<u2" if len(union) <= 1 << 16 else "<u4"
    return {
        "members": np.array(signatures, "<i8").tobytes(),
        "sizes": np.array([len(s) for s in sets], "<i8").tobytes(),
        "union_tokens": union.astype("<u8").tobytes(),
        "places": places.astype(kind).tobytes(),
    }


class Group:
    def __init__(self, members: bytes, sizes: bytes, union: bytes, places: bytes):
        self.members, self.sizes, self.union = np.frombuffer(members, "<i8"), np.frombuffer(sizes, "<i8"), np.frombuffer(union, "<u8")
        self.places = np.frombuffer(places, "<u2" if len(self.union) <= 1 << 16 else "<u4").astype(np.int64)
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)

    def part(self, columns: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The 0/1 matrix of some sets (mask) and some union places."""
        number, line = np.full(len(self.union), -1), np.cumsum(rows) - 1
        number[columns] = np.arange(len(columns))
        own = (number[self.places] >= 0) & rows[self.owner]
        out = np.zeros((int(rows.sum()), len(columns)), np.float32)
        out[line[self.owner[own]], number[self.places[own]]] = 1
        return out

    def shared(self, columns: np.ndarray) -> np.ndarray:
        """How many of each set's tokens are among some union places: its overlap with another group's union."""
        some = np.zeros(len(self.union), bool)
        some[columns] = True
        return np.bincount(self.owner[some[self.places]], minlength=len(self.sizes))


def open_pair(a: Group, b: Group, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member of a, member of b) of two groups (or of one with itself) by exact comparison.

    Only sets that pass the bound against the other group's union are compared.
    """
    _, in_a, in_b = np.intersect1d(a.union, b.union, assume_unique=True, return_indices=True)
    rows = a.shared(in_a) >= least_overlap(a.sizes, percent)
    columns = b.shared(in_b) >= least_overlap(b.sizes, percent)
    if not (rows.any() and columns.any()):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = np.zeros((int(rows.sum()), int(columns.sum())), np.float64)
    for i in range(0, len(in_a), COLUMNS):
        both += a.part(in_a[i : i + COLUMNS], rows) @ b.part(in_b[i : i + COLUMNS], columns).T
    union = a.sizes[rows][:, None] + b.sizes[columns][None, :] - both
    left, right = np.nonzero(100 * both >= percent * union)
    return np.flatnonzero(rows)[left], np.flatnonzero(columns)[right]


def _spanning(nodes_a: np.ndarray, nodes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node it reaches) that connect what the given links connect."""
    nodes, places = np.unique(np.concatenate([nodes_a, nodes_b]), return_inverse=True)
    a, b = places[: len(nodes_a)], places[len(nodes_a) :]
    label = np.arange(len(nodes))
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            break
        label = low
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[own], nodes[label[own]]


def _open_pairs(percent, batches):
    for batch in batches:
        for row in range(batch.num_rows):
            values = [batch.column(c)[row].as_py() for c in range(8)]
            a, b = Group(*values[:4]), Group(*values[4:])
            left, right = open_pair(a, b, percent)
            x, y = _spanning(a.members[left], b.members[right])
            if len(x):
                yield pa.RecordBatch.from_pydict({"a": pa.array(x), "b": pa.array(y)})


class Batches:
    """Sets the rows of an Arrow batch for what runs inside."""

    KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def __init__(self, spark, rows: int):
        self.spark, self.rows = spark, rows

    def __enter__(self):
        self.before = self.spark.conf.get(self.KEY, "10000")
        self.spark.conf.set(self.KEY, str(self.rows))

    def __exit__(self, *_error):
        self.spark.conf.set(self.KEY, self.before)


def linked_documents(staging: Staging, documents: DataFrame, n: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, n_shingles, component_id.

    Two documents are linked when 100 * intersection >= percent * union of their sets of word
    n-grams. component_id is the smallest doc_id that links reach, itself included. Documents
    without words or text have an empty set and are linked with nothing. Null ids are passed over as
    component_id unless a component has no other. Repeated rows have one set and are linked.
    """
    with Staging(staging.spark) as own:  # only the result outlives this call
        return staging.keep(_linked(own, documents.select("doc_id", "text"), n, percent), "linked")


def _linked(staging: Staging, texts: DataFrame, n: int, percent: int) -> DataFrame:
    spark = staging.spark
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    with Batches(spark, 2048):
        counts = spark.sparkContext.broadcast(token_counts(texts, n))
        described = texts.mapInArrow(
            lambda b: _describe(n, percent, counts.value, b), "doc_id bigint, n_shingles bigint, signature bigint, prefix array<bigint>"
        )
        sets = staging.keep(described, "sets")

        # Prefixes without the tokens that only one set has. What passes a filter is checked below.
        some = sets.filter("signature is not null")
        dealt = some.select("signature", "prefix").mapInArrow(lambda b: _deal(buckets, b), "bucket bigint, tokens binary, owners binary")
        bits = collected(dealt.repartition("bucket").mapInArrow(_meeting, _TABLE), BITS // 8, "u1", np.bitwise_or)
        meeting = spark.sparkContext.broadcast(bits)
        postings = some.select("signature", "n_shingles", "prefix").mapInArrow(
            lambda b: _may_meet(percent, meeting, b), "signature bigint, n bigint, shared bigint, token bigint"
        )
        postings = staging.keep(postings, "may_meet")
    spread = postings.groupBy("token").agg(F.min("signature").alias("low"), F.max("signature").alias("high"), F.count("*").alias("often"))
    both_sides = spread.filter("low < high").select("token", "often")
    active = postings.join(both_sides, "token").groupBy("token", "signature").agg(
        F.first("n").alias("n"), F.first("shared").alias("shared"), F.first("often").alias("often")
    )
    active = staging.keep(active, "postings")

    # Groups: sets with the same most frequent prefix token, in parts of bounded size.
    leads = active.groupBy("signature").agg(
        F.max("n").alias("n"), F.max("shared").alias("shared"), F.count("*").alias("has"), F.max(F.struct("often", "token"))["token"].alias("lead")
    )
    leads = staging.keep(leads.filter("has >= shared"), "leads")
    rooms = leads.groupBy("lead").agg(F.ceil(F.greatest(F.count("*") / GROUP_SETS, F.sum("n") / GROUP_TOKENS)).alias("parts"))
    part = F.pmod(F.xxhash64("signature"), F.col("parts"))
    grouped = staging.keep(leads.join(rooms, "lead").select("signature", "n", F.xxhash64("lead", part).alias("group")), "groups")

    # Groups that share enough prefix tokens and whose sizes allow a link.
    per_token = active.join(grouped.select("signature", "group"), "signature").groupBy("token", "group").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("shared").alias("shared")
    )
    per_token = staging.keep(per_token, "tokens")
    a, b = per_token.alias("a"), per_token.alias("b")
    near = (F.col("a.most") * 100 >= F.col("b.least") * percent) & (F.col("b.most") * 100 >= F.col("a.least") * percent)
    met = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.group") < F.col("b.group")) & near)
    met = met.groupBy(F.col("a.group").alias("ga"), F.col("b.group").alias("gb")).agg(
        F.count("*").alias("common"), F.min(F.least("a.shared", "b.shared")).alias("needed")
    )
    pairs = staging.keep(met.filter("common >= needed").select("ga", "gb"), "pairs")

    # The token-group matrix, from the text of one document per set.
    reps = sets.filter("signature is not null").groupBy("signature").agg(F.min("doc_id").alias("rep"))
    wanted = staging.keep(grouped.select("signature", "group").join(reps, "signature"), "wanted")

    chosen = spark.sparkContext.broadcast(filter_of(wanted, "rep"))
    crossing = spark.sparkContext.broadcast(filter_of(pairs.select("ga").union(pairs.select("gb")), "ga"))
    with Batches(spark, 2048):
        own = texts.mapInArrow(lambda b: _own_tokens(n, chosen, b), "id bigint, own bigint, tokens binary")
        listed = F.broadcast(wanted) if wanted.count() <= SENT_ROWS else wanted
        own = own.join(listed, (own["own"] == wanted["signature"]) & own["id"].eqNullSafe(wanted["rep"])).select("group", "signature", "tokens")

        def pack(frame: pd.DataFrame) -> pd.DataFrame:
            """A group's links among its own sets, and its matrix if it meets another group."""
            frame, group = frame.drop_duplicates("signature").sort_values("signature"), int(frame["group"].iloc[0])
            packed = pack_group(frame["signature"].tolist(), [np.frombuffer(t, np.uint64) for t in frame["tokens"]])
            own = Group(*packed.values())
            left, right = open_pair(own, own, percent) if len(own.members) > 1 else (np.zeros(0, np.int64),) * 2
            low, high = _spanning(own.members[left], own.members[right])
            if not Filter(crossing.value).has(_codes_of(np.array([group])))[0]:
                packed = dict.fromkeys(packed)
            return pd.DataFrame([{"group": group, **packed, "a": low.tolist(), "b": high.tolist()}])

        columns = ["members", "sizes", "union_tokens", "places"]
        schema = "group bigint, " + ", ".join(f"{c} binary" for c in columns) + ", a array<bigint>, b array<bigint>"
        matrix = staging.keep(own.groupBy("group").applyInPandas(pack, schema), "matrix")
    with Batches(spark, 8):
        stored = matrix.filter("members is not null")
        x, y = (stored.select(*[F.col(c).alias(f"{side}_{c}") for c in ["group", *columns]]) for side in "xy")
        opened = pairs.join(x, F.col("ga") == F.col("x_group")).join(y, F.col("gb") == F.col("y_group"))
        opened = opened.select(*[f"x_{c}" for c in columns], *[f"y_{c}" for c in columns])
        within = matrix.filter("size(a) > 0").select(F.inline(F.arrays_zip("a", "b")))
        edges = opened.mapInArrow(lambda b: _open_pairs(percent, b), "a bigint, b bigint").unionByName(within)
        edges = staging.keep(edges, "links")

    roots = components(staging, edges)
    named = reps.join(roots, reps["signature"] == roots["node"], "left").select("signature", F.coalesce("root", "signature").alias("root"), "rep")
    named = staging.keep(named, "named")
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_set = named.join(smallest, "root").select(F.col("signature").alias("own"), "component_id")
    out = sets.join(by_set, sets["signature"] == by_set["own"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(staging: Staging, documents: DataFrame, n: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """The documents without near copies, all columns: one row of each component stays.

    It is the row with the smallest doc_id, a null id coming last. Rows count by id and text: rows that
    share an id but not their text are documents of their own, and rows without id are reduced
    like others. Of rows equal in id and text the one with the least other columns stays. Documents with an
    empty set all stay.
    """
    code = F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), "text")
    keyed = documents.select(code.alias("code"), "doc_id", "text")
    linked = linked_documents(staging, keyed.select(F.col("code").alias("doc_id"), "text"), n, percent)
    linked = linked.select(F.col("doc_id").alias("code"), "n_shingles", "component_id")
    ids = keyed.groupBy("code").agg(F.first("doc_id").alias("id"), F.count("*").alias("rows"))
    some = linked.filter("n_shingles > 0").select("code", "component_id").distinct().join(ids, "code")
    first = some.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("code"), F.col("rows"))).alias("first"))
    empty = linked.filter("n_shingles = 0").select("code", F.lit(1).cast("bigint").alias("rows")).distinct()
    kept = staging.keep(first.select("first.code", "first.rows").unionByName(empty), "kept")
    coded = documents.select(code.alias("_code"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"))
    single = coded.join(kept.select(F.col("code").alias("_kept")), F.col("_code") == F.col("_kept"), "left_semi")
    repeated = kept.filter("rows > 1").select(F.col("code").alias("_kept"))
    if not repeated.isEmpty():
        again = F.col("_code") == F.col("_kept")
        one = single.join(repeated, again, "left_semi").groupBy("_code").agg(F.min("_row").alias("_row"))
        single = single.join(repeated, again, "left_anti").unionByName(one)
    return single.select("_row.*")


SQL = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM grams a JOIN grams b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * common >= 85 * (a.n + b.n - common)
), two_ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  WITH RECURSIVE r(x, y) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT r.x, t.y FROM r JOIN two_ways t ON r.y = t.x) SELECT x, min(y) AS component_id FROM r GROUP BY x
)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id
FROM words w LEFT JOIN sizes s ON s.doc_id = w.doc_id LEFT JOIN reach r ON r.x = w.doc_id
"""
