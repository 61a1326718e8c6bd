"""Token ids of whole texts, written as grammar-compressed shards and read back.

Documents are range-partitioned by id; each partition is one shard, in ascending order.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthlake.llm import repair
from hearthlake.llm.pieces import TOKENIZER, PieceModel, pre_tokens
from hearthlake.llm.words import posix_path
from hearthlake.session import Staging, work_dir

END_ID = 2
#: Terminal ids of the grammar; the vocabulary is smaller.
TERMINALS = 49_408
#: Ids that are compressed together, unless one document has more.
BLOCK_IDS = 1 << 20
#: Bytes of pre-tokens whose ids a worker keeps, and what the store of one takes beside them.
KEPT_BYTES, ENTRY_BYTES = 80_000_000, 200


class Encoder:
    """Ids of a text, pre-token by pre-token; a pre-token is encoded when it is first met."""

    def __init__(self, name: str = TOKENIZER):
        self.model = PieceModel(name)
        self.known = _Known(self.model)

    def __call__(self, text: str | None) -> bytes:
        """The ids of the text, two bytes each (in the machine's order)."""
        return b"".join(map(self.known.__getitem__, pre_tokens(text)))


class _Known(dict):
    """Packed ids by pre-token; emptied when its pre-tokens and ids have ``KEPT_BYTES``."""

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model, self.size = model, 0

    def __missing__(self, piece: str) -> bytes:
        packed = array("H", self.model.ids(piece)).tobytes()
        if len(piece) <= KEPT_BYTES // 64:
            if self.size > KEPT_BYTES:
                self.clear()
                self.size = 0
            self[piece] = packed
            self.size += len(piece) + len(packed) + ENTRY_BYTES
        return packed


_ENCODERS: dict[str, Encoder] = {}


def encoder(name: str = TOKENIZER) -> Encoder:
    """The worker's encoder; it keeps the ids of pre-tokens from task to task."""
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(name)
    return _ENCODERS[name]


def _write_shard(root, tokenizer, batches):
    place = f"{root}/shard-{TaskContext.get().partitionId():06d}"
    os.makedirs(root, exist_ok=True)
    own, encode, end = f"{place}.{uuid.uuid4().hex}.tmp", encoder(tokenizer), np.array([END_ID], "=u2").tobytes()
    docs = total = 0
    ids, texts, held, index = [], [], 0, []

    with open(own, "wb") as file:

        def flush():
            nonlocal ids, texts, held
            counts = np.array([len(t) // 2 for t in texts], np.int64)
            known = np.array([i is not None for i in ids], bool)
            numbers = np.array([i or 0 for i in ids], np.int64)
            symbols = np.frombuffer(b"".join(texts), "=u2")
            some = numbers[known]
            index.append((file.tell(), int(some.min()), int(some.max()), len(some)) if len(some) else (file.tell(), 0, 0, 0))
            file.write(repair.pack_block(numbers, known, counts, symbols, TERMINALS, END_ID))
            ids, texts, held = [], [], 0

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = encode(text.as_py()) + end
                ids.append(doc_id)
                texts.append(data)
                held += len(data) // 2
                docs, total = docs + 1, total + len(data) // 2
                if held >= BLOCK_IDS:
                    flush()
        if ids:
            flush()
        file.write(repair.pack_index(index))
    os.replace(own, f"{place}.ids")
    shard = TaskContext.get().partitionId()
    yield pa.RecordBatch.from_pydict(
        {"shard": pa.array([shard], pa.int64()), "path": [f"{place}.ids"], "docs": pa.array([docs], pa.int64()), "ids": pa.array([total], pa.int64())}
    )


def write_shards(documents: DataFrame, folder: str, shards: int, tokenizer: str = TOKENIZER) -> DataFrame:
    """(shard, path, docs, ids) of the shards written to ``folder``, in ascending doc_id order.

    Null ids come first, null texts count as empty. Rows with one id (or none) are ordered and dealt out by
    their texts' hash, so that many of them do not meet in one shard. A shard is moved into place when it is
    complete, so a task that is run again replaces its own file. Only the ids of one block
    are held at a time.
    """
    root = posix_path(folder)
    keyed = documents.select("doc_id", "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ranged = keyed.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    return ranged.mapInArrow(lambda batches: _write_shard(root, tokenizer, batches), "shard bigint, path string, docs bigint, ids bigint")


def _read_shards(with_ids, batches):
    for batch in batches:
        for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            with open(path, "rb") as file:
                for block in repair.read_blocks(file):
                    ids = block.ids().astype("<u4")
                    ends = np.cumsum(block.counts)
                    starts = ends - block.counts
                    data = memoryview(ids.tobytes())
                    crc = [zlib.crc32(data[4 * s : 4 * e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                    columns = {
                        "doc_id": pa.array(block.doc_ids, pa.int64(), mask=block.known == 0),
                        "start": pa.array(starts + before, pa.int64()),
                        "n_tokens": pa.array(block.counts, pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    }
                    if with_ids:
                        columns["ids"] = pa.array([ids[s:e].tolist() for s, e in zip(starts, ends, strict=True)], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(columns)
                    before += len(ids)


def read_shards(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document, decoded from the shards of a manifest.

    ``start`` counts the ids of all documents before; the running total is over one row per shard.
    """
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("path", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("before"), "docs").filter("docs > 0").select("path", "before")
    tasks = max(1, manifest.sparkSession.sparkContext.defaultParallelism * 2)
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")
    return placed.repartition(tasks).mapInArrow(lambda batches: _read_shards(with_ids, batches), schema)


def read_document(path: str, doc_id: int) -> list[int] | None:
    """Random access: one document's ids from its shard, reading its block's tables and its own symbols only."""
    with open(path, "rb") as file:
        ids = repair.find_document(file, doc_id)
    return None if ids is None else ids.tolist()


def token_output(staging: Staging, documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Writes the shards of ``documents`` (doc_id, text) and returns what they say of each document.

    The number of shards follows the session's shuffle partitions. An empty table gives no row.
    Rows with equal ids keep their own ids, in any order.
    """
    spark = staging.spark
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    manifest = staging.keep(write_shards(documents, work_dir(spark, "ids"), shards, tokenizer), "shards")
    return read_shards(manifest)
