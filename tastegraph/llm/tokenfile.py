"""Operator 6: token files in the Arrow stream format.

A shard is one Arrow stream of record batches with two fixed-size-list
columns: ``input_ids`` (unsigned, as narrow as the vocabulary allows) and
``mask`` (false where the last sequence is padded).  All batches but the last
have the same number of rows, so sequence i is row ``i % rows`` of batch
``i // rows`` of a memory-mapped file, without copying.  A second stream
beside it holds the shard's documents (doc_id, start, n_tokens).  Shards are
ranges of doc_id; their numbers follow the order.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegraph.llm.common import materialize, scratch_path, slices
from tastegraph.llm.tokens import loaded

SEQUENCE, ROWS = 2048, 64

SHARD = T.StructType([T.StructField("shard", T.LongType()), T.StructField("path", T.StringType()),
                      T.StructField("documents", T.LongType()), T.StructField("tokens", T.LongType())])


def _open(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def id_type(vocab_size: int) -> np.dtype:
    """The narrowest unsigned type for the ids."""
    return np.dtype("<u2") if vocab_size <= 1 << 16 else np.dtype("<u4")


class _ShardWriter:
    """Streams ids into equal sequences, ``ROWS`` of them a batch."""

    def __init__(self, path: str, kind: np.dtype, sequence: int, rows: int, pad: int):
        self._fs, where = _open(path)
        self._fs.create_dir(where.rpartition("/")[0], recursive=True)
        self._sequence, self._step, self._kind, self._pad = sequence, sequence * rows, kind, pad
        self._schema = pa.schema([("input_ids", pa.list_(pa.from_numpy_dtype(kind), sequence)), ("mask", pa.list_(pa.bool_(), sequence))])
        self._sink = self._fs.open_output_stream(where)
        self._writer = pa.ipc.new_stream(self._sink, self._schema)
        self._held: list[np.ndarray] = []
        self._n = 0

    def add(self, ids: np.ndarray) -> None:
        self._held.append(ids)
        self._n += len(ids)
        if self._n >= self._step:
            flat = np.concatenate(self._held)
            whole = len(flat) // self._step * self._step
            for at in range(0, whole, self._step):
                self._batch(flat[at:at + self._step], self._step)
            self._held, self._n = [flat[whole:]], len(flat) - whole

    def _batch(self, ids: np.ndarray, n: int) -> None:
        padded = np.full(-(-n // self._sequence) * self._sequence, self._pad, self._kind)
        padded[:n] = ids
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self._sequence) for x in (padded, np.arange(len(padded)) < n)]
        self._writer.write_batch(pa.record_batch(lists, schema=self._schema))

    def close(self) -> None:
        if self._n:
            self._batch(np.concatenate(self._held), self._n)
        self._writer.close()
        self._sink.close()


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 2, sequence: int = SEQUENCE,
                      rows: int = ROWS) -> DataFrame:
    """Write all texts (null: empty), in ascending doc_id order (nulls first,
    ties by text), and return one row per shard: shard, path, documents,
    tokens.  A task attempt writes files of its own name and the returned
    table, itself written once, names those of the attempt that counted, so
    lost executors and repeated tasks leave no doubled rows.  An empty table
    gives no shard."""
    ordered = docs.select("doc_id", "text").withColumn("_tie", F.xxhash64("text")).repartitionByRange("doc_id", "_tie")
    ordered = ordered.sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(vocabulary, end_id)
        kind = id_type(max(encoder.vocab_size, end_id + 1))
        shard = TaskContext.get().partitionId()
        path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.arrows"
        tokens = writer = index = None
        count = 0
        for batch in slices(batches):
            if writer is None:
                writer, tokens = _ShardWriter(path, kind, sequence, rows, end_id), 0
                fs, where = _open(f"{path}.docs")
                sink = fs.open_output_stream(where)
                schema = pa.schema([("doc_id", batch.schema.field(0).type), ("start", pa.int64()), ("n_tokens", pa.int64())])
                index = pa.ipc.new_stream(sink, schema)
            lengths = []
            for text in batch.column(1).to_pylist():
                ids = np.frombuffer(encoder.encode(text), "<u4")
                writer.add(ids.astype(kind))
                lengths.append(len(ids))
            ends = tokens + np.cumsum(lengths)
            index.write_batch(pa.record_batch([batch.column(0), pa.array(ends - lengths), pa.array(np.array(lengths))], schema=schema))
            tokens, count = int(ends[-1]), count + batch.num_rows
        if writer is not None:
            writer.close()
            index.close()
            sink.close()
            yield pa.record_batch([pa.array([v], t) for v, t in ((shard, pa.int64()), (path, pa.string()), (count, pa.int64()), (tokens, pa.int64()))],
                                  names=SHARD.names)

    return materialize(ordered.mapInArrow(run, SHARD), "shards")


def open_shard(path: str) -> Iterator[np.ndarray]:
    """The ids of a shard without padding, batch by batch; on a local file
    system the arrays are views of the mapped file."""
    fs, where = _open(path)
    source = pa.memory_map(where) if fs.type_name == "local" else fs.open_input_stream(where)
    with pa.ipc.open_stream(source) as reader:
        for batch in reader:
            ids = batch.column(0).flatten().to_numpy()
            mask = batch.column(1).flatten()
            yield ids if mask.true_count == len(ids) else ids[:mask.true_count]


def read_documents(shards: DataFrame, id_kind: T.DataType) -> DataFrame:
    """Read the files back: doc_id, start (over all shards), n_tokens and
    ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""
    # one row per shard; a partition of documents gave each
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0))).select("path", "before")
    schema = T.StructType([T.StructField("doc_id", id_kind), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            ids, held, at = open_shard(row["path"]), np.empty(0, "<u4"), 0
            fs, where = _open(f"{row['path']}.docs")
            with pa.ipc.open_stream(fs.open_input_stream(where)) as index:
                for docs in index:
                    crcs = []
                    for n in docs.column(2).to_pylist():
                        crc = 0
                        while n:
                            if at == len(held):
                                held, at = next(ids).astype("<u4"), 0
                            take = held[at:at + n]
                            crc, n, at = zlib.crc32(take, crc), n - len(take), at + len(take)
                        crcs.append(crc)
                    starts = docs.column(1).to_numpy() + row["before"]
                    yield pa.record_batch([docs.column(0), pa.array(starts), docs.column(2), pa.array(crcs, pa.int64())], names=schema.names)

    return placed.repartition(max(1, shards.count())).mapInArrow(run, schema)


def token_files(docs: DataFrame, vocabulary: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Write and read back; the files stay in ``folder`` (default: a new one
    in the cluster's shared folder)."""
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    return read_documents(write_token_files(docs, folder, vocabulary, end_id), docs.schema["doc_id"].dataType)
