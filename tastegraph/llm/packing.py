"""Operator 1: best-fit packing of token pieces into sequences.

Best-fit decreasing places pieces from the longest to the shortest, each into
the open sequence with the least room that still takes it; a segment tree
over the remaining capacities finds that room in logarithmic time.  Pieces of
one length are interchangeable, so the placement needs only the number of
pieces of each length: at most ``capacity`` numbers, whatever the size of the
corpus.  The driver places whole runs of equal pieces into whole runs of
equal sequences, and the tasks then look up the place of the k-th piece of a
length.  The result is the one that best-fit decreasing gives on all pieces
together, not on shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegraph.llm.common import lean, materialize, slices
from tastegraph.llm.tokens import Encoder, loaded

CAPACITY = 1024


class CapacityTree:
    """Which remaining capacities have open sequences: a segment tree over
    0 … capacity that answers "the least one ≥ x" in O(log capacity)."""

    def __init__(self, capacity: int):
        self._leaves = 1 << capacity.bit_length()
        self._any = bytearray(2 * self._leaves)

    def set(self, room: int, open_: bool) -> None:
        i = self._leaves + room
        self._any[i] = open_
        while i := i >> 1:
            self._any[i] = self._any[2 * i] | self._any[2 * i + 1]

    def tightest(self, length: int) -> int | None:
        i = self._leaves + length
        if self._any[i]:
            return length
        while i > 1:  # up to the first right sibling with an open sequence, then down its left edge
            if not i & 1 and self._any[i + 1]:
                i += 1
                while i < self._leaves:
                    i = 2 * i + (not self._any[2 * i])
                return i - self._leaves
            i >>= 1
        return None


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Placement of ``counts[length]`` pieces of each length.

    Rows (length, first piece, first sequence, pieces per sequence, offset):
    piece ``first + k`` of the length goes to sequence ``first sequence +
    k // pieces``, at ``offset + (k % pieces) * length``.  A length opens or
    splits at most three runs of sequences, and a sequence holds at most
    sqrt(2 * capacity) different lengths, which bounds the rows by
    3 * capacity * sqrt(2 * capacity) at any corpus size.
    """
    tree, runs, rows, opened = CapacityTree(capacity), {}, [], 0

    def keep(room: int, lo: int, hi: int) -> None:
        if room and hi > lo:
            runs.setdefault(room, []).append((lo, hi))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        left, done = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:  # no open sequence takes it: as many new ones as the rest needs
                room, per = capacity, capacity // length
                lo, hi = opened, opened - (-left // per)
                opened = hi
            else:
                per, (lo, hi) = room // length, runs[room].pop()
                if not runs[room]:
                    tree.set(room, False)
            full = min(hi - lo, left // per)
            if full:
                rows.append((length, done, lo, per, capacity - room))
                keep(room - per * length, lo, lo + full)
                done, left, lo = done + full * per, left - full * per, lo + full
            if 0 < left < per and lo < hi:
                rows.append((length, done, lo, per, capacity - room))
                keep(room - left * length, lo, lo + 1)
                done, left, lo = done + left, 0, lo + 1
            keep(room, lo, hi)
    return np.array(rows, np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, keep_ids: bool, keep_encoder: bool) -> DataFrame:
    """Token pieces of every text (null: empty).  Texts of more than
    ``capacity`` tokens are cut so that only their first piece is shorter.
    ``part`` and ``rank`` number the pieces of a length within a task."""
    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
    fields += [T.StructField(n, t) for n, t in (("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()),
                                                ("ids_crc32", T.LongType()), ("part", T.LongType()), ("rank", T.LongType()))]
    fields += [T.StructField("ids", T.BinaryType())] * keep_ids

    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(vocabulary, end_id) if keep_encoder else Encoder(vocabulary, end_id)
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in slices(batches):
            whose, out = [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = encoder.encode(text)
                n = len(ids) // 4
                start, end, k = 0, n % capacity or capacity, 0
                while start < n:
                    length, raw = end - start, ids[4 * start:4 * end]
                    whose.append(row)
                    out.append((k, start, length, zlib.crc32(raw), part, seen[length], *([raw] * keep_ids)))
                    seen[length] += 1
                    start, end, k = end, end + capacity, k + 1
            if out:
                kinds = [pa.int32(), *[pa.int64()] * 5, pa.binary()]
                columns = [pa.array(v, t) for v, t in zip(zip(*out), kinds)]
                yield pa.record_batch([batch.column(0).take(pa.array(whose)), *columns], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(lean(run), schema)


def pack(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = CAPACITY, keep_ids: bool = True,
         keep_encoder: bool = False) -> DataFrame:
    """Pack all texts into sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset and, with ``keep_ids``, the ids themselves (little-endian unsigned
    32-bit).  A null text counts as empty (one piece: the end id), a null
    doc_id is kept, repeated rows are packed each for itself, other columns
    are ignored, and an empty table gives no rows.  With ``keep_encoder``
    tasks that follow one another in a worker process share an encoder and its
    memo, which is faster and holds their memory between tasks.
    """
    cut = materialize(pieces(docs, vocabulary, end_id, capacity, keep_ids, keep_encoder), "pieces")
    counts = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # at most `capacity` rows come to the driver
    totals = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = plan(totals, capacity)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    width = 1 << 48
    keys = rows[:, 0] * width + rows[:, 1]
    schema = T.StructType([*(f for f in cut.schema.fields if f.name not in ("part", "rank")),
                           T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k, length = (b.column(n).to_numpy() for n in ("index", "length"))
            row = rows[np.searchsorted(keys, length * width + k, "right") - 1]
            k = k - row[:, 1]
            found = [pa.array(row[:, 2] + k // row[:, 3]), pa.array(row[:, 4] + k % row[:, 3] * length)]
            yield pa.record_batch([*b.columns[:-1], *found], names=schema.names)

    placed = cut.join(offsets, ["length", "part"]).withColumn("index", F.col("before") + F.col("rank"))
    return placed.select(*schema.names[:-2], "index").mapInArrow(lean(place), schema)
