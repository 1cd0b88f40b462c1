"""Operator 5: removal of long byte strings that occur more than once, by
hash refinement at content-chosen positions.

Prefix doubling would sort a rank for every byte position and so move some
thirty times the input per round.  It is replaced: no rank is doubled, and
hashes are grouped for chosen positions only:

1. Every ``length``-byte string is charged to its anchor, the least-hashing
   short gram within it.  Equal strings have the same anchor at the same
   place, so only positions relative to anchors need comparing: strings of
   one anchor whose distances to it fall into the same block share a core.
2. A core's halves give its first ranks, and the pair of them the rank at
   the doubled length.  Cores with a rank of their own are unique and leave.
3. The remaining blocks are reranked by their whole extent, past the
   threshold: blocks that share that rank repeat entirely.
4. A block that shares only its core is on the edge of a repeat.  It is cut
   into blocks of a few strings, with longer cores, which are reranked in the
   same way (one block for each extent that repeats takes part); only the
   strings at the very edge are then ranked one by one at the full length.

Ranks are grouped counts, never collected groups, and a hot string is one
row of a count per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegraph.llm.common import lean, materialize, release, slices, temp
from tastegraph.llm.hashing import U64, RangeHash, chunks, constants, mix

LENGTH = 400
_CHUNK_BYTES = 1 << 18


def _slide_least(x: np.ndarray, width: int) -> np.ndarray:
    """out[i] = min(x[i:i + width]), by doubling."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


#: Strings of a block of the second round.
FINE = 16
_BLOCK = [("first", T.IntegerType()), ("strings", T.ShortType()), ("place", T.ShortType()), ("core", T.LongType()), ("extent", T.LongType())]


def anchors(data: np.ndarray, hashes: RangeHash, length: int) -> np.ndarray:
    """For every start of a ``length``-byte string, the place of its anchor;
    ties of the hash go to the first."""
    gram = min(32, max(1, length // 4))
    at = np.arange(len(data) - gram + 1)
    bits = U64(len(data).bit_length())
    grams = (hashes(at, at + gram) >> bits << bits) | at.astype(U64)
    return (_slide_least(grams, length - gram + 1) & ((U64(1) << bits) - U64(1))).astype(np.int64)


def blocks_of(hashes: RangeHash, starts: np.ndarray, anchor: np.ndarray, length: int, width: int):
    """Runs of consecutive strings of one anchor whose distance to it falls
    into the same block of ``width``: (first start, strings, distance of the
    first, core, extent).  The core is what all strings of the block, present
    or not, have in common; its rank is the pair of its halves' ranks."""
    number = (anchor - starts) // width
    new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(number, prepend=-1) != 0) | (np.diff(starts, prepend=-2) != 1))
    lo, hi = starts[new], starts[np.append(new[1:], len(starts)) - 1]
    core, size = anchor[new] - number[new] * width, length - width + 1
    half = (size + 1) // 2
    pair = constants(43, 2)
    ranks = mix(hashes(core, core + half) * pair[0] + hashes(core + size - half, core + size) * pair[1])
    return new, lo, hi - lo + 1, anchor[new] - lo, ranks, hashes(lo, hi + length)


def _blocks(length: int, id_type: T.DataType):
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("digest", T.LongType()), *(T.StructField(*f) for f in _BLOCK)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [(i, t) for i, t in enumerate(x.encode() if x else b"" for x in b.column(2).to_pylist()) if len(t) >= length]
            for part in chunks(texts, [len(t) for _, t in texts], _CHUNK_BYTES):
                data = np.frombuffer(b"".join(t for _, t in part), np.uint8)
                hashes = RangeHash(data)
                ends = np.cumsum([len(t) for _, t in part])
                begins = np.append(0, ends[:-1])
                anchor = anchors(data, hashes, length)
                inside = np.zeros(len(anchor) + 1, np.int32)  # strings that lie within one text
                inside[begins] += 1
                inside[ends - length + 1] -= 1
                starts = np.flatnonzero(np.cumsum(inside[:-1]))
                _, lo, n, place, core, extent = blocks_of(hashes, starts, anchor[starts], length, max(1, length // 4))
                text = np.searchsorted(ends, lo, "right")
                whose = pa.array(np.array([i for i, _ in part])[text])
                yield pa.record_batch([b.column(0).take(whose), b.column(1).take(whose), pa.array(lo - begins[text], pa.int32()),
                                       pa.array(n, pa.int16()), pa.array(place, pa.int16()), pa.array(core.view(np.int64)),
                                       pa.array(extent.view(np.int64))], names=schema.names)

    return run, schema


def _fine_blocks(length: int, id_type: T.DataType):
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("digest", T.LongType()), *(T.StructField(*f) for f in _BLOCK),
                           T.StructField("each", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for i, (text, runs) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                hashes = RangeHash(np.frombuffer(text.encode(), np.uint8))
                first, n, place = (np.array([r[k] for r in runs], np.int64) for k in ("first", "strings", "place"))
                order = np.argsort(first)
                first, n, place = first[order], n[order], place[order]
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                starts = np.repeat(first, n) + step
                new, lo, count, near, core, extent = blocks_of(hashes, starts, np.repeat(first + place, n), length, min(FINE, max(1, length // 8)))
                each = pa.ListArray.from_arrays(pa.array(np.append(new, len(starts)), pa.int32()),
                                                pa.array(hashes(starts, starts + length).view(np.int64)))
                whose = pa.array(np.full(len(lo), i))
                yield pa.record_batch([b.column(0).take(whose), b.column(1).take(whose), pa.array(lo, pa.int32()), pa.array(count, pa.int16()),
                                       pa.array(near, pa.int16()), pa.array(core.view(np.int64)), pa.array(extent.view(np.int64)), each],
                                      names=schema.names)

    return run, schema


_OWN = ["doc_id", "digest"]


def rerank(blocks: DataFrame) -> DataFrame:
    """The blocks whose core is shared, with ``whole`` (their extent is, too)
    and ``edge`` (their core has several extents; true for one block of each
    extent).  Releases ``blocks``."""
    # written, so that the join below is one of plain shuffles, whose hot keys Spark splits
    cores = materialize(blocks.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "cores")
    shared = materialize(blocks.join(cores, "core"), "shared-blocks")
    release(blocks, cores)
    extents = materialize(shared.groupBy("core", "extent").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*_OWN, "first")).alias("one")), "extents")
    several = extents.groupBy("core").agg((F.count(F.lit(1)) > 1).alias("mixed"))
    ranked = shared.join(extents.join(several, "core"), ["core", "extent"])
    ranked = ranked.withColumn("whole", F.col("n") > 1).withColumn("edge", F.col("mixed") & (F.struct(*_OWN, "first") == F.col("one")))
    ranked = materialize(ranked.filter("whole or edge").drop("n", "one", "mixed"), "ranked-blocks")
    release(shared, extents)
    return ranked


def merge_spans(firsts: np.ndarray, strings: np.ndarray, length: int) -> np.ndarray:
    """Union of [first, first + strings - 1 + length) as rows (start, end)."""
    order = np.argsort(firsts, kind="stable")
    lo, hi = firsts[order], (firsts + strings - 1 + length)[order]
    reach = np.maximum.accumulate(hi)
    new = np.flatnonzero(np.append(True, lo[1:] > reach[:-1]))
    return np.stack([lo[new], reach[np.append(new[1:], len(lo)) - 1]], axis=1)


def _cut(length: int, fields: list[T.StructField], kept_name: str, spans_name: str, text_name: str | None):
    text_field = [T.StructField(text_name, T.StringType())] if text_name else []
    schema = T.StructType([*fields, T.StructField(kept_name, T.BinaryType()),
                           T.StructField(spans_name, T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
                           *text_field])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in slices(batches):
            kept, spans, whole = [], [], []
            for text, runs in zip(b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist()):
                data, gone, at = text.encode() if text else b"", [], 0
                pieces = []
                if runs:
                    first, strings = (np.array([r[n] for r in runs], np.int64) for n in ("first", "strings"))
                    gone = merge_spans(first, strings, length).tolist()
                for lo, hi in gone:
                    pieces.append(data[at:lo])
                    at = hi
                pieces.append(data[at:])
                kept.append(b"".join(pieces))
                if text_name:  # of a valid text, only the characters at cut edges can be partial
                    whole.append("".join(x.decode("utf-8", "ignore") for x in pieces) if gone else text)
                spans.append([{"start": lo, "end": hi} for lo, hi in gone])
            yield pa.record_batch([*b.columns[:-2], pa.array(kept, pa.binary()), pa.array(spans, span),
                                   *([pa.array(whole, pa.string())] if text_name else [])], names=schema.names)

    return run, schema


def remove_repeats(docs: DataFrame, length: int = LENGTH, kept: str = "kept", spans: str = "spans", text: str | None = "text") -> DataFrame:
    """All columns of ``docs`` but text, then kept (binary: the text's UTF-8
    bytes that remain), spans (the removed [start, end) byte ranges, maximal
    and in order) and text (the characters that remain whole; null for null).
    The names of the three are parameters; columns of ``docs`` that have them
    are replaced, and ``text=None`` leaves the last one out.

    A byte is removed if a ``length``-byte string that covers it starts
    anywhere else as well, in this text or another; strings lie within one
    text and are judged on the input.  A null text counts as empty; texts
    shorter than ``length`` stay whole; repeated rows are repeats of each
    other; null or repeated doc_ids are told apart by their text.  An empty
    table gives no rows.
    """
    id_type = docs.schema["doc_id"].dataType
    digest, span, names = F.xxhash64("text").alias("digest"), [*_OWN, "first", "strings"], (kept, spans, text)
    run, schema = _blocks(length, id_type)
    coarse = rerank(materialize(docs.select("doc_id", digest, "text").mapInArrow(lean(run), schema), "blocks"))
    edges = (coarse.filter("edge").groupBy(*_OWN).agg(F.collect_list(F.struct("first", "strings", "place")).alias("runs"))
             .toDF("_id", "_digest", "runs"))
    texts = docs.select("doc_id", digest, "text").filter(F.octet_length("text") >= length)
    here = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    run, schema = _fine_blocks(length, id_type)
    fine = rerank(materialize(texts.join(edges, here).select(*_OWN, "text", "runs").mapInArrow(lean(run), schema), "fine-blocks"))
    each = fine.filter("edge").select(*_OWN, "core", "first", F.posexplode("each").alias("at", "string"))
    twice = materialize(each.groupBy("core", "string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "strings")
    single = each.join(twice, ["core", "string"]).select(*_OWN, (F.col("first") + F.col("at")).alias("first"), F.lit(1).cast("short").alias("strings"))
    found = coarse.filter("whole").select(*span).unionByName(fine.filter("whole").select(*span)).unionByName(single)
    found = found.groupBy(*_OWN).agg(F.collect_set(F.struct("first", "strings")).alias("runs"))
    other = [c for c in docs.columns if c not in ("text", *names)]
    run, schema = _cut(length, [docs.schema[c] for c in other], *names)
    kept_id, kept_digest, runs = temp("id"), temp("digest"), temp("runs")
    found = found.toDF(kept_id, kept_digest, runs)
    joined = docs.join(found, docs["doc_id"].eqNullSafe(F.col(kept_id)) & (F.xxhash64(docs["text"]) == F.col(kept_digest)), "left")
    return joined.select(*other, "text", runs).mapInArrow(lean(run), schema)


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The columns of ``docs`` with the repeats taken out of text (and n_chars,
    if there is one, counted anew); no other column changes, whatever its
    name.  Characters cut apart go whole; texts of which nothing remains go,
    empty and null ones stay."""
    kept, spans, text = temp("kept"), temp("spans"), temp("text")
    cut = remove_repeats(docs, length, kept, spans, text)
    cut = cut.filter((F.size(spans) == 0) | (F.col(text) != "")).withColumn("text", F.col(text))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)
