"""Operator 9: near-duplicates by SuperMinHash, banding, exact confirmation
and union-find.

1. Texts with the same shingle set form one class; only classes go on.
2. SuperMinHash signatures: an element gives its j-th random rank to the j-th
   place of its own permutation, so the places of one element are correlated
   and the estimate varies less than with independent hashes; levels stop as
   soon as no place of the signature can fall any more.
3. Bands of the signature hash to buckets.  A bucket links its members to its
   least one, so a bucket of n gives n - 1 rows, never pairs.  The components
   of these loose links bound what can be alike.
4. Within a loose component the similarity of full sets is computed exactly.
   Components above ``block`` classes are dealt by hash into blocks, and
   every pair of blocks is a task of its own; a task returns only the links
   that its union-find needed.
5. Star contraction joins the links into components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegraph.llm.common import lean, materialize, slices, temp
from tastegraph.llm.graph import UnionFind, components
from tastegraph.llm.hashing import U64, chunks, constants, mix, shingle_sets

PLACES, ROWS_PER_BAND = 128, 4
BLOCK = 512
_RANK_BITS = 40
_EMPTY = U64(2**64 - 1)


def super_minhash(sets: list[np.ndarray], places: int = PLACES) -> np.ndarray:
    """Signatures, one row per set: level j in the high bits, the element's
    random rank of that level in the low 40.  An empty set has no minimum.

    Level j gives place p[j] of each element's permutation p, which a partial
    Fisher-Yates shuffle extends by one step per level.  A set is finished
    before level j if all its places hold values of lower levels; large sets
    finish after the first one, before any permutation is stored.
    """
    sizes = np.array([len(s) for s in sets])
    out = np.full((len(sets), places), _EMPTY, U64)
    flat = out.reshape(-1)
    element, owner = np.concatenate([np.empty(0, U64), *sets]), np.repeat(np.arange(len(sets)), sizes)
    seeds, perm = constants(31, places), None
    for j in range(places):
        if j:
            live = out.max(axis=1) >= U64(j << _RANK_BITS)
            stays = live[owner]
            if not stays.any():
                break
            element, owner = element[stays], owner[stays]
            if perm is None:
                perm = np.tile(np.arange(places, dtype=np.uint8 if places <= 256 else np.uint16), (len(element), 1))
                swap = swap[stays]
                perm[:, 0] = swap
                perm[np.arange(len(element)), swap] = 0
            else:
                perm = perm[stays]
        random = mix(element ^ seeds[j])
        swap = j + (random % U64(places - j)).astype(np.int64)
        if perm is None:
            place = swap
        else:
            rows = np.arange(len(element))
            place = perm[rows, swap].astype(np.int64)
            perm[rows, swap] = perm[:, j]
            perm[:, j] = place
        rank = (mix(random) >> U64(64 - _RANK_BITS)) | U64(j << _RANK_BITS)
        np.minimum.at(flat, owner * places + place, rank)
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` places, distinct between bands."""
    n, places = signatures.shape
    grouped = signatures.reshape(n, places // rows, rows)
    keys = (mix(grouped) * constants(37, rows)).sum(axis=2) + constants(41, places // rows)
    return mix(keys).view(np.int64)


_CHUNK_BYTES = 1 << 18


def _signed(words: int, places: int, rows: int, id_type: T.DataType):
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", id_type),
                           T.StructField("digest", T.LongType()), T.StructField("n_shingles", T.LongType()),
                           T.StructField("set_key", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [t.encode() if t else b"" for t in b.column(3).to_pylist()]
            at = 0
            for part in chunks(texts, [len(t) for t in texts], _CHUNK_BYTES):
                sets = shingle_sets(part, words)
                bands = band_keys(super_minhash(sets, places), rows)
                n = np.array([len(s) for s in sets])
                ends = np.cumsum([0, *np.where(n > 0, bands.shape[1], 0)]).astype(np.int32)
                yield pa.record_batch([*(b.column(i).slice(at, len(part)) for i in range(3)), pa.array(n),
                                       pa.array([set_key(s) for s in sets], pa.binary()),
                                       pa.ListArray.from_arrays(ends, pa.array(bands[n > 0].reshape(-1)))], names=schema.names)
                at += len(part)

    return run, schema


def set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def links_within(sets: list[np.ndarray], nodes: list[int], block: np.ndarray, percent: int, cross: bool) -> list[tuple[int, int]]:
    """Links that connect the sets with 100 * |intersection| >= percent *
    |union|, as a union-find forest; ``cross``: only between the two blocks."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, ids = np.unique(flat, return_inverse=True)
    order = np.argsort(ids, kind="stable")
    posting = owner[order]
    first = np.concatenate([[0], np.cumsum(np.bincount(ids))])
    ends, union, out = np.cumsum(sizes), UnionFind(), []
    for i in range(len(sets) - 1):
        mine = ids[ends[i] - sizes[i]:ends[i]]
        lo, n = first[mine], first[mine + 1] - first[mine]
        take = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        common = np.bincount(posting[take], minlength=len(sets))
        like = 100 * common >= percent * (sizes[i] + sizes - common)
        like[:i + 1] = False
        if cross:
            like &= block != block[i]
        for j in np.flatnonzero(like).tolist():
            if union.union(nodes[i], nodes[j]):
                out.append((nodes[i], nodes[j]))
    return out


def _confirm(words: int, percent: int):
    def cell(rows: list[tuple]) -> pd.DataFrame:
        sets, nodes, blocks, seen = [], [], [], set()
        for node, block, key, text in rows:
            s = shingle_sets([text.encode()], words)[0]
            if node not in seen and set_key(s) == key:  # another row may share the doc_id
                seen.add(node)
                sets.append(s)
                nodes.append(node)
                blocks.append(block)
        found = links_within(sets, nodes, np.array(blocks), percent, len(set(blocks)) > 1) if sets else []
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, []
        for b in batches:
            for c, *row in zip(b["cell"], b["node"].tolist(), b["block"].tolist(), b["set_key"], b["text"]):
                if c != now:
                    if held:
                        yield cell(held)
                    now, held = c, []
                held.append(row)
        if held:
            yield cell(held)

    return run


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, places: int = PLACES,
                    rows_per_band: int = ROWS_PER_BAND, block: int = BLOCK) -> DataFrame:
    """One row per input row: row (a number of its own), doc_id, digest (of
    the text), n_shingles, component_id (the least doc_id of its group of rows linked by a Jaccard
    similarity of at least ``percent``/100 of their word-shingle sets) and
    representative (exactly one row of each group: the least doc_id, then
    the least row).

    Two sets at the threshold share no band with probability
    (1 - 0.8^4)^32 < 1e-7 at the defaults.  Null or empty texts and texts of
    white space have no shingles and are groups of their own; their
    component_id is their doc_id.  A null doc_id is allowed and least.
    Repeated rows are equal texts.  Other columns are ignored; an empty
    table gives no rows.
    """
    run, schema = _signed(words, places, rows_per_band, docs.schema["doc_id"].dataType)
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("digest"), "text")
    base = materialize(numbered.mapInArrow(lean(run), schema), "signatures")
    filled = base.filter("n_shingles > 0")
    classes = materialize(filled.groupBy("set_key").agg(F.min("row").alias("node"), F.min(F.struct("doc_id", "row", "digest")).alias("least"),
                                                        F.any_value("bands").alias("bands")), "classes")
    # buckets: every member to the least
    band = classes.select("node", F.explode("bands").alias("band"))
    # written, so that the join below is one of plain shuffles, whose hot keys Spark splits
    leaders = materialize(band.groupBy("band").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"),
                          "band-leaders")
    loose = band.join(leaders, "band").filter("node <> leader").select(F.col("node").alias("u"), F.col("leader").alias("v")).distinct()
    group = materialize(components(loose), "loose")
    sizes = group.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks"))
    # cells: a pair of blocks of one loose component
    member = (group.join(sizes, "root").join(classes.select("node", "set_key", "least.doc_id", "least.digest"), "node")
              .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    # by text too, as many rows may share a doc_id
    texts = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_digest"), "text").filter(F.col("text").isNotNull())
    member = member.join(texts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")))
    member = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    member = member.select(F.struct("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).alias("c"),
                           "node", "block", "set_key", "text").withColumn("cell", F.concat_ws(":", "c.root", "c.i", "c.j")).drop("c")
    links = (member.repartition("cell").sortWithinPartitions("cell")
             .mapInPandas(lean(_confirm(words, percent)), "u long, v long"))
    found = materialize(components(links), "components")
    least = found.join(classes.select("node", "least"), "node").groupBy("root").agg(F.min("least").alias("first"))
    joined = found.join(least, "root").select("node", "first")
    whose = classes.join(joined, "node", "left").select("set_key", F.coalesce("first", "least").alias("first"))
    own = F.struct("doc_id", "row", "digest")
    linked = filled.join(whose, "set_key").select("row", "doc_id", "digest", "n_shingles", F.col("first.doc_id").alias("component_id"),
                                                  (own == F.col("first")).alias("representative"))
    return linked.unionByName(base.filter("n_shingles = 0").select(
        "row", "doc_id", "digest", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("representative")))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that represent their group.  Of rows that are
    equal in doc_id and text one stays."""
    chosen = near_duplicates(docs, **options).filter("representative").select("doc_id", "digest").distinct()
    key, digest, number = temp("id"), temp("digest"), temp("number")
    chosen = chosen.toDF(key, digest)
    kept = docs.join(chosen, docs["doc_id"].eqNullSafe(F.col(key)) & (F.xxhash64(docs["text"]) == F.col(digest)))
    first = Window.partitionBy(key, digest).orderBy(*[F.col(c) for c in docs.columns if c != "text"])
    return kept.withColumn(number, F.row_number().over(first)).filter(F.col(number) == 1).select(*docs.columns)
