"""Exact top-k similarity lists without a table of pairs.

The pair join of :mod:`tastegraph.operators.similarity` forms a row for every
two owners (users or products) and every key they share, Σ (raters)², and
most of them cannot enter a list of k.  Here owners' *vectors* travel instead:

1. Keys are dealt into blocks whose vectors fit a task (``CELL`` entries), and
   every owner's vector goes once to each block it has a key in.
2. In a block (:func:`_cell`) inverted lists over its owners add up an owner's
   similarities whole, over all their keys, and only the k best of an owner
   leave.  A pair that shares keys of several blocks is taken in the block of
   its first shared key, so once.  Blocks take turns, so that no more than
   ``ROUND_SHARE`` times the entries are in shuffle files at once; the lists so
   far are merged with each turn's.
3. A *hot* key, whose vectors exceed a block, is split into cells of owners'
   parts and comes after all others in that order: a pair is first met there
   only if it shares hot keys alone.  For the cosine such a pair scores no more
   than the product of the norms that are left from that key on, so an owner
   asks a hot key only if that product, with the largest norm left there, can
   reach the k-th score it has already (remaining-norm bound).
4. An owner of more than ``LONG`` keys does not travel: its pairs are formed
   by the pair join, restricted to it on one side, and merged in.

What leaves the tasks is at most k rows per owner and block, the top k of all
of them is the top k of all pairs, and similarities are sums over the shared
keys in one order, whoever of the two asks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.functions import safe_ratio
from tastegraph.operators.similarity import DEFAULT_HOT_THRESHOLD, split_join, top_k_per, unit_rows
from tastegraph.schema import RATING
from tastegraph.session import give_back, materialize, release

#: Entries of vectors in one block or cell, about.
CELL = 4_000_000
#: Products that one task adds up, about.  Each part of a block's asking owners
#: gets all of its vectors, so parts cost disk.
WORK = 8_000_000
#: Entries of vectors that are sent to blocks at a time, at least, and as a
#: multiple of all entries.
ROUND, ROUND_SHARE = 32_000_000, 3
#: Entries of a vector that travels.
LONG = 4_096
DIGITS = 6
#: Products of a batch, about.
_BATCH = 250_000
_VECTOR = ["owner", "keys", "values", "blocks"]


def _order(corated: bool) -> list[Column]:
    return [F.desc("sim"), *([F.desc("n")] if corated else []), F.asc("other")]


def _rounded(x: np.ndarray) -> np.ndarray:
    """Half away from zero at ``DIGITS`` decimals."""
    return np.copysign(np.floor(np.abs(x) * 10 ** DIGITS + 0.5), x) / 10 ** DIGITS + 0.0


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0] … start[0] + size[0] − 1, start[1] …"""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


class Cell:
    """The rows of one block or cell: owners with their vectors, first the keys
    that are not hot, and inverted lists of those over the owners that answer."""

    def __init__(self, group: pa.Table, blocks: int, wanted: bool = False):
        group = group.sort_by("owner")  # ties go by owner
        self.block, self.owner = group.column("block")[0].as_py(), group.column("owner").combine_chunks()
        self.hot, self.first_hot = self.block >= blocks, blocks
        self.asks, answers = (group.column(c).to_numpy() for c in ("asks", "answers"))
        lists = {c: group.column(c).combine_chunks() for c in ("keys", "values", "blocks", *(["ratings", "wanted"] if wanted else []))}
        offsets = np.asarray(lists["keys"].offsets).astype(np.int64)
        self.start, size = offsets[:-1], np.diff(offsets)
        flat = {c: x.flatten() for c, x in lists.items()}
        coded = pa.concat_arrays([flat["keys"], flat["wanted"]]) if wanted else flat["keys"]
        coded = coded.dictionary_encode()
        code, self.names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        self.key, self.wanted = code[:len(flat["keys"])], code[len(flat["keys"]):]
        if wanted:
            self.ratings, self.wanted_size = flat["ratings"].to_numpy(), np.diff(np.asarray(lists["wanted"].offsets)).astype(np.int64)
        self.value, self.blocks = flat["values"].to_numpy(), flat["blocks"].to_numpy()
        self.whose = np.repeat(np.arange(len(size)), size)
        self.same = self.owner.dictionary_encode().indices.to_numpy()  # an owner may ask in one row and answer in another
        ordinary = self.blocks < blocks
        self.size = np.bincount(self.whose[ordinary], minlength=len(size))  # of what is not hot; the rest of a vector comes behind
        self.rest = size - self.size
        self.first, self.many, self.listed = self._lists(np.flatnonzero(ordinary & answers[self.whose]))
        self.own = (self.first, self.many, self.listed) if not self.hot else self._lists(np.flatnonzero((self.blocks == self.block) & answers[self.whose]))
        # hot keys get numbers of their own
        hot_keys, self.hot_key = np.unique(self.key[~ordinary]), np.zeros(len(self.names), np.int64)
        self.hot_key[hot_keys], self.n_hot = np.arange(len(hot_keys)), len(hot_keys)

    def _lists(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        entries = entries[np.argsort(self.key[entries], kind="stable")]
        many = np.bincount(self.key[entries], minlength=len(self.names))
        return np.cumsum(many) - many, many, entries

    def batches(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """The rows in batches of few products."""
        ordinary, own = self.blocks < self.first_hot, self.own[1]
        work = np.bincount(self.whose[ordinary], self.many[self.key[ordinary]], len(self.size))
        if self.hot:
            mine = self.blocks == self.block
            work = work + np.bincount(self.whose[mine], own[self.key[mine]], len(self.size))
        if len(self.wanted):
            work = work + np.bincount(np.repeat(np.arange(len(self.size)), self.wanted_size), own[self.wanted], len(self.size))
        edge, at = np.cumsum(work[rows] + 1), 0
        while at < len(rows):
            end = max(at + 1, int(np.searchsorted(edge, (edge[at - 1] if at else 0) + _BATCH, "right")))
            yield rows[at:end]
            at = end

    def totals(self, rows: np.ndarray, corated: bool) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """The pairs that share a key which is not hot, one of them of ``rows``
        (place in ``rows`` times the rows of the cell, plus the other row; in
        order), their sums over such keys (xy and, co-rated, xx, yy and the
        number of shared keys), and the block of their first shared key."""
        mine = _ranges(self.start[rows], self.size[rows])
        many = self.many[self.key[mine]]
        met = self.listed[_ranges(self.first[self.key[mine]], many)]
        code = np.repeat(np.repeat(np.arange(len(rows)) * len(self.size), self.size[rows]), many) + self.whose[met]
        n, dense = len(rows) * len(self.size), len(rows) * len(self.size) <= 4 * len(code)
        if not dense:  # most pairs share nothing
            pairs, code = np.unique(code, return_inverse=True)
            n = len(pairs)
        x, y = np.repeat(self.value[mine], many), self.value[met]
        # of nothing at all, bincount gives integers
        sums = [np.bincount(code, w, n).astype(np.float64, copy=False) for w in ((x * y, x * x, y * y) if corated else (x * y,))]
        if corated:
            sums.append(np.bincount(code, minlength=n))
        first = np.full(n, -1)
        first[code[::-1]] = self.blocks[met][::-1]  # of several writes the last one stays: the first key
        if dense:
            pairs = np.flatnonzero(first >= 0)
            sums, first = [s[pairs] for s in sums], first[pairs]
        return pairs, sums, first

    def add_hot(self, rows: np.ndarray, place: np.ndarray, near: np.ndarray, sums: list[np.ndarray]) -> np.ndarray:
        """Add what the pairs (rows[place], near) share of hot keys to their
        sums; the block of the first shared hot key (-1: none)."""
        first = np.full(len(near), -1)
        if not self.n_hot or not len(near):
            return first
        def entries(r: np.ndarray) -> np.ndarray:
            return _ranges(self.start[r] + self.size[r], self.rest[r])
        mine, theirs = entries(rows), entries(near)
        slot = np.repeat(np.arange(len(rows)) * self.n_hot, self.rest[rows]) + self.hot_key[self.key[mine]]
        has, at = np.zeros(len(rows) * self.n_hot, bool), np.zeros(len(rows) * self.n_hot)
        has[slot], at[slot] = True, self.value[mine]
        slot = np.repeat(place * self.n_hot, self.rest[near]) + self.hot_key[self.key[theirs]]
        shared = np.flatnonzero(has[slot])
        pair = np.repeat(np.arange(len(near)), self.rest[near])[shared]
        x, y = at[slot[shared]], self.value[theirs[shared]]
        for total, add in zip(sums, (x * y, x * x, y * y, np.ones(len(x)))):
            total += np.bincount(pair, add, len(near)).astype(total.dtype)
        first[pair[::-1]] = self.blocks[theirs[shared]][::-1]
        return first


def _cell(group: pa.Table, blocks: int, k: int, corated: bool, least: int) -> pa.Table:
    """The k best of each asking owner among the pairs that the cell takes."""
    c = Cell(group, blocks)
    n_rows, found = len(c.size), []
    for rows in c.batches(np.flatnonzero(c.asks)):
        pairs, sums, first = c.totals(rows, corated)
        if c.hot:  # its key, but no ordinary one
            begin, many, listed = c.own
            asked = np.flatnonzero((c.blocks == c.block) & np.isin(c.whose, rows))
            ways = np.repeat(np.searchsorted(rows, c.whose[asked]), many[c.key[asked]])
            met = ways * n_rows + c.whose[listed[_ranges(begin[c.key[asked]], many[c.key[asked]])]]
            met = met[~np.isin(met, pairs)]
            sums = [np.zeros(len(met), s.dtype) for s in sums]
        else:
            here = first == c.block
            met, sums = pairs[here], [s[here] for s in sums]
        place, near = met // n_rows, met % n_rows
        other = c.same[near] != c.same[rows[place]]
        place, near, sums = place[other], near[other], [s[other] for s in sums]
        first = c.add_hot(rows, place, near, sums)
        if corated:
            norm = np.sqrt(sums[1]) * np.sqrt(sums[2])
            sim, n = np.divide(sums[0], norm, out=np.zeros(len(norm)), where=norm != 0), sums[3]
        else:
            sim, n = sums[0], np.zeros(len(near), np.int64)
        taken = n >= least if corated else np.ones(len(near), bool)
        if c.hot:  # the first key that they share
            taken &= first == c.block
        sim, n, near, place = _rounded(sim[taken]), n[taken], near[taken], place[taken]
        if len(place) and np.bincount(place).max() > k:
            best = np.lexsort((near, -n, -sim, place) if corated else (near, -sim, place))
            place = place[best]
            top = np.arange(len(place)) - np.searchsorted(place, place) < k
            best, place = best[top], place[top]
            sim, n, near = sim[best], n[best], near[best]
        found.append((rows[place], near, sim, n))
    u, v, sim, n = (np.concatenate(x) for x in zip(*found)) if found else [np.empty(0, np.int64)] * 2 + [np.empty(0), np.empty(0, np.int64)]
    return pa.table([c.owner.take(pa.array(u)), c.owner.take(pa.array(v)), pa.array(sim), pa.array(n.astype(np.int64))], names=["owner", "other", "sim", "n"])


def in_cells(rows: DataFrame, made: Callable[[pa.Table], pa.Table], schema: str, cells: int) -> DataFrame:
    """``made`` of each cell.  Cells are few bytes but much work, so they get
    partitions of their own, which Spark does not coalesce.  A worker returns
    what a cell has freed before it takes the next one."""
    def lean(group: pa.Table) -> pa.Table:
        try:
            return made(group)
        finally:
            give_back()

    return rows.repartition(min(2 * cells, 20_000), "cell").groupBy("cell").applyInArrow(lean, schema)


def _asked(rows: DataFrame, d: "Dealt", cells: int, k: int, corated: bool, least: int) -> DataFrame:
    kind, blocks = rows.schema["owner"].dataType.simpleString(), d.blocks
    return in_cells(rows, lambda g: _cell(g, blocks, k, corated, least), f"owner {kind}, other {kind}, sim double, n long", cells)


def _of_long(entries: DataFrame, sizes: DataFrame, long: int, corated: bool, least: int, hot_threshold: int | None) -> DataFrame:
    """Both directions of all pairs with an owner of more than ``long`` keys."""
    flagged = materialize(entries.join(sizes.select("owner", (F.col("size") > long).alias("long")), "owner"), "owner-rows")
    one = flagged.filter("long").select(F.col("owner").alias("a"), "key", F.col("value").alias("x"))
    two = flagged.select(F.col("owner").alias("b"), "key", F.col("value").alias("y"), F.col("long").alias("both"))
    met = split_join(one, two, "key", "a", "b", hot_threshold).filter(F.col("a") != F.col("b"))
    sums = met.groupBy("a", "b", "both").agg(F.sum(F.col("x") * F.col("y")).alias("xy"), F.sum(F.col("x") * F.col("x")).alias("xx"),
                                             F.sum(F.col("y") * F.col("y")).alias("yy"), F.count(F.lit(1)).alias("n"))
    sim = safe_ratio(F.col("xy"), F.sqrt("xx") * F.sqrt("yy")) if corated else F.col("xy")
    pairs = sums.filter(F.col("n") >= (least if corated else 1)).select("a", "b", "both", F.round(sim, DIGITS).alias("sim"),
                                                                        (F.col("n") if corated else F.lit(0).cast("long")).alias("n"))
    ways = F.array(F.struct(F.col("a").alias("owner"), F.col("b").alias("other")), F.struct(F.col("b").alias("owner"), F.col("a").alias("other")))
    # two long owners meet in both orders already
    return pairs.select(F.explode(F.when(F.col("both"), F.slice(ways, 1, 1)).otherwise(ways)).alias("way"), "sim", "n").select("way.*", "sim", "n")


def _held(sizes: list, blocks: int) -> float:
    """Entries of vectors that one of ``blocks`` gets, about."""
    return sum(r["count"] * r["size"] * (1 - (1 - 1 / blocks) ** r["size"]) for r in sizes)


def _blocks(sizes: list, cell: int) -> int:
    """The least number of blocks for which a block holds ``cell`` entries of
    vectors at most: an owner of n keys goes to it with 1 − (1 − 1/blocks)ⁿ."""
    most = 1
    while _held(sizes, most) > cell:
        most *= 2
    least = most // 2 + 1
    while least < most:
        middle = (least + most) // 2
        least, most = (middle + 1, most) if _held(sizes, middle) > cell else (least, middle)
    return most


@dataclass
class Dealt:
    """Owners' vectors, and where each key's owners meet."""

    entries: DataFrame       # owner, key, value and the extra columns; written
    sizes: DataFrame         # owner, size; written
    any_long: bool
    blocks: int              # blocks of the keys that are not hot
    parts: int               # of the asking owners of such a block
    hot: DataFrame | None    # hot_block, key, parts; written
    vectors: DataFrame       # of the owners that travel: owner, keys, values, blocks, hot and the extra lists; written
    rounds: int = 1          # in which blocks that are not hot take turns

    def cold(self, columns: tuple[str, ...] = tuple(_VECTOR), turn: int = 0) -> DataFrame:
        """Vectors in the cells of the blocks of a turn: an owner answers in all
        parts of a block, and asks in one."""
        rows = self.vectors.select(*columns, F.explode(F.array_distinct(F.filter("blocks", lambda b: self.now(b, turn)))).alias("block"))
        own = F.pmod(F.xxhash64("owner", F.lit(7)), F.lit(self.parts)).cast("int")
        rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(self.parts - 1))))
        return rows.select(*columns, "block", F.struct("block", F.col("part").alias("i"), F.lit(0).alias("j")).alias("cell"),
                           (F.col("part") == own).alias("asks"), F.lit(True).alias("answers"))

    def now(self, block: Column, turn: int) -> Column:
        """Whether a block is one of the turn's, and not hot."""
        cold = block < self.blocks
        return cold & (F.pmod(block, F.lit(self.rounds)) == turn) if self.rounds > 1 else cold

    def hot_cells(self) -> int:
        return self.hot.agg(F.sum(F.col("parts").cast("long") * F.col("parts"))).first()[0]

    def cold_block(self, key: str = "key") -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.blocks)).cast("long")


def deal(entries: DataFrame, cell: int, long: int, extra: tuple[str, ...] = ()) -> Dealt:
    """Deal the keys of ``(owner, key, value, *extra)`` into blocks by what the
    vectors of their owners weigh."""
    entries = materialize(entries.select("owner", "key", F.col("value").cast("double").alias("value"), *extra).dropna(), "entries")
    sizes = materialize(entries.groupBy("owner").agg(F.count(F.lit(1)).alias("size")), "owner-sizes")
    any_long = sizes.filter(F.col("size") > long).limit(1).count() > 0
    short = entries.join(sizes.filter(F.col("size") > long), "owner", "left_anti") if any_long else entries
    loads = materialize(short.join(sizes, "owner").groupBy("key").agg(F.sum("size").alias("load"), F.count(F.lit(1)).alias("n")), "key-loads")
    products = F.when(F.col("load") <= cell, F.col("n").cast("double") * F.col("n"))
    heat = loads.agg(F.coalesce(F.sum(products), F.lit(0.0)).alias("products"), F.max("load").alias("most")).first()
    counts = sizes.filter(F.col("size") <= long).groupBy("size").count().collect()  # at most ``long`` rows
    blocks = _blocks(counts, cell)
    parts = min(max(1, math.ceil(heat["products"] / blocks / WORK)), max(1, math.ceil(cell / 1000)))
    sent, kept = parts * blocks * _held(counts, blocks), sum(r["count"] * r["size"] for r in counts)
    made = Dealt(entries, sizes, any_long, blocks, parts, None, None, min(blocks, max(1, math.ceil(sent / max(ROUND, ROUND_SHARE * kept)))))
    if (heat["most"] or 0) > cell:
        # no more hot keys than the total load holds cells
        made.hot = materialize(loads.filter(F.col("load") > cell).select(
            "key", (F.lit(made.blocks) + F.row_number().over(Window.orderBy("key")) - 1).cast("long").alias("hot_block"),
            F.ceil(F.col("load") / cell).cast("int").alias("parts")), "hot-blocks")
        placed = short.join(made.hot.select("key", "hot_block"), "key", "left").withColumn("block", F.coalesce("hot_block", made.cold_block()))
    else:
        placed = short.withColumn("hot_block", F.lit(None).cast("long")).withColumn("block", made.cold_block())
    vector = F.array_sort(F.collect_list(F.struct(F.col("hot_block").isNotNull().alias("hot"), "key", "value", "block", *extra)))
    lists = {"keys": "key", "values": "value", "blocks": "block", "hot": "hot", **{f"{c}s": c for c in extra}}
    made.vectors = materialize(placed.groupBy("owner").agg(vector.alias("v")).select("owner", *[F.col(f"v.{c}").alias(n) for n, c in lists.items()]), "vectors")
    release(loads, *([] if any_long else [entries]))
    return made


def parted(df: DataFrame, asks: bool, block: str = "hot_block") -> DataFrame:
    """The rows of a hot block with owner and parts, sent to its cells: an
    asking owner meets every part of the answering ones."""
    part, every = F.pmod(F.xxhash64("owner"), F.col("parts")).cast("int"), F.sequence(F.lit(0), F.col("parts") - 1)
    rows = df.withColumn("own_part", part).withColumn("other_part", F.explode(every))
    i, j = ("own_part", "other_part") if asks else ("other_part", "own_part")
    cell = F.struct(F.col(block).alias("block"), F.col(i).alias("i"), F.col(j).alias("j"))
    return (rows.withColumn("cell", cell).withColumn("block", F.col(block)).withColumn("asks", F.lit(asks)).withColumn("answers", F.lit(not asks))
            .drop("own_part", "other_part", "parts"))


def nearest(entries: DataFrame, owner: str, shared: str, value: str, k: int, measure: str = "cosine", min_overlap: int = 1,
            cell: int = CELL, long: int = LONG, hot_threshold: int | None = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """``(owner, other, sim, n, rank)``: the k most similar other owners of
    every owner, among those that share a key with it (n: the number of shared
    keys if co-rated, else 0).

    ``entries`` has one row per (owner, shared).  ``measure`` "cosine" takes
    unit vectors and ranks by the rounded dot product, then id; "corated" is
    the cosine over the shared keys only (0 for a zero norm), ranked by it, by
    the number n of shared keys (``min_overlap`` at least), then id.  Rows
    with a null owner, key or value are left out; an empty table gives no rows.
    """
    corated = {"cosine": False, "corated": True}[measure]
    d = deal(entries.select(F.col(owner).alias("owner"), F.col(shared).alias("key"), F.col(value).alias("value")), cell, long)
    best = None
    for turn in range(d.rounds):
        found = _asked(d.cold(turn=turn), d, -(-d.blocks // d.rounds) * d.parts, k, corated, min_overlap)
        if d.rounds > 1:
            every = found if best is None else best.unionByName(found)
            before, best = best, materialize(top_k_per(every, "owner", _order(corated), k).drop("k"), "lists-so-far")
            found = best
            release(*([before] if before is not None else []))
    if d.any_long:
        found = found.unionByName(_of_long(d.entries, d.sizes, long, corated, min_overlap, hot_threshold))
    if d.hot is not None:
        found = materialize(found, "lists-of-cold-keys")
        found = found.unionByName(_of_hot(d, found, k, corated, min_overlap))
    ranked = top_k_per(found, "owner", _order(corated), k)
    return ranked.select(F.col("owner").alias(owner), "other", "sim", "n", F.col("k").alias("rank"))


def _of_hot(d: Dealt, found: DataFrame, k: int, corated: bool, least: int) -> DataFrame:
    """The k best of each owner among pairs that share hot keys only."""
    # one row per owner and hot key, with the norm that is left from it on
    at = F.transform(F.filter(F.sequence(F.lit(0), F.size("keys") - 1), lambda i: F.get(F.col("hot"), i)), lambda i: F.struct(
        F.get(F.col("blocks"), i).alias("hot_block"),
        F.sqrt(F.aggregate(F.slice(F.col("values"), i + 1, F.size("values")), F.lit(0.0), lambda s, x: s + x * x)).alias("rest")))
    rows = d.vectors.filter(F.exists("hot", lambda h: h)).select(*_VECTOR, F.explode(at).alias("at")).select(*_VECTOR, "at.*")
    rows = rows.join(d.hot.select("hot_block", "parts"), "hot_block")
    asking = rows
    if not corated:
        reach = rows.groupBy("hot_block").agg(F.max("rest").alias("reach"))
        kth = top_k_per(found, "owner", _order(corated), k).filter(F.col("k") == k).select("owner", F.col("sim").alias("kth"))
        asking = rows.join(reach, "hot_block").join(kth, "owner", "left")
        # 1e-6: scores are rounded, and ties are broken by id
        asking = asking.filter(F.col("kth").isNull() | (F.col("rest") * F.col("reach") >= F.col("kth") - 10.0 ** -DIGITS)).drop("reach", "kth")
    return _asked(parted(asking.drop("rest"), True).unionByName(parted(rows.drop("rest"), False)), d, d.hot_cells(), k, corated, least)


def nearest_by_cosine(z: DataFrame, owner: str, shared: str, k: int, **options) -> DataFrame:
    """The k nearest owners by cosine of centred ratings ``z`` (N1),
    with the norm of the whole vector; zero vectors have no list."""
    return nearest(unit_rows(z, owner), owner, shared, "w", k, "cosine", **options)


def nearest_by_corated(m: DataFrame, owner: str, shared: str, k: int, min_overlap: int = 1, **options) -> DataFrame:
    """The k nearest owners by the cosine over co-rated keys."""
    return nearest(m, owner, shared, RATING, k, "corated", min_overlap, **options)
