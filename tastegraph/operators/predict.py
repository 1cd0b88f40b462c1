"""Neighbourhood predictions without a table of similarities.

``prediction(u, p) = Σ sim·r / Σ sim`` over the raters v of p that are similar
to u.  Joining every target with all raters of its product forms
Σ (raters)² candidates, and each then has to meet its similarity, which was
made from as many pair rows.  But in the block of p the vectors of all its
raters are at hand (:mod:`tastegraph.operators.topk`), so similarity, rating
and sum are worked out there: a target is one row that comes in and one row
that goes out, whatever the number of raters.

A hot product is split into cells of parts of its raters, whose sums are added
up; owners of very many ratings do not travel and take part through joins
restricted to them.  ``k`` keeps the k most similar raters of each target
(ties by id): each cell sends its k best, and the best of those count.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.operators.similarity import DEFAULT_HOT_THRESHOLD, split_join, unit_rows, user_center_scale
from tastegraph.operators.topk import CELL, LONG, Cell, _of_long, _ranges, _rounded, deal, in_cells, parted
from tastegraph.schema import PRODUCT, RATING, USER
from tastegraph.session import materialize

_COLUMNS = ["owner", "keys", "values", "blocks", "ratings"]


def _cell(group: pa.Table, blocks: int, k: int | None, least: float, whole: bool = False) -> pa.Table:
    """Sums of the targets of a cell: a row per (owner, key) with similar
    raters, or with ``k`` one for each of its k most similar ones, unless the
    cell has the ``whole`` of its targets' raters."""
    c = Cell(group, blocks, wanted=True)
    edge = np.append(0, np.cumsum(c.wanted_size))
    n_rows, found = len(c.size), []
    begin, many, listed = c.own
    for rows in c.batches(np.flatnonzero(c.asks)):
        pairs, (xy,), _ = c.totals(rows, False)
        at = _ranges(edge[rows], c.wanted_size[rows])  # the questions, and then their answers
        key, row = c.wanted[at], np.repeat(rows, c.wanted_size[rows])
        question = np.repeat(np.arange(len(key)), many[key])
        entry = listed[_ranges(begin[key], many[key])]
        place, rater = np.searchsorted(rows, row)[question], c.whose[entry]
        code = place * n_rows + rater
        if c.n_hot:
            asked, code = np.unique(code, return_inverse=True)
            total = _found(pairs, xy, asked)
            c.add_hot(rows, asked // n_rows, asked % n_rows, [total])
            sim = _rounded(total[code])
        else:
            sim = _rounded(_found(pairs, xy, code))
        good = (sim > least) & (c.same[rater] != c.same[rows[place]])
        sim, question, rating, rater = sim[good], question[good], c.ratings[entry[good]], rater[good]
        if k is not None:
            order = np.lexsort((rater, -sim, question))
            top = np.arange(len(order)) - np.searchsorted(question[order], question[order]) < k
            order = order[top]
            sim, question, rating, rater = sim[order], question[order], rating[order], rater[order]
        if k is None or whole:
            n = np.bincount(question, minlength=len(key))
            hit = np.flatnonzero(n)
            totals = (np.bincount(question, x, len(key))[hit].astype(np.float64) for x in (sim * rating, sim))
            found.append((row[hit], key[hit], *totals, n[hit], row[hit]))
        else:
            found.append((row[question], key[question], sim * rating, sim, np.ones(len(sim), np.int64), rater))
    none = [np.empty(0, np.int64)] * 2 + [np.empty(0)] * 2 + [np.empty(0, np.int64)] * 2
    u, p, weighted, sims, n, rater = (np.concatenate(x) for x in zip(*found)) if found else none
    return pa.table([c.owner.take(pa.array(u)), c.names.take(pa.array(p)), pa.array(weighted), pa.array(sims), pa.array(n.astype(np.int64)),
                     c.owner.take(pa.array(rater))], names=["owner", "key", "weighted", "sims", "n", "other"])


def _found(pairs: np.ndarray, sums: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The sums of the asked pairs, 0 for those that are none of ``pairs``."""
    if not len(pairs):
        return np.zeros(len(asked))
    at = np.minimum(np.searchsorted(pairs, asked), len(pairs) - 1)
    return np.where(pairs[at] == asked, sums[at], 0.0)


def predict(m: DataFrame, targets: DataFrame | None = None, min_similarity: float = 0.0, k: int | None = None,
            cell: int = CELL, long: int = LONG, hot_threshold: int | None = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """``(user_id, product_id, prediction, n_neighbours)`` for the distinct
    (user, product) pairs ``targets`` (default: every rated pair), from the
    ratings ``m`` (M3; written, as it is read several times): Σ(sim·r) / Σ sim
    over the other users that rated the product and have a centred cosine (N4,
    six decimals) above ``min_similarity``, or over the ``k`` most similar of
    them.  Targets without such a user have no row; neither has a null."""
    z = unit_rows(user_center_scale(m, keep_rating=True), USER)
    d = deal(z.select(F.col(USER).alias("owner"), F.col(PRODUCT).alias("key"), F.col("w").alias("value"), F.col(RATING).alias("rating")),
             cell, long, ("rating",))
    blocks = d.blocks
    asked = None if targets is None else materialize(targets.select(F.col(USER).alias("owner"), F.col(PRODUCT).alias("key")).dropna().distinct(), "targets")
    kinds = {c: d.entries.schema[c].dataType.simpleString() for c in ("owner", "key")}
    schema = f"owner {kinds['owner']}, key {kinds['key']}, weighted double, sims double, n long, other {kinds['owner']}"
    nothing = F.array().cast(f"array<{kinds['key']}>")

    whole = d.hot is None and not d.any_long  # then one cell has all raters of a target

    def summed(rows: DataFrame, cells: int) -> DataFrame:
        return in_cells(rows, lambda g: _cell(g, blocks, k, min_similarity, whole), schema, cells)

    def in_turns(rows: Callable[[int], DataFrame]) -> DataFrame:
        """The sums of the blocks that are not hot, written turn by turn if there are several turns."""
        made = [summed(rows(turn), -(-d.blocks // d.rounds) * d.parts) for turn in range(d.rounds)]
        return reduce(DataFrame.unionByName, [materialize(x, "sums-of-turn") for x in made] if d.rounds > 1 else made)

    blocked = None if asked is None else asked  # with the block of each target
    if blocked is not None:
        if d.hot is not None:
            blocked = blocked.join(d.hot, "key", "left").withColumn("block", F.coalesce("hot_block", d.cold_block()))
        else:
            blocked = blocked.withColumn("block", d.cold_block()).withColumn("hot_block", F.lit(None).cast("long")).withColumn("parts", F.lit(1))
        lists = blocked.groupBy("owner", "block").agg(F.collect_list("key").alias("wanted"), F.first("hot_block").alias("hot_block"), F.first("parts").alias("parts"))
        asking = materialize(d.vectors.select(*_COLUMNS).join(lists, "owner"), "asking")
    if asked is None:  # each owner asks for the keys that it has
        mine = F.transform(F.filter(F.arrays_zip("keys", "blocks"), lambda x: x["blocks"] == F.col("block")), lambda x: x["keys"])
        found = in_turns(lambda turn: d.cold(tuple(_COLUMNS), turn).withColumn("wanted", F.when(F.col("asks"), mine).otherwise(nothing)))
    else:
        own = F.pmod(F.xxhash64("owner", F.lit(7)), F.lit(d.parts)).cast("int")
        cell = F.struct("block", own.alias("i"), F.lit(0).alias("j")).alias("cell")
        ask = asking.filter("hot_block is null").select(*_COLUMNS, "block", cell, F.lit(True).alias("asks"), F.lit(False).alias("answers"), "wanted")
        found = in_turns(lambda turn: ask.filter(d.now(F.col("block"), turn)).unionByName(
            d.cold(tuple(_COLUMNS), turn).withColumn("asks", F.lit(False)).withColumn("wanted", nothing)))
    if d.hot is not None:
        hot = d.vectors.filter(F.exists("hot", lambda h: h)).select(*_COLUMNS, F.explode(F.filter("blocks", lambda b: b >= d.blocks)).alias("hot_block"))
        hot = hot.join(d.hot.withColumnRenamed("key", "hot_key"), "hot_block")
        ask = hot.withColumn("wanted", F.array("hot_key")).drop("hot_key") if asked is None else asking.filter("hot_block is not null").drop("block")
        rows = [parted(ask, True), parted(hot.drop("hot_key").withColumn("wanted", nothing), False)]
        columns = [*_COLUMNS, "block", "cell", "asks", "answers", "wanted"]
        found = found.unionByName(summed(rows[0].select(*columns).unionByName(rows[1].select(*columns)), d.hot_cells()))
    if d.any_long:
        found = found.unionByName(_with_long(d, asked, min_similarity, hot_threshold, long))
    if k is not None and not whole:
        best = Window.partitionBy("owner", "key").orderBy(F.desc("sims"), F.asc("other"))
        found = found.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= k)
    if whole:
        total = found.withColumnRenamed("n", "n_neighbours")
    else:
        total = found.groupBy("owner", "key").agg(F.sum("weighted").alias("weighted"), F.sum("sims").alias("sims"), F.sum("n").alias("n_neighbours"))
    return (total.select(F.col("owner").alias(USER), F.col("key").alias(PRODUCT), F.try_divide("weighted", "sims").alias("prediction"), "n_neighbours")
            .filter(F.col("prediction").isNotNull()))


def _with_long(d, asked: DataFrame | None, least: float, hot_threshold: int | None, long: int) -> DataFrame:
    """The terms of targets and raters of which one at least does not travel."""
    near = materialize(_of_long(d.entries, d.sizes, long, False, 1, hot_threshold).filter(F.col("sim") > least).select("owner", "other", "sim"), "similar-to-long")
    flag = d.sizes.select("owner", (F.col("size") > long).alias("long"))
    rows = materialize(d.entries.select("owner", "key", "rating").join(flag, "owner"), "flagged-ratings")
    ratings = rows.select(F.col("owner").alias("other"), "key", "rating", "long")
    targets = (rows.select("owner", "key", "long") if asked is None else asked.join(flag, "owner"))
    met = [split_join(t.select("owner", "key"), r.select("other", "key", "rating"), "key", "owner", "other", hot_threshold)
           for t, r in ((targets, ratings.filter("long")), (targets.filter("long"), ratings.filter("not long")))]
    met = met[0].unionByName(met[1]).join(near, ["owner", "other"])
    return met.select("owner", "key", (F.col("sim") * F.col("rating")).alias("weighted"), F.col("sim").alias("sims"), F.lit(1).cast("long").alias("n"), "other")
