"""Normalisation, co-rater pairs and similarity measures.

Similarities are *sparse edge lists* ``(id1, id2, sim, …)`` over pairs that
share at least one co-rated item; nothing dense is built.

The quadratic step is the self-join of ratings on the shared key (product for
user-user measures, user for item-item).  Its cost is the sum over groups of
(group size)².  ``hot_threshold`` keeps it distributed at any skew: the keys
of groups above the threshold are listed once.  Without any, the join is a
plain one, whose shuffle AQE may still coalesce or split.  With some, sums
over shared keys (M8, N3–N5) multiply them block by block
(:mod:`tastegraph.operators.gram`); where the pairs themselves are asked for
(J2), only their rows are dealt into blocks: a group of n rows gets
⌈n / threshold⌉ hash buckets, and every pair of buckets is a join key of its
own, so no task sees more than threshold² candidate pairs; the other keys keep
the plain join.  Lists of the k nearest need no pairs at all
(:mod:`tastegraph.operators.topk`).
``cap_raters`` (N6) bounds the groups by sampling; no other operator uses it
unless asked to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.functions import safe_ratio
from tastegraph.operators.gram import pair_sums
from tastegraph.schema import PRODUCT, RATING, USER
from tastegraph.session import materialize

DEFAULT_HOT_THRESHOLD = 2000


# ---------------------------------------------------------------- N1, N2

def user_center_scale(m: DataFrame, keep_rating: bool = False) -> DataFrame:
    """N1 + N2: ``z = (r − mean_u) / (max_u − min_u)`` over the user's rated
    items; users whose ratings are all equal are dropped *before* dividing.

    Stats come from a ``groupBy`` joined back rather than a window: the
    aggregate is partial (map-side) and the join can be split by AQE if one
    user holds a large share of the rows — a window partition cannot.
    """
    st = (m.groupBy(USER).agg(F.avg(RATING).alias("_mu"), (F.max(RATING) - F.min(RATING)).alias("_rg"))
          .filter(F.col("_rg") > 0))
    return (m.join(st, USER)
            .select(USER, PRODUCT, ((F.col(RATING) - F.col("_mu")) / F.col("_rg")).alias("z"), *([RATING] if keep_rating else [])))


def drop_constant_users(m: DataFrame) -> DataFrame:
    """N2 as its own query: the users that survive, with their item count."""
    return (m.groupBy(USER).agg((F.max(RATING) - F.min(RATING)).alias("_rg"), F.count(F.lit(1)).alias("n_products"))
            .filter(F.col("_rg") > 0).select(USER, "n_products"))


def unit_rows(z: DataFrame, owner: str) -> DataFrame:
    """Divide every ``z`` by the L2 norm of its owner's vector (owner = user
    for user-user cosine, product for item-item); zero vectors are dropped, so
    they never produce a similarity.  Normalising the inputs once is cheaper
    than joining both norms onto every pair afterwards."""
    norms = z.groupBy(owner).agg(F.sqrt(F.sum(F.col("z") * F.col("z"))).alias("_norm")).filter(F.col("_norm") > 0)
    return z.join(norms, owner).withColumn("w", F.col("z") / F.col("_norm")).drop("_norm")


# ---------------------------------------------------------------- N6

def cap_raters(m: DataFrame, n: int = 500, seed: int = 42) -> DataFrame:
    """Products with more than *n* raters keep *n* of them, chosen by the
    md5 of ``seed|user|product`` (ties by user) — the same sample for the same
    seed under any partitioning.  ``row_number ≤ n`` (n ≤ 1000) is planned as
    a WindowGroupLimit in front of the shuffle, so even a product holding a
    large share of all ratings sends at most n rows per map task."""
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(USER).cast("string"), F.col(PRODUCT).cast("string")))
    w = Window.partitionBy(PRODUCT).orderBy(key, F.col(USER))
    return m.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


# ---------------------------------------------------------------- J2 and the generic self-join

def self_pairs(df: DataFrame, key: str, member: str, values: list[str],
               hot_threshold: int | None = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """All unordered member pairs within each ``key`` group.

    ``df`` has one row per (key, member).  Output: ``key, m1, m2`` with
    ``m1 < m2`` plus ``<v>_1`` / ``<v>_2`` for each value column.  With
    ``hot_threshold=None`` it is the plain theta self-join
    ``a.key = b.key AND a.member < b.member``; otherwise groups above the
    threshold are split into hash-bucket blocks (see the module docstring).
    """
    def side(x, suffix, mcol):
        return [F.col(mcol).alias("m" + suffix)] + [F.col(v).alias(f"{v}_{suffix}") for v in values]

    base = df.select(key, member, *values)
    if hot_threshold is None:
        a = base.select(key, *side(base, "1", member))
        b = base.select(key, *side(base, "2", member))
        return a.join(b, [key]).filter(F.col("m1") < F.col("m2"))

    hot = materialize(base.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_threshold)
                      .select(key, F.ceil(F.col("_n") / F.lit(hot_threshold)).cast("int").alias("_s")), "hot-keys")
    none_hot = hot.limit(1).count() == 0
    rest = base if none_hot else base.join(hot, key, "left_anti")
    plain = (rest.select(key, *side(rest, "1", member)).join(rest.select(key, *side(rest, "2", member)), [key])
             .filter(F.col("m1") < F.col("m2")))
    if none_hot:
        return plain
    x = base.join(hot, key).withColumn("_b", F.pmod(F.xxhash64(F.col(member)), F.col("_s")).cast("int"))
    # bucket b sends its rows to the cells (b, j), j ≥ b, as the left side and
    # to the cells (i, b), i ≤ b, as the right side
    left = x.select(key, F.col("_b").alias("_i"), F.explode(F.sequence(F.col("_b"), F.col("_s") - 1)).alias("_j"),
                    *side(x, "1", member))
    right = x.select(key, F.explode(F.sequence(F.lit(0), F.col("_b"))).alias("_i"), F.col("_b").alias("_j"),
                     *side(x, "2", member))
    j = left.join(right, [key, "_i", "_j"]).filter((F.col("_i") < F.col("_j")) | (F.col("m1") < F.col("m2")))
    swap = F.col("m1") > F.col("m2")
    cols = [F.col(key), F.least("m1", "m2").alias("m1"), F.greatest("m1", "m2").alias("m2")]
    for v in values:
        cols += [F.when(swap, F.col(f"{v}_2")).otherwise(F.col(f"{v}_1")).alias(f"{v}_1"),
                 F.when(swap, F.col(f"{v}_1")).otherwise(F.col(f"{v}_2")).alias(f"{v}_2")]
    return plain.select(*[F.col(c) for c in plain.columns]).unionByName(j.select(*cols))


def co_rater_pairs(m: DataFrame, hot_threshold: int | None = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """Every unordered user pair per product with both ratings:
    ``(product_id, user1, user2, rating1, rating2)`` with ``user1 < user2``."""
    p = self_pairs(m, PRODUCT, USER, [RATING], hot_threshold)
    return p.select(PRODUCT, F.col("m1").alias("user1"), F.col("m2").alias("user2"),
                    F.col(f"{RATING}_1").alias("rating1"), F.col(f"{RATING}_2").alias("rating2"))


def split_join(left: DataFrame, right: DataFrame, key, left_salt: str, right_salt: str,
               hot_threshold: int | None = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """Inner equi-join on ``key`` (a column or several) that splits keys which
    are large on both sides.  A key with ``nl`` left and ``nr`` right rows and
    ``nl·nr > threshold²`` gets ``sl = ⌈nl/threshold⌉`` left and
    ``sr = ⌈nr/threshold⌉`` right hash buckets (by ``left_salt`` /
    ``right_salt``); left bucket i goes to cells (i, 0…sr−1), right bucket j
    to cells (0…sl−1, j), and each cell joins on its own key, so no task
    meets more than threshold² candidate pairs.  Other keys, and all of them
    if none is that large, join plainly.  ``hot_threshold=None`` is the plain
    join."""
    keys = [key] if isinstance(key, str) else list(key)
    if hot_threshold is None:
        return left.join(right, keys)
    t = hot_threshold
    ln = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nl"))
    rn = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nr"))
    hot = materialize(ln.join(rn, keys).filter(F.col("_nl") * F.col("_nr") > F.lit(t) * F.lit(t))
                      .select(*keys, F.ceil(F.col("_nl") / t).cast("int").alias("_sl"),
                              F.ceil(F.col("_nr") / t).cast("int").alias("_sr")), "hot-keys")
    if hot.limit(1).count() == 0:
        return left.join(right, keys)
    plain = left.join(hot, keys, "left_anti").join(right.join(hot, keys, "left_anti"), keys)
    lx = (left.join(hot, keys).withColumn("_i", F.pmod(F.xxhash64(F.col(left_salt)), F.col("_sl")).cast("int"))
          .withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_sr") - 1))).drop("_sl", "_sr"))
    rx = (right.join(hot, keys).withColumn("_j", F.pmod(F.xxhash64(F.col(right_salt)), F.col("_sr")).cast("int"))
          .withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_sl") - 1))).drop("_sl", "_sr"))
    return plain.unionByName(lx.join(rx, [*keys, "_i", "_j"]).drop("_i", "_j"))


# ---------------------------------------------------------------- M8, N5

def pair_moments(m: DataFrame, hot_threshold: int | None = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """M8: Σx², Σy², Σxy and co-rater count per user pair.  Products with more
    than ``hot_threshold`` raters are multiplied block by block instead of
    joined (:mod:`tastegraph.operators.gram`); ``m`` is read several times, so
    pass a written table."""
    p = pair_sums(m, PRODUCT, USER, RATING, ["xy", "xx", "yy", "n"], hot_threshold)
    return p.select(F.col("m1").alias("user1"), F.col("m2").alias("user2"), "xy", "xx", "yy", "n")


def corated_cosine(m: DataFrame, min_overlap: int = 1, digits: int | None = 6,
                   hot_threshold: int | None = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """Cosine of the *raw* ratings with both norms over the co-rated
    items only, plus the co-rater count; a zero norm gives 0.0.  Output
    ``(user1, user2, sim, n)`` with ``user1 < user2``; ``digits`` rounds the
    similarity so that ranking on it is stable across engines."""
    mo = pair_moments(m, hot_threshold).filter(F.col("n") >= min_overlap)
    sim = safe_ratio(F.col("xy"), F.sqrt("xx") * F.sqrt("yy"))
    if digits is not None:
        sim = F.round(sim, digits)
    return mo.select("user1", "user2", sim.alias("sim"), "n")


# ---------------------------------------------------------------- N3, N4

def _centred_cosine(z: DataFrame, owner: str, shared: str, digits: int | None,
                    hot_threshold: int | None) -> DataFrame:
    w = unit_rows(z, owner).select(owner, shared, "w")
    if hot_threshold is not None:
        w = materialize(w, "unit-rows")  # read for the group sizes and by both sides of the join
    p = pair_sums(w, shared, owner, "w", ["xy"], hot_threshold)
    sim = F.round("xy", digits) if digits is not None else F.col("xy")
    return p.select(F.col("m1").alias(owner + "1"), F.col("m2").alias(owner + "2"), sim.alias("sim"))


def item_cosine(z: DataFrame, digits: int | None = 6,
                hot_threshold: int | None = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """Cosine between product vectors of centred ratings (norm over the
    whole vector, zero vectors excluded).  Pairs that share a rater only;
    output ``(product_id1, product_id2, sim)``, ``product_id1 < product_id2``."""
    return _centred_cosine(z, PRODUCT, USER, digits, hot_threshold)


def user_cosine(z: DataFrame, digits: int | None = 6,
                hot_threshold: int | None = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """The same between user vectors; ``(user_id1, user_id2, sim)``."""
    return _centred_cosine(z, USER, PRODUCT, digits, hot_threshold)


def cosine_for(z: DataFrame, owner: str, shared: str, ids, digits: int | None = 6) -> DataFrame:
    """N3 / N4 for the listed owners only: directed ``(<owner>1, <owner>2,
    sim)`` with the first one in ``ids``.  The ids filter the first side of the
    pair join (norms are those of whole vectors), so no other pair is formed."""
    w = unit_rows(z, owner).select(owner, shared, "w")
    a = w.filter(F.col(owner).isin(list(ids))).select(F.col(owner).alias(owner + "1"), shared, F.col("w").alias("w_1"))
    b = w.select(F.col(owner).alias(owner + "2"), shared, F.col("w").alias("w_2"))
    s = F.sum(F.col("w_1") * F.col("w_2"))
    return (a.join(b, shared).filter(F.col(owner + "1") != F.col(owner + "2")).groupBy(owner + "1", owner + "2")
            .agg((F.round(s, digits) if digits is not None else s).alias("sim")))


# ---------------------------------------------------------------- helpers

def both_directions(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, …) with a < b → both (a, b, …) and (b, a, …).  One pass: each
    row emits itself and its mirror through ``explode`` — a UNION would
    evaluate (and finally aggregate) the half result twice."""
    rest = [c for c in edges.columns if c not in (a, b)]
    pair = F.explode(F.array(F.struct(F.col(a).alias("_x"), F.col(b).alias("_y")),
                             F.struct(F.col(b).alias("_x"), F.col(a).alias("_y")))).alias("_e")
    return (edges.select(pair, *rest)
            .select(F.col("_e._x").alias(a), F.col("_e._y").alias(b), *rest))


def top_k_per(df: DataFrame, by: str, order: list, k: int, rank_col: str = "k") -> DataFrame:
    """Top-k rows per group by ``order`` with a gap-free 1-based rank.  For
    k ≤ 1000 Spark plans a partial WindowGroupLimit before the shuffle, so a
    group's traffic is bounded by k per map task."""
    w = Window.partitionBy(by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
