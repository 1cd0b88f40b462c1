"""Top-k neighbours and recommendations.

Ranking always uses the rounded similarity / score and breaks ties by id, so
the result does not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.operators.similarity import (
    DEFAULT_HOT_THRESHOLD,
    both_directions,
    cap_raters,
    split_join,
    top_k_per,
)
from tastegraph.operators.recommend import weighted_sums
from tastegraph.operators.topk import nearest_by_corated, nearest_by_cosine
from tastegraph.functions import safe_ratio
from tastegraph.schema import PRODUCT, RATING, TITLE, USER
from tastegraph.session import materialize

NEIGHBOUR = "neighbour_id"


# ---------------------------------------------------------------- R1, R2 (centred cosine)

def nearest_products(z: DataFrame, k: int = 10, **options) -> DataFrame:
    """R1 without a similarity table: the k most similar other products of
    every product, from the centred ratings ``z`` (N1)."""
    return (nearest_by_cosine(z, PRODUCT, USER, k, **options)
            .select(PRODUCT, F.col("other").alias("similar_product_id"), "sim", "rank"))


def nearest_users(z: DataFrame, k: int = 10, **options) -> DataFrame:
    """R2 without a similarity table: the k most similar other users of every
    user, from the centred ratings ``z`` (N1)."""
    return nearest_by_cosine(z, USER, PRODUCT, k, **options).select(USER, F.col("other").alias(NEIGHBOUR), "sim", "rank")


def top_similar_products(item_sims: DataFrame, k: int = 10, directed: bool = False) -> DataFrame:
    """The k most similar other products of every product (``directed``:
    of every first product of ``item_sims``)."""
    e = item_sims if directed else both_directions(item_sims, "product_id1", "product_id2")
    return (top_k_per(e, "product_id1", [F.desc("sim"), F.asc("product_id2")], k)
            .select(F.col("product_id1").alias(PRODUCT), F.col("product_id2").alias("similar_product_id"),
                    "sim", F.col("k").alias("rank")))


def top_similar_users(user_sims: DataFrame, k: int = 10, directed: bool = False) -> DataFrame:
    """R2: the k most similar other users of every user (self excluded by id,
    so ties at 1.0 are harmless).  A user without data has no rows."""
    e = user_sims if directed else both_directions(user_sims, "user_id1", "user_id2")
    return (top_k_per(e, "user_id1", [F.desc("sim"), F.asc("user_id2")], k)
            .select(F.col("user_id1").alias(USER), F.col("user_id2").alias(NEIGHBOUR), "sim",
                    F.col("k").alias("rank")))


def similar_user_recs(top_users: DataFrame, z: DataFrame, k: int = 5,
                      hot_threshold: int | None = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """For each of a user's neighbours take the products at that
    neighbour's maximum centred rating (all ties), count how many neighbours
    name each product, keep the top k by (count desc, product asc).  Products
    the user rated are not removed (reference behaviour)."""
    best = (z.groupBy(USER).agg(F.max("z").alias("_mz"))
            .join(z, USER).filter(F.col("z") == F.col("_mz")).select(F.col(USER).alias(NEIGHBOUR), PRODUCT))
    cnt = (split_join(top_users.select(USER, NEIGHBOUR), best, NEIGHBOUR, USER, PRODUCT, hot_threshold)
           .groupBy(USER, PRODUCT).agg(F.count(F.lit(1)).alias("n_neighbours")))
    return (top_k_per(cnt, USER, [F.desc("n_neighbours"), F.asc(PRODUCT)], k)
            .withColumnRenamed("k", "rank"))


def predict_rating(targets: DataFrame, user_sims: DataFrame, m: DataFrame, min_similarity: float = 0.0,
                   hot_threshold: int | None = DEFAULT_HOT_THRESHOLD, directed: bool = False) -> DataFrame:
    """Σ(sim·r) / Σ sim over all users that rated the product and have
    sim > ``min_similarity`` with the user.

    ``targets`` holds the distinct (user, product) pairs to predict.  Each
    target first meets the *other raters of its product* (an equi-join on
    product: Σ raters per target rows; a product with many raters is split
    into blocks by :func:`split_join`), and the pair then its similarity.
    ``user_sims`` has one row per unordered pair (N4), so the pair is put in
    order first, or is ``directed`` from the target's user.
    """
    nr = m.select(F.col(USER).alias(NEIGHBOUR), PRODUCT, F.col(RATING).alias("_r"))
    cand = (split_join(targets.select(USER, PRODUCT), nr, PRODUCT, USER, NEIGHBOUR, hot_threshold)
            .filter(F.col(USER) != F.col(NEIGHBOUR)))
    one, two = (F.col(USER), F.col(NEIGHBOUR)) if directed else (F.least(USER, NEIGHBOUR), F.greatest(USER, NEIGHBOUR))
    near = user_sims.filter(F.col("sim") > min_similarity).select("user_id1", "user_id2", "sim")
    joined = cand.withColumn("user_id1", one).withColumn("user_id2", two).join(near, ["user_id1", "user_id2"])
    return (joined.groupBy(USER, PRODUCT)
            .agg(F.try_divide(F.sum(F.col("sim") * F.col("_r")), F.sum("sim")).alias("prediction"),
                 F.count(F.lit(1)).alias("n_neighbours"))
            .filter(F.col("prediction").isNotNull()))


# ---------------------------------------------------------------- R5–R8 (co-rated cosine)

def nearest_neighbours(m: DataFrame, k: int = 100, cap: int | None = None, seed: int = 42,
                       min_overlap: int = 1, only_users: DataFrame | None = None,
                       hot_threshold: int | None = DEFAULT_HOT_THRESHOLD,
                       same_group: str | None = None) -> DataFrame:
    """Top-k neighbours per user by co-rated cosine (sim desc, co-rater
    count desc, id asc).  ``m`` is the (user, product)-unique rating table
    (M3).  ``cap`` samples at most so many raters per product first (N6);
    without it every rating counts.  All users' lists come from blocks of
    vectors (:mod:`tastegraph.operators.topk`), no pair table is formed.
    ``only_users`` (a list of ids — pushed into the scan as a predicate — or
    a DataFrame of ids, semi-joined) restricts the *first* user of each pair
    before the pair join; ``same_group`` adds an extra equi-key (a
    column of ``m``) that both users must share.
    """
    if cap is not None:
        m = cap_raters(m, cap, seed)
    if only_users is None and same_group is None:
        found = nearest_by_corated(m, USER, PRODUCT, k, min_overlap, hot_threshold=hot_threshold)
        return found.select(USER, F.col("other").alias(NEIGHBOUR), "sim", "n", "rank")
    sims = _corated_for(m, only_users, min_overlap, same_group, hot_threshold)
    return (top_k_per(sims, "user1", [F.desc("sim"), F.desc("n"), F.asc("user2")], k)
            .select(F.col("user1").alias(USER), F.col("user2").alias(NEIGHBOUR), "sim", "n",
                    F.col("k").alias("rank")))


def _corated_for(m: DataFrame, only_users, min_overlap: int, same_group: str | None,
                 hot_threshold: int | None) -> DataFrame:
    """Directed co-rated cosine ``(user1, user2, sim, n)`` where the first
    user is restricted to ``only_users`` (semi-join before the pair join) and/or
    both users share the value of ``same_group``.  A listed user has one row
    per product, so that join has no key which is large on both sides; any
    other is split."""
    extra = [same_group] if same_group else []
    a = m.select(F.col(USER).alias("user1"), PRODUCT, F.col(RATING).alias("r1"),
                 *extra)
    listed = isinstance(only_users, (list, tuple, set))
    if listed:
        # explicit ids: a plain predicate, pushed into the ratings scan
        a = a.filter(F.col("user1").isin(list(only_users)))
    elif only_users is not None:
        a = a.join(only_users.select(F.col(USER).alias("user1")).distinct(), "user1", "left_semi")
    b = m.select(F.col(USER).alias("user2"), PRODUCT, F.col(RATING).alias("r2"),
                 *extra)
    j = split_join(a, b, [PRODUCT, *extra], "user1", "user2", None if listed else hot_threshold)
    j = j.filter(F.col("user1") != F.col("user2"))
    mo = (j.groupBy("user1", "user2")
          .agg(F.sum(F.col("r1") * F.col("r2")).alias("xy"), F.sum(F.col("r1") * F.col("r1")).alias("xx"),
               F.sum(F.col("r2") * F.col("r2")).alias("yy"), F.count(F.lit(1)).alias("n"))
          .filter(F.col("n") >= min_overlap))
    sim = F.round(safe_ratio(F.col("xy"), F.sqrt("xx") * F.sqrt("yy")), 6)
    return mo.select("user1", "user2", sim.alias("sim"), "n")


def neighbour_ratings(nn: DataFrame, m: DataFrame, hot_threshold: int | None = DEFAULT_HOT_THRESHOLD,
                      with_count: bool = True) -> DataFrame:
    """Attach every neighbour's ratings and pre-aggregate per (user,
    product): Σ sim·r, Σ sim and the number of contributing neighbours.  An
    equi-join on the neighbour id — no broadcast of the ratings; a neighbour
    who is both popular and a heavy rater is split into blocks
    (:func:`split_join`)."""
    nr = m.select(F.col(USER).alias(NEIGHBOUR), PRODUCT, F.col(RATING).alias("_r"))
    return (split_join(nn.select(USER, NEIGHBOUR, "sim"), nr, NEIGHBOUR, USER, PRODUCT, hot_threshold)
            .groupBy(USER, PRODUCT)
            .agg(F.sum(F.col("sim") * F.col("_r")).alias("sum_sim_rating"), F.sum("sim").alias("sum_sim"),
                 *([F.count(F.lit(1)).alias("n_neighbours")] if with_count else [])))


def neighbour_ratings_for_all(nn: DataFrame, m: DataFrame, **options) -> DataFrame:
    """J5 for the lists of very many users: the same rows, from blocks of users
    (:mod:`tastegraph.operators.recommend`), without a row per neighbour's
    rating.  Ratings with a null product or rating take the join."""
    if m.filter(F.col(PRODUCT).isNull() | F.col(RATING).isNull()).limit(1).count():
        return neighbour_ratings(nn, m)
    return weighted_sums(nn, m, None, False, lambda lists: neighbour_ratings(lists, m), **options)


def weighted_sum_recs(nn: DataFrame, m: DataFrame, k: int = 100, unseen: bool = False,
                      digits: int = 6) -> DataFrame:
    """score(product) = Σ sim·r / Σ sim over the neighbours who rated
    it (Σ sim = 0 → no score); top k per user by (score desc, product desc).
    ``unseen=True`` (R7) first removes products the user rated (anti-join)."""
    s = neighbour_ratings(nn, m, with_count=False)
    if unseen:
        s = s.join(m.select(USER, PRODUCT), [USER, PRODUCT], "left_anti")
    s = (s.select(USER, PRODUCT, F.round(F.try_divide("sum_sim_rating", "sum_sim"), digits).alias("score"))
         .filter(F.col("score").isNotNull()))
    return top_k_per(s, USER, [F.desc("score"), F.desc(PRODUCT)], k).withColumnRenamed("k", "rank")


def weighted_sum_recs_for_all(nn: DataFrame, m: DataFrame, k: int = 100, unseen: bool = False, **options) -> DataFrame:
    """R6 / R7 for the lists of very many users: the same rows, from blocks of
    users (:mod:`tastegraph.operators.recommend`)."""
    return weighted_sums(nn, m, k, unseen, lambda lists: weighted_sum_recs(lists, m, k, unseen), **options)


def recs_for_user(m: DataFrame, products: DataFrame, user_ids, k_neighbours: int = 100, k: int = 100,
                  cap: int | None = None, seed: int = 42, unseen: bool = True) -> DataFrame:
    """R6/R7 for the served users only (a list of ids or a DataFrame),
    with rank and title.  The user filter is applied to the first side of
    the pair join, so only those users' pairs are ever formed.  An empty
    result means not enough data."""
    nn = nearest_neighbours(m, k_neighbours, cap, seed, only_users=user_ids)
    recs = weighted_sum_recs(nn, m, k, unseen)
    recs = materialize(recs, "served-recs")  # k rows a user, read by the title lookup twice
    return title_lookup(recs, products, small_result=True).select(USER, "rank", PRODUCT, "score", TITLE)


# ---------------------------------------------------------------- J3, J4

def title_lookup(df: DataFrame, products: DataFrame, small_result: bool = False) -> DataFrame:
    """Attach the title (NULL when unknown).  A plain left equi-join: the
    catalogue grows with the data, so there is no broadcast hint — AQE
    broadcasts it only after measuring it small.

    ``small_result=True`` is for short lists (top-k of served users): the
    catalogue is first semi-joined with the list's product ids.  AQE measures
    that id list tiny and broadcasts it, so the catalogue is scanned and
    filtered in place instead of being shuffled to meet a handful of rows.
    """
    titles = products.select(PRODUCT, TITLE)
    if small_result:
        titles = titles.join(df.select(PRODUCT).distinct(), PRODUCT, "left_semi")
    return df.join(titles, PRODUCT, "left")


def unseen_candidates(products: DataFrame, rated: DataFrame) -> DataFrame:
    """Catalogue products the user has not rated (anti-join)."""
    return products.select(PRODUCT).distinct().join(rated.select(PRODUCT), PRODUCT, "left_anti")
