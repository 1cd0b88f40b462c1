"""A stored profile of ratings that grows slice by slice (M1, M2, M7).

Exact distinct counts of a growing table read all of it again.  Here every
slice (a day, a load) leaves one row per split: its number of ratings, two
HyperLogLog sketches and a frequent-items sketch.  Rows merge, so the totals of
any choice of slices come from the rows alone; adding a slice reads that slice
only, and adding it again replaces it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.operators.ratings import SPLIT, split_label, with_split_digit
from tastegraph.schema import PRODUCT, USER
from tastegraph.session import materialize

#: 2^14 registers a sketch: 16 KB, and a relative standard error of 1.04 / 2^7.
LOG_REGISTERS = 14
DISTINCT_ERROR = 1.04 / 2 ** (LOG_REGISTERS / 2)
#: Products that a sketch of frequent ones tracks.
TRACKED = 10_000


def count_error(n: int, tracked: int = TRACKED) -> float:
    """By how much a product's estimated number of ratings may be off among n
    ratings: the sketch has 2^j ≥ tracked / 0.75 places and errs by 3.5 n / 2^j
    at most, merged or not.  Products of more ratings than that are never missed."""
    return 3.5 * 0.75 * n / tracked


def add_to_profile(r: DataFrame, by: str, folder: str, tracked: int = TRACKED) -> None:
    """Write the profile rows of the slices (values of column ``by``) that are
    in ``r`` to ``folder``, in place of what it has of these slices.  ``r``
    must hold the slices whole; other slices stay as they are.  Null users and
    products are counted as ratings only."""
    rows = (with_split_digit(r).groupBy(by, split_label().alias(SPLIT))
            .agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(USER, LOG_REGISTERS).alias("users"), F.hll_sketch_agg(PRODUCT, LOG_REGISTERS).alias("products"),
                 F.call_function("approx_top_k_accumulate", F.col(PRODUCT), F.lit(tracked)).alias("frequent")))
    # rows of one slice in one file
    rows.repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(folder)


def _distinct(sketch: str) -> Column:
    return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(sketch)), F.lit(0)).cast("long")


def profile_totals(profile: DataFrame, *keys: str) -> DataFrame:
    """M1 (M2 with the key ``split``) from the rows of a profile: the exact
    number of ratings, and distinct users and products within
    :data:`DISTINCT_ERROR` (one standard error, relative)."""
    return profile.groupBy(*keys).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_ratings"), _distinct("users").alias("n_users"), _distinct("products").alias("n_products"))


def frequent_products(profile: DataFrame, k: int, tracked: int = TRACKED, ratings: DataFrame | None = None) -> DataFrame:
    """M7 for the products rated most: ``(product_id, n_ratings)``, the k of
    largest estimate, each within :func:`count_error`.  At most ``tracked``
    counters leave a task, whatever the number of products.

    A sketch lists only products that stand out from its error, so few or none
    of very many products rated alike.  Given the ``ratings`` of the profile,
    the products of most ratings, counted exactly, take the places left open."""
    # grouped by a constant, as an empty profile then has no group instead of an empty sketch, which Spark cannot read
    merged = profile.groupBy(F.lit(0).alias("all")).agg(F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(tracked)).alias("frequent"))
    found = merged.select(F.explode(F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(k))).alias("x"))
    found = found.select(F.col("x.item").alias(PRODUCT), F.col("x.count").alias("n_ratings")).dropna()
    if ratings is None:
        return found
    found = materialize(found, "frequent")  # k rows
    left_open = k - found.count()
    if not left_open:
        return found
    counted = ratings.dropna(subset=[PRODUCT]).groupBy(PRODUCT).agg(F.count(F.lit(1)).alias("n_ratings"))
    return found.unionByName(counted.join(found, PRODUCT, "left_anti").orderBy(F.desc("n_ratings"), F.asc(PRODUCT)).limit(left_open))
