"""Profiling, filtering, aggregation and splitting of a ratings table.

Input everywhere: ``(user_id, product_id, rating, ts)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.functions import hash_unit, split_digit
from tastegraph.operators.encode import positions
from tastegraph.schema import PRODUCT, RATING, TS, USER

SPLIT = "split"
DIGIT = "split_digit"


# ---------------------------------------------------------------- filters

def filter_user_id_cap(r: DataFrame, cap: int | None = None) -> DataFrame:
    """keep ``user_id <= cap``; ``None`` keeps everything (the reference's
    cap only bounded its in-memory matrix).  Pushed into the parquet scan by
    Catalyst when the ratings come straight from a file."""
    return r if cap is None else r.filter(F.col(USER) <= cap)


def positive_ratings(r: DataFrame) -> DataFrame:
    """ratings > 0."""
    return r.filter(F.col(RATING) > 0)


def multi_rater_products(r: DataFrame, min_raters: int = 2) -> DataFrame:
    """products with more than one rating row, with the row count."""
    return (r.groupBy(PRODUCT).agg(F.count(F.lit(1)).alias("n_raters"))
            .filter(F.col("n_raters") >= min_raters))


# ---------------------------------------------------------------- aggregates (M*)

def rating_summary(r: DataFrame, approx: bool = False) -> DataFrame:
    """M1: number of ratings, distinct users and distinct products in one pass.
    ``approx=True`` swaps the exact distincts (an Expand + two-level
    aggregation) for HyperLogLog sketches that merge map-side."""
    cd = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    return r.agg(F.count(F.lit(1)).alias("n_ratings"), cd(USER).alias("n_users"), cd(PRODUCT).alias("n_products"))


def with_split_digit(r: DataFrame) -> DataFrame:
    """add the hundreds digit of the timestamp."""
    return r.withColumn(DIGIT, split_digit(TS))


def split_label(digit_col=DIGIT, train_below: int = 6, validation_below: int = 8):
    d = F.col(digit_col)
    return (F.when(d < train_below, F.lit("train"))
            .when(d < validation_below, F.lit("validation")).otherwise(F.lit("test")))


def split_counts(r: DataFrame) -> DataFrame:
    """M2: rows per split of the 6:2:2 timestamp-digit split."""
    return (with_split_digit(r).groupBy(split_label().alias(SPLIT))
            .agg(F.count(F.lit(1)).alias("n")))


def user_item_mean(r: DataFrame) -> DataFrame:
    """M3: one row per (user, product); duplicate ratings are averaged."""
    return r.groupBy(USER, PRODUCT).agg(F.avg(RATING).alias(RATING))


def user_item_pivot(r: DataFrame, width: int = 16, prefix: str = "p_") -> DataFrame:
    """M4: the user × product matrix of mean ratings, all products, cut into
    blocks of ``width`` neighbouring product ids: one row per user and block
    with a rating in it, column j of block b is product b·width + j (NULL =
    not rated).  The width of a row does not grow with the catalogue."""
    at = F.pmod(F.col(PRODUCT), F.lit(width))
    block = F.floor(F.col(PRODUCT) / F.lit(width)).alias("product_block")
    return r.groupBy(USER, block).agg(*[F.avg(F.when(at == j, F.col(RATING))).alias(f"{prefix}{j}") for j in range(width)])


def user_rating_stats(m: DataFrame) -> DataFrame:
    """M5: per-user mean, max and min over the rated items."""
    return m.groupBy(USER).agg(F.avg(RATING).alias("mean_rating"), F.max(RATING).alias("max_rating"),
                               F.min(RATING).alias("min_rating"))


def mean_rating(r: DataFrame) -> DataFrame:
    """M6: global mean rating (one row)."""
    return r.agg(F.avg(RATING).alias("mean_rating"))


def raters_per_product(r: DataFrame) -> DataFrame:
    """M7: number of ratings per product (the reference groups the raters per
    product; the pairs themselves come from the self-join, J2)."""
    return r.groupBy(PRODUCT).agg(F.count(F.lit(1)).alias("n_raters"))


# ---------------------------------------------------------------- splits (T*)

def split_train(r: DataFrame, extra: DataFrame | None = None, train_below: int = 6) -> DataFrame:
    """Digit < 6, plus the served user's own ratings (UNION ALL)."""
    t = with_split_digit(r).filter(F.col(DIGIT) < train_below).select(USER, PRODUCT, RATING, TS)
    return t if extra is None else t.unionByName(extra.select(USER, PRODUCT, RATING, TS))


def add_profile(r: DataFrame, profile: DataFrame) -> DataFrame:
    """The served user's ratings added to a ratings table (UNION ALL).  The
    profile's user id must not already occur in ``r`` — otherwise two people
    would merge into one (the reference serves id 0, which is also the first
    encoded id).  The check is a semi-join counted to at most one row."""
    clash = r.select(USER).join(profile.select(USER).distinct(), USER, "left_semi").limit(1).count()
    if clash:
        raise ValueError("profile user id already present in the ratings")
    return r.unionByName(profile.select(USER, PRODUCT, RATING, TS))


def split_validation(r: DataFrame, train_below: int = 6, validation_below: int = 8) -> DataFrame:
    """6 <= digit < 8."""
    d = with_split_digit(r)
    return d.filter((F.col(DIGIT) >= train_below) & (F.col(DIGIT) < validation_below)).select(USER, PRODUCT, RATING, TS)


def split_test(r: DataFrame, validation_below: int = 8) -> DataFrame:
    """Digit >= 8."""
    return with_split_digit(r).filter(F.col(DIGIT) >= validation_below).select(USER, PRODUCT, RATING, TS)


def random_split(r: DataFrame, weights=(5, 3, 2), seed: int = 0) -> DataFrame:
    """T4: seeded split by a hash of the row's identity — the same row lands in
    the same part under any partitioning or engine (``randomSplit`` depends on
    the partition layout).  Returns the rows with a ``split`` label."""
    total = sum(weights)
    b = F.pmod(hash_unit(seed, USER, PRODUCT, TS), F.lit(total))
    c1, c2 = weights[0], weights[0] + weights[1]
    label = F.when(b < c1, F.lit("train")).when(b < c2, F.lit("validation")).otherwise(F.lit("test"))
    return r.withColumn(SPLIT, label)


def union_all_ratings(*parts: DataFrame) -> DataFrame:
    """T5: UNION ALL (duplicates kept)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distinct_ids(r: DataFrame, col: str = USER) -> DataFrame:
    """DISTINCT ids."""
    return r.select(col).distinct()


def rank_ordinal(df: DataFrame, partition_by: list[str], order_by: list, k: int | None = None,
                 name: str = "rank") -> DataFrame:
    """1-based gap-free ordinal of the rows of each group.

    With ``k`` the list ends there, which Spark limits map-side
    (WindowGroupLimit).  Without, every row is ranked by its position in one
    range-partitioned sort minus that of its group's first row, so a huge
    group is spread over many tasks instead of sorted in one window."""
    if k is not None:
        from pyspark.sql import Window
        w = Window.partitionBy(*partition_by).orderBy(*order_by)
        return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)
    placed = positions(df, [F.col(c) for c in partition_by] + list(order_by), "_at")
    first = placed.groupBy(*partition_by).agg(F.min("_at").alias("_first"))
    ranked = placed.join(first, partition_by)
    return ranked.select(*df.columns, (F.col("_at") - F.col("_first") + 1).cast("int").alias(name))
