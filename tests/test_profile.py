"""Profiles that merge, interests over open categories, the number of clusters."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegraph.operators import profile as PR
from tastegraph.operators.interest import choose_clusters, fit_clusters, user_interests
from tastegraph.operators.ratings import rating_summary, split_counts
from tastegraph.plans.catalog import R
from tastegraph.session import scratch_path

SF = "/root/testdata/sf0.01"


def _years(spark):
    return R(spark, SF).withColumn("year", F.year(F.timestamp_seconds("ts")))


def test_slices_add_up_and_a_repeated_slice_counts_once(spark):
    r, folder = _years(spark), scratch_path(spark, "profile")
    for part in ("year < 1994", "year >= 1996", "year between 1993 and 1995", "year = 1997"):
        PR.add_to_profile(r.filter(part), "year", folder)
    stored = spark.read.parquet(folder)
    assert stored.count() == stored.select("year", "split").distinct().count() == 3 * r.select("year").distinct().count()
    got, exact = PR.profile_totals(stored).first(), rating_summary(r).first()
    assert got.n_ratings == exact.n_ratings
    for g, e in ((got.n_users, exact.n_users), (got.n_products, exact.n_products)):
        assert abs(g / e - 1) <= 3 * PR.DISTINCT_ERROR
    by_split = {x.split: x.n_ratings for x in PR.profile_totals(stored, "split").collect()}
    assert by_split == {x.split: x.n for x in split_counts(r).collect()}
    some = PR.profile_totals(stored.filter("year in (1993, 1995)")).first()
    exact = rating_summary(r.filter("year in (1993, 1995)")).first()
    assert some.n_ratings == exact.n_ratings and abs(some.n_users / exact.n_users - 1) <= 3 * PR.DISTINCT_ERROR


@pytest.mark.parametrize("tracked", [48, 400, 10_000])
def test_frequent_products_stay_within_the_stated_error(spark, tracked):
    # products 0, 1, … have n / 2, n / 4, … ratings, among 3,000 rare ones
    ids = spark.range(0, 40_000, 1, 6)
    zeros = F.least(F.lit(8), F.floor(F.log2((F.lit(40_000) / (F.col("id") + 1)))))
    r = ids.select((F.col("id") % 11).alias("user_id"), F.when(F.col("id") % 2 == 0, zeros).otherwise(100 + F.xxhash64("id") % 1500).cast("long").alias("product_id"),
                   F.lit(1.0).alias("rating"), (F.col("id") * 100).alias("ts"), (F.col("id") % 5).alias("day"))
    folder = scratch_path(spark, "profile")
    PR.add_to_profile(r, "day", folder, tracked)
    exact = {x.product_id: x["count"] for x in r.groupBy("product_id").count().collect()}
    got = {x.product_id: x.n_ratings for x in PR.frequent_products(spark.read.parquet(folder), 5, tracked).collect()}
    error = PR.count_error(40_000, tracked)
    assert len(got) <= 5 and all(abs(exact[p] - n) <= error for p, n in got.items())
    fifth = sorted(exact.values())[-5]
    assert {p for p, n in exact.items() if n > fifth + 2 * error} <= got.keys()


def test_places_that_the_sketch_leaves_open_are_counted(spark):
    # 3,000 products rated alike, two of them a little more: none stands out from the error of 48 places
    ids = spark.range(0, 30_000, 1, 6)
    r = ids.select((F.col("id") % 11).alias("user_id"), F.when(F.col("id") < 40, 7 + F.col("id") % 2).otherwise(F.col("id") % 3000).alias("product_id"),
                   F.lit(1.0).alias("rating"), F.lit(0).cast("long").alias("ts"), (F.col("id") % 2).alias("day"))
    r = r.unionByName(spark.createDataFrame([(1, None, 1.0, 0, 0)], r.schema))
    folder = scratch_path(spark, "profile")
    PR.add_to_profile(r, "day", folder, 48)
    stored = spark.read.parquet(folder)
    assert PR.frequent_products(stored, 4, 48).count() < 4
    got = [tuple(x) for x in PR.frequent_products(stored, 4, 48, ratings=r).collect()]
    exact = {x.product_id: x["count"] for x in r.dropna().groupBy("product_id").count().collect()}
    assert len({p for p, _ in got}) == 4 and {7, 8} <= {p for p, _ in got}
    assert all(abs(exact[p] - n) <= PR.count_error(30_001, 48) for p, n in got)
    few = r.filter("product_id < 3 and day = 0")
    assert {x.product_id for x in PR.frequent_products(stored.limit(0), 4, 48, ratings=few).collect()} == {x.product_id for x in few.select("product_id").distinct().collect()}


def test_nulls_and_empty_tables(spark):
    kind = "user_id long, product_id long, rating double, ts long, day int"
    folder = scratch_path(spark, "profile")
    PR.add_to_profile(spark.createDataFrame([(None, 1, 1.0, 0, 1), (2, None, 1.0, 0, 1), (2, 1, None, 0, 2)], kind), "day", folder)
    stored = spark.read.parquet(folder)
    assert tuple(PR.profile_totals(stored).first()) == (3, 1, 1)
    assert [tuple(x) for x in PR.frequent_products(stored, 3).collect()] == [(1, 2)]
    PR.add_to_profile(spark.createDataFrame([], kind), "day", folder)
    assert tuple(PR.profile_totals(spark.read.parquet(folder)).first()) == (3, 1, 1)
    assert tuple(PR.profile_totals(stored.limit(0)).first()) == (0, 0, 0)
    assert PR.frequent_products(stored.limit(0), 3).count() == 0


def test_interests_of_open_categories(spark):
    r = spark.createDataFrame([(1, "a", 4.0), (1, "a", 1.0), (1, None, 3.0), (2, "new#1", None), (None, "a", 2.0)], "user_id long, kind string, rating double")
    got = {(x.user_id, x.kind): (x.interest, x.n_ratings) for x in user_interests(r, "kind", 3).collect()}
    assert got == {(1, "a"): (2.5, 2), (1, None): (3.0, 1), (2, "new#1"): (None, 1), (None, "a"): (2.0, 1)}


def test_the_silhouette_chooses_the_planted_number(spark):
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(c, 0.3, (30, 2)) for c in ((0, 0), (5, 0), (0, 6))])
    vectors = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "user_id long, x double, y double")
    best, found = choose_clusters(vectors, [2, 3, 4, 5])
    assert best == 3 and found[3] > 0.9
    cluster = np.array([c for _, c in sorted((r.user_id, r.cluster) for r in fit_clusters(vectors, 4)[0].collect())])
    away = ((points[:, None] - points[None]) ** 2).sum(2)
    each = []
    for i, c in enumerate(cluster):
        own = away[i, cluster == c].sum() / max(1, (cluster == c).sum() - 1)
        other = min(away[i, cluster == o].mean() for o in set(cluster) - {c})
        each.append((other - own) / max(other, own) if (cluster == c).sum() > 1 else 0.0)
    assert found[4] == pytest.approx(np.mean(each), abs=1e-6)
