"""The reference's programs as composed DataFrame plans.

* :func:`corated_recommendations` — user-user co-rated cosine, top-100
  neighbours, weighted-sum recommendations for one or all users.
* :func:`centred_cosine_report` — centred (mean-removed, range-scaled) cosine
  between users and between products: similar products, similar users,
  neighbour picks, predictions and the in-sample error of one user.
* :func:`als_recommender` — timestamp-digit split, ALS grid search, test and
  baseline RMSE, top-50 recommendations for a served profile.
* :func:`encode_ratings` / :func:`project_metadata_file` — the preprocessors.

Every function returns DataFrames (lazy unless a model must be fitted); the
caller decides what to show or write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.functions import ascii_only
from tastegraph.operators import als as A
from tastegraph.operators import encode as L
from tastegraph.operators import evaluate as E
from tastegraph.operators import neighbours as NB
from tastegraph.operators import ratings as RT
from tastegraph.operators import similarity as SIM
from tastegraph.schema import PRODUCT, RATING, TITLE, USER
from tastegraph.session import materialize


def corated_recommendations(ratings: DataFrame, products: DataFrame, user_ids: list | DataFrame | None = None,
                            k_neighbours: int = 100, k: int = 100, cap: int | None = None, seed: int = 42,
                            unseen: bool = True) -> DataFrame:
    """Co-rated cosine recommender.  With ``user_ids`` only those users'
    pairs are formed (R8; listed ids are a predicate of the ratings scan);
    without, every user is served, from blocks of users (R6/R7)."""
    m = materialize(RT.user_item_mean(ratings), "user_item_mean")
    if user_ids is not None:
        return NB.recs_for_user(m, products, user_ids, k_neighbours, k, cap, seed, unseen)
    nn = materialize(NB.nearest_neighbours(m, k_neighbours, cap, seed), "neighbours")
    recs = NB.weighted_sum_recs_for_all(nn, m, k, unseen)
    return NB.title_lookup(recs, products)


def centred_cosine_report(ratings: DataFrame, user_id, product_id, user_id_cap: int | None = None) -> dict[str, DataFrame]:
    """Centred-cosine report for one user and one product (R1–R4, E4); ids of
    any type.  Only the pairs of the served user and product are formed, once,
    and every part of the report reads them."""
    m = materialize(RT.user_item_mean(RT.filter_user_id_cap(ratings, user_id_cap)), "user_item_mean")
    z = materialize(SIM.user_center_scale(m), "centred")
    near = materialize(SIM.cosine_for(z, USER, PRODUCT, [user_id]), "user-cosine")
    items = SIM.cosine_for(z, PRODUCT, USER, [product_id])
    users = NB.top_similar_users(near, 10, directed=True)
    mine = m.filter(F.col(USER) == user_id)
    pred = NB.predict_rating(mine, near, m, directed=True)
    return {
        "similar_products": NB.top_similar_products(items, 10, directed=True),
        "similar_users": users,
        "similar_user_recs": NB.similar_user_recs(users, z, 5),
        "predictions": pred,
        "insample_error": E.user_insample_error(pred, mine),
    }


def als_recommender(ratings: DataFrame, products: DataFrame, profile: DataFrame, user_id: int,
                    ranks=(12,), reg_params=(0.01, 0.1), iterations=(20,), seed: int = 42, k: int = 50,
                    serve_as: int | None = None) -> dict[str, DataFrame]:
    """The ALS program: summary, split, grid search, evaluation, top-k.

    The served user's id must not occur anywhere in the ratings, in training
    or not.  ``serve_as`` gives the profile another id for the run, so that a
    profile written for id 0 can be served next to ids that start at 0."""
    spark = ratings.sparkSession
    r = materialize(ratings.select(USER, PRODUCT, RATING, "ts"), "ratings")
    profile = profile.filter((F.col(RATING) > 0) & (F.col(USER) == user_id))
    if serve_as is not None:
        profile, user_id = profile.withColumn(USER, F.lit(serve_as).cast("long")), serve_as
    RT.add_profile(r, profile)  # raises if the id is taken
    train = RT.split_train(r, profile)
    validation, test = RT.split_validation(r), RT.split_test(r)
    grid, models, best = A.als_grid_search(train, validation, ranks, reg_params, iterations, seed)
    model = models[best]
    test_rmse = E.rmse_of_scored(A.als_predict(model, test), test)
    base = E.mean_baseline_rmse(RT.union_all_ratings(train, validation), test)
    tr = test_rmse.first()
    bs = base.first()
    improvement = None
    if tr["rmse_all_rows"] is not None and bs["baseline_rmse"]:
        improvement = (bs["baseline_rmse"] - tr["rmse_all_rows"]) / bs["baseline_rmse"] * 100
    metrics = spark.createDataFrame(
        [(best[0], best[1], best[2], tr["rmse"], tr["rmse_all_rows"], tr["coverage"], bs["mean_rating"],
          bs["baseline_rmse"], improvement)],
        "rank int, reg_param double, max_iter int, test_rmse double, test_rmse_all_rows double, coverage double, "
        "mean_rating double, baseline_rmse double, improvement_pct double")
    return {
        "summary": RT.rating_summary(r),
        "split_counts": RT.split_counts(r),
        "grid": grid,
        "metrics": metrics,
        "recommendations": A.als_recs_for_user(model, products, profile, user_id, k)
        .withColumn("title_ascii", ascii_only(TITLE)),
    }


def encode_ratings(raw: DataFrame, metadata: DataFrame | None = None) -> dict[str, DataFrame]:
    """The preprocessor: dense codes for users and products.  With metadata
    the product dictionary is fitted on ratings ∪ metadata (L4), so the
    encoded titles and ratings agree."""
    users = L.build_dictionary(raw, USER)
    prods = (L.encode_joint(raw, metadata) if metadata is not None else L.build_dictionary(raw, PRODUCT))
    enc = L.encode_column(L.encode_column(raw, USER, users), PRODUCT, prods)
    out = {"ratings": enc, "user_dictionary": users, "product_dictionary": prods}
    if metadata is not None:
        out["titles"] = L.encode_column(metadata.select(PRODUCT, TITLE), PRODUCT, prods)
    return out
