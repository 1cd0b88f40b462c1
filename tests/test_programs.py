"""The end-to-end programs on the sf0.01 fixture."""

from pyspark.sql import functions as F

from tastegraph.plans import recommenders as REC
from tastegraph.plans.catalog import P, R, profile
from tastegraph.plans.oracle import PROFILE_USER

SF = "/root/testdata/sf0.01"


def test_corated_one_user(spark):
    users = spark.createDataFrame([(1,)], "user_id long")
    recs = REC.corated_recommendations(R(spark, SF), P(spark, SF), users).collect()
    assert len(recs) == 100 and [r.rank for r in recs] == sorted(r.rank for r in recs)
    assert all(r.user_id == 1 and r.title is not None for r in recs)


def test_centred_report(spark):
    rep = REC.centred_cosine_report(R(spark, SF), 1, 525)
    assert rep["similar_users"].count() == 10
    assert rep["similar_products"].count() == 10
    assert rep["similar_user_recs"].count() == 5
    err = rep["insample_error"].first()
    assert err.user_id == 1 and err.n_predicted > 0 and err.mse >= 0


def test_als_program(spark):
    res = REC.als_recommender(R(spark, SF), P(spark, SF), profile(spark), PROFILE_USER,
                              ranks=(4,), reg_params=(0.1,), iterations=(5,))
    recs = res["recommendations"].collect()
    assert len(recs) == 50 and sorted(r.rank for r in recs) == list(range(1, 51))
    rated = {r.product_id for r in profile(spark).collect()}
    assert not rated & {r.product_id for r in recs}
    met = res["metrics"].first()
    assert met.baseline_rmse > 0 and met.test_rmse_all_rows <= met.test_rmse
    assert res["grid"].filter(F.col("is_best")).count() == 1


def test_encode_program(spark):
    raw = spark.createDataFrame([("u9", "b", 1.0, 1), ("u10", "a", 2.0, 2)], "user_id string, product_id string, "
                                "rating double, ts long")
    meta = spark.createDataFrame([("c", "C"), ("a", "A")], "product_id string, title string")
    out = REC.encode_ratings(raw, meta)
    enc = {(r.user_id, r.product_id) for r in out["ratings"].collect()}
    assert enc == {(1, 1), (0, 0)}  # 'u10' < 'u9'; products a=0, b=1, c=2
    assert {(r.product_id, r.title) for r in out["titles"].collect()} == {(2, "C"), (0, "A")}


def test_grid_search_parallel_same_choice(spark):
    from tastegraph.operators import als as A
    from tastegraph.plans.catalog import splits
    tr, va, _ = splits(spark, SF)
    seq, _, best1 = A.als_grid_search(tr, va, (3,), (0.05, 0.5), (3,), seed=5)
    par, _, best2 = A.als_grid_search(tr, va, (3,), (0.05, 0.5), (3,), seed=5, parallelism=2)
    assert best1 == best2
    a = sorted((r.reg_param, round(r.validation_rmse, 9)) for r in seq.collect())
    b = sorted((r.reg_param, round(r.validation_rmse, 9)) for r in par.collect())
    assert a == b


def test_one_popular_product_keeps_all_its_raters(spark):
    """700 raters of one product: neighbours equal the uncapped SQL, with the
    product split into blocks and without."""
    import duckdb

    from tastegraph.operators import neighbours as NB
    rows = [(u, 1, float(1 + u % 5)) for u in range(700)] + [(u, 2 + u % 40, float(1 + u % 3)) for u in range(700)]
    m = spark.createDataFrame(rows, "user_id long, product_id long, rating double")
    con = duckdb.connect()
    con.execute("CREATE TABLE m (u BIGINT, p BIGINT, r DOUBLE)")
    con.executemany("INSERT INTO m VALUES (?, ?, ?)", rows)
    from tastegraph.plans.oracle import CP, NN
    want = con.sql(f"WITH {CP}, {NN} SELECT u1, u2, sim, n, k FROM nn ORDER BY u1, k").fetchall()
    for threshold in (50, 2000):
        got = NB.nearest_neighbours(m, k=100, hot_threshold=threshold).orderBy("user_id", "rank").collect()
        assert [tuple(r) for r in got] == want
    served = NB.nearest_neighbours(m, k=100, only_users=[5]).orderBy("rank").collect()
    assert [tuple(r) for r in served] == [w for w in want if w[0] == 5]


def test_errors_count_every_row_once(spark):
    from tastegraph.operators import evaluate as E
    actual = spark.createDataFrame([(1, 1, 4.0), (1, 1, 2.0), (2, 1, 3.0)], "user_id long, product_id long, rating double")
    pred = spark.createDataFrame([(1, 1, 3.0), (1, 1, 3.0)], "user_id long, product_id long, prediction double")
    r = E.rmse(pred, actual).first()
    assert (r.n_rows, r.n_predicted) == (3, 2) and abs(r.rmse - 1.0) < 1e-12
    scored = actual.filter("user_id = 1").selectExpr("*", "3.0D AS prediction")
    assert E.rmse_of_scored(scored, actual).first() == r
    big = spark.createDataFrame([(1e8 + x,) for x in (0.0, 2.0, 4.0)], "rating double")
    base = E.mean_baseline_rmse(big, big).first()
    assert abs(base.baseline_rmse - (8 / 3) ** 0.5) < 1e-6


def test_als_evaluation_counts_the_split(spark):
    from tastegraph.operators import als as A
    from tastegraph.operators import evaluate as E
    from tastegraph.plans.catalog import splits
    tr, va, _ = splits(spark, "/root/testdata/sf0.001")
    model = A.als_train(tr, rank=3, max_iter=3, reg_param=0.1, seed=1)
    assert E.rmse_of_scored(A.als_predict(model, va), va).first().n_rows == va.count()


def test_certificates_reject_wrong_answers(spark):
    from tastegraph.operators import als as A
    from tastegraph.operators import neighbours as NB
    from tastegraph.operators.interest import clusters_check, fit_clusters
    from tastegraph.plans.catalog import splits
    sf = "/root/testdata/sf0.001"
    tr, _, _ = splits(spark, sf)
    model = A.als_train(tr, rank=3, max_iter=3, reg_param=0.1, seed=1)
    prof = profile(spark)
    cand = NB.unseen_candidates(P(spark, sf), prof).withColumn("user_id", F.lit(PROFILE_USER))
    scored = A.als_predict(model, cand).select("product_id", "prediction")
    recs = A.als_recs_for_user(model, P(spark, sf), prof, PROFILE_USER, 20)
    ok = A.als_recs_check(recs, prof, scored).first()
    assert (ok.n_rows, ok.n_seen, ok.n_rank_gaps, ok.n_inversions, ok.n_better) == (20, 0, 0, 0, 0)
    # the first 20 candidates by id, ranked by id
    wrong = (scored.orderBy("product_id").limit(20).withColumn("user_id", F.lit(PROFILE_USER).cast("long"))
             .withColumn("rank", F.expr("row_number() OVER (ORDER BY product_id)")))
    bad = A.als_recs_check(wrong, prof, scored).first()
    assert bad.n_inversions > 0 and bad.n_better > 0
    vec = spark.createDataFrame([(i, float(i % 2 * 10), float(i)) for i in range(20)], "user_id long, a double, b double")
    clusters, centres = fit_clusters(vec, 2, 1)
    assert clusters_check(vec, clusters, centres).first().n_misplaced == 0
    assert clusters_check(vec, clusters.withColumn("cluster", 1 - F.col("cluster")), centres).first().n_misplaced > 0


def test_served_report_equals_the_whole(spark):
    from tastegraph.operators import neighbours as NB
    from tastegraph.operators import ratings as RT
    from tastegraph.operators import similarity as SIM
    sf = "/root/testdata/sf0.001"
    rep = REC.centred_cosine_report(R(spark, sf), 1, 25)
    m = RT.user_item_mean(R(spark, sf))
    z = SIM.user_center_scale(m)
    users = NB.top_similar_users(SIM.user_cosine(z), 10)
    pred = NB.predict_rating(m, SIM.user_cosine(z), m)
    whole = {
        "similar_products": NB.top_similar_products(SIM.item_cosine(z), 10).filter("product_id = 25"),
        "similar_users": users.filter("user_id = 1"),
        "similar_user_recs": NB.similar_user_recs(users, z, 5).filter("user_id = 1"),
        "predictions": pred.filter("user_id = 1"),
    }
    for name, df in whole.items():
        def rows(x):
            return sorted(tuple(round(v, 5) if isinstance(v, float) else v for v in r) for r in x.select(*df.columns).collect())
        assert rows(rep[name]) == rows(df), name


def test_centred_report_takes_string_products(spark):
    r = R(spark, "/root/testdata/sf0.001").withColumn("product_id", F.concat(F.lit("B"), F.col("product_id").cast("string")))
    assert REC.centred_cosine_report(r, 1, "B25")["similar_products"].count() == 10
