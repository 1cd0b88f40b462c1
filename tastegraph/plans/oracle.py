"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Tables ``lineitem orders part customer documents`` are views over the same
parquet files.  ``R``/``P`` are the ratings and products of the fixtures; the
short CTE names (u, p, r) mirror the Spark operators.  Similarities, scores
and other non-exact floating results are rounded (6 dp, predictions 4 dp) on
both sides; ranks are computed on the rounded values with id tie-breaks.
"""

from __future__ import annotations

PROFILE_USER = 2147483647
# The served profile of the reference's sample file, under a
# user id that cannot collide with a customer key.
PROFILE_ROWS = [(PROFILE_USER, 525, 5.0, 1400000000), (PROFILE_USER, 625, 3.0, 1400000000),
                (PROFILE_USER, 744, 2.5, 1400000000), (PROFILE_USER, 1219, 4.5, 1400000000)]
SERVED_USER = 1
PIVOT_WIDTH = 16
#: 1993-01-01 in epoch seconds.
FIRST_YEAR_ENDS = 725846400
BRANDS = [f"Brand#{i}" for i in range(1, 26)]

R = """R AS (SELECT o_custkey AS user_id, l_partkey AS product_id,
              CAST(floor((l_quantity - 1) / 10) + 1 AS DOUBLE) AS rating,
              CAST(epoch(l_shipdate) AS BIGINT) AS ts
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
P = "P AS (SELECT p_partkey AS product_id, p_name AS title FROM part)"
RD = "RD AS (SELECT *, CAST(((floor(ts / 100) % 10) + 10) % 10 AS INTEGER) AS split_digit FROM R)"
PROFILE = ("PROFILE AS (SELECT CAST(a AS BIGINT) AS user_id, CAST(b AS BIGINT) AS product_id, "
           "CAST(c AS DOUBLE) AS rating, CAST(d AS BIGINT) AS ts FROM (VALUES "
           + ", ".join(f"({u}, {p}, {r}, {t})" for u, p, r, t in PROFILE_ROWS) + ") v(a, b, c, d))")
TRAIN = "TRAIN AS (SELECT user_id, product_id, rating, ts FROM RD WHERE split_digit < 6 UNION ALL SELECT * FROM PROFILE)"
VALID = "VALID AS (SELECT user_id, product_id, rating, ts FROM RD WHERE split_digit >= 6 AND split_digit < 8)"
TEST = "TEST AS (SELECT user_id, product_id, rating, ts FROM RD WHERE split_digit >= 8)"
M = "m AS (SELECT user_id AS u, product_id AS p, avg(rating) AS r FROM R GROUP BY user_id, product_id)"
Z = """st AS (SELECT u, avg(r) AS mu, max(r) - min(r) AS rg FROM m GROUP BY u),
z AS (SELECT m.u, m.p, (m.r - st.mu) / st.rg AS z FROM m JOIN st ON m.u = st.u WHERE st.rg > 0)"""
US = """nu AS (SELECT u, sqrt(sum(z * z)) AS n FROM z GROUP BY u HAVING sum(z * z) > 0),
us AS (SELECT a.u AS u1, b.u AS u2, round(sum(a.z * b.z) / (max(x.n) * max(y.n)), 6) AS sim
       FROM z a JOIN z b ON a.p = b.p AND a.u <> b.u JOIN nu x ON x.u = a.u JOIN nu y ON y.u = b.u
       GROUP BY a.u, b.u),
un AS (SELECT *, row_number() OVER (PARTITION BY u1 ORDER BY sim DESC, u2) AS k FROM us)"""
PS = """np AS (SELECT p, sqrt(sum(z * z)) AS n FROM z GROUP BY p HAVING sum(z * z) > 0),
ps AS (SELECT a.p AS p1, b.p AS p2, round(sum(a.z * b.z) / (max(x.n) * max(y.n)), 6) AS sim
       FROM z a JOIN z b ON a.u = b.u AND a.p <> b.p JOIN np x ON x.p = a.p JOIN np y ON y.p = b.p
       GROUP BY a.p, b.p)"""
PRED = """pr AS (SELECT t.u, t.p, sum(un.sim * n.r) / sum(un.sim) AS prediction, count(*) AS n_neighbours
       FROM m t JOIN un ON un.u1 = t.u AND un.sim > 0
       JOIN m n ON n.u = un.u2 AND n.p = t.p GROUP BY t.u, t.p)"""
CP = """cp AS (SELECT a.u AS u1, b.u AS u2, sum(a.r * b.r) AS xy, sum(a.r * a.r) AS xx, sum(b.r * b.r) AS yy,
              count(*) AS n
       FROM m a JOIN m b ON a.p = b.p AND a.u < b.u GROUP BY a.u, b.u),
cs AS (SELECT u1, u2, round(CASE WHEN sqrt(xx) * sqrt(yy) = 0 THEN 0.0 ELSE xy / (sqrt(xx) * sqrt(yy)) END, 6) AS sim,
              n FROM cp)"""
NN = """sy AS (SELECT u1, u2, sim, n FROM cs UNION ALL SELECT u2, u1, sim, n FROM cs),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY u1 ORDER BY sim DESC, n DESC, u2) AS k FROM sy)
       WHERE k <= 100)"""
REC = """rec AS (SELECT nn.u1, m.p, round(sum(nn.sim * m.r) / sum(nn.sim), 6) AS score
        FROM nn JOIN m ON m.u = nn.u2 {unseen} GROUP BY nn.u1, m.p HAVING sum(nn.sim) <> 0)"""
UNSEEN = "LEFT JOIN m own ON own.u = nn.u1 AND own.p = m.p WHERE own.u IS NULL"


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def rank(expr: str) -> str:
    return f"CAST(row_number() OVER ({expr}) AS INTEGER)"


ORACLE: dict[str, str] = {}

_ratings = "SELECT user_id, product_id, rating, ts FROM R"
ORACLE["scan_ratings_delimited"] = w(R) + _ratings
ORACLE["scan_ratings_csv_header"] = w(R) + "SELECT user_id, product_id, rating FROM R"
ORACLE["scan_product_titles"] = w(P) + "SELECT product_id, title FROM P"
ORACLE["scan_metadata_json"] = ("SELECT 'P' || CAST(p_partkey AS VARCHAR) AS asin, p_name AS title, p_retailprice AS price, "
                                "p_brand AS brand, p_type AS description FROM part")
ORACLE["metadata_projection"] = ("SELECT 'P' || CAST(p_partkey AS VARCHAR) AS product_id, p_name AS title, "
                                 "p_type AS category FROM part")
ORACLE["load_personal_ratings"] = w(R) + _ratings + " WHERE rating > 0"
ORACLE["write_ratings_delimited"] = w(R) + _ratings
ORACLE["write_titles_delimited"] = "SELECT p_partkey AS product_id, p_name || ' ' || p_brand AS title FROM part"
ORACLE["write_metadata_csv"] = ("SELECT p_partkey AS product_id, p_name AS title, p_brand AS brand, "
                                "p_retailprice AS price FROM part")

ORACLE["filter_user_id_cap"] = w(R) + _ratings + " WHERE user_id <= 1000"
ORACLE["split_digit"] = w(R, RD) + "SELECT user_id, product_id, rating, ts, split_digit FROM RD"
ORACLE["positive_ratings"] = w(R) + _ratings + " WHERE rating > 0"
ORACLE["multi_rater_products"] = w(R) + ("SELECT product_id, count(*) AS n_raters FROM R GROUP BY product_id "
                                         "HAVING count(*) > 1")
ORACLE["title_ascii"] = "SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7F]', '', 'g') AS title_ascii FROM documents"
ORACLE["strip_split_cast"] = w(R) + _ratings
ORACLE["safe_ratio"] = ("SELECT l_orderkey, l_linenumber, round(CASE WHEN l_discount = 0 THEN 0.0 "
                        "ELSE l_tax / l_discount END, 6) AS ratio FROM lineitem")

_names = ("N AS (SELECT c.c_name AS user_id, 'P' || CAST(R.product_id AS VARCHAR) AS product_id, R.rating, R.ts "
          "FROM R JOIN customer c ON c.c_custkey = R.user_id)")
ORACLE["encode_users"] = w(R, _names) + ("SELECT CAST(dense_rank() OVER (ORDER BY user_id) - 1 AS BIGINT) AS user_id, "
                                         "product_id, rating, ts FROM N")
ORACLE["encode_products"] = w(R, _names) + ("SELECT user_id, CAST(dense_rank() OVER (ORDER BY product_id) - 1 AS BIGINT) "
                                            "AS product_id, rating, ts FROM N")
ORACLE["encode_metadata_products"] = ("SELECT CAST(dense_rank() OVER (ORDER BY 'P' || CAST(p_partkey AS VARCHAR)) - 1 "
                                      "AS BIGINT) AS product_id, p_name AS title FROM part")
ORACLE["encode_joint"] = w(R, _names) + (
    "SELECT product_id, CAST(dense_rank() OVER (ORDER BY product_id) - 1 AS BIGINT) AS code FROM "
    "(SELECT product_id FROM N UNION SELECT 'P' || CAST(p_partkey AS VARCHAR) FROM part)")
ORACLE["encode_append"] = w(R, _names) + (
    "SELECT user_id, dense_rank() OVER (ORDER BY version, user_id) - 1 AS code, version FROM (SELECT user_id, "
    f"CASE WHEN min(ts) < {FIRST_YEAR_ENDS} THEN 1 ELSE 2 END AS version FROM N GROUP BY user_id)")
ORACLE["decode_ids"] = w(R, _names) + "SELECT user_id, product_id, rating, ts FROM N"

ORACLE["rating_summary"] = w(R) + ("SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, "
                                   "count(DISTINCT product_id) AS n_products FROM R")
ORACLE["rating_profile"] = w(R, RD) + (
    "SELECT CASE WHEN split_digit < 6 THEN 'train' WHEN split_digit < 8 THEN 'validation' ELSE 'test' END AS split, "
    "count(*) AS n_ratings, true AS n_users_near, true AS n_products_near FROM RD GROUP BY 1")
ORACLE["frequent_products"] = w(R) + (
    "SELECT least(20, count(DISTINCT product_id)) AS n_listed, CAST(0 AS BIGINT) AS n_off, true AS none_missed FROM R")
ORACLE["split_counts"] = w(R, RD) + ("SELECT CASE WHEN split_digit < 6 THEN 'train' WHEN split_digit < 8 THEN 'validation' "
                                     "ELSE 'test' END AS split, count(*) AS n FROM RD GROUP BY 1")
ORACLE["user_item_mean"] = w(R) + ("SELECT user_id, product_id, avg(rating) AS rating FROM R "
                                   "GROUP BY user_id, product_id")
ORACLE["user_item_pivot"] = w(R) + (f"SELECT user_id, product_id // {PIVOT_WIDTH} AS product_block, " + ", ".join(
    f"avg(CASE WHEN product_id % {PIVOT_WIDTH} = {j} THEN rating END) AS p_{j}" for j in range(PIVOT_WIDTH))
    + f" FROM R GROUP BY user_id, product_id // {PIVOT_WIDTH}")
ORACLE["user_rating_stats"] = w(R, M) + ("SELECT u AS user_id, round(avg(r), 6) AS mean_rating, max(r) AS max_rating, "
                                         "min(r) AS min_rating FROM m GROUP BY u")
ORACLE["mean_rating"] = w(R, RD, PROFILE, TRAIN, VALID) + (
    "SELECT round(avg(rating), 6) AS mean_rating FROM (SELECT * FROM TRAIN UNION ALL SELECT * FROM VALID)")
ORACLE["raters_per_product"] = w(R) + "SELECT product_id, count(*) AS n_raters FROM R GROUP BY product_id"
ORACLE["pair_moments"] = w(R, M, CP) + ("SELECT u1 AS user1, u2 AS user2, round(xy, 6) AS xy, round(xx, 6) AS xx, "
                                        "round(yy, 6) AS yy, n FROM cp")

ORACLE["split_train"] = w(R, RD, PROFILE, TRAIN) + "SELECT * FROM TRAIN"
ORACLE["split_validation"] = w(R, RD, VALID) + "SELECT * FROM VALID"
ORACLE["split_test"] = w(R, RD, TEST) + "SELECT * FROM TEST"
ORACLE["random_split"] = w(R) + (
    "SELECT user_id, product_id, rating, ts, CASE WHEN b < 5 THEN 'train' WHEN b < 8 THEN 'validation' "
    "ELSE 'test' END AS split FROM (SELECT *, ('0x' || substr(md5('0|' || CAST(user_id AS VARCHAR) || '|' || "
    "CAST(product_id AS VARCHAR) || '|' || CAST(ts AS VARCHAR)), 1, 8))::BIGINT % 10 AS b FROM R)")
ORACLE["union_all_ratings"] = w(R, RD, PROFILE, TRAIN, VALID) + "SELECT * FROM TRAIN UNION ALL SELECT * FROM VALID"
ORACLE["distinct_ids"] = w(R) + "SELECT DISTINCT user_id FROM R"

ORACLE["join_predictions_actuals"] = w(R, M, Z, US, PRED) + (
    "SELECT pr.u AS user_id, pr.p AS product_id, round(pr.prediction, 4) AS prediction, m.r AS rating "
    "FROM pr JOIN m ON m.u = pr.u AND m.p = pr.p")
ORACLE["co_rater_pairs"] = w(R, M) + ("SELECT a.p AS product_id, a.u AS user1, b.u AS user2, a.r AS rating1, "
                                      "b.r AS rating2 FROM m a JOIN m b ON a.p = b.p AND a.u < b.u")
ORACLE["title_lookup"] = w(R, P) + ("SELECT c.product_id, c.n_raters, P.title FROM (SELECT product_id, count(*) AS n_raters "
                                    "FROM R GROUP BY product_id) c LEFT JOIN P ON P.product_id = c.product_id")
ORACLE["unseen_candidates"] = w(PROFILE) + ("SELECT DISTINCT p_partkey AS product_id FROM part WHERE p_partkey NOT IN "
                                            "(SELECT product_id FROM PROFILE)")
ORACLE["neighbour_ratings_join"] = w(R, M, CP, NN) + (
    "SELECT nn.u1 AS user_id, m.p AS product_id, round(sum(nn.sim * m.r), 8) AS sum_sim_rating, "
    "round(sum(nn.sim), 6) AS sum_sim, count(*) AS n_neighbours FROM nn JOIN m ON m.u = nn.u2 GROUP BY nn.u1, m.p")
_covered = ("SELECT count(*) AS n_test, count(CASE WHEN u.user_id IS NOT NULL AND p.product_id IS NOT NULL THEN 1 END) "
            "AS n_covered FROM TEST t LEFT JOIN (SELECT DISTINCT user_id FROM TRAIN) u ON u.user_id = t.user_id "
            "LEFT JOIN (SELECT DISTINCT product_id FROM TRAIN) p ON p.product_id = t.product_id")
_split_ctes = (R, RD, PROFILE, TRAIN, VALID, TEST)
ORACLE["score_known_pairs"] = w(*_split_ctes) + f"SELECT n_covered AS n_scored FROM ({_covered})"

ORACLE["user_center_scale"] = w(R, M, Z) + "SELECT u AS user_id, p AS product_id, round(z, 6) AS z FROM z"
ORACLE["drop_constant_users"] = w(R, M) + ("SELECT u AS user_id, count(*) AS n_products FROM m GROUP BY u "
                                           "HAVING max(r) - min(r) > 0")
ORACLE["item_cosine"] = w(R, M, Z, PS) + "SELECT p1 AS product_id1, p2 AS product_id2, sim FROM ps WHERE p1 < p2"
ORACLE["user_cosine"] = w(R, M, Z, US) + "SELECT u1 AS user_id1, u2 AS user_id2, sim FROM us WHERE u1 < u2"
ORACLE["corated_cosine"] = w(R, M, CP) + "SELECT u1 AS user1, u2 AS user2, sim, n FROM cs"
ORACLE["cap_raters"] = w(R, M) + (
    "SELECT u AS user_id, p AS product_id, r AS rating FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY "
    "md5('42|' || CAST(u AS VARCHAR) || '|' || CAST(p AS VARCHAR)), u) AS rn FROM m) WHERE rn <= 20")

ORACLE["top_similar_products"] = w(R, M, Z, PS) + (
    "SELECT p1 AS product_id, p2 AS similar_product_id, sim, k AS rank FROM (SELECT *, "
    + rank("PARTITION BY p1 ORDER BY sim DESC, p2") + " AS k FROM ps) WHERE k <= 10")
ORACLE["top_similar_users"] = w(R, M, Z, US) + (
    "SELECT u1 AS user_id, u2 AS neighbour_id, sim, CAST(k AS INTEGER) AS rank FROM un WHERE k <= 10")
ORACLE["similar_user_recs"] = w(R, M, Z, US) + """,
best AS (SELECT z.u, z.p FROM z JOIN (SELECT u, max(z) AS mz FROM z GROUP BY u) q ON z.u = q.u AND z.z = q.mz),
cnt AS (SELECT un.u1, best.p, count(*) AS n FROM un JOIN best ON best.u = un.u2 WHERE un.k <= 10
        GROUP BY un.u1, best.p)
SELECT u1 AS user_id, p AS product_id, n AS n_neighbours, k AS rank FROM (
  SELECT *, """ + rank("PARTITION BY u1 ORDER BY n DESC, p") + " AS k FROM cnt) WHERE k <= 5"
ORACLE["predict_rating"] = w(R, M, Z, US, PRED) + (
    "SELECT u AS user_id, p AS product_id, round(prediction, 4) AS prediction, n_neighbours FROM pr")
ORACLE["predict_rating_nearest"] = w(R, M, Z, US) + (
    "SELECT u AS user_id, p AS product_id, round(sum(sim * r) / sum(sim), 4) AS prediction, count(*) AS n_neighbours FROM ("
    "SELECT t.u, t.p, un.sim, n.r, row_number() OVER (PARTITION BY t.u, t.p ORDER BY un.sim DESC, un.u2) AS place "
    "FROM m t JOIN un ON un.u1 = t.u AND un.sim > 0 JOIN m n ON n.u = un.u2 AND n.p = t.p) WHERE place <= 5 GROUP BY u, p")
ORACLE["nearest_neighbours"] = w(R, M, CP, NN) + (
    "SELECT u1 AS user_id, u2 AS neighbour_id, sim, n, CAST(k AS INTEGER) AS rank FROM nn")
_rec_out = ("SELECT u1 AS user_id, p AS product_id, score, k AS rank FROM (SELECT *, "
            + rank("PARTITION BY u1 ORDER BY score DESC, p DESC") + " AS k FROM rec) WHERE k <= 100")
ORACLE["weighted_sum_recs"] = w(R, M, CP, NN, REC.format(unseen="")) + _rec_out
ORACLE["weighted_sum_recs_unseen"] = w(R, M, CP, NN, REC.format(unseen=UNSEEN)) + _rec_out
ORACLE["recs_for_user"] = w(R, P, M, CP, NN, REC.format(unseen=UNSEEN)) + (
    "SELECT x.u1 AS user_id, x.k AS rank, x.p AS product_id, x.score, P.title FROM (SELECT *, "
    + rank("PARTITION BY u1 ORDER BY score DESC, p DESC") + f" AS k FROM rec WHERE u1 = {SERVED_USER}) x "
    "LEFT JOIN P ON P.product_id = x.p WHERE x.k <= 100")
ORACLE["als_recs_for_user"] = w(PROFILE) + (
    "SELECT least(50, count(*)) AS n_rows, CAST(0 AS BIGINT) AS n_seen, CAST(0 AS BIGINT) AS n_rank_gaps, "
    "CAST(0 AS BIGINT) AS n_inversions, CAST(0 AS BIGINT) AS n_better FROM "
    "(SELECT DISTINCT p_partkey FROM part WHERE p_partkey NOT IN (SELECT product_id FROM PROFILE))")
ORACLE["rank_ordinal"] = w(R, M) + (
    "SELECT u AS user_id, p AS product_id, r AS rating, " + rank("PARTITION BY u ORDER BY r DESC, p") + " AS rank FROM m")

ORACLE["als_train"] = w(R, RD, PROFILE, TRAIN) + (
    "SELECT count(DISTINCT user_id) AS n_users, CAST(0 AS BIGINT) AS n_violations FROM TRAIN")
ORACLE["als_fold_in"] = w(R, RD, PROFILE, TRAIN) + (
    "SELECT count(DISTINCT user_id) AS n_users, CAST(0 AS BIGINT) AS n_off FROM TRAIN")
ORACLE["als_recs_for_all"] = w(R, RD, PROFILE, TRAIN) + (
    ", pr AS (SELECT DISTINCT user_id, product_id FROM TRAIN), known AS (SELECT DISTINCT product_id FROM pr JOIN part ON p_partkey = product_id), "
    "e AS (SELECT pr.user_id, least(50, (SELECT count(*) FROM known) - count(known.product_id)) AS n FROM pr LEFT JOIN known "
    "ON known.product_id = pr.product_id GROUP BY pr.user_id) SELECT count(*) AS n_users, CAST(sum(n) AS BIGINT) AS n_rows, "
    "CAST(0 AS BIGINT) AS n_seen, CAST(0 AS BIGINT) AS n_rank_gaps, CAST(0 AS BIGINT) AS n_inversions, CAST(0 AS BIGINT) AS n_off "
    "FROM e WHERE n > 0")
ORACLE["als_grid_search"] = ("SELECT CAST(2 AS BIGINT) AS n_settings, CAST(1 AS BIGINT) AS n_best, CAST(0 AS BIGINT) AS n_better, "
                             "CAST(0 AS BIGINT) AS n_mismatch")
ORACLE["als_predict"] = w(*_split_ctes) + f"SELECT n_covered AS n_rows, CAST(0 AS BIGINT) AS n_mismatch FROM ({_covered})"
ORACLE["rmse"] = w(R, M, Z, US, PRED) + (
    "SELECT round(sqrt(sum(power(pr.prediction - m.r, 2)) / count(pr.prediction)), 6) AS rmse, "
    "round(sqrt(sum(power(pr.prediction - m.r, 2)) / count(*)), 6) AS rmse_all_rows, "
    "round(count(pr.prediction) / count(*), 6) AS coverage, count(pr.prediction) AS n_predicted, count(*) AS n_rows "
    "FROM m LEFT JOIN pr ON pr.u = m.u AND pr.p = m.p")
ORACLE["mean_baseline_rmse"] = w(*_split_ctes) + (
    "SELECT round(mu, 6) AS mean_rating, round(sqrt(avg(power(t.rating - mu, 2))), 6) AS baseline_rmse, "
    "count(*) AS n_test FROM TEST t, (SELECT avg(rating) AS mu FROM (SELECT * FROM TRAIN UNION ALL "
    "SELECT * FROM VALID)) GROUP BY mu")
_fit = "FIT AS (SELECT * FROM TRAIN UNION ALL SELECT * FROM VALID)"
_fit_means = "m AS (SELECT user_id AS u, product_id AS p, avg(rating) AS r FROM FIT GROUP BY user_id, product_id)"
_test_pairs = PRED.replace("FROM m t JOIN", "FROM (SELECT DISTINCT user_id AS u, product_id AS p FROM TEST) t JOIN")
ORACLE["improvement_pct"] = w(*_split_ctes, _fit, _fit_means, Z, US, _test_pairs) + (
    ", mean AS (SELECT avg(rating) AS mu FROM FIT), "
    "e AS (SELECT sqrt(avg(power(coalesce(pr.prediction, mu) - t.rating, 2))) AS rmse, sqrt(avg(power(mu - t.rating, 2))) AS base, "
    "count(*) AS n_test, count(pr.prediction) AS n_predicted "
    "FROM mean, TEST t LEFT JOIN pr ON pr.u = t.user_id AND pr.p = t.product_id) "
    "SELECT round(rmse, 6) AS rmse, round(base, 6) AS baseline_rmse, round((base - rmse) * 100.0 / base, 4) AS improvement_pct, "
    "n_test, n_predicted FROM e")
ORACLE["user_insample_error"] = w(R, M, Z, US, PRED) + (
    "SELECT m.u AS user_id, count(*) AS n_rated, count(pr.prediction) AS n_predicted, "
    "round(avg(power(pr.prediction - m.r, 2)), 6) AS mse, round(sqrt(avg(power(pr.prediction - m.r, 2))), 6) AS rmse "
    "FROM m LEFT JOIN pr ON pr.u = m.u AND pr.p = m.p WHERE m.r > 0 GROUP BY m.u")
ORACLE["als_coverage"] = w(*_split_ctes) + (
    f"SELECT n_test, n_covered, round(n_covered / n_test, 6) AS coverage FROM ({_covered})")

_nation = "MN AS (SELECT m.u, m.p, m.r, c.c_nationkey AS g FROM m JOIN customer c ON c.c_custkey = m.u)"
ORACLE["regional_neighbours"] = w(R, M, _nation) + """,
cp AS (SELECT a.u AS u1, b.u AS u2, sum(a.r * b.r) AS xy, sum(a.r * a.r) AS xx, sum(b.r * b.r) AS yy, count(*) AS n
       FROM MN a JOIN MN b ON a.p = b.p AND a.u <> b.u AND a.g = b.g GROUP BY a.u, b.u),
sy AS (SELECT u1, u2, round(xy / (sqrt(xx) * sqrt(yy)), 6) AS sim, n FROM cp)
SELECT u1 AS user_id, u2 AS neighbour_id, sim, n, k AS rank FROM (SELECT *, """ + rank(
    "PARTITION BY u1 ORDER BY sim DESC, n DESC, u2") + " AS k FROM sy) WHERE k <= 100"
ORACLE["user_interests"] = w(R) + (
    "SELECT R.user_id, part.p_type AS category, round(avg(R.rating), 6) AS interest, count(*) AS n_ratings "
    "FROM R JOIN part ON part.p_partkey = R.product_id GROUP BY R.user_id, part.p_type")
ORACLE["user_clusters"] = w(R) + ("SELECT count(DISTINCT R.user_id) AS n_users, CAST(5 AS BIGINT) AS n_clusters, CAST(0 AS BIGINT) AS n_misplaced "
                                  "FROM R JOIN part ON part.p_partkey = R.product_id")
ORACLE["user_interest_vector"] = w(R) + ("SELECT R.user_id, " + ", ".join(
    f"round(avg(CASE WHEN part.p_brand = '{b}' THEN R.rating END), 6) AS brand_{b.split('#')[1]}" for b in BRANDS)
    + " FROM R JOIN part ON part.p_partkey = R.product_id GROUP BY R.user_id")
