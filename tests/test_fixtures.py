"""Micro-fixtures for the edge cases of the survey (FIXTURES.md §3)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tastegraph.operators import encode as L
from tastegraph.operators import evaluate as E
from tastegraph.operators import neighbours as NB
from tastegraph.operators import ratings as RT
from tastegraph.operators import similarity as SIM
from tastegraph.sources import delimited as D
from tastegraph.sources import metadata as MD


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_constant_user_dropped(ratings):
    m = RT.user_item_mean(ratings([(1, 10, 3), (1, 11, 3), (2, 10, 1), (2, 11, 5)]))
    z = SIM.user_center_scale(m)
    assert {r.user_id for r in z.collect()} == {2}
    assert rows(SIM.drop_constant_users(m), "user_id", "n_products") == [(2, 2)]


def test_duplicate_rating_averaged_and_no_self_pair(ratings):
    m = RT.user_item_mean(ratings([(1, 10, 2), (1, 10, 4), (2, 10, 5)]))
    assert rows(m.filter("user_id = 1"), "rating") == [(3.0,)]
    pairs = SIM.co_rater_pairs(m)
    assert rows(pairs, "user1", "user2") == [(1, 2)]


def test_one_common_product(ratings):
    m = RT.user_item_mean(ratings([(1, 10, 1), (2, 10, 5)]))
    assert rows(SIM.corated_cosine(m), "user1", "user2", "sim", "n") == [(1, 2, 1.0, 1)]
    assert SIM.corated_cosine(m, min_overlap=2).count() == 0


def test_zero_ratings(ratings):
    m = RT.user_item_mean(ratings([(1, 10, 0), (2, 10, 4), (2, 11, 3)]))
    assert rows(SIM.corated_cosine(m), "sim") == [(0.0,)]
    nn = NB.nearest_neighbours(m, k=10, cap=None)
    recs = NB.weighted_sum_recs(nn, m, 10)
    # Σ sim = 0 for every product: no score rows at all
    assert recs.count() == 0


def test_negative_timestamp_digit(ratings):
    df = RT.with_split_digit(ratings([(1, 10, 1, -150), (1, 11, 1, 1234), (1, 12, 1, 99)]))
    assert rows(df, "ts", "split_digit") == [(-150, 8), (99, 0), (1234, 2)]


def test_title_with_separator_and_accents(spark):
    d = tempfile.mkdtemp(prefix="tg-titles-")
    p = os.path.join(d, "t.txt")
    with open(p, "w", encoding="utf-8") as f:
        f.write("7#A#1 Café™\n")
    assert rows(D.read_product_titles(spark, p), "product_id", "title") == [(7, "A#1 Café™")]
    assert rows(D.read_product_titles(spark, p, truncate_at_sep=True), "title") == [("A",)]
    from tastegraph.functions import ascii_only
    got = D.read_product_titles(spark, p).select(ascii_only("title").alias("a")).first().a
    assert got == "A#1 Caf"


def test_loose_json(spark):
    d = tempfile.mkdtemp(prefix="tg-meta-")
    p = os.path.join(d, "m.json")
    with open(p, "w", encoding="utf-8") as f:
        f.write("{'asin': '1', 'title': \"Rubik's\", 'x': None}\n")
        f.write("{'asin': '2', 'title': 'It\\'s'}\n")
        f.write('{"asin": "3", "title": "plain", "price": 2.5, "salesRank": {"Toys": 7}}\n')
        f.write("this is not a record\n")
    df = MD.read_metadata_json(spark, p)
    good = MD.metadata_records(df)
    assert rows(good, "asin", "title") == [("1", "Rubik's"), ("2", "It's"), ("3", "plain")]
    assert MD.metadata_rejects(df).count() == 1
    proj = MD.project_metadata(good)
    assert "product_id" in proj.columns and "price" not in proj.columns and "salesRank" not in proj.columns
    with pytest.raises(KeyError):
        MD.project_metadata(good.drop("brand"), strict=True)


def test_mismatched_dictionaries(spark):
    r = spark.createDataFrame([("u", "a"), ("u", "c")], "user_id string, product_id string")
    meta = spark.createDataFrame([("a",), ("b",), ("c",)], "product_id string")
    _, d2 = L.encode_products(r)
    _, d3 = L.encode_metadata_products(meta)
    c2 = {x.product_id: x.code for x in d2.collect()}
    c3 = {x.product_id: x.code for x in d3.collect()}
    assert c2["c"] != c3["c"]
    joint = {x.product_id: x.code for x in L.encode_joint(r, meta).collect()}
    assert joint == {"a": 0, "b": 1, "c": 2}


def test_encoding_dense_and_ordered_over_partitions(spark):
    vals = [f"id{i:05d}" for i in range(0, 3000, 3)] + ["B", "a", "é", "10", "9"]
    df = spark.createDataFrame([(v,) for v in vals], "user_id string").repartition(7)
    d = {x.user_id: x.code for x in L.build_dictionary(df, "user_id").collect()}
    assert sorted(d.values()) == list(range(len(vals)))
    order = sorted(vals, key=lambda s: s.encode("utf-8"))
    assert [d[v] for v in order] == list(range(len(vals)))


def test_decode_inverts_encode(spark):
    r = spark.createDataFrame([("x", "P10", 1.0), ("y", "P9", 2.0), ("x", "P9", 3.0)],
                              "user_id string, product_id string, rating double")
    enc, dic = L.encode_products(r)
    back = L.decode_column(enc, "product_id", dic)
    assert rows(back, "user_id", "product_id", "rating") == rows(r, "user_id", "product_id", "rating")


def test_empty_profile_raises(spark):
    d = tempfile.mkdtemp(prefix="tg-prof-")
    p = os.path.join(d, "p.txt")
    with open(p, "w") as f:
        f.write("0|525|0|1400000000|Duck\n0|625|0.0|1400000000|Gag\n")
    with pytest.raises(ValueError):
        D.load_personal_ratings(spark, p)


def test_profile_loaded(spark):
    d = tempfile.mkdtemp(prefix="tg-prof-")
    p = os.path.join(d, "p.txt")
    with open(p, "w") as f:
        f.write("0|525|5.0|1400000000|Duck Duck Safari\n0|625|0|1400000000|Capture\n")
    assert rows(D.load_personal_ratings(spark, p), "product_id", "rating") == [(525, 5.0)]


def test_profile_id_collision(ratings):
    r = ratings([(1, 10, 3), (2, 10, 4)])
    with pytest.raises(ValueError):
        RT.add_profile(r, ratings([(1, 11, 5)]))
    assert RT.add_profile(r, ratings([(9, 11, 5)])).count() == 3


def test_unknown_user_empty(spark, ratings):
    m = RT.user_item_mean(ratings([(1, 10, 1), (1, 11, 5), (2, 10, 2), (2, 11, 4), (3, 10, 5), (3, 12, 1)]))
    z = SIM.user_center_scale(m)
    top = NB.top_similar_users(SIM.user_cosine(z), 10)
    assert top.filter("user_id = 99").count() == 0
    assert NB.similar_user_recs(top, z).filter("user_id = 99").count() == 0
    users = spark.createDataFrame([(99,)], "user_id long")
    prods = spark.createDataFrame([(10, "a")], "product_id long, title string")
    assert NB.recs_for_user(m, prods, users).count() == 0


def test_cold_test_pair(ratings):
    train = ratings([(1, 10, 4), (2, 10, 2), (2, 11, 3)])
    test = ratings([(1, 11, 5), (3, 10, 1)])  # user 3 only in test
    cov = E.known_pair_coverage(test, train).first()
    assert (cov.n_test, cov.n_covered) == (2, 1)
    pred = test.filter("user_id = 1").select("user_id", "product_id", F.lit(4.0).alias("prediction"))
    m = E.rmse(pred, test).first()
    assert m.coverage == 0.5 and m.rmse_all_rows < m.rmse


def test_cap_raters_seeded_and_partition_independent(ratings):
    base = [(u, 10, 1 + u % 5) for u in range(30)] + [(u, 11, 3) for u in range(5)]
    a = SIM.cap_raters(RT.user_item_mean(ratings(base, 1)), n=20, seed=7)
    b = SIM.cap_raters(RT.user_item_mean(ratings(base, 6)), n=20, seed=7)
    assert a.filter("product_id = 10").count() == 20
    assert a.filter("product_id = 11").count() == 5
    assert rows(a, "user_id", "product_id") == rows(b, "user_id", "product_id")


def test_tie_at_one(ratings):
    data = [(u, p, r) for u in (1, 2, 3) for p, r in ((10, 1), (11, 5), (12, 3))]
    z = SIM.user_center_scale(RT.user_item_mean(ratings(data)))
    top = NB.top_similar_users(SIM.user_cosine(z), 10)
    assert rows(top.filter("user_id = 2"), "neighbour_id", "sim", "rank") == [(1, 1.0, 1), (3, 1.0, 2)]


def test_hot_group_split_equals_plain_join(ratings):
    import random
    rnd = random.Random(3)
    data = {(u, 1): rnd.randint(1, 5) for u in range(40)}           # one hot product
    data.update({(u, p): rnd.randint(1, 5) for u in range(40) for p in range(2, 6) if rnd.random() < 0.3})
    m = RT.user_item_mean(ratings([(u, p, r) for (u, p), r in data.items()], 5))
    plain = SIM.self_pairs(m, "product_id", "user_id", ["rating"], hot_threshold=None)
    split = SIM.self_pairs(m, "product_id", "user_id", ["rating"], hot_threshold=6)
    cols = ["product_id", "m1", "m2", "rating_1", "rating_2"]
    assert split.count() == plain.count() == len(rows(split, *cols))
    assert rows(split, *cols) == rows(plain, *cols)
    s1 = rows(SIM.user_cosine(SIM.user_center_scale(m), hot_threshold=None), "user_id1", "user_id2", "sim")
    s2 = rows(SIM.user_cosine(SIM.user_center_scale(m), hot_threshold=4), "user_id1", "user_id2", "sim")
    assert s1 == s2


def test_similarity_invariants(ratings):
    import random
    rnd = random.Random(5)
    data = [(u, p, rnd.randint(1, 5)) for u in range(12) for p in range(8) if rnd.random() < 0.5]
    m = RT.user_item_mean(ratings(data))
    for sims, a, b in ((SIM.corated_cosine(m), "user1", "user2"),
                       (SIM.user_cosine(SIM.user_center_scale(m)), "user_id1", "user_id2")):
        got = rows(sims, a, b, "sim")
        assert all(x < y for x, y, _ in got)
        assert all(-1.0000001 <= s <= 1.0000001 for _, _, s in got)
    nn = NB.nearest_neighbours(m, k=3, cap=None)
    ranks = {}
    for r in nn.collect():
        ranks.setdefault(r.user_id, []).append(r.rank)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in ranks.values())
    recs = NB.weighted_sum_recs(nn, m, 5)
    assert all(1.0 <= r.score <= 5.0 for r in recs.collect())


def test_splits_disjoint_and_complete(ratings):
    data = [(u, p, 3, t) for u, p, t in zip(range(50), range(50), range(-5000, 5000, 200))]
    r = ratings(data)
    tr, va, te = RT.split_train(r), RT.split_validation(r), RT.split_test(r)
    assert tr.count() + va.count() + te.count() == r.count()
    keys = [set((x.user_id, x.product_id) for x in d.collect()) for d in (tr, va, te)]
    assert not (keys[0] & keys[1] or keys[0] & keys[2] or keys[1] & keys[2])
    rs = RT.random_split(r)
    assert rs.count() == 50 and {x.split for x in rs.collect()} <= {"train", "validation", "test"}


def test_write_read_roundtrips(spark, ratings):
    r = ratings([(1, 10, 2.5, 100), (2, 11, 4, -3)])
    d = tempfile.mkdtemp(prefix="tg-io-")
    for sep, header in (("#", False), ("|", False), (",", True)):
        p = D.write_ratings_delimited(r, os.path.join(d, f"r{ord(sep)}"), sep=sep, header=header)
        if header:
            back = D.read_ratings_csv_header(spark, p, sep=sep)
            assert rows(back, "user_id", "product_id", "rating") == [(1, 10, 2.5), (2, 11, 4.0)]
        else:
            back = D.read_ratings_delimited(spark, p, sep=sep)
            assert rows(back, "user_id", "product_id", "rating", "ts") == rows(r, "user_id", "product_id", "rating", "ts")
    t = spark.createDataFrame([(1, "a#b, \"q\""), (2, None)], "product_id long, title string")
    p = D.write_titles_delimited(t, os.path.join(d, "titles"))
    assert rows(D.read_product_titles(spark, p), "product_id", "title") == [(1, 'a#b, "q"'), (2, None)] or \
        rows(D.read_product_titles(spark, p), "product_id", "title") == [(1, 'a#b, "q"'), (2, "")]
    p = D.write_metadata_csv(t, os.path.join(d, "meta"))
    back = spark.read.schema(t.schema).option("header", True).option("escape", '"').csv(p)
    assert rows(back, "product_id", "title") == [(1, 'a#b, "q"'), (2, None)]


def test_failfast_rejects_bad_line(spark):
    d = tempfile.mkdtemp(prefix="tg-bad-")
    p = os.path.join(d, "r.txt")
    with open(p, "w") as f:
        f.write("1|2|3.0|100\nx|2|3.0|100\n")
    assert D.read_ratings_delimited(spark, p).count() == 1
    with pytest.raises(Exception):
        D.read_ratings_delimited(spark, p, mode="FAILFAST").collect()


def test_split_join_equals_plain_join(ratings):
    import random
    rnd = random.Random(11)
    data = {(u, 1): rnd.randint(1, 5) for u in range(50)}
    data.update({(u, p): rnd.randint(1, 5) for u in range(50) for p in range(2, 8) if rnd.random() < 0.25})
    m = RT.user_item_mean(ratings([(u, p, r) for (u, p), r in data.items()], 3))
    left = m.select("user_id", "product_id")
    right = m.select(F.col("user_id").alias("v"), "product_id", "rating")
    cols = ["user_id", "product_id", "v", "rating"]
    plain = rows(SIM.split_join(left, right, "product_id", "user_id", "v", None), *cols)
    split = rows(SIM.split_join(left, right, "product_id", "user_id", "v", 7), *cols)
    assert plain == split and len(plain) == sum(1 for _ in plain)
    z = SIM.user_center_scale(m)
    sims = SIM.user_cosine(z)
    p1 = rows(NB.predict_rating(m, sims, m, hot_threshold=None), "user_id", "product_id", "prediction")
    p2 = rows(NB.predict_rating(m, sims, m, hot_threshold=5), "user_id", "product_id", "prediction")
    assert [(a, b, round(c, 9)) for a, b, c in p1] == [(a, b, round(c, 9)) for a, b, c in p2]
    nn = NB.nearest_neighbours(m, k=5, cap=None)
    j1 = rows(NB.neighbour_ratings(nn, m, hot_threshold=None), "user_id", "product_id", "n_neighbours")
    j2 = rows(NB.neighbour_ratings(nn, m, hot_threshold=3), "user_id", "product_id", "n_neighbours")
    assert j1 == j2


def test_gzip_metadata(spark):
    import gzip
    d = tempfile.mkdtemp(prefix="tg-gz-")
    p = os.path.join(d, "meta.json.gz")
    with gzip.open(p, "wt", encoding="utf-8") as f:
        f.write("{'asin': 'B1', 'title': 'Café', 'related': {'also_bought': ('B2', 'B3')}, 'price': None}\n")
        f.write("{'asin': 'B2', 'title': 'Two', 'salesRank': {'Toys': 12}}\n")
    df = MD.metadata_records(MD.read_metadata_json(spark, p))
    got = {r.asin: r for r in df.collect()}
    assert got["B1"].title == "Café" and got["B1"].related == {"also_bought": ["B2", "B3"]}
    assert got["B2"].salesRank == {"Toys": 12}


def test_string_ids_corated(spark):
    import random
    rnd = random.Random(2)
    rows_ = [("u%d" % u, "p%d" % p, float(rnd.randint(1, 5)), 0) for u in range(8) for p in range(6)
             if rnd.random() < 0.5]
    r = spark.createDataFrame(rows_, "user_id string, product_id string, rating double, ts long")
    m = RT.user_item_mean(r)
    nn = NB.nearest_neighbours(m, k=3)
    recs = NB.weighted_sum_recs(nn, m, 5, unseen=True)
    assert recs.count() > 0
    one = NB.recs_for_user(m, spark.createDataFrame([("p1", "t")], "product_id string, title string"), ["u1"], 3, 5)
    assert {x.user_id for x in one.collect()} <= {"u1"}


def test_rating_summary_approx_close_to_exact(ratings):
    r = ratings([(u, p, 3) for u in range(300) for p in range(u % 7, 40, 7)])
    exact = RT.rating_summary(r).first()
    approx = RT.rating_summary(r, approx=True).first()
    assert exact.n_ratings == approx.n_ratings
    assert abs(approx.n_users - exact.n_users) <= 0.05 * exact.n_users
    assert abs(approx.n_products - exact.n_products) <= 0.05 * exact.n_products


def test_readers_keep_rejects_and_fail_fast(spark, tmp_path):
    from tastegraph.sources import metadata as MD
    p = str(tmp_path / "r.txt")
    with open(p, "w") as f:
        f.write("1|2|3.0|4\nx|2|3.0|4\n5|6|7.5\n")
    assert D.read_ratings_delimited(spark, p).count() == 1
    assert sorted(r.line for r in D.rating_rejects(spark, p).collect()) == ["5|6|7.5", "x|2|3.0|4"]
    for read in (lambda df: df.count(), lambda df: df.select("product_id").collect()):
        with pytest.raises(Exception, match="malformed rating line"):
            read(D.read_ratings_delimited(spark, p, mode="FAILFAST"))
    assert D.read_ratings_delimited(spark, p, id_type="string").count() == 2
    t = str(tmp_path / "t.txt")
    with open(t, "w") as f:
        f.write("1#One\nB2#Two\n")
    assert D.read_product_titles(spark, t).count() == 1 and D.title_rejects(spark, t).first().line == "B2#Two"
    with pytest.raises(Exception, match="malformed title line"):
        D.read_product_titles(spark, t, mode="FAILFAST", dedup=False).count()
    c = str(tmp_path / "c.csv")
    with open(c, "w") as f:
        f.write("user_id,product_id,rating,ts\n1,2,3.5,4\n1,zz,3.5,4\n")
    assert D.read_ratings_csv_header(spark, c).count() == 1
    assert D.csv_rating_rejects(spark, c).count() == 1
    j = str(tmp_path / "m.json")
    with open(j, "w") as f:
        f.write("{'asin': 'A', 'price': 1.5}\n{'asin': 'B', 'price': 'abc', 'x': None}\n{'asin': 'C', 'price': None}\n")
    df = MD.read_metadata_json(spark, j)
    assert sorted(r.asin for r in MD.metadata_records(df).collect()) == ["A", "C"]
    assert "'B'" in MD.metadata_rejects(df).first()[0]
