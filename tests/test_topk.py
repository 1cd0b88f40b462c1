"""Top-k lists without pairs, and hot keys by block Gram matrices, against
plain loops over all pairs."""

import math
import random
import re
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tastegraph.operators import gram as G
from tastegraph.operators import neighbours as NB
from tastegraph.operators import similarity as SIM
from tastegraph.operators import topk as T

COLD = {"cell": 10 ** 9}


@pytest.fixture(autouse=True)
def small_tasks(monkeypatch):
    monkeypatch.setattr(T, "WORK", 300)  # so that blocks have several parts of asking owners


def brute(rows, measure, k, least=1):
    """{owner: [(other, sim, n) …]} of (owner, key, value) rows."""
    vec = {}
    for o, d, v in rows:
        vec.setdefault(o, {})[d] = v
    out = {}
    for o, x in vec.items():
        found = []
        for p, y in vec.items():
            shared = x.keys() & y.keys()
            if o == p or not shared or (measure == "corated" and len(shared) < least):
                continue
            xy = math.fsum(x[d] * y[d] for d in shared)
            sim = xy
            if measure == "corated":
                norm = math.sqrt(sum(x[d] ** 2 for d in shared)) * math.sqrt(sum(y[d] ** 2 for d in shared))
                sim = xy / norm if norm else 0.0
            found.append((p, math.copysign(math.floor(abs(sim) * 1e6 + 0.5), sim) / 1e6 + 0.0, len(shared) if measure == "corated" else 0))
        found.sort(key=lambda t: (-t[1], -t[2], t[0]))
        if found:
            out[o] = found[:k]
    return out


def lists(df, owner="o"):
    out = {}
    for r in df.orderBy(owner, "rank").collect():
        out.setdefault(r[owner], []).append((r.other, r.sim, r.n))
        assert r["rank"] == len(out[r[owner]])
    return out


def some_rows(seed, owners=60, keys=40, hot=3):
    rng = random.Random(seed)
    rows = {(o, d): rng.choice([-1.0, -0.5, 0.0, 0.5, 0.25, 1.0, 2.0]) for o in range(owners) for d in rng.sample(range(keys), rng.randint(1, 8))}
    for d in range(hot):  # keys of nearly everyone
        rows |= {(o, 1000 + d): rng.choice([0.125, 0.25, -0.5, 1.5]) for o in range(owners) if rng.random() < 0.9}
    rows |= {(5, d): 1.0 for d in range(keys)}  # a long owner
    rows[777, 9999] = 1.0  # nobody else has its key
    return [(o, d, v) for (o, d), v in rows.items()]


@pytest.mark.parametrize("options", [COLD, {"cell": 400}, {"cell": 400, "long": 10}, {"cell": 120, "long": 20}, {"cell": 60}])
@pytest.mark.parametrize("measure", ["cosine", "corated"])
def test_lists_equal_all_pairs(spark, options, measure):
    rows = some_rows(3)
    df = spark.createDataFrame(rows, "o int, d int, v double").repartition(4)
    for k in (1, 7):
        assert lists(T.nearest(df, "o", "d", "v", k, measure, **options)) == brute(rows, measure, k)


@pytest.mark.parametrize("measure", ["cosine", "corated"])
def test_blocks_in_turns_give_the_same_lists(spark, monkeypatch, measure):
    monkeypatch.setattr(T, "ROUND", 1)
    monkeypatch.setattr(T, "ROUND_SHARE", 1)
    monkeypatch.setattr(T, "_BATCH", 50)
    asked, original = [], T._asked
    monkeypatch.setattr(T, "_asked", lambda df, *a: asked.append({r[0] for r in df.select("block").distinct().collect()}) or original(df, *a))
    rows = some_rows(9)
    df = spark.createDataFrame(rows, "o int, d int, v double").repartition(4)
    assert lists(T.nearest(df, "o", "d", "v", 4, measure, cell=250)) == brute(rows, measure, 4)
    turns = asked[:-1]  # the last ones are hot
    assert len(turns) > 2 and all(len(t) < len(set.union(*turns)) for t in turns) and not set.intersection(*turns)


def test_a_written_table_leaves_no_shuffle_files(spark):
    from tastegraph.session import materialize
    folders = [Path(x) for x in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()]

    def data():
        return {f for d in folders for f in d.rglob("shuffle_*.data")}

    before = data()
    assert len(materialize(spark.range(1000).repartition(3, "id"), "numbers").collect()) == 1000
    for _ in range(50):
        if not data() - before:
            break
        time.sleep(0.1)
    assert not data() - before


def test_least_overlap_string_ids_nulls_and_no_rows(spark):
    rows = [(f"o{o}", f"é{d}", v) for o, d, v in some_rows(8)]
    df = spark.createDataFrame(rows + [(None, "x", 1.0), ("o1", None, 1.0), ("o2", "x", None)], "o string, d string, v double")
    assert lists(T.nearest(df, "o", "d", "v", 5, "corated", min_overlap=3, cell=500)) == brute(rows, "corated", 5, 3)
    assert T.nearest(df.limit(0), "o", "d", "v", 5, "cosine").collect() == []


def test_hot_cells_and_remaining_norms_are_used(spark, monkeypatch):
    """With a strong cold neighbour, an owner whose hot part is weak does not ask the hot key."""
    rows = [(o, o // 2, 1.0) for o in range(200)] + [(o, 500, 0.01 if o < 190 else 0.9) for o in range(200)]
    monkeypatch.setattr(T, "WORK", 10 ** 9)
    seen = []
    original = T._asked
    monkeypatch.setattr(T, "_asked", lambda df, *a: seen.append(df.filter("asks").select("owner", "cell").distinct().count()) or original(df, *a))
    df = spark.createDataFrame(rows, "o int, d int, v double")
    got = lists(T.nearest(df, "o", "d", "v", 1, "cosine", cell=100))
    assert got == brute(rows, "cosine", 1)
    cold, hot = seen
    assert cold == 200 and hot <= 10 * 8  # only the ten strong owners ask, in one cell per part


def test_registered_lists_form_fewer_rows_than_pairs(spark):
    from tastegraph.plans.catalog import Mm
    sf = "/root/testdata/sf0.01"
    z = SIM.user_center_scale(Mm(spark, sf))
    w = SIM.unit_rows(z, "user_id")
    n = w.groupBy("product_id").count().agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0]
    assert T._asked(_one_cell(w), T.Dealt(None, None, False, 1, 1, None, None), 1, 10, False, 1).count() <= n / 2
    want = {tuple(r) for r in NB.top_similar_users(SIM.user_cosine(z), 10).collect()}
    assert {tuple(r) for r in T.nearest_by_cosine(z, "user_id", "product_id", 10).select("user_id", "other", "sim", "rank").collect()} == want


def _one_cell(w):
    v = F.array_sort(F.collect_list(F.struct("product_id", "w")))
    rows = w.groupBy("user_id").agg(v.alias("v"))
    zero = F.transform("v", lambda x: F.lit(0).cast("long"))
    return rows.select(F.col("user_id").alias("owner"), F.col("v.product_id").alias("keys"), F.col("v.w").alias("values"), zero.alias("blocks"),
                       F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("cell"), F.lit(True).alias("asks"), F.lit(True).alias("answers"))


# ---------------------------------------------------------------- block Gram matrices

def sums(rows):
    vec, out = {}, {}
    for o, d, v in rows:
        vec.setdefault(o, {})[d] = v
    for o, x in vec.items():
        for p, y in vec.items():
            shared = x.keys() & y.keys()
            if o < p and shared:
                out[o, p] = tuple(round(math.fsum(t), 9) for t in ([x[d] * y[d] for d in shared], [x[d] ** 2 for d in shared], [y[d] ** 2 for d in shared])) + (len(shared),)
    return out


@pytest.mark.parametrize("threshold,members", [(None, 8), (1000, 8), (20, 8), (20, 1000), (6, 5), (1, 7)])
def test_gram_blocks_equal_the_join(spark, monkeypatch, threshold, members):
    rows = some_rows(11)
    df = spark.createDataFrame(rows, "o int, d int, v double").repartition(3)
    got = G.pair_sums(df, "d", "o", "v", ["xy", "xx", "yy", "n"], threshold, members).collect()
    assert len({(r.m1, r.m2) for r in got}) == len(got)
    assert {(r.m1, r.m2): (round(r.xy, 9), round(r.xx, 9), round(r.yy, 9), r.n) for r in got} == sums(rows)


@pytest.mark.parametrize("threshold", [1000, 6])
def test_pairs_are_never_exchanged_and_busy_members_are_split(spark, monkeypatch, threshold):
    rows = some_rows(11)
    df = spark.createDataFrame(rows, "o int, d int, v double").repartition(3)
    monkeypatch.setattr(G, "PAIRS", 200)
    made, original = [], G._joined
    monkeypatch.setattr(G, "_joined", lambda *a: made.append((a[4], out := original(*a))) or out)
    got = G.pair_sums(df, "d", "o", "v", ["xy", "xx", "yy", "n"], threshold, 7).collect()
    assert {(r.m1, r.m2): (round(r.xy, 9), round(r.xx, 9), round(r.yy, 9), r.n) for r in got} == sums(rows) and len(got) == len(sums(rows))
    (parts, joined), = made
    assert parts > 1 and not re.search(r"hashpartitioning\(m1#\d+, m2", joined._jdf.queryExecution().executedPlan().toString())


def test_one_product_of_all_users(spark, ratings, monkeypatch):
    rng = random.Random(2)
    rows = [(u, 1, float(rng.randint(1, 5))) for u in range(150)] + [(u, 10 + rng.randrange(30), float(rng.randint(1, 5))) for u in range(150) for _ in range(4)]
    m = ratings([(u, p, r) for (u, p), r in {(u, p): r for u, p, r in rows}.items()]).drop("ts")
    joined = []
    original = G._joined
    monkeypatch.setattr(G, "_joined", lambda df, *a: joined.append({r[0] for r in df.select("key").distinct().collect()}) or original(df, *a))
    hot = {tuple(r) for r in SIM.corated_cosine(m, hot_threshold=100).collect()}
    assert 1 not in joined[0] and len(joined) == 1  # the product of all users never meets itself in a join
    assert hot == {tuple(r) for r in SIM.corated_cosine(m, hot_threshold=None).collect()}
    z = SIM.user_center_scale(m)
    assert {tuple(r) for r in SIM.user_cosine(z, hot_threshold=100).collect()} == {tuple(r) for r in SIM.user_cosine(z, hot_threshold=None).collect()}
    assert {tuple(r) for r in SIM.item_cosine(z, hot_threshold=4).collect()} == {tuple(r) for r in SIM.item_cosine(z, hot_threshold=None).collect()}
