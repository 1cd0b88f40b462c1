"""Weighted sums by blocks of users against the join."""

import random

import pytest

from tastegraph.operators import neighbours as NB
from tastegraph.operators import recommend, topk


@pytest.fixture(scope="module")
def inputs(spark):
    rng = random.Random(6)
    rows = {(u, rng.randrange(40)): float(rng.randint(1, 5)) for u in range(50) for _ in range(7)}
    rows |= {(0, p): 3.0 for p in range(40)}  # everyone's heavy neighbour
    m = spark.createDataFrame([(u, p, r) for (u, p), r in rows.items()], "user_id long, product_id long, rating double").repartition(3).cache()
    nn = {(u, v): rng.choice([1.0, 0.5, 0.25, 0.0]) for u in range(50) for v in [0, *rng.sample(range(50), 6)] if u != v}
    nn |= {(51, 3): 0.5, (52, 999): 1.0}  # a user without ratings, a neighbour without
    lists = spark.createDataFrame([(u, v, s) for (u, v), s in nn.items()], "user_id long, neighbour_id long, sim double").repartition(3).cache()
    return lists, m


@pytest.mark.parametrize("unseen", [False, True])
@pytest.mark.parametrize("k,cell", [(5, 10 ** 9), (5, 150), (100, 90), (1, 60), (100, 1)])
def test_blocks_equal_the_join(inputs, unseen, k, cell):
    nn, m = inputs
    got = [tuple(r) for r in NB.weighted_sum_recs_for_all(nn, m, k, unseen, cell=cell).select("user_id", "product_id", "score", "rank").collect()]
    want = [tuple(r) for r in NB.weighted_sum_recs(nn, m, k, unseen).select("user_id", "product_id", "score", "rank").collect()]
    assert sorted(got) == sorted(want) and got


@pytest.mark.parametrize("unseen", [False, True])
def test_blocks_in_turns_equal_the_join(inputs, monkeypatch, unseen):
    for name in ("ROUND", "ROUND_SHARE"):
        monkeypatch.setattr(topk, name, 1)
    written, original = [], recommend.materialize
    monkeypatch.setattr(recommend, "materialize", lambda df, name: written.append(name) or original(df, name))
    nn, m = inputs
    got = [tuple(r) for r in NB.weighted_sum_recs_for_all(nn, m, 5, unseen, cell=150).select("user_id", "product_id", "score", "rank").collect()]
    want = [tuple(r) for r in NB.weighted_sum_recs(nn, m, 5, unseen).select("user_id", "product_id", "score", "rank").collect()]
    assert sorted(got) == sorted(want) and written.count("scores-of-turn") > 2


@pytest.mark.parametrize("cell", [10 ** 9, 150, 1])
def test_all_sums_by_blocks_equal_the_join(spark, inputs, cell):
    nn, m = inputs

    def rows(df):
        return sorted((r.user_id, r.product_id, round(r.sum_sim_rating, 8), round(r.sum_sim, 8), r.n_neighbours) for r in df.collect())

    want, made = rows(NB.neighbour_ratings(nn, m)), NB.neighbour_ratings_for_all(nn, m, cell=cell)
    assert rows(made) == want
    if cell > 1:
        assert "FlatMapCoGroupsInArrow" in made._jdf.queryExecution().executedPlan().toString()
    missing = m.unionByName(spark.createDataFrame([(0, 99, None), (1, None, 2.0)], m.schema))
    key = ["user_id", "product_id"]
    assert NB.neighbour_ratings_for_all(nn, missing).orderBy(*key).collect() == NB.neighbour_ratings(nn, missing).orderBy(*key).collect()
    assert NB.neighbour_ratings_for_all(nn.limit(0), m).collect() == [] == NB.neighbour_ratings_for_all(nn, m.limit(0)).collect()


def test_no_rows(inputs):
    nn, m = inputs
    assert NB.weighted_sum_recs_for_all(nn.limit(0), m, 5, True).collect() == []
    assert NB.weighted_sum_recs_for_all(nn, m.limit(0), 5, True).collect() == []
