"""Predictions without a similarity table against the join and a plain loop."""

import platform
import random
import re
from pathlib import Path
from types import SimpleNamespace

import pytest

from tastegraph.operators import neighbours as NB
from tastegraph.operators import similarity as SIM
from tastegraph.operators import predict as predict_module
from tastegraph.operators import topk
from tastegraph.operators.predict import predict
from tastegraph.operators.topk import in_cells

PLAIN = {"cell": 10 ** 9}


@pytest.fixture(scope="module")
def m(spark):
    rng = random.Random(4)
    rows = {(u, rng.randrange(30)): float(rng.randint(1, 5)) for u in range(70) for _ in range(6)}
    rows |= {(u, 100 + p): float(rng.randint(1, 5)) for p in range(2) for u in range(70) if rng.random() < 0.9}  # hot products
    rows |= {(3, p): float(rng.randint(1, 5)) for p in range(30)}  # a user of very many ratings
    rows |= {(90, p): 4.0 for p in range(5)}  # equal ratings: no centred vector
    df = spark.createDataFrame([(u, p, r) for (u, p), r in rows.items()], "user_id long, product_id long, rating double")
    return df.repartition(4).cache()


def got(df):
    return {(r.user_id, r.product_id): (round(r.prediction, 8), r.n_neighbours) for r in df.collect()}


def brute(m, targets, k=None, least=0.0):
    sims, ratings = {}, {}
    for r in SIM.user_cosine(SIM.user_center_scale(m), hot_threshold=None).collect():
        sims[r.user_id1, r.user_id2] = sims[r.user_id2, r.user_id1] = r.sim
    for r in m.collect():
        ratings.setdefault(r.product_id, {})[r.user_id] = r.rating
    out = {}
    for u, p in targets:
        near = sorted(((-sims[u, v], v) for v in ratings.get(p, {}) if v != u and sims.get((u, v), -1) > least))[:k]
        if near:
            out[u, p] = (round(sum(-s * ratings[p][v] for s, v in near) / sum(-s for s, _ in near), 8), len(near))
    return out


CASES = [PLAIN, {"cell": 600}, {"cell": 600, "long": 12}, {"cell": 300}]


@pytest.mark.parametrize("options", CASES)
def test_every_rated_pair(spark, m, options):
    pairs = [(r.user_id, r.product_id) for r in m.collect()]
    sims = SIM.user_cosine(SIM.user_center_scale(m), hot_threshold=None)
    want = brute(m, pairs)
    assert got(predict(m, **options)) == want == got(NB.predict_rating(m, sims, m, hot_threshold=None))


@pytest.mark.parametrize("options", CASES)
@pytest.mark.parametrize("k", [None, 1, 3])
def test_any_targets_and_the_nearest_raters(spark, m, options, k):
    pairs = [(u, p) for u in [0, 3, 7, 41, 90, 12345] for p in [*range(0, 30, 3), 100, 101, 999]]
    df = spark.createDataFrame(pairs + pairs[:5] + [(None, 1), (1, None)], "user_id long, product_id long")
    assert got(predict(m, df, k=k, **options)) == brute(m, pairs, k)


@pytest.mark.parametrize("k", [None, 2])
@pytest.mark.parametrize("hot", [False, True])
def test_blocks_in_turns_give_the_same_predictions(spark, m, monkeypatch, k, hot):
    for name in ("ROUND", "ROUND_SHARE"):
        monkeypatch.setattr(topk, name, 1)
    few = m if hot else m.filter("product_id < 100")
    pairs = [(r.user_id, r.product_id) for r in few.collect()]
    some = [(u, p) for u in (0, 3, 7, 41) for p in (1, 5, 100, 999)]
    written = []
    monkeypatch.setattr(predict_module, "materialize", lambda df, name, original=predict_module.materialize: written.append(name) or original(df, name))
    assert got(predict(few, k=k, cell=200)) == brute(few, pairs, k)
    assert written.count("sums-of-turn") > 1
    assert got(predict(few, spark.createDataFrame(some, "user_id long, product_id long"), k=k, cell=200)) == brute(few, some, k)


def test_least_similarity_and_no_rows(spark, m):
    pairs = [(r.user_id, r.product_id) for r in m.collect()]
    assert got(predict(m, min_similarity=0.2, cell=600)) == brute(m, pairs, None, 0.2)
    assert predict(m.limit(0)).collect() == [] and predict(m, m.limit(0)).collect() == []


def test_similarities_are_never_exchanged(spark, m):
    """No join on a pair of users, and nothing but targets and sums leaves the blocks."""
    plan = predict(m)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
    assert plan.count("FlatMapGroupsInArrow") == 1


@pytest.mark.skipif(platform.libc_ver()[0] != "glibc", reason="malloc_trim is glibc's")
def test_a_worker_returns_what_a_cell_has_freed():
    pins = []

    def made(group):
        held = []
        for _ in range(50_000):
            held.append(bytes(2000))
        pins.append(bytes(2000))  # stays above the others: the heap's end cannot go down
        return group

    def anonymous_mb():
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024

    rows = SimpleNamespace(repartition=lambda *a: rows, groupBy=lambda *a: rows, applyInArrow=lambda run, schema: run)
    run, before = in_cells(rows, made, "x long", 1), anonymous_mb()
    assert made(1) == 1 and anonymous_mb() - before > 80
    assert run(2) == 2 and anonymous_mb() - before < 20
