"""Plan-shape checks: pushdown, pruning, partial top-k, no union, bounded broadcasts."""

import re

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark):
    p = plan(entry.queries()["filter_user_id_cap"](spark, SF))
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(o_custkey,1000\)", p), p
    li = [l for l in p.split("\n") if "FileScan parquet" in l and "l_orderkey" in l][0]
    assert "l_extendedprice" not in li and "l_comment" not in li


def test_topk_is_limited_before_the_shuffle(spark):
    p = plan(entry.queries()["nearest_neighbours"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p
    assert len(re.findall(r"WindowGroupLimit .*Partial", p)) == 1  # top-100; no rater cap


def test_mirroring_does_not_union(spark):
    p = plan(entry.queries()["nearest_neighbours"](spark, SF))
    assert "Union" not in p and "Generate explode" in p


def test_served_user_restricts_the_pair_join(spark):
    from tastegraph.operators import neighbours as NB
    from tastegraph.plans.catalog import Mm
    p = plan(NB.nearest_neighbours(Mm(spark, SF), only_users=[1]))
    # the served id reaches the scan of the ratings table as a pushed predicate
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(user_id,1\)", p) or \
        re.search(r"PushedFilters: \[[^\]]*In\(user_id, \[1\]", p), p
    users = spark.createDataFrame([(1,)], "user_id long")
    p2 = plan(NB.nearest_neighbours(Mm(spark, SF), only_users=users))
    assert "LeftSemi" in p2


def test_only_hot_groups_are_split(spark):
    from tastegraph.operators import similarity as SIM
    from tastegraph.plans.catalog import Mm
    m = Mm(spark, SF)
    p = plan(SIM.co_rater_pairs(m, hot_threshold=10))
    assert "sequence" in p and "xxhash64" in p
    p = plan(SIM.co_rater_pairs(m))
    assert "sequence" not in p and "REPARTITION_BY_NUM" not in p


def test_served_ids_reach_the_scan_of_centred_pairs(spark):
    from tastegraph.operators import similarity as SIM
    from tastegraph.plans.catalog import Mm
    from tastegraph.session import materialize
    z = materialize(SIM.user_center_scale(Mm(spark, SF)), "z")
    p = plan(SIM.cosine_for(z, "user_id", "product_id", [1]))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(user_id,1\)|PushedFilters: \[[^\]]*In\(user_id, \[1\]", p), p


def test_only_bounded_explicit_broadcasts(spark):
    # the queries' logical plans carry no broadcast hint except the id
    # dictionary's per-partition offsets (bounded by the partition count)
    for name in ["weighted_sum_recs_unseen", "predict_rating", "title_lookup", "recs_for_user", "item_cosine"]:
        lp = entry.queries()[name](spark, SF)._jdf.queryExecution().logical().toString()
        assert "broadcast" not in lp.lower(), name


def test_short_list_titles_do_not_shuffle_the_catalogue(spark):
    df = entry.queries()["recs_for_user"](spark, SF)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    part_scans = [l for l in final.split("\n") if "FileScan parquet" in l and "p_name" in l]
    assert part_scans
    # the catalogue side meets the served user's product ids in a broadcast semi-join
    assert re.search(r"BroadcastHashJoin \[[^\]]*\], \[[^\]]*\], LeftSemi", final), final
