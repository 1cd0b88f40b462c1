"""Append-only dictionaries."""

import os

import pytest

from tastegraph.operators import encode as L
from tastegraph.session import scratch_path


def _values(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string").repartition(5)


def _codes(df):
    return {r.name: (r.code, r.version) for r in df.collect()}


def test_old_codes_stay_and_all_are_dense(spark):
    folder = scratch_path(spark, "dict")
    one = _codes(L.append_to_dictionary(_values(spark, ["pear", "fig", "fig", None, "Äpfel"]), "name", folder))
    assert one == {"fig": (0, 1), "pear": (1, 1), "Äpfel": (2, 1)}
    two = _codes(L.append_to_dictionary(_values(spark, ["apple", "fig", "zest", None, "apple"]), "name", folder))
    assert two == {**one, "apple": (3, 2), "zest": (4, 2)}
    assert _codes(L.append_to_dictionary(_values(spark, ["fig", None]), "name", folder)) == two  # an empty version
    last = _codes(L.append_to_dictionary(_values(spark, ["b"]), "name", folder))
    assert last == {**two, "b": (5, 4)}
    assert _codes(L.stored_dictionary(spark, folder, 1)) == one and _codes(L.stored_dictionary(spark, folder, 3)) == two
    coded = L.encode_column(_values(spark, ["zest", "new"]), "name", L.stored_dictionary(spark, folder)).collect()
    assert {r.name for r in coded} == {4, None}


def test_many_values_over_many_partitions(spark):
    folder = scratch_path(spark, "dict")
    ids = spark.range(0, 5000, 1, 7).withColumnRenamed("id", "name")
    first = {r.name: r.code for r in L.append_to_dictionary(ids.filter("name % 3 = 0"), "name", folder).collect()}
    both = {r.name: r.code for r in L.append_to_dictionary(ids, "name", folder).collect()}
    assert sorted(both.values()) == list(range(5000)) and all(both[n] == c for n, c in first.items())
    new = [both[n] for n in range(5000) if n % 3]
    assert new == sorted(new)


def test_first_version_empty_a_single_code_and_unfinished_versions(spark):
    folder = scratch_path(spark, "dict")
    with pytest.raises(ValueError):
        L.stored_dictionary(spark, folder)
    assert L.append_to_dictionary(_values(spark, [None]), "name", folder).count() == 0
    assert _codes(L.append_to_dictionary(_values(spark, ["x"]), "name", folder)) == {"x": (0, 2)}
    # a lost job left files of version 3 without its mark
    _values(spark, ["lost"]).selectExpr("name", "cast(1 as long) code").write.parquet(f"{folder}/version=3")
    os.remove(f"{folder.removeprefix('file:')}/version=3/_SUCCESS")
    assert L.dictionary_versions(spark, folder) == [1, 2]
    assert _codes(L.append_to_dictionary(_values(spark, ["y"]), "name", folder)) == {"x": (0, 2), "y": (1, 3)}
    with pytest.raises(ValueError):
        L.append_to_dictionary(spark.range(3).withColumnRenamed("id", "name"), "name", folder)
    with pytest.raises(ValueError):
        L.stored_dictionary(spark, folder, 9)
