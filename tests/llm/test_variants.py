"""Operator 11 against brute force over all pairs of words."""

import collections
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tastegraph.llm import queries as Q
from tastegraph.llm import variants as V
from tastegraph.llm.common import documents

SF = "/root/testdata/sf0.001"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k:] == b[k + 1:] or (len(a) == len(b) and a[k + 1:] == b[k + 1:])


def brute(counts, times=10):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= times * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n, len(near[w]), form[w], form[w] and counts[form[w]], root)
    return out


def found(df):
    rows = [(r.word, (r.n, r.n_near, r.form, r.form_n, r.root)) for r in df.collect()]
    assert len({w for w, _ in rows}) == len(rows)
    return dict(rows)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text(alphabet="abé", min_size=1, max_size=6), min_size=1, max_size=60))
def test_composed_machine_accepts_the_near_pairs(words):
    words = sorted(words)
    one, two = V.compose(words)
    got = [tuple(sorted((int(a), int(b)))) for a, b in zip(one, two)]
    assert len(set(got)) == len(got)
    assert set(got) == {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if one_edit(words[i], words[j])}


def test_query_equals_brute_force(spark):
    counts = collections.Counter()
    for r in documents(spark, SF).collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    assert found(Q.op11_spelling_variants(spark, SF)) == brute(counts)


@pytest.mark.parametrize("range_words", [3, 7, 40, 10_000])
def test_any_ranges_give_the_same(spark, range_words):
    counts = {}
    for i in range(400):
        x = (i * 7919 + 13) % 1000
        counts["".join("abcé"[(x >> (2 * k)) & 3] for k in range(4 + i % 3))] = 1 + (i * i) % 977
    counts |= {"a" * k: 10 ** (k % 5) for k in range(1, 12)} | {"x" * 3000: 5, "x" * 2999: 60, "x" * 2999 + "y": 900}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert found(V.variants(df, 10, range_words)) == brute(counts)


def test_a_hot_prefix(spark):
    counts = {f"prefix{a}{b}{c}": 2 + ord(a) for a in "abcdefghij" for b in "abcdefghij" for c in "klmnop"}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(V.variants(df, 10, 50)) == brute(counts)


def test_nulls_empty_texts_and_clashes(spark):
    rows = [(1, None, "x"), (None, "Straßen Straßen straßen STRAßEN", "y"), (2, "", None), (2, "", None), (3, "ab,cd; Straßer Straßer!", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    got = found(V.variants(V.words(docs)))
    assert got == {"straßen": (4, 1, None, None, "straßen"), "straßer": (2, 1, None, None, "straßer")}
    assert found(V.variants(V.words(docs.limit(0)))) == {}
    assert found(V.variants(spark.createDataFrame([(None, 3), ("only", 2)], "word string, n int"))) == {"only": (2, 0, None, None, "only")}


def test_pairs_come_once(spark):
    df = spark.createDataFrame([("aaa", 5), ("aa", 4), ("aaaa", 1), ("aba", 2)], "word string, n long")
    got = [tuple(sorted((r.word, r.near))) for r in V.near_pairs(df, 2).collect()]
    assert sorted(got) == [("aa", "aaa"), ("aa", "aba"), ("aaa", "aaaa"), ("aaa", "aba")]
