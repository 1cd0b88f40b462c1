"""Nulls in any column, empty and very long texts, ties, repeated rows, empty
tables and extra columns with clashing names, for every operator."""

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tastegraph.llm import langid, licenses, mixing, neardup, packing, quality, spotsigs, suffix, tokenfile, urls  # noqa: E402
from tastegraph.llm.graph import components  # noqa: E402
from tastegraph.llm.queries import vocabulary  # noqa: E402

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, digest long, kept string, spans int, row int, score string, "
          "copies int, size string, _id int, part int, rank int")
rng = random.Random(3)
PROSE = " ".join(rng.choice("the of and river mountain stone water garden window paper is in to".split()) for _ in range(300))
LONG = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(60_000))


def row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, len(text or ""), *[None] * 10)


MESSY = [row(1, PROSE), row(1, PROSE), row(2, PROSE), row(3, PROSE + " end"), row(4, ""), row(5, None), row(6, " \n\t "), row(None, PROSE), row(None, None),
         row(7, "el perro y la casa de los gatos", "es"), row(8, "x", None), row(9, "###", None, None), row(10, LONG, "en", None),
         row(11, "Released under the MIT License.\nReleased under the MIT License."), row(12, "\U0001F600é" * 300), row(13, "a  b\r\nc \x1c d")]


@pytest.fixture(scope="module")
def messy(spark):
    return spark.createDataFrame(MESSY, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


OPERATORS = {
    "pack": lambda d: packing.pack(d, vocabulary()),
    "spotsigs": spotsigs.edited_likeness,
    "langid": langid.identify,
    "licenses": licenses.scan,
    "suffix": lambda d: suffix.remove_repeats(d, 100),
    "suffix texts": lambda d: suffix.without_repeats(d, 100),
    "token files": lambda d: tokenfile.token_files(d, vocabulary()),
    "mix": lambda d: mixing.mix(d, mixing.n_words(F.col("text")), mixing.length_quality(F.col("size"))),
    "mixed documents": lambda d: mixing.mixed_documents(d, mixing.n_words(F.col("text")), mixing.length_quality(F.col("size"))),
    "quality": quality.judge,
    "neardup": neardup.near_duplicates,
    "one of each": neardup.one_of_each,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_tables_give_no_rows(empty, name):
    assert OPERATORS[name](empty).count() == 0


@pytest.mark.parametrize("name", ["langid", "licenses", "suffix", "token files", "mix", "quality", "neardup", "spotsigs"])
def test_every_row_is_answered(messy, name):
    rows = OPERATORS[name](messy).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(m[0]) for m in MESSY)


def test_packing_of_messy_rows(messy):
    rows = OPERATORS["pack"](messy).collect()
    assert sum(r.piece == 0 for r in rows) == len(MESSY)
    assert sorted(r.length for r in rows if r.doc_id in (4, 5)) == [1, 1]  # the end id alone
    assert len([r for r in rows if r.doc_id == 10]) > 100


def test_equal_texts_are_equal(messy):
    by_id = {}
    for r in spotsigs.edited_likeness(messy).collect():
        by_id.setdefault(r.doc_id, []).append(r)
    assert len({r.fingerprint for d in (1, 2) for r in by_id[d]}) == 1
    assert by_id[4][0].fingerprint == "" and by_id[4][0].near_edited == 1.0  # an empty text stays empty
    assert langid.identify(messy).filter("doc_id = 9 OR doc_id = 5").select("lang_pred", "score").distinct().collect() == [("und", 0.0)]


def test_groups_of_copies(messy):
    rows = neardup.near_duplicates(messy).collect()
    copies = [r for r in rows if r.doc_id in (1, 2, 3) or (r.doc_id is None and r.n_shingles)]
    assert {r.component_id for r in copies} == {None} and sum(r.representative for r in copies) == 1  # a null doc_id is least
    assert all(r.representative for r in rows if not r.n_shingles)
    assert neardup.one_of_each(messy).count() == len(MESSY) - 4


def test_repeats_of_messy_rows(messy):
    rows = suffix.remove_repeats(messy, 100).collect()
    assert all(not r.kept and [tuple(s) for s in r.spans] == [(0, len(PROSE))] for r in rows if r.doc_id in (1, 2))
    three = [r for r in rows if r.doc_id == 3][0]
    assert bytes(three.kept) == b" end"
    assert [r for r in rows if r.doc_id == 10][0].spans == []
    assert [tuple(s) for s in [r for r in rows if r.doc_id == 12][0].spans] == [(0, 1800)]  # repeats itself, overlapping


def test_licenses_of_lines(messy):
    found = {r.doc_id: r for r in licenses.scan(messy).collect()}
    assert (found[11].license, found[11].dice, found[11].n_notices) == ("MIT", 1.0, 2)
    assert found[4].license is None and found[10].n_notices == 0


def test_mix_takes_near_its_targets(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), "abc"[i % 3] if i % 11 else None) for i in range(3000)], "doc_id long, text string, source string")
    rows = mixing.mix(docs, mixing.n_words(F.col("text")), mixing.length_quality(F.col("size"))).collect()
    taken = {}
    for r in rows:
        t = taken.setdefault(r.source, [0, r.target])
        t[0] += r.size * r.copies
        assert r.copies <= 3
    assert len(taken) == 4 and all(abs(a - b) <= 7 for a, b in taken.values())
    assert sum(b for _, b in taken.values()) == pytest.approx(sum(r.size for r in rows))


def test_targets_stop_at_three_times_the_size(spark):
    s = spark.createDataFrame([(False, "a", 10, 1), (False, "b", 1000, 1), (False, "c", 30, 1), (True, "", 0, 1)],
                              "no_source boolean, source_key string, source_size long, n long")
    got = {r.source_key: r.target for r in mixing.targets(s).collect()}
    assert got == {"a": 30.0, "b": 920.0, "c": 90.0, "": 0.0}


def test_urls_of_messy_rows(spark):
    pages = spark.createDataFrame([(1, "HTTP://Ex.COM/a?b", None, 1), (None, None, "<p>x", 2), (2, "no scheme", "", 3), (3, "x://", "y", 4), (3, "x://", "y", 4),
                                   (4, "https://best-casino-bonus.org/x", "<b>casino bonus best</b>", 5)], "page_id long, url string, html string, row int")
    rows = urls.judge(pages, [("block", "com", "/")]).collect()
    assert len(rows) == 6
    got = {r.page_id: r for r in rows}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("ex.com", "/a", "com/", "block")
    assert (got[2].host, got[2].path, got[2].verdict) == ("", "", "allow")
    assert got[4].verdict == "allow" and got[4].score == 0.0 and "casino" in got[4].words  # no rule taught it a word of that host
    assert urls.judge(pages.limit(0), [("block", "com", "/")]).count() == 0


def test_viterbi_prefers_known_words():
    assert urls.viterbi("cheapflights", {"cheap": 50, "flights": 20, "light": 9}, 1000) == ["cheap", "flights"]
    assert urls.viterbi("", {}, 1) == [] and urls.viterbi("qzx", {}, 1000) == ["qzx"]


def test_hot_loose_components_are_blocked(spark):
    """A group of near copies larger than a block, and one of exact copies."""
    words = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(90):
        w = list(words)
        for k in range(i % 5):
            w[(i * 7 + k * 13) % 100] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(f"z{j}" for j in range(60))) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    small, whole = (neardup.near_duplicates(docs, words=3, block=b).select("doc_id", "component_id") for b in (8, 512))
    sets = {d: {tuple(t.split()[i:i + 3]) for i in range(len(t.split()) - 2)} for d, t in rows}
    root = {d: d for d in sets}
    for _ in range(3):
        for a in sets:
            for b in sets:
                c = len(sets[a] & sets[b])
                if 100 * c >= 80 * (len(sets[a]) + len(sets[b]) - c):
                    root[a] = root[b] = min(root[a], root[b])
    assert dict(map(tuple, small.collect())) == dict(map(tuple, whole.collect())) == root


@pytest.mark.parametrize("block", [0, 500_000])
def test_components(spark, block):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)] + [(200 + i, 200) for i in range(1, 30)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long").repartition(4), block).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102), 100), **dict.fromkeys(range(200, 230), 200)}


def test_signatures_estimate_similarity():
    """SuperMinHash agrees in about the Jaccard similarity of its places, whatever the set sizes."""
    import numpy as np
    r = np.random.default_rng(1)
    for n in (5, 40, 3000):
        a = np.unique(r.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[:int(0.8 * len(a))], r.integers(0, 2**63, n - int(0.8 * n), dtype=np.uint64)]))
        s = neardup.super_minhash([a, b], 512)
        j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((s[0] == s[1]).mean() - j) < 0.1
        assert (s < np.uint64(2**63)).all()
    assert (neardup.super_minhash([a, a[:0]], 16)[1] == np.uint64(2**64 - 1)).all()


def test_arrow_files_give_random_access(spark, tmp_path):
    import pyarrow as pa
    docs = spark.createDataFrame([(i, "word " * i) for i in range(50)], "doc_id long, text string")
    shards = tokenfile.write_token_files(docs, f"file://{tmp_path}/t", vocabulary(), sequence=16, rows=4).collect()
    path = [s for s in shards if s.tokens > 200][0].path.removeprefix("file://")
    batches = list(pa.ipc.open_stream(pa.memory_map(path)))
    assert all(b.num_rows == 4 for b in batches[:-1]) and batches[0].schema.field("input_ids").type == pa.list_(pa.uint16(), 16)
    ids = [t for b in batches for x, m in zip(b["input_ids"].to_pylist(), b["mask"].to_pylist()) for t, k in zip(x, m) if k]
    assert batches[1]["input_ids"][2].as_py() == ids[16 * 6:16 * 7]
