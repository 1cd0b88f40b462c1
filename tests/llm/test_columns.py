"""No pipeline stage touches a column of its input that it does not own."""

import random

import pytest
from pyspark.sql import functions as F

from tastegraph.llm import langid, mixing, neardup, suffix
from tastegraph.llm.common import documents

SF = "/root/testdata/sf0.001"
NAMES = ["kept", "spans", "_cut", "_mix_id", "_mix_digest", "_mix_copies", "digest", "copies", "size", "quality", "bucket", "fits", "key", "row",
         "set_key", "component_id", "n_shingles", "representative", "score", "lang_pred", "held_out", "vector", "family", "runs", "first", "core",
         "before", "epochs", "rest", "n", "part", "id", "_id", "_digest"]


@pytest.fixture(scope="module")
def docs(spark):
    extra = [F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n) for n in NAMES]
    return documents(spark, SF).select("*", *extra).cache()


STAGES = {
    "language ID": langid.in_known_language,
    "near-dedup": lambda d: neardup.one_of_each(d, words=5, percent=80),
    "suffix dedup": lambda d: suffix.without_repeats(d, 200),
    "mix": lambda d: mixing.mixed_documents(d, mixing.n_words(F.col("text")), mixing.length_quality(F.col("size"))),
}


@pytest.mark.parametrize("name", sorted(STAGES))
def test_other_columns_stay(docs, name):
    got = STAGES[name](docs)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    rows = got.collect()
    assert len(rows) > 100
    assert all(r[n] == f"{n}:{r.doc_id}" for r in rows for n in NAMES)


def test_replacement_characters_stay_and_cut_ones_go(spark):
    rng = random.Random(1)
    passage = "é" + "".join(rng.choice("abcdefgh ") for _ in range(150)) + "é"
    texts = ["x�y " + passage + " z�", "�" + passage, "q" * 30 + passage[1:] + "€�", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in suffix.without_repeats(docs, 100).collect()}
    assert got[0] == "x�y  z�" and got[1] == "�" and got[2] == "q" * 30 + "€�" and got[3] is None and got[4] == ""


def test_parts_of_a_character_at_a_cut_go(spark):
    # é and ê share their first byte, so a repeat that ends within them leaves the second one alone
    body = "".join(random.Random(2).choice("abcdefgh ") for _ in range(150))
    docs = spark.createDataFrame([(0, "A" + body + "é!"), (1, "B" + body + "ê?")], "doc_id long, text string")
    raw = {r.doc_id: bytes(r.kept) for r in suffix.remove_repeats(docs, 100).collect()}
    assert raw == {0: b"A\xa9!", 1: b"B\xaa?"}
    assert {r.doc_id: r.text for r in suffix.without_repeats(docs, 100).collect()} == {0: "A!", 1: "B?"}


def test_an_op5_text_is_what_remains(spark):
    from tastegraph.llm.queries import op5_suffix_dedup
    for r in op5_suffix_dedup(spark, SF).collect():
        assert r.n_removed or len((r.text or "").encode()) == r.n_bytes
