"""Operator 12 against the tokenizers library itself."""

import hashlib
import random
from array import array

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tastegraph.llm import bpe as B
from tastegraph.llm import queries as Q
from tastegraph.llm.common import documents

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(Q.word_vocabulary())


@pytest.fixture(scope="module")
def bpe():
    return B.loaded(Q.word_vocabulary())


def packed(ids):
    return array("I", ids).tobytes()


def test_query_equals_the_library(spark, library):
    texts = {r.doc_id: r.text or "" for r in documents(spark, SF).collect()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in Q.op12_bpe_round_trip(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for d, t in texts.items():
        ids = library.encode(t, add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[d] == (len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


AWKWARD = ["", " ", "\n\n", "don't I'LL we've  x", "a\tb\x0bc\x1cd e f\u0085g", "<|endoftext|>", "x<|startoftext|>y <|endoftext|>",
           "<|ENDOFTEXT|>", "ΑΣ ΣΑΣ", "İstanbul ßtraße ǅ", "é ́x ạ́", "日本語テキスト ２３ ½", "''''s 'r'e 're", "12345 1a2b",
           "×÷ÀÞß", "퟿￿\U0001f600😂😂😂", "\x00\x01 \x7f\x80", "naïve café 'tis l'été", "a" * 300, "ab" * 400, "." * 700]


@pytest.mark.parametrize("text", AWKWARD)
def test_awkward_texts(bpe, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert bpe.encode(text) == packed(ids)
    assert bpe.decode(packed(ids)) == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'srtvlmde.,!0<|>"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(text):
    from tokenizers import Tokenizer
    library = test_any_text.__dict__.setdefault("library", None) or Tokenizer.from_file(Q.word_vocabulary())
    test_any_text.library = library
    ids = library.encode(text, add_special_tokens=False).ids
    assert B.loaded(Q.word_vocabulary()).encode(text) == packed(ids)


@pytest.mark.parametrize("letters", ["a", "ab", "aab", "abc", "the", "haha", "etaoinshrdlu", "!?.", "ðŁĺĤ"])
def test_joins_equal_the_encoding_of_the_whole(bpe, letters):
    rng = random.Random(letters)
    for _ in range(150):
        run = "".join(rng.choice(letters) for _ in range(rng.randint(2, 160)))
        k = rng.randint(1, len(run) - 1)
        got = bpe.join(run[:k], bpe.run(run[:k]), run[k:], bpe.run(run[k:]), window=rng.choice([1, 2, 5, 32]))
        assert got.tolist() == bpe.run(run).tolist(), (run, k)


def test_merges_give_each_token_once():
    import json
    merges = json.load(open(Q.word_vocabulary()))["model"]["merges"]  # what the pairwise argument of the module needs
    assert len({a + b for a, b in merges}) == len(merges)


def test_long_runs_by_the_tree(spark, library, monkeypatch):
    rng = random.Random(5)

    def run(n, letters="etaoinshrdluc"):
        return "".join(rng.choice(letters) for _ in range(n))

    texts = [run(50_000), "short words " + run(9_000) + " and, " + run(4_097) + "!" + run(20_000, "!?"), "x" * 30_000, run(4_096), run(1_025), None, "",
             "é" * 5_000 + "<|endoftext|>" + "日" * 3_000, ".a" * 6_000, "plain text here"]
    rows = [(i, t, "z") for i, t in enumerate(texts)] + [(0, texts[0], "again"), (None, texts[1], "z"), (None, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    got = sorted(((r.doc_id, bytes(r.ids), r.text) for r in B.decode(B.encode(docs, Q.word_vocabulary()), Q.word_vocabulary()).collect()), key=str)
    want = []
    for d, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, packed(ids), library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=str)


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id string, text string")
    assert B.decode(B.encode(empty, Q.word_vocabulary()), Q.word_vocabulary()).collect() == []
    none = spark.createDataFrame([("a", None)], "doc_id string, ids binary")
    assert [tuple(r) for r in B.decode(none, Q.word_vocabulary()).collect()] == [("a", None, "")]


def test_other_vocabulary_decodes_by_its_own_rule():
    from tokenizers import Tokenizer
    ids = np.array([464, 3797, 50256], np.uint32)
    assert B.Bpe(Q.vocabulary()).decode(ids.tobytes()) == Tokenizer.from_file(Q.vocabulary()).decode(ids.tolist(), skip_special_tokens=False)
