"""The memoised encoder against the library, word by word."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tastegraph.llm import tokens as K
from tastegraph.llm.packing import pack
from tastegraph.llm.queries import vocabulary


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def same(encoder, library, text):
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == [*library.encode(text, add_special_tokens=False).ids, 2], repr(text)


def test_runs_of_marks_do_not_take_the_whole_pipeline(library):
    """Words of letters and any marks behind them cost the pipeline once a run of marks, not once a word."""
    encoder, runs = K.Encoder(vocabulary(), 2), []
    whole = encoder.whole
    encoder.whole = lambda part: runs.append(part) or whole(part)
    text = " ".join(f"{w}{m}" for w in ("heat", "Überall", "mañana", "the") for m in ("***", ".%%%", "'''", "$", "&&."))
    same(encoder, library, text)
    assert sorted(runs) == sorted({"***", ".%%%", "'''", "$", "&&."})


def test_words_with_marks_anywhere_are_the_librarys(library):
    random.seed(5)
    encoder = K.Encoder(vocabulary(), 2, memo_entries=60)
    encoder.MARK_RUNS = 7
    for _ in range(3000):
        words = ["".join(random.choice(["a", "s", "re", "É", "ß", "ll", "語", "7", "'", "'", "*", "%", ".", "-", "…", "_", "́", "ª", "²"])
                         for _ in range(random.randint(0, 6))) for _ in range(random.randint(1, 6))]
        same(encoder, library, random.choice([" ", " ", "\n"]).join(words))


def test_a_shared_encoder_gives_the_same_pieces(spark):
    docs = spark.createDataFrame([(i, f"some words {i} here***") for i in range(40)], "doc_id long, text string").repartition(4)
    rows = [sorted(map(tuple, pack(docs, vocabulary(), keep_encoder=k).select("doc_id", "piece", "start", "length", "ids_crc32").collect())) for k in (False, True)]
    assert rows[0] == rows[1] and len(rows[0]) == 40
