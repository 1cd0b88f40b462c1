"""What a worker process keeps of the memory of a task that has ended, and what the driver takes to fit a model."""

import gc
import platform
import re
import tracemalloc
import weakref
from pathlib import Path

import pytest

import corpus_pipeline
from tastegraph.llm import langid
from tastegraph.llm.common import documents, lean
from tastegraph.llm.packing import pieces
from tastegraph.llm.queries import vocabulary
from tastegraph.llm.tokens import Encoder


def anonymous_mb() -> float:
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


@pytest.mark.skipif(platform.libc_ver()[0] != "glibc", reason="malloc_trim is glibc's")
def test_a_task_gives_its_freed_memory_back():
    pins = []

    def run(batches):
        held = []
        for b in batches:
            held += [bytes(2000) for _ in range(50_000)]
            pins.append(bytes(2000))  # stays above the others: the heap's end cannot go down
            yield b

    before = anonymous_mb()
    assert list(run(iter([1]))) == [1]
    kept = anonymous_mb() - before
    assert list(lean(run)(iter([2]))) == [2]
    assert kept > 80 and anonymous_mb() - before < 20


def test_packing_ends_its_tasks_that_way(spark, monkeypatch):
    """The encoder is gone when the memory goes back."""
    import tastegraph.llm.packing as P
    wrapped = []
    monkeypatch.setattr(P, "lean", lambda run: wrapped.append(run.__name__) or lean(run))
    docs = documents(spark, "/root/testdata/sf0.001")
    assert pieces(docs, vocabulary(), 2, 1024, False, False).count() >= docs.count() and wrapped == ["run"]


def test_an_encoder_goes_with_its_last_reference():
    gc.disable()
    try:
        encoder = Encoder(vocabulary(), 2)
        encoder.encode("Some words, some marks!!")
        gone = weakref.ref(encoder)
        del encoder
        assert gone() is None
    finally:
        gc.enable()


@pytest.mark.parametrize("stage", [f for name, f in corpus_pipeline.STAGES if name != "mixing sources"], ids=lambda f: f.__name__)
def test_a_stage_sends_few_texts_at_once_to_python(spark, stage):
    setting, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")

    def rows(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.record_batch([pa.array([b.num_rows])], names=["n"])

    try:
        stage(spark, documents(spark, "/root/testdata/sf0.001"), "/root/testdata/sf0.001")
        sent = [r["n"] for r in spark.range(0, 2500, 1, 1).mapInArrow(rows, "n long").collect()]
        assert sum(sent) == 2500 and max(sent) <= 1000
        spark.conf.set(setting, 100)
        stage(spark, documents(spark, "/root/testdata/sf0.001"), "/root/testdata/sf0.001")
        assert spark.conf.get(setting) == "100"  # a smaller one stays
    finally:
        spark.conf.set(setting, before)


def test_the_driver_fits_the_languages_on_one_copy_of_the_vectors(spark, monkeypatch):
    fit, rows = langid.Model.fit, []

    def counted(*args):
        rows.append(sum(len(a) for a in args if a.ndim == 2))
        return fit(*args)

    monkeypatch.setattr(langid.Model, "fit", counted)
    docs = documents(spark, "/root/testdata/sf0.01")
    tracemalloc.start()
    try:
        model = langid.train(docs, ~langid.held_out())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # the rows as they came, and the array made of them; twice as wide and copied three times before
    assert model.first and rows[0] > 400 and peak < 3 * rows[0] * langid.DIMENSIONS * 4
