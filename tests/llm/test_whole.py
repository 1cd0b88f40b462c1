"""Work that earlier versions did in part only."""

import random
import textwrap
from array import array

import pytest
from pyspark.sql import functions as F

from tastegraph.llm import langid, licenses, mixing, neardup
from tastegraph.llm.common import documents
from tastegraph.llm.packing import pack
from tastegraph.llm.queries import vocabulary
from tastegraph.llm.tokenfile import token_files

SF = "/root/testdata/sf0.01"

FOREIGN = {
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava "
          "toisiaan kohtaan veljeyden hengessä.",
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować "
          "wobec innych w duchu braterstwa.",
    "tr": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti "
          "ile hareket etmelidirler.",
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "zh": "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。",
    "markup": '<div class="row"><a href="#x" id="q1"><img src="/i/p.png"></a><td><tr><ul><li></li></ul>' * 20,
    "base64": "aGVsbG8gd29ybGQgdGhpcyBpcyBiYXNlNjQgZGF0YSBmb3IgdGVzdGluZw0KcXdlcnR5dWlvcA" * 5,
    "gibberish": " ".join("".join(random.Random(k).choices("abcdefghijklmnopqrstuvwxyz", k=2 + k % 8)) for k in range(200)),
}


def test_texts_of_no_learned_language_go(spark):
    docs = documents(spark, SF).select("doc_id", "text", "lang")
    planted = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(FOREIGN.values())], docs.schema)
    rows = [r.doc_id for r in langid.in_known_language(docs.unionAll(planted)).select("doc_id").collect()]
    assert not [lang for i, lang in enumerate(FOREIGN) if -1 - i in rows]
    clean = docs.filter(langid.held_out() & F.col("text").rlike(r"\p{L}")).count()
    assert len(set(rows) & {r.doc_id for r in docs.filter(langid.held_out()).collect()}) >= 0.99 * clean


def test_one_language_is_not_every_language(spark):
    docs = documents(spark, SF).select("doc_id", "text", "lang").filter("lang = 'en'")
    planted = spark.createDataFrame([(-1, FOREIGN["ru"], None), (-2, FOREIGN["gibberish"], None)], docs.schema)
    rows = [r.doc_id for r in langid.in_known_language(docs.unionAll(planted)).collect()]
    assert min(rows) >= 0 and len(rows) >= 0.99 * docs.filter(F.col("text").rlike(r"\p{L}")).count()


ADDED = ["end of text <|endoftext|> next", "<|endoftext|>", "a<|endoftext|>b\n<|endoftext|> ", "  two  spaces <|endoftext|>\n\nand lines", "<|endoftext", "none here"]


def test_added_tokens_in_texts_are_the_librarys(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(vocabulary())  # nothing switched
    want = [tok.encode(t, add_special_tokens=False).ids + [2] for t in ADDED]
    assert want[0][:-1] == [437, 286, 2420, 220, 50256, 1306]
    docs = spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string")
    packed = {r.doc_id: array("I", bytes(r.ids)).tolist() for r in pack(docs, vocabulary(), end_id=2, capacity=1024).collect()}
    assert packed == dict(enumerate(want))
    files = {r.doc_id: (r.start, r.n_tokens) for r in token_files(docs, vocabulary(), end_id=2).collect()}
    assert files == {i: (sum(map(len, want[:i])), len(want[i])) for i in range(len(ADDED))}


def test_licences_over_lines_and_within_lines(spark):
    bodies = [(name, textwrap.fill(text, 78)) for name, text in licenses.BODIES]
    within = [("reserved", "Copyright 2020 Foo Inc. All rights reserved."), ("Apache-2.0", "Code is licensed under the Apache License, Version 2.0, see the file."),
              ("MIT", "Some prose before it. Released under the MIT License. Some prose after it."), (None, "Some prose, all of its rights, a licence and the MIT.")]
    cases = [*bodies, *within, *((name, "Some prose before it.\n" * 50 + text + "\nSome prose after it." * 50) for name, text in bodies)]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert [found[i].license for i in range(len(cases))] == [name for name, _ in cases]
    assert all((r.dice, r.n_notices) == (0.0, 0) if r.license is None else r.dice == 1.0 and r.n_notices >= 1 for r in found.values())


def test_windows_equal_brute_force(spark):
    rng = random.Random(5)
    notices, texts = [("A", "one two three four five six"), ("B", "two three nine ten")], []
    for _ in range(300):
        texts.append(" ".join(rng.choice(["one two three four five six", "two three nine ten", "one", "two", "three", "four", "nine", "x", "y z", "\n"])
                              for _ in range(rng.randint(1, 7))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.license, r.dice) for r in licenses.scan(docs, notices, 0.8, ()).collect()}
    for i, text in enumerate(texts):
        best = (0.0, "")
        units = [text.split(), *map(str.split, text.split("\n"))]
        for name, t in notices:
            grams = set(licenses.bigrams_of(t))
            most = licenses.size_bounds(len(grams), 0.8)[1]
            whole = units[0]
            spans = [whole[a:b] for a in range(len(whole)) for b in range(a + 2, len(whole) + 1) if b - a - 1 <= most + 1e-9]
            for u in [*units, *spans]:
                g = {f"{x} {y}" for x, y in zip(u, u[1:])}
                best = min(best, (-2 * len(g & grams) / (len(g) + len(grams)), name)) if g else best
        assert got[i] == ((best[1], pytest.approx(-best[0])) if best[0] <= -0.8 + 1e-12 else (None, 0.0)), text


def test_rows_without_a_key_are_in_no_window(spark):
    docs = spark.createDataFrame([(i, "" if i % 3 else "w " * (i % 5), "s") for i in range(300)], "doc_id long, text string, source string")
    made = mixing.mix(docs, mixing.n_words(F.col("text")), mixing.length_quality(F.col("size")))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "isnull(key" in plan and "isnotnull(key" in plan
    rows = made.collect()
    assert len(rows) == 300 and all(r.copies == 0 for r in rows if r.size == 0)
    # a document of quality 0 is in no draw, but in every epoch
    rows = mixing.mix(docs, mixing.n_words(F.col("text")), F.lit(0.0), most=3).collect()
    assert len(rows) == 300 and {r.copies for r in rows if r.size} == {int(r.target // r.source_size) for r in rows}


@pytest.mark.parametrize("quality", [(0.02, 0.9), (1e-6, 0.5), (0.5, 0.5)])
def test_buckets_of_keys_are_small_whatever_the_qualities(spark, quality):
    n = 40_000
    keys = spark.range(n).select((-F.log((F.pmod(F.xxhash64("id"), F.lit(1 << 40)) + 0.5) / float(1 << 40)) / F.when(F.col("id") % 2 == 0, quality[0]).otherwise(quality[1])).alias("key"),
                                 F.lit(n).alias("n"))
    rows = keys.groupBy(mixing.bucket("key", "n").alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).orderBy("b").collect()
    assert max(r.n for r in rows) <= 1.25 * n ** 0.5 and len(rows) <= 15 * n ** 0.5
    assert all(a.hi < b.lo for a, b in zip(rows, rows[1:]))


def test_texts_of_a_shared_doc_id_meet_their_own_class_only(spark, monkeypatch):
    met, confirm = spark.sparkContext.accumulator(0), neardup._confirm

    def counting(words, percent):
        inner = confirm(words, percent)

        def run(batches):
            def seen():
                for b in batches:
                    met.add(len(b))
                    yield b
            yield from inner(seen())
        return run

    monkeypatch.setattr(neardup, "_confirm", counting)
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(None, " ".join([*words, f"x{i}"])) for i in range(100)], "doc_id long, text string")
    rows = neardup.near_duplicates(docs).collect()
    assert len(rows) == 100 and sum(r.representative for r in rows) == 1
    assert 0 < met.value <= 200
