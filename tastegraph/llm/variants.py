"""Operator 11: spelling variants by finite-state composition.

Two words are near if one inserted, deleted or replaced character turns one
into the other: the pairs that *acceptor ∘ one-edit transducer ∘ acceptor*
accepts, where the acceptor is the minimal one of the vocabulary.

The sorted vocabulary is dealt into ranges of bounded size; the states that a
range's prefixes lead to from the initial state are its own, so each range
builds and composes its own machines.  In a range (:func:`compose`) a node of
the trie is a prefix, and a state of the minimal acceptor is the set of nodes
with one right language, told by a hash of its set of suffixes.  The composed
machine walks both acceptors through equal states up to the edit; after it,
both must read one and the same rest.  So the pairs of suffixes that part at
a state are enumerated once per *state* and carried over to each prefix that
leads there.

Words of different ranges part at a prefix that is also one of a word at a
range's border.  Words send the composed state of those few depths (prefix
and rest) to one exchange (:func:`crossings`).  A prefix and a rest are shared
by no more words than there are letters, so no group of either kind is large.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.llm.common import materialize
from tastegraph.llm.hashing import U64, RangeHash, mix

#: Maximal runs of these letters are words.
LETTERS = "[A-Za-zÀ-ÿ]+"
#: Words of a range, about.
RANGE_WORDS = 30_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPREAD = U64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- vocabulary

def words(docs: DataFrame, least_length: int = 7, least_count: int = 2,
          change: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``(word, n)``: the distinct runs of letters in whole texts, A-Z in lower
    case, of at least so many characters and occurrences.  ``change`` makes
    the counted word of doc_id and run, not longer than the run."""
    runs = F.filter(F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(LETTERS), F.lit(0)),
                    lambda w: F.length(w) >= least_length)
    each = docs.select("doc_id", F.explode(runs).alias("run"))
    word = change(F.col("doc_id"), F.col("run")) if change else F.col("run")
    return (each.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .filter((F.col("n") >= least_count) & (F.length("word") >= least_length)))


def dropped_letter(doc_id: Column, run: Column) -> Column:
    """The run without one character if 31 divides h, the crc32 of
    ``<doc_id>:<run>`` (null doc_id: empty); h modulo the length says which."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run)).cast("int")
    return F.when(h % 31 == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


# ---------------------------------------------------------------- machines of one range

class Cells:
    """One cell per word and prefix, the whole word included, with the hashes
    of the prefix, of the rest, and of the rest's first character (0: none)."""

    def __init__(self, words: list[str]):
        raw = [w.encode() for w in words]
        ends = np.cumsum([len(w) + 1 for w in raw]) - 1
        starts = ends - [len(w) for w in raw]
        data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
        pos = np.flatnonzero((data & 0xC0) != 0x80)
        self.word = np.searchsorted(ends, pos)
        self.last = pos == ends[self.word]
        h = RangeHash(data)
        self.prefix, self.rest = h(starts[self.word], pos), h(pos, ends[self.word])
        self.first = np.where(self.last, U64(0), h(pos, np.append(pos[1:], len(data))))
        self.depth = np.arange(len(pos)) - np.flatnonzero(np.diff(self.word, prepend=-1))[self.word]


def compose(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the near pairs among the sorted distinct ``words``."""
    c = Cells(words)
    # the trie's nodes, and the minimal acceptor's states: nodes of one right language
    _, node = np.unique(c.prefix, return_inverse=True)
    order = np.argsort(node, kind="stable")  # cells of a node in the order of words, hence of rests
    size = np.bincount(node)
    begin = np.cumsum(size) - size
    language = np.add.reduceat(mix(c.rest[order] + _SPREAD), begin) + mix(size.astype(U64))
    _, example, state = np.unique(language, return_index=True, return_inverse=True)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order)) - np.repeat(begin, size)

    # pairs that part at a state, enumerated at one node of it: a·s with b·s, and a·s with s
    cell = np.flatnonzero(example[state[node]] == node)
    here = node.astype(U64) * _SPREAD
    tail = cell[~c.last[cell]]
    key = mix(here[tail] + c.rest[tail + 1])
    by = np.argsort(key)
    tail, key = tail[by], key[by]
    one, two = [], []
    k = 1
    while k < len(key) and (same := key[k:] == key[:-k]).any():  # as often as letters share a rest
        one.append(tail[:-k][same])
        two.append(tail[k:][same])
        k += 1
    whole = mix(here[cell] + c.rest[cell])
    by = np.argsort(whole)
    at = np.minimum(np.searchsorted(whole[by], key), len(by) - 1)
    short = cell[by][at]
    # a run of one letter may lose any of its letters: the edit is where the words part
    met = (whole[by][at] == key) & (c.first[short] != c.first[tail])
    one, two = np.concatenate([*one, tail[met]]), np.concatenate([*two, short[met]])

    # every prefix that leads to the state has these pairs
    nodes, many = np.argsort(state, kind="stable"), np.bincount(state)
    its = state[node[one]]
    pair = np.repeat(np.arange(len(one)), many[its])
    nth = np.arange(len(pair)) - np.repeat(np.cumsum(many[its]) - many[its], many[its])
    base = begin[nodes[(np.cumsum(many) - many)[its[pair]] + nth]]
    return c.word[order[base + rank[one[pair]]]], c.word[order[base + rank[two[pair]]]]


def _shared(a: str, b: str | None) -> int:
    n = 0
    for x, y in zip(a, b or ""):
        if x != y:
            break
        n += 1
    return n


# ---------------------------------------------------------------- all ranges

def near_pairs(vocabulary: DataFrame, range_words: int = RANGE_WORDS) -> DataFrame:
    """``(word, n, near, near_n)``: every unordered pair of near words of the
    distinct ``(word, n)`` once.  Null words are left out; an empty table
    gives no rows."""
    vocabulary = vocabulary.select("word", F.col("n").cast("long").alias("n")).filter("word is not null")
    ranges = max(1, -(-vocabulary.count() // range_words))
    dealt = materialize(vocabulary.repartitionByRange(ranges, "word").sortWithinPartitions("word")
                        .withColumn("part", F.spark_partition_id()), "acceptor-ranges")
    schema = "word string, n long, near string, near_n long"

    def inside(group: pa.Table) -> pa.Table:
        group = group.sort_by("word")
        word, n = (group.column(x).combine_chunks() for x in ("word", "n"))
        one, two = (pa.array(x) for x in compose(word.to_pylist()))
        return pa.table([word.take(one), n.take(one), word.take(two), n.take(two)], names=["word", "n", "near", "near_n"])

    # one row per range: the words of its neighbours next to its borders
    ends = dealt.groupBy("part").agg(F.min("word").alias("least"), F.max("word").alias("most"))
    w = Window.orderBy("part")
    borders = ends.select("part", F.lag("most").over(w).alias("before"), F.lead("least").over(w).alias("after"))
    inner = dealt.select("part", "word", "n").groupBy("part").applyInArrow(inside, schema)

    cells = materialize(dealt.join(F.broadcast(borders), "part").select("word", "n", "part", "before", "after")
                        .mapInArrow(crossings, "key long, whole boolean, first long, word string, n long, part int"), "crossings")

    def side(x: str) -> DataFrame:
        return cells.select("key", *[F.col(v).alias(v + x) for v in ("whole", "first", "word", "n", "part")])

    met = side("1").filter("not whole1").join(side("2"), "key").filter(
        (F.col("part1") != F.col("part2")) & F.when(F.col("whole2"), F.col("first1") != F.col("first2")).otherwise(F.col("part1") < F.col("part2")))
    outer = met.select(F.col("word1").alias("word"), F.col("n1").alias("n"), F.col("word2").alias("near"), F.col("n2").alias("near_n"))
    # hashes have found them, the words decide
    return inner.unionByName(outer).filter(F.levenshtein("word", "near", 1) == 1)


def crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cells of words at those prefixes that words of other ranges have
    too: keys of (prefix, rest) for the whole rest and for the rest without
    its first character."""
    for b in batches:
        if not b.num_rows:
            continue
        text = b.column("word").to_pylist()
        deep = np.array([max(_shared(w, x), _shared(w, y)) for w, x, y in
                         zip(text, b.column("before").to_pylist(), b.column("after").to_pylist())])
        c = Cells(text)
        cell = np.flatnonzero(c.depth <= deep[c.word])
        tail = cell[~c.last[cell]]
        key = np.concatenate([mix(c.prefix[cell] * _SPREAD + c.rest[cell]), mix(c.prefix[tail] * _SPREAD + c.rest[tail + 1])])
        which = np.concatenate([cell, tail])
        rows = pa.array(c.word[which])
        yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(np.arange(len(which)) < len(cell)), pa.array(c.first[which].view(np.int64)),
                               *[b.column(x).take(rows) for x in ("word", "n", "part")]], names=["key", "whole", "first", "word", "n", "part"])


# ---------------------------------------------------------------- forms and roots

def variants(vocabulary: DataFrame, times: int = 10, range_words: int = RANGE_WORDS) -> DataFrame:
    """The spelling variants of the distinct ``(word, n)``.

    One row per word: ``word, n, n_near`` (near words), ``form`` (the near word
    of the largest n, ties: the smallest in code-point order, if its n is at
    least ``times`` that of the word, else null), ``form_n`` and ``root`` (the
    last form of the word's form, and so on; the word itself if it has none).
    Null words are left out, other columns are ignored.
    """
    vocabulary = materialize(vocabulary.select("word", F.col("n").cast("long").alias("n")).filter("word is not null"), "vocabulary")
    ways = F.explode(F.array(*[F.struct(F.col(a).alias("word"), F.col(an).alias("n"), F.struct((-F.col(bn)).alias("less"), F.col(b).alias("near")).alias("other"))
                               for a, an, b, bn in (("word", "n", "near", "near_n"), ("near", "near_n", "word", "n"))])).alias("way")
    links = near_pairs(vocabulary, range_words).select(ways).select("way.*")
    alone = vocabulary.withColumn("other", F.lit(None).cast(links.schema["other"].dataType))
    best = (links.unionByName(alone).groupBy("word")
            .agg(F.max("n").alias("n"), F.count("other").alias("n_near"), F.min("other").alias("best")))
    form = F.when(-F.col("best.less") >= times * F.col("n"), F.col("best.near"))
    forms = materialize(best.select("word", "n", "n_near", form.alias("form"), F.when(form.isNotNull(), -F.col("best.less")).alias("form_n")), "forms")

    roots = forms.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:  # a form's n is `times` the word's at least: few steps, and each round doubles them
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = materialize(roots.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                                    F.col("further").isNotNull().alias("moved")), "roots")
        if roots.filter("moved").limit(1).count() == 0:
            break
    return (forms.join(roots.select("word", "root"), "word", "left")
            .select("word", F.coalesce("root", "word").alias("root"), "n", "n_near", "form", "form_n"))
