"""Operator 3: hierarchical language identification.

A first set of linear support vector machines, one per family against the
rest, predicts the language family.  Within the family, one machine per pair
of languages separates the close relatives, and the language with the
largest sum of margins wins.  Features are hashed byte n-grams of the
lower-cased letters of the whole text.

The rest that a family is learned against includes decoys, learned texts with
their letters exchanged: words and lengths of prose, but in no language.  So a
text that no family claims has a negative margin in all of them, and a score
below one half.

Training takes at most ``per_language`` labelled documents of each language,
the least by a hash of their doc_id; the tasks turn them into feature
vectors, and only these come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegraph.llm.common import crc_remainder, give_back, lean, slices, temp

DIMENSIONS, LONGEST = 1 << 12, 4
PER_LANGUAGE = 400
#: One learned text in so many, by its draw, and one of each language at least gives a decoy.
DECOYS = 4
UNDETERMINED = "und"

#: ISO 639-1 codes of larger language families; any other
#: language is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
}
_FAMILY = {lang: family for family, members in FAMILIES.items() for lang in members}


def _letter_bytes() -> np.ndarray:
    """Bytes of a-z and of multi-byte characters; all others become a space."""
    b = np.arange(256)
    return np.where((b >= 97) & (b <= 122) | (b >= 128), b, 32).astype(np.uint32)


_LETTERS = _letter_bytes()


def features(text: str) -> np.ndarray:
    """Square roots of hashed 1- to 4-gram counts, scaled to length 1.  Runs
    of other characters than letters are one space."""
    b = _LETTERS[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    b = b[np.append(True, (b[1:] != 32) | (b[:-1] != 32))]
    counts, code = np.zeros(DIMENSIONS), b
    for n in range(1, LONGEST + 1):
        if n > 1:
            code = (code[:-1] << np.uint32(8)) | b[n - 1:]
        hashed = ((code + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(20)
        counts += np.bincount(hashed, minlength=DIMENSIONS)
    x = np.sqrt(counts)
    return x / np.linalg.norm(x)


def decoy(text: str, seed: int) -> str:
    """``text`` in lower case with its letters and a to z exchanged at random."""
    text = text.lower()
    letters = sorted({*"abcdefghijklmnopqrstuvwxyz", *filter(str.isalpha, text)})
    order = np.random.default_rng(seed).permutation(len(letters))
    return text.translate({ord(c): letters[i] for c, i in zip(letters, order)})


def train_svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0, rounds: int = 20) -> np.ndarray:
    """Weights (bias last) of a linear support vector machine with squared
    hinge loss, by dual coordinate descent; ``y`` is 1 or -1.  It computes in
    double precision a row at a time, so ``x`` is never copied."""
    row = np.ones(x.shape[1] + 1)
    w, alpha, diagonal = np.zeros(len(row)), np.zeros(len(x)), np.empty(len(x))
    for i in range(len(x)):
        row[:-1] = x[i]
        diagonal[i] = (row * row).sum() + 0.5 / cost
    order = np.random.default_rng(0)
    for _ in range(rounds):
        for i in order.permutation(len(x)):
            row[:-1] = x[i]
            slope = y[i] * (row @ w) - 1 + alpha[i] * 0.5 / cost
            new = max(alpha[i] - slope / diagonal[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * row
                alpha[i] = new
    return w


@dataclass
class Model:
    """``families``: languages by family, ``first``: a machine per family
    against the others and the decoys (none if there is nothing to tell it
    from), ``pairs``: a machine per pair of languages of one family, positive
    for the first."""

    families: dict[str, list[str]] = field(default_factory=dict)
    first: dict[str, np.ndarray] = field(default_factory=dict)
    pairs: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    @classmethod
    def fit(cls, x: np.ndarray, langs: np.ndarray) -> "Model":
        """``x``: a row per text of ``langs``, then the decoys."""
        m, decoys = cls(), len(x) - len(langs)
        for lang in sorted(set(langs.tolist())):
            m.families.setdefault(_FAMILY.get(lang, lang), []).append(lang)
        family = np.array([_FAMILY.get(lang, lang) for lang in langs.tolist()])
        if len(m.families) > 1 or len(m.families) and decoys:
            none = np.full(decoys, -1.0)
            m.first = {f: train_svm(x, np.append(np.where(family == f, 1.0, -1.0), none)) for f in m.families}
        for members in m.families.values():
            for a, b in combinations(members, 2):
                rows = np.flatnonzero((langs == a) | (langs == b))
                m.pairs[a, b] = train_svm(x[rows], np.where(langs[rows] == a, 1.0, -1.0))
        return m

    def predict(self, text: str) -> tuple[str, float]:
        """(language, score): the score is the least of the logistic
        confidences in the family's own margin, in its lead and in the
        language's lead, from 0 to 1; under one half, no family claims the
        text."""
        if not self.families:
            return UNDETERMINED, 0.0
        x = np.append(features(text), 1.0)
        family, sure = next(iter(self.families)), 1.0
        if self.first:
            margins = sorted((float(x @ w), f) for f, w in self.first.items())
            family = margins[-1][1]
            sure = min(_logistic(m) for m in (margins[-1][0], *(margins[-1][0] - m for m, _ in margins[-2:-1])))
        members = self.families[family]
        if len(members) == 1:
            return members[0], sure
        total = dict.fromkeys(members, 0.0)
        for a, b in combinations(members, 2):
            margin = float(x @ self.pairs[a, b])
            total[a] += margin
            total[b] -= margin
        ranked = sorted(members, key=lambda lang: (-total[lang], lang))
        return ranked[0], min(sure, _logistic(total[ranked[0]] - total[ranked[1]]))


def _logistic(margin: float) -> float:
    return float(1 / (1 + np.exp(-2 * margin)))


def train(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on at most ``per_language`` rows of each language among the rows
    where ``learn`` holds, lang is not null and the text has a letter."""
    rows = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", F.xxhash64(F.lit(7), "doc_id", "text").alias("draw"), "text")
    # the largest draw that belongs to a language's sample, one row per language; only draws are ranked
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    ends = rows.select("lang", "draw").withColumn("rank", rank).filter(F.col("rank") <= per_language)
    ends = ends.groupBy("lang").agg(F.max("draw").alias("last"), F.min("draw").alias("least"))
    odd = (F.col("draw") == F.col("least")) | (F.col("draw") % DECOYS == 0)
    sample = rows.join(F.broadcast(ends), "lang").filter(F.col("draw") <= F.col("last")).select("lang", "draw", "text", odd.alias("odd"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts, draws = b.column(2).to_pylist(), b.column(1).to_pylist()
            x = [features(t).astype("<f4").tobytes() for t in texts]
            z = [features(decoy(t, d % (1 << 32))).astype("<f4").tobytes() if odd else None for t, d, odd in zip(texts, draws, b.column(3).to_pylist())]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(x, pa.binary()), pa.array(z, pa.binary())], names=["lang", "draw", "x", "z"])

    got = sample.mapInArrow(lean(vectors), "lang string, draw long, x binary, z binary").collect()  # per_language rows of 16 KB a language, and the decoys
    got.sort(key=lambda r: (r["lang"], r["draw"]))
    langs, vecs = np.array([r["lang"] for r in got], object), [r["x"] for r in got] + [r["z"] for r in got if r["z"] is not None]
    x = np.empty((len(vecs), DIMENSIONS), np.float32)
    for i, v in enumerate(vecs):
        x[i] = np.frombuffer(v, "<f4")
    got = vecs = v = None
    give_back()  # the driver keeps one copy of the vectors while it fits
    return Model.fit(x, langs)


def held_out(doc_id: str = "doc_id") -> Column:
    """A third of the documents, by doc_id: never learned from."""
    return F.coalesce(crc_remainder(doc_id), F.lit(0)) == 1


def identify(docs: DataFrame, learn: Column | None = None, per_language: int = PER_LANGUAGE) -> DataFrame:
    """All columns of ``docs`` plus held_out, lang_pred and score.

    ``learn`` says which rows may be learned from (default: all but the held
    out ones; a null doc_id is not held out).  A null text, or one without a
    letter, is ``und`` with score 0; so is every text if there is no row to
    learn from.  Equal texts get equal predictions; repeated rows keep a row
    each; input columns of the result's names are replaced; an empty table
    gives no rows.
    """
    model = train(docs, ~held_out() if learn is None else learn, per_language)
    docs = docs.select([c for c in docs.columns if c not in ("held_out", "lang_pred", "score")])
    lettered, fields = temp("lettered"), docs.schema.fields
    schema = T.StructType([*fields, T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [model.predict(t) if ok else (UNDETERMINED, 0.0) for t, ok in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist())]
            langs, scores = zip(*found) if found else ((), ())
            yield pa.record_batch([*b.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    marked = docs.withColumn("held_out", held_out()).withColumn(lettered, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return marked.mapInArrow(lean(run), schema)


def in_known_language(docs: DataFrame, least: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` whose language is determined with a score of at
    least ``least``: one half is a margin of 0 in the family's own machine."""
    clash = {c: temp(c) for c in ("held_out", "lang_pred", "score") if c in docs.columns}
    found = identify(docs.withColumnsRenamed(clash), **options)
    found = found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)).drop("held_out", "lang_pred", "score")
    return found.withColumnsRenamed({v: k for k, v in clash.items()}).select(*docs.columns)
