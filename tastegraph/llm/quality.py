"""Operator 8: quality rules as weak supervision.

Every rule looks at one ratio of a document and votes good (1), bad (-1) or
abstains (0).  Expectation-maximisation over the votes of all documents finds
how often each rule gives each vote on good and on bad documents (the model
of Dawid and Skene, with abstaining as a third answer), without labels.  A
document is kept unless its posterior probability of being good is low,
whichever single rules it fails.

The votes of all documents reduce to a count per vote pattern, at most
3^rules rows, and each round of the algorithm is one aggregate over them.
DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import WORD, materialize

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: rule: (feature, its unit, good up to, bad from).  A ratio between the two
#: abstains.  Every kind of junk should meet two rules or more: what the rules
#: have in common is what expectation-maximisation learns from.
RULES = {
    "symbols": ("n_symbols", "n_words", 0.05, 0.20),
    "marks": ("n_marks", "word_chars", 0.12, 0.20),
    "wordless": ("n_wordless", "n_words", 0.05, 0.20),
    "capitals": ("n_capitals", "word_chars", 0.15, 0.50),
    "shouting": ("n_exclamations", "n_words", 0.05, 0.40),
    "repeats": ("n_repeat_words", "n_words", 0.10, 0.40),
    "vocabulary": ("n_known_words", "n_words", 0.60, 0.80),
    "duplicate_lines": ("n_dup_lines", "n_lines", 0.15, 0.50),
}
GOOD, BAD = 1, 0
#: A word without a letter.
_WORDLESS = r"(?<![^\x20\x09-\x0D])[^\p{L}\x20\x09-\x0D]+(?![^\x20\x09-\x0D])"
#: The first guess, (1, 0, -1): passing a rule says little, failing one says much.
_GUESS = {GOOD: (0.80, 0.17, 0.03), BAD: (0.60, 0.10, 0.30)}
ROUNDS, PRIOR = 25, 0.8
#: Posterior of being good from which a document is kept.
LEAST = 0.2


def repeated_words(words: str) -> tuple[Column, Column, Column]:
    """Three steps, each for a select of its own: hashes of the 3-word
    windows; those that occur twice, as (hash, place) in order; and the number
    of words in such windows."""
    w = F.col(words)
    windows = F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                                                 lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
    h = F.col("windows")
    placed = F.when(F.size(F.array_distinct(h)) < F.size(h),
                    F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    p = F.col("placed")

    def again(x: Column, k: Column) -> Column:
        same = [F.coalesce(F.get(p, k + d)["h"] == x["h"], F.lit(False)) for d in (-1, 1)]
        return same[0] | same[1]

    places = F.array_sort(F.transform(F.filter(p, again), lambda x: x["i"]))
    return windows, placed, places


def features(docs: DataFrame) -> DataFrame:
    """Counts of every whole text (null: no words)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", text.alias("t")).withColumn("words", F.regexp_extract_all("t", F.lit(WORD), 0))
    d = d.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD)))
    windows, placed, places = repeated_words("words")

    def count(pattern: str) -> Column:
        return F.regexp_count("t", F.lit(pattern)).cast("long")

    d = d.select("doc_id", F.size("words").cast("long").alias("n_words"), F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
                 count(r"[#*$%&|<>]").alias("n_symbols"), F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 (F.size("words") - F.size(F.array_distinct("words"))).cast("long").alias("n_known_words"), count(_WORDLESS).alias("n_wordless"),
                 count(r"[^\p{L}\x20\x09-\x0D]").alias("n_marks"), count(r"\p{Lu}").alias("n_capitals"), count("!").alias("n_exclamations"),
                 windows.alias("windows"))
    d = d.withColumn("placed", placed).drop("windows").withColumn("places", places).drop("placed")
    q = F.col("places")
    # each window adds the words up to the next one, three at most
    covered = F.aggregate(F.transform(q, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(q, i + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("places")


def votes(rules: dict = RULES) -> list[Column]:
    def vote(name: str) -> Column:
        feature, unit, good, bad = rules[name]
        ratio = F.try_divide(F.col(feature), F.col(unit))
        return F.when(ratio <= good, 1).when(ratio >= bad, -1).otherwise(0).alias(name)
    return [vote(n) for n in rules]


def posterior(model: dict, rules: dict = RULES) -> Column:
    """Probability that a document with these votes is good."""
    odds = F.lit(math.log(model["prior"]) - math.log1p(-model["prior"]))
    for name in rules:
        lift = {v: math.log(model[name, GOOD, v]) - math.log(model[name, BAD, v]) for v in (1, 0, -1)}
        odds = odds + F.when(F.col(name) == 1, lift[1]).when(F.col(name) == -1, lift[-1]).otherwise(lift[0])
    return 1 / (1 + F.exp(-odds))


def fit(voted: DataFrame, rules: dict = RULES, rounds: int = ROUNDS) -> dict:
    """Expectation-maximisation on the vote patterns.  One imagined document
    per class and vote keeps every probability above 0."""
    patterns = materialize(voted.groupBy(*rules).agg(F.count(F.lit(1)).alias("n")).coalesce(1).sortWithinPartitions(*rules), "patterns")
    model = {"prior": PRIOR} | {(r, c, v): _GUESS[c][1 - v] for r in rules for c in _GUESS for v in (1, 0, -1)}
    weight = {GOOD: F.col("n") * F.col("q"), BAD: F.col("n") * (1 - F.col("q"))}
    for _ in range(rounds):
        sums = [F.sum(F.when(F.col(r) == v, weight[c]).otherwise(0.0)).alias(f"{r}_{c}_{v}") for r in rules for c in weight for v in (1, 0, -1)]
        got = patterns.withColumn("q", posterior(model, rules)).agg(F.sum(weight[GOOD]).alias("good"), F.sum(weight[BAD]).alias("bad"), *sums).first()
        if got["good"] is None:
            break
        total = {GOOD: got["good"], BAD: got["bad"]}
        model = {"prior": (total[GOOD] + 1) / (total[GOOD] + total[BAD] + 2)} | {
            (r, c, v): (got[f"{r}_{c}_{v}"] + 1) / (total[c] + 3) for r in rules for c in weight for v in (1, 0, -1)}
    return model


def judge(docs: DataFrame, rules: dict = RULES, least: float = LEAST) -> DataFrame:
    """One row per input row: doc_id, the counts, every rule's vote,
    base_failed, probability (of being good) and kept.

    A null text has no words and fails the base rules, as does an empty one.
    Rows with equal texts get equal verdicts, other columns are ignored, and
    an empty table gives no rows.
    """
    counted = materialize(features(docs), "quality-features")
    voted = counted.select("*", *votes(rules))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = voted.withColumn("base_failed", failed).withColumn("probability", posterior(fit(voted, rules), rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= least))
