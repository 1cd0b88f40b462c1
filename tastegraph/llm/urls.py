"""Operator 10: URL filters.

Explicit rules come first.  Other URLs are judged by a multinomial naive
Bayes model over the words of their host and path.  Host labels are written
together ("cheapflights"), so a unigram model, counted on the text of all
pages, splits them by Viterbi's algorithm.  The model learns from the URLs
that rules decide; the rules' own words are left out, as they would only teach
it the rules again.

Work is done once per distinct label and host.  A host has one vote, shared
out over its decided pages, and a word counts if hosts of two or more have it:
else the model would know hosts by their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import materialize

ALLOW, BLOCK = "allow", "block"

#: A word: letters, marks and digits of any script.
WORD = r"[\p{L}\p{M}\p{N}]+"
#: Words beyond this length meet labels by their first letters, then whole.
LONG = 64
#: Log odds above which the model blocks: nine to one.
LEAST_ODDS = math.log(9)
#: Hosts that a word must occur on to count.
LEAST_HOSTS = 2


def parts(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    host, path = (F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", i), F.lit("")) for i in (1, 2))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def best_rule(rules: list[tuple[str, str, str]], host: str = "host", path: str = "path") -> Column:
    """(rule, verdict) of the longest fitting rule of (verdict, host, path),
    or null; of equally long ones the first given."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, at, start in sorted(reversed(rules), key=lambda r: len(r[1]) + len(r[2])):
        fits = ((F.col(host) == at) | F.col(host).endswith("." + at)) & F.col(path).startswith(start)
        out = F.when(fits, F.struct(F.lit(at + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _words(text) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), 0)


def unigrams(texts: DataFrame, column: str) -> DataFrame:
    """(word, n): counts of all words in the text outside of tags, lower-cased."""
    text = F.regexp_replace(column, "<[^>]*>", " ")
    return texts.select(F.explode(_words(text)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def viterbi(label: str, known: dict[str, int], total: int) -> list[str]:
    """The most probable split of a label into words.  An unknown word of n
    letters has probability 10 / (total * 10^n), at any length: the best word
    that ends at a letter either is known or lengthens the unknown word that
    ends one letter before."""
    letter = math.log(10)
    begin = letter - math.log(total)
    sizes = sorted({len(w) for w in known})
    best: list[tuple[float, int]] = [(0.0, 0)]
    unknown = (-math.inf, 0)
    for end in range(1, len(label) + 1):
        unknown = max((best[end - 1][0] + begin - letter, end - 1), (unknown[0] - letter, unknown[1]))
        options = [unknown]
        for size in sizes:
            if size > end:
                break
            n = known.get(label[end - size:end])
            if n:
                options.append((best[end - size][0] + math.log(n / total), end - size))
        best.append(max(options))
    words, end = [], len(label)
    while end:
        start = best[end][1]
        words.append(label[start:end])
        end = start
    return words[::-1]


def segmented(labels: DataFrame, model: DataFrame) -> DataFrame:
    """(label, words) for every distinct ``label``, of any length.

    The substrings of up to 64 letters of a label meet the unigram model in a
    join, so the model may be of any size; a label of a host name has some
    2,000 of them.  Longer words of the model meet the substrings of 64 letters
    by their first 64 and are then compared whole.
    """
    counts = model.agg(F.sum("n").alias("n"), F.max(F.length("word")).alias("longest")).first()
    total, longest = counts["n"] or 1, counts["longest"] or 0
    labels = labels.select("label").distinct()
    starts = labels.select("label", F.explode(F.sequence(F.lit(1), F.length("label"))).alias("start")).filter(F.length("label") > 0)
    left = F.length("label") - F.col("start") + 1
    spans = starts.select("label", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(LONG), left))).alias("size"))
    pieces = spans.select("label", F.expr("substring(label, start, size)").alias("word")).distinct()
    found = pieces.join(model, "word")
    if longest > LONG:
        ahead = starts.filter(left > LONG).select("label", "start", F.expr(f"substring(label, start, {LONG})").alias("begins"))
        long_ = model.filter(F.length("word") > LONG).withColumn("begins", F.substring("word", 1, LONG))
        whole = ahead.join(long_, "begins").filter(F.expr("substring(label, start, length(word)) = word"))
        found = found.unionByName(whole.select("label", "word", "n").distinct().select(*found.columns))
    known = found.groupBy("label").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("known"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"label": b["label"], "words": [viterbi(x, dict(k) if k is not None else {}, total)
                                                               for x, k in zip(b["label"], b["known"])]})

    return labels.join(known, "label", "left").mapInPandas(run, "label string, words array<string>")


def rule_words(rules: list[tuple[str, str, str]]) -> list[str]:
    return sorted({w for _, host, path in rules for w in re.findall(r"[^\W_]+", (host + path).lower())})


def weights(votes: DataFrame) -> DataFrame:
    """(word, weight): the log-likelihood ratio of block to allow of every
    word, with add-one smoothing, from (word, allow, block, hosts)."""
    votes = votes.filter(F.col("hosts") >= LEAST_HOSTS)
    sums = votes.agg(F.sum(BLOCK).alias("b"), F.sum(ALLOW).alias("a"), F.count(F.lit(1)).alias("v")).first()
    b, a, v = sums["b"] or 0, sums["a"] or 0, sums["v"]
    return votes.select("word", (F.log((F.col(BLOCK) + 1) / (b + v)) - F.log((F.col(ALLOW) + 1) / (a + v))).alias("weight"))


def _scored(pages: DataFrame, rules: list[tuple[str, str, str]], learn: Column) -> DataFrame:
    """All rows with host, path, rule, ruled (its verdict), words and score;
    learned from the decided URLs of hosts where ``learn`` is true."""
    host, path = parts()
    base = pages.select("page_id", host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("row"))
    base = materialize(base.withColumn("best", best_rule(rules)).select("*", "best.rule", F.col("best.verdict").alias("ruled")).drop("best"), "urls")
    hosts = base.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), *[F.count_if((F.col("ruled") == v) & learn).alias(v) for v in (ALLOW, BLOCK)])
    hosts = materialize(hosts.withColumn("decided", F.col(ALLOW) + F.col(BLOCK)), "host-counts")
    labels = hosts.select("host", F.posexplode(_words("host")).alias("at", "label"))
    split = materialize(segmented(labels, materialize(unigrams(pages, "html"), "unigrams")), "segments")
    words = labels.join(split, "label").groupBy("host").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])).alias("words"))
    hosts = materialize(hosts.join(words, "host", "left"), "hosts")
    # votes: of a host's words by all its decided pages, of path words by the pages that have them
    by_host = hosts.filter("decided > 0").select("host", F.explode("words").alias("word"), ALLOW, BLOCK, "decided")
    by_path = (base.filter(F.col("ruled").isNotNull() & learn).select("host", F.explode(_words("path")).alias("word"), "ruled")
               .groupBy("host", "word").agg(*[F.count_if(F.col("ruled") == v).alias(v) for v in (ALLOW, BLOCK)])
               .join(hosts.select("host", "decided"), "host").select(*by_host.columns))
    votes = (by_host.unionByName(by_path).filter(~F.col("word").isin(*rule_words(rules))).groupBy("word")
             .agg(*[F.sum(F.col(v) / F.col("decided")).alias(v) for v in (ALLOW, BLOCK)], F.count_distinct("host").alias("hosts")))
    model = materialize(weights(votes), "url-weights")
    host_score = hosts.select("host", F.explode("words").alias("word")).join(model, "word").groupBy("host").agg(F.sum("weight").alias("host_score"))
    asked = base.filter(F.col("ruled").isNull() | ~learn)
    path_score = asked.select("row", F.explode(_words("path")).alias("word")).join(model, "word").groupBy("row").agg(F.sum("weight").alias("path_score"))
    known = materialize(hosts.select("host", "words", "pages").join(host_score, "host", "left"), "host-scores")
    # hosts of more than a task's share of the pages are fewer than tasks: they go to the pages, the other pages to the hosts
    share = max(1, base.count() // int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = F.broadcast(known.filter(F.col("pages") > share).select("host", "words", "host_score"))
    cold = known.filter(F.col("pages") <= share).select("host", "words", "host_score")
    met = base.join(hot, "host").unionByName(base.join(hot.select("host"), "host", "left_anti").join(cold, "host"))
    score = F.round(F.coalesce("host_score", F.lit(0.0)) + F.coalesce("path_score", F.lit(0.0)), 6)
    return met.join(path_score, "row", "left").withColumn("score", score)


def judge(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """One row per input row: page_id, host, path, rule (null if none fits),
    verdict, words (of the host) and score (the log odds of block; null where
    a rule decided).

    The model gives both verdicts even odds before it sees a word (rules are
    no sample of the web) and blocks from nine to one.  Without a rule that
    blocks it allows.  A URL that is null or has no
    ``://`` has an empty host and path, no words, and is allowed.  Pages
    without html still count; null page_ids and repeated rows are kept; an
    empty table gives no rows; other columns of any name are left out.
    """
    judged = _scored(pages, rules, F.lit(True)).withColumn("score", F.when(F.col("ruled").isNull(), F.col("score")))
    verdict = F.coalesce("ruled", F.when(F.col("score") >= LEAST_ODDS, BLOCK).otherwise(ALLOW))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.coalesce("words", F.array().cast("array<string>")).alias("words"),
                         "score")


def held_out_verdicts(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(ruled, verdict, n): how the model judges the URLs that rules decide on
    hosts it did not learn from, those with crc32(host) mod 3 = 1."""
    learn = F.crc32(F.encode("host", "UTF-8")) % 3 != 1
    held = _scored(pages, rules, learn).filter(F.col("ruled").isNotNull() & ~learn)
    return held.groupBy("ruled", F.when(F.col("score") >= LEAST_ODDS, BLOCK).otherwise(ALLOW).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))
