"""Operator 2: SpotSigs document fingerprints.

An anchor is a common word; its spot signature is the anchor with the chain
of content words that follow it.  The set of a text's spot signatures is its
fingerprint: it stays with the prose where markup, headers or boilerplate
change.  Fingerprints are compared by Jaccard similarity; sets whose sizes
differ by more than the wanted similarity allows are told apart by their
size partition alone.  DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.llm.common import materialize, temp

#: Common words of English, French, German and Spanish.
ANCHORS = (
    "a", "all", "also", "an", "and", "are", "as", "at", "be", "but", "by", "can", "do", "for", "from", "had", "has", "have", "he", "in", "is",
    "it", "not", "of", "on", "or", "said", "that", "the", "there", "they", "this", "to", "was", "were", "which", "will", "with", "you",
    "au", "aux", "avec", "ce", "dans", "de", "des", "du", "elle", "en", "est", "et", "il", "la", "le", "les", "ne", "pas", "pour", "que", "qui",
    "sur", "un", "une",
    "auf", "das", "dem", "den", "der", "die", "ein", "eine", "für", "ich", "im", "ist", "mit", "nicht", "sich", "sie", "und", "von", "zu",
    "como", "con", "del", "el", "es", "las", "lo", "los", "más", "no", "o", "para", "por", "se", "su", "una", "y",
)
CHAIN = 2
#: One content word in so many, chosen by its hash, is an anchor too, for texts without common words.
RARE = 4
#: Texts with fewer spots get the chain from every content word.
FEWEST = 4


def with_spots(df: DataFrame, text: str, name: str, chain: int = CHAIN) -> DataFrame:
    """``df`` plus ``name``: the sorted distinct spot signatures (32-bit) of
    the column ``text``.  Texts of too few words for a chain have their whole
    sequence of words as one; texts without words have none."""
    words, content, spots = temp("words"), temp("content"), temp("spots")
    df = df.withColumn(words, F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0))
    w, c = F.col(words), F.col(content)
    df = df.withColumn(content, F.filter(w, lambda x: ~x.isin(*ANCHORS)))
    places = F.filter(F.transform(w, lambda x, i: F.when(x.isin(*ANCHORS), i)), lambda i: i.isNotNull())

    # the k-th anchor, at place i, has i - k content words before it
    def after(anchor: Column, first: Column) -> Column:
        return F.when(first + chain <= F.size(c), F.hash(anchor, *[F.get(c, first + j) for j in range(chain)]))

    # an anchor too near the end of the text has no chain
    df = df.withColumn(spots, F.array_compact(F.concat(
        F.transform(places, lambda i, k: after(F.get(w, i), i - k)),
        F.transform(c, lambda x, i: F.when(F.pmod(F.hash(x), F.lit(RARE)) == 0, after(F.lit(""), i))))))
    every = F.array_compact(F.transform(c, lambda x, i: after(F.lit(""), i)))
    few = F.when(F.size(spots) >= FEWEST, F.col(spots)).otherwise(F.concat(spots, every))
    whole = F.when(F.size(w) > 0, F.array(F.hash(F.array_join(w, " ")))).otherwise(F.array().cast("array<int>"))
    df = df.withColumn(spots, few)
    found = F.when(F.size(spots) > 0, F.array_sort(F.array_distinct(spots))).otherwise(whole)
    return df.withColumn(name, found).drop(words, content, spots)


def fingerprint(spots: str) -> Column:
    """The set as a string: its members in hexadecimal, in order."""
    return F.array_join(F.transform(spots, lambda x: F.hex(x.cast("long") + (1 << 31))), " ")


def size_partition(spots: str, least: float) -> Column:
    """Partition of the set size; sets of similarity ``least`` or more are in
    the same or neighbouring partitions, each 1 / least times as wide."""
    return F.when(F.size(spots) > 0, F.floor(F.log(F.size(spots).cast("double")) / (-math.log(least)))).otherwise(-1)


def likeness(a: str, b: str, least: float = 0.0) -> Column:
    """Jaccard similarity; 0 without looking at the members if the sizes rule
    out ``least``, or if one set only is empty.  Two empty sets are alike."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    return (F.when(large == 0, 1.0).when((small == 0) | (small < least * large), 0.0)
            .otherwise(common / (F.size(a) + F.size(b) - common)))


def next_ids(ids: DataFrame) -> DataFrame:
    """``ids`` (doc_id, distinct, and more) plus next_id: the next larger
    doc_id, for the last the first.  Null is least.  Every range of the order
    looks ahead by itself; only one row per range meets the others."""
    mid, part, head = temp("mid"), temp("part"), temp("head")
    ranged = materialize(ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id").withColumn(mid, F.monotonically_increasing_id())
                         .withColumn(part, F.shiftright(mid, 33)), "next-ids")
    heads = ranged.groupBy(part).agg(F.min_by(F.struct("doc_id"), mid).alias(head))
    order = Window.orderBy(part)
    heads = heads.select(part, F.coalesce(F.lead(head).over(order), F.first(head).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
                         .alias(head))
    after = F.lead(F.struct("doc_id")).over(Window.partitionBy(part).orderBy(mid))
    return (ranged.withColumn("next_id", after).join(F.broadcast(heads), part)
            .withColumn("next_id", F.coalesce("next_id", head)["doc_id"]).drop(mid, part, head))


def edited_likeness(docs: DataFrame, least: float = 0.0) -> DataFrame:
    """Fingerprints of all texts and of their edited forms.

    One row per input row: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next and size_partition.  The
    edited text has its last floor(n_chars / 4) code points replaced by as
    many first ones (or all) of the next document in the order of doc_id.  A
    null text counts as empty; null doc_ids come first; of rows that share a
    doc_id the one with the least text hash is the next document of others;
    a single document is its own next one; an empty table gives no rows.
    """
    # a struct of the id pairs nulls, too, and is one key for the joins and the grouping between them
    texts = docs.select(F.struct("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    quarter = F.floor(F.char_length("text") / 4).cast("int")
    ids = next_ids(texts.groupBy("key.doc_id").agg(F.max(quarter).alias("need")))
    asks = ids.select(F.struct(F.col("next_id").alias("doc_id")).alias("key"), F.struct("doc_id").alias("asker"), "need")
    # what each document sends to the one before it
    sent = with_spots(texts.join(asks, "key"), "text", "next_spots").select(
        F.col("asker").alias("key"), F.expr("substring(text, 1, need)").alias("head"), "next_spots", F.xxhash64("text").alias("h"))
    sent = sent.groupBy("key").agg(F.min_by(F.struct("head", "next_spots"), "h").alias("sent"))
    d = texts.join(sent, "key").select("key.doc_id", "text", "sent.head", "sent.next_spots")
    d = d.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("quarter", quarter)
    d = d.withColumn("edited", F.concat(F.expr("substring(text, 1, n_chars - quarter)"), F.expr("substring(head, 1, quarter)")))
    d = with_spots(with_spots(d, "text", "spots"), "edited", "edited_spots")
    return d.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint("spots").alias("fingerprint"),
                    fingerprint("edited_spots").alias("edited_fingerprint"), likeness("spots", "edited_spots", least).alias("near_edited"),
                    likeness("spots", "next_spots", least).alias("near_next"), size_partition("spots", 0.8).alias("size_partition"))
