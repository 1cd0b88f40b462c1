"""Operator 7: mixing sources to target weights by Efraimidis-Spirakis
sampling.

Every document draws a key: an exponential variable divided by its quality
weight.  Within a source, ascending keys are a weighted sample without
replacement, so the documents whose sizes add up to the budget come first.
A target above the source's size first takes whole epochs of it.

The order within a source is not sorted in one task: keys of a source of n
documents fall into buckets of their logarithm, 4 / sqrt(n) octaves wide, the
buckets' sizes are summed in order, and each bucket sorts its own documents.
The logarithm of an exponential variable has a density of at most 1 / e, at
any scale, so whatever the mixture of quality weights a bucket expects about
sqrt(n) documents at most, and there are some ten times sqrt(n) buckets.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.llm.common import WORD, materialize, temp

WEIGHTS, MOST_EPOCHS = (5, 2, 1), 3
_SOURCE = ["no_source", "source_key"]


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def length_quality(size: Column) -> Column:
    """A quality weight in [0, 1) that grows with the size: documents much
    shorter than a paragraph are drawn late."""
    return size / (size + F.lit(50.0))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``sources`` (one row per source, with source_size) plus target.

    Sources take the weights by turns, in code point order, null last, and
    share the total of all sizes.  A target stops at ``most`` times its
    source's size; the excess goes to the others by weight until none is
    above: with the sources in the order of cap / weight, the share per unit
    of weight is that of the first source whose cap it does not exceed.
    """
    everything = Window.partitionBy()  # one row per source, not per document
    by_name, by_ratio = Window.orderBy(*_SOURCE), Window.orderBy("ratio", *_SOURCE)
    cycle = F.array(*[F.lit(w) for w in weights])
    s = sources.withColumn("weight", F.get(cycle, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))))
    s = s.withColumn("cap", F.col("source_size") * most).withColumn("ratio", F.col("cap") / F.col("weight"))
    s = s.withColumn("capped", F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("cap"))
    s = s.withColumn("open", F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    s = s.withColumn("unit", (F.sum("source_size").over(everything) - F.col("capped")) / F.col("open"))
    s = s.withColumn("unit", F.min(F.when(F.col("ratio") >= F.col("unit"), F.struct("ratio", "unit"))).over(everything)["unit"])
    return s.withColumn("target", F.when(F.col("ratio") < F.col("unit"), F.col("cap").cast("double"))
                        .otherwise(F.col("unit") * F.col("weight"))).select(*_SOURCE, "source_size", "n", "target")


def bucket(key: str, n: str) -> Column:
    """The bucket of a key among n documents; buckets ascend with the keys."""
    return F.floor(F.log2(key) * F.sqrt(n) / 4)


def mix(docs: DataFrame, size: Column, quality: Column, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS,
        seed: str = "mix") -> DataFrame:
    """One row per input row: doc_id, digest (of the text), source, size,
    source_size, target and copies (how often the mix takes the document).

    Complete epochs come first; of the rest, documents are taken in the order
    of their keys while they fit the budget, and the one across its end if
    that brings the source nearer to its target.  Keys come from the seed
    and the doc_id, so reruns agree; ties go by doc_id.  Documents of size 0
    (null or empty texts) are never taken, a null source is a source, null
    doc_ids share a key, and an empty table gives no rows.
    """
    unit = (F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), 1, 13), 16, 10)
            .cast("long") + 0.5) / float(1 << 52)
    base = docs.select("doc_id", F.xxhash64("text").alias("digest"), "source", F.col("source").isNull().alias("no_source"),
                       F.coalesce("source", F.lit("")).alias("source_key"), size.alias("size"), unit.alias("unit"))
    base = base.withColumn("quality", F.coalesce(quality, F.lit(0.0)))
    # -ln(unit) is exponential; the quality weight scales it
    base = base.withColumn("key", F.when((F.col("size") > 0) & (F.col("quality") > 0), -F.log("unit") / F.col("quality"))).drop("unit")
    base = materialize(base, "mix-sizes")
    sources = targets(base.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), weights, most)
    sources = (sources.withColumn("epochs", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)))
               .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    drawn = base.join(materialize(sources, "mix-targets"), _SOURCE)
    keyless = drawn.filter(F.col("key").isNull())  # in no draw, so in no order either
    drawn = drawn.filter(F.col("key").isNotNull()).withColumn("bucket", bucket("key", "n"))
    totals = drawn.groupBy(*_SOURCE, "bucket").agg(F.sum("size").alias("in_bucket"))
    running = Window.partitionBy(*_SOURCE).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("before", F.coalesce(F.sum("in_bucket").over(running), F.lit(0))).drop("in_bucket")
    within = (Window.partitionBy(*_SOURCE, "bucket").orderBy("key", "doc_id", "digest")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = drawn.join(totals, [*_SOURCE, "bucket"]).withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    after = F.col("before") + F.col("size")
    fits = (after <= F.col("rest")) | ((F.col("before") < F.col("rest")) & (after - F.col("rest") < F.col("rest") - F.col("before")))
    copies = F.when(F.col("size") > 0, F.col("epochs") + F.col("fits").cast("int")).otherwise(0)
    rows = ["doc_id", "digest", "source", "size", "source_size", "target", "epochs"]
    placed = placed.select(*rows, fits.alias("fits")).unionByName(keyless.select(*rows, F.lit(False).alias("fits")))
    return placed.select("doc_id", "digest", "source", "size", "source_size", "target", copies.cast("int").alias("copies"))


def mixed_documents(docs: DataFrame, size: Column, quality: Column, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, whatever their names, each
    document as many times as the mix takes it.  Rows equal in doc_id and text
    share a decision; rows with a null doc_id share keys, those with a null or
    empty text are not taken, and an empty table gives no rows."""
    made = mix(docs, size, quality, **options).filter("copies > 0")
    its_id, digest, copies = temp("id"), temp("digest"), temp("copies")
    made = made.groupBy("doc_id", "digest").agg(F.max("copies").alias("copies")).toDF(its_id, digest, copies)
    here = docs["doc_id"].eqNullSafe(F.col(its_id)) & (F.xxhash64(docs["text"]) == F.col(digest))
    return docs.join(made, here).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*[docs[c] for c in docs.columns])
