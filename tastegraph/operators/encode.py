"""Dense id encoding (sorted distinct values → 0 … n−1) and decoding.

The dictionary is built without a single-partition window: the distinct
values are range-partitioned and sorted, each row gets
``monotonically_increasing_id`` (partition index in the high bits, position
in the low 33 bits), the result is checkpointed so the ids are fixed, and a
per-partition offset table — one row per partition, so its size is bounded
by the partition count, not by the data — turns (partition, position) into
the global code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastegraph.schema import PRODUCT, USER

CODE = "code"
_LOW_BITS = 33


def build_dictionary(values: DataFrame, col: str) -> DataFrame:
    """Dictionary ``(col, code)`` with codes in ascending value order
    (binary / UTF-8 order for strings, numeric order for numbers)."""
    return positions(values.select(col).filter(F.col(col).isNotNull()).distinct(), [F.col(col)], CODE)


def positions(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` plus ``name``: the 0-based position of each row in the order."""
    ordered = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    ordered = ordered.checkpoint(eager=True)
    ordered = (ordered.withColumn("_part", F.shiftright("_mid", _LOW_BITS))
               .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))))
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a window over it is tiny by construction
    offsets = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_off"))
    return (ordered.join(F.broadcast(offsets), "_part")
            .select(*df.columns, (F.col("_off") + F.col("_pos")).alias(name)))


def encode_column(df: DataFrame, col: str, dictionary: DataFrame) -> DataFrame:
    """Replace ``col`` by its code (values missing from the dictionary → NULL)."""
    d = dictionary.select(F.col(col).alias("_v"), F.col(CODE).alias("_code"))
    cols = [F.col("_code").alias(col) if c == col else F.col(c) for c in df.columns]
    return df.join(d, df[col] == d["_v"], "left").select(*cols)


def decode_column(df: DataFrame, col: str, dictionary: DataFrame) -> DataFrame:
    """Code → original value."""
    d = dictionary.select(F.col(CODE).alias("_c"), F.col(col).alias("_orig"))
    cols = [F.col("_orig").alias(col) if c == col else F.col(c) for c in df.columns]
    return df.join(d, df[col] == d["_c"], "left").select(*cols)


def encode_users(r: DataFrame) -> tuple[DataFrame, DataFrame]:
    """L1: fit on the ratings' users and encode them."""
    d = build_dictionary(r, USER)
    return encode_column(r, USER, d), d


def encode_products(r: DataFrame) -> tuple[DataFrame, DataFrame]:
    """L2: fit on the ratings' products and encode them."""
    d = build_dictionary(r, PRODUCT)
    return encode_column(r, PRODUCT, d), d


def encode_metadata_products(meta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """L3: fit on the metadata's products (separately from the ratings — codes
    need not agree with L2; use L4 when both are encoded)."""
    d = build_dictionary(meta, PRODUCT)
    return encode_column(meta, PRODUCT, d), d


def encode_joint(r: DataFrame, meta: DataFrame) -> DataFrame:
    """L4: one product dictionary over ratings ∪ metadata, so a title and the
    ratings of the same product always share a code."""
    return build_dictionary(r.select(PRODUCT).unionByName(meta.select(PRODUCT)), PRODUCT)


# ---------------------------------------------------------------- append-only dictionaries

VERSION = "version"


def dictionary_versions(spark: SparkSession, folder: str) -> list[int]:
    """The complete versions of a stored dictionary, in order.  A version
    counts once its write has committed (``_SUCCESS``); what a lost job left
    behind is not one, and the next append writes over it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    found = sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{VERSION}="))
    return [v for v in found if fs.exists(hadoop.Path(f"{folder}/{VERSION}={v}/_SUCCESS"))]


def stored_dictionary(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """``(value, code, version)`` of a stored dictionary as of a version (the
    last unless given).  ``version`` says when a value came in."""
    parts = [v for v in dictionary_versions(spark, folder) if version is None or v <= version]
    if not parts or (version is not None and parts[-1] != version):
        raise ValueError(f"{folder} has no version {'' if version is None else version}".rstrip())
    return spark.read.option("basePath", folder).parquet(*[f"{folder}/{VERSION}={v}" for v in parts])


def append_to_dictionary(values: DataFrame, col: str, folder: str) -> DataFrame:
    """L1–L4 over time: give the values of ``col`` that the stored dictionary
    in ``folder`` lacks the next codes, in value order, as a new version, and
    return the whole dictionary.

    Old codes never move and all codes together are 0 … n−1, so what was
    encoded earlier stays right.  Only new values are sorted (by range, as in
    :func:`build_dictionary`) and written; the old ones are read for one
    anti-join.  Nulls have no code; repeated values one; a version may be
    empty.  One job may append at a time.
    """
    spark = values.sparkSession
    done = dictionary_versions(spark, folder)
    fresh, first = values.select(col).filter(F.col(col).isNotNull()).distinct(), 0
    if done:
        old = stored_dictionary(spark, folder)
        if old.schema[col].dataType != values.schema[col].dataType:
            raise ValueError(f"{col} is {values.schema[col].dataType.simpleString()}, the dictionary's {old.schema[col].dataType.simpleString()}")
        fresh = fresh.join(old.select(col), col, "left_anti")
        first = old.agg(F.coalesce(F.max(CODE) + 1, F.lit(0)).alias("first")).first()["first"]
    numbered = positions(fresh, [F.col(col)], CODE).select(col, (F.col(CODE) + first).alias(CODE))
    numbered.write.mode("overwrite").parquet(f"{folder}/{VERSION}={done[-1] + 1 if done else 1}")
    return stored_dictionary(spark, folder)
