"""Product metadata written as one Python-literal dict per line
(optionally gzip-compressed), and its projection to the columns we keep."""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegraph.schema import METADATA, METADATA_DROPPED, PRODUCT
from tastegraph.session import materialize

CORRUPT = "_corrupt_record"


@F.pandas_udf(T.StringType())
def _literal_to_json(lines: pd.Series) -> pd.Series:
    """Python-literal dict text → strict JSON text (NULL if the line is not a
    dict literal).  ``ast.literal_eval`` only evaluates literals; nothing in
    the input is ever executed."""
    def conv(s):
        try:
            v = ast.literal_eval(s)
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None
        if not isinstance(v, dict):
            return None
        try:
            return json.dumps(v, default=list)
        except (TypeError, ValueError):
            return None
    return lines.map(conv)


def read_metadata_json(spark: SparkSession, path: str, schema: T.StructType = METADATA) -> DataFrame:
    """Read loose-JSON metadata lines (plain or gzip text).

    ``from_json`` with the explicit schema parses strict JSON and single-quoted
    records on the JVM.  Only the lines it rejects (``None``, tuples and other
    Python-only literals) are sent to the vectorised literal parser — a Python
    UDF evaluates every row of its input, so the rejected rows are split off
    first rather than guarded by ``when``.  Lines that still fail keep their
    text in ``_corrupt_record`` with NULL fields: :func:`metadata_rejects`
    lists them, :func:`metadata_records` returns the rest.  Both parsers take
    the same schema and options, so a value that does not fit its column makes
    a reject on either branch.  The first parse is written once, after dealing
    out the lines of an unsplittable gzip file, and both branches read it.
    """
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "allowSingleQuotes": "true",
            "allowBackslashEscapingAnyCharacter": "true"}
    names = [f.name for f in schema.fields]
    lines = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    lines = lines.repartition(spark.sparkContext.defaultParallelism) if path.endswith(".gz") else lines
    parsed = materialize(lines.select("value", F.from_json("value", full, opts).alias("_rec")), "metadata")
    rejected = F.col("_rec").isNull() | F.col("_rec." + CORRUPT).isNotNull()
    good = parsed.filter(~rejected).select(*[F.col("_rec." + n).alias(n) for n in names],
                                           F.lit(None).cast("string").alias(CORRUPT))
    fixed = (parsed.filter(rejected).select("value")
             .withColumn("_json", _literal_to_json(F.col("value")))
             .withColumn("_fix", F.from_json("_json", full, opts)))
    failed = F.col("_json").isNull() | F.col("_fix." + CORRUPT).isNotNull()
    fixed = fixed.select(*[F.when(~failed, F.col("_fix." + n)).alias(n) for n in names], F.when(failed, F.col("value")).alias(CORRUPT))
    return good.unionByName(fixed)


def metadata_records(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def metadata_rejects(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def project_metadata(df: DataFrame, drop: list[str] = METADATA_DROPPED, strict: bool = False) -> DataFrame:
    """``asin`` → ``product_id`` and drop the listed columns.  Spark's
    ``drop`` ignores a missing column; ``strict=True`` raises instead."""
    if strict:
        missing = [c for c in ["asin", *drop] if c not in df.columns]
        if missing:
            raise KeyError(f"metadata columns missing: {missing}")
    return df.withColumnRenamed("asin", PRODUCT).drop(*drop)
