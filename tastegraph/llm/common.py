"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.session import give_back, lean, materialize, release, scratch_path

__all__ = ["WORD", "crc_remainder", "documents", "give_back", "lean", "materialize", "release", "scratch_path", "slices",
           "small_batches", "table", "temp"]

#: A word of the contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def temp(name: str) -> str:
    """A column name that no input column has."""
    return f"_{name}_{uuid.uuid4().hex[:8]}"


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into slices of few rows, so that a task turns few
    texts at a time into Python objects."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """From here on the session sends at most ``rows`` rows at once to Python.
    Spark's own 10,000 texts are held by the executor's JVM, outside its heap,
    and by the worker process, for each running task."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= rows:
        spark.conf.set(setting, rows)


def crc_remainder(col: str, n: int = 3) -> Column:
    """crc32 of the column as text, modulo ``n``."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(n))
