"""Ratings and products derived from the star-schema parquet tables.

ratings R: one row per line item — the ordering customer rates the part,
quantity bucketed to 1..5, ship date as epoch seconds.
products P: part key and part name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.functions import epoch_seconds
from tastegraph.schema import PRODUCT, RATING, TITLE, TS, USER

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    return {n: load_table(spark, sf_dir, n) for n in (names or TABLES)}


def ratings_from_orders(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """R(user_id, product_id, rating, ts).  Only the four needed columns are
    read from each parquet file; the join on the order key is a plain equi
    join that AQE turns into a broadcast only when ``orders`` is measured
    small, otherwise a sort-merge join on co-partitioned keys."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    od = orders.select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").alias(USER),
                    F.col("l_partkey").alias(PRODUCT),
                    (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("double").alias(RATING),
                    epoch_seconds("l_shipdate").alias(TS)))


def products_from_part(part: DataFrame) -> DataFrame:
    """P(product_id, title)."""
    return part.select(F.col("p_partkey").alias(PRODUCT), F.col("p_name").alias(TITLE))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings_from_orders(load_table(spark, sf_dir, "lineitem"), load_table(spark, sf_dir, "orders"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products_from_part(load_table(spark, sf_dir, "part"))
