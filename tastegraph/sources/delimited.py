"""Delimited text readers and writers for ratings and product titles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.functions.expressions import parse_delimited, sep_pattern
from tastegraph.schema import PRODUCT, RATING, TITLE, TS, USER

_RATING_NAMES = [USER, PRODUCT, RATING, TS]


def _bad(names: list[str]):
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in names])


def _checked(rows: DataFrame, names: list[str], mode: str, what: str) -> DataFrame:
    """Rows whose ``names`` all parsed.  FAILFAST raises on the first other
    row: the check is a filter, so it runs whatever columns a reader of the
    result asks for, ``count()`` included."""
    bad = _bad(names)
    if mode.upper() == "FAILFAST":
        return rows.filter(F.assert_true(~bad, F.concat(F.lit(f"malformed {what} line: "), F.col("_line"))).isNull())
    return rows.filter(~bad)


def _rating_lines(spark: SparkSession, path: str, sep: str, id_type: str) -> DataFrame:
    lines = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    return lines.select(F.col("value").alias("_line"), *parse_delimited("value", sep, _RATING_NAMES, [id_type, id_type, "double", "long"]))


def read_ratings_delimited(spark: SparkSession, path: str, sep: str = "|", id_type: str = "long",
                           mode: str = "PERMISSIVE") -> DataFrame:
    """``user|product|rating|timestamp`` lines without a header.

    Fields are stripped; trailing fields (a title, say) are ignored.  In
    PERMISSIVE mode a malformed line goes to :func:`rating_rejects`; FAILFAST
    raises like the reference's hard casts.
    """
    return _checked(_rating_lines(spark, path, sep, id_type), _RATING_NAMES, mode, "rating").select(*_RATING_NAMES)


def rating_rejects(spark: SparkSession, path: str, sep: str = "|", id_type: str = "long") -> DataFrame:
    """The lines (column ``line``) that S1 leaves out."""
    return _rating_lines(spark, path, sep, id_type).filter(_bad(_RATING_NAMES)).select(F.col("_line").alias("line"))


_CSV_REJECT = "_corrupt_record"


def _csv_ratings(spark: SparkSession, path: str, sep: str, id_type: str) -> DataFrame:
    schema = f"{USER} {id_type}, {PRODUCT} {id_type}, {RATING} double, {TS} long, {_CSV_REJECT} string"
    return (spark.read.schema(schema).option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _CSV_REJECT).option("enforceSchema", True).csv(path))


def read_ratings_csv_header(spark: SparkSession, path: str, sep: str = ",", id_type: str = "long") -> DataFrame:
    """CSV with a header row; keep user, product, rating.  Rows without
    one of them go to :func:`csv_rating_rejects`."""
    return _csv_ratings(spark, path, sep, id_type).select(USER, PRODUCT, RATING).dropna()


def csv_rating_rejects(spark: SparkSession, path: str, sep: str = ",", id_type: str = "long") -> DataFrame:
    """The rows that S2 leaves out: the fields as far as they parsed, and the
    line where Spark found one that does not fit its column."""
    rows = _csv_ratings(spark, path, sep, id_type)
    return rows.filter(_bad([USER, PRODUCT, RATING]))


def _title_lines(spark: SparkSession, path: str, sep: str, truncate_at_sep: bool, id_type: str) -> DataFrame:
    parts = F.split(F.trim("value"), sep_pattern(sep), 2)
    title = F.get(parts, F.lit(1))
    if truncate_at_sep:
        title = F.split(title, sep_pattern(sep)).getItem(0)
    return (spark.read.text(path).filter(F.length(F.trim("value")) > 0)
            .select(F.col("value").alias("_line"), F.trim(parts.getItem(0)).try_cast(id_type).alias(PRODUCT), title.alias(TITLE)))


def title_rejects(spark: SparkSession, path: str, sep: str = "#", id_type: str = "long") -> DataFrame:
    """The lines (column ``line``) that S3 leaves out: no valid id."""
    return _title_lines(spark, path, sep, False, id_type).filter(F.col(PRODUCT).isNull()).select(F.col("_line").alias("line"))


def read_product_titles(spark: SparkSession, path: str, sep: str = "#", truncate_at_sep: bool = False,
                        dedup: bool = True, id_type: str = "long", mode: str = "PERMISSIVE") -> DataFrame:
    """S3: ``product_id#title`` lines.

    The title is everything after the first separator (``split`` with limit 2),
    so a title may contain the separator; ``truncate_at_sep=True`` cuts it at
    its own separator like the reference.  Duplicate ids keep ``max(title)``:
    text files have no line order across partitions, so "last line wins" is
    not a distributed notion.  Lines without a valid id go to
    :func:`title_rejects`, or raise in FAILFAST mode.
    """
    out = _checked(_title_lines(spark, path, sep, truncate_at_sep, id_type), [PRODUCT], mode, "title").select(PRODUCT, TITLE)
    if dedup:
        out = out.groupBy(PRODUCT).agg(F.max(TITLE).alias(TITLE))
    return out


def load_personal_ratings(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """The served user's own ratings (5th field, a title, is ignored);
    only ratings > 0 count.  Raises ``ValueError`` if nothing is left — the
    one check that needs an action, over a file that is small by definition."""
    rows = read_ratings_delimited(spark, path, sep=sep).filter(F.col(RATING) > 0)
    if rows.limit(1).count() == 0:
        raise ValueError(f"no positive ratings in {path}")
    return rows


def write_ratings_delimited(df: DataFrame, path: str, sep: str = "#", header: bool = False) -> str:
    """K1: encoded ratings as separated text (header off for ALS input, on for
    the cosine input)."""
    (df.select(USER, PRODUCT, RATING, TS).write.mode("overwrite")
     .option("sep", sep).option("header", header).csv(path))
    return path


def write_titles_delimited(df: DataFrame, path: str, sep: str = "#") -> str:
    """K2: ``product_id#title`` lines.  Written as plain text (not CSV) so the
    separator inside a title survives unquoted and S3 reads it back whole."""
    (df.select(F.concat_ws(sep, F.col(PRODUCT).cast("string"), F.coalesce(F.col(TITLE), F.lit(""))).alias("value"))
     .write.mode("overwrite").text(path))
    return path


def write_metadata_csv(df: DataFrame, path: str) -> str:
    """K3: projected metadata, comma separated with a header; embedded quotes
    and commas are quoted so the file reads back to the same values."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("quoteAll", False).csv(path))
    return path
