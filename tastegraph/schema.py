"""Column names and schemas shared by all operators."""

from pyspark.sql import types as T

USER = "user_id"
PRODUCT = "product_id"
RATING = "rating"
TS = "ts"
TITLE = "title"

# Encoded ratings: the common input of every recommender.
RATINGS = T.StructType([
    T.StructField(USER, T.LongType()),
    T.StructField(PRODUCT, T.LongType()),
    T.StructField(RATING, T.DoubleType()),
    T.StructField(TS, T.LongType()),
])

# Raw ratings as they arrive before id encoding: ids are strings.
RAW_RATINGS = T.StructType([
    T.StructField(USER, T.StringType()),
    T.StructField(PRODUCT, T.StringType()),
    T.StructField(RATING, T.DoubleType()),
    T.StructField(TS, T.LongType()),
])

PRODUCTS = T.StructType([
    T.StructField(PRODUCT, T.LongType()),
    T.StructField(TITLE, T.StringType()),
])

# Product metadata records (one dict per line).  Only ``asin`` and ``title``
# are used downstream; the nested shapes of the dropped keys are assumptions.
METADATA = T.StructType([
    T.StructField("asin", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("salesRank", T.MapType(T.StringType(), T.LongType())),
    T.StructField("imUrl", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("categories", T.ArrayType(T.ArrayType(T.StringType()))),
    T.StructField("related", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
])

# Columns the metadata projection removes (fixed by the reference's behaviour).
METADATA_DROPPED = ["description", "price", "salesRank", "imUrl", "brand", "related"]
