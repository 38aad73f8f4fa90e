"""Declared schemas of the store tables and of the CSV exchange files. Column names are fixed values."""

from pyspark.sql import types as T

CATALOGS = T.StructType([
    T.StructField("catalog_id", T.LongType(), False),
    T.StructField("catalog_link", T.StringType(), False),
    T.StructField("collected", T.BooleanType(), False),
    T.StructField("analyzed", T.BooleanType(), False),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("product_article", T.LongType(), False),
    T.StructField("catalog_id", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("rating", T.DoubleType(), False),
    T.StructField("count_reviews", T.IntegerType(), False),
])

REVIEWS = T.StructType([
    T.StructField("review_id", T.LongType(), False),
    T.StructField("product_article", T.LongType(), False),
    T.StructField("rating", T.IntegerType(), False),
    T.StructField("text_all", T.StringType(), True),
    T.StructField("text_plus", T.StringType(), True),
    T.StructField("text_minus", T.StringType(), True),
    T.StructField("text_comment", T.StringType(), True),
])

ANALYSIS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("word", T.StringType(), False),
    T.StructField("frequency", T.DoubleType(), False),
    T.StructField("df_index", T.StringType(), False),
    T.StructField("column", T.StringType(), False),
])

# What the stream has captured, before it is collected.
CAPTURED = T.StructType([
    T.StructField("catalog_id", T.LongType()),
    T.StructField("position", T.LongType()),
    T.StructField("product_article", T.LongType()),
    T.StructField("variant_group", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("product_rating", T.StringType()),
    T.StructField("review_pos", T.LongType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("text", T.StringType()),
])

TABLES = {"catalogs": CATALOGS, "products": PRODUCTS, "reviews": REVIEWS, "analysis": ANALYSIS, "captured": CAPTURED}

CATALOG_CSV = T.StructType([
    T.StructField("product_article", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("product_rating", T.StringType()),
    T.StructField("count_reviews", T.IntegerType()),
])

RAW_REVIEW_CSV = T.StructType([
    T.StructField("review_rating", T.IntegerType()),
    T.StructField("review_text", T.StringType()),
    T.StructField("review_text_plus", T.StringType()),
    T.StructField("review_text_minus", T.StringType()),
])

PROCESSED_REVIEW_CSV = T.StructType(
    RAW_REVIEW_CSV.fields + [T.StructField("review_text_comment", T.StringType())]
)
