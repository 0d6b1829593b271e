"""Fixed schemas of the tables the engine reads and writes."""

from pyspark.sql import types as T

PAGE = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

ARTICLE = T.StructType([
    T.StructField("title", T.StringType(), False),
    T.StructField("url", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("blurp", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("imgurl", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
])

# A typed attribute value: one wrapper key per type. Text, list of text and null occur.
ATTRIBUTE = "struct<S: string, L: array<struct<S: string>>, `NULL`: boolean>"

# Field names of the change-record format.
CHANGE_BATCH = (
    "Records array<struct<eventName: string, dynamodb: struct<SequenceNumber: string, "
    f"Keys: map<string, {ATTRIBUTE}>, NewImage: map<string, {ATTRIBUTE}>>>>"
)

SEARCH_FIELDS = ["date", "url", "text", "blurp", "imgurl", "title", "tags", "category"]
