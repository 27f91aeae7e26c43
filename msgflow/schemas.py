"""Record layouts at the edges of the engine."""

from pyspark.sql import types as T

MESSAGE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("data", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("authorName", T.StringType()),
    T.StructField("authorLink", T.StringType()),
    T.StructField("images", T.ArrayType(T.StringType())),
    T.StructField("text", T.ArrayType(T.StringType())),
    T.StructField("videos", T.ArrayType(T.StringType())),
    T.StructField("views", T.StringType()),
    # an object on the wire, kept as its raw JSON text until decode_translation
    T.StructField("translation", T.StringType()),
    T.StructField("@timestamp", T.StringType()),
])

TRANSLATION = T.StructType([
    T.StructField("service", T.StringType()),
    T.StructField("text", T.StringType()),
])

KAFKA_VALUE = T.StructType([T.StructField("value", T.StringType())])

CHANNEL_PAGE = T.StructType([
    T.StructField("channel", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

GAZETTEER_DOCUMENT = T.StructType([
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("population", T.LongType()),
        T.StructField("location", T.StringType()),
        T.StructField("cityId", T.LongType()),
    ]))),
])

GAZETTEER = T.StructType([
    T.StructField("pos", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("population", T.StringType()),
    T.StructField("latitude", T.StringType()),
    T.StructField("longitude", T.StringType()),
])

WHOIS_REGISTRY = T.StructType([
    T.StructField("domain", T.StringType()),
    T.StructField("domain_name", T.ArrayType(T.StringType())),
    T.StructField("whois_server", T.StringType()),
    T.StructField("registrar", T.StringType()),
    T.StructField("org", T.StringType()),
    T.StructField("referral_url", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("creation_date", T.ArrayType(T.TimestampType())),
    T.StructField("updated_date", T.ArrayType(T.TimestampType())),
    T.StructField("expiration_date", T.ArrayType(T.TimestampType())),
])

LABELLED_TEXT = T.StructType([
    T.StructField("content", T.StringType()),
    T.StructField("label", T.IntegerType()),
])

LABELLED_TEXT_ITALIAN = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("subjective", T.IntegerType()),
    T.StructField("positive", T.IntegerType()),
    T.StructField("negative", T.IntegerType()),
    T.StructField("ironic", T.IntegerType()),
    T.StructField("lpositive", T.IntegerType()),
    T.StructField("lnegative", T.IntegerType()),
    T.StructField("top", T.IntegerType()),
    T.StructField("page_text", T.StringType()),
])

RAW_TWEET = T.StructType([
    T.StructField("sentiment", T.IntegerType()),
    T.StructField("id", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("query_string", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("content", T.StringType()),
])

INGEST_STATE = T.StructType([
    T.StructField("channel", T.StringType()),
    T.StructField("last_id", T.LongType()),
    T.StructField("transaction_id", T.LongType()),
])

# Declared layout of the link table (text columns plus an epoch-second time).
LINK_TABLE_DDL = "id STRING, channel STRING, `@timestamp` STRING, content STRING, url STRING, whois STRING, emotion_detection STRING"
CITATION_TABLE_DDL = "id STRING, channel STRING, timestamp STRING, traduction STRING, emotion_detection STRING, city STRING, location STRING"
