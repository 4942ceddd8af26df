"""Column layouts and the fixed values shared by every module."""

from pyspark.sql import types as T

# These names and numbers are the data model's own.
PLATFORMS = ["bluesky", "reddit", "twitter_archive"]
ASPECTS = ["general", "product_quality", "customer_support", "pricing_value", "ui_performance"]
LABELS = ["negative", "neutral", "positive"]
SCORE_OF_LABEL = {"negative": -1.0, "neutral": 0.0, "positive": 1.0}
GRANULARITIES = {"15min": "15 minutes", "1hour": "1 hour", "1day": "1 day"}
ALERT_STATUSES = ["triggered", "acknowledged", "investigating", "resolved", "false_positive"]
SUPPORTED_LANGUAGES = ["en"]

POST_KEY = ["platform", "post_id"]
ASPECT_KEY = ["platform", "post_id", "aspect"]
REQUIRED_POST_FIELDS = ["post_id", "platform", "author_id", "text", "created_at"]

# A post as it arrives: created_at is still ISO-8601 text on the wire.
WIRE_POST = T.StructType(
    [
        T.StructField("post_id", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("author_id", T.StringType()),
        T.StructField("author_handle", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("reply_to_id", T.StringType()),
        T.StructField("reply_to_user", T.StringType()),
        T.StructField("engagement", T.MapType(T.StringType(), T.LongType())),
        T.StructField("raw_metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)

# The same post once validated.
RAW_POST = T.StructType(
    [
        T.StructField(f.name, T.TimestampType() if f.name == "created_at" else f.dataType)
        for f in WIRE_POST
    ]
)

SENTIMENT_POST = T.StructType(
    [
        T.StructField("post_id", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("author_id", T.StringType()),
        T.StructField("author_handle", T.StringType()),
        T.StructField("clean_text", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("sentiment_label", T.StringType()),
        T.StructField("sentiment_score", T.DoubleType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("is_spam", T.BooleanType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

ASPECT_RESULT = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField(
            "probabilities",
            T.StructType([T.StructField(name, T.DoubleType()) for name in LABELS]),
        ),
    ]
)
ASPECT_MAP = T.MapType(T.StringType(), ASPECT_RESULT)



def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Decoded inputs of the two platform normalisers.
BLUESKY_COMMIT = struct(
    repo=T.StringType(),
    ops=T.ArrayType(
        struct(
            action=T.StringType(),
            path=T.StringType(),
            record=struct(
                text=T.StringType(),
                createdAt=T.StringType(),
                reply=struct(parent=struct(uri=T.StringType())),
            ),
        )
    ),
)

REDDIT_ITEM = struct(
    kind=T.StringType(),
    id=T.StringType(),
    author=T.StringType(),
    title=T.StringType(),
    selftext=T.StringType(),
    body=T.StringType(),
    created_utc=T.DoubleType(),
    url=T.StringType(),
    permalink=T.StringType(),
    score=T.LongType(),
    parent_id=T.StringType(),
    subreddit=T.StringType(),
)
