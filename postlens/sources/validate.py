"""Messages that are not valid posts go to a dead-letter table with the reason."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.schemas import REQUIRED_POST_FIELDS, WIRE_POST
from postlens.sources.posts import parse_time, typed

CORRUPT = "_corrupt"
PARSE_SCHEMA = T.StructType([*WIRE_POST.fields, T.StructField(CORRUPT, T.StringType())])


def parse_messages(messages: DataFrame, column: str = "value") -> DataFrame:
    """JSON text beside the parsed post and the reason why it is unusable (NULL if it is fine).

    Unparsable text comes before a missing field, and fields are tried in their fixed order.
    """
    parsed = F.from_json(
        F.col(column), PARSE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    post = F.col("post")
    reason = F.when(post.isNull() | post[CORRUPT].isNotNull(), F.lit("malformed JSON"))
    for name in REQUIRED_POST_FIELDS:
        reason = reason.when(post[name].isNull(), F.lit(f"missing field: {name}"))
    reason = reason.when(
        parse_time(post["created_at"]).isNull(), F.lit("bad timestamp: created_at")
    )
    return messages.select(F.col(column).alias("original_payload"), parsed.alias("post")).withColumn(
        "reason", reason
    )


def valid_posts(parsed: DataFrame) -> DataFrame:
    return typed(parsed.filter(F.col("reason").isNull()).select("post.*").drop(CORRUPT))


def dead_letters(parsed: DataFrame, failed_at=None) -> DataFrame:
    return parsed.filter(F.col("reason").isNotNull()).select(
        (F.current_timestamp() if failed_at is None else F.lit(failed_at).cast("timestamp")).alias(
            "failed_at"
        ),
        "reason",
        "original_payload",
    )


def validate_and_dead_letter(
    messages: DataFrame, column: str = "value", failed_at=None
) -> tuple[DataFrame, DataFrame]:
    """(valid raw posts, dead letters)."""
    parsed = parse_messages(messages, column)
    return valid_posts(parsed), dead_letters(parsed, failed_at)
