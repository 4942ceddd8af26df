"""The enrichment job: messages in; bronze, silver, aspect, search and dead-letter tables out."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlens.functions.spam import SpamLimits, grade
from postlens.operators.keyed import RESCORED, as_messages, explode_aspects, search_documents
from postlens.operators.language import detect_language, with_clean_text
from postlens.operators.models import Scorer, document_sentiment
from postlens.schemas import ASPECT_KEY, POST_KEY, SUPPORTED_LANGUAGES
from postlens.session import spread
from postlens.sources.sinks import KeyedTable, insert_ignore_into, upsert_into
from postlens.sources.validate import validate_and_dead_letter

TRIGGER = "2 seconds"


@dataclass(frozen=True)
class EnrichmentTables:
    """Folders under one root; the three keyed tables are split into buckets of their key.

    A post that comes again with another time is still the same post.
    """

    root: str
    buckets: int = 16

    @property
    def bronze(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/raw_social_posts", POST_KEY, buckets=self.buckets)

    @property
    def silver(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/sentiment_posts", POST_KEY, buckets=self.buckets)

    @property
    def aspects(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/post_aspect_sentiment", ASPECT_KEY, buckets=self.buckets)

    def folder(self, name: str, batch_id: int) -> str:
        return f"{self.root}/{name}/batch={batch_id}"


@dataclass(frozen=True)
class Enricher:
    """How posts are cleaned, graded and scored. Without a language model all count as English."""

    scorer: Scorer
    language_model: PipelineModel | None = None
    supported: tuple[str, ...] = tuple(SUPPORTED_LANGUAGES)
    limits: SpamLimits = SpamLimits()
    replace_emoji: bool = True

    def clean(self, posts: DataFrame) -> DataFrame:
        cleaned = with_clean_text(posts, "text", self.replace_emoji)
        if self.language_model is None:
            tagged = cleaned.withColumn("language", F.lit("en"))
        else:
            tagged = detect_language(cleaned, self.language_model)
        return grade(tagged, "text", list(self.supported), self.limits)

    def enrich(self, posts: DataFrame) -> DataFrame:
        """Raw posts to enriched posts. Spam is scored as well; queries leave it out."""
        scored = document_sentiment(self.scorer(self.clean(posts)))
        return scored.withColumnRenamed("text", "raw_text").withColumn(
            "processed_at", F.current_timestamp()
        )


BRONZE = [
    "post_id",
    "platform",
    "author_id",
    "author_handle",
    "raw_text",
    "url",
    "created_at",
    "reply_to_id",
    "reply_to_user",
    "engagement",
    "raw_metadata",
]
SILVER = [
    "post_id",
    "platform",
    "author_id",
    "author_handle",
    "clean_text",
    "language",
    "sentiment_label",
    "sentiment_score",
    "confidence",
    "is_spam",
    "created_at",
    "processed_at",
]


def store_batch(
    messages: DataFrame, batch_id: int, tables: EnrichmentTables, enricher: Enricher
) -> None:
    """One micro-batch into all sinks. Every write may be repeated with the same result.

    A failure fails the batch, which is then replayed from the checkpointed offsets.
    """
    posts, dead = validate_and_dead_letter(spread(messages))
    enriched = enricher.enrich(posts).persist()
    insert_ignore_into(tables.bronze, enriched.select(*BRONZE))
    upsert_into(tables.silver, enriched.select(*SILVER), update=RESCORED, order=["processed_at"])
    insert_ignore_into(tables.aspects, explode_aspects(enriched, "created_at"))
    search_documents(enriched).write.mode("overwrite").json(tables.folder("search", batch_id))
    as_messages(enriched).write.mode("overwrite").json(tables.folder("enriched", batch_id))
    dead.write.mode("overwrite").json(tables.folder("dead_letter", batch_id))
    enriched.unpersist()


def start_enrichment(
    messages: DataFrame, tables: EnrichmentTables, enricher: Enricher, checkpoint: str, **trigger
) -> StreamingQuery:
    """Run store_batch on every micro-batch of a message stream (column value)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, batch_id, tables, enricher)

    return (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )
