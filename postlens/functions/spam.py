"""Spam grading: ordered rules, the first that fires names the reason."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.text import URL, word_count
from postlens.schemas import SUPPORTED_LANGUAGES

# Phrases in the order in which they are tried.
SPAM_PHRASES = [
    "airdrop",
    "free crypto",
    "giveaway alert",
    "dm to buy",
    "earn $",
    "whatsapp me",
    "telegram channel",
    "100x gem",
    "guaranteed profit",
    "work from home",
    "passive income",
    "click here to claim",
]


@dataclass(frozen=True)
class SpamLimits:
    min_words: int = 2
    max_chars: int = 3000
    max_links: int = 3
    shouting_letters: int = 20
    shouting_share: float = 0.75
    flood_chars: int = 20
    flood_share: float = 0.45
    phrases: list[str] = field(default_factory=lambda: list(SPAM_PHRASES))


def shouting(raw: Column, limits: SpamLimits) -> Column:
    letters = F.regexp_count(raw, F.lit(r"\p{L}"))
    capitals = F.regexp_count(raw, F.lit(r"\p{Lu}"))
    return (letters > limits.shouting_letters) & (capitals / letters > limits.shouting_share)


def flooding(raw: Column, limits: SpamLimits) -> Column:
    """One character makes up too much of the text.

    The caller tries it after the length rule, so it runs on short texts only.
    """
    size = F.char_length(raw)
    chars = F.filter(F.array_distinct(F.split(raw, "")), lambda c: c != "")
    most = F.array_max(
        F.transform(chars, lambda c: size - F.char_length(F.replace(raw, c, F.lit(""))))
    )
    return (size > limits.flood_chars) & (most / size > limits.flood_share)


def first_phrase(raw: Column, limits: SpamLimits) -> Column:
    lowered = F.lower(raw)
    return F.coalesce(
        *[F.when(F.contains(lowered, F.lit(p)), F.lit(p)) for p in limits.phrases]
    )


def text_spam_reason(raw: Column, clean: Column, limits: SpamLimits = SpamLimits()) -> Column:
    """Reason from the text alone, NULL when no rule fires."""
    phrase = first_phrase(raw, limits)
    return (
        F.when(word_count(clean) < limits.min_words, "TOO_SHORT")
        .when(F.char_length(raw) > limits.max_chars, "EXCESSIVE_LENGTH")
        .when(F.regexp_count(raw, F.lit(URL)) >= limits.max_links, "EXCESSIVE_LINKS")
        .when(shouting(raw, limits), "SHOUTING_RATIO")
        .when(flooding(raw, limits), "CHARACTER_FLOODING")
        .when(phrase.isNotNull(), F.concat(F.lit("SPAM_KEYWORD:"), phrase))
    )


def spam_reason(
    raw: Column,
    clean: Column,
    language: Column,
    supported: list[str] | None = None,
    limits: SpamLimits = SpamLimits(),
) -> Column:
    """An unsupported language overrides the text rules; an unknown one does not."""
    known = [*(supported or SUPPORTED_LANGUAGES), "unknown"]
    return F.when(
        ~language.isin(known), F.concat(F.lit("UNSUPPORTED_LANGUAGE:"), language)
    ).otherwise(text_spam_reason(raw, clean, limits))


def grade(
    posts: DataFrame,
    raw: str = "text",
    supported: list[str] | None = None,
    limits: SpamLimits = SpamLimits(),
) -> DataFrame:
    """Add spam_reason and is_spam to posts that have clean_text and language."""
    reason = spam_reason(F.col(raw), F.col("clean_text"), F.col("language"), supported, limits)
    graded = posts.withColumn("spam_reason", reason)
    return graded.withColumn("is_spam", F.col("spam_reason").isNotNull())
