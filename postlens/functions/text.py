"""Text cleaning. The steps run in a fixed order; each sees what the one before left.

Entities, compatibility characters and emoji names have no Spark function, so they share one
Arrow-batched pandas UDF; all other steps are regular expressions inside the JVM.
"""

import html
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.functions.emoji import demojize

# Letters, numbers and underscore, and white space, as classes that mean the same in Java as
# in Python's Unicode mode.
WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\s\x1C-\x1F]"
NOT_SPACE = r"[^\s\x1C-\x1F]"
EDGE = rf"(?:(?<!{WORD})(?={WORD})|(?<={WORD})(?!{WORD}))"

# The patterns of the cleaning rules.
URL = rf"(?U)[hH][tT][tT][pP][sSſ]?://{NOT_SPACE}+|[wW][wW][wW]\.{NOT_SPACE}+"
# The possessive ++ changes no match, as @ is not in the class before it.
EMAIL = rf"(?U){EDGE}[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Z|a-z]{{2,}}{EDGE}"
MENTION = r"@[\p{L}\p{N}_.-]+"
HASHTAG = rf"#({WORD}+)"
REPEATS = r"([^\n])\1{3,}"
SYMBOLS = r"""(?U)[^\p{L}\p{N}_\s\x1C-\x1F.,!?'"-]"""
# Characters that need decoding: any beyond ASCII, and the start of an entity.
SPECIAL = r"[^\x00-\x7F]|&"
SPACES = rf"(?U){SPACE}+"
TOKEN = rf"{WORD}{{2,}}"


def unescaped(text: str) -> str:
    return html.unescape(text) if "&" in text else text


def normalised(text: str) -> str:
    return text if text.isascii() else unicodedata.normalize("NFKC", text)


def decoded(text: str | None, replace_emoji: bool = True) -> str:
    """Entities to characters, compatibility form, then emoji names and underscores to spaces."""
    if not text:
        return ""
    text = normalised(unescaped(text))
    if replace_emoji:
        if not text.isascii() or "⃣" in text:
            text = demojize(text)
        text = text.replace("_", " ")
    return text


@F.pandas_udf(T.StringType())
def decode_with_emoji(texts: pd.Series) -> pd.Series:
    return texts.map(decoded, na_action=None)


@F.pandas_udf(T.StringType())
def decode_plain(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: decoded(t, replace_emoji=False), na_action=None)


@F.pandas_udf(T.StringType())
def unescape_entities(texts: pd.Series) -> pd.Series:
    return texts.map(unescaped, na_action="ignore")


def html_unescape(text: Column | str) -> Column:
    """Entities to characters. Only texts with an ampersand go to Python."""
    text = F.col(text) if isinstance(text, str) else text
    has_entity = text.contains("&")
    return F.when(has_entity, unescape_entities(F.when(has_entity, text))).otherwise(text)


def replaced_where(text: Column, may_match: Callable[[Column], Column], pattern: str, by: str) -> Column:
    """The pattern replaced in texts that may match; others skip the search.

    The text gets a name, so its expression is not written out at each use.
    """
    step = lambda t: F.when(may_match(t), F.regexp_replace(t, pattern, by)).otherwise(t)
    return F.get(F.transform(F.array(text), step), F.lit(0))


def strip_urls(text: Column) -> Column:
    return replaced_where(text, lambda t: t.contains("://") | t.rlike(r"[wW][wW][wW]\."), URL, "")


def strip_emails(text: Column) -> Column:
    return replaced_where(text, lambda t: t.contains("@"), EMAIL, "")


def name_mentions(text: Column) -> Column:
    return replaced_where(text, lambda t: t.contains("@"), MENTION, "@user")


def unpack_hashtags(text: Column) -> Column:
    return replaced_where(text, lambda t: t.contains("#"), HASHTAG, "$1")


def squeeze_repeats(text: Column) -> Column:
    """Four or more of one character become two."""
    return F.regexp_replace(text, REPEATS, "$1$1")


def strip_symbols(text: Column) -> Column:
    return F.regexp_replace(text, SYMBOLS, " ")


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACES, " "))


MARKUP_STEPS = [
    strip_urls,
    strip_emails,
    name_mentions,
    unpack_hashtags,
    squeeze_repeats,
    strip_symbols,
    collapse_spaces,
]


def clean_markup(text: Column) -> Column:
    """The regular-expression steps alone."""
    for step in MARKUP_STEPS:
        text = step(text)
    return text


def clean_text(text: Column, replace_emoji: bool = True) -> Column:
    """All steps. NULL and empty text give the empty string."""
    decode = decode_with_emoji if replace_emoji else decode_plain
    # Plain ASCII without an ampersand holds nothing to decode, so it is sent to Python as NULL.
    special = text.rlike(SPECIAL)
    plain = F.translate(text, "_", " ") if replace_emoji else text
    decoded = F.when(special, decode(F.when(special, text))).otherwise(F.coalesce(plain, F.lit("")))
    return clean_markup(decoded)


def word_count(clean: Column) -> Column:
    """Words of cleaned text, which holds single spaces only."""
    return F.when(clean == "", 0).otherwise(F.size(F.split(clean, " ")))


def raw_word_count(text: Column) -> Column:
    """Words of any text: runs of non-space characters."""
    return F.regexp_count(text, F.lit(rf"(?U){NOT_SPACE}+"))


def tokens(text: Column) -> Column:
    """Lower-case word tokens of two or more characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
