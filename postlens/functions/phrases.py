"""Many phrases looked up in one pass of a text, by one automaton over all of them."""

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from postlens.session import small_batches


def first_phrase(spark: SparkSession, text: Column, phrases: list[str]) -> Column:
    """The first phrase, by its place in the list, that the text holds whatever the case; null if none or no text.

    What `filters.has_keyword` tests phrase by phrase: the time hangs on the text, not on the number of phrases. The list is the
    caller's and goes to every task, which builds the automaton once.
    """
    small_batches(spark)
    sent = spark.sparkContext.broadcast(list(phrases))

    @F.pandas_udf("string")
    def look_up(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        listed = sent.value
        automaton = ahocorasick.Automaton()
        # Later ones are written first, so that of equal phrases the first one stays.
        for place, phrase in reversed(list(enumerate(listed))):
            if phrase:
                automaton.add_word(phrase.lower(), place)
        automaton.make_automaton()
        none = len(listed)
        # An empty phrase stands in every text.
        at_once = listed.index("") if "" in listed else none
        known = len(automaton) > 0

        def first(value):
            if not value:
                return None
            best = at_once
            if known:
                for _, place in automaton.iter(value):
                    if place < best:
                        best = place
                        if not best:
                            break
            return None if best == none else listed[best]

        for batch in batches:
            yield batch.map(first)

    return look_up(F.coalesce(F.lower(text), F.lit("")))
