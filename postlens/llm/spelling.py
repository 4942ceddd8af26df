"""Words grouped with their spelling variants: words one inserted, deleted or replaced letter apart, by a gram index.

The grams have different lengths. A gram that stands in many words tells little, so it is lengthened: at each place of a word
the gram is the shortest one that is not frequent, between SHORTEST and LONGEST letters. The dictionary is the set of
frequent grams; their number is at most the number of grams over the count that makes one frequent, which grows with the words.

One edit touches only grams that hold its letter. So a word's bound is the most grams that hold one letter, and near words
share all but so many. In one order of all grams, rare ones first, the first bound + 1 grams of two near words have one in
common: a word is listed under these alone. A gram's list is split by the letters that one edit leaves as they are, lists
are merged, and the words met there are verified.

Null texts hold no words; a null doc_id counts as an empty text before the colon. Equal rows count as often as they stand
there. Columns other than doc_id and text are not read. Empty tables give no words.
"""

import functools
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import stored

LEAST_LETTERS = 7
LEAST_COUNT = 2
FORM_RATIO = 10
DAMAGED = 31
SHORTEST, LONGEST = 2, 4
# A gram is frequent beyond LEAST_FREQUENT words, or beyond this share of all grams of its length.
LEAST_FREQUENT = 16
DICTIONARY = 1 << 17
WORDS_HELD = 200_000
WORDS_A_TASK = 50_000


def corpus_words(documents: DataFrame) -> DataFrame:
    """(word, n): runs of letters of whole texts, one letter lost where crc32 says so, that occur often enough."""
    least, damaged, held = LEAST_LETTERS, DAMAGED, WORDS_HELD

    def count(frames):
        # The letters are fixed: A-Z in lower case, and U+00C0 to U+00FF.
        runs = re.compile(f"[a-zÀ-ÿ]{{{least},}}")
        counts = Counter()
        for frame in frames:
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                if not text:
                    continue
                start = zlib.crc32(f"{doc_id or ''}:".encode())
                # Lower case of bytes changes A-Z alone.
                for run, n in Counter(runs.findall(text.encode().lower().decode())).items():
                    h = zlib.crc32(run.encode(), start)
                    if h % damaged == 0:
                        run = run[: h % len(run)] + run[h % len(run) + 1 :]
                        if len(run) < least:
                            continue
                    counts[run] += n
                if len(counts) > held:
                    yield pd.DataFrame(counts.items(), columns=["word", "n"])
                    counts = Counter()
        if counts:
            yield pd.DataFrame(counts.items(), columns=["word", "n"])

    texts = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    counted = texts.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """Grams of SHORTEST to LONGEST letters in more words than the bound, with their counts: DICTIONARY of a length at most."""
    letters = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    bound = max(LEAST_FREQUENT, letters // DICTIONARY)
    padded = words.select(F.concat(F.lit("^"), "word", F.lit("$")).alias("w"))

    def of_length(q):
        return F.transform(F.sequence(F.lit(1), F.length("w") - (q - 1)), lambda i: F.substring("w", i, F.lit(q)))

    grams = [of_length(q) for q in range(SHORTEST, LONGEST + 1)]
    counted = padded.select(F.explode(F.flatten(F.array(*grams))).alias("gram")).groupBy("gram").count()
    return {r[0]: r[1] for r in counted.where(F.col("count") > bound).collect()}


def decompose(word, frequent):
    """(place, gram) at each place of ^word$: the gram is lengthened as long as it is frequent."""
    word = f"^{word}$"
    end, grams = len(word), []
    for i in range(end - SHORTEST + 1):
        j = i + SHORTEST
        while j < end and j - i < LONGEST and word[i:j] in frequent:
            j += 1
        grams.append((i, word[i:j]))
    return grams


def affected(grams, letters):
    """The most grams that one edit can touch: those that hold one letter of the word."""
    change = [0] * (letters + 4)
    for i, gram in grams:
        change[i] += 1
        change[i + len(gram)] -= 1
    most = now = 0
    for x in range(letters + 1):
        now += change[x]
        if x:
            most = max(most, now)
    return most


def lister(frequent):
    """listed(word): the grams under which a word is listed, as places in ^word$: first, and last + 1."""
    order = {}

    def rank(place):
        gram = place[1]
        if gram not in order:
            order[gram] = (frequent.get(gram, 0), zlib.crc32(gram.encode()), gram)
        return order[gram], place[0]

    def listed(word):
        grams = decompose(word, frequent)
        grams.sort(key=rank)
        return [(i, i + len(gram)) for i, gram in grams[: affected(grams, len(word)) + 1]]

    return listed


def list_parts(letters, start, end):
    """What the lists of a word's gram know of it: rows of (kind, short, from, letters, from, letters), places from 1.

    An edit leaves all letters on one side of a shared gram as they are, and the first or last half of those on the other side.
    So the list of a gram is split by both, and by the length of the shorter word: a word stands among the short words of its
    own length and among the long ones of a letter less.
    """
    rows = []
    for side, sure, rest in ((0, (1, end - 1), (end, letters - end + 1)), (1, (start, letters - start + 1), (1, start - 1))):
        # A gram that holds the mark of the start or of the end has no letters on that side to edit.
        if (end == letters + 2) if side == 0 else start == 0:
            continue
        for short in (1, 0):
            free = rest[1] - 1 + short
            half = free // 2
            if free >= 0:
                rows.append((4 * (letters - 1 + short) + 2 * side, short, *sure, rest[0], half))
            if half:
                rows.append((4 * (letters - 1 + short) + 2 * side + 1, short, *sure, rest[0] + rest[1] - half, half))
    return np.array(rows, np.int32).reshape(-1, 6)


def near_words(words: DataFrame) -> DataFrame:
    """(word, other): each pair of words that differ by one edit, once, word before other. words must be stored.

    The name of a list is the hash of all that its words share.
    """
    # Bounded by frequent_grams, so it may go to all tasks.
    frequent = words.sparkSession.sparkContext.broadcast(frequent_grams(words))
    names = ["kind", "short", "a", "b", "c", "d"]

    def lists(batches):
        listed, parts = lister(frequent.value), functools.cache(list_parts)
        for batch in batches:
            found = [np.concatenate([parts(len(w), i, j) for i, j in listed(w)]) for w in batch["word"].to_pylist()]
            rows = np.concatenate(found) if found else np.zeros((0, 6), np.int32)
            of = np.repeat(np.arange(len(found)), [len(x) for x in found])
            columns = [batch["word"].take(pa.array(of)), *(pa.array(rows[:, k]) for k in range(6))]
            yield pa.RecordBatch.from_arrays(columns, ["word", *names])

    tasks = max(words.sparkSession.sparkContext.defaultParallelism, words.count() // WORDS_A_TASK)
    listed_words = words.select("word").repartition(tasks).mapInArrow(lists, "word string, " + ", ".join(f"{n} int" for n in names))
    shared = [F.substring("word", F.col("a"), F.col("b")), F.substring("word", F.col("c"), F.col("d"))]
    rows = listed_words.select(F.xxhash64("kind", *shared).alias("at"), "word", (F.col("short") == 1).alias("short"))
    # Lists are far larger than the words they come from, whose size the planner would go by.
    others = rows.hint("merge").select("at", F.col("word").alias("other"), F.col("short").alias("other_short"))
    close = F.col("short") & (~F.col("other_short") | (F.col("word") < F.col("other")))
    met = rows.join(others, "at").where(close & (F.levenshtein("word", "other", 1) == 1))
    return met.select(F.least("word", "other").alias("word"), F.greatest("word", "other").alias("other")).distinct()


def spelling_groups(documents: DataFrame) -> DataFrame:
    """Each word with its count, its near words and the most frequent of them, and the end of its chain of forms."""
    words = stored(corpus_words(documents), "spelling-words")
    pairs = stored(near_words(words), "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other")))
    counts = words.select(F.col("word").alias("other"), F.col("n").alias("form_n"))
    best = (
        both.join(counts, "other")
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), F.min(F.struct(-F.col("form_n"), F.col("other").alias("form"))).alias("best"))
        .select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.col1")).alias("form_n"))
    )
    formed = F.col("form_n") >= FORM_RATIO * F.col("n")
    found = stored(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("form")).alias("form"),
            F.when(formed, F.col("form_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    return found.join(roots(found.where("form IS NOT NULL").select("word", "form")), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", F.col("word")).alias("root")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form of each chain. Counts grow tenfold with each form, so a few doublings of the steps end it."""
    reached = forms.withColumnRenamed("form", "root")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        reached = stored(
            reached.join(further, "root", "left").select(
                "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")
            ),
            "spelling-roots",
        )
        if reached.where("moved").isEmpty():
            return reached.drop("moved")
        reached = reached.drop("moved")
