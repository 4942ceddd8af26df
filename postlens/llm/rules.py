"""Quality rules by document and by host, in DataFrame functions only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import WORD_BREAK, stored
from postlens.llm.native import SHINGLE_WORDS, let, window_hashes, words

MIN_WORDS = 10
MAX_REPEAT_SHARE = 20  # words in repeated windows, per 100 words
MAX_SYMBOL_SHARE = 20  # symbols, per 100 characters of words
MAX_DUP_LINE_WORDS = 30  # repeated lines, per 100 lines with a word
# A host is bad if the shrunk share of its documents that fail some rule is over this.
MAX_HOST_RATE = 0.5
RULES = ("base", "symbols", "lines")
NOT_SYMBOL = "[^#*$%&|<>]+"
WORD = "[^\\x20\\x09-\\x0D]"


def repeat_words(windows: Column) -> Column:
    """How many words lie in a window whose hash occurs twice or more."""

    def positions(ordered):
        def again(x, k):
            beside = F.get(ordered, k - 1)["h"] == x["h"], F.get(ordered, k + 1)["h"] == x["h"]
            return F.coalesce(beside[0], F.lit(False)) | F.coalesce(beside[1], F.lit(False))

        return F.sort_array(F.transform(F.filter(ordered, again), lambda x: x["k"]))

    def covered(places):
        each = F.transform(
            places, lambda p, k: F.least(F.coalesce(F.get(places, k + 1) - p, F.lit(SHINGLE_WORDS)), F.lit(SHINGLE_WORDS))
        )
        return F.aggregate(each, F.lit(0).cast("bigint"), lambda total, n: total + n)

    def count(w):
        ordered = F.sort_array(F.transform(w, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))
        return let(ordered, lambda o: let(positions(o), covered))

    none = F.lit(0).cast("bigint")
    return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), none).otherwise(count(w)))


def text_counts(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words; zeros for null."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))

    def counts(found):
        return F.struct(
            F.size(found).cast("bigint").alias("n_words"),
            F.length(F.regexp_replace(text, WORD_BREAK, "")).cast("bigint").alias("word_chars"),
            F.length(F.regexp_replace(text, NOT_SYMBOL, "")).cast("bigint").alias("n_symbols"),
            let(lines, lambda own: F.struct(F.size(own).alias("n"), F.size(F.array_distinct(own)).alias("distinct"))).alias("lines"),
            repeat_words(window_hashes(found)).alias("n_repeat_words"),
        )

    return let(words(text), counts)


def document_rules(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """The counts and failed rules of every document, beside the columns of keep."""
    rows = docs.select(*keep, text_counts(F.col("text")).alias("c"))
    rows = rows.select(
        *keep,
        "c.n_words",
        "c.word_chars",
        "c.n_symbols",
        F.col("c.lines.n").cast("bigint").alias("n_lines"),
        (F.col("c.lines.n") - F.col("c.lines.distinct")).cast("bigint").alias("n_dup_lines"),
        "c.n_repeat_words",
    )
    too_many = 100 * F.col("n_repeat_words") > MAX_REPEAT_SHARE * F.col("n_words")
    return rows.withColumns(
        {
            "base_failed": (F.col("n_words") < MIN_WORDS) | too_many,
            "symbols_failed": 100 * F.col("n_symbols") > MAX_SYMBOL_SHARE * F.col("word_chars"),
            "lines_failed": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_WORDS * F.col("n_lines"),
        }
    )


def host_of(source: Column) -> Column:
    """The host in lower case of a URL or bare name; empty for null."""
    name = F.regexp_extract(F.lower(source), r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/@]*@)?([^/:?#]*)", 1)
    return F.coalesce(name, F.lit(""))


def host_counts(rows: DataFrame) -> DataFrame:
    """host, documents and the number of failures of every rule, from rows with host and `<rule>_failed`."""
    failed = [F.sum(F.col(f"{rule}_failed").cast("bigint")).alias(f"{rule}_n") for rule in RULES]
    return rows.groupBy("host").agg(F.count("*").alias("documents"), *failed)


def likeness(hosts: DataFrame) -> dict[str, float]:
    """How alike documents of one host fail each rule: 0 (as by chance) to 1 (all or none), the share 1 / (a + b + 1) of a beta prior.

    It is the analysis of variance's estimate, (between - within) / (between + (size - 1) within), so the noise of
    small hosts does not count as a difference. 0 if no host has two documents, there is but one host, or hosts
    differ no more than by chance. Sums over hosts come to the driver.
    """
    documents = F.col("documents").cast("double")
    failures = {rule: F.col(f"{rule}_n").cast("double") for rule in RULES}
    sums = hosts.agg(
        F.count("*").alias("hosts"),
        F.sum(documents).alias("documents"),
        F.sum(documents * documents).alias("squares"),
        *(F.sum(failures[rule]).alias(f"{rule}_n") for rule in RULES),
        *(F.sum(failures[rule] * failures[rule] / documents).alias(f"{rule}_squares") for rule in RULES),
    ).first()
    if sums.hosts < 2 or sums.documents <= sums.hosts:
        return dict.fromkeys(RULES, 0.0)
    size = (sums.documents - sums.squares / sums.documents) / (sums.hosts - 1)
    found = {}
    for rule in RULES:
        failed, squares = sums[f"{rule}_n"], sums[f"{rule}_squares"]
        between = (squares - failed * failed / sums.documents) / (sums.hosts - 1)
        within = (failed - squares) / (sums.documents - sums.hosts)
        found[rule] = (between - within) / (between + (size - 1) * within) if between > within else 0.0
    return found


def host_verdicts(hosts: DataFrame) -> DataFrame:
    """host, documents, a shrunk rate for each rule, and bad, from host_counts; hosts is read three times.

    The beta prior of a rule has the hosts' mean rate, each host weighed by what it tells, and 1 / likeness - 1
    documents. A host's rate is the mean of its posterior, which is the prior mean itself where the likeness is 0.
    """
    alike = likeness(hosts)
    told = {rule: 1 + alike[rule] * (F.col("documents") - 1) for rule in RULES}
    means = hosts.agg(
        *((F.sum(F.col(f"{rule}_n") / told[rule]) / F.sum(F.col("documents") / told[rule])).alias(rule) for rule in RULES)
    ).first()
    shrunk = {}
    for rule in RULES:
        own, prior = alike[rule], (1 - alike[rule]) * (means[rule] or 0.0)
        shrunk[f"{rule}_rate"] = (own * F.col(f"{rule}_n") + prior) / (own * F.col("documents") + (1 - own))
    bad = F.greatest(*shrunk.values()) > MAX_HOST_RATE
    return hosts.select("host", "documents", *(rate.alias(name) for name, rate in shrunk.items()), bad.alias("bad"))


def host_rules(docs: DataFrame) -> DataFrame:
    """doc_id, host, the counts, base_failed, kept and the host's rates for every document.

    kept is false if the document fails a base rule or its host is bad. Failures are summed up before the shuffle, so
    a host may hold any share of the rows; verdicts, one row a host, are joined back and adaptive planning splits a
    large host. Null and empty texts have no words and fail; a null source is a host of its own; repeated rows count
    each; a null doc_id is like any other; an empty table gives no rows; other columns are left out.
    """
    rows = stored(document_rules(docs).withColumn("host", host_of(F.col("source"))).drop("source"), "document-rules")
    joined = rows.join(host_verdicts(stored(host_counts(rows), "host-counts")), "host", "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("bad"))
