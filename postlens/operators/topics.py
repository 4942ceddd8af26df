"""Topic discovery: TF-IDF, NMF, embedding clusters, keywords, coherence and topic metrics.

What reaches the driver is model-sized: the vocabulary (max_features terms) and the topic-by-term
matrix. Documents stay distributed, and their rows are recomputed from the model, never stored
between rounds.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.feature import StopWordsRemover
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postlens.functions.numeric import rounded
from postlens.functions.text import tokens
from postlens.session import cut_lineage

OUTLIER = -1


def english_stop_words() -> list[str]:
    """Spark's own English list."""
    return StopWordsRemover.loadDefaultStopWords("english")


def content_tokens(text: Column, stop_words: list[str]) -> Column:
    words = tokens(text)
    return F.filter(words, lambda t: ~t.isin(stop_words)) if stop_words else words


def term_statistics(docs: DataFrame, words: str) -> DataFrame:
    """term, tf (all uses), df (documents): one pass, combined before the shuffle."""
    # All uses of a document, then each of its terms once.
    listed = docs.select(F.size(words).alias("uses"), F.posexplode(F.concat(words, F.array_distinct(words))).alias("at", "term"))
    is_use = F.col("at") < F.col("uses")
    return listed.groupBy("term").agg(F.count_if(is_use).alias("tf"), F.count_if(~is_use).alias("df"))


def vocabulary(
    docs: DataFrame, words: str, min_df: int = 2, max_df: float = 0.95, max_features: int = 1000
) -> tuple[list[tuple[str, int]], int]:
    """([(term, df)] of the most used terms, number of documents)."""
    count = docs.count()
    kept = (
        term_statistics(docs, words)
        .filter((F.col("df") >= min_df) & (F.col("df") <= max_df * count))
        .orderBy(F.desc("tf"), "term")
        .limit(max_features)
    )
    return [(row.term, row.df) for row in kept.select("term", "df").collect()], count


def tfidf(
    docs: DataFrame,
    text: str = "clean_text",
    stop_words: list[str] | None = None,
    min_df: int = 2,
    max_df: float = 0.95,
    max_features: int = 1000,
) -> tuple[DataFrame, list[str]]:
    """(docs with sparse vector `features` of unit length, terms in index order).

    Weight: uses * (ln((1 + documents) / (1 + df)) + 1). The transform is row-local.
    """
    stop_words = english_stop_words() if stop_words is None else stop_words
    prepared = docs.withColumn("_words", content_tokens(F.col(text), stop_words))
    chosen, count = vocabulary(prepared.select("_words"), "_words", min_df, max_df, max_features)
    terms = [term for term, _ in chosen]
    if not terms:
        empty = F.array().cast("array<double>")
        return prepared.withColumn("features", array_to_vector(empty)).drop("_words"), terms
    idf = [float(np.log((1 + count) / (1 + df)) + 1) for _, df in chosen]
    counter = CountVectorizerModel.from_vocabulary(terms, inputCol="_words", outputCol="_counts")
    weigh = ElementwiseProduct(
        scalingVec=Vectors.dense(idf), inputCol="_counts", outputCol="_weighted"
    )
    unit = Normalizer(p=2.0, inputCol="_weighted", outputCol="features")
    vectors = unit.transform(weigh.transform(counter.transform(prepared)))
    return vectors.drop("_words", "_counts", "_weighted"), terms


def sparse_parts(features: str = "features") -> list[Column]:
    """Index and value arrays of a sparse vector column."""
    inner = F.unwrap_udt(F.col(features))
    return [inner["indices"].alias("indices"), inner["values"].alias("values")]


def tfidf_rows(vectors: DataFrame, terms: list[str], key: str) -> DataFrame:
    """Long form: key, term, weight."""
    pairs = vectors.select(key, *sparse_parts())
    return pairs.select(
        key, F.explode(F.arrays_zip("indices", "values")).alias("p")
    ).select(
        key,
        F.element_at(F.array(*[F.lit(t) for t in terms]), F.col("p.indices") + 1).alias("term"),
        F.col("p.values").alias("weight"),
    )


# --- NMF -----------------------------------------------------------------------------------

TINY = 1e-12
DENSE_ROWS = 1000  # documents held as a dense block at a time
SPARE_DIRECTIONS = 8
POWER_PASSES = 2
EXACT = 1e-4  # weights are found to 1e-5, so a gradient under this is noise


@dataclass(frozen=True)
class Factors:
    """Topic-by-term matrix with rows of length 1, half the squared error, and whether the stop rule was met."""

    topics: np.ndarray
    objective: float
    iterations: int
    converged: bool


def _blocks(rows: pd.DataFrame, width: int) -> Iterator[np.ndarray]:
    """The sparse vectors of a batch as dense blocks; a null vector is zero."""
    for start in range(0, len(rows), DENSE_ROWS):
        block = rows.iloc[start : start + DENSE_ROWS]
        sizes = block["indices"].map(lambda x: 0 if x is None else len(x)).to_numpy()
        dense = np.zeros((len(block), width))
        if sizes.sum():
            at = np.concatenate([x for x in block["indices"] if x is not None])
            dense[np.repeat(np.arange(len(block)), sizes), at] = np.concatenate([x for x in block["values"] if x is not None])
        yield dense


def _summed(rows: DataFrame, width: int, shape: tuple[int, int], of_block: Callable) -> np.ndarray:
    """The sum of of_block (of that shape) over all documents: added in each task, then cell by cell in Spark."""

    def run(batches):
        total = np.zeros(shape)
        for batch in batches:
            for block in _blocks(batch, width):
                total += of_block(block)
        yield pd.DataFrame({"line": np.arange(shape[0]), "sums": list(total)})

    cells = (
        rows.mapInPandas(run, "line int, sums array<double>")
        .select("line", F.posexplode("sums").alias("at", "x"))
        .groupBy("line", "at")
        .agg(F.sum("x").alias("x"))
        .toPandas()
    )
    sums = np.zeros(shape)
    sums[cells["line"], cells["at"]] = cells["x"]
    return sums


def _nonnegative(gain: np.ndarray, gram: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """Rows x >= 0 of least x gram x / 2 - gain x, by coordinate descent until no step moves a hundred-thousandth."""
    x = np.zeros_like(gain) if start is None else start.copy()
    if not x.size:
        return x
    curve = np.maximum(gram.diagonal(), TINY)
    while True:
        moved = 0.0
        for j in range(len(gram)):
            new = np.maximum(x[:, j] + (gain[:, j] - x @ gram[:, j]) / curve[j], 0)
            moved = max(moved, float(np.abs(new - x[:, j]).max()))
            x[:, j] = new
        if moved <= 1e-5 * float(x.max()) + TINY:
            return x


def _document_weights(v: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The best topic weights of documents for a fixed topic matrix."""
    return _nonnegative(v @ h.T, h @ h.T)


def _unit(h: np.ndarray) -> np.ndarray:
    """Rows of length 1; rows of zeros stay."""
    return h / np.maximum(np.linalg.norm(h, axis=1, keepdims=True), TINY)


def _svd_start(rows: DataFrame, width: int, topics: int, seed: int) -> np.ndarray:
    """Non-negative halves of the leading right singular vectors.

    The vectors come from a randomised subspace iteration, whose passes sum width x (topics + 8) numbers. Of a
    direction's positive and negative half the one that explains more is taken, by the lengths of both its sides.
    """
    found = min(width, topics + SPARE_DIRECTIONS)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, found)))[0]
    for _ in range(POWER_PASSES):
        q = np.linalg.qr(_summed(rows, width, (width, found), lambda v: v.T @ (v @ q)))[0]
    small = _summed(rows, width, (found, found), lambda v: (v @ q).T @ (v @ q))
    right = (q @ np.linalg.eigh(small)[1][:, ::-1][:, :topics]).T

    def halves(v):
        left = v @ right.T
        return np.stack([(np.maximum(left, 0) ** 2).sum(axis=0), (np.minimum(left, 0) ** 2).sum(axis=0)])

    sides = _summed(rows, width, (2, topics), halves)
    plus, minus = np.maximum(right, 0), np.maximum(-right, 0)
    better = sides[0] * (plus**2).sum(axis=1) >= sides[1] * (minus**2).sum(axis=1)
    return _unit(np.where(better[:, None], plus, minus))


def nmf(vectors: DataFrame, width: int, topics: int, rounds: int = 200, tol: float = 5e-3, seed: int = 42) -> Factors:
    """A non-negative factorisation of the TF-IDF rows.

    A round is one pass: tasks find the best weights of their documents for the current matrix and send topic-sized
    sums, from which the driver finds the best matrix for those weights. The next matrix lies further in the direction
    of that step, and the more so the longer the error falls. It has converged when the projected gradient is at most
    tol of that of the start, or EXACT of the sums it is the difference of; after so many rounds it ends unconverged
    and says so.
    """
    rows = vectors.select(*sparse_parts()).persist()
    kept = plain = tried = _svd_start(rows, width, topics, seed)
    objective, first, reach, done, converged = np.inf, None, 0.5, 0, False
    while done < rounds and not converged:

        def sums(v, h=tried):
            w = _document_weights(v, h)
            return np.concatenate([w.T @ v, w.T @ w, np.full((topics, 1), (v**2).sum())], axis=1)

        total = _summed(rows, width, (topics, width + topics + 1), sums)
        wv, ww, length = total[:, :width], total[:, width:-1], total[0, -1]
        done += 1
        error = float(length - 2 * (wv * tried).sum() + (ww * (tried @ tried.T)).sum()) / 2
        if error > objective and tried is not plain:
            tried, reach = plain, reach / 2
            continue
        kept, objective = tried, error
        slope = ww @ tried - wv
        steep = float(np.linalg.norm(np.where(tried > 0, slope, np.minimum(slope, 0))))
        first = steep if first is None else first
        converged = steep <= max(tol * first, EXACT * float(np.linalg.norm(wv)))
        before, plain = plain, _unit(_nonnegative(wv.T, ww, tried.T).T)
        tried, reach = _unit(np.maximum(plain + reach * (plain - before), 0)), min(1.0, 1.1 * reach)
    rows.unpersist()
    return Factors(kept, objective, done, converged)


def document_weights(vectors: DataFrame, key: str, h: np.ndarray) -> DataFrame:
    """key, weights: the best weight of every topic for each document."""

    def run(batches):
        for rows in batches:
            found = [_document_weights(block, h) for block in _blocks(rows, h.shape[1])]
            yield pd.DataFrame({key: rows[key], "weights": [w for block in found for w in block]})

    return vectors.select(key, *sparse_parts()).mapInPandas(run, f"{key} string, weights array<double>")


def assign_topics(vectors: DataFrame, key: str, h: np.ndarray) -> DataFrame:
    """key, topic_id: the topic with the largest weight, the first of equal ones."""
    largest = F.array_position("weights", F.array_max("weights")).cast("int") - 1
    return document_weights(vectors, key, h).select(key, largest.alias("topic_id"))


def topic_terms(h: np.ndarray, terms: list[str], k: int = 10) -> list[list[str]]:
    """The k heaviest terms of each topic, ties by term order."""
    return [[terms[i] for i in np.argsort(-row, kind="stable")[:k]] for row in h]


def topic_rows(spark, h: np.ndarray, terms: list[str]) -> DataFrame:
    """topic_id, term, weight: the topic matrix, zeros left out."""
    rows = [(int(i), terms[j], float(h[i, j])) for i, j in zip(*h.nonzero())]
    return spark.createDataFrame(rows, "topic_id int, term string, weight double")


@dataclass(frozen=True)
class Discovered:
    """Documents with their topic, their vectors, the vocabulary, the heaviest terms per topic, and the factors."""

    assigned: DataFrame
    vectors: DataFrame
    vocabulary: list[str]
    terms: list[list[str]]
    factors: Factors


def factor_topics(
    docs: DataFrame,
    key: str = "post_id",
    text: str = "clean_text",
    nr_topics: int = 10,
    stop_words: list[str] | None = None,
    max_features: int = 1000,
    **options,
) -> Discovered:
    """Topics of docs by a factorisation of their TF-IDF rows. Without a term there are no topics."""
    vectors, vocabulary = tfidf(docs.select(key, text), text, stop_words, max_features=max_features)
    vectors = cut_lineage(vectors)
    count = vectors.count()
    if not count or not vocabulary:
        none = Factors(np.zeros((0, len(vocabulary))), 0.0, 0, True)
        return Discovered(vectors.limit(0).select(key, F.lit(0).alias("topic_id")), vectors, vocabulary, [], none)
    topics = min(nr_topics, max(2, count // 10), len(vocabulary))
    factors = nmf(vectors, len(vocabulary), topics, **options)
    assigned = assign_topics(vectors, key, factors.topics)
    return Discovered(assigned, vectors, vocabulary, topic_terms(factors.topics, vocabulary), factors)


def discover_topics(docs: DataFrame, **options) -> tuple[DataFrame, list[list[str]]]:
    """(key, topic_id per document; heaviest terms per topic) of factor_topics."""
    found = factor_topics(docs, **options)
    return found.assigned, found.terms


def embedding_topics(
    vectors: DataFrame,
    embedding: str = "embedding",
    nr_topics: int = 10,
    min_size: int = 15,
    seed: int = 42,
) -> DataFrame:
    """Add topic_id from clustering the given embeddings; clusters under min_size become -1."""
    prepared = vectors.withColumn(
        "_features", array_to_vector(F.col(embedding).cast("array<double>"))
    )
    model = KMeans(k=nr_topics, seed=seed, featuresCol="_features", predictionCol="_cluster").fit(
        prepared
    )
    # Cluster sizes are known from training: one number per cluster.
    kept = [i for i, size in enumerate(model.summary.clusterSizes) if size >= min_size]
    topic = F.when(F.col("_cluster").isin(kept), F.col("_cluster")).otherwise(F.lit(OUTLIER))
    return model.transform(prepared).withColumn("topic_id", topic).drop("_features", "_cluster")


# --- keywords ------------------------------------------------------------------------------


def ctfidf(docs: DataFrame, topic: str, text: str, stop_words: list[str] | None = None) -> DataFrame:
    """topic, term, weight: uses in the topic * ln(1 + mean words per topic / uses in all)."""
    stop_words = english_stop_words() if stop_words is None else stop_words
    # Counts are needed three times, the texts should be read once.
    uses = cut_lineage(
        docs.select(topic, F.explode(content_tokens(F.col(text), stop_words)).alias("term"))
        .groupBy(topic, "term")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    overall = uses.groupBy("term").agg(F.sum("uses").alias("all_uses"))
    mean_words = uses.agg(F.sum("uses") / F.count_distinct(topic)).scalar()
    return uses.join(overall, "term").select(
        topic,
        "term",
        (F.col("uses") * F.log1p(mean_words / F.col("all_uses"))).alias("weight"),
    )


def top_terms(weights: DataFrame, topic: str, k: int = 10) -> DataFrame:
    """topic, rank, term, weight of the k heaviest terms.

    Spark cuts each task's terms to k per topic before the shuffle.
    """
    order = W.partitionBy(topic).orderBy(F.desc("weight"), "term")
    return weights.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def keyword_lists(ranked: DataFrame, topic: str, kept: int = 8) -> DataFrame:
    """topic, top_keywords (in rank order) and topic_label from the first two."""
    pairs = F.array_sort(F.collect_list(F.struct("rank", "term")))
    return (
        ranked.filter(F.col("rank") <= kept)
        .groupBy(topic)
        .agg(pairs.getField("term").alias("top_keywords"))
        .withColumn("topic_label", topic_label(F.col("top_keywords")))
    )


def topic_label(keywords: Column) -> Column:
    """The first two keywords, every run of letters with a capital first: "k8s" becomes "K8S"."""
    name = F.array_join(F.slice(keywords, 1, 2), " & ")
    runs = F.regexp_extract_all(name, F.lit(r"\p{L}+|\P{L}+"), 0)
    return F.array_join(F.transform(runs, F.initcap), "")


def keyword_frame(spark, terms: list[list[str]], kept: int = 8) -> DataFrame:
    """topic_id, top_keywords, topic_label from a model's term lists."""
    rows = [(i, words[:kept]) for i, words in enumerate(terms)]
    frame = spark.createDataFrame(rows, "topic_id int, top_keywords array<string>")
    label = F.when(F.size("top_keywords") > 0, topic_label(F.col("top_keywords")))
    return frame.withColumn(
        "topic_label", F.coalesce(label, F.concat(F.lit("Topic "), "topic_id"))
    )


# --- metrics -------------------------------------------------------------------------------


def topic_metrics(assigned: DataFrame, samples: int = 2) -> DataFrame:
    """Size, label ratios, mean score and sample texts per topic; outliers are left out.

    assigned: post_id, topic_id, clean_text, sentiment_label, sentiment_score. The samples are
    the texts of the lowest post ids, cut to that number before the shuffle.
    """
    kept = assigned.filter(F.col("topic_id") != OUTLIER)
    size = F.count(F.lit(1))
    metrics = kept.groupBy("topic_id").agg(
        size.alias("post_count"),
        rounded(F.count_if(F.col("sentiment_label") == "positive") / size, 4).alias(
            "positive_ratio"
        ),
        rounded(F.count_if(F.col("sentiment_label") == "negative") / size, 4).alias(
            "negative_ratio"
        ),
        rounded(F.avg("sentiment_score"), 4).alias("mean_sentiment"),
    )
    first = F.row_number().over(W.partitionBy("topic_id").orderBy("post_id"))
    sampled = (
        kept.withColumn("n", first)
        .filter(F.col("n") <= samples)
        .groupBy("topic_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("n", "clean_text")))
            .getField("clean_text")
            .alias("representative_samples")
        )
    )
    return metrics.join(sampled, "topic_id").orderBy(F.desc("post_count"), "topic_id")


def topic_clusters(
    assigned: DataFrame, keywords: DataFrame, run_date, coherence: DataFrame | None = None
) -> DataFrame:
    """Rows of the topic table for one run; coherence_score is null without coherence (topic_id, coherence)."""
    rows = topic_metrics(assigned).join(F.broadcast(keywords), "topic_id", "left")
    if coherence is None:
        rows = rows.withColumn("coherence", F.lit(None).cast("double"))
    else:
        rows = rows.join(coherence, "topic_id", "left")
    return rows.select(
        F.lit(str(run_date)).cast("date").alias("run_date"),
        "topic_id",
        F.coalesce("topic_label", F.concat(F.lit("Topic "), "topic_id")).alias("topic_label"),
        F.coalesce("top_keywords", F.array().cast("array<string>")).alias("top_keywords"),
        F.col("coherence").alias("coherence_score"),
        "post_count",
        "positive_ratio",
        "negative_ratio",
        "mean_sentiment",
        "representative_samples",
    )


def topic_coherence(docs: DataFrame, text: str, terms: list[list[str]]) -> DataFrame:
    """topic_id, coherence: mean NPMI over pairs of a topic's top terms, counted over documents.

    A document is compared with the few listed terms only, so it yields at most one row per
    listed pair and the counts are combined before the shuffle. No topics give no rows.
    """
    if not terms:
        return docs.sparkSession.createDataFrame([], "topic_id int, coherence double")
    # Few words of a document are listed, so they are picked out before anything is compared.
    all_terms = sorted({t for topic in terms for t in topic})
    words = F.array_distinct(F.filter(tokens(F.col(text)), lambda t: t.isin(all_terms)))
    listed = docs.select(words.alias("words"))
    found = F.concat(
        *[
            F.array(
                F.struct(
                    F.lit(i).alias("topic_id"),
                    F.array_sort(
                        F.array_intersect(F.col("words"), F.array(*[F.lit(t) for t in topic]))
                    ).alias("hits"),
                )
            )
            for i, topic in enumerate(terms)
        ]
    )
    per_topic = listed.select(F.explode(found).alias("f")).select("f.topic_id", "f.hits")
    longest = max(len(topic) for topic in terms)
    events = F.flatten(
        F.transform(
            "hits",
            lambda a, i: F.transform(
                F.slice("hits", i + 1, longest), lambda b: F.struct(a.alias("a"), b.alias("b"))
            ),
        )
    )
    # Topics * terms^2 rows, needed three times; the texts are read once.
    counts = cut_lineage(
        per_topic.select("topic_id", F.explode(events).alias("e"))
        .groupBy("topic_id", "e.a", "e.b")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    single = counts.filter(F.col("a") == F.col("b")).select("topic_id", F.col("a").alias("t"), "n")
    # Topics * terms rows on each side from here on.
    pairs = single.alias("x").join(
        single.alias("y"),
        (F.col("x.topic_id") == F.col("y.topic_id")) & (F.col("x.t") < F.col("y.t")),
    ).select(
        F.col("x.topic_id"),
        F.col("x.t").alias("a"),
        F.col("y.t").alias("b"),
        F.col("x.n").alias("na"),
        F.col("y.n").alias("nb"),
    )
    total = docs.agg(F.count(F.lit(1)).cast("double")).scalar()
    joint = F.coalesce("n", F.lit(0)) / total
    npmi = F.when(joint == 0, -1.0).when(joint >= 1, 1.0).otherwise(
        F.log(joint / ((F.col("na") / total) * (F.col("nb") / total))) / -F.log(joint)
    )
    return (
        pairs.join(counts, ["topic_id", "a", "b"], "left")
        .groupBy("topic_id")
        .agg(rounded(F.avg(npmi), 4).alias("coherence"))
    )
