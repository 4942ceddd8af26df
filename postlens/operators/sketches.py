"""Rollups that merge: a row for 15 minutes holds sketches, and longer periods come from those rows alone.

Distinct authors are an HLL sketch, scores a KLL sketch; counts and sums are exact. A day reads 96 rows a platform
in place of its posts. Null authors and scores are in no sketch; posts without a time are in no window.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.operators.filters import not_spam
from postlens.schemas import GRANULARITIES

# 2^12 registers: a standard error of 1.6 %.
AUTHOR_BITS = 12
# The rank of a KLL quantile is within 1.65 % with k = 200, 99 times of 100.
SCORE_K = 200
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
AUTHOR_BOUND = 0.05
RANK_BOUND = 0.02


def sketch_rollup(posts: DataFrame, granularity: str = "15min") -> DataFrame:
    """window_start, platform, posts, score_sum and the sketches authors and scores of posts that are no spam."""
    return (
        not_spam(posts)
        .groupBy(F.window("created_at", GRANULARITIES[granularity]).alias("w"), "platform")
        .agg(
            F.count(F.lit(1)).alias("posts"),
            F.sum("sentiment_score").alias("score_sum"),
            F.hll_sketch_agg("author_id", F.lit(AUTHOR_BITS)).alias("authors"),
            F.kll_sketch_agg_double(F.col("sentiment_score").cast("double"), F.lit(SCORE_K)).alias("scores"),
        )
        .select(F.col("w.start").alias("window_start"), "platform", "posts", "score_sum", "authors", "scores")
    )


def merged(rollups: DataFrame, granularity: str) -> DataFrame:
    """The same columns for longer windows, from rows of shorter ones, and `parts`, the rows that were merged."""
    return (
        rollups.groupBy(F.window("window_start", GRANULARITIES[granularity]).alias("w"), "platform")
        .agg(
            F.sum("posts").alias("posts"),
            F.sum("score_sum").alias("score_sum"),
            F.hll_union_agg("authors").alias("authors"),
            F.kll_merge_agg_double("scores").alias("scores"),
            F.count(F.lit(1)).alias("parts"),
        )
        .select(F.col("w.start").alias("window_start"), "platform", "posts", "score_sum", "authors", "scores", "parts")
    )


def quantile(scores: Column, share: float) -> Column:
    """Null where no score was met."""
    return F.when(F.kll_sketch_get_n_double(scores) > 0, F.kll_sketch_get_quantile_double(scores, F.lit(share)))


def read_out(rollups: DataFrame) -> DataFrame:
    """Estimates of a rollup: distinct authors and quartiles of scores."""
    return rollups.withColumns(
        {"authors": F.hll_sketch_estimate("authors"), **{name: quantile(F.col("scores"), s) for name, s in QUARTILES.items()}}
    ).drop("scores")


def accuracy(posts: DataFrame, estimates: DataFrame, granularity: str) -> DataFrame:
    """Exact posts and authors of each window beside whether the estimates keep to their bounds."""
    window = F.window("created_at", GRANULARITIES[granularity])["start"].alias("window_start")
    kept = not_spam(posts).select(window, "platform", "author_id", "sentiment_score")
    near = estimates.select("window_start", "platform", "parts", F.col("authors").alias("_authors"), *QUARTILES)
    score = F.col("sentiment_score")
    ranks = []
    for name, share in QUARTILES.items():
        below, upto = F.avg((score < F.col(name)).cast("double")), F.avg((score <= F.col(name)).cast("double"))
        ranks.append((below <= share + RANK_BOUND) & (upto >= share - RANK_BOUND))
    close = F.abs(F.first("_authors") - F.countDistinct("author_id")) <= AUTHOR_BOUND * F.countDistinct("author_id")
    return (
        kept.join(near, ["window_start", "platform"])
        .groupBy("window_start", "platform", "parts")
        .agg(
            F.count(F.lit(1)).alias("posts"),
            F.countDistinct("author_id").alias("unique_authors"),
            close.alias("authors_close"),
            (ranks[0] & ranks[1] & ranks[2]).alias("quartiles_close"),
        )
    )
