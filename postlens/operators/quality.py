"""Constraint checks: the rules the tables promise, counted in one pass per table."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.schemas import ALERT_STATUSES, ASPECT_KEY, ASPECTS, GRANULARITIES, LABELS, PLATFORMS, POST_KEY


@dataclass(frozen=True)
class Rules:
    """required: not-null columns. checks: name -> condition, NULL passing as in SQL.
    unique: key columns."""

    required: list[str] = field(default_factory=list)
    checks: dict[str, str] = field(default_factory=dict)
    unique: list[str] = field(default_factory=list)


def one_of(column: str, values) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"{column} IN ({listed})"


RAW_POST_RULES = Rules(
    required=["post_id", "platform", "author_id", "raw_text", "created_at"],
    checks={
        "platform_known": one_of("platform", PLATFORMS),
        "post_id_length": "char_length(post_id) <= 128",
        "author_id_length": "char_length(author_id) <= 255",
    },
    unique=POST_KEY,
)
SENTIMENT_POST_RULES = Rules(
    required=[
        "post_id",
        "platform",
        "author_id",
        "clean_text",
        "sentiment_label",
        "sentiment_score",
        "confidence",
        "created_at",
    ],
    checks={
        "platform_known": one_of("platform", PLATFORMS),
        "label_known": one_of("sentiment_label", LABELS),
        "score_range": "sentiment_score BETWEEN -1 AND 1",
        "confidence_range": "confidence BETWEEN 0 AND 1",
    },
    unique=POST_KEY,
)
ASPECT_RULES = Rules(
    required=[*ASPECT_KEY, "sentiment_label", "sentiment_score", "confidence"],
    checks={
        "aspect_known": one_of("aspect", ASPECTS),
        "label_known": one_of("sentiment_label", LABELS),
    },
    unique=ASPECT_KEY,
)
METRIC_RULES = Rules(
    required=["window_start", "window_end", "granularity", "platform"],
    checks={"granularity_known": one_of("granularity", GRANULARITIES)},
    unique=["granularity", "platform", "window_start"],
)
ALERT_RULES = Rules(
    required=["platform", "window_start", "window_end", "status"],
    checks={"status_known": one_of("status", ALERT_STATUSES)},
    unique=["alert_id"],
)
TOPIC_RULES = Rules(
    required=["run_date", "topic_id", "topic_label", "post_count"], unique=["run_date", "topic_id"]
)
INFLUENCE_RULES = Rules(
    required=["author_id", "platform"], unique=["platform", "author_id", "calculated_at"]
)


def breaches(rules: Rules) -> dict[str, Column]:
    """Name -> true where a row breaks the rule."""
    found = {f"{c}_present": F.col(c).isNull() for c in rules.required}
    for name, condition in rules.checks.items():
        found[name] = F.coalesce(~F.expr(condition), F.lit(False))
    return found


def check_constraints(df: DataFrame, rules: Rules) -> DataFrame:
    """rule, violations: row rules in one aggregate, uniqueness as the surplus copies of keys."""
    found = breaches(rules)
    row_rules = df.agg(*[F.count_if(bad).alias(name) for name, bad in found.items()])
    report = row_rules.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in found]
            )
        ).alias("r")
    ).select("r.rule", "r.violations")
    if rules.unique:
        report = report.unionByName(
            df.groupBy(*rules.unique)
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(
                F.lit("unique_" + "_".join(rules.unique)).alias("rule"),
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"),
            )
        )
    return report


def check_foreign_key(child: DataFrame, parent: DataFrame, keys: list[str], name: str) -> DataFrame:
    """rule, violations: child rows without a parent."""
    return orphans(child, parent, keys).agg(
        F.lit(name).alias("rule"), F.count(F.lit(1)).alias("violations")
    )


def orphans(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    return child.join(parent.select(*keys), keys, "left_anti")


def quarantine(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with the names of the broken rules)."""
    names = F.array_compact(
        F.array(*[F.when(bad, F.lit(name)) for name, bad in breaches(rules).items()])
    )
    marked = df.withColumn("broken_rules", names)
    good = marked.filter(F.size("broken_rules") == 0).drop("broken_rules")
    return good, marked.filter(F.size("broken_rules") > 0)
