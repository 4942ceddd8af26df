"""Language detection: naive Bayes over character pairs and triples, trained on labelled texts.

Training counts grams, scoring is row-local; the model is languages x grams, and grams are the most
frequent ones of two or more training texts.
"""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import CountVectorizer, IndexToString, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.text import clean_text, word_count

MIN_WORDS = 3


def _with_grams(df: DataFrame, text: str) -> DataFrame:
    """All overlapping pairs and triples of characters, the ends of the text included."""
    padded = F.concat(F.lit(" "), F.lower(F.col(text)), F.lit(" "))
    grams = [F.regexp_extract_all(padded, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in (2, 3)]
    return df.withColumn("_grams", F.concat(*grams))


def train_language_model(
    labelled: DataFrame, text: str = "clean_text", language: str = "language", features: int = 1 << 18
) -> PipelineModel:
    indexer = StringIndexer(inputCol=language, outputCol="_label", stringOrderType="alphabetAsc")
    fitted = indexer.fit(labelled)
    pipeline = Pipeline(
        stages=[
            CountVectorizer(vocabSize=features, minDF=2.0, inputCol="_grams", outputCol="_features"),
            NaiveBayes(featuresCol="_features", labelCol="_label", predictionCol="_language_ix"),
            IndexToString(
                inputCol="_language_ix", outputCol="_detected", labels=list(fitted.labels)
            ),
        ]
    )
    return pipeline.fit(_with_grams(fitted.transform(labelled), text))


def detect_language(df: DataFrame, model: PipelineModel, text: str = "clean_text") -> DataFrame:
    """Add `language`; texts under three words count as English, empty ones too."""
    scored = model.transform(_with_grams(df, text))
    short = word_count(F.col(text)) < MIN_WORDS
    language = F.when(short, F.lit("en")).otherwise(F.coalesce("_detected", F.lit("unknown")))
    return scored.withColumn("language", language).select(*df.columns, "language")


def with_clean_text(posts: DataFrame, text: str = "text", replace_emoji: bool = True) -> DataFrame:
    return posts.withColumn("clean_text", clean_text(F.col(text), replace_emoji))
