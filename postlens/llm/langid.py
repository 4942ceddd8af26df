"""Language of a text from averaged hashed subword embeddings and a linear softmax."""

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import held_out, stored, thinned

UNKNOWN = "und"
BUCKET_BITS = 16
DIMENSIONS = 16
SUBWORDS = (3, 4)
EPOCHS = 4
RATE = 0.5
EMBEDDING_RATE = 16
# The model is fitted on so many documents of each language, those with the smallest hashed doc_id, and on a
# stretch of so many characters of each, its start drawn by the same hash; a fifth of them calibrate.
SAMPLE_DOCUMENTS = 800
SAMPLE_CHARS = 4000
CALIBRATION_SHARE = 5
# Rejection lets this share of rightly named calibration documents go.
CLEAN_LOSS = 0.001
SEGMENT_CHARS = 1 << 20
LETTER = regex.compile(r"\p{L}")
# Letters of the first code points as lower case letters, all else as a space.
FOLDED = np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else 32 for c in range(0x250)], dtype=np.uint32)
MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def subwords(text: str) -> np.ndarray:
    """Buckets of all runs of SUBWORDS characters; what is no letter counts as a space."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    low = codes < len(FOLDED)
    folded = np.where(low, FOLDED[np.where(low, codes, 0)], codes)
    inner = np.flatnonzero((folded[1:] != 32) | (folded[:-1] != 32)) if len(folded) > 1 else np.empty(0, int)
    folded = np.concatenate([[32], folded[inner], folded[-1:], [32]]).astype(np.uint64)
    buckets, mixed = [], np.zeros(len(folded), dtype=np.uint64)
    for size in range(1, max(SUBWORDS) + 1):
        if len(folded) < size:
            break  # the empty text
        mixed = (mixed[: len(folded) - size + 1] ^ folded[size - 1 :]) * MIX[size - 1]
        mixed ^= mixed >> np.uint64(31)
        if size in SUBWORDS:
            buckets.append((mixed * MIX[0]) >> np.uint64(64 - BUCKET_BITS))
    return np.concatenate([*buckets, np.empty(0, np.uint64)]).astype(np.int64)


class LanguageModel:
    """Class weights of every bucket (embeddings times the softmax matrix), shifts, temperature and threshold."""

    def __init__(self, languages, table, shifts, temperature=1.0, threshold=0.0):
        self.languages, self.table, self.shifts = languages, table, shifts
        self.temperature, self.threshold = temperature, threshold

    def logits(self, text):
        total, count = np.zeros(len(self.languages)), 0
        for start in range(0, len(text), SEGMENT_CHARS):
            buckets = subwords(text[start : start + SEGMENT_CHARS])
            total += self.table[buckets].sum(axis=0, dtype=np.float64)
            count += len(buckets)
        return total / max(1, count) + self.shifts

    def chances(self, text):
        x = self.logits(text) / self.temperature
        e = np.exp(x - x.max())
        return e / e.sum()

    def __call__(self, text):
        """(language, score); `und` and 0 without a letter or without a model."""
        if not text or not self.languages or not LETTER.search(text):
            return UNKNOWN, 0.0
        chances = self.chances(text)
        best = int(chances.argmax())
        return self.languages[best], float(chances[best])


def train(samples: list[tuple[str, str]], seed: int = 7) -> LanguageModel:
    """Stochastic gradient descent, one text at a time, at a falling rate; then calibration on every fifth text.

    samples are (language, text). Ties go to the language that sorts first.
    """
    languages = sorted({language for language, _ in samples})
    if not languages:
        return LanguageModel([], None, None)
    place = {language: k for k, language in enumerate(languages)}
    rng = np.random.default_rng(seed)
    fit = [s for k, s in enumerate(samples) if k % CALIBRATION_SHARE] or samples
    held = samples[::CALIBRATION_SHARE]
    rows = [(*np.unique(subwords(text), return_counts=True), place[language]) for language, text in fit]
    embeddings = rng.uniform(-1, 1, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    matrix, shifts = np.zeros((DIMENSIONS, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            buckets, counts, label = rows[k]
            rate, done = RATE * (1 - done / steps), done + 1
            shares = (counts / counts.sum()).astype(np.float32)
            mean = shares @ embeddings[buckets]
            x = mean @ matrix + shifts
            wrong = np.exp(x - x.max())
            wrong /= wrong.sum()
            wrong[label] -= 1
            back = matrix @ wrong
            matrix -= rate * np.outer(mean, wrong)
            shifts -= 0.1 * rate * wrong
            embeddings[buckets] -= EMBEDDING_RATE * rate * np.outer(shares, back)
    model = LanguageModel(languages, (embeddings @ matrix).astype(np.float32), shifts.astype(np.float64))
    calibrate(model, held, place)
    return model


def calibrate(model, held, place):
    """Temperature of the least log loss, then the threshold of rejection."""
    logits = np.array([model.logits(text) for _, text in held])
    labels = np.array([place[language] for language, _ in held])

    def loss(temperature):
        x = logits / temperature
        x = x - x.max(axis=1, keepdims=True)
        return (np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(x)), labels]).mean()

    model.temperature = float(min(np.geomspace(0.02, 10, 120), key=loss))
    x = np.exp((logits - logits.max(axis=1, keepdims=True)) / model.temperature)
    best = (x / x.sum(axis=1, keepdims=True)).max(axis=1)[logits.argmax(axis=1) == labels]
    model.threshold = float(min(np.quantile(best, CLEAN_LOSS, method="lower"), 0.5)) if len(best) else 0.0


def fit_model(docs: DataFrame) -> LanguageModel:
    """Learn from text and language of documents outside the held-out third.

    The sample is bounded (SAMPLE_DOCUMENTS a language, SAMPLE_CHARS a document), so the driver holds as much
    whatever the table's size. Rows without language or letters teach nothing.
    """
    hashed = F.xxhash64("doc_id")
    by_hash = Window.partitionBy("lang").orderBy(hashed, "doc_id")
    known = docs.select("doc_id", "lang").where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    )
    chosen = thinned(known, SAMPLE_DOCUMENTS, "lang").withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= SAMPLE_DOCUMENTS)
    start = F.pmod(hashed, F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(1))).cast("int") + 1
    texts = docs.select("doc_id", F.substring("text", start, F.lit(SAMPLE_CHARS)).alias("text"))
    # SAMPLE_DOCUMENTS rows for each language are sent to all tasks.
    sample = texts.join(F.broadcast(chosen.drop("place").dropDuplicates()), "doc_id")
    rows = stored(sample, "language-sample").orderBy(hashed, "doc_id", "lang", "text").collect()
    return train([(r.lang, r.text) for r in rows if r.text and LETTER.search(r.text)])


def language(model: LanguageModel) -> Column:
    """Struct of the column `text`: lang_pred, score, rejected.

    A text that is null or has no letter is `und` with score 0 and rejected; others are rejected if the
    score is under the model's threshold. Without a model all are `und`.
    """

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        named = [model(text) for text in texts]
        frame = pd.DataFrame(named, columns=["lang_pred", "score"])
        frame["rejected"] = (frame["lang_pred"] == UNKNOWN) | (frame["score"] < model.threshold)
        return frame

    return predict("text")
