"""The automaton against one test for each phrase, with ten and with ten thousand phrases."""

import random
import time

from pyspark.sql import functions as F

from postlens.functions.phrases import first_phrase
from postlens.plans.catalog import QUERIES
from postlens.plans.oracle import ORACLE
from tests.compare import connect, difference


def texts(rows=3000):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdeÉ") for _ in range(rng.randint(1, 6)))
    return [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(rows)], [f"{word()} {word()}" for _ in range(10000)]


def found(spark, rows, phrases):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "id int, text string")
    return {r.id: r.p for r in df.select("id", first_phrase(spark, F.col("text"), phrases).alias("p")).collect()}


def test_equals_one_test_for_each_phrase(spark):
    rows, phrases = texts()
    for listed in (phrases[:10], phrases):
        plain = {i: next((p for p in listed if p.lower() in t.lower()), None) for i, t in enumerate(rows[:400])}
        assert found(spark, rows[:400], listed) == plain
        assert any(plain.values())


def test_ten_thousand_phrases_cost_little_more_than_ten(spark):
    rows, phrases = texts()
    seconds = {}
    for n in (10, 10000):
        found(spark, rows, phrases[:n])
        started = time.perf_counter()
        found(spark, rows, phrases[:n])
        seconds[n] = time.perf_counter() - started
    assert seconds[10000] < 2 * seconds[10]


def test_odd_texts_and_phrases(spark):
    rows = [None, "", "ABC", "x" * 200000 + "abc", "abc abd"]
    assert list(found(spark, rows, ["abd", "Abc", "abc"]).values()) == [None, None, "Abc", "Abc", "abd"]
    assert list(found(spark, rows, []).values()) == [None] * 5
    assert list(found(spark, rows, ["abd", ""]).values()) == [None, None, "", "", "abd"]


def test_query_equals_its_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    name = "first_keyword"
    assert difference(spark, connect(sf_dir), sf_dir, QUERIES[name], ORACLE[name]) is None
