"""Cleaning and spam rules against literal outcomes."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from postlens.functions import emoji, text as rules
from postlens.functions.spam import SpamLimits, grade
from postlens.functions.text import clean_text, raw_word_count, tokens, word_count
from postlens.operators.explore import spam_reason_breakdown
from postlens.plans.catalog import QUERIES
from postlens.session import BATCH, small_batches

# Text, cleaned text and spam reason, worked out by hand from the rules.
CASES = [
    ("", "", "TOO_SHORT"),
    ("   ", "", "TOO_SHORT"),
    ("one", "one", "TOO_SHORT"),
    ("two words", "two words", None),
    (
        "&lt;b&gt; Tom &amp;amp; Jerry &#39;quoted&#39; &copy; 2024 &eacute; &amp no semicolon",
        "b Tom amp Jerry 'quoted' copyright 2024 é no semicolon",
        None,
    ),
    ("ﬁne ① ² ½ Ⅳ ｆｕｌｌ ™ ㎏", "fine 1 2 1 2 IV full TM kg", None),
    (
        "so good 🚀🚀 angry 😡 love ❤️ thumbs 👍🏽 flag 🇺🇸 key 1️⃣ coder 👨\u200d💻 ✨",
        "so good rocket rocket angry enraged face love red heart thumbs thumbs up medium skin tone flag flag us "
        "key keycap 1 coder man technologist sparkles",
        None,
    ),
    (
        "snake_case https://a.b/c_d?e=f_g tail www.x_y.org @some_user.name-x #under_score",
        "snake case d?e f g tail y.org user user.name-x under score",
        None,
    ),
    ("HTTPS://UPPER.example/X Www.Mixed.example/y httpx://no http:// x", "httpx no http x", None),
    (
        "mail a.b_c%d+e-f@ex-ample.co.uk, x@y.z, é@host.org, under_a@b.com and end@host.museum.",
        "mail a.b , x user, é user, under and .",
        None,
    ),
    ("bad@host.c|m |pipe@host.a|b", "", "TOO_SHORT"),
    ("#CloudBrand is #1 #é_x # alone ##double", "CloudBrand is 1 é x alone double", None),
    ("nooo noooo " + "o" * 20 + " !!!!! \n\n\n\n\n ....", "nooo noo oo !! ..", "CHARACTER_FLOODING"),
    ("tabs\tand\nnew\r\nlines\x0b\x0c\x1c\x1d\x85\xa0\u2003\u2028 end", "tabs and new lines end", None),
    ("$100 €200 £300 (50%) [x] {y} <z> ~`^|\\/*=:;", "100 200 300 50 x y z", None),
    ("it's \"quoted\" semi-colon; dash - ok.", "it's \"quoted\" semi-colon dash - ok.", None),
    # Marks that are no letters are symbols, so vowel signs and joiners go.
    ("e\u0301 combining नमस्ते हिन्दी العربية 日本語 кириллица", "é combining नमस त ह न द العربية 日本語 кириллица", None),
    ("A" * 20 + " b", "AA b", "SHOUTING_RATIO"),
    ("ABCDEFGHIJKLMNO abcde", "ABCDEFGHIJKLMNO abcde", None),
    ("ABCDEFGHIJKLMNOP abcde", "ABCDEFGHIJKLMNOP abcde", "SHOUTING_RATIO"),
    (
        "FREE CRYPTO AIRDROP AIRDROP CLICK HERE TO CLAIM 1000 BTC NOW!!!",
        "FREE CRYPTO AIRDROP AIRDROP CLICK HERE TO CLAIM 1000 BTC NOW!!!",
        "SHOUTING_RATIO",
    ),
    ("get free crypto and an airdrop today", "get free crypto and an airdrop today", "SPAM_KEYWORD:airdrop"),
    ("passive income, click here to claim", "passive income, click here to claim", "SPAM_KEYWORD:passive income"),
    ("aaaaaaaaaa bcdefghijkl", "aa bcdefghijkl", "CHARACTER_FLOODING"),
    ("abababababababababab ababababab cdefghij", "abababababababababab ababababab cdefghij", None),
    ("see http://a.b and http://c.d", "see and", None),
    ("see http://a.b and http://c.d or www.e.f", "see and or", "EXCESSIVE_LINKS"),
    ("earn $ now my friend", "earn now my friend", "SPAM_KEYWORD:earn $"),
    ("please AIRDROP this is it", "please AIRDROP this is it", "SPAM_KEYWORD:airdrop"),
    ("please FREE CRYPTO this is it", "please FREE CRYPTO this is it", "SPAM_KEYWORD:free crypto"),
    ("please GIVEAWAY ALERT this is it", "please GIVEAWAY ALERT this is it", "SPAM_KEYWORD:giveaway alert"),
    ("please DM TO BUY this is it", "please DM TO BUY this is it", "SPAM_KEYWORD:dm to buy"),
    ("please WHATSAPP ME this is it", "please WHATSAPP ME this is it", "SPAM_KEYWORD:whatsapp me"),
    ("please TELEGRAM CHANNEL this is it", "please TELEGRAM CHANNEL this is it", "SPAM_KEYWORD:telegram channel"),
    ("please 100X GEM this is it", "please 100X GEM this is it", "SPAM_KEYWORD:100x gem"),
    ("please GUARANTEED PROFIT this is it", "please GUARANTEED PROFIT this is it", "SPAM_KEYWORD:guaranteed profit"),
    ("please WORK FROM HOME this is it", "please WORK FROM HOME this is it", "SPAM_KEYWORD:work from home"),
    ("please CLICK HERE TO CLAIM this is it", "please CLICK HERE TO CLAIM this is it", "SPAM_KEYWORD:click here to claim"),
]
SENTENCES = "The quick brown fox is here. "
LONG = [(SENTENCES * 104)[:2999] + "x", (SENTENCES * 104)[:3000] + "x"]


@pytest.fixture(scope="module")
def posts(spark):
    rows = [(n, case[0]) for n, case in enumerate(CASES)]
    return spark.createDataFrame(rows, "n int, text string").withColumn(
        "clean_text", clean_text(F.col("text"))
    )


def test_cleaning_of_every_case(posts):
    assert {row.n: row.clean_text for row in posts.collect()} == {n: case[1] for n, case in enumerate(CASES)}


def test_cleaning_of_no_text(spark):
    row = spark.sql("SELECT cast(NULL AS string) AS t").select(clean_text(F.col("t")).alias("c")).first()
    assert row.c == ""


def test_underscores_go_before_links_and_mentions(spark):
    row = spark.range(1).select(clean_text(F.lit("@a_b see http://x.y/c_d ok")).alias("c")).first()
    assert row.c == "user b see d ok"


def test_emoji_can_stay(spark):
    row = spark.range(1).select(clean_text(F.lit("a_b 🚀 c"), replace_emoji=False).alias("c")).first()
    assert row.c == "a_b c"


NAMES = {
    "🚀": "rocket", "👍🏽": "thumbs_up_medium_skin_tone", "👨\u200d💻": "man_technologist",
    "👩🏽\u200d🚀": "woman_astronaut_medium_skin_tone", "🏃\u200d♀️": "woman_running", "🙍🏿\u200d♂️": "man_frowning_dark_skin_tone",
    "❤️\u200d🔥": "heart_on_fire", "👨\u200d👩\u200d👧": "family_man_woman_girl", "🏴\u200d☠️": "pirate_flag", "1️⃣": "keycap_1",
    "©": "copyright", "®": "registered", "🎯": "bullseye", "🤖": "robot", "🚨": "police_car_light", "🛑": "stop_sign",
    "🔴": "red_circle", "🟢": "green_circle", "⌛": "hourglass_done", "⏳": "hourglass_not_done", "🆘": "SOS_button",
    "🆕": "NEW_button", "📧": "e-mail", "😂": "face_with_tears_of_joy", "😭": "loudly_crying_face", "🐶": "dog_face",
    "🎸": "guitar", "🐢": "turtle", "🍎": "red_apple", "🚲": "bicycle",
}


def test_emoji_names():
    for text, name in NAMES.items():
        assert emoji.demojize(text) == f" {name} "
    assert emoji.demojize("🧑\u200d🎄") == " person  christmas_tree "  # no rule: the parts
    assert len(emoji.name_table()) == len({c for c, _ in emoji.name_table()})


def test_spam_reason_of_every_case(posts):
    graded = grade(posts.withColumn("language", F.lit("en")))
    found = {row.n: (row.spam_reason, row.is_spam) for row in graded.collect()}
    assert found == {n: (case[2], case[2] is not None) for n, case in enumerate(CASES)}


def test_length_bound(spark):
    assert [len(t) for t in LONG] == [3000, 3001]
    df = spark.createDataFrame([(t, "en") for t in LONG], "text string, language string")
    rows = grade(df.withColumn("clean_text", F.col("text"))).collect()
    assert {len(r.text): r.spam_reason for r in rows} == {3000: None, 3001: "EXCESSIVE_LENGTH"}


def test_language_overrides_spam_reason(spark):
    rows = [("free crypto for all", "de"), ("free crypto for all", "unknown"), ("fine post", "en")]
    df = spark.createDataFrame(rows, "text string, language string").withColumn(
        "clean_text", F.col("text")
    )
    found = [r.spam_reason for r in grade(df).collect()]
    assert found == ["UNSUPPORTED_LANGUAGE:de", "SPAM_KEYWORD:free crypto", None]
    assert grade(df, supported=["de", "en"]).filter("language = 'de'").first().spam_reason == (
        "SPAM_KEYWORD:free crypto"
    )


def test_limits_are_parameters(spark):
    df = spark.createDataFrame([("short post", "en")], "text string, language string").withColumn(
        "clean_text", F.col("text")
    )
    assert grade(df, limits=SpamLimits(min_words=3)).first().spam_reason == "TOO_SHORT"


def test_words_and_tokens(spark):
    df = spark.createDataFrame([("",), ("Ab c d_e é1 x",), (" lead  and\ttabs ",)], "t string")
    rows = df.select(
        word_count(F.trim("t")).alias("clean"),
        raw_word_count(F.col("t")).alias("raw"),
        tokens(F.col("t")).alias("tokens"),
    ).collect()
    assert [r.raw for r in rows] == [0, 5, 3]
    assert rows[0].clean == 0
    assert rows[1].tokens == ["ab", "d_e", "é1"]


@pytest.mark.parametrize("name", ["clean_pages", "spam_reason_breakdown", "first_keyword"])
def test_python_gets_long_texts_in_small_batches(spark, name):
    for setting in BATCH:
        spark.conf.unset(setting)
    QUERIES[name](spark, "/root/testdata/sf0.001")

    @F.pandas_udf("long")
    def rows(batch: pd.Series) -> pd.Series:
        return pd.Series(len(batch), batch.index)

    assert spark.range(0, 3000, 1, 1).select(rows("id").alias("n")).agg(F.max("n")).first()[0] <= 256


def test_smaller_batches_of_the_caller_stay(spark):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(setting, "7")
    small_batches(spark)
    assert spark.conf.get(setting) == "7"
    spark.conf.set(setting, "0")
    small_batches(spark)
    assert spark.conf.get(setting) == BATCH[setting]


def test_spam_reasons_are_found_once(spark):
    plan = QUERIES["spam_reason_breakdown"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SHOUTING_RATIO") == 1
    rows = [("A", True), ("A", True), ("A", False), ("B", False), (None, True), (None, None)]
    graded = spark.createDataFrame(rows, "spam_reason string, is_spam boolean")
    assert sorted(spam_reason_breakdown(graded).collect(), key=str) == [("A", 2), (None, 1)]


def test_texts_are_cleaned_once_for_language_detection(spark):
    """Training and detection read written texts: nothing of the cleaning is left in the query's own plan."""
    plan = QUERIES["language_detection"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan
    assert "ArrowEvalPython" not in plan


def test_steps_skip_texts_without_their_sign_and_change_nothing_else(spark):
    texts = [None, "", "@", "a@b.co", "x@", "#", "#t a#b", "Www.x y", "://", "httpſ://a b", "wWw.", "www", "p.q@r.st @u", "plain words"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(1)
    t = F.col("t")
    pairs = [
        (rules.strip_urls(t), F.regexp_replace(t, rules.URL, "")),
        (rules.strip_emails(t), F.regexp_replace(t, rules.EMAIL, "")),
        (rules.name_mentions(t), F.regexp_replace(t, rules.MENTION, "@user")),
        (rules.unpack_hashtags(t), F.regexp_replace(t, rules.HASHTAG, "$1")),
    ]
    for step, plain in pairs:
        # The search stands behind a condition, which it did not before.
        assert "CASE WHEN" in df.select(step)._jdf.queryExecution().optimizedPlan().toString()
        assert df.where(step.eqNullSafe(plain)).count() == len(texts)


def test_emoji_search_is_spared_only_where_nothing_can_match():
    found = [*(chr(c) for a, b in emoji._spans() for c in (a, b)), "🇺🇸", "1️⃣", "#⃣", "👨\u200d💻"]
    for sign in found:
        assert emoji.may_hold_emoji("x" * emoji.PIECE_CHARS + sign)
        assert emoji.demojize(f"é{sign}") != f"é{sign}"
    assert not any(map(emoji.may_hold_emoji, ["", "é", "中文", "\U0010ffff", "\ud800", "a" * emoji.PIECE_CHARS]))
