"""Spelling groups against all pairs of words, and rows that tables seldom hold."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from postlens.llm import queries, spelling
from postlens.llm.common import stored
from tests.compare import connect, difference

SCHEMA = "doc_id bigint, text string, word string, n long, form string"


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
                run = ""
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_groups(rows):
    words = plain_words(rows)
    near = {a: [b for b in words if abs(len(a) - len(b)) < 2 and plain_distance(a, b) == 1] for a in words}
    form = {}
    for a, others in near.items():
        best = min(others, key=lambda b: (-words[b], b.encode()), default=None)
        form[a] = best if best is not None and words[best] >= 10 * words[a] else None
    out = set()
    for a in words:
        root = a
        while form[root]:
            root = form[root]
        out.add((a, words[a], len(near[a]), form[a], words[form[a]] if form[a] else None, root))
    return out


def groups(df):
    return [tuple(r) for r in spelling.spelling_groups(df).select("word", "n", "n_near", "form", "form_n", "root").collect()]


def variants(seed, count):
    """Words of few letters, so that many are near, each some times; one word holds a third of all rows."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(60)]
    rows = []
    for i in range(count):
        words = []
        for _ in range(6):
            w = list(rng.choice(base))
            if rng.random() < 0.4:
                w[rng.randrange(len(w))] = rng.choice(["", "a", "bb", "ÿ"])
            words.append("".join(w))
        rows.append((i, " ".join([*words, "Frequents", "frequents"]) + rng.choice([".", "\n", "1", ""])))
    return rows


def test_equals_all_pairs(spark):
    rows = variants(3, 400)
    found = groups(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert len(found) == len(set(found))
    assert set(found) == plain_groups(rows)
    assert sum(r[3] is not None for r in found) > 3


def test_query_equals_its_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    name = "op13_spelling_groups"
    assert difference(spark, connect(sf_dir), sf_dir, queries.QUERIES[name], queries.ORACLE[name]) is None


def test_bound_covers_every_edit():
    """Near words share all grams but bound many, whatever the edit, and are met in a list."""
    rng = random.Random(8)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(7, 12))) for _ in range(3000)}
    grams = Counter(w[i : i + q] for w in words for q in (2, 3, 4) for i in range(len(w) - q + 1))
    frequent = {g: n for g, n in grams.items() if n > 40}
    listed = spelling.lister(frequent)

    def lists(word):
        rows = np.concatenate([spelling.list_parts(len(word), i, j) for i, j in listed(word)])
        return {(k, word[a - 1 : a - 1 + b], word[c - 1 : c - 1 + d]): s for k, s, a, b, c, d in rows.tolist()}

    for word in list(words)[:1500]:
        x = rng.randrange(len(word))
        other = rng.choice([word[:x] + word[x + 1 :], word[:x] + "abc"[rng.randrange(3)] + word[x + 1 :], word[:x] + "c" + word[x:]])
        if other == word or len(other) < 7:
            continue
        a, b = spelling.decompose(word, frequent), spelling.decompose(other, frequent)
        shared = sum((Counter(g for _, g in a) & Counter(g for _, g in b)).values())
        assert shared >= max(len(a) - spelling.affected(a, len(word)), len(b) - spelling.affected(b, len(other)))
        ours, theirs = lists(word), lists(other)
        assert any(ours[k] or theirs[k] for k in ours.keys() & theirs.keys())


def test_longer_grams_only_where_frequent():
    frequent = {"^a": 9, "ab": 9, "abc": 9}
    assert spelling.decompose("abcd", frequent) == [(0, "^ab"), (1, "abcd"), (2, "bc"), (3, "cd"), (4, "d$")]


def test_odd_rows(spark):
    long_word = "xyz" * 300
    rows = [
        (None, "ORPHANED orphaned"),
        (None, None),
        (1, ""),
        (1, "repeated"),
        (1, "repeated"),
        (2, f"{long_word} {long_word} {long_word[1:]} {long_word[1:]}"),
        (3, "ÀÉÎÕÜÝß àéîõüýß ÀÉÎÕÜÝß àéîõüýß"),
        (4, "short short 12345678 12345678"),
    ]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    assert set(groups(df)) == plain_groups(rows)
    assert groups(spark.createDataFrame([], SCHEMA)) == []


def test_chain_of_forms(spark):
    pairs = [("abcdefg", 2), ("abcdefgh", 20), ("abcdefghi", 200), ("abcdefghij", 2000)]
    forms = spark.createDataFrame([(a, b) for (a, _), (b, _) in zip(pairs, pairs[1:])], "word string, form string")
    found = dict(map(tuple, spelling.roots(stored(forms, "forms")).collect()))
    assert found == {a: "abcdefghij" for a, _ in pairs[:3]}


@pytest.mark.parametrize("a,b,near", [("abcdefg", "abcdefgh", True), ("abcdefg", "abcdegf", False), ("bcdefgh", "abcdefgh", True)])
def test_near_words(spark, a, b, near):
    words = stored(spark.createDataFrame([(a, 2), (b, 2)], "word string, n long"), "words")
    assert spelling.near_words(words).count() == near
