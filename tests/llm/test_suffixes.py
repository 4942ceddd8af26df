"""Covered bytes against a table of all strings, the suffix order against sorting, and rows that tables seldom hold."""

import hashlib
import random
import tracemalloc

import numpy as np

from postlens.llm import queries, suffixes
from postlens.session import BATCH

SCHEMA = "doc_id bigint, text string, bytes string, n_bytes int, runs int"
LENGTH = 100


def plain(rows):
    """(doc_id, n_bytes, n_removed, n_spans, hash) of each row; all strings of earlier places are kept in one set."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, __import__("zlib").crc32((r[1] or "").encode())))
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - LENGTH + 1):
            string = data[i : i + LENGTH]
            if string in seen:
                gone[i : i + LENGTH] = True
            seen.add(string)
        spans = int((gone[:-1] & ~np.r_[False, gone[:-2]]).sum()) if len(data) else 0
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def found(df):
    return [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in suffixes.without_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()]


def key(r):
    return (r[0] is not None, r[0] or 0, r[1:])


def same(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 1) for r in rows], SCHEMA).repartition(4)
    assert sorted(found(df), key=key) == sorted(plain(rows), key=key)


def passages(seed, count):
    """Documents with shared passages of 90 to 400 bytes, near copies, copies and runs of one letter."""
    rng = random.Random(seed)
    words = lambda n: " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))
    shared = [words(rng.randint(18, 90)) for _ in range(12)] + ["z" * 250, "ab" * 120]
    rows = []
    for i in range(count):
        kind = rng.random()
        if kind < 0.15 and rows:
            text = rng.choice(rows)[1]
        elif kind < 0.4 and rows:
            text = list(rng.choice(rows)[1])
            for _ in range(rng.randint(1, 3)):
                text.insert(rng.randrange(len(text) + 1), rng.choice("xyz"))
            text = "".join(text)
        else:
            text = " ".join([words(rng.randint(0, 30)), rng.choice(shared), words(rng.randint(0, 30)), rng.choice([*shared, ""])])
        rows.append((i, text))
    return rows


def test_suffix_order_equals_sorting():
    rng = random.Random(1)
    for alphabet in (1, 2, 4, 200):
        for n in [*range(1, 40), 500, 2000]:
            text = np.array([rng.randrange(alphabet) for _ in range(n)], np.int64) + 1
            if rng.random() < 0.5:
                text = np.tile(text[: max(1, n // 3)], 4)[:n]
            order = suffixes.suffix_order(text, 1, LENGTH)
            assert sorted(order.tolist()) == list(range(len(text)))
            strings = [text[i : i + LENGTH].tolist() for i in order]
            assert strings == sorted(strings)


def test_equals_a_table_of_all_strings(spark):
    same(spark, passages(2, 150))


def test_gram_with_many_units_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "UNITS_SORTED", 5)
    same(spark, passages(4, 120))


def test_long_texts_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "WINDOWS_HELD", 300)
    monkeypatch.setattr(suffixes, "UNITS_HELD", 50)
    same(spark, [*passages(6, 60), (99, " ".join(t for _, t in passages(7, 60)))])


def test_odd_rows(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(230))
    rows = [(None, text), (None, None), (3, ""), (3, text), (3, text), (3, text + "é"), (-5, "é" * 60), (4, text[:99]), (5, text[50:150]), (6, text[50:149])]
    same(spark, rows)
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_query_on_given_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    ours = queries.QUERIES["op11_repeated_bytes"](spark, sf_dir).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, ours), key=key) == sorted(plain(rows), key=key)


def test_hashing_holds_little_memory(spark):
    anchors = suffixes.hasher()
    text = np.random.default_rng(1).integers(0, 256, suffixes.WINDOWS_HELD + LENGTH - 1).astype(np.uint8)
    tracemalloc.start()
    first, windows, _, _ = anchors(text, np.ones(suffixes.WINDOWS_HELD, bool))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert windows.sum() == suffixes.WINDOWS_HELD and first[0] == 0
    assert peak < 64 << 20


def test_texts_come_in_small_batches(spark):
    before = {name: spark.conf.get(name) for name in BATCH}
    try:
        for name in BATCH:
            spark.conf.unset(name)
        suffixes.without_repeats(spark.createDataFrame([(1, "x" * 200)], "doc_id long, text string")).collect()
        assert {name: spark.conf.get(name) for name in BATCH} == BATCH
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
