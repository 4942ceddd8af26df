"""BPE, token files, packing and shards against the tokenizers library and plain recounts."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postlens.llm import bpe, common, packing, queries, sharding, tokenfile, tokens
from postlens.llm.common import BYTE_BPE, WORD_BPE, ranked, stored
from postlens.llm.tokens import file_text, library_encoder

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string, length int, start int"
ODD = [
    (5, None, None, None, None, "x", 1, 1),
    (None, "no id", "en", "s", 5, "x", 1, 1),
    (7, "", "en", "s", 0, "x", 1, 1),
    (7, "twice", "en", "s", 5, "x", 1, 1),
    (7, "twice", "en", "s", 5, "x", 1, 1),
    (-3, "  two  spaces \n\n and\ttabs <|endoftext|> end ", "en", "s", 5, "x", 1, 1),
    (9, "long " * 30000, "en", "s", 5, "x", 1, 1),
    (8, "unbroken" * 4000, "en", "s", 5, "x", 1, 1),
    (10, "漢字🙂é é İSTANBUL ΣΑΣ 's 't '", "en", "s", 5, "x", 1, 1),
]


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def library_ids(path, texts):
    tokenizer = Tokenizer.from_file(path)
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def fuzzed(count, seed=3):
    rng = random.Random(seed)
    letters = " \n\t  aabcdefthe'sxé漢🙂0123!!ingÀÉ\x1ć" + "Σİß"
    parts = [*letters, "<|endoftext|>", "<|startoftext|>", "\r\n", "   ", "the", "tion"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 50))) for _ in range(count)]


def test_backtracking_equals_the_library():
    texts = fuzzed(5000) + ["a" * n for n in range(1, 120)] + [r[1] or "" for r in ODD]
    coder = bpe.coder(file_text(BYTE_BPE))
    encoder, decoder = coder.encode, coder.decode
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    for text, ids in zip(texts, library_ids(BYTE_BPE, texts)):
        own = np.frombuffer(encoder(text), "<u4").tolist()
        assert own == ids
        assert decoder(np.array(own, dtype=np.int64)) == tokenizer.decode(ids, skip_special_tokens=False)


def test_decoding_of_broken_bytes():
    decoder = bpe.coder(file_text(BYTE_BPE)).decode
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    rng = random.Random(5)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 8))]
        assert decoder(np.array(ids, dtype=np.int64)) == tokenizer.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize(("path", "keeps"), [(BYTE_BPE, True), (WORD_BPE, False)])
def test_chunks_equal_whole_texts(path, keeps):
    texts = fuzzed(3000, 11) + [r[1] or "" for r in ODD]
    assert tokenfile.keep_spaces(file_text(path)) == keeps
    encoder = library_encoder(file_text(path), keeps)
    for text, ids in zip(texts, library_ids(path, texts)):
        assert np.frombuffer(encoder(text), "<u4").tolist() == ids


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


def test_round_trip_query(spark, documents):
    rows = {r.doc_id: r for r in queries.QUERIES["op6_bpe_round_trip"](spark, SF_DIR).collect()}
    assert len(rows) == len(documents)
    for (doc_id, text), ids in zip(documents, library_ids(BYTE_BPE, [t or "" for _, t in documents])):
        row = rows[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(packed(ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_odd_rows(spark):
    for as_bytes in (False, True):
        back = bpe.decode_documents(bpe.encode_documents(odd(spark), as_bytes=as_bytes)).collect()
        assert Counter((r.doc_id, r.text) for r in back) == Counter((r[0], r[1] or "") for r in ODD)
        once = bpe.round_trip_documents(odd(spark)).collect()
        assert Counter((r.doc_id, r.text) for r in once) == Counter((r[0], r[1] or "") for r in ODD)
    assert bpe.decode_documents(bpe.encode_documents(empty(spark))).collect() == []


def expected_files(rows):
    """What the files must hold, from plain counting."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, out = 0, []
    for (doc_id, _), ids in zip(rows, library_ids(WORD_BPE, [t or "" for _, t in rows])):
        ids = [*ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(packed(ids))))
        start += len(ids)
    return out


def test_token_files(spark, documents):
    rows = queries.QUERIES["op9_token_files"](spark, SF_DIR).collect()
    assert sorted(map(tuple, rows)) == expected_files(documents)


def test_token_files_odd_rows(spark, tmp_path):
    path = f"{tmp_path}/files"
    tokenfile.write_tokens(odd(spark), path)
    got = [tuple(r) for r in tokenfile.token_digests(spark, path).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected_files([r[:2] for r in ODD])
    short = tokenfile.read_tokens(spark, path, [10, 5]).collect()
    assert {r.doc_id: r.ids[-1] for r in short} == {10: 1, 5: 1}
    assert len(tokenfile.read_tokens(spark, path).collect()) == len(ODD)


def test_token_files_of_an_empty_table(spark, tmp_path):
    path = f"{tmp_path}/files"
    tokenfile.write_tokens(empty(spark), path)
    assert tokenfile.token_digests(spark, path).collect() == []


def test_changed_dictionary_is_refused(spark, tmp_path):
    path = f"{tmp_path}/files"
    tokenfile.write_tokens(odd(spark), path)
    wrong = spark.createDataFrame([("0" * 64, b"other")], "hash string, content binary")
    wrong.write.mode("append").parquet(f"{path}/dictionaries")
    with pytest.raises(ValueError):
        tokenfile.token_digests(spark, path)


def check_packing(rows, texts, capacity=1024):
    """Pieces put together are the documents, and every sequence is gapless."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for (doc_id, _), ids in zip(texts, library_ids(BYTE_BPE, [t or "" for _, t in texts])):
        ids, own = [*ids, 2], sorted(pieces[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // capacity)))
        assert [r.length for r in own[1:]] == [capacity] * (len(own) - 1)
        assert [r.start for r in own] == [sum(r.length for r in own[:k]) for k in range(len(own))]
        for r in own:
            assert r.ids_crc32 == zlib.crc32(packed(ids[r.start : r.start + r.length]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def one_by_one(lengths, capacity):
    """Best fit decreasing, a piece at a time."""
    room = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= length]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - length)
        else:
            room.append(capacity - length)
    return len(room)


def test_packing_query(spark, documents):
    rows = queries.QUERIES["op10_best_fit"](spark, SF_DIR).collect()
    assert check_packing(rows, documents) == one_by_one([r.length for r in rows], 1024)


def test_packing_odd_rows(spark):
    once = [r for r in ODD if r[0] != 7] + [ODD[2]]
    rows = packing.packed_documents(spark.createDataFrame(once, SCHEMA)).collect()
    check_packing(rows, [r[:2] for r in once])
    assert packing.packed_documents(empty(spark)).collect() == []
    twice = packing.packed_documents(odd(spark)).collect()
    assert len({(r.sequence_id, r.offset) for r in twice}) == len(twice)


def test_plan_equals_best_fit_one_by_one():
    rng = random.Random(2)
    for _ in range(200):
        capacity = rng.choice([10, 37, 100])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 200))]
        slots = defaultdict(list)
        for length, runs in packing.best_fit_plan(Counter(lengths), capacity).items():
            count = lengths.count(length)
            ends = [r[0] for r in runs[1:]] + [count]
            for (rank, first, each, offset), end in zip(runs, ends):
                for k in range(end - rank):
                    slots[first + k // each].append((offset + k % each * length, length))
        assert sum(map(len, slots.values())) == len(lengths)
        for places in slots.values():
            end = 0
            for offset, length in sorted(places):
                assert offset == end
                end += length
            assert end <= capacity
        assert len(slots) == one_by_one(lengths, capacity)


def check_shards(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert set(slots) <= set(range(shards))
    assert max(counts) - min(counts) <= 1
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))


def test_shard_query(spark, documents):
    rows = queries.QUERIES["op7_shards"](spark, SF_DIR).collect()
    check_shards(rows, 24)
    texts = dict(documents)
    for r in rows:
        body = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(body) + 8, zlib.crc32(body), "rows", None)


def test_shards_of_odd_rows(spark):
    rows = sharding.shard_documents(odd(spark), shards=4).collect()
    check_shards(rows, 4)
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in ODD)
    assert sharding.shard_documents(empty(spark)).collect() == []
    hot = spark.range(300).select(F.lit(1).alias("doc_id"), F.lit("same").alias("text"))
    check_shards(sharding.shard_documents(hot, shards=7).collect(), 7)


def test_few_keys_move_when_a_shard_is_added(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    before = {r.doc_id: r.shard for r in sharding.shard_documents(docs, 24).collect()}
    after = {r.doc_id: r.shard for r in sharding.shard_documents(docs, 25).collect()}
    moved = sum(before[k] != after[k] for k in before) / len(before)
    assert moved < 0.25  # dealing out by rank or by modulo moves 24 of 25 keys


def test_bounded_plan_equals_walking_one_by_one():
    rng = np.random.default_rng(4)
    for _ in range(50):
        shards = int(rng.integers(1, 6))
        _, owners = sharding.ring(shards, 8)
        loads = rng.integers(0, 30, len(owners))
        room = [int(loads.sum()) // shards + (s < int(loads.sum()) % shards) for s in range(shards)]
        expected = {}
        waiting = []
        for arc, load in enumerate(loads):
            for rank in range(load):
                if room[owners[arc]]:
                    room[owners[arc]] -= 1
                    expected[arc, rank] = owners[arc]
                else:
                    waiting.append((arc, rank))
        for arc, rank in waiting:
            at = arc
            while not room[owners[at]]:
                at = (at + 1) % len(owners)
            room[owners[at]] -= 1
            expected[arc, rank] = owners[at]
        runs = defaultdict(list)
        for arc, rank, shard, _ in sharding.bounded_plan(loads, owners, shards):
            runs[arc].append((rank, shard))
        for (arc, rank), shard in expected.items():
            assert [s for first, s in runs[arc] if first <= rank][-1] == shard


def test_ranks_are_gapless(spark):
    rows = spark.range(5000).selectExpr("if(id % 3 = 0, 'hot', cast(id % 50 as string)) k", "id % 100 as v")
    got = ranked(stored(rows, "ranks"), ["k"], ["v"]).collect()
    ranks = defaultdict(list)
    for r in got:
        ranks[r.k].append(r["rank"])
    assert all(sorted(own) == list(range(len(own))) for own in ranks.values())
    assert len(got) == 5000


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_line_feeds_and_marks_equal_whole_text_calls(path):
    library = Tokenizer.from_file(path)
    spec = file_text(path)
    encoder = library_encoder(spec, tokenfile.keep_spaces(spec))
    texts = [
        "One.\nTwo\n\n three \n four\n",
        "\nab$$$ cd|<>%&*# ef<| <|endoftext|>\ngh",
        "can't\n's it's\ńe é\nñ >\n̸",
        "ªºµß\nİIÉ!?;: \x85\x1c\n\t x",
        "\n".join(["", " ", "a", " b", "c "]),
    ]
    for text in texts:
        ids = np.frombuffer(encoder(text), dtype="<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path, keeps", [(WORD_BPE, False), (BYTE_BPE, True)])
def test_letters_of_a_known_chunk_are_not_encoded_again(path, keeps):
    encoder = library_encoder(file_text(path), keeps)
    library = encoder.known.encode.__self__
    encoder("x zebrafishes \u00e9tudiantes")
    calls, tokenize = [], library.tokenize
    library.tokenize = lambda text: calls.append(text) or tokenize(text)
    text = "x zebrafishes, zebrafishes. Zebrafishes! \u00e9tudiantes; \u00c9tudiantes,"
    ids = np.frombuffer(encoder(text), "<u4").tolist()
    library.tokenize = tokenize
    assert ids == library_ids(path, [text])[0]
    # The vocabulary of words lower-cases; the one of bytes knows capital letters as other words.
    assert len(calls) == (2 if keeps else 0)


def test_a_worker_gives_back_what_another_job_left(monkeypatch):
    given_back = []

    class Pool:
        def release_unused(self):
            given_back.append(common.sys.modules["_postlens_llm_kept"].value)

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    assert [common.per_worker(key, lambda: key) for key in ("one job", "one job", "another job")] == ["one job", "one job", "another job"]
    assert given_back == [None, None]


def test_known_chunks_are_never_held_three_times(monkeypatch):
    """The old generation has gone when the young one is copied."""
    monkeypatch.setattr(tokens, "CACHED_CHARS", 3)
    held = []
    known = tokens.Known(lambda chunk: chunk.encode())
    monkeypatch.setattr(tokens, "dict", lambda young: held.append(known.old) or dict(young.items()), raising=False)
    assert [known[c] for c in ("ab", "cd", "ef", "ab", "gh", "ij")] == [b"ab", b"cd", b"ef", b"ab", b"gh", b"ij"]
    assert held and held == [None] * len(held) and known.find("ij") == b"ij"
