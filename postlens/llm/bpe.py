"""Byte-level BPE by backtracking over longest matches, and decoding through an offset table."""

import json
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from postlens.llm.common import BYTE_BPE, per_worker
from postlens.llm.tokens import ChunkEncoder, byte_letters, file_text, packed

# Fixed value: the pre-tokenizer pattern of the vocabulary file's ByteLevel step.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KNOWN_PAIRS = 1 << 18
NONE = -1


def token_bytes(spec: dict) -> tuple[dict[int, bytes], dict[str, int]]:
    """Bytes by id, and the special tokens' ids by name."""
    to_byte = {letter: byte for byte, letter in byte_letters().items()}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocabulary = spec["model"]["vocab"].items()
    return {i: bytes(map(to_byte.get, token)) for token, i in vocabulary if token not in special}, special


class Vocabulary:
    """What both directions need: bytes of each id, merge ranks, halves, longest proper prefix tokens."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        ids = spec["model"]["vocab"]
        self.bytes_of, self.special = token_bytes(spec)
        self.id_of = {token: i for i, token in self.bytes_of.items()}
        size = 1 + max(ids.values(), default=0)
        # A token that no merge makes is a single byte: rank -1 and no halves.
        self.rank, self.halves, self.merge_rank = [NONE] * size, [None] * size, {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            pair, whole = (ids[left], ids[right]), ids[left + right]
            self.merge_rank[pair] = rank
            if self.rank[whole] == NONE:
                self.rank[whole], self.halves[whole] = rank, pair
        self.length, self.prefix = [0] * size, [NONE] * size
        for i, token in self.bytes_of.items():
            self.length[i], self.prefix[i] = len(token), self.longest_prefix(token)

    def longest_prefix(self, token):
        for end in range(len(token) - 1, 0, -1):
            if token[:end] in self.id_of:
                return self.id_of[token[:end]]
        return NONE


class BacktrackingEncoder:
    """Exact BPE of one pre-token in linear time.

    Tokens are taken greedily, longest first, from Aho-Corasick matches. A token may follow another
    only if BPE of the two tokens' joined text keeps the border between them; if no token fits, the
    last one is taken back and the place it ended at is closed.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.automaton = ahocorasick.Automaton()
        for i, token in vocabulary.bytes_of.items():
            self.automaton.add_word(token.decode("latin-1"), (i, len(token) - 1))
        self.automaton.make_automaton()
        self.known_pairs = {}

    def longest_at(self, text):
        """The longest token that starts at each place."""
        longest = [NONE] * len(text)
        # Matches come by their last place, so the last one seen for a start is the longest.
        for end, (i, before_end) in self.automaton.iter(text):
            longest[end - before_end] = i
        return longest

    def keeps_border(self, left, right):
        """Undo merges from the latest on, on whichever side made the later one.

        The border is crossed if the pair beside it merges earlier than the merges that took the two
        tokens up on their sides; of two equal merges the one further left goes first.
        """
        v = self.v
        used_left = used_right = len(v.merge_rank)
        while True:
            rank = v.merge_rank.get((left, right))
            if rank is not None and rank < used_left and rank <= used_right:
                return False
            left_rank, right_rank = v.rank[left], v.rank[right]
            if left_rank == right_rank == NONE:
                return True
            if left_rank >= right_rank:
                used_left, left = left_rank, v.halves[left][1]
            else:
                used_right, right = right_rank, v.halves[right][0]

    def __call__(self, token: bytes):
        if token in self.v.id_of:
            return [self.v.id_of[token]]
        length_of, shorter, known = self.v.length, self.v.prefix, self.known_pairs
        if len(known) > KNOWN_PAIRS:
            known.clear()
        size = len(token)
        longest = self.longest_at(token.decode("latin-1"))
        is_open = bytearray(b"\x01") * (size + 1)
        ids, place, candidate = [], 0, longest[0]
        while place < size:
            end = place + length_of[candidate]
            if is_open[end]:
                if ids:
                    pair = ids[-1] << 32 | candidate
                    fits = known.get(pair)
                    if fits is None:
                        fits = known[pair] = self.keeps_border(ids[-1], candidate)
                else:
                    fits = True
                if fits:
                    ids.append(candidate)
                    place = end
                    candidate = longest[place] if place < size else NONE
                    continue
            candidate = shorter[candidate]
            if candidate == NONE:
                is_open[place] = 0
                candidate = ids.pop()
                place -= length_of[candidate]
        return ids


class TextEncoder:
    """Whole texts to ids: special tokens, then pre-tokens, then backtracking for each distinct one."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.backtrack = BacktrackingEncoder(vocabulary)
        self.pattern = regex.compile(PRE_TOKENS)
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.whole = ChunkEncoder(self.encode, lambda chunk: self.encode(" " + chunk), keep_spaces=True)

    def encode(self, chunk):
        parts = self.special.split(chunk) if self.special else [chunk]
        ids = []
        for place, part in enumerate(parts):
            if place % 2:
                ids.append(self.vocabulary.special[part])
                continue
            for token in self.pattern.findall(part):
                ids += self.backtrack(token.encode("utf-8"))
        return packed(ids)

    def __call__(self, text):
        return self.whole(text)


class Decoder:
    """Ids to bytes: all tokens' bytes in one block, and the place at which each id's begin."""

    def __init__(self, spec: str):
        bytes_of, special = token_bytes(json.loads(spec))
        tokens = [b""] * (1 + max([*bytes_of, *special.values()], default=0))
        for i, token in bytes_of.items():
            tokens[i] = token
        for name, i in special.items():
            tokens[i] = name.encode("utf-8")
        self.block = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)

    def __call__(self, ids: np.ndarray) -> str:
        starts = self.offsets[ids]
        lengths = self.offsets[ids + 1] - starts
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        places = np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
        return self.block[places].tobytes().decode("utf-8", errors="replace")


class Coder:
    """Both directions, each made when first asked for."""

    def __init__(self, spec: str):
        self.spec = spec

    @cached_property
    def encode(self) -> TextEncoder:
        return TextEncoder(Vocabulary(self.spec))

    @cached_property
    def decode(self) -> Decoder:
        return Decoder(self.spec)


def coder(spec: str) -> Coder:
    return per_worker(("bpe", hash(spec)), lambda: Coder(spec))


def encode_documents(docs: DataFrame, path: str = BYTE_BPE, as_bytes: bool = False) -> DataFrame:
    """doc_id, ids of every whole text: an array of int, or little-endian unsigned 32-bit numbers as_bytes.

    Null and empty texts give no ids. Rows are kept as they are, repeated ones and null doc_id
    included; other columns are left out. No shuffle: documents are encoded where they are read.
    """
    spec = docs.sparkSession.sparkContext.broadcast(file_text(path))

    def encode(batches):
        encoder = coder(spec.value).encode
        for batch in batches:
            ids = [encoder(t.as_py()) for t in batch.column("text")]
            if as_bytes:
                column = pa.array(ids, pa.binary())
            else:
                offsets = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                column = pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(ids), dtype="<i4"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), column], names=["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, ids {'binary' if as_bytes else 'array<int>'}")


def decode_documents(encoded: DataFrame, path: str = BYTE_BPE) -> DataFrame:
    """doc_id, ids, text of every row of ids (either form); bytes that are no UTF-8 become U+FFFD.

    No ids and null give the empty text.
    """
    spec = encoded.sparkSession.sparkContext.broadcast(file_text(path))
    kinds = {name: encoded.schema[name].dataType.simpleString() for name in ("doc_id", "ids")}
    as_bytes = kinds["ids"] == "binary"

    def decode(batches):
        decoder = coder(spec.value).decode
        for batch in batches:
            rows = (row.as_py() or b"" for row in batch.column("ids"))
            ids = (np.frombuffer(row, dtype="<u4") if as_bytes else np.array([*row], dtype=np.int64) for row in rows)
            texts = pa.array([decoder(row.astype(np.int64)) for row in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {kinds['doc_id']}, ids {kinds['ids']}, text string")


def round_trip_documents(docs: DataFrame, path: str = BYTE_BPE) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit bytes), text as decoded from them, both in one pass.

    What encode_documents and decode_documents give one after the other, with half the workers.
    """
    spec = docs.sparkSession.sparkContext.broadcast(file_text(path))

    def both(batches):
        own = coder(spec.value)
        for batch in batches:
            ids = [own.encode(t.as_py()) for t in batch.column("text")]
            texts = [own.decode(np.frombuffer(row, dtype="<u4").astype(np.int64)) for row in ids]
            columns = [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(both, f"doc_id {kind}, ids binary, text string")
