"""Token-id files: every document's ids as its own zstandard frame under one shared dictionary.

A file set is a folder with two Parquet tables. `blocks` holds about 1 MB of frames a row: part and
block (place in document order), dictionary (hash of the dictionary the frames need), width (bytes an id takes),
doc_ids, lengths (ids of each document), offsets (where each frame begins, one more than documents),
tokens_before (ids of the part in front of the block), tokens and payload. `dictionaries` holds hash and content.
"""

import hashlib
import json
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import WORD_BPE, per_worker, thinned
from postlens.llm.tokens import file_text, library_encoder

END_ID = 1
LEVEL = 3
BLOCK_BYTES = 1 << 20
# The dictionary is fitted on the documents with the smallest hashed doc_id, and on so many ids of each.
SAMPLE_DOCUMENTS = 1000
SAMPLE_IDS = 2048
DICTIONARY_BYTES = 32 << 10

BLOCKS = (
    "part int, block int, dictionary string, width int, doc_ids array<bigint>, lengths array<bigint>, "
    "offsets array<bigint>, tokens_before bigint, tokens bigint, payload binary"
)


def serialised(ids: bytes, end_id: int, width: int) -> bytes:
    """Packed 32-bit ids and the end id, at the file's width."""
    ids = np.append(np.frombuffer(ids, dtype="<u4"), np.uint32(end_id))
    return ids.astype(f"<u{width}").tobytes()


def keep_spaces(spec: str) -> bool:
    """Whether the tokenizer's ids depend on white space."""
    return '"Removed"' not in json.dumps(json.loads(spec)["pre_tokenizer"])


def id_width(spec: str) -> int:
    spec = json.loads(spec)
    ids = [*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"]), END_ID]
    return 2 if max(ids) < 1 << 16 else 4


def fitted_dictionary(docs: DataFrame, spec, width: int, end_id: int) -> bytes:
    """A dictionary of the sample; empty if the sample is too small to fit one."""
    first = thinned(docs, SAMPLE_DOCUMENTS).orderBy(F.xxhash64("doc_id")).limit(SAMPLE_DOCUMENTS).select("text")
    keeps = keep_spaces(spec.value)

    def encode(batches):
        encoder = library_encoder(spec.value, keeps)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([encoder(t.as_py())[: 4 * SAMPLE_IDS] for t in batch.column("text")], pa.binary())], names=["ids"]
            )

    rows = first.mapInArrow(encode, "ids binary").collect()
    samples = [serialised(bytes(row.ids), end_id, width) for row in rows]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_tokens(docs: DataFrame, path: str, tokenizer: str = WORD_BPE, end_id: int = END_ID) -> None:
    """Write all documents' ids to a new file set at path, in ascending doc_id order.

    Documents are dealt out by ranges of doc_id, so that only one shuffle is needed; each task
    encodes its range and holds one block at a time. Null and empty texts have the end id only; null
    doc_id comes first; rows of one doc_id are all kept, ordered by text. Other columns are left out.
    """
    spark = docs.sparkSession
    text = file_text(tokenizer)
    spec, width, keeps = spark.sparkContext.broadcast(text), id_width(text), keep_spaces(text)
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    content = fitted_dictionary(docs, spec, width, end_id)
    name = hashlib.sha256(content).hexdigest()
    spark.createDataFrame([(name, content)], "hash string, content binary").coalesce(1).write.parquet(f"{path}/dictionaries")

    def encode(batches):
        encoder = library_encoder(spec.value, keeps)
        pack = compressor(content)
        part, block, before = TaskContext.get().partitionId(), 0, 0
        doc_ids, lengths, frames, size = [], [], [], 0

        def row():
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype(np.int64)
            values = [part, block, name, width, doc_ids, lengths, offsets, before, sum(lengths), b"".join(frames)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, BLOCK_TYPES)], names=BLOCK_NAMES)

        for batch in batches:
            for doc_id, body in zip(batch.column("doc_id"), batch.column("text")):
                ids = serialised(encoder(body.as_py()), end_id, width)
                doc_ids.append(doc_id.as_py())
                lengths.append(len(ids) // width)
                frames.append(pack.compress(ids))
                size += len(frames[-1])
                if size >= BLOCK_BYTES:
                    yield row()
                    block, before = block + 1, before + sum(lengths)
                    doc_ids, lengths, frames, size = [], [], [], 0
        if frames:
            yield row()

    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


BLOCK_NAMES = [field.split()[0] for field in BLOCKS.split(", ")]
BLOCK_TYPES = [
    {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}.get(
        field.split()[1], pa.list_(pa.int64())
    )
    for field in BLOCKS.split(", ")
]


def as_dictionary(content: bytes):
    return zstandard.ZstdCompressionDict(content) if content else None


def compressor(content: bytes):
    dictionary = as_dictionary(content)
    if dictionary:
        dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)


def blocks_of(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, bytes]]:
    """The blocks with `start`, the ids in front of each, and the dictionaries by hash (one for each file set)."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # One row for each written part, so this small table may be summed up and sent to all tasks.
    parts = blocks.groupBy("part").agg(F.sum("tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("part_start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    blocks = blocks.join(F.broadcast(parts), "part").withColumn("start", F.col("part_start") + F.col("tokens_before"))
    contents = {row.hash: bytes(row.content) for row in spark.read.parquet(f"{path}/dictionaries").collect()}
    for name, content in contents.items():
        if hashlib.sha256(content).hexdigest() != name:
            raise ValueError(f"the dictionary {name} has another content")
    return blocks, contents


def documents_in(batch: pa.RecordBatch, contents: dict[str, bytes], wanted=None):
    """(doc_id, start, ids) of the documents of a batch of blocks; frames of unwanted ones stay packed."""
    for row in batch.to_pylist():
        unpack = per_worker(
            ("unpack", row["dictionary"]),
            lambda: zstandard.ZstdDecompressor(dict_data=as_dictionary(contents[row["dictionary"]])),
        )
        start, offsets, payload = row["start"], row["offsets"], memoryview(row["payload"])
        for place, (doc_id, length) in enumerate(zip(row["doc_ids"], row["lengths"])):
            if wanted is None or doc_id in wanted:
                data = unpack.decompress(payload[offsets[place] : offsets[place + 1]])
                yield doc_id, start, np.frombuffer(data, dtype=f"<u{row['width']}").astype("<u4")
            start += length


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files."""
    blocks, contents = blocks_of(spark, path)

    def read(batches):
        for batch in batches:
            rows = [(i, s, len(ids), zlib.crc32(ids.tobytes())) for i, s, ids in documents_in(batch, contents)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return blocks.drop("part_start").mapInArrow(read, ", ".join(f"{n} bigint" for n in names))


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, ids (array of bigint) of all documents, or of a short list of them.

    For a list only the blocks that hold one are kept, and of these only the wanted frames are unpacked.
    """
    blocks, contents = blocks_of(spark, path)
    wanted = None if doc_ids is None else set(doc_ids)
    if wanted is not None:
        blocks = blocks.where(F.arrays_overlap("doc_ids", F.array([F.lit(i).cast("bigint") for i in doc_ids])))

    def read(batches):
        for batch in batches:
            rows = [(i, ids.astype(np.int64)) for i, _, ids in documents_in(batch, contents, wanted)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64()))],
                names=["doc_id", "ids"],
            )

    return blocks.drop("part_start").mapInArrow(read, "doc_id bigint, ids array<bigint>")
