"""Best-fit packing planned over the histogram of lengths, not over documents."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import BYTE_BPE, ranked, stored
from postlens.llm.tokenfile import keep_spaces
from postlens.llm.tokens import file_text, library_encoder

CAPACITY = 1024
END_ID = 2


def token_pieces(docs: DataFrame, tokenizer: str = BYTE_BPE, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids and end id, cut if over capacity.

    The first piece takes what is over, so all others are full. Null and empty texts have the end id
    only. Null doc_id and repeated rows are kept; other columns are left out.
    """
    spec = docs.sparkSession.sparkContext.broadcast(file_text(tokenizer))
    keeps = keep_spaces(spec.value)
    last = np.array([end_id], dtype="<u4").tobytes()

    def encode(batches):
        encoder = library_encoder(spec.value, keeps)
        for batch in batches:
            rows = []
            for doc_id, body in zip(batch.column("doc_id"), batch.column("text")):
                data = encoder(body.as_py()) + last
                size, begin = len(data) // 4, 0
                for piece in range(-(-size // capacity)):
                    end = begin + ((size - begin - 1) % capacity + 1)
                    rows.append((doc_id.as_py(), piece, begin, end - begin, zlib.crc32(data[4 * begin : 4 * end])))
                    begin = end
            columns = zip(*rows) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    return texts.mapInArrow(encode, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit_plan(counts: dict[int, int], capacity: int) -> dict[int, list[tuple]]:
    """Best fit, longest first, on counts: for each length the runs (rank, sequence, a sequence, offset).

    Pieces of ranks from `rank` on go to sequences from `sequence` on, `a sequence` pieces into each, the first at
    `offset`. Sequences with the same room are kept as ranges, so the work depends on the capacity, not on the pieces.
    """
    room = defaultdict(list)  # free tokens -> [(first sequence, how many)]
    runs, used = {}, 0
    for length in sorted(counts, reverse=True):
        left, rank, runs[length] = counts[length], 0, []
        fits = sorted(r for r in room if r >= length)
        filled = defaultdict(list)

        def place(first, how_many, free):
            """Fill how_many sequences from first on with as many pieces as fit in each."""
            nonlocal left, rank
            each = free // length
            full = min(how_many, left // each)
            if full:
                runs[length].append((rank, first, each, capacity - free))
                filled[free - each * length].append((first, full))
                rank, left = rank + full * each, left - full * each
            if left and full < how_many:
                runs[length].append((rank, first + full, left, capacity - free))
                filled[free - left * length].append((first + full, 1))
                rank, left, full = rank + left, 0, full + 1
            return full

        for free in fits:
            ranges = room.pop(free)
            while ranges and left:
                first, how_many = ranges.pop()
                done = place(first, how_many, free)
                if done < how_many:
                    ranges.append((first + done, how_many - done))
            if ranges:
                room[free] = ranges
            if not left:
                break
        if left:
            each = capacity // length
            new = -(-left // each)
            place(used, new, capacity)
            used += new
        for free, ranges in filled.items():
            if free:
                room[free] += ranges
    return runs


def best_fit_packing(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to a table of pieces with doc_id, piece and length (1 to capacity).

    Only the histogram, capacity numbers at most, comes to the driver, and only the plan goes back.
    A piece takes the slot of its rank within its length; ranks are made from salted groups, since one
    length may hold most pieces. Ties and repeated rows get slots of their own. An empty table stays empty.
    """
    spark = pieces.sparkSession
    counts = {row.length: row.n for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = [(length, *map(list, zip(*runs))) for length, runs in best_fit_plan(counts, capacity).items()]
    schema = "length bigint, _ranks array<bigint>, _sequences array<bigint>, _each array<bigint>, _offsets array<bigint>"
    plan = spark.createDataFrame(rows, schema)
    placed = ranked(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "_rank").join(F.broadcast(plan), "length")
    run = F.expr("int(size(filter(_ranks, r -> r <= _rank)))")
    at = {name: F.element_at(name, F.col("_run")) for name in ("_ranks", "_sequences", "_each", "_offsets")}
    return (
        placed.withColumn("_run", run)
        .withColumn("_in_run", F.col("_rank") - at["_ranks"])
        .withColumn("sequence_id", at["_sequences"] + F.expr("_in_run div element_at(_each, _run)"))
        .withColumn("offset", at["_offsets"] + F.col("_in_run") % at["_each"] * F.col("length"))
        .drop("_rank", "_run", "_in_run", "_ranks", "_sequences", "_each", "_offsets")
    )


def packed_documents(docs: DataFrame, tokenizer: str = BYTE_BPE, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their sequence and place there."""
    pieces = stored(token_pieces(docs, tokenizer, end_id, capacity), "pieces")
    packed = best_fit_packing(pieces, capacity)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
