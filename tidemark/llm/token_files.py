"""Token ids in Simple-8b coded files, in ascending order of documents.

A token folder is a Parquet table of blocks, so that Spark's committer makes each file appear whole or
not at all wherever the folder is, and readers prune columns and blocks. A block holds whole documents
in order, at least ``block_ids`` ids unless it is the last of its file: columns ``shard`` and ``block``
(the order of blocks), ``start`` (ids of the shard before the block), ``doc_ids``, ``sizes`` (ids of each document),
``n_ids``, ``words`` (Simple-8b, little-endian) and ``before`` (see ``simple8b``).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from . import simple8b
from .common import id_and_text, library_encoder

BLOCKS = "shard int, block int, start bigint, doc_ids array<bigint>, sizes array<bigint>, n_ids bigint, words binary, before binary"
#: Rows handed on at a time, so that a batch of long documents stays small.
_ROWS = 256


def encode_blocks(docs: DataFrame, path: str, end_id: int, block_ids: int = 1 << 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Blocks of ``docs`` encoded by the ``tokenizers`` file ``path``, ``end_id`` after each document.

    Documents are dealt out by ranges of (id, hash of the text, input row): rows that share an id, null
    ids among them (which come first), spread over tasks like others. A null or empty text has the end id only.
    """
    ordered = (
        id_and_text(docs, id_col, text_col)
        .withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), "_hash", "_row")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_hash", "_row")
        .select("doc_id", "text")
    )

    def write(batches):
        encode, shard, block = library_encoder(path, spaces=False), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        doc_ids, parts, n, start = [], [], 0, 0

        def closed():
            sizes = [len(p) // 4 for p in parts]
            words, before = simple8b.encode(np.frombuffer(b"".join(parts), "<u4"))
            row = {"shard": shard, "block": block, "start": start, "doc_ids": doc_ids, "sizes": sizes, "n_ids": n, "words": words, "before": before}
            return pa.RecordBatch.from_pylist([row], schema)

        schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                            ("n_ids", pa.int64()), ("words", pa.binary()), ("before", pa.binary())])
        for b in batches:
            for row in range(0, b.num_rows, _ROWS):
                some = b.slice(row, _ROWS)
                for doc_id, ids in zip(some["doc_id"].to_pylist(), encode(some["text"].to_pylist())):
                    doc_ids.append(doc_id)
                    parts.append(ids + end)
                    n += len(ids) // 4 + 1
                    if n >= block_ids:
                        yield closed()
                        doc_ids, parts, n, block, start = [], [], 0, block + 1, start + n
        if parts:
            yield closed()

    return ordered.mapInArrow(write, BLOCKS)


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int, **options) -> None:
    encode_blocks(docs, path, end_id, **options).write.parquet(folder)


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Rows per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (and ids).

    Shards follow each other, so a shard's place is the sum of the ids of those before: a row per file.
    """
    stored = spark.read.schema(BLOCKS).parquet(folder)
    per_shard = stored.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    earlier = per_shard.select("shard", F.coalesce(F.sum("n").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))

    def read(batches):
        for b in batches:
            for k in range(b.num_rows):
                row = b.slice(k, 1).to_pylist()[0]
                ids = simple8b.decode(row["words"], row["n_ids"]).astype("<u4")
                ends = np.cumsum(row["sizes"])
                parts = [ids[e - n:e] for e, n in zip(ends, row["sizes"])]
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends - row["sizes"], pa.int64()),
                           pa.array(row["sizes"], pa.int64()), pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64())]
                if with_ids:
                    columns.append(pa.array([p.view("<i4") for p in parts], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(columns)])

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    placed = stored.join(F.broadcast(earlier), "shard")  # a row per file
    return placed.select("doc_ids", "sizes", "n_ids", "words", (F.col("earlier") + F.col("start")).alias("start")).mapInArrow(read, schema)
