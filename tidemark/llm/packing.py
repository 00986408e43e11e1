"""Packing documents into sequences of a fixed number of tokens by bin completion.

1. One pass encodes every text, appends the end id, cuts what is longer than a sequence, and stores one
   row per piece: its length and its place among the pieces of that length that its task has seen.
2. The histogram of lengths (at most ``capacity`` rows, whatever the input) is packed; see ``bin_completion``.
3. Piece number k of a length takes the k-th slot of that length in the plan. The numbering adds up
   counts per (task, length); the plan has at most ``capacity`` distinct fillings or so and is broadcast.

No piece moves through the driver or through one task, and a length that a third of all pieces share
is spread over the tasks that made it.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialise, text_batches
from .bin_completion import Plan, pack
from .common import KEPT_PIECES, TRIMMED_SLICES, id_and_text, library_encoder, slices, trimmed

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, nth bigint"


def cut_documents(docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = False, remembered: int | None = None) -> DataFrame:
    """Rows per piece: doc_id, piece, start, length, ids_crc32, task, nth, and ``ids`` if asked for.

    Pieces of a longer document are full but for the first. A null or empty text is one piece of the end id.
    """
    def cut(batches):
        encode, task, seen = library_encoder(path, spaces=True), TaskContext.get().partitionId(), Counter()
        end = np.array([end_id], "<u4").tobytes()
        encode.remembered = remembered
        for b in (part for whole in batches for part in slices(whole)):
            doc, piece, starts, lengths, crcs, nth, kept = [], [], [], [], [], [], []
            for doc_id, ids in zip(b["doc_id"].to_pylist(), encode(b["text"].to_pylist())):
                ids += end
                at, length = 0, (len(ids) // 4 - 1) % capacity + 1
                for number in range(-(-len(ids) // 4 // capacity)):
                    part = ids[4 * at:4 * (at + length)]
                    doc.append(doc_id)
                    piece.append(number)
                    starts.append(at)
                    lengths.append(length)
                    crcs.append(zlib.crc32(part))
                    nth.append(seen[length])
                    seen[length] += 1
                    if with_ids:
                        kept.append(np.frombuffer(part, "<i4"))
                    at, length = at + length, capacity
            columns = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                       pa.array(crcs, pa.int64()), pa.array([task] * len(doc), pa.int32()), pa.array(nth, pa.int64())]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth", "ids"]
            yield pa.RecordBatch.from_arrays(columns, names[:len(columns)])
        encode.forget(KEPT_PIECES)

    return id_and_text(docs, id_col, text_col).mapInArrow(lambda batches: trimmed(cut(batches), TRIMMED_SLICES, tokens=True), _PIECES + (", ids array<int>" if with_ids else ""))


def plan_slots(plan: Plan) -> list[tuple]:
    """(length, from, upto, first sequence, per bin, offset) per length and filling of the plan.

    Slots ``from`` to ``upto`` of the length lie in the bins of that filling, ``per bin`` in each, from ``offset`` on.
    """
    rows, next_slot, first = [], Counter(), 0
    for filling, bins in plan:
        offset = 0
        for length, per in sorted(Counter(filling).items(), reverse=True):
            rows.append((length, next_slot[length], next_slot[length] + per * bins, first, per, offset))
            next_slot[length] += per * bins
            offset += per * length
        first += bins
    return rows


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = False, remembered: int | None = None) -> DataFrame:
    """Rows per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Every row of ``docs`` is packed, repeated rows and null ids too. No documents, no rows. A worker remembers ``remembered`` pieces of
    texts (else REMEMBERED_PIECES): fewer take less memory and more time.
    """
    with text_batches(docs.sparkSession):
        pieces = materialise(cut_documents(docs, path, capacity, end_id, id_col, text_col, with_ids, remembered), "pieces")
    # A row per task and length; tasks are as many as input splits, which bounds a window over one length.
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    numbered = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # At most `capacity` rows come to the driver: the histogram.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = plan_slots(pack(histogram, capacity))
    table = {}
    for length, low, upto, first, per, offset in rows:
        table.setdefault(length, []).append((low, first, per, offset))
    plan = docs.sparkSession.sparkContext.broadcast(
        {n: tuple(np.array(c, np.int64) for c in zip(*sorted(r))) for n, r in table.items()}
    )
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def place(batches):
        for b in batches:
            length, slot = b["length"].to_numpy(), b["slot"].to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                low, first, per, start = plan.value[int(n)]
                mine = np.flatnonzero(length == n)
                at = np.searchsorted(low, slot[mine], "right") - 1
                inside = slot[mine] - low[at]
                sequence[mine] = first[at] + inside // per[at]
                offset[mine] = start[at] + inside % per[at] * n
            yield pa.RecordBatch.from_arrays([*(b[c] for c in kept), pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    slots = pieces.join(numbered, ["task", "length"]).select(*kept, (F.col("before") + F.col("nth")).alias("slot"))
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    return slots.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")
