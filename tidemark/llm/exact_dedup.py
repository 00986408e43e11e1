"""Exact duplicates by a tree merge of sorted digest runs.

Every input task sorts the digests of its rows into a run and folds equal ones. Runs are then exchanged in
binomial rounds of ``2**BITS`` partners: in round r a node cuts its run by the next BITS bits of the
digest, sends each cut to the node of its group that stands for these bits, and merges the cuts
it receives, keeping per digest the row that stays and the count. After the last round node n holds all
digests that begin with n, each once. The answers return on the same paths, so a node only
ever sees one entry per digest and partner: a text that a third of all rows share costs no task more
than another. A digest counts as equal only if the length and a second, independent hash agree too.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .common import TRIMMED_SLICES, id_and_text, slices, trimmed

#: Partners in a round: 2**BITS.
BITS = 4
#: Rows of one run when a task has more.
RUN_ROWS = 1 << 20

_KEY = ["d0", "d1", "d2", "d3", "check", "size"]
_ENTRY = np.dtype([*((k, ">u8") for k in _KEY), ("has_id", "u1"), ("id", "<i8"), ("row", "<i8"), ("count", "<i8")])
_RUN = "node bigint, partner bigint, run binary"


def _schema() -> pa.Schema:
    return pa.schema([("node", pa.int64()), ("partner", pa.int64()), ("run", pa.binary())])


def _sorted(entries: np.ndarray, largest: bool) -> np.ndarray:
    """By key; within a key the entry that stays is last. Presorted runs are merged, not sorted afresh."""
    sign = 1 if largest else -1
    order = np.lexsort([sign * entries["row"], sign * entries["id"], sign * entries["has_id"].astype(np.int8), *(entries[k] for k in reversed(_KEY))])
    return entries[order]


def _last_of_key(entries: np.ndarray) -> np.ndarray:
    if not len(entries):
        return np.zeros(0, bool)
    return np.append(np.any([entries[k][1:] != entries[k][:-1] for k in _KEY], axis=0), True)


def _merged(runs: list[bytes], largest: bool) -> np.ndarray:
    """One entry per key of all ``runs``: the row that stays, and how many rows there are."""
    entries = _sorted(np.frombuffer(b"".join(runs), _ENTRY), largest)
    last = np.flatnonzero(_last_of_key(entries))
    folded = entries[last].copy()
    if len(last):
        folded["count"] = np.add.reduceat(entries["count"], np.append(0, last[:-1] + 1))
    return folded


def _cuts(node: int, run: bytes, level: int, largest: bool):
    """(partner, part of the run) per partner of ``node`` in round ``level``; empty parts are not sent."""
    entries = _merged([run], largest)
    digit = (entries["d0"] >> np.uint64(64 - BITS * (level + 1)) & np.uint64((1 << BITS) - 1)).astype(np.int64)
    ends = np.searchsorted(digit, np.arange((1 << BITS) + 1))
    place = BITS * level
    for d in range(1 << BITS):
        if ends[d] < ends[d + 1]:
            yield node & ~(((1 << BITS) - 1) << place) | d << place, entries[ends[d]:ends[d + 1]].tobytes()


def _sent(level_runs: DataFrame, level: int, largest: bool) -> DataFrame:
    """Rows (node: receiver, partner: sender, run) of round ``level``."""
    def send(batches):
        for b in batches:
            for node, run in zip(b["node"].to_pylist(), b["run"].to_pylist()):
                rows = [{"node": to, "partner": node, "run": part} for to, part in _cuts(node, run, level, largest)]
                yield pa.RecordBatch.from_pylist(rows, _schema())

    return level_runs.select("node", "run").mapInArrow(send, _RUN)


def _received(sent: DataFrame, largest: bool) -> DataFrame:
    def merge(key, table):
        run = _merged(table["run"].to_pylist(), largest).tobytes()
        return pa.Table.from_pylist([{"node": key[0].as_py(), "partner": None, "run": run}], _schema())

    return sent.groupBy("node").applyInArrow(merge, _RUN)


def _answered(sent: DataFrame, answers: DataFrame) -> DataFrame:
    """Gives each sender back what it sent, with the row that stays and the count of all rows."""
    def answer(_, asked, known):
        found = np.frombuffer(b"".join(known["run"].to_pylist()), _ENTRY)
        rows = [{"node": to, "partner": None, "run": _filled(np.frombuffer(run, _ENTRY), found).tobytes()}
                for to, run in zip(asked["partner"].to_pylist(), asked["run"].to_pylist())]
        return pa.Table.from_pylist(rows, _schema())

    return sent.groupBy("node").cogroup(answers.groupBy("node")).applyInArrow(answer, _RUN)


def _filled(asked: np.ndarray, known: np.ndarray) -> np.ndarray:
    """``asked`` with id, row and count of the entry of the same key in ``known``, in the order of ``asked``."""
    both = np.concatenate([known, asked])
    order = np.lexsort([np.arange(len(both)), *(both[k] for k in reversed(_KEY))])
    last = _last_of_key(both[order])
    group = np.cumsum(last) - last
    heads = order[np.append(0, np.flatnonzero(last)[:-1] + 1)] if len(order) else order
    out = asked.copy()
    asks = order >= len(known)
    source = both[heads[group[asks]]]
    for field in ("has_id", "id", "row", "count"):
        out[field][order[asks] - len(known)] = source[field]
    return out


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """Rows (doc_id, keep_id, group_size, kept, text_sha256), one per row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; a null text is an empty one. Of equal texts the
    row with the largest (or smallest) id stays; a null id is below all others. Rows that also share the id are
    told apart by their place in the input, so exactly one row of a group is kept. No rows give no rows.
    """
    largest = {"largest": True, "smallest": False}[keep]

    def digest(batches):
        task, row, parts, held = TaskContext.get().partitionId(), 0, [], 0

        def run():
            entries = _sorted(np.concatenate(parts), largest)
            return pa.RecordBatch.from_pylist([{"node": task, "partner": None, "run": entries.tobytes()}], _schema())

        for b in (part for whole in batches for part in slices(whole)):
            entries = np.zeros(b.num_rows, _ENTRY)
            texts = [t.encode().lower() for t in b["text"].to_pylist()]
            sums = np.frombuffer(b"".join([hashlib.sha256(t).digest() for t in texts]), ">u8").reshape(-1, 4)
            for k in range(4):
                entries[f"d{k}"] = sums[:, k]
            entries["check"] = [xxhash.xxh3_64_intdigest(t) for t in texts]
            entries["size"] = [len(t) for t in texts]
            ids = b["doc_id"]
            entries["has_id"] = ids.is_valid().to_numpy(zero_copy_only=False)
            entries["id"] = ids.fill_null(0).to_numpy()
            entries["row"] = (task << 33) + row + np.arange(b.num_rows)
            entries["count"] = 1
            row += b.num_rows
            parts.append(entries)
            held += b.num_rows
            if held >= RUN_ROWS:
                yield run()
                parts, held = [], 0
        if held:
            yield run()

    leaves = materialise(id_and_text(docs, id_col, text_col).mapInArrow(lambda batches: trimmed(digest(batches), TRIMMED_SLICES), _RUN), "digests")
    top = leaves.agg(F.max("node")).first()[0] or 0
    rounds = max(1, -(-int(top).bit_length() // BITS))
    levels = [leaves]
    for level in range(rounds):
        levels.append(materialise(_received(_sent(levels[-1], level, largest), largest), "digests"))
    answers = levels[-1]
    for level in reversed(range(rounds)):
        answers = _answered(_sent(levels[level], level, largest), answers)

    def rows(_, own, known):
        asked = np.frombuffer(b"".join(own["run"].to_pylist()), _ENTRY)
        found = _filled(asked, np.frombuffer(b"".join(known["run"].to_pylist()), _ENTRY))
        digests = np.ascontiguousarray(np.stack([asked[f"d{k}"] for k in range(4)], axis=1)).tobytes()
        return pa.table({
            "doc_id": pa.array(asked["id"], mask=asked["has_id"] == 0),
            "keep_id": pa.array(found["id"], mask=found["has_id"] == 0),
            "group_size": pa.array(found["count"]),
            "kept": pa.array(asked["row"] == found["row"]),
            "text_sha256": [digests[i:i + 32].hex() for i in range(0, len(digests), 32)],
        }, schema=pa.schema([("doc_id", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("kept", pa.bool_()), ("text_sha256", pa.string())]))

    return leaves.groupBy("node").cogroup(answers.groupBy("node")).applyInArrow(
        rows, "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string"
    )
