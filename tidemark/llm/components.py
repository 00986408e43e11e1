"""Connected components of links, as joins and aggregations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialise


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its tree) for the links a[i] - b[i]; roots are left out."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = index[:len(a)], index[len(a):]
    parent = np.arange(len(nodes))
    while True:  # hook the larger root under the smaller, then shorten paths
        low, high = np.minimum(parent[left], parent[right]), np.maximum(parent[left], parent[right])
        if (low == high).all():
            break
        np.minimum.at(parent, high, low)
        while (parent[parent] != parent).any():
            parent = parent[parent]
    inner = parent != np.arange(len(nodes))
    return nodes[inner], nodes[parent[inner]]


def _contracted(links: DataFrame) -> DataFrame:
    """The links of each task as stars around their smallest nodes."""
    def contract(batches):
        tables = [pa.Table.from_batches([b]) for b in batches]
        if tables:
            both = pa.concat_tables(tables)
            node, root = local_forest(both["a"].to_numpy(), both["b"].to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["a", "b"])

    return links.select("a", "b").mapInArrow(contract, "a bigint, b bigint")


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One half step: link neighbours to the smallest of the neighbourhood instead of to each other."""
    if large:
        near = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = near.join(least, "a")
    moved = joined.filter("b > a") if large else joined
    out = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.union(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component): every node of ``links`` (a, b) with the smallest node it is connected to.

    Alternating large and small stars; each round is stored, and rounds end when no link changes. Links are first
    contracted per task, so chains inside a task take no round. No links, no rows.
    """
    stored = materialise(_contracted(links), "links")
    before = None
    while True:
        mark = stored.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        stored = materialise(_star(_star(stored, large=True), large=False), "links")
    inner = stored.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    roots = stored.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return inner.union(roots)
