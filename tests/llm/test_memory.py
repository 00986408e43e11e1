"""Passes over whole texts hold a few megabytes of them, and idle workers few pieces."""

from types import SimpleNamespace

import public_tokenizers
import pyarrow as pa

from tidemark.llm import common, jaccard, packing
from tidemark.session import TEXT_BATCH_BYTES

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


class Frame:
    """Keeps the function of a pass over texts, and the batch limit while it is written."""

    def __init__(self, spark):
        self.sparkSession, self.limits, self.passes = spark, [], []

    def mapInArrow(self, function, schema):
        self.passes.append(function)
        return self

    @property
    def write(self):
        return self

    def partitionBy(self, column):
        return self

    def parquet(self, path):
        self.limits.append(self.sparkSession.conf.get(LIMIT, None))


def test_texts_of_the_join_come_in_small_batches_and_slices(spark):
    docs = Frame(spark)
    jaccard._stored_sets(docs)
    assert [int(x) for x in docs.limits] == [TEXT_BATCH_BYTES] and spark.conf.get(LIMIT, None) is None
    texts = [" ".join(f"w{i}x{j}" for j in range(20_000)) for i in range(10)]  # 10 texts of 150 kB
    batch = pa.RecordBatch.from_arrays([pa.array(range(10), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    rows = [b.num_rows for b in docs.passes[0](iter([batch])) if b["kind"][0].as_py() == 0]
    assert sum(rows) == 10 and max(rows) * len(texts[0]) <= 1 << 20


def test_a_limit_of_the_session_stays(spark):
    docs = Frame(spark)
    spark.conf.set(LIMIT, "1000000")
    try:
        jaccard._stored_sets(docs)
        assert docs.limits == ["1000000"] == [spark.conf.get(LIMIT)]
    finally:
        spark.conf.unset(LIMIT)


def test_texts_to_pack_come_in_small_batches(spark, monkeypatch):
    limits, stored = [], packing.materialise
    monkeypatch.setattr(packing, "materialise", lambda df, name: limits.append(spark.conf.get(LIMIT, None)) or stored(df, name))
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id bigint, text string")
    assert packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).count() == 2
    assert [int(x) for x in limits] == [TEXT_BATCH_BYTES] and spark.conf.get(LIMIT, None) is None


def test_a_worker_keeps_few_pieces_after_packing(spark, monkeypatch):
    docs, path = Frame(spark), public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(packing, "id_and_text", lambda *a: docs)
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    packing.cut_documents(None, path, 2048, 0)
    common.forget_pieces()
    encoder = common.library_encoder(path, spaces=True)

    def packed(words):
        batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array([" ".join(f"p{i}" for i in range(words))])], ["doc_id", "text"])
        return [n for b in docs.passes[0](iter([batch])) for n in b["length"].to_pylist()]

    packed(1_000)
    assert len(encoder._known) == 1_000  # a few are kept for the next task
    monkeypatch.setattr(packing, "KEPT_PIECES", 2_000)
    assert packed(3_000) and not encoder._known


def test_a_pass_may_remember_fewer_pieces():
    encoder = common.library_encoder(public_tokenizers.path("byte_bpe_50k.json"), spaces=True)
    texts = [" ".join(f"q{i}x{j}" for j in range(40)) for i in range(1_024)]
    encoder.forget()
    encoder.remembered = None
    whole = list(encoder(texts))
    assert len(encoder._known) == 40 * 1_024
    encoder.forget()
    encoder.remembered = 5_000
    assert list(encoder(texts)) == whole and len(encoder._known) == 40 * 256
    encoder.remembered = None
