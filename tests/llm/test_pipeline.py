"""The corpus pipeline stage by stage, and the registered queries."""

from collections import Counter

import pytest

import corpus_pipeline
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.session import materialise

from ..oracle import compare, duck
from .test_duplicates import brute, groups
from .test_tokens import checked_packing


@pytest.fixture(scope="module")
def staged(spark, sf):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = materialise(stage(spark, docs, sf), name)
        out.append((before, docs))
    return out


def rows(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def test_columns_stay(staged):
    for before, after in staged:
        assert after.columns == before.columns


def test_toxicity_stage(spark, sf, staged):
    from tidemark.llm.toxicity import toxic_documents

    before, after = staged[0]
    rejected = {r["doc_id"] for r in toxic_documents(before, spark.read.parquet(f"{sf}/labels.parquet")).filter("rejected").collect()}
    assert Counter(rows(after)) == Counter(r for r in rows(before) if r[0] not in rejected)


def test_exact_stage(staged):
    before, after = staged[1]
    assert sorted(i for i, _ in rows(after)) == sorted(max(ids) for ids in groups(rows(before)).values())


def test_near_stage(staged):
    before, after = staged[2]
    assert sorted(i for i, _ in rows(after)) == sorted({component for _, _, component in brute(rows(before))})


def test_secret_stage(staged):
    from .test_filters import BASE, brute_base

    before, after = staged[3]
    texts = dict(rows(before))
    assert Counter(i for i, _ in rows(after)) == Counter(list(texts))
    for i, text in rows(after):
        assert text == texts[i] if not brute_base(texts[i]) else not [m for m in BASE["hex"].findall(text) if len(m) >= 24]


def test_packing_stage(spark, sf, staged):
    checked_packing(staged[3][1])
    assert corpus_pipeline.packing(spark, staged[3][1], sf).select("doc_id").distinct().count() == staged[3][1].count()


def test_odd_rows(spark, sf, odd, none):
    for source in (odd, none):
        docs = source
        for name, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, sf), name)
            if name != "best_fit_packing":
                assert docs.columns == source.columns
        assert (docs.count() > 0) == (source is odd)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, sf, name):
    assert compare(spark, duck(sf), sf, QUERIES[name], ORACLES[name]) == []


def test_a_query_per_operator():
    assert {int(n[2:].partition("_")[0]) for n in QUERIES} == set(range(1, 14))
