"""Tokenizers, packing and token files against the libraries and brute force."""

import base64
import gc
import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing, simple8b
from tidemark.llm.bin_completion import best_fit, lower_bound, pack
from tidemark.llm.bpe import ByteBPE, decode_documents, encode_documents, round_trip_digests
from tidemark.llm.common import library_encoder, trimmed
from tidemark.llm.packing import pack_documents
from tidemark.llm.token_files import read_token_files, write_token_files
from tidemark.session import fresh_path

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PATTERN = public_tokenizers.PATTERN
pieces = st.sampled_from(["a", "é", " ", "\n", "\t", "\x0b", " ", "　", "\x1c", "1", "½", "'s", "'", "!", "日", "👍", "Ω", "\r\n", "᠎", "don't", "İ", "é", "\x00", "⁇", "<|endoftext|>", "Word.", "ß,"])
texts = st.lists(pieces, max_size=15).map("".join) | st.text(max_size=20)


@pytest.fixture(scope="module")
def bpe():
    return ByteBPE(RANKS, PATTERN)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_sentencepiece_model_equals_ranks(bpe, reference):
    @settings(max_examples=400, deadline=None)
    @given(texts)
    def same(text):
        ids = bpe.encode(text)
        assert ids == reference.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()

    same()


@pytest.mark.parametrize(("path", "spaces"), [(BYTES, True), (WORDS, False)])
def test_pieces_equal_whole_texts(path, spaces):
    encode, whole = library_encoder(path, spaces), library(path)

    @settings(max_examples=400, deadline=None)
    @given(texts)
    def same(text):
        assert np.frombuffer(next(encode([text])), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids

    same()


@pytest.mark.parametrize(("path", "spaces"), [(BYTES, True), (WORDS, False)])
def test_learning_pieces_keeps_no_lists(path, spaces):
    """Lists kept for every new piece set off a collection every 2,000 of them."""
    encode, rounds = library_encoder(path, spaces), []
    letters = ["".join(chr(97 + i // 26 ** k % 26) for k in range(4)) for i in range(20_000)]
    words = [f"{w}q{w}," for w in letters]
    text = " ".join(words)
    gc.collect()
    gc.callbacks.append(lambda phase, info: rounds.append(info) if phase == "start" else None)
    try:
        ids = next(encode([text]))
    finally:
        gc.callbacks.pop()
    assert len(rounds) < 8
    assert np.frombuffer(ids, "<u4").tolist() == library(path).encode(text, add_special_tokens=False).ids


def test_other_passes_drop_known_pieces():
    """A worker that packed texts and then does something else holds no pieces any more."""
    encode = library_encoder(BYTES, True)
    want = next(encode(["several pieces, known"]))
    assert list(trimmed(iter("ab"), tokens=True)) == ["a", "b"] and encode._known
    assert list(trimmed(iter("ab"))) == ["a", "b"] and not encode._known
    assert next(encode(["several pieces, known"])) == want


def test_round_trip(spark, odd, docs, reference):
    for frame in (odd, docs):
        rows = frame.select("doc_id", "text").collect()
        want = Counter()
        for r in rows:
            ids = reference.encode_ordinary(r["text"] or "")
            want[r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()] += 1
        assert Counter(map(tuple, round_trip_digests(frame, RANKS, PATTERN).collect())) == want


def test_encode_and_decode_frames(odd):
    encoded = encode_documents(odd, RANKS, PATTERN)
    decoded = decode_documents(encoded, RANKS, PATTERN)
    assert Counter((r[0], bytes(r[1])) for r in decoded.collect()) == Counter((r["doc_id"], (r["text"] or "").encode()) for r in odd.collect())


def checked_packing(frame, capacity=2048):
    whole = library(BYTES)
    rows = pack_documents(frame, BYTES, capacity).collect()
    want = Counter()
    for r in frame.select("doc_id", "text").collect():
        ids = [*whole.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        at, length = 0, (len(ids) - 1) % capacity + 1
        for piece in range(-(-len(ids) // capacity)):
            want[r["doc_id"], piece, at, length, zlib.crc32(np.array(ids[at:at + length], "<u4").tobytes())] += 1
            at, length = at + length, capacity
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), Counter(r["length"] for r in rows)


def test_packing(docs, odd):
    bins, lengths = checked_packing(docs)
    assert bins <= lower_bound(lengths, 2048) + 1
    checked_packing(odd, 64)


def test_empty_tables(spark, none):
    assert pack_documents(none, BYTES).count() == 0
    assert round_trip_digests(none, RANKS, PATTERN).count() == 0
    folder = fresh_path(spark, "tokens")
    write_token_files(none, folder, WORDS, end_id=1)
    assert read_token_files(spark, folder).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 6), max_size=15))
def test_bin_completion_packs_everything(counts):
    plan, first = pack(counts, 40), best_fit(counts, 40)
    for p in (plan, first):
        packed = Counter()
        for filling, n in p:
            assert sum(filling) <= 40
            for length in filling:
                packed[length] += n
        assert packed == Counter(counts)
    size = sum(n for _, n in plan)
    assert lower_bound(counts, 40) <= size <= sum(n for _, n in first)


def test_bin_completion_beats_best_fit():
    counts = Counter({51: 2, 27: 2, 26: 2, 23: 2, 24: 2, 25: 2, 22: 2})
    assert sum(n for _, n in pack(counts, 100)) == lower_bound(counts, 100)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=700))
def test_simple8b_round_trip(values):
    words, before = simple8b.encode(np.array(values, np.uint64))
    assert simple8b.decode(words, len(values)).tolist() == values
    assert len(before) // 4 == -(-(len(words) // 8) // simple8b.STRIDE)


def test_simple8b_marks_count_values():
    values = np.arange(5000, dtype=np.uint64) % 3000
    words, before = simple8b.encode(values)
    mark = int(np.frombuffer(before, "<u4")[3])
    assert simple8b.decode(words[8 * 3 * simple8b.STRIDE:], len(values) - mark).tolist() == values[mark:].tolist()


def test_token_files(spark, odd, docs):
    whole = library(WORDS)
    for frame in (docs, odd):
        folder = fresh_path(spark, "tokens")
        write_token_files(frame, folder, WORDS, end_id=1, block_ids=500)
        got = sorted(read_token_files(spark, folder).collect(), key=lambda r: r["start"])
        at = 0
        for r in got:
            assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
            at += r["n_tokens"]
        order = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
        assert order == sorted(order)
        want = Counter((r["doc_id"], tuple([*whole.encode(r["text"] or "", add_special_tokens=False).ids, 1])) for r in frame.collect())
        assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want


def test_packing_takes_a_batch_in_slices(spark, monkeypatch):
    """Texts of one batch become strings a slice at a time, and the pieces stay the same."""
    docs = spark.createDataFrame([(i, "some words of text " * (1 + i % 5)) for i in range(40)], "doc_id bigint, text string").coalesce(1)
    path = public_tokenizers.path("byte_bpe_50k.json")
    read = lambda: sorted(map(tuple, packing.cut_documents(docs, path, 16, 0).drop("task").collect()))
    whole, taken = read(), spark.sparkContext.accumulator(0)
    monkeypatch.setattr(packing, "slices", lambda b: (taken.add(1) or b.slice(at, 1) for at in range(b.num_rows)), raising=False)
    assert read() == whole and taken.value == 40
