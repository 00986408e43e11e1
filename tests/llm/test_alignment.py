import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import alignment as al

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def _byte_characters():
    keep = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in keep)}


def _spans(pieces):
    out, at = [], 0
    for p in pieces:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def brute(texts, libraries):
    """[(n_a, n_b, n_groups, links, group text)] by whole texts and two loops."""
    a_lib, b_lib = libraries
    chars, out = _byte_characters(), []
    for text in texts:
        if not text:
            out.append((0, 0, 0, [], None))
            continue
        a = a_lib.encode(" " + text, add_special_tokens=False).ids
        b = b_lib.encode(text)
        a_bytes = [bytes(chars[c] for c in a_lib.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b_lib.id_to_piece(i)) for i in b)]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            out.append((0, 0, 0, [], None))
            continue
        sa, sb = _spans(a_bytes), _spans(b_bytes)
        ends, links, j = {e for _, e in sa} & {e for _, e in sb}, [], 0
        for i, (s, e) in enumerate(sa):
            while sb[j][1] <= s:
                j += 1
            k = j
            while k < len(sb) and sb[k][0] < e:
                links.append((a[i], b[k]))
                k += 1
        groups, left, right, x, y = [], [], [], 0, 0
        for end in sorted(ends):
            while x < len(sa) and sa[x][1] <= end:
                left.append(a[x])
                x += 1
            while y < len(sb) and sb[y][1] <= end:
                right.append(b[y])
                y += 1
            groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
            left, right = [], []
        out.append((len(a), len(b), len(groups), links, ";".join(groups)))
    return out


def expected(rows, libraries):
    found = brute([t for _, t in rows], libraries)
    counts = Counter(p for f in found for p in f[3])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for (doc_id, _), (n_a, n_b, n_groups, links, text) in zip(rows, found):
        out.append((doc_id, n_a, n_b, n_groups, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
                    "" if text is None else hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def _rows(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=repr)


def _odd_texts():
    rng = random.Random(5)
    alphabet = ["a", "the", " ", "  ", "\n", "\t", "é", "👍🏽", "한국", "<s>", "<|endoftext|>", "0", "12345", "'s", "...", "　", "\x00", "Zebra", "᠎", "\x1c"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 30))) for _ in range(300)]
    return [*texts, "a▁b", "▁", " ", "a ", " a", "a  b", "x" * 3000, "  ", "word " * 500, "퟿ ok"]


def test_matches_whole_text_libraries(spark, libraries):
    rows = [(i, t) for i, t in enumerate(_odd_texts())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert _rows(al.align_tokenizers(docs, A, B)) == expected(rows, libraries)


@pytest.mark.parametrize("pairs", [al.BROADCAST_PAIRS, 0])
def test_given_documents(spark, docs, libraries, pairs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert _rows(al.align_tokenizers(docs, A, B, broadcast_pairs=pairs)) == expected(rows, libraries)


def test_ranges_over_tasks_and_rounds(spark, docs, libraries):
    """Ranges of 40 bytes make hundreds of fragments a document, in several rounds."""
    some = docs.filter("length(text) < 9000").limit(40)
    rows = [(r["doc_id"], r["text"]) for r in some.collect()] + [(10_000 + i, t) for i, t in enumerate(_odd_texts())]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert _rows(al.align_tokenizers(frame, A, B, chunk_bytes=40)) == expected(rows, libraries)


def test_fragments_join_in_any_order_of_brackets(libraries):
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        ends = [np.append(np.sort(rng.choice(n, int(rng.integers(0, n)), replace=False)) + 1, n + 1).astype(np.int64) for _ in range(2)]
        ends = [np.unique(e) for e in ends]
        tokens = al.Tokens(rng.integers(0, 5, len(ends[0])), ends[0], rng.integers(0, 5, len(ends[1])), ends[1])
        whole = al.Closed.of(tokens)
        borders = [0, *sorted(rng.choice(n + 1, int(rng.integers(0, n)), replace=False).tolist()), n + 1]
        parts = [al.Fragment.of(tokens.between(a, b)) for a, b in zip(borders, borders[1:])]
        while len(parts) > 1:
            i = int(rng.integers(0, len(parts) - 1))
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        got = parts[0].whole()
        assert got.text == whole.text and (got.n_a, got.n_b, got.n_groups, got.n_links) == (whole.n_a, whole.n_b, whole.n_groups, whole.n_links)
        assert got.pairs.tolist() == whole.pairs.tolist() and got.counts.tolist() == whole.counts.tolist()


def test_ranges_cover_a_text_once():
    text = "one two  three\n four " + "x" * 500 + " five é 👍🏽 six"
    for size in (1, 3, 7, 50, 10_000):
        ranges = al.byte_ranges(text, size)
        assert [r[0] for r in ranges] == [0, *[r[1] for r in ranges][:-1]] and ranges[-1][1] == len(text.encode()) + 1
        assert sum(len(r[3].encode()) for r in ranges if "x" * 400 in r[3]) <= 3 * 520


def test_odd_rows(spark, odd, none, libraries):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert _rows(al.align_tokenizers(odd, A, B)) == expected(rows, libraries)
    assert al.align_tokenizers(none, A, B).count() == 0
