"""Alignment of the tokens of two tokenizers, through a monoid of byte-range fragments.

A and B tokens of a text cut the same bytes. Places where both end close a group. A fragment is what a range of bytes
tells of the groups: the tokens up to the first common end (open prefix, whose group may have begun earlier), the closed groups after it, and
the tokens behind the last common end (open suffix). Joining two neighbours closes one more group, from the suffix of the left and the
prefix of the right; fragments without a common end are all open. Joining is associative, so very long documents are
cut into byte ranges, whose fragments are made in tasks of their own and joined in a tree of rounds.

Short documents are closed fragments already, and described many at a time: the end of each is a common end.

Both tokenizers begin afresh at most spaces, so texts are encoded by the pieces between, each distinct one once as long as it is remembered.

Inside a group, links (an A and a B token that share bytes) are the stretches between neighbouring ends of either kind.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .common import byte_characters, id_and_text, slices, trimmed

#: Bytes of a range; longer documents are cut.
CHUNK_BYTES = 1 << 16
#: Bytes of short texts that are described together; each takes some 30 times as much memory meanwhile.
ALIGNED_BYTES = 1 << 20
#: Fragments that are joined in one round.
FAN = 16
#: Distinct id pairs up to which their corpus-wide counts are broadcast (about 100 bytes each); more are joined by exchange.
BROADCAST_PAIRS = 2_000_000
#: Distinct pieces that a task remembers.
KNOWN_PIECES = 400_000

#: A space at which both tokenizers begin afresh: after something that is no white space, and not the last character.
_CUT = re.compile("(?<=[^\\s᠎]) (?=.)", re.DOTALL)
_HEAD = (1 << 32) - 1


@dataclass
class Tokens:
    """Tokens of both kinds in order; ``ends`` are byte offsets in the document."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate([x, y]) for x, y in zip(self.parts, other.parts)))

    @property
    def parts(self) -> tuple[np.ndarray, ...]:
        return self.a, self.a_ends, self.b, self.b_ends

    def between(self, low: int, high: int) -> Tokens:
        """Those that end after ``low`` and not after ``high``."""
        i, j = (slice(*np.searchsorted(e, [low, high], "right")) for e in (self.a_ends, self.b_ends))
        return Tokens(self.a[i], self.a_ends[i], self.b[j], self.b_ends[j])


NO_TOKENS = Tokens(*(np.zeros(0, np.int64) for _ in range(4)))


def _merged(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distinct values of two ascending arrays; a stable sort merges the two runs."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    return both[np.append(True, both[1:] != both[:-1])] if len(both) else both


def common_ends(tokens: Tokens) -> np.ndarray:
    both = np.concatenate([tokens.a_ends, tokens.b_ends])
    both.sort(kind="stable")
    return both[1:][both[1:] == both[:-1]]


#: Ids in decimals with the mark that follows, filled as far as needed.
_NAMES: dict[str, np.ndarray] = {}


def _named(ids: np.ndarray, mark: str) -> np.ndarray:
    known, most = _NAMES.get(mark, np.zeros(0, object)), int(ids.max(initial=-1)) + 1
    if len(known) < most:
        known = _NAMES[mark] = np.array([f"{i}{mark}" for i in range(most)], object)
    return known[ids]


def _texts(tokens: Tokens, common: np.ndarray, bounds: np.ndarray) -> list[str]:
    """The groups of each document as text; ``bounds`` are the numbers of groups up to the end of each document."""
    a_upto, b_upto = (np.searchsorted(e, common, "right") for e in (tokens.a_ends, tokens.b_ends))
    a_n, b_n = np.diff(a_upto, prepend=0), np.diff(b_upto, prepend=0)
    parts = np.empty(len(tokens.a) + len(tokens.b), object)
    for ids, upto, sizes, before, mark in ((tokens.a, a_upto, a_n, b_upto - b_n, "|"), (tokens.b, b_upto, b_n, a_upto, ";")):
        place = np.arange(len(ids)) + np.repeat(before, sizes)
        parts[place] = _named(ids, ",")
        parts[place[upto - 1]] = _named(ids[upto - 1], mark)
    ends = np.append(0, a_upto + b_upto)[np.append(0, bounds)].tolist()
    return ["".join(parts[i:j])[:-1] for i, j in zip(ends, ends[1:])]


@dataclass
class Closed:
    """Closed groups: their text, number of tokens, groups and links, and count by pair (A id * 2**32 + B id)."""

    text: str = ""
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @classmethod
    def of(cls, tokens: Tokens) -> Closed:
        """Groups of ``tokens``, whose last ends are common."""
        return cls.of_each(tokens, tokens.a_ends[-1:])[0] if len(tokens.a) else cls()

    @classmethod
    def of_each(cls, tokens: Tokens, ends: np.ndarray) -> list[Closed]:
        """Groups of each of the documents that end at ``ends``, which are ascending common ends."""
        common, links = common_ends(tokens), _merged(tokens.a_ends, tokens.b_ends)
        groups = np.searchsorted(common, ends, "right")
        texts = _texts(tokens, common, groups)
        a, b = tokens.a[np.searchsorted(tokens.a_ends, links)], tokens.b[np.searchsorted(tokens.b_ends, links)]
        # One number per document and pair; below 2 ** 63 for vocabularies of a million and slices of a million documents.
        wide_a, wide_b = int(a.max(initial=0)) + 1, int(b.max(initial=0)) + 1
        key = (np.searchsorted(ends, links) * wide_a + a) * wide_b + b
        key.sort()
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        times, key = np.diff(np.append(first, len(key))), key[first]
        pairs, doc = (key // wide_b % wide_a) << 32 | key % wide_b, key // wide_b // wide_a
        cuts = np.searchsorted(doc, np.arange(len(ends) + 1)).tolist()
        counted = [np.diff(np.searchsorted(e, ends, "right"), prepend=0).tolist() for e in (tokens.a_ends, tokens.b_ends, common, links)]
        return [cls(text, *n, pairs[i:j], times[i:j]) for text, *n, i, j in zip(texts, *counted, cuts, cuts[1:])]

    def __add__(self, other: Closed) -> Closed:
        pairs, at = np.unique(np.concatenate([self.pairs, other.pairs]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([self.counts, other.counts]), len(pairs)).astype(np.int64)
        return Closed(";".join(filter(None, (self.text, other.text))), self.n_a + other.n_a, self.n_b + other.n_b,
                      self.n_groups + other.n_groups, self.n_links + other.n_links, pairs, counts)


@dataclass
class Fragment:
    """What a range of bytes tells of the groups. ``closed`` is None where no common end lies in the range; all tokens are then in ``prefix``."""

    prefix: Tokens = field(default_factory=lambda: NO_TOKENS)
    closed: Closed | None = None
    suffix: Tokens = field(default_factory=lambda: NO_TOKENS)

    @classmethod
    def of(cls, tokens: Tokens) -> Fragment:
        common = common_ends(tokens)
        if not len(common):
            return cls(tokens)
        first, last = int(common[0]), int(common[-1])
        return cls(tokens.between(-1, first), Closed.of(tokens.between(first, last)), tokens.between(last, np.iinfo(np.int64).max))

    def __add__(self, other: Fragment) -> Fragment:
        if self.closed is None:
            return Fragment(self.prefix + other.prefix, other.closed, other.suffix)
        if other.closed is None:
            return Fragment(self.prefix, self.closed, self.suffix + other.prefix)
        return Fragment(self.prefix, self.closed + Closed.of(self.suffix + other.prefix) + other.closed, other.suffix)

    def whole(self) -> Closed:
        """All groups, of the fragment of a whole text: its first group begins at byte 0."""
        return Closed.of(self.prefix) + self.closed if self.closed else Closed()


class BothTokenizers:
    """Tokens of texts by the pieces between cuts; one per worker process, remembers pieces.

    ``path_a`` is a byte-level file of the ``tokenizers`` library, ``path_b`` a sentencepiece model; both see a space before a text.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True  # their strings in a text are plain text
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        vocabulary = {i: t for t, i in self._a.get_vocab(with_added_tokens=True).items()}
        self._bytes_a = [bytes(byte_of.get(c, 63) for c in vocabulary.get(i, "")) for i in range(max(vocabulary) + 1)]
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{path_b}: a piece goes over a space, so texts cannot be cut there")
        self._bytes_b = [bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self._size_a, self._size_b = (np.array(list(map(len, x)), np.int64) for x in (self._bytes_a, self._bytes_b))
        self._ids_a: dict[str, bytes | None] = {}
        self._ids_b: dict[str, bytes | None] = {}
        self._odd: set[str] = set()

    def pieces(self, texts: list[str]) -> list[list[str]]:
        """The pieces of each text, whose tokens are known from then on."""
        if len(self._ids_a) > KNOWN_PIECES:
            self._ids_a, self._ids_b, self._odd = {}, {}, set()
        cut = [t.split(" ") for t in texts]
        new = set().union(*cut).difference(self._ids_a)
        self._odd.update(p for p in new if not p or p[-1].isspace() or p[-1] == "᠎")  # no cut after these
        if self._odd:
            cut = [p if self._odd.isdisjoint(p) else _CUT.split(t) for p, t in zip(cut, texts)]
            new = set().union(*cut).difference(self._ids_a)
        self._learn(list(new))
        return cut

    def _learn(self, pieces: list[str]) -> None:
        for start in range(0, len(pieces), 10_000):
            some = pieces[start:start + 10_000]
            spaced = [f" {p}" for p in some]
            for piece, whole, a, b in zip(some, spaced, self._a.encode_batch_fast(spaced, add_special_tokens=False), self._b.encode(some, num_threads=1)):
                ids, data = a.ids, whole.encode()
                same = b"".join(map(self._bytes_a.__getitem__, ids)) == data == b"".join(map(self._bytes_b.__getitem__, b))
                self._ids_a[piece], self._ids_b[piece] = (array("I", ids).tobytes(), array("I", b).tobytes()) if same else (None, None)

    def ids(self, pieces: list[str]) -> tuple[bytes, bytes] | None:
        """A and B ids of neighbouring pieces, 4 bytes each; None where the tokens of one do not spell it."""
        try:
            return b"".join(map(self._ids_a.__getitem__, pieces)), b"".join(map(self._ids_b.__getitem__, pieces))
        except TypeError:
            return None

    def tokens(self, ids: list[tuple[bytes, bytes]], start: int = 0) -> Tokens:
        """Tokens of neighbouring ``ids`` from byte ``start`` on."""
        a, b = (np.frombuffer(b"".join(x), np.uint32).astype(np.int64) for x in zip(*ids)) if ids else (NO_TOKENS.a, NO_TOKENS.b)
        return Tokens(a, start + np.cumsum(self._size_a[a]), b, start + np.cumsum(self._size_b[b]))


_LOADED: dict[tuple[str, str], BothTokenizers] = {}


def both_tokenizers(path_a: str, path_b: str) -> BothTokenizers:
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = BothTokenizers(path_a, path_b)
    return _LOADED[path_a, path_b]


_ALIGNED = ("row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
            "pairs array<bigint>, counts array<bigint>")
_ALIGNED_NAMES = [c.split()[0] for c in _ALIGNED.split(", ")]


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *parts])))


def _aligned_batch(rows, ids, closed: list[Closed]) -> pa.RecordBatch:
    sha = [hashlib.sha256(c.text.encode()).hexdigest() if c.n_a else "" for c in closed]
    numbers = [pa.array([getattr(c, n) for c in closed], pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")]
    return pa.RecordBatch.from_arrays([rows, ids, *numbers, pa.array(sha, pa.string()), _lists([c.pairs for c in closed]), _lists([c.counts for c in closed])], _ALIGNED_NAMES)


def _of_short(batches, path_a: str, path_b: str):
    """Aligned rows of whole texts, each a closed fragment."""
    both = both_tokenizers(path_a, path_b)
    for b in (part for whole in batches for part in slices(whole, size=ALIGNED_BYTES)):
        texts = b["text"].to_pylist()
        ids = [both.ids(pieces) if text else None for text, pieces in zip(texts, both.pieces(texts))]
        tokens = both.tokens([x for x in ids if x])
        n_a = np.cumsum([len(x[0]) // 4 for x in ids if x], dtype=np.int64)
        closed = iter(Closed.of_each(tokens, tokens.a_ends[n_a - 1]))
        yield _aligned_batch(b["row"], b["doc_id"], [next(closed) if x else Closed() for x in ids])


# ---------------------------------------------------------------- long documents

_RANGES = "row bigint, doc_id bigint, chunk int, low bigint, high bigint, start bigint, text string"


def byte_ranges(text: str, size: int) -> list[tuple[int, int, int, str]]:
    """(low, high, start, part) of ranges of about ``size`` bytes of " " + text, from byte ``low`` up to ``high``.

    ``part`` holds the pieces that the range touches, ``start`` is the byte of the space before it. Ranges end anywhere in a piece; of a piece longer than a range only the
    first border counts, so that it is tokenized twice at most.
    """
    data = text.encode()
    cuts = np.array([0, *_byte_cuts(text)], np.int64)
    ends = np.append(cuts[1:], len(data) + 1)
    borders = []
    for border in range(size, len(data) + 1, size):
        piece = int(np.searchsorted(cuts, border, "right")) - 1
        if not borders or cuts[piece] > borders[-1]:
            borders.append(border)
    out, edges = [], [0, *borders, len(data) + 1]
    for low, high in zip(edges, edges[1:]):
        if low < high:
            first, last = int(np.searchsorted(ends, low, "right")), int(np.searchsorted(ends, high, "left"))
            out.append((low, high, int(cuts[first]), data[cuts[first]:ends[last] - 1].decode()))
    return out


def _byte_cuts(text: str) -> list[int]:
    """Byte offsets in " " + text of the spaces at which pieces but the first begin."""
    out, at, bytes_before = [], 0, 1
    for m in _CUT.finditer(text):
        bytes_before += len(text[at:m.start()].encode())
        at = m.start()
        out.append(bytes_before)
    return out


def _cut(batches, size: int):
    for b in batches:
        for row, doc_id, text in zip(b["row"].to_pylist(), b["doc_id"].to_pylist(), b["text"].to_pylist()):
            ranges = byte_ranges(text, size)
            low, high, start, parts = zip(*ranges)
            n = len(ranges)
            yield pa.RecordBatch.from_arrays([
                pa.array([row] * n, pa.int64()), pa.array([doc_id] * n, pa.int64()), pa.array(range(n), pa.int32()), *(pa.array(x, pa.int64()) for x in (low, high, start)), pa.array(parts, pa.string())],
                ["row", "doc_id", "chunk", "low", "high", "start", "text"])


_TOKEN_FIELDS = [f"{side}_{name}" for side in ("prefix", "suffix") for name in ("a", "a_ends", "b", "b_ends")]
_FRAGMENT = ("row bigint, doc_id bigint, chunk int, good boolean, closes boolean, closed string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
             + ", ".join(f"{f} array<bigint>" for f in ["pairs", "counts", *_TOKEN_FIELDS]))


def _fragment_table(keys: list[tuple], fragments: list[Fragment | None]) -> pa.Table:
    """Rows of ``keys`` (row, doc_id, chunk) and fragments; None, for a range whose tokens do not spell it, is not good."""
    found = [f or Fragment() for f in fragments]
    closed = [f.closed or Closed() for f in found]
    columns = {n: pa.array([k[i] for k in keys], t) for i, (n, t) in enumerate((("row", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int32())))}
    columns |= {"good": pa.array([f is not None for f in fragments]), "closes": pa.array([f.closed is not None for f in found]), "closed": pa.array([c.text for c in closed], pa.string())}
    columns |= {n: pa.array([getattr(c, n) for c in closed], pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")}
    columns |= {n: _lists([getattr(c, n) for c in closed]) for n in ("pairs", "counts")}
    tokens = [[*f.prefix.parts, *f.suffix.parts] for f in found]
    columns |= {n: _lists([t[i] for t in tokens]) for i, n in enumerate(_TOKEN_FIELDS)}
    return pa.table(columns)


def _fragments_in(table: pa.Table) -> list[Fragment | None]:
    out = []
    for r in table.to_pylist():
        arrays = {n: np.array(r[n], np.int64) for n in ["pairs", "counts", *_TOKEN_FIELDS]}
        sides = [Tokens(*(arrays[f"{s}_{n}"] for n in ("a", "a_ends", "b", "b_ends"))) for s in ("prefix", "suffix")]
        closed = Closed(r["closed"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], arrays["pairs"], arrays["counts"]) if r["closes"] else None
        out.append(Fragment(sides[0], closed, sides[1]) if r["good"] else None)
    return out


def _fragments(batches, path_a: str, path_b: str):
    both = both_tokenizers(path_a, path_b)
    for b in batches:
        for row in b.to_pylist():
            ids = both.ids(both.pieces([row["text"]])[0])
            fragment = Fragment.of(both.tokens([ids], row["start"]).between(row["low"], row["high"])) if ids else None
            yield from _fragment_table([(row["row"], row["doc_id"], row["chunk"])], [fragment]).to_batches()


def _join_neighbours(table: pa.Table) -> pa.Table:
    """The fragments of one document and FAN neighbouring ranges, joined in order; one bad range makes all bad."""
    table = table.sort_by("chunk")
    found = _fragments_in(table)
    total = None if None in found else sum(found[1:], found[0])
    return _fragment_table([(table["row"][0].as_py(), table["doc_id"][0].as_py(), table["chunk"][0].as_py() // FAN)], [total])


def _of_long(docs: DataFrame, path_a: str, path_b: str, size: int) -> DataFrame:
    """Aligned rows of the documents ``docs`` (row, doc_id, text): ranges are dealt over tasks, and their fragments joined FAN at a time."""
    ranges = docs.mapInArrow(lambda batches: _cut(batches, size), _RANGES).repartition("row", "chunk")
    fragments = materialise(ranges.mapInArrow(lambda batches: trimmed(_fragments(batches, path_a, path_b)), _FRAGMENT), "fragments")
    last = fragments.agg(F.max("chunk")).first()[0] or 0
    while last > 0:
        joined = fragments.groupBy("row", F.floor(F.col("chunk") / FAN).alias("_part")).applyInArrow(_join_neighbours, _FRAGMENT)
        fragments, last = materialise(joined, "fragments"), last // FAN

    def finish(batches):
        for b in batches:
            closed = [f.whole() if f else Closed() for f in _fragments_in(pa.Table.from_batches([b]))]
            yield _aligned_batch(b["row"], b["doc_id"], closed)

    return fragments.mapInArrow(finish, _ALIGNED)


# ---------------------------------------------------------------- corpus


def aligned_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Stored rows (row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, counts), one per row of ``docs``.

    ``pairs`` are the linked ids, A * 2**32 + B, and ``counts`` their links in the document.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "text")
    long = F.octet_length("text") > chunk_bytes
    short = rows.filter(~long).mapInArrow(lambda batches: trimmed(_of_short(batches, path_a, path_b)), _ALIGNED)
    # Rows of long documents get numbers of their own, as those of a second scan need not be the same.
    return materialise(short.union(_of_long(materialise(rows.filter(long).withColumn("row", -1 - F.col("row")), "long"), path_a, path_b, chunk_bytes)), "aligned")


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                     chunk_bytes: int = CHUNK_BYTES, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one per row of ``docs``.

    Null and empty texts, and those that the tokens of one side do not spell, have no tokens: zeros and an empty digest. A pair's count
    is the number of its links in all rows, repeated ones included. Null ids are rows like others.
    """
    aligned = aligned_documents(docs, path_a, path_b, id_col, text_col, chunk_bytes)
    single = aligned.select("row", F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    counts = materialise(single.groupBy("pair").agg(F.sum("n").alias("count")), "pairs")
    b = F.col("pair").bitwiseAND(F.lit(_HEAD)).alias("b")
    best = counts.groupBy(b).agg(F.max("count").alias("most"))  # a row per id of B
    facts = counts.withColumn("b", b).join(best, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("is_best"))
    if counts.count() <= broadcast_pairs:
        facts = F.broadcast(facts)
    summed = single.join(facts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("is_best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    out = aligned.drop("pairs", "counts").join(summed, "row", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
