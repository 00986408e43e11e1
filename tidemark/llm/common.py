"""What the operators share: the two columns they read, and piecewise tokenization."""

from __future__ import annotations

import contextlib
import ctypes
import re
import struct
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

#: Pieces a worker remembers before it starts afresh; about 200 bytes each.
REMEMBERED_PIECES = 1_000_000
#: Of these, those that a worker may keep between tasks of the packing pass, as more workers live than run.
KEPT_PIECES = 200_000
#: Slices of texts after which a task gives freed memory back, as it does at its end.
TRIMMED_SLICES = 8
#: Bytes of texts that a task works on at a time; one text may have more.
SLICE_BYTES = 4 << 20


def give_back() -> None:
    """Freed memory goes back to the system, as a process lives on after its task or fit."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # the C library of other systems has no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def forget_pieces() -> None:
    """Encoders outlive their tasks, with the pieces they know; another pass of the same worker needs that memory."""
    held = [e for e in _LOADED.values() if e.forget()]
    if held:
        give_back()


def trimmed(batches, every: int | None = None, tokens: bool = False):
    """Passes on ``batches`` and gives freed memory back, also after ``every`` so many of them. Before a pass other than of
    ``tokens``, what earlier ones remember of pieces goes."""
    if not tokens:
        forget_pieces()
    for n, batch in enumerate(batches, 1):
        yield batch
        if every and n % every == 0:
            del batch
            give_back()
    give_back()


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES):
    """``batch`` in slices of about ``size`` bytes of text, so that memory follows bytes and not rows."""
    ends = np.cumsum(pc.binary_length(batch[column]).fill_null(0).to_numpy().astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(int(np.searchsorted(ends, before + size, "right")), start + 1)
        yield batch.slice(start, end - start)
        start = end


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id (BIGINT) and text (never null), and no other."""
    return docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where printable, else from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def id_bytes(ids: list[int]) -> bytes:
    """As little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class PieceEncoder:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes, from the ids of their pieces.

    Tokenizers that split at white space give a space-separated piece the same ids wherever it
    stands, so each distinct piece is encoded once. ``encode_many(pieces)`` returns the ids of each as such bytes,
    ``encode_whole(text)`` those of one text as numbers. With ``spaces``, a piece carries the space or line
    break before it, which holds only between pieces free of white space: a text with any other
    white space is encoded whole. Without, white space has no ids and never matters. With ``lower`` the tokenizer
    lower-cases; texts of letters for which that is beyond doubt are lower-cased here, so that fewer pieces differ.
    """

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], encode_whole: Callable[[str], list], spaces: bool, lower: bool = False):
        self._many, self._whole, self._spaces, self._lower = encode_many, encode_whole, spaces, lower
        self._known: dict[str, bytes | None] = {}
        self.remembered: int | None = None  # REMEMBERED_PIECES unless a pass says otherwise
        self._newline = id_bytes(encode_whole("\n"))

    def forget(self, beyond: int = 0) -> bool:
        """Drops the known pieces if there are more than ``beyond``; whether there were."""
        held = len(self._known) > beyond
        if held:
            self._known = {}
        return held

    def _learn(self, pieces: list[str], line: bool) -> None:
        """``pieces`` follow a line break if ``line``, else a space."""
        known, mark = self._known, "\n" if line else ""
        if self._spaces:  # None marks a piece whose ids depend on what stands beside it
            joined = "\n".join(pieces)
            if joined.split() != pieces or "\u180e" in joined:
                alone = {p for p in pieces if p.split() != [p] or "\u180e" in p}
                known.update((mark + p, None) for p in alone)
                pieces = [p for p in pieces if p not in alone]
        before, head = ("", self._newline) if line or not self._spaces else (" ", b"")
        for start in range(0, len(pieces), 2048):
            part = pieces[start:start + 2048]
            found = self._many([before + p for p in part] if before else part)
            known.update(((mark + p, head + ids) for p, ids in zip(part, found)) if line or head else zip(part, found))

    def __call__(self, texts: list[str]):
        """Yields the ids of each text, in order."""
        skip = len(self._newline)
        for start in range(0, len(texts), 256):
            if len(self._known) > (self.remembered or REMEMBERED_PIECES):
                self._known.clear()
            some = texts[start:start + 256]
            if self._spaces:
                cut = [f"\n{t}".replace("\n", " \n").split(" ")[1:] for t in some]
            else:
                cut = [(t.lower() if self._lower and not _RARE.search(t) else t).replace("\n", " ").split(" ") for t in some]
            new = set().union(*cut).difference(self._known)
            self._learn([p for p in new if p[:1] != "\n"], False)
            self._learn([p[1:] for p in new if p[:1] == "\n"], True)
            get = self._known.__getitem__
            for text, pieces in zip(some, cut):
                try:
                    ids = b"".join(map(get, pieces))
                    yield ids[skip:] if self._spaces else ids
                except TypeError:
                    yield id_bytes(self._whole(text))


#: A piece of plain Latin letters with punctuation after it: two words for every splitter, whose letters normalise to themselves.
_PLAIN = re.compile(r"( ?)([A-Za-zÀ-ÖØ-öø-\u012f\u0131-\u02af]+)([.,;:!?]*)")
_RARE = re.compile("[\u0130\u0250-\U0010ffff]")
_PROBES = ["Ab", " Ab", "éÀ.", "straße,", "ñ?!", " Łódź;", "a"]
_LOADED: dict[tuple, PieceEncoder] = {}


def library_encoder(path: str, spaces: bool) -> PieceEncoder:
    """Encoder of a ``tokenizers`` file; one per worker process. The file is public and on every node.

    Strings of special tokens in a text are ordinary text. Pieces pass through the file's own
    normaliser, splitter and model, many at a time: they are joined by a separator that the splitter
    makes a word of its own (a line break, or, where white space vanishes, a zero byte between spaces).
    """
    if (path, spaces) not in _LOADED:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        normaliser, splitter, model = tokenizer.normalizer, tokenizer.pre_tokenizer, tokenizer.model
        separator = "\n" if spaces else " \0 "

        def whole(text: str) -> list[int]:
            return tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

        def words_of(text: str) -> list[str]:
            return [w for w, _ in splitter.pre_tokenize_str(normaliser.normalize_str(text) if normaliser else text)]

        letters = {i: c for i, c in enumerate(byte_characters())}
        lower = words_of("A") == words_of("a")

        plain, blank = _PLAIN.fullmatch, letters[32]

        def plain_words(piece: str) -> list[str] | None:
            """What ``words_of`` gives for a plain piece, at a third of its cost."""
            if not (found := plain(piece)):
                return None
            space, word, mark = found.groups()
            if lower:
                word = word.lower()
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(letters)
            if spaces and space:
                word = blank + word
            return [word, mark] if mark else [word]

        if any(plain_words(p) != words_of(p) for p in _PROBES):
            plain_words = lambda piece: None  # noqa: E731  another kind of splitter
        (cut,) = words_of(separator)

        def by_library(pieces: list[str]) -> list[list[str]]:
            if any("\0" in p for p in pieces):
                return [words_of(p) for p in pieces]
            out: list[list[str]] = [[]]
            for w in words_of(separator.join(pieces)):
                if w == cut:
                    out.append([])
                else:
                    out[-1].append(w)
            if len(out) != len(pieces):
                raise ValueError(f"{path}: the separator is not a word of its own")
            return out

        tokenize = model.tokenize
        of_mark = lru_cache(4096)(lambda mark: id_bytes([t.id for t in tokenize(mark)]))

        def many(pieces: list[str]) -> list[bytes]:
            """Words of plain pieces hardly repeat, so they go straight to the model; the marks after them and other pieces' words do.

            Ids become bytes at once: lists kept for all pieces would set off the garbage collector again and again.
            """
            out, others = [], []
            for piece in pieces:
                if words := plain_words(piece):
                    ids = id_bytes([t.id for t in tokenize(words[0])])
                    out.append(ids + of_mark(words[1]) if len(words) > 1 else ids)
                else:
                    others.append(len(out))
                    out.append(b"")
            if others:
                found = by_library([pieces[i] for i in others])
                ids = {w: id_bytes([t.id for t in tokenize(w)]) for w in {w for x in found for w in x}}
                for i, words in zip(others, found):
                    out[i] = b"".join([ids[w] for w in words])
            return out

        _LOADED[path, spaces] = PieceEncoder(many, whole, spaces, lower)
    return _LOADED[path, spaces]
