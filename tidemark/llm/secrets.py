"""Secrets by pattern and by sliding-window entropy, in built-in functions only.

Positions: ``split`` gives what lies between the matches that ``regexp_extract_all`` gives, so starts are
running sums of lengths. Everything is row by row; no exchange, and no work beyond the patterns for a text without hits.

Entropy: a candidate is a maximal run of letters, digits and ``+/_=-`` of WINDOW characters or more. A fold over it
keeps the count of each character in the window, and the sum of c * log2(c) over the counts c, in whole millionths; a character that
enters or leaves changes one count and two terms. The window's entropy is log2(WINDOW) less the sum over WINDOW, so each
character class has a largest sum up to which a window passes. A candidate with a passing window is reported from
the first such window to the last, without what a pattern has found already, unless an allow-listed shape explains it. Base64 can have
the shape of a path, so a path is only allowed where each segment is made of words and numbers.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .common import id_and_text

#: Patterns by kind, in the order of kinds; of ``assign`` the second group must have SHORTEST_VALUE characters.
KINDS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",  # a run of these is matched whole, so 20+ characters of it is the same as 16+ after the prefix
    "hex": r"[0-9a-f]{24,}",
}
SHORTEST_VALUE = 6
ENTROPY = "entropy"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Least entropy in bits of a window by class: hex digits only; digits and letters of both cases; digits and letters of one case, four digits at least.
LEAST_BITS = {"hex": 3.0, "mixed": 3.8, "single": 3.8}
#: Shapes that are long and random but not secret: UUIDs, dates and versions, file paths, identifiers of joined words, published sample keys.
ALLOWED = [
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[0-9_=+/-]+$",
    r"^/?([A-Za-z0-9_-]{1,19}/)+[A-Za-z0-9_-]{0,19}$",
    r"^([A-Za-z]+|[0-9]+)([_-]([A-Za-z]+|[0-9]+))*$",
    r"^[A-Z]+[0-9]*EXAMPLE[A-Z0-9]*$",
]
#: Which of ALLOWED is the shape of a path, and what its segments must be: words in either case, also joined, numbers behind them; dates and sizes; or three characters at most.
PATH = ALLOWED[2]
_PART = r"(?:(?:[A-Z][a-z]{2,}+|[a-z]{2,}+|[A-Z]{2,}+)++[0-9]{0,4}|[0-9]{1,8}[a-z]{0,2}|[A-Za-z0-9]{1,3})(?![A-Za-z0-9])"
WORDED = rf"^[_-]*(?:{_PART}(?:[_-]++{_PART})*+)?+[_-]*$"
_SCALE = 1_000_000
_TERMS = [0] + [round(c * math.log2(c) * _SCALE) for c in range(1, WINDOW + 1)]
#: Largest sum of terms of a passing window, by class.
MOST = {name: round(WINDOW * (math.log2(WINDOW) - bits) * _SCALE) for name, bits in LEAST_BITS.items()}
_GROUP = 256
MASK = "[SECRET]"


def _running_sums(values: Column) -> Column:
    """Inclusive running sums of an array of BIGINT, in groups, so that the cost is linear in its size."""
    groups = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _GROUP).cast("int")), lambda g: F.slice(values, g * _GROUP + 1, _GROUP))

    def sums(array: Column) -> Column:
        return F.aggregate(array, F.array().cast("array<bigint>"), lambda done, x: F.concat(done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0)) + x)))

    inside = F.transform(groups, sums)
    before = F.concat(F.array(F.lit(0).cast("bigint")), sums(F.transform(inside, lambda g: F.element_at(g, -1))))
    return F.flatten(F.zip_with(inside, F.slice(before, 1, F.size(inside)), lambda g, b: F.transform(g, lambda x: x + b)))


def _span(start: Column, kind: Column, end: Column) -> Column:
    return F.struct(start.cast("bigint").alias("start"), kind.cast("int").alias("kind"), end.cast("bigint").alias("end"))


_SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


def _located(text: Column, pattern: str, matches: Column, kind: int, good: Callable[[Column], Column] | None = None) -> Column:
    """Spans of ``matches``, all matches of ``pattern`` in ``text``, that are ``good``."""
    lengths = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(matches)), matches, lambda gap, m: (F.length(gap) + F.length(m)).cast("bigint"))
    spans = F.zip_with(_running_sums(lengths), matches, lambda end, m: F.struct(_span(end - F.length(m), F.lit(kind), end).alias("span"), m.alias("m")))
    if good is not None:
        spans = F.filter(spans, lambda s: good(s["m"]))
    return F.when(F.size(matches) > 0, F.transform(spans, lambda s: s["span"])).otherwise(F.array().cast(_SPANS))


def _passing(candidate: Column) -> Column:
    """STRUCT<first, last>: ends of the first and last passing windows of a candidate, 0 if none passes."""
    codes = F.transform(F.slice(F.split(candidate, "", -1), 1, F.length(candidate)), lambda c: F.position(c, F.lit(ALPHABET)))
    steps = F.transform(codes, lambda c, i: F.struct(  # what enters and what leaves; 0 is nothing
        (i + 1).alias("at"), c.alias("new"), F.when(i >= WINDOW, F.get(codes, i - WINDOW)).otherwise(F.lit(0)).alias("old")))
    terms = F.array(*[F.lit(t).cast("bigint") for t in _TERMS])
    classes = {"upper": (1, 26), "lower": (27, 52), "digit": (53, 62), "hex_letter": (27, 32)}
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0).cast("bigint").alias("total"),
        *[F.lit(0).alias(name) for name in classes], F.lit(0).alias("first"), F.lit(0).alias("last"),
    )

    def step(acc: Column, x: Column) -> Column:
        leaving = F.coalesce(F.get(acc["counts"], x["old"] - 1), F.lit(0))
        entering = F.get(acc["counts"], x["new"] - 1) - (x["new"] == x["old"]).cast("int")
        total = (acc["total"] + F.get(terms, entering + 1) - F.get(terms, entering)
                 + F.when(leaving > 0, F.get(terms, leaving - 1) - F.get(terms, leaving)).otherwise(F.lit(0)))
        counts = F.transform(acc["counts"], lambda c, i: c + (i + 1 == x["new"]).cast("int") - (i + 1 == x["old"]).cast("int"))
        held = {n: acc[n] + x["new"].between(*r).cast("int") - x["old"].between(*r).cast("int") for n, r in classes.items()}
        upper, lower, digit, hex_letter = (held[n] for n in classes)
        passes = (x["at"] >= WINDOW) & (
            ((digit + hex_letter == WINDOW) & (digit > 0) & (hex_letter > 0) & (total <= MOST["hex"]))
            | ((upper > 0) & (lower > 0) & (digit > 0) & (total <= MOST["mixed"]))
            | (((upper == 0) | (lower == 0)) & (digit >= 4) & (upper + lower >= 4) & (total <= MOST["single"]))
        )
        return F.struct(
            counts.alias("counts"), total.alias("total"), *[v.alias(n) for n, v in held.items()],
            F.when(passes & (acc["first"] == 0), x["at"]).otherwise(acc["first"]).alias("first"),
            F.when(passes, x["at"]).otherwise(acc["last"]).alias("last"),
        )

    return F.aggregate(steps, start, step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def _allowed(candidate: Column) -> Column:
    others = "|".join(p for p in ALLOWED if p != PATH)
    return candidate.rlike(others) | (candidate.rlike(PATH) & F.forall(F.split(candidate, "/", -1), lambda part: part.rlike(WORDED)))


def _without(span: Column, base: Column, text: Column) -> Column:
    """The parts of an entropy span outside all spans of ``base``, which are in order; parts of marks alone are none."""
    kind = F.lit(len(KINDS))
    touching = F.filter(base, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))

    def step(acc: Column, b: Column) -> Column:
        gap = F.when(acc["at"] < b["start"], F.array(_span(acc["at"], kind, b["start"]))).otherwise(F.array().cast(_SPANS))
        return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), F.concat(acc["out"], gap).alias("out"))

    parts = F.aggregate(touching, F.struct(span["start"].alias("at"), F.array().cast(_SPANS).alias("out")), step, lambda acc: F.concat(
        acc["out"], F.when(acc["at"] < span["end"], F.array(_span(acc["at"], kind, span["end"]))).otherwise(F.array().cast(_SPANS))))
    return F.filter(parts, lambda s: text.substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")).rlike("[A-Za-z0-9]"))


def _random_spans(text: Column, candidates: Column, base: Column) -> Column:
    """Spans of passing windows of ``candidates`` that are not allow-listed, less the spans of ``base``."""
    kind = len(KINDS)
    lengths = F.zip_with(F.slice(F.split(text, CANDIDATE, -1), 1, F.size(candidates)), candidates, lambda gap, m: (F.length(gap) + F.length(m)).cast("bigint"))
    placed = F.zip_with(_running_sums(lengths), candidates, lambda end, m: F.struct((end - F.length(m)).alias("start"), m.alias("m")))
    likely = F.filter(placed, lambda c: c["m"].rlike("[0-9]") & c["m"].rlike("[A-Za-z]") & ~_allowed(c["m"]))
    found = F.transform(likely, lambda c: F.struct(c["start"].alias("start"), _passing(c["m"]).alias("w")))
    spans = F.transform(F.filter(found, lambda f: f["w"]["first"] > 0), lambda f: _span(
        f["start"] + f["w"]["first"] - WINDOW, F.lit(kind), f["start"] + f["w"]["last"]))
    spans = F.flatten(F.transform(spans, lambda s: _without(s, base, text)))
    return F.when(F.exists(candidates, lambda m: m.rlike("[0-9]")), spans).otherwise(F.array().cast(_SPANS))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, [*KINDS, ENTROPY]))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (doc_id, text, base, spans), one per row of ``docs``, with the columns ``keep`` besides.

    ``base`` has the spans of KINDS, leftmost and without overlap per kind, ``spans`` those and the entropy's; each is an
    ordered ARRAY<STRUCT<start, kind, end>> in code points, end exclusive, ``kind`` an index of KINDS, or their number for
    entropy. A null text counts as empty and has no spans. Repeated rows each give a row; null ids stay null.
    """
    source = id_and_text(docs, id_col, text_col) if not keep else docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    columns = [*(["kept"] if keep else []), "doc_id", "text"]
    text = F.col("text")
    matched = source.select(*columns, *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"_{k}") for k, p in KINDS.items()],
                            F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("_candidates"))
    good = {"assign": lambda m: F.length(F.regexp_extract(m, KINDS["assign"], 2)) >= SHORTEST_VALUE}
    located = [_located(text, p, F.col(f"_{k}"), i, good.get(k)) for i, (k, p) in enumerate(KINDS.items())]
    based = matched.select(*columns, "_candidates", F.array_sort(F.concat(*located)).alias("base"))
    return based.select(*columns, "base", F.array_sort(F.concat("base", _random_spans(text, F.col("_candidates"), F.col("base")))).alias("spans"))


def secret_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: counts of base spans per kind, the digest of the base spans, and all spans as text."""
    found = find_secrets(docs, id_col, text_col)

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
    )


def mask_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with each secret in the text replaced by MASK, overlapping spans by one; no row goes, other columns stay.

    ``length_col``, if there is such a column, follows the new text where that changed. A null text stays null.
    """
    found = find_secrets(docs, id_col, text_col, keep=tuple(docs.columns))
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["at"]
        gap = text.substr((acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(apart, F.concat(acc["out"], gap, F.lit(MASK))).otherwise(acc["out"]).alias("out"))

    masked = F.aggregate("spans", F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")), step,
                         lambda acc: F.concat(acc["out"], text.substr((acc["at"] + 1).cast("int"), F.length(text))))
    done = found.select("kept", (F.size("spans") > 0).alias("hit"), F.when(F.size("spans") > 0, masked).alias("masked"))

    def column(name: str) -> Column:
        old = F.col("kept").getField(name)
        if name == text_col:
            return F.when(F.col("hit"), F.col("masked")).otherwise(old).alias(name)
        if name == length_col:
            return F.when(F.col("hit"), F.length("masked").cast(docs.schema[name].dataType)).otherwise(old).alias(name)
        return old.alias(name)

    return done.select(*map(column, docs.columns))
