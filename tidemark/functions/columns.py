"""Small column builders shared by the feature code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def flag(condition: Column) -> Column:
    """1 when the condition holds; 0 when it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def whole_number(c: Column, lenient: bool = False) -> Column:
    """Text to INT. Only integer literals count unless ``lenient``, which rounds decimals."""
    if lenient:
        return F.round(c.try_cast("double")).try_cast("int")
    return c.try_cast("int")


def number(c: Column) -> Column:
    return c.try_cast("double")


def within(value: Column, bounds: tuple, otherwise=None) -> Column:
    """``value`` when inside the closed range, else ``otherwise`` (NULL by default)."""
    return F.when(value.between(*bounds), value).otherwise(F.lit(otherwise))


def zero_or_one(c: Column) -> Column:
    value = whole_number(c)
    return F.when(value.isin(0, 1), value).otherwise(0)


def compact_date(c: Column) -> Column:
    """``yyyyMMdd`` text to DATE; anything malformed becomes NULL.

    Cast from ISO text: several times faster than a pattern parser, which is built per row.
    """
    iso = F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))
    return F.when(F.length(F.trim(c)) == 8, F.when(F.length(c) == 8, iso.try_cast("date")))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def right_closed_bins(value: Column, bins: list[tuple], lowest: float = -1) -> Column:
    """Label of the right-closed bin holding ``value``: (lowest, edge1], (edge1, edge2], ...

    ``bins`` lists (upper edge, label); an upper edge of None has no limit. Outside: NULL.
    """
    ladder = F.when(value.isNull() | (value <= lowest), F.lit(None).cast("string"))
    for edge, label in bins:
        ladder = ladder.when(F.lit(True) if edge is None else value <= edge, F.lit(label))
    return ladder


def md5_number(c: Column, hex_digits: int = 8) -> Column:
    """Leading hex digits of md5 as BIGINT: a hash any SQL engine can reproduce."""
    return F.conv(F.substring(F.md5(c.cast("string")), 1, hex_digits), 16, 10).cast("bigint")


def in_hash_sample(key: Column, fraction: float, method: str = "xxhash64") -> Column:
    """Repeatable membership test: the same key is in or out on every table it appears in."""
    if not 0 < float(fraction) <= 1:
        raise ValueError("fraction must be in (0, 1]")
    hashed = {"xxhash64": F.xxhash64, "md5": md5_number}[method](key)
    return F.pmod(hashed, F.lit(1_000_000)) < int(float(fraction) * 1_000_000)
