"""Simple-8b: several unsigned integers in one 64-bit word, whose top 4 bits say how many and how wide.

A value of more than 60 bits is an escape: a word with selector 15 and nothing else, followed by the
value as a raw word. Besides the words an encoded run holds, for every ``STRIDE`` words, the number of
values before them, so a reader can start inside a run.
"""

from __future__ import annotations

import numpy as np

#: (values in a word, bits of each) by selector; 0 and 1 are runs of zeros, 15 is the escape.
SELECTORS = [(240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (1, 60)]
ESCAPE = 15
STRIDE = 128
_COUNTS = np.array([n for n, _ in SELECTORS] + [1])
_LIMIT = np.uint64(1) << np.uint64(60)


def _exact_widths(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values), np.uint8)
    for narrower, width in zip((0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20), (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 60)):
        out[values >= np.uint64(1) << np.uint64(narrower)] = width
    out[values >= _LIMIT] = 64
    return out


_SMALL_WIDTHS = _exact_widths(np.arange(1 << 16, dtype=np.uint64))


def _widths(values: np.ndarray) -> np.ndarray:
    """The narrowest selector's bits that hold each value, 64 for an escape."""
    small = values < len(_SMALL_WIDTHS)
    if small.all():
        return _SMALL_WIDTHS[values]
    out = _SMALL_WIDTHS[np.where(small, values, 0)]
    out[~small] = _exact_widths(values[~small])
    return out


def _selectors(widths: np.ndarray) -> np.ndarray:
    """The selector of most values that a word starting at each position can have."""
    n = len(widths)
    chosen = np.full(n, ESCAPE, np.uint8)
    chosen[widths <= 60] = 14
    done, span = widths, 1  # done[i]: the widest of the `span` values from i
    for selector in range(13, -1, -1):
        count, bits = SELECTORS[selector]
        if count > n:
            break
        while span < count:
            step = min(span, count - span)
            done = np.maximum(done[:len(done) - step], done[step:])
            span += step
        chosen[:len(done)][done <= bits] = selector
    return chosen


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """(words, values before every STRIDE-th word) of unsigned integers."""
    values = np.ascontiguousarray(values, np.uint64)
    selector = _selectors(_widths(values))
    jump, at, starts = _COUNTS[selector].tolist(), 0, []
    while at < len(jump):
        starts.append(at)
        at += jump[at]
    starts = np.array(starts, np.int64)
    used = selector[starts] if len(starts) else np.zeros(0, np.uint8)
    escaped = used == ESCAPE
    place = np.arange(len(starts)) + np.cumsum(escaped) - escaped
    words = np.zeros(len(starts) + int(escaped.sum()), np.uint64)
    words[place] = used.astype(np.uint64) << np.uint64(60)
    words[place[escaped] + 1] = values[starts[escaped]]
    for s, (count, bits) in enumerate(SELECTORS):
        mine = np.flatnonzero(used == s)
        if bits and len(mine):
            first, packed = starts[mine], np.zeros(len(mine), np.uint64)
            for k in range(count):
                packed |= values[first + k] << np.uint64(bits * k)
            words[place[mine]] |= packed
    marks = np.searchsorted(place, np.arange(0, len(words), STRIDE))
    before = np.append(starts, len(values))[marks]
    return words.astype("<u8").tobytes(), before.astype("<u4").tobytes()


def decode(data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of the words in ``data``; the work is per selector, not per value."""
    words = np.frombuffer(data, "<u8")
    selector = (words >> np.uint64(60)).astype(np.uint8)
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(selector == ESCAPE):  # a raw word may look like an escape itself
        if not raw[i]:
            raw[i + 1] = True
    heads = np.flatnonzero(~raw)
    used = selector[heads]
    starts = np.cumsum(_COUNTS[used]) - _COUNTS[used]
    out = np.zeros(n, np.uint64)
    for s, (count, bits) in enumerate(SELECTORS):
        mine = np.flatnonzero(used == s)
        if bits and len(mine):
            first, packed, mask = starts[mine], words[heads[mine]], np.uint64((1 << bits) - 1)
            for k in range(count):
                out[first + k] = packed >> np.uint64(bits * k) & mask
    mine = np.flatnonzero(used == ESCAPE)
    out[starts[mine]] = words[heads[mine] + 1]
    return out
