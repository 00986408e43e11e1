"""Bin completion over a histogram of lengths: how many bins of which fillings.

A plan is a list of (filling, bins): a filling is the multiset of lengths in one bin. Everything
works on counts per length, of which there are at most ``capacity``, so the effort depends on the
capacity alone and not on the number of documents.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter

#: Fillings tried around the largest length at one node, and nodes visited in all. Both bound the
#: search for a better plan than the incumbent; every length is always packed.
WIDTH = 6
NODES = 20_000

Filling = tuple[int, ...]
Plan = list[tuple[Filling, int]]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins needed at least: by volume, and by lengths of which no two fit together (Martello-Toth L2)."""
    lengths = sorted(counts, reverse=True)
    best = -(-sum(n * c for n, c in counts.items()) // capacity)
    for k in [0, *(n for n in lengths if 2 * n <= capacity)]:
        alone = sum(counts[n] for n in lengths if n > capacity - k)
        halves = [n for n in lengths if capacity - k >= n > capacity / 2]
        rest = sum(n * counts[n] for n in lengths if capacity / 2 >= n >= k)
        room = sum((capacity - n) * counts[n] for n in halves)
        best = max(best, alone + sum(counts[n] for n in halves) + max(0, -(-(rest - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing, many equal bins at a time: the first incumbent."""
    bins: dict[int, Counter] = {}  # room left -> fillings
    rooms: list[int] = []

    def put(filling: Filling, n: int, room: int) -> None:
        if room not in bins:
            bins[room] = Counter()
            insort(rooms, room)
        bins[room][filling] += n

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                if left // each:
                    put((length,) * each, left // each, capacity - each * length)
                if left % each:
                    put((length,) * (left % each), 1, capacity - left % each * length)
                break
            room = rooms[at]
            filling, n = next(iter(bins[room].items()))
            each = min(room // length, left)
            used = min(n, left // each)
            bins[room][filling] -= used
            if not bins[room][filling]:
                del bins[room][filling]
            if not bins[room]:
                del bins[room]
                rooms.pop(at)
            put(filling + (length,) * each, used, room - each * length)
            left -= used * each
    return [(f, n) for fillings in bins.values() for f, n in fillings.items()]


def completions(lengths: list[int], counts: dict[int, int], room: int, width: int = WIDTH) -> list[Filling]:
    """Undominated ways to fill ``room``, fullest first, of up to three parts and then best fit.

    One part that fills as much as several dominates them (the several fit wherever it does), so of
    equal sums only the one of fewest and largest parts is kept, and a filling to which a further
    length fits is dominated by the one that has it.
    """
    if not lengths or room < lengths[0]:
        return [()]
    found: dict[int, Filling] = {}

    def fits(limit: int, taken: Filling) -> int | None:
        at = bisect_right(lengths, limit) - 1
        while at >= 0 and counts[lengths[at]] <= taken.count(lengths[at]):
            at -= 1
        return lengths[at] if at >= 0 else None

    def close(taken: Filling) -> None:
        """Add the largest lengths that fit until none does."""
        while (n := fits(room - sum(taken), taken)) is not None:
            taken += (n,)
        found.setdefault(sum(taken), taken)

    top = bisect_right(lengths, room)
    for first in lengths[max(0, top - 64):top][::-1]:
        close((first,))
        if room in found:
            break
    if room not in found:  # pairs that fill the room exactly, then triples around the largest lengths
        for first in lengths[:top][::-1]:
            second = room - first
            if second <= first and counts.get(second, 0) > (second == first):
                found[room] = (first, second)
                break
    if room not in found:
        for first in lengths[max(0, top - 24):top][::-1]:
            for second in lengths[:bisect_right(lengths, room - first)][::-1][:64]:
                third = room - first - second
                if third <= second and counts.get(third, 0) > (third == first) + (third == second):
                    found[room] = (first, second, third)
                    break
            if room in found:
                break
    return [found[s] for s in sorted(found, reverse=True)[:width]]


def pack(counts: dict[int, int], capacity: int, nodes: int = NODES, width: int = WIDTH) -> Plan:
    """The best plan found; ends at once when a plan meets the lower bound.

    Branch and bound: take the largest length left, fill its bin in each undominated way (as many
    equal bins at a time as the counts allow), and go on. The waste of the bins closed so far must
    stay below what would make the plan as large as the incumbent's.
    """
    counts = {int(n): int(c) for n, c in counts.items() if c}
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError(f"lengths must be 1 to {capacity}")
    if not counts:
        return []
    bound, total = lower_bound(counts, capacity), sum(n * c for n, c in counts.items())
    best = best_fit(counts, capacity)
    if sum(n for _, n in best) == bound:
        return best
    size = sum(n for _, n in best)
    visited = 0
    # Depth first on an explicit stack: (counts left, bins of the plan so far as a linked list, bins, waste).
    stack = [(counts, None, 0, 0)]
    while stack and visited < nodes and size > bound:
        left, closed, bins, waste = stack.pop()
        visited += 1
        if waste > (size - 1) * capacity - total:
            continue
        if not left:
            plan = []
            while closed:
                (filling, n), closed = closed
                plan.append((filling, n))
            best, size = plan, bins
            continue
        lengths = sorted(left)
        largest = lengths[-1]
        less = dict(left)
        less[largest] -= 1
        if not less[largest]:
            del less[largest]
        rest = sorted(less)
        for filling in reversed(completions(rest, less, capacity - largest, width)):
            uses = Counter((largest, *filling))
            times = min(left[n] // k for n, k in uses.items())
            after = dict(left)
            for n, k in uses.items():
                after[n] -= k * times
                if not after[n]:
                    del after[n]
            lost = (capacity - sum((largest, *filling))) * times
            stack.append((after, (((largest, *filling), times), closed), bins + times, waste + lost))
    return best
