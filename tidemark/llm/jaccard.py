"""Documents linked by the Jaccard similarity (0.75 or more) of their five-word shingles; exact.

A tree over count vectors alone does not spare work here: texts of like length have like counts in every few
groups, so its boxes overlap, and it would have to stand in one place. Its root is therefore dealt out. Under a common
order of shingles (those of many documents last) two similar sets share one of their first n - ceil(0.75 n) + 1,
so sets meet in blocks, one per such shingle, and a tree is built for each block.

1. One pass over the texts stores each distinct set of a task, its point and its key. Shingles that are
   frequent in a batch are counted on the way; their list is bounded by the mean set size times MOST_FREQUENT.
2. First shingles are exchanged as packed arrays by hash bucket and sorted there into blocks. Places of the first shingle
   that a pair shares bound what it can share at all, so a set whose place allows none of the others leaves the block.
3. Star links inside each block (each set to the smallest key) are verified: they join copies, so
   that a block of thousands of near copies becomes one component without all its pairs. Further turns take other sets as hubs.
4. Blocks that still hold several components go through the tree, which bounds the overlap of pairs of different
   components by summed coordinate minima; what it lets pass, each pair in one block, is verified on the sets.

So every pair that the bounds allow is either verified or connected already.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from ..session import fresh_path, materialise, text_batches
from .common import TRIMMED_SLICES, id_and_text, slices, trimmed
from .components import components
from .rtree import leaf_pairs, needs

WORDS = 5
#: Coordinates of a point in the tree. A stored point has a power of two more, so that a text has one or two shingles
#: in a group, however long it is; taken modulo fewer groups it folds to a point of those.
GROUPS = 128
#: A shingle that more than one in MOST_FREQUENT documents of a batch hold, and BATCH_LEAST at least, counts as frequent.
MOST_FREQUENT = 400
BATCH_LEAST = 16
#: Sets of a block that one task takes; more are split into parts, and every two parts meet.
BLOCK_SETS = 100_000
#: First shingles per bucket.
BUCKET_ENTRIES = 1_000_000
#: Lists of a set, the first by rank, that its rows carry: a pair is taken where no earlier list of both is known.
KNOWN_LISTS = 8
#: Turns of links from one set of a block to the others before the trees; they only spare the trees work.
HUB_TURNS = 2
#: Bits of the filter that says which sets are to be compared: 16 per set, and no more than these.
FILTER_BITS = 1 << 27
#: Sets that a task works on at a time, and words it remembers.
SLICE, KNOWN_WORDS = 1_000, 100_000
#: Bytes of texts whose sets are made at a time; one text may have more.
SET_BYTES = 1 << 20
#: Sets whose shingles are counted together, fewer where they have more distinct shingles than these.
COUNTED_SETS, COUNTED_SHINGLES = 4_000, 2_000_000
#: Keys that a task remembers; a set whose key was forgotten is stored once more.
CARRIED = 500_000
#: Shingles are kept as 48-bit hashes: within a pair of sets of 1,000 one in 10**9 is confused.
_BYTES = 6

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SETS = "kind int, doc_id bigint, n_shingles bigint, key bigint, point binary, shingles binary, shingle bigint, seen bigint"


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Distinct 64-bit hashes of the five-word windows of word hashes; fewer words are one window."""
    if not len(words):
        return words
    width = min(WORDS, len(words))
    h = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        h = (h ^ (h >> np.uint64(29))) * _MIX + words[k:k + len(h)]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return np.unique(h)


def _packed(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_BYTES].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // _BYTES, 8), np.uint8)
    wide[:, :_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, _BYTES)
    return wide.view("<u8").ravel()


def _stored_sets(docs: DataFrame) -> str:
    """Writes a row per document (kind 0; ``shingles`` once per distinct set and task) and per frequent shingle of a batch (kind 1)."""
    def read(batches):
        known: dict[bytes, int] = {}
        carried: set[int] = set()
        counter = _Counter()
        for b in (part for whole in batches for part in slices(whole, size=SET_BYTES)):
            n, keys, points, packed, fresh = [], [], [], [], []
            if len(carried) > CARRIED:
                carried.clear()
            for text in b["text"].to_pylist():
                words = text.encode().lower().split()
                if len(known) > KNOWN_WORDS:
                    known.clear()
                for w in set(words).difference(known):
                    known[w] = xxhash.xxh3_64_intdigest(w)
                exact = shingle_hashes(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
                n.append(len(exact))
                if not len(exact):
                    keys.append(None)
                    points.append(None)
                    packed.append(None)
                    continue
                key = xxhash.xxh3_64_intdigest(exact.tobytes()) - (1 << 63)
                keys.append(key)
                if key in carried:
                    points.append(None)
                    packed.append(None)
                    continue
                carried.add(key)
                kept = np.unique(exact >> np.uint64(16))
                points.append(_point(kept))
                packed.append(_packed(kept))
                fresh.append(kept)
            yield _batch(0, doc_id=b["doc_id"], n_shingles=n, key=keys, point=points, shingles=packed)
            counter.add(fresh)
            if counter.full:
                yield from counter.frequent()
        yield from counter.frequent()

    path = fresh_path(docs.sparkSession, "shingles")
    with text_batches(docs.sparkSession):
        docs.mapInArrow(lambda batches: trimmed(read(batches), 4 * TRIMMED_SLICES), _SETS).write.partitionBy("kind").parquet(path)
    return path


class _Counter:
    """Sets that hold each shingle, of up to COUNTED_SETS sets: a sorted run that each slice is merged into."""

    def __init__(self):
        self._shingle, self._seen, self._sets = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0

    @property
    def full(self) -> bool:
        return self._sets >= COUNTED_SETS or len(self._shingle) > COUNTED_SHINGLES

    def add(self, fresh: list[np.ndarray]) -> None:
        if not fresh:
            return
        self._sets += len(fresh)
        shingle, seen = np.unique(np.concatenate(fresh), return_counts=True)
        at = np.searchsorted(self._shingle, shingle)
        old = self._shingle[np.minimum(at, len(self._shingle) - 1)] == shingle if len(self._shingle) else np.zeros(len(shingle), bool)
        self._seen[at[old]] += seen[old]
        self._shingle, self._seen = np.insert(self._shingle, at[~old], shingle[~old]), np.insert(self._seen, at[~old], seen[~old])

    def frequent(self):
        """One batch of the frequent shingles, if there are any; counting begins afresh."""
        often = self._seen >= max(BATCH_LEAST, self._sets / MOST_FREQUENT)
        if often.any():
            yield _batch(1, shingle=self._shingle[often].astype(np.int64), seen=self._seen[often])
        self.__init__()


def _batch(kind: int, **columns) -> pa.RecordBatch:
    types = {"doc_id": pa.int64(), "n_shingles": pa.int64(), "key": pa.int64(), "point": pa.binary(), "shingles": pa.binary(),
             "shingle": pa.int64(), "seen": pa.int64()}
    size = len(next(iter(columns.values())))
    arrays = [pa.array([kind] * size, pa.int32())]
    arrays += [pa.array(columns[c], t) if c in columns else pa.nulls(size, t) for c, t in types.items()]
    return pa.RecordBatch.from_arrays(arrays, ["kind", *types])


def _planes(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, first bytes first, so that the zeros of small ones stand together and compress."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _point(shingles: np.ndarray) -> bytes:
    groups = GROUPS
    while True:
        counts = np.bincount((shingles % np.uint64(groups)).astype(np.int64), minlength=groups)
        if 2 * groups > len(shingles) and counts.max() < 256:
            bits = np.zeros(groups + len(shingles), bool)
            bits[np.cumsum(counts) + np.arange(groups)] = True  # each count as so many zeros before a one, as most are 0 to 3
            return np.packbits(bits).tobytes()
        groups *= 2


def _as_point(data: bytes) -> np.ndarray:
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8)))
    return (np.diff(ones, prepend=-1) - 1).astype(np.uint8)


def _folded(point: np.ndarray, groups: int) -> np.ndarray:
    return point if groups == len(point) else point.reshape(-1, groups).sum(axis=0, dtype=np.uint16)


def _may_link(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two points, in the groups both have, allow the overlap that their sizes need."""
    groups = min(len(a), len(b))
    a, b = _folded(a, groups), _folded(b, groups)
    return bool(7 * np.minimum(a, b).sum(dtype=np.int64) >= needs(a.sum(dtype=np.int64), b.sum(dtype=np.int64)))


def _entries(sets: DataFrame, frequent: Broadcast, buckets: int, block_sets: int) -> DataFrame:
    """First shingles of each set as packed rows (bucket, keys, counts, lengths, shingles, places): the ``counts[i]`` shingles of ``keys[i]``, a
    set of ``lengths[i]``, in a row, with their places in the common order of the set.

    A shingle of more than ``block_sets`` sets by the count of frequent ones is a block for every two parts of its sets.
    """
    def first(batches):
        often, seen = frequent.value
        for b in (whole.slice(at, SLICE) for whole in batches for at in range(0, whole.num_rows, SLICE)):
            keys, chosen, length, place = [], [], [], []
            for key, data in zip(b["key"].to_pylist(), b["shingles"].to_pylist()):
                values = _unpacked(data)
                at = np.searchsorted(often, values)
                is_often = (often[np.minimum(at, len(often) - 1)] == values) if len(often) else np.zeros(len(values), bool)
                n = len(values)
                values = np.concatenate([values[~is_often], values[is_often]])[:n - (3 * n + 3) // 4 + 1]
                block, at_place = values, np.arange(len(values))
                if len(often):
                    at = np.minimum(np.searchsorted(often, values), len(often) - 1)
                    split = np.where(often[at] == values, -(-seen[at] // block_sets), 1)
                    if (split > 1).any():
                        block = np.concatenate([values[split == 1], *(
                            _part_blocks(v, int(s), key) for v, s in zip(values[split > 1], split[split > 1]))])
                        at_place = np.concatenate([at_place[split == 1], np.repeat(at_place[split > 1], split[split > 1])])
                keys.append(np.full(len(block), key, np.int64))
                chosen.append(block)
                length.append(np.full(len(block), n))
                place.append(at_place)
            if not keys:
                continue
            key, shingle, n, at = map(np.concatenate, (keys, chosen, length, place))
            bucket = (shingle % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            key, shingle, n, at, bucket = key[order], shingle[order], n[order], at[order], bucket[order]
            ends = np.flatnonzero(np.append(bucket[1:] != bucket[:-1], True)) + 1
            rows, start = [], 0
            for end in ends:
                k = key[start:end]
                heads = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
                rows.append((int(bucket[start]), k[heads].tobytes(), _planes(np.diff(np.append(heads, len(k)))), _planes(n[start:end][heads]),
                             _packed(shingle[start:end]), _planes(at[start:end])))
                start = end
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], ["bucket", "keys", "counts", "lengths", "shingles", "places"])

    schema = "bucket int, keys binary, counts binary, lengths binary, shingles binary, places binary"
    return sets.select("key", "shingles").mapInArrow(lambda batches: trimmed(first(batches)), schema)


def _part_blocks(shingle: int, parts: int, key: int) -> np.ndarray:
    """A block name for the part of ``key`` with each part, itself included."""
    own = xxhash.xxh3_64_intdigest(str(key)) % parts
    names = [xxhash.xxh3_64_intdigest(f"{shingle}:{min(own, p)}:{max(own, p)}") >> 16 for p in range(parts)]
    return np.array(names, np.uint64)


def _runs(shingle: np.ndarray, key: np.ndarray):
    """Positions of the entries sorted by shingle then key without repeats, and the bounds of the shingles that two or more sets hold."""
    order = np.lexsort([key, shingle])
    if len(key):
        s, k = shingle[order], key[order]
        order = order[np.append(True, (s[1:] != s[:-1]) | (k[1:] != k[:-1]))]
    shingle = shingle[order]
    heads = np.flatnonzero(np.append(True, shingle[1:] != shingle[:-1])) if len(order) else np.zeros(0, np.int64)
    ends = np.append(heads[1:], len(order))
    several = ends - heads > 1
    return order, heads[several], ends[several]


def _inside(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of the members of blocks, block after block."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


def _reach(length: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The largest length with which a set may be similar, if the first shingle they share is at ``place`` of its own.

    From there on they share length - place at most, and need 3/7 of both lengths. So x and y may link only if each is within the other's reach.
    """
    return (4 * length - 7 * place) // 3


def _partnered(sizes: np.ndarray, length: np.ndarray, reach: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Whether each member, block after block, has one of another ``part`` in its block with each in the other's reach."""
    if not len(length):
        return np.zeros(0, bool)
    # One line for all blocks: the numbers of a block are above all those of the blocks before it.
    offset = np.repeat(np.arange(len(sizes)), sizes) * (int(max(length.max(), reach.max())) + 1)
    low, high = length + offset, reach + offset
    order = np.argsort(low, kind="stable")
    far, of = high[order], part[order]
    # The farthest reach of all up to a length, and of those of other parts than the one that reaches farthest.
    first = np.maximum.accumulate(far)
    leads = np.append(True, far[1:] > first[:-1])
    leader = of[np.maximum.accumulate(np.where(leads, np.arange(len(far)), 0))]
    second = np.where(of != leader, far, -1)
    changed = np.append(False, leader[1:] != leader[:-1])
    second[changed] = first[:-1][changed[1:]]
    second = np.maximum.accumulate(second)
    last = np.searchsorted(low[order], high, "right") - 1
    farthest = np.where(leader[last] != part, first[last], second[last])
    return (last >= 0) & (farthest >= low)


def _kept_blocks(sizes: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Sizes of the blocks whose members are those to ``keep``; empty ones are left out."""
    left = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=keep, minlength=len(sizes)).astype(np.int64)
    return left[left > 0]


def _blocks(entries: DataFrame) -> DataFrame:
    """Per bucket one row of its blocks of several sets: ``sizes``, and ``keys``, ``lengths`` and ``places`` of their members; and its star links,
    ``a`` the smallest key of a block. Sets without a partner in reach are left out."""
    def build(group, table):
        def joined(column, read):
            return np.concatenate([read(x) for x in table[column].to_pylist()])

        keys, counts, lengths = joined("keys", lambda x: np.frombuffer(x, np.int64)), joined("counts", _from_planes), joined("lengths", _from_planes)
        at, heads, ends = _runs(joined("shingles", _unpacked), np.repeat(keys, counts))
        sizes = ends - heads
        at = at[_inside(heads, sizes)]
        key, length, place = np.repeat(keys, counts)[at], np.repeat(lengths, counts)[at], joined("places", _from_planes)[at]
        keep = _partnered(sizes, length, _reach(length, place), key)
        sizes, key, length, place = _kept_blocks(sizes, keep), key[keep], length[keep], place[keep]
        reach, hub = _reach(length, place), np.repeat(np.cumsum(sizes) - sizes, sizes)
        linked = (key != key[hub]) & (length <= reach[hub]) & (length[hub] <= reach)
        links = np.unique(np.stack([key[hub][linked], key[linked]], axis=1), axis=0)
        return pa.table({
            "bucket": pa.array([group[0].as_py()], pa.int32()), **{c: pa.array([x], pa.binary()) for c, x in (
                ("sizes", _planes(sizes)), ("keys", key.tobytes()), ("lengths", _planes(length)), ("places", _planes(place)))},
            "a": pa.array([links[:, 0]], pa.list_(pa.int64())), "b": pa.array([links[:, 1]], pa.list_(pa.int64())),
        })

    schema = "bucket int, sizes binary, keys binary, lengths binary, places binary, a array<bigint>, b array<bigint>"
    return entries.groupBy("bucket").applyInArrow(build, schema)


def _bounded(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """The pairs (a, b) whose points allow the overlap they need."""
    def bound(batches):
        for b in batches:
            good = [_may_link(_as_point(x), _as_point(y)) for x, y in zip(b["x"].to_pylist(), b["y"].to_pylist())]
            yield b.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = pairs.join(points.select(F.col("key").alias("a"), F.col("point").alias("x")), "a")
    return left.join(points.select(F.col("key").alias("b"), F.col("point").alias("y")), "b").mapInArrow(lambda batches: trimmed(bound(batches)), "a bigint, b bigint")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar. Only sets that the filter of wanted keys lets pass are exchanged."""
    spark = pairs.sparkSession
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key"))
    bits = 1 << 10
    while bits < min(FILTER_BITS, 32 * pairs.count()):
        bits *= 2
    place = F.pmod(F.xxhash64("key"), F.lit(bits))
    marked = wanted.select(place.alias("place")).selectExpr("shiftright(place, 5) AS word", "shiftleft(1L, CAST(place % 32 AS INT)) AS bit")
    # A bitmap of at most FILTER_BITS comes to the driver.
    rows = marked.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(bits // 32, np.int64)
    bitmap[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    shared = spark.sparkContext.broadcast(bitmap)

    def chosen(batches):
        for b in batches:
            at = b["place"].to_numpy()
            hit = shared.value[at >> 5] >> (at & 31) & 1 == 1
            yield b.select(["key", "shingles"]).filter(pa.array(hit))

    compared = sets.select("key", "shingles", place.alias("place")).mapInArrow(lambda batches: trimmed(chosen(batches)), "key bigint, shingles binary").dropDuplicates(["key"])

    def verify(batches):
        for b in batches:
            good = []
            for x, y in zip(b["x"].to_pylist(), b["y"].to_pylist()):
                both = np.concatenate([_unpacked(x), _unpacked(y)])
                both.sort(kind="stable")
                shared_n = int(np.count_nonzero(both[1:] == both[:-1]))
                good.append(100 * shared_n >= 75 * (len(both) - shared_n))
            yield b.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = pairs.join(compared.select(F.col("key").alias("a"), F.col("shingles").alias("x")), "a")
    both = left.join(compared.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b")
    return both.mapInArrow(lambda batches: trimmed(verify(batches)), "a bigint, b bigint")


def _by_bucket(blocks: DataFrame, parts: DataFrame, make, schema: str) -> DataFrame:
    """Cogroups each bucket's blocks with the components of its sets: rows of ``make`` (keys, parts, starts, sizes) of its open blocks.

    A block is open while sets of several components are in each other's reach; the others leave it. A set without a link is a component of its own.
    """
    def members(batches):
        for b in batches:
            for bucket, keys in zip(b["bucket"].to_pylist(), b["keys"].to_pylist()):
                key = np.unique(np.frombuffer(keys, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), bucket, np.int32)), pa.array(key)], ["bucket", "key"])

    named = blocks.select("bucket", "keys").mapInArrow(lambda batches: trimmed(members(batches)), "bucket int, key bigint").join(
        parts.select(F.col("node").alias("key"), F.col("component").alias("part")), "key").select("bucket", "key", "part")

    def open_blocks(_, stored, labels):
        empty = np.zeros(0, np.int64)
        if not stored.num_rows:
            return make(empty, empty, empty, empty)
        row = stored.to_pylist()[0]
        key, sizes, length = np.frombuffer(row["keys"], np.int64), _from_planes(row["sizes"]), _from_planes(row["lengths"])
        part = key.copy()
        if labels.num_rows:
            known, label = labels["key"].to_numpy(), labels["part"].to_numpy()
            order = np.argsort(known)
            known, label = known[order], label[order]
            at = np.minimum(np.searchsorted(known, key), len(known) - 1)
            part = np.where(known[at] == key, label[at], key)
        keep = _partnered(sizes, length, _reach(length, _from_planes(row["places"])), part)
        sizes = _kept_blocks(sizes, keep)
        return make(key[keep], part[keep], np.cumsum(sizes) - sizes, sizes)

    return blocks.select("bucket", "keys", "sizes", "lengths", "places").groupBy("bucket").cogroup(named.groupBy("bucket")).applyInArrow(open_blocks, schema)


def _hub_links(blocks: DataFrame, parts: DataFrame, turn: int) -> DataFrame:
    """Distinct links, in each open block, from one set to those of other components. All blocks rank sets alike, and each turn anew."""
    def stars(key, part, starts, sizes):
        if not len(key):
            return pa.table({"a": pa.array([], pa.list_(pa.int64())), "b": pa.array([], pa.list_(pa.int64()))})
        rank = (key.view(np.uint64) ^ np.uint64(turn * 0x5851F42D4C957F2D & (1 << 64) - 1)) * _MIX
        rank ^= rank >> np.uint64(31)
        hub = rank == np.repeat(np.minimum.reduceat(rank, starts), sizes)
        hubs, of = np.repeat(key[hub], sizes), np.repeat(part[hub], sizes)
        a, b = hubs[of != part], key[of != part]
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.table({"a": pa.array([pairs[:, 0]], pa.list_(pa.int64())), "b": pa.array([pairs[:, 1]], pa.list_(pa.int64()))})

    found = _by_bucket(blocks, parts, stars, "a array<bigint>, b array<bigint>")
    return found.select(F.explode(F.arrays_zip("a", "b")).alias("p")).select("p.a", "p.b").distinct()


def _open_lists(blocks: DataFrame, parts: DataFrame) -> DataFrame:
    """Distinct lists of the sets of open blocks: rows (list, key, part), a row per member."""
    def lists(key, part, starts, sizes):
        found = {}
        for s, e in zip(starts, starts + sizes):
            found[xxhash.xxh3_64_intdigest(key[s:e].tobytes()) - (1 << 63)] = (key[s:e], part[s:e])
        return pa.table({"list": pa.array(list(found), pa.int64()), "keys": pa.array([k for k, _ in found.values()], pa.list_(pa.int64())),
                         "parts": pa.array([p for _, p in found.values()], pa.list_(pa.int64()))})

    kept = _by_bucket(blocks, parts, lists, "list bigint, keys array<bigint>, parts array<bigint>")
    return kept.dropDuplicates(["list"]).select("list", F.explode(F.arrays_zip("keys", "parts")).alias("m")).select(
        "list", F.col("m.keys").alias("key"), F.col("m.parts").alias("part"))


def _tree_pairs(lists: DataFrame, points: DataFrame) -> DataFrame:
    """Distinct pairs of different components that the tree of some list lets pass. A list holds at most two parts of a block.

    Sets of one family share many lists; a pair is taken from the first list that holds both, as far as the KNOWN_LISTS first lists of
    both tell. So it may be given by several lists, but by one at least.
    """
    def join(batches):
        open_list, held = None, []

        def pairs():
            key = np.concatenate([t["key"].to_numpy() for t in held])
            part = np.concatenate([t["part"].to_numpy() for t in held])
            stored = [_as_point(x) for t in held for x in t["point"].to_pylist()]
            first = [frozenset(x) for t in held for x in t["first"].to_pylist()]
            point = np.stack([_folded(x, GROUPS) for x in stored])
            for i, j in leaf_pairs(point, point.sum(axis=1, dtype=np.int64), part):
                mine = np.fromiter((first[x].isdisjoint(first[y]) and _may_link(stored[x], stored[y]) for x, y in zip(i, j)), bool, len(i))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(key[i], key[j])[mine]), pa.array(np.maximum(key[i], key[j])[mine])], ["a", "b"])

        for b in batches:
            names = b["list"].to_numpy()
            bounds = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1), len(names)]
            for start, end in zip(bounds, bounds[1:]):
                if start == end:
                    continue
                if names[start] != open_list and held:
                    yield from pairs()
                    held = []
                open_list = names[start]
                held.append(b.slice(start, end - start))
        if held:
            yield from pairs()

    # A set stands in as many lists as it has first shingles, at most; a row needs the names before its own.
    of = lists.groupBy("key").agg(F.slice(F.sort_array(F.collect_set("list")), 1, KNOWN_LISTS).alias("first"))
    located = lists.join(of, "key").join(points, "key").select("list", "key", "part", "point", F.filter("first", lambda x: x < F.col("list")).alias("first"))
    return located.repartition("list").sortWithinPartitions("list").mapInArrow(lambda batches: trimmed(join(batches)), "a bigint, b bigint").distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_sets: int = BLOCK_SETS) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one per row of ``docs``.

    A-Z are lower-cased; words are split at ASCII white space. A set is that of the distinct five-word shingles,
    with fewer words the one sequence. Two rows link when 100 * intersection >= 75 * union; ``component_id`` is the
    smallest id reachable. Null, empty and white texts have no set and no link: their component is their own id.
    Null ids are reached but never the smallest; a component of null ids only has none. Repeated rows each give a row.
    Sets are told apart by 64-bit keys.
    """
    spark = docs.sparkSession
    path = _stored_sets(id_and_text(docs, id_col, text_col))
    stored = spark.read.schema(_SETS).option("basePath", path).parquet(path)
    sets, counted = stored.filter("kind = 0"), stored.filter("kind = 1")
    carriers = sets.filter("shingles IS NOT NULL")
    points = carriers.select("key", "point").dropDuplicates(["key"])

    total = sets.agg(F.count("shingles"), F.sum(F.when(F.col("shingles").isNotNull(), F.floor(F.col("n_shingles") / 4) + 1))).first()
    least = max(BATCH_LEAST, total[0] / MOST_FREQUENT)
    # At most MOST_FREQUENT times the mean set size come to the driver.
    often = counted.groupBy("shingle").agg(F.sum("seen").alias("seen")).filter(F.col("seen") >= least).orderBy("shingle").toArrow()
    frequent = spark.sparkContext.broadcast((often["shingle"].to_numpy().astype(np.uint64), often["seen"].to_numpy().astype(np.int64)))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (total[1] or 0) // BUCKET_ENTRIES + 1)

    blocks = materialise(_blocks(_entries(carriers, frequent, buckets, block_sets)), "blocks")
    stars = blocks.select(F.explode(F.arrays_zip("a", "b")).alias("p")).select("p.a", "p.b").distinct()
    links = materialise(_verified(materialise(_bounded(stars, points), "pairs"), carriers), "verified")
    parts = materialise(components(links), "parts")
    for turn in range(1, HUB_TURNS + 1):
        hubs = materialise(_bounded(_hub_links(blocks, parts, turn), points), "pairs")
        links = materialise(links.union(_verified(hubs, carriers)), "verified")
        parts = materialise(components(links), "parts")
    lists = materialise(_open_lists(blocks, parts), "lists")
    further = materialise(_tree_pairs(lists, points), "pairs")
    links = links.union(_verified(further, carriers))
    parts = components(links)

    classes = sets.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first"))
    joined = classes.join(parts.withColumnRenamed("node", "key"), "key", "left").withColumn("part", F.coalesce("component", "key"))
    named = joined.groupBy("part").agg(F.min("first").alias("component_id"))
    by_key = joined.select("key", "part").join(named, "part").select("key", "component_id")
    return sets.select("doc_id", "n_shingles", "key").join(by_key, "key", "left").select(
        "doc_id", "n_shingles", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
