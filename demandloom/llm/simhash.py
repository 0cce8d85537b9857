"""SimHash near copies by Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into segments of 23, 23 and 18 bits. The binary Golay code of length 23 is perfect: every
segment lies within three bits of exactly one codeword, whose index has 12 bits. The indices of the segment and of its
neighbours at one bit are at most six; two segments at distance two or less always share one of them, because both are
next to a segment halfway. Two linked fingerprints differ in four bits at most, so by the pigeonhole principle some two of
the three segments differ in two bits together, and a point halfway is one bit from both over those two segments. The
keys of a fingerprint are therefore, for each of the three pairs of segments, the index pairs of all that is one bit away
(at most eleven); linked fingerprints share a key, and those that share a key are verified by their distance.

Fingerprints are compared once each, however many documents hold them. A bucket sends a forest of its links, never all
pairs, and a search that takes found members out makes dense buckets cheap. Members of buckets above `bucket` fingerprints
go on to longer keys: first the indices of all three segments of everything within two bits (36 bits of key), and where
even those buckets are too large, all points within two bits themselves: two fingerprints that are both next to a point
are linked for certain, so a bucket of any size is tied to its smallest member by an aggregate. Nothing is dropped.

Defined cases: null texts and texts without words have fingerprint zero and link like others; texts of fewer than four
words have one shingle, the whole sequence; repeated shingles count each time; repeated rows share a component; a null
doc_id takes part and counts in no minimum (its component is null only if all its members are); texts of any length are
read whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import drop_staged, ranges, staged, text_slices, word_bounds
from demandloom.llm.components import components

#: Words of a shingle, seed of its hash, and bits in which linked fingerprints differ at most.
WIDTH, SEED, RADIUS = 4, 42, 4
#: Bits of the segments; the last one is a shortened code.
SEGMENTS = (23, 23, 18)
#: Fingerprints of one bucket that a task compares; members of larger buckets get longer keys.
BUCKET = 20_000
#: Buckets up to this size are compared side by side, larger ones by search.
SMALL = 32
#: Shingles whose bits are counted in one step.
COUNTED = 1 << 15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# -- fingerprints -----------------------------------------------------------------------------------------------------


def shingle_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of the rows, repeats included, and the shingles of each row."""
    lowered = _LOWER[data]
    starts, ends = word_bounds(lowered, bounds)
    rows = len(bounds) - 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(rows, np.int64)
    # all words with one blank after each: a shingle is one stretch of these bytes
    sizes = ends - starts
    begin = np.cumsum(sizes + 1) - sizes - 1
    joined = np.full(int((sizes + 1).sum()), 0x20, np.uint8)
    joined[ranges(begin, sizes)] = lowered[ranges(starts, sizes)]
    words = np.bincount(np.searchsorted(bounds, starts, side="right") - 1, minlength=rows)
    counts = np.where(words > 0, np.maximum(words - WIDTH + 1, 1), 0)
    first = ranges(np.cumsum(words) - words, counts)
    last = first + np.repeat(np.minimum(words, WIDTH), counts) - 1
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    stops = (begin + sizes)[last]
    found = [digest(view[a:b], SEED) for a, b in zip(begin[first].tolist(), stops.tolist(), strict=True)]
    return np.array(found, np.uint64), counts


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per row, the bits that are set in over half of its hashes."""
    total = np.zeros((len(counts), 64), np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    for first in range(0, len(hashes), COUNTED):
        part, own = hashes[first: first + COUNTED], row[first: first + COUNTED]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        edge = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        total[own[edge]] += np.add.reduceat(bits, edge, axis=0, dtype=np.int64)
    over = (2 * total > counts[:, None]).astype(np.uint8)
    return np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and print (the fingerprint's bits as a long) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in text_slices(batch.column(1)):
                prints = majority(*shingle_hashes(data, bounds))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(prints.view(np.int64))], names=["doc_id", "print"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(run, "doc_id long, print long")


# -- Golay code -------------------------------------------------------------------------------------------------------

#: Fixed value: generator polynomial of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
_CHECK_BITS, _LENGTH = 11, 23


def _remainders() -> np.ndarray:
    """Remainder of index * x^11 modulo the generator for all 12-bit indices."""
    out = np.arange(1 << (_LENGTH - _CHECK_BITS), dtype=np.int64) << _CHECK_BITS
    for bit in range(_LENGTH - 1, _CHECK_BITS - 1, -1):
        out ^= np.where(out >> bit & 1, GENERATOR << (bit - _CHECK_BITS), 0)
    return out


_REMAINDER = _remainders()


def syndrome(segment: np.ndarray) -> np.ndarray:
    return _REMAINDER[segment >> _CHECK_BITS] ^ (segment & ((1 << _CHECK_BITS) - 1))


def _errors() -> np.ndarray:
    """The one pattern of at most three bits that has each syndrome."""
    out = np.full(1 << _CHECK_BITS, -1, np.int64)
    single = 1 << np.arange(_LENGTH)
    patterns = [np.zeros(1, np.int64), single]
    for _ in range(2):
        patterns.append(np.unique((patterns[-1][:, None] ^ single).ravel()))
    for group in patterns:
        found = syndrome(group)
        fresh = out[found] < 0
        out[found[fresh]] = group[fresh]
    return out


_ERROR = _errors()


def decoded(segment: np.ndarray) -> np.ndarray:
    """Index of the codeword within three bits."""
    return (segment ^ _ERROR[syndrome(segment)]) >> _CHECK_BITS


def _neighbours(flips: int) -> list[np.ndarray]:
    """Per syndrome, what the index changes by when up to `flips` bits of the segment change; zero comes first.

    The code is linear, so this depends on the error pattern only.
    """
    single = 1 << np.arange(_LENGTH)
    near = np.r_[0, single]
    if flips == 2:
        near = np.unique((near[:, None] ^ near).ravel())
    changed = decoded(_ERROR[:, None] ^ near)
    return [np.unique(row) for row in changed]


class Keys:
    """Keys of fingerprints that linked ones share."""

    def __init__(self):
        self.near = [self._flat(_neighbours(flips)) for flips in (1, 2)]

    @staticmethod
    def _flat(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(x) for x in lists])
        return np.concatenate(lists), np.cumsum(sizes) - sizes, sizes

    @staticmethod
    def segments(prints: np.ndarray) -> list[np.ndarray]:
        out, at = [], 0
        for bits in SEGMENTS:
            out.append((prints >> np.uint64(at) & np.uint64((1 << bits) - 1)).astype(np.int64))
            at += bits
        return out

    def _changes(self, flips: int, syndromes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries of `row` repeated for every change of the index under so many flips, and the changes."""
        flat, begin, sizes = self.near[flips - 1]
        count = sizes[syndromes[row]]
        return np.repeat(np.arange(len(row)), count), flat[ranges(begin[syndromes[row]], count)]

    def pairs(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and key for each pair of segments: both indices, or one of them as it is one bit away."""
        parts = self.segments(prints)
        index, marks = [decoded(p) for p in parts], [syndrome(p) for p in parts]
        rows, keys = [], []
        for n, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
            every = np.arange(len(prints))
            for k, other in ((a, b), (b, a)):
                row, change = self._changes(1, marks[k], every)
                if k == b:
                    row, change = row[change > 0], change[change > 0]
                high, low = (index[k][row] ^ change, index[other][row]) if k == a else (index[other][row], index[k][row] ^ change)
                rows.append(row)
                keys.append(np.int64(n) << 24 | high << 12 | low)
        return np.concatenate(rows), np.concatenate(keys)

    def triples(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and key of all three indices of everything within two bits."""
        parts = self.segments(prints)
        index, marks = [decoded(p) for p in parts], [syndrome(p) for p in parts]
        whole = index[0] << 24 | index[1] << 12 | index[2]
        every = np.arange(len(prints))
        rows, keys = [], []
        for k, place in enumerate((24, 12, 0)):
            row, change = self._changes(2, marks[k], every)
            rows.append(row)
            keys.append(whole[row] ^ change << place)
        for a, b in ((0, 1), (0, 2), (1, 2)):
            row, one = self._changes(1, marks[a], every)
            again, two = self._changes(1, marks[b], row)
            rows.append(row[again])
            keys.append(whole[row[again]] ^ one[again] << (24 - 12 * a) ^ two << (24 - 12 * b))
        row, key = np.concatenate(rows), np.concatenate(keys)
        order = np.lexsort((key, row))
        row, key = row[order], key[order]
        fresh = np.r_[True, (row[1:] != row[:-1]) | (key[1:] != key[:-1])] if len(row) else np.zeros(0, bool)
        return row[fresh], key[fresh]


def centres(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and every point within two bits of its fingerprint."""
    single = np.r_[np.uint64(0), np.uint64(1) << np.arange(64, dtype=np.uint64)]
    near = np.unique((single[:, None] ^ single).ravel())
    return np.repeat(np.arange(len(prints)), len(near)), (prints[:, None] ^ near).ravel().view(np.int64)


# -- links ------------------------------------------------------------------------------------------------------------


def forest(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest entry that each of `count` entries reaches over the links between a and b."""
    root = np.arange(count)
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        open_ = low < high
        if not open_.any():
            return root
        np.minimum.at(root, high[open_], low[open_])
        while not np.array_equal(root, root[root]):
            root = root[root]


def side_by_side(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tied fingerprints of small buckets that follow each other: (member, root) within each."""
    ones, twos = [], []
    left, step = np.arange(len(keys)), 1
    while True:
        left = left[left + step < len(keys)]
        left = left[keys[left] == keys[left + step]]
        if not len(left):
            break
        near = left[np.bitwise_count(prints[left] ^ prints[left + step]) <= RADIUS]
        ones.append(near)
        twos.append(near + step)
        step += 1
    if not ones:
        return prints[:0], prints[:0]
    root = forest(len(keys), np.concatenate(ones), np.concatenate(twos))
    tied = np.flatnonzero(root != np.arange(len(keys)))
    return prints[tied], prints[root[tied]]


def searched(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) of one large bucket: a search that compares a found member only with those not found yet."""
    members, roots = [], []
    left = prints
    while len(left):
        root, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            one, front = front[0], front[1:]
            near = np.bitwise_count(left ^ one) <= RADIUS
            if near.any():
                found, left = left[near], left[~near]
                front = np.concatenate([front, found])
                members.append(found)
                roots.append(np.full(len(found), root))
    return (np.concatenate(members), np.concatenate(roots)) if members else (prints[:0], prints[:0])


def _sent(u: np.ndarray, v: np.ndarray, hot: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(u.view(np.int64)), pa.array(v.view(np.int64)), pa.array(np.full(len(u), hot))], names=["u", "v", "hot"]
    )


def _compared(batches: Iterator[pa.RecordBatch], bucket: int) -> Iterator[pa.RecordBatch]:
    """Links of the buckets, rows being sorted by key; members of buckets that are too large are marked hot instead."""
    held_keys, held = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    large = None  # key of a bucket known to be too large
    for batch in _and_end(batches):
        last = batch is None
        if not last:
            held_keys = np.concatenate([held_keys, batch.column(0).to_numpy()])
            held = np.concatenate([held, batch.column(1).to_numpy().view(np.uint64)])
        if not len(held):
            continue
        first = np.flatnonzero(np.r_[True, held_keys[1:] != held_keys[:-1]])
        end = np.r_[first[1:], len(held)]
        if not last and end[-1] - first[-1] <= bucket and held_keys[-1] != large:
            whole = first[-1]  # the last bucket may go on
            first, end = first[:-1], end[:-1]
        else:
            whole = len(held)
        size = end - first
        over = (size > bucket) | (held_keys[first] == large)
        for a, b in zip(first[over].tolist(), end[over].tolist(), strict=True):
            yield _sent(held[a:b], held[a:b], True)
        small = np.repeat(~over & (size <= SMALL), size)
        yield _sent(*side_by_side(held_keys[:whole][small], held[:whole][small]), False)
        for n in np.flatnonzero(~over & (size > SMALL)).tolist():
            yield _sent(*searched(held[first[n]: end[n]]), False)
        if len(over) and over[-1] and end[-1] == len(held):
            large = held_keys[-1]
        held_keys, held = held_keys[whole:], held[whole:]


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def keyed(prints: DataFrame, keys_of: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], rows: int) -> DataFrame:
    """key and print for every key; `rows` fingerprints are handled at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0).to_numpy().view(np.uint64)
            for first in range(0, len(column), rows):
                part = column[first: first + rows]
                row, key = keys_of(part)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row].view(np.int64))], names=["key", "print"])

    return prints.select("print").mapInArrow(run, "key long, print long")


def _by_keys(prints: DataFrame, keys_of: Callable, bucket: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Links that the keys give, and the fingerprints of buckets that are too large."""
    rows = keyed(prints, keys_of, 4096).repartition("key").sortWithinPartitions("key")
    found = staged(rows.mapInArrow(lambda it: _compared(it, bucket), "u long, v long, hot boolean"), name)
    return found.where("NOT hot").select("u", "v"), found.where("hot").select(F.col("u").alias("print")).distinct()


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """u and v: links that tie all fingerprints (column print, each once) within RADIUS bits of each other together."""
    keys = Keys()
    out, crowded = _by_keys(prints, keys.pairs, bucket, "print-links")
    if crowded.isEmpty():
        return out
    more, crowded = _by_keys(crowded, keys.triples, bucket, "print-links")
    out = out.unionByName(more)
    if crowded.isEmpty():
        return out
    around = staged(keyed(crowded, centres, 64), "print-centres")
    least = around.groupBy("key").agg(F.min("print").alias("v"), F.count("*").alias("n")).where("n > 1")
    return out.unionByName(around.join(least, "key").where("print <> v").select(F.col("print").alias("u"), "v").distinct())


def join(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id (smallest doc_id reachable) of every document."""
    rows = staged(fingerprints(docs), "prints")
    classes = staged(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "print-classes")
    tied = components(links(classes, bucket))
    # one row per component, then the smallest doc_id for each of its fingerprints
    rooted = staged(tied.select(F.col("node").alias("print"), "root").join(classes, "print"), "print-roots")
    lows = rooted.groupBy("root").agg(F.min("least").alias("low"))
    ids = rooted.select("print", "root").join(lows, "root").select("print", "low")
    every = classes.join(ids, "print", "left").select("print", F.coalesce("low", "least").alias("component_id"))
    return rows.join(every, "print").select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
