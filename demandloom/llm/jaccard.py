"""N-gram Jaccard join in the metric space of shingle sets.

Jaccard distance is a metric, so pivots can divide the join. Two documents without a common shingle are at distance 1, and
nearly all pairs are; pivots that are documents therefore tell almost nothing apart at first. The first pivots are single
shingles: the nearest such pivot of a set is the first of its shingles in a global order (rare ones first), and the sets
within the radius of a set can only be nearest to one of its first n - ceil(s * n) + 1 shingles. Each set is replicated to
those regions. Inside a region, pairs that are too far apart in size, or whose parity sketches differ in more bits than
their symmetric difference may have, are ruled out for certain; what is left ties sets into cells. Cells hold near copies
and what is almost one, and distances inside them tell: cells of more than BLOCK sets choose pivots among their own sets,
every set goes to its nearest pivot's region, and, by the triangle inequality, to those regions where
d(x, q) <= d(x, home) + 2 * radius; replicas are dealt in blocks, so no task receives a whole cell. Regions that are still
large inside a task are divided again the same way, and small ones are compared by exact intersection counts.

Sets are identified by 64-bit hashes of words, shingles and whole sets; equal sets are one class and are compared once.

Defined cases: null or empty texts and texts without words have no shingles, link with nothing and are components of their
own; texts of fewer words than a shingle have one shingle, the whole sequence; repeated rows share a component; a null
doc_id takes part and counts in no minimum (its component is null only if all its members are); texts of any length are
read whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import chain, emptied_by, entered, mix, ranges, span_hashes, staged, word_bounds
from demandloom.llm.components import components
from demandloom.llm.parts import (
    NULL_ID, cuts_of, hashes_of, located, pack, part_table, placed_slices, slices, stored_by_part, unpack, with_part,
)

#: Words of a shingle; least similarity as a fraction.
WIDTH, TOP, BOTTOM = 5, 4, 5
#: Documents sampled to order shingles by frequency (the order decides the work, never the result).
ORDER_SAMPLE = 20_000
#: Sets of a cell or of a block of replicas that are compared in one piece.
BLOCK = 96
#: Sets below which a region is compared without pivots.
LEAF = 48
#: Shingle hashes that a task gathers before it sends them.
SENT = 2_000_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingles(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every shingle of the rows, repeats included."""
    data = _LOWER[data]
    starts, ends = word_bounds(data, bounds)
    words = span_hashes(data, starts, ends)
    row = np.searchsorted(bounds, starts, side="right") - 1
    full = chain(words, WIDTH)
    at = np.flatnonzero(row[WIDTH - 1:] == row[: len(full)]) if len(full) else np.zeros(0, np.int64)
    out, own = full[at], row[at]
    counts = np.bincount(row, minlength=len(bounds) - 1)
    for width in range(1, WIDTH):  # whole sequences shorter than a shingle
        few = np.flatnonzero(counts == width)
        if len(few):
            first = np.searchsorted(row, few)
            code = np.full(len(few), width, np.uint64)
            for k in range(width):
                code = mix(code * np.uint64(0x9E3779B97F4A7C15) + words[first + k])
            out, own = np.concatenate([out, code]), np.concatenate([own, few])
    return out, own


def ordered_sets(data: np.ndarray, bounds: np.ndarray, often: np.ndarray, level: np.ndarray):
    """Distinct shingles of the rows, each row's in the global order, their rows, and set sizes.

    `often` holds the hashes seen several times in the sample, in ascending order, and `level` how often (a logarithm).
    """
    code, row = shingles(data, bounds)
    rank = np.zeros(len(code), np.int64)
    if len(often) and len(code):
        at = np.minimum(np.searchsorted(often, code), len(often) - 1)
        known = often[at] == code
        rank[known] = level[at[known]]
    order = np.lexsort((code, row * 64 + rank))
    code, row = code[order], row[order]
    keep = np.ones(len(code), dtype=bool)
    keep[1:] = (code[1:] != code[:-1]) | (row[1:] != row[:-1])
    code, row = code[keep], row[keep]
    return code, row, np.bincount(row, minlength=len(bounds) - 1)


def prefix_length(sizes: np.ndarray) -> np.ndarray:
    """Regions that a set of this size must be in: two sets within the radius share one of their first shingles."""
    return np.where(sizes > 0, sizes - -(-TOP * sizes // BOTTOM) + 1, 0)


def classes(code: np.ndarray, row: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One number for each row's set."""
    total = np.zeros(len(sizes), np.uint64)
    second = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        first = np.cumsum(sizes) - sizes
        total[full] = np.add.reduceat(mix(code), first[full])
        second[full] = np.bitwise_xor.reduceat(mix(code + np.uint64(0x632BE59BD9B4E019)), first[full])
    return mix(total * np.uint64(0x9E3779B97F4A7C15) + mix(second + sizes.astype(np.uint64)))


def sketch_bytes(sizes: np.ndarray) -> np.ndarray:
    """Bytes of a parity sketch: bits at least the set's size, 256 or more, a power of two."""
    return 2 ** np.ceil(np.log2(np.maximum(sizes, 256) / 8)).astype(np.int64)


def sketches(code: np.ndarray, row: np.ndarray, sizes: np.ndarray, wanted: np.ndarray) -> list[bytes]:
    """Parity of the number of shingles that fall on each bit, for the rows wanted."""
    first = np.cumsum(sizes) - sizes
    out = []
    for n in wanted.tolist():
        width = int(sketch_bytes(sizes[n: n + 1])[0])
        bit = (code[first[n]: first[n] + sizes[n]] >> np.uint64(20)) & np.uint64(8 * width - 1)
        odd = np.bincount(bit.astype(np.int64), minlength=8 * width).astype(np.uint8) & 1
        out.append(np.packbits(odd, bitorder="little").tobytes())
    return out


# -- the global order -------------------------------------------------------------------------------------------------


def frequent(rows: DataFrame, least: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of at least `least` documents of a bounded hash sample, ascending, with the level of their count."""
    share = min(1.0, ORDER_SAMPLE / max(1, rows.count()))
    some = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entered("jaccard")
        none = np.zeros(0, np.uint64)
        held, size = [], 0
        for _, _, data, bounds in slices(batches):
            held.append(ordered_sets(data, bounds, none, none)[0])
            size += len(held[-1])
            if size > SENT:
                yield from send(held)
                held, size = [], 0
        yield from send(held)

    def send(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if held:
            code, n = np.unique(np.concatenate(held), return_counts=True)
            cuts = cuts_of(code, tasks)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(tasks), pa.int32()),
                    pa.array([code[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                    pa.array([pack(n[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                ],
                names=["bucket", "codes", "n"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [row for batch in batches for row in batch.to_pylist()]
        if got:
            code = np.concatenate([hashes_of(r["codes"]) for r in got])
            n = np.concatenate([unpack(r["n"]) for r in got])
            order = np.argsort(code, kind="stable")
            first = np.flatnonzero(np.r_[True, code[order][1:] != code[order][:-1]][: len(code)])
            total = np.add.reduceat(n[order], first) if len(first) else n
            often = total >= least
            yield pa.RecordBatch.from_arrays(
                [pa.array([code[order][first][often].tobytes()], pa.binary()), pa.array([pack(total[often])], pa.binary())],
                names=["codes", "n"],
            )

    sent = some.mapInArrow(run, "bucket int, codes binary, n binary").repartition(tasks, "bucket")
    # the sample is bounded, so what is frequent in it is too
    got = sent.mapInArrow(count, "codes binary, n binary").collect()
    code = np.concatenate([hashes_of(bytes(r["codes"])) for r in got] or [np.zeros(0, np.uint64)])
    n = np.concatenate([unpack(bytes(r["n"])) for r in got] or [np.zeros(0, np.int64)])
    order = np.argsort(code)
    return code[order], np.minimum(63, np.ceil(4 * np.log2(n[order] + 1))).astype(np.int64)


# -- first regions: single shingles -----------------------------------------------------------------------------------


def sent_prefixes(order, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every class's first shingles, packed by bucket."""

    def send(part: int, held: list) -> pa.RecordBatch:
        code, kind = (np.concatenate(x) for x in zip(*held, strict=True))
        by = np.lexsort((kind, code))
        by = by[np.r_[True, (np.diff(code[by]) != 0) | (np.diff(kind[by]) != 0)]]
        code, kind = code[by], kind[by]
        cuts = cuts_of(code, buckets)
        pairs = [(k, slice(a, b)) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in pairs], pa.int32()),
                pa.array([part] * len(pairs), pa.int64()),
                pa.array([code[s].tobytes() for _, s in pairs], pa.binary()),
                pa.array([kind[s].tobytes() for _, s in pairs], pa.binary()),
            ],
            names=["bucket", "part", "codes", "kinds"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entered("jaccard")
        often, level = order.value
        at, held, size = None, [], 0
        for part, _, data, bounds in slices(batches):
            if held and (part != at or size > SENT):
                yield send(at, held)
                held, size = [], 0
            code, row, sizes = ordered_sets(data, bounds, often, level)
            first = np.cumsum(sizes) - sizes
            pick = ranges(first, prefix_length(sizes))
            if len(pick):
                held.append((code[pick], classes(code, row, sizes)[row[pick]]))
                at, size = part, size + len(pick)
        if held:
            yield send(at, held)

    return run


def shared_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every part its shingles that two classes or more have among their first ones."""
    got = [row for batch in batches for row in batch.to_pylist()]
    if not got:
        return
    code = np.concatenate([hashes_of(r["codes"]) for r in got])
    kind = np.concatenate([hashes_of(r["kinds"]) for r in got])
    sizes = np.array([len(r["codes"]) // 8 for r in got])
    order = np.argsort(code, kind="stable")
    head = np.r_[True, code[order][1:] != code[order][:-1]]
    first = np.flatnonzero(head)
    several = np.minimum.reduceat(kind[order], first) != np.maximum.reduceat(kind[order], first)
    keep = np.zeros(len(code), dtype=bool)
    keep[order] = several[np.cumsum(head) - 1]
    part = np.repeat(np.array([r["part"] for r in got]), sizes)[keep]
    code = code[keep]
    for own in np.unique(part).tolist():
        yield pa.RecordBatch.from_arrays(
            [pa.array([own], pa.int64()), pa.array([np.unique(code[part == own]).tobytes()], pa.binary())],
            names=["part", "codes"],
        )


@functools.lru_cache(maxsize=2)
def part_codes(path: str, part: int) -> np.ndarray:
    table = part_table(path, part, ["codes"])
    if table is None:
        return np.zeros(0, np.uint64)
    return np.sort(np.concatenate([hashes_of(x.as_py()) for x in table.column("codes")]))


emptied_by(part_codes.cache_clear)
MEMBERS = "bucket int, part long, rows binary, ids binary, sizes binary, kinds binary, codes binary, at binary, sketches array<binary>"


def sent_members(order, path: str, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of two sorts: ids, set sizes and classes of documents (bucket -1); members of shared regions by bucket.

    A class is sent once per bucket and task, with its sketch, and the regions it is in.
    """

    def send_members(part: int, code: np.ndarray, kind: np.ndarray, about: dict[int, tuple[int, bytes]]) -> Iterator[tuple]:
        by = np.lexsort((kind, code))
        by = by[np.r_[True, (np.diff(code[by]) != 0) | (np.diff(kind[by]) != 0)]]
        code, kind = code[by], kind[by]
        cuts = cuts_of(code, buckets)
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if a < b:
                own, at = np.unique(kind[a:b], return_inverse=True)
                sizes, sketch = zip(*(about[int(c)] for c in own), strict=True)
                yield k, part, b"", b"", pack(np.array(sizes)), own.tobytes(), code[a:b].tobytes(), pack(at), list(sketch)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 6 + [pa.list_(pa.binary())]
        names = ["bucket", "part", "rows", "ids", "sizes", "kinds", "codes", "at", "sketches"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entered("jaccard")
        often, level = order.value
        at, held, about, size = None, [], {}, 0
        for part, place, ids, data, bounds in placed_slices(batches):
            if held and (part != at or size > SENT):
                out = list(send_members(at, *(np.concatenate(x) for x in zip(*held, strict=True)), about))
                yield batch_of(out)
                held, about, size = [], {}, 0
            code, row, sizes = ordered_sets(data, bounds, often, level)
            kinds = classes(code, row, sizes)
            yield batch_of([(-1, part, pack(place), ids.astype("<i8").tobytes(), pack(sizes), kinds.tobytes(), b"", b"", [])])
            first = np.cumsum(sizes) - sizes
            pick = ranges(first, prefix_length(sizes))
            table = part_codes(path, part)
            found = np.searchsorted(table, code[pick])
            hit = found < len(table)
            hit[hit] = table[found[hit]] == code[pick][hit]
            pick = pick[hit]
            if len(pick):
                wanted = np.unique(row[pick])
                wanted = wanted[[int(kinds[n]) not in about for n in wanted]]
                for n, sketch in zip(wanted.tolist(), sketches(code, row, sizes, wanted), strict=True):
                    about[int(kinds[n])] = (int(sizes[n]), sketch)
                    size += len(sketch)
                held.append((code[pick], kinds[row[pick]]))
                at, size = part, size + len(pick)
        if held:
            yield batch_of(list(send_members(at, *(np.concatenate(x) for x in zip(*held, strict=True)), about)))

    return run


def folded(sketch: bytes, width: int) -> np.ndarray:
    """A sketch brought down to fewer bits; parities add up."""
    bits = np.frombuffer(sketch, np.uint8)
    while len(bits) > width:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2:]
    return bits


def possible(size: int, sizes: np.ndarray, sketch: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether sets can be within the radius of one: by size and by the bits in which parity sketches differ."""
    near = (BOTTOM * np.minimum(size, sizes) >= TOP * np.maximum(size, sizes))
    differ = np.bitwise_count(others ^ sketch).sum(axis=1, dtype=np.int64)
    return near & ((TOP + BOTTOM) * differ <= (BOTTOM - TOP) * (size + sizes))


def region_links(sizes: np.ndarray, sketch: list[bytes]) -> Iterator[tuple[int, int]]:
    """A spanning forest of the pairs of a region that cannot be ruled out."""
    order = np.argsort(sizes, kind="stable")
    # neighbours in size share a width to which their sketches are folded
    left = order.tolist()
    while left:
        queue = [left.pop(0)]
        while queue:
            n = queue.pop()
            if not left:
                return
            rest = np.array(left)
            close = rest[BOTTOM * np.minimum(sizes[n], sizes[rest]) >= TOP * np.maximum(sizes[n], sizes[rest])]
            if not len(close):
                continue
            width = min(len(sketch[n]), min(len(sketch[m]) for m in close.tolist()))
            others = np.stack([folded(sketch[m], width) for m in close.tolist()])
            found = close[possible(sizes[n], sizes[close], folded(sketch[n], width), others)]
            for m in found.tolist():
                yield n, m
            queue += found.tolist()
            gone = set(found.tolist())
            left = [m for m in left if m not in gone]


def candidate_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of classes that tie the possible pairs of every region together."""
    got = [row for batch in batches for row in batch.to_pylist()]
    if not got:
        return
    about: dict[int, tuple[int, bytes]] = {}
    codes, kinds = [], []
    for r in got:
        own = hashes_of(r["kinds"])
        about.update(zip(own.tolist(), zip(unpack(r["sizes"]).tolist(), r["sketches"], strict=True), strict=True))
        codes.append(hashes_of(r["codes"]))
        kinds.append(own[unpack(r["at"])])
    code, kind = np.concatenate(codes), np.concatenate(kinds)
    by = np.lexsort((kind, code))
    by = by[np.r_[True, (np.diff(code[by]) != 0) | (np.diff(kind[by]) != 0)]]
    code, kind = code[by], kind[by]
    edges = np.flatnonzero(np.r_[True, code[1:] != code[:-1], True])
    found: set[tuple[int, int]] = set()
    judged: set[bytes] = set()
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b - a < 2:
            continue
        same = kind[a:b].tobytes()
        if same in judged:  # regions with the same members
            continue
        judged.add(same)
        members = kind[a:b].tolist()
        sizes = np.array([about[c][0] for c in members])
        for n, m in region_links(sizes, [about[c][1] for c in members]):
            found.add((members[n], members[m]))
    pairs = np.array(sorted(found), dtype=np.uint64).reshape(-1, 2)
    yield pa.RecordBatch.from_arrays(
        [pa.array(pairs[:, 0].copy().view(np.int64)), pa.array(pairs[:, 1].copy().view(np.int64))], names=["u", "v"]
    )


# -- cells: exact join by pivots --------------------------------------------------------------------------------------


def cell_sets(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The sets of the classes that are in cells, one per class and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entered("jaccard")
        none, sent = np.zeros(0, np.uint64), set()
        for part, ids, data, bounds in slices(batches):
            table = part_table(path, part, ["doc_id", "kind", "cell"])
            if table is None:
                continue
            wanted = np.isin(ids, table.column("doc_id").fill_null(NULL_ID).to_numpy())
            if not wanted.any():
                continue
            cell = dict(zip(table.column("kind").to_pylist(), table.column("cell").to_pylist(), strict=True))
            rows = np.flatnonzero(wanted)
            lengths = (bounds[1:] - bounds[:-1])[rows]
            code, row, sizes = ordered_sets(data[ranges(bounds[:-1][rows], lengths)], np.concatenate([[0], np.cumsum(lengths)]), none, none)
            kinds = classes(code, row, sizes).view(np.int64)
            first = np.cumsum(sizes) - sizes
            out = []
            for n in range(len(rows)):
                kind = int(kinds[n])
                if kind in cell and kind not in sent:
                    sent.add(kind)
                    out.append((cell[kind], kind, code[first[n]: first[n] + sizes[n]].tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)],
                    names=["cell", "kind", "codes"],
                )

    return run


def intersections(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of every set with every other (or with each of `others`)."""
    both = sets if others is None else [*sets, *others]
    code = np.concatenate(both)
    row = np.repeat(np.arange(len(both)), [len(s) for s in both])
    order = np.argsort(code, kind="stable")
    code, row = code[order], row[order]
    head = np.r_[True, code[1:] != code[:-1]]
    column = np.cumsum(head) - 1
    used = np.bincount(column)[column] > 1
    row, column = row[used], np.cumsum(head & used)[used] - 1 if used.any() else column[used]
    total = np.zeros((len(sets), len(both) - (0 if others is None else len(sets))), np.float32)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(column, column[first] + 8192))
        block = np.zeros((len(both), int(column[end - 1] - column[first]) + 1), np.float32)
        block[row[first:end], column[first:end] - column[first]] = 1
        total += block[: len(sets)] @ (block if others is None else block[len(sets):]).T
        first = end
    return np.rint(total).astype(np.int64)


def distances(sets: list[np.ndarray], pivots: list[np.ndarray]) -> np.ndarray:
    inter = intersections(sets, pivots)
    union = np.array([len(s) for s in sets])[:, None] + np.array([len(p) for p in pivots]) - inter
    return 1 - inter / union


def regions(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot of each set, and which further regions it must be seen in.

    For a link between x at home in p and y at home in q, d(x, q) <= d(x, p) + 2 * radius; x goes to q for p < q only.
    """
    home = d.argmin(axis=1)
    window = d <= d[np.arange(len(d)), home][:, None] + 2 * (BOTTOM - TOP) / BOTTOM + 1e-9
    window &= np.arange(d.shape[1]) > home[:, None]
    return home, window


def linked_pairs(sets: list[np.ndarray], home: np.ndarray, depth: int = 0) -> Iterator[tuple[int, int]]:
    """All links with at least one end at home, found in regions of pivots that are divided until they are small."""
    own = np.flatnonzero(home)
    if not len(own):
        return
    if len(sets) > LEAF and depth < 3:
        pivots = [sets[n] for n in own[:: max(1, len(own) // 8)][:8]]
        d = distances(sets, pivots)
        near, window = regions(d)
        parts = [np.flatnonzero((near == q) | window[:, q]) for q in range(len(pivots))]
        if max(map(len, parts)) <= 0.8 * len(sets):
            for q, part in enumerate(parts):
                inner = [sets[n] for n in part]
                # pairs of two replicas belong to another region; pairs with a home member of this region are due here
                for a, b in _due(inner, home[part], near[part] == q, depth):
                    yield int(part[a]), int(part[b])
            return
    inter = intersections(sets)
    size = np.array([len(s) for s in sets])
    link = (BOTTOM * inter >= TOP * (size[:, None] + size - inter)) & (inter > 0) & (home[:, None] | home)
    a, b = np.nonzero(np.triu(link, 1))
    yield from zip(a.tolist(), b.tolist(), strict=True)


def _due(sets: list[np.ndarray], home: np.ndarray, here: np.ndarray, depth: int) -> Iterator[tuple[int, int]]:
    for a, b in linked_pairs(sets, here, depth + 1):
        if home[a] or home[b]:
            yield a, b


def forest(count: int, pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """A spanning forest of the pairs."""
    parent = list(range(count))

    def root(n: int) -> int:
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    out = []
    for a, b in pairs:
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def exact_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the pieces of cells in a partition (columns piece, kind, home, codes)."""
    pieces: dict[int, dict[int, tuple[bool, bytes]]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            pieces.setdefault(row["piece"], {})[row["kind"]] = (row["home"], row["codes"])
    found = set()
    for members in pieces.values():
        kinds = sorted(members)
        sets = [np.sort(hashes_of(members[k][1])) for k in kinds]
        home = np.array([members[k][0] for k in kinds])
        found.update((kinds[a], kinds[b]) for a, b in forest(len(kinds), linked_pairs(sets, home)))
    if found:
        u, v = zip(*sorted(found), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def to_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of large cells (with the cell's pivots) at home and as replicas: region, block of replicas, home."""
    for batch in batches:
        out = []
        rows = batch.to_pylist()
        by_cell: dict[int, list[dict]] = {}
        for row in rows:
            by_cell.setdefault(row["cell"], []).append(row)
        for cell, members in by_cell.items():
            pivots = [np.sort(hashes_of(p)) for p in sorted(members[0]["pivots"])]
            d = distances([np.sort(hashes_of(r["codes"])) for r in members], pivots)
            home, window = regions(d)
            for n, row in enumerate(members):
                out.append((cell, row["kind"], row["codes"], int(home[n]), True))
                out += [(cell, row["kind"], row["codes"], int(q), False) for q in np.flatnonzero(window[n])]
        columns = list(zip(*out, strict=True))
        types = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, types, strict=True)], names=["cell", "kind", "codes", "region", "home"]
        )


def pieces_of(sets: DataFrame) -> DataFrame:
    """Pieces to compare: small cells whole; of large ones every region's home sets with each block of its replicas."""
    sizes = sets.groupBy("cell").agg(F.count("*").alias("m"))
    sets = sets.join(sizes, "cell")
    small = sets.where(F.col("m") <= BLOCK).select(F.xxhash64("cell").alias("piece"), "kind", F.lit(True).alias("home"), "codes")
    large = sets.where(F.col("m") > BLOCK)
    # about one pivot for every half block, drawn by hash
    drawn = F.pmod(F.xxhash64("kind", F.lit(5)), F.lit(1 << 30)) < F.lit(1 << 30) * F.lit(2.0 / BLOCK)
    pivots = large.where(drawn).groupBy("cell").agg(F.collect_list("codes").alias("pivots"))
    large = large.join(pivots, "cell", "left").withColumn(
        "pivots", F.coalesce("pivots", F.array("codes"))  # a cell without a drawn pivot: each set is its own
    )
    dealt = large.select("cell", "kind", "codes", "pivots").mapInArrow(
        to_regions, "cell long, kind long, codes binary, region int, home boolean"
    )
    dealt = staged(dealt, "cell-regions")
    block = 64
    counts = dealt.groupBy("cell", "region", "home").agg(F.count("*").alias("n"))
    counts = counts.groupBy("cell", "region").agg(
        F.sum(F.when(F.col("home"), F.col("n"))).alias("homes"), F.sum(F.when(~F.col("home"), F.col("n"))).alias("guests")
    )
    counts = counts.select(
        "cell", "region", F.greatest(F.lit(1), F.ceil(F.coalesce("homes", F.lit(0)) / block)).cast("int").alias("a"),
        F.greatest(F.lit(1), F.ceil(F.coalesce("guests", F.lit(0)) / block)).cast("int").alias("b"),
    )
    dealt = dealt.join(counts, ["cell", "region"])
    # home blocks meet each other and every guest block; a piece is a pair of blocks
    own = F.pmod(F.xxhash64("kind", F.lit(9)), F.when(F.col("home"), F.col("a")).otherwise(F.col("b"))).cast("int")
    dealt = dealt.withColumn("own", own)
    among = dealt.where("home").select(
        "cell", "region", "kind", "codes", F.lit(True).alias("home"), F.lit("h").alias("sort"),
        F.explode(F.transform(F.sequence(F.lit(0), F.col("a") - 1), lambda k: F.array(F.least(k, "own"), F.greatest(k, "own")))).alias("pair"),
    )
    hosts = dealt.where("home").select(
        "cell", "region", "kind", "codes", F.lit(True).alias("home"), F.lit("g").alias("sort"),
        F.explode(F.transform(F.sequence(F.lit(0), F.col("b") - 1), lambda k: F.array(F.col("own"), k))).alias("pair"),
    )
    guests = dealt.where("NOT home").select(
        "cell", "region", "kind", "codes", F.lit(False).alias("home"), F.lit("g").alias("sort"),
        F.explode(F.transform(F.sequence(F.lit(0), F.col("a") - 1), lambda k: F.array(k, F.col("own")))).alias("pair"),
    )
    rest = among.unionByName(hosts).unionByName(guests)
    rest = rest.select(F.xxhash64("cell", "region", "sort", "pair").alias("piece"), "kind", "home", "codes")
    return small.unionByName(rest)


def _joined(rows: DataFrame) -> DataFrame:
    """part, row, doc_id, n_shingles, class, root class and component_id of every document (the last three null if empty)."""
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = spark.sparkContext.broadcast(frequent(rows))  # bounded by the sample
    prefixes = rows.mapInArrow(sent_prefixes(order, 8 * tasks), "bucket int, part long, codes binary, kinds binary")
    shared = prefixes.repartition(tasks, "bucket").mapInArrow(shared_codes, "part long, codes binary")
    shared = stored_by_part(shared, "join-shared")

    members = staged(rows.mapInArrow(sent_members(order, shared, 8 * tasks), MEMBERS), "join-members")
    own = members.where("bucket = -1").select("part", "rows", "ids", "sizes", "kinds").mapInArrow(
        unpacked, "part long, row long, doc_id long, n_shingles long, kind long"
    )
    regions_ = members.where("bucket >= 0").repartition(tasks, "bucket")
    cells = components(regions_.mapInArrow(candidate_links, "u long, v long"))
    cells = staged(cells.select(F.col("node").alias("kind"), F.col("root").alias("cell")), "join-cells")

    wanted = stored_by_part(own.join(cells, "kind").select("part", "doc_id", "kind", "cell"), "join-wanted")
    sets = rows.mapInArrow(cell_sets(wanted), "cell long, kind long, codes binary")
    sets = staged(sets.dropDuplicates(["cell", "kind"]), "join-sets")
    links = pieces_of(sets).repartition(tasks, "piece").mapInArrow(exact_links, "u long, v long")
    roots = components(links)

    least = own.where("n_shingles > 0").groupBy("kind").agg(F.min("doc_id").alias("least"))
    named = least.join(roots.withColumnRenamed("node", "kind"), "kind", "left").withColumn("root", F.coalesce("root", "kind"))
    named = staged(named, "join-classes")
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(lowest, "root").select("kind", "root", "component_id")
    return own.join(named, "kind", "left")


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    own_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return _joined(with_part(docs)).select("doc_id", "n_shingles", own_id.alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of every component, that with the smallest doc_id, with all columns; documents without words stay.

    Texts are not shuffled: what stays is stored by file and row, and each file's rows are filtered where they are read.
    """
    docs = located(docs)
    names = [c for c in docs.columns if c not in ("_part", "_row")]
    joined = _joined(with_part(docs))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "kind", "part", "row")
    first = joined.where("n_shingles > 0").groupBy("root").agg(F.min(order).alias("first")).select("first.part", "first.row")
    kept = stored_by_part(first.unionByName(joined.where("n_shingles = 0").select("part", "row")), "join-kept")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entered("jaccard")
        for batch in batches:
            part, row = batch.column(len(names)).to_numpy(), batch.column(len(names) + 1).to_numpy()
            mask = np.zeros(len(part), dtype=bool)
            for one in np.unique(part).tolist():
                mask |= (part == one) & np.isin(row, kept_rows(kept, one))
            yield batch.select(range(len(names))).filter(pa.array(mask))

    return docs.select(*names, "_part", "_row").mapInArrow(run, docs.select(*names).schema)


@functools.lru_cache(maxsize=2)
def kept_rows(path: str, part: int) -> np.ndarray:
    table = part_table(path, part, ["row"])
    return np.zeros(0, np.int64) if table is None else table.column("row").to_numpy()


emptied_by(kept_rows.cache_clear)


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """part, row, doc_id, n_shingles and class of every document."""
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["ids"], "<i8")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), row["part"])),
                    pa.array(unpack(row["rows"]).astype(np.int64)),
                    pa.array(ids, pa.int64(), mask=ids == NULL_ID),
                    pa.array(unpack(row["sizes"]).astype(np.int64)),
                    pa.array(hashes_of(row["kinds"]).view(np.int64)),
                ],
                names=["part", "row", "doc_id", "n_shingles", "kind"],
            )
