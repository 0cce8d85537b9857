"""Exact removal of repeated byte strings over the whole corpus.

Every string of WINDOW bytes has a minimiser: the leftmost smallest hash of its GRAM-byte grams. The windows of a text
fall into runs with one minimiser each, so equal windows, wherever they stand, meet under the same hash. The work goes in
three passes over the texts, which are never shuffled:

1. every task sends each different run of its texts once for each part, as two hashes (of the minimiser and of the run's
   bytes) with the smallest doc_id. A minimiser whose runs are all equal, as inside copies and shared passages, is settled
   there: the smallest doc_id goes back. Of a minimiser with several different runs, one part is asked for the bytes of
   each;
2. tasks send those bytes, once for each different run of the corpus. Each receiver builds an enhanced suffix array over
   the different runs that share a minimiser, scans its interval tree for maximal repeats of at least WINDOW bytes with all
   their occurrences, and sends back the stretches of windows that a smaller doc_id has in another run;
3. every task removes the bytes of windows that a smaller doc_id has, and digests the rest.

What goes back to a text is stored in the shared folder by the block of rows of the file that the text is read from, so it
is read by the tasks that need it and held in parts of bounded size, however large the files are. Messages are packed by
size, whatever number of parts a task reads: one row for each stretch of hashes, of which there are as many as the bytes of
the corpus ask for. A minimiser with very many different runs (HOT) would gather them all in one place; the windows of its
runs are sent one by one under a hash of their own instead, where equal ones are merged before they are sent.

Defined cases: null text has no bytes; a null doc_id counts as smaller than any other; rows with the same doc_id do not
remove each other's bytes; texts shorter than WINDOW bytes lose nothing; texts of any length are handled in slices of
whole documents; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import emptied_by, entered, mix, ranges, span_hashes
from demandloom.llm.parts import (
    NULL_ID, hashes_of, pack, part_table, planes, slices, stored_by_part, unpack, unplanes, with_part,
)
from demandloom.llm.suffix_array import maximal_repeats

WINDOW, GRAM = 50, 16
#: Different runs with the same minimiser from which its windows travel alone.
HOT = 400
#: Runs that a task gathers before it sends them.
SENT_RUNS = 800_000
#: Bytes of runs that a task gathers before it sends them.
SENT_BYTES = 8 << 20
#: Text bytes of the corpus for each stretch of hashes.
STRETCH_BYTES = 16 << 20
#: Entries that a receiver unpacks at a time, and different runs in one suffix array (more only within one minimiser).
UNPACKED, SORTED_RUNS = 400_000, 6_000


# -- runs of a text ---------------------------------------------------------------------------------------------------


def runs_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser hash, first window, last window and row of every run of windows with one minimiser."""
    none = np.zeros(0, np.int64)
    windows = len(data) - WINDOW + 1
    if windows <= 0:
        return none.astype(np.uint64), none, none, none
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    words = np.ndarray((len(data) + 8,), dtype="<u8", buffer=padded, strides=(1,))
    low = words[: len(data) - GRAM + 1] * np.uint64(0x9E3779B97F4A7C15)
    low ^= low >> np.uint64(29)
    low += words[8: len(data) - GRAM + 9] * np.uint64(0xD6E8FEB86659FD93)
    low ^= low >> np.uint64(32)
    low *= np.uint64(0xBF58476D1CE4E5B9)
    low ^= low >> np.uint64(31)
    best, place, have, span = low, np.arange(len(low), dtype=np.int32), 1, WINDOW - GRAM + 1
    while have < span:  # leftmost minimum of `have` neighbours, then of up to twice as many
        add = min(have, span - have)
        a, b = best[: len(best) - add], best[add:]
        right = b < a
        best = np.where(right, b, a)
        place = np.where(right, place[add:], place[: len(place) - add])
        have += add
    valid = np.zeros(len(data) + 1, np.int8)
    counts = np.maximum(np.diff(bounds) - WINDOW + 1, 0)
    full = counts > 0
    valid[bounds[:-1][full]] = 1
    np.add.at(valid, (bounds[:-1] + counts)[full], -1)
    valid = np.cumsum(valid[:windows], dtype=np.int8) > 0
    change = np.ones(windows, dtype=bool)
    change[1:] = place[1:] != place[:-1]
    change[1:] |= valid[1:] != valid[:-1]
    # a run also ends where a text does; its windows are cut off by `valid` unless the next text starts right there
    starts = bounds[:-1][full]
    change[starts[starts < windows]] = True
    first = np.flatnonzero(change)
    last = np.append(first[1:], windows) - 1
    keep = valid[first]
    first, last = first[keep], last[keep]
    return best[first], first, last, np.searchsorted(bounds, first, side="right") - 1


# -- messages ---------------------------------------------------------------------------------------------------------

MESSAGE = "stretch int, alone boolean, hashes binary, keys binary, parts binary, part_at binary, low binary, many binary, sizes binary, bytes binary"
_KINDS = [pa.int32(), pa.bool_()] + [pa.binary()] * 8
_NAMES = ["stretch", "alone", "hashes", "keys", "parts", "part_at", "low", "many", "sizes", "bytes"]
#: Minimisers and windows are told by the upper bits of their hash and by a second hash of 64 bits.
HASH_BITS = 48


class Outbox:
    """Entries (hash, key, part, id) of a task, sent in ascending hashes, one row for each stretch of them."""

    def __init__(self, stretches: int, alone: bool):
        self.stretches, self.alone = stretches, alone
        self.empty()

    def empty(self) -> None:
        self.held: list[tuple[np.ndarray, ...]] = []
        self.parts: list[int] = []
        self.size = self.bytes = 0

    def add(self, part: int, hashes: np.ndarray, keys: np.ndarray, ids: np.ndarray, sizes=None, text=None) -> None:
        if not len(hashes):
            return
        if not self.parts or self.parts[-1] != part:
            self.parts.append(part)
        at = np.full(len(hashes), len(self.parts) - 1, np.int32)
        sizes = np.zeros(len(hashes), np.int64) if sizes is None else sizes
        text = np.zeros(0, np.uint8) if text is None else text
        self.held.append((hashes, keys, at, ids, sizes, text))
        self.size += len(hashes)
        self.bytes += len(text)

    def full(self) -> bool:
        return self.size > SENT_RUNS or self.bytes > SENT_BYTES

    def send(self) -> Iterator[pa.RecordBatch]:
        """Each (hash, key) of a part once, with the smallest id and whether there are several, and its bytes if any."""
        if not self.held:
            return
        h, keys, at, ids, sizes, text = (np.concatenate(c) for c in zip(*self.held, strict=True))
        begin = np.cumsum(sizes) - sizes
        order = np.lexsort((keys, h))  # stable: parts stay in their order
        h, keys, at, ids = h[order], keys[order], at[order], ids[order]
        first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (keys[1:] != keys[:-1]) | (at[1:] != at[:-1])])
        low, many = np.minimum.reduceat(ids, first), np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)
        h, keys, at, source = h[first], keys[first], at[first], order[first]
        edges = [(k << HASH_BITS) // self.stretches for k in range(1, self.stretches)]
        cuts = [0, *np.searchsorted(h, np.array(edges, np.uint64)).tolist(), len(h)]
        parts = np.array(self.parts, np.int64).tobytes()
        out = []
        for k in range(self.stretches):
            s = slice(cuts[k], cuts[k + 1])
            if cuts[k] == cuts[k + 1]:
                continue
            raw = lengths = b""
            if not self.alone and len(text):
                own = source[s]
                raw = text[ranges(begin[own], sizes[own])].tobytes()
                lengths = planes(sizes[own])
            steps = np.diff(h[s], prepend=np.uint64(0))
            flags = np.packbits(many[s]).tobytes()
            out.append((k, self.alone, planes(steps[:1]) + planes(steps[1:]), keys[s].tobytes(), parts, planes(at[s]),
                        planes(low[s]), flags, lengths, raw))
        self.empty()
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), _KINDS, strict=True)], names=_NAMES
        )


def by_stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict[str, np.ndarray]]]:
    """Columns of all entries of a range of hashes, unpacked a bounded number at a time; a hash is never divided."""
    held: dict[tuple[int, bool], list[dict]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            held.setdefault((row["stretch"], row["alone"]), []).append(row)
    while held:
        key = next(iter(held))
        rows = held.pop(key)
        counts = [len(r["keys"]) // 8 for r in rows]
        hashes = []
        for r, n in zip(rows, counts, strict=True):
            front = 9 + r["hashes"][0]
            steps = np.concatenate([unplanes(r["hashes"][:front], 1), unplanes(r["hashes"][front:], n - 1)])
            hashes.append(np.cumsum(steps))
        pieces = -(-sum(counts) // UNPACKED)
        low, high = min(int(h[0]) for h in hashes), max(int(h[-1]) for h in hashes) + 1
        edges = [low + (high - low) * k // pieces for k in range(pieces + 1)]
        for k in range(pieces):
            found: list[tuple[np.ndarray, ...]] = []
            for r, n, h in zip(rows, counts, hashes, strict=True):
                a, b = np.searchsorted(h, edges[k: k + 2]).tolist()
                if a == b:
                    continue
                sizes = unplanes(r["sizes"], n) if r["sizes"] else np.zeros(n, np.int64)
                skip, size = int(sizes[:a].sum()), int(sizes[a:b].sum())
                parts = np.frombuffer(r["parts"], np.int64)[unplanes(r["part_at"], n, a, b)]
                many = np.unpackbits(np.frombuffer(r["many"], np.uint8), count=n)[a:b].astype(bool)
                text = np.frombuffer(r["bytes"], np.uint8)[skip: skip + size]
                found.append((h[a:b], hashes_of(r["keys"])[a:b], parts, unplanes(r["low"], n, a, b), many, sizes[a:b], text))
            if found:
                names = ("hashes", "keys", "parts", "low", "many", "sizes", "text")
                yield key[1], {name: np.concatenate(c) for name, c in zip(names, zip(*found, strict=True), strict=True)}


# -- pass 1: shared minimisers ----------------------------------------------------------------------------------------

#: What is known of a run: settled, several runs share its minimiser, the same and its bytes are asked for, hot.
SETTLED, MIXED, ASKED, ALONE = range(4)


def runs_with_keys(data: np.ndarray, bounds: np.ndarray):
    """Mixed minimiser, hash of the bytes, first and last window, and row of every run.

    Minimisers are small numbers, so they are mixed before ranges of them are dealt to tasks.
    """
    h, first, last, row = runs_of(data, bounds)
    h = mix(h)
    return h >> np.uint64(64 - HASH_BITS), span_hashes(data, first, last + WINDOW) ^ h, first, last, row


def seen_runs(stretches: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entered("repeats")
        box = Outbox(stretches, alone=False)
        for part, own, data, bounds in slices(batches):
            h, keys, _, _, row = runs_with_keys(data, bounds)
            box.add(part, h, keys, own[row])
            if box.full():
                yield from box.send()
        yield from box.send()

    return run


def settled(entries: dict[str, np.ndarray], hot: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries that need an answer, the smallest id of each one's bytes, and what is known of it."""
    order = np.lexsort((entries["keys"], entries["hashes"]))
    h, keys, low, many = (entries[name][order] for name in ("hashes", "keys", "low", "many"))
    new = np.r_[True, h[1:] != h[:-1]]
    other = new | np.r_[True, keys[1:] != keys[:-1]]
    group, first = np.cumsum(new) - 1, np.flatnonzero(new)
    least = np.minimum.reduceat(low, np.flatnonzero(other))[np.cumsum(other) - 1]
    shared = (np.minimum.reduceat(low, first) != np.maximum.reduceat(low, first)) | np.logical_or.reduceat(many, first)
    kinds = np.add.reduceat(other.astype(np.int64), first)
    state = np.where(kinds == 1, SETTLED, np.where(kinds > hot, ALONE, MIXED)).astype(np.uint8)[group]
    state[other & (state == MIXED)] = ASKED
    # the only document of a part that has the bytes learns nothing if it is the smallest that has them
    needed = shared[group] & ((kinds[group] > 1) | many | (low > least))
    return order[needed], least[needed], state[needed]


def settle(batches: Iterator[pa.RecordBatch], hot: int) -> Iterator[pa.RecordBatch]:
    """For every part its runs that other documents may have, with the smallest id and what is known of them."""
    for _, entries in by_stretch(batches):
        at, least, state = settled(entries, hot)
        parts, keys = entries["parts"][at], entries["keys"][at]
        order = np.lexsort((state, keys, parts))
        edges = np.flatnonzero(np.r_[True, np.diff(parts[order]) != 0, True]) if len(order) else []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            own = order[a:b]
            columns = [keys[own].tobytes(), planes(least[own]), state[own].tobytes()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([parts[own[0]]], pa.int64()), *(pa.array([c], pa.binary()) for c in columns)],
                names=["part", "keys", "low", "state"],
            )


@functools.lru_cache(maxsize=2)
def known(path: str, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending keys of a part's runs that others may have, their smallest ids, and what is known of them."""
    table = part_table(path, part, ["keys", "low", "state"])
    if table is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
    rows = table.to_pylist()
    keys = np.concatenate([hashes_of(r["keys"]) for r in rows])
    low = np.concatenate([unplanes(r["low"], len(r["state"])) for r in rows])
    state = np.concatenate([np.frombuffer(r["state"], np.uint8) for r in rows])
    order = np.lexsort((state, keys))
    last = order[np.r_[keys[order][1:] != keys[order][:-1], True]]  # asked for, if any of the same run is
    return keys[last], low[last], state[last]


emptied_by(known.cache_clear)


def found_in(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in the ascending table, and whether it is there."""
    at = np.searchsorted(table, keys)
    hit = at < len(table)
    hit[hit] = table[at[hit]] == keys[hit]
    return at, hit


def lone_windows(data: np.ndarray, first: np.ndarray, last: np.ndarray, row: np.ndarray):
    """Start, row and two hashes of every window of some runs."""
    counts = last - first + 1
    start = ranges(first, counts)
    one = span_hashes(data, start, start + WINDOW) >> np.uint64(64 - HASH_BITS)
    two = span_hashes(data ^ 0x5A, start, start + WINDOW)
    return start, np.repeat(row, counts), one, two


# -- pass 2: smallest document of the windows of different runs -------------------------------------------------------


def sent_runs(path: str, stretches: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Runs whose minimiser has others, with their bytes where those are asked for, and the windows of hot minimisers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entered("repeats")
        mixed, alone = Outbox(stretches, alone=False), Outbox(stretches, alone=True)
        for part, own, data, bounds in slices(batches):
            h, keys, first, last, row = runs_with_keys(data, bounds)
            table, low, state = known(path, part)
            at, hit = found_in(table, keys)
            kind = np.full(len(keys), SETTLED, np.uint8)
            kind[hit] = state[at[hit]]
            some = np.flatnonzero((kind == MIXED) | (kind == ASKED))
            if len(some):
                _, index = np.unique(keys[some], return_index=True)
                some = some[index]
                sizes = np.where(kind[some] == ASKED, last[some] - first[some] + WINDOW, 0)
                mixed.add(part, h[some], keys[some], low[at[some]], sizes, data[ranges(first[some], sizes)])
            hot = kind == ALONE
            if hot.any():
                _, rows, one, two = lone_windows(data, first[hot], last[hot], row[hot])
                alone.add(part, one, two, own[rows])
            for box in (mixed, alone):
                if box.full():
                    yield from box.send()
        yield from mixed.send()
        yield from alone.send()

    return run


FOUND = "part long, keys binary, low binary, piece_at binary, piece_first binary, piece_last binary, piece_low binary"


def smaller_windows(
    h: np.ndarray, sizes: np.ndarray, begin: np.ndarray, text: np.ndarray, low: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(run, first window, last window, smallest id) of stretches of windows that a smaller id has in another run.

    Runs are in the order of their minimisers, each different run once.
    """
    edges = np.flatnonzero(np.r_[True, h[1:] != h[:-1], True])
    a = 0
    while a < len(h):
        b = int(edges[max(np.searchsorted(edges, a + SORTED_RUNS, side="right") - 1, np.searchsorted(edges, a, side="right"))])
        size, least = sizes[a:b], low[a:b]
        data = text[ranges(begin[a:b], size)]
        start = np.cumsum(size) - size
        own = np.repeat(least, size)
        best = own.copy()
        for length, at, smallest in maximal_repeats(data, start, start + size, least, WINDOW):
            covered = (at[:, None] + np.arange(length - WINDOW + 1)).ravel()
            best[covered] = np.minimum(best[covered], smallest)
        better = best < own
        change = best[1:] != best[:-1]
        edge = np.flatnonzero(better & np.r_[True, ~better[:-1] | change])
        stop = np.flatnonzero(better & np.r_[~better[1:] | change, True])
        # a stretch never crosses runs: the last WINDOW - 1 bytes of a run start no window
        owner = np.searchsorted(start, edge, side="right") - 1
        yield owner + a, edge - start[owner], stop - start[owner], best[edge]
        a = b


def smallest_ids(batches: Iterator[pa.RecordBatch], hot: int) -> Iterator[pa.RecordBatch]:
    """For every part: lone windows that others have, and stretches of its runs' windows where a smaller id has those."""
    empty = np.zeros(0, np.int64)
    for alone, entries in by_stretch(batches):
        if alone:
            at, low, _ = settled(entries, hot)
            kind, pieces = np.zeros(len(at), np.int64), [empty] * 4
        else:
            order = np.lexsort((entries["sizes"] == 0, entries["keys"], entries["hashes"]))
            h, keys = entries["hashes"][order], entries["keys"][order]
            head = np.r_[True, (h[1:] != h[:-1]) | (keys[1:] != keys[:-1])]
            one = order[head]
            begin = np.cumsum(entries["sizes"]) - entries["sizes"]
            found = list(smaller_windows(entries["hashes"][one], entries["sizes"][one], begin[one], entries["text"], entries["low"][one]))
            pieces = [np.concatenate(c) for c in zip(*found, strict=True)]
            kind = np.cumsum(head) - 1
            needed = np.isin(kind, pieces[0])
            at, kind = order[needed], kind[needed]
            low = entries["low"][at]
        parts, keys = entries["parts"][at], entries["keys"][at]
        order = np.lexsort((keys, parts))
        edges = np.flatnonzero(np.r_[True, np.diff(parts[order]) != 0, True]) if len(order) else []
        by = np.argsort(pieces[0], kind="stable")
        owners = pieces[0][by]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            own = order[a:b]
            own = own[np.r_[True, keys[own][1:] != keys[own][:-1]]]
            x, y = np.searchsorted(owners, kind[own]), np.searchsorted(owners, kind[own], side="right")
            chosen = by[ranges(x, y - x)]
            columns = [keys[own].tobytes(), planes(low[own]), pack(np.repeat(np.arange(len(own)), y - x))]
            columns += [pack(p[chosen]) for p in pieces[1:]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([parts[own[0]]], pa.int64()), *(pa.array([c], pa.binary()) for c in columns)],
                names=["part", "keys", "low", "piece_at", "piece_first", "piece_last", "piece_low"],
            )


class Verdicts:
    """Smallest ids of a part's lone windows, and the stretches of its runs' windows with smaller ones."""

    def __init__(self, table: pa.Table | None):
        rows = table.to_pylist() if table is not None else []
        sizes = [len(r["keys"]) // 8 for r in rows]
        begin = np.cumsum([0, *sizes])
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        keys = join([hashes_of(r["keys"]) for r in rows], np.uint64)
        low = join([unplanes(r["low"], n) for r, n in zip(rows, sizes, strict=True)], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.low = keys[order], low[order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        at = rank[join([unpack(r["piece_at"]) + b for r, b in zip(rows, begin, strict=False)], np.int64)]
        by = np.argsort(at, kind="stable")
        self.at = at[by]
        self.first, self.last, self.least = (
            join([unpack(r[name]) for r in rows], np.int64)[by] for name in ("piece_first", "piece_last", "piece_low")
        )


@functools.lru_cache(maxsize=2)
def verdicts(path: str, part: int) -> Verdicts:
    return Verdicts(part_table(path, part, ["keys", "low", "piece_at", "piece_first", "piece_last", "piece_low"]))


emptied_by(verdicts.cache_clear)


# -- pass 3: removal --------------------------------------------------------------------------------------------------


def covered_bytes(shared: str, found: str, part: int, ids: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether each byte of a slice lies in a window that a smaller id has."""
    _, keys, first, last, row = runs_with_keys(data, bounds)
    table, low, state = known(shared, part)
    answers = verdicts(found, part)
    edge = np.zeros(len(data) + 1, np.int64)

    def gone(starts: np.ndarray, ends: np.ndarray) -> None:
        np.add.at(edge, starts, 1)
        np.add.at(edge, ends + WINDOW, -1)

    at, hit = found_in(table, keys)
    at, keys, first, last, row = at[hit], keys[hit], first[hit], last[hit], row[hit]
    whole = low[at] < ids[row]
    gone(first[whole], last[whole])
    kind = state[at]
    mixed = np.flatnonzero((kind == MIXED) | (kind == ASKED))
    place, hit = found_in(answers.keys, keys[mixed])
    place, mixed = place[hit], mixed[hit]
    a, b = np.searchsorted(answers.at, place), np.searchsorted(answers.at, place, side="right")
    piece, run = ranges(a, b - a), np.repeat(mixed, b - a)
    smaller = answers.least[piece] < ids[row[run]]
    piece, run = piece[smaller], run[smaller]
    gone(first[run] + answers.first[piece], first[run] + answers.last[piece])
    hot = kind == ALONE
    if hot.any():
        start, rows, _, two = lone_windows(data, first[hot], last[hot], row[hot])
        place, hit = found_in(answers.keys, two)
        start, rows = start[hit], rows[hit]
        smaller = answers.low[place[hit]] < ids[rows]
        gone(start[smaller], start[smaller])
    return np.cumsum(edge[:-1]) > 0


def _tables(docs: DataFrame, hot: int) -> tuple[DataFrame, str, str]:
    """Rows with their part, and the stored results of the first two passes."""
    rows = with_part(docs)
    size = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    stretches = max(-(-size // STRETCH_BYTES), 2 * docs.sparkSession.sparkContext.defaultParallelism)
    seen = rows.mapInArrow(seen_runs(stretches), MESSAGE).repartition(stretches, "stretch")
    shared = seen.mapInArrow(lambda batches: settle(batches, hot), "part long, keys binary, low binary, state binary")
    shared = stored_by_part(shared, "repeat-shared")
    sent = rows.mapInArrow(sent_runs(shared, stretches), MESSAGE).repartition(stretches, "stretch")
    found = stored_by_part(sent.mapInArrow(lambda batches: smallest_ids(batches, hot), FOUND), "repeat-found")
    return rows, shared, found


def removed_spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, first and end byte of every maximal removed run."""
    rows, shared, found = _tables(docs, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entered("repeats")
        for part, ids, data, bounds in slices(batches):
            gone = covered_bytes(shared, found, part, ids, data, bounds)
            row, first, end = spans_of(gone, bounds)
            own = pa.array(ids[row], pa.int64(), mask=ids[row] == NULL_ID)
            yield pa.RecordBatch.from_arrays([own, pa.array(first), pa.array(end)], names=["doc_id", "first", "end"])

    return rows.mapInArrow(run, "doc_id long, first long, end long")


def spans_of(gone: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and end byte (inside the row) of every maximal run of removed bytes."""
    edge = np.zeros(len(gone) + 1, dtype=bool)
    edge[bounds] = True
    first = np.flatnonzero(gone & (np.r_[True, ~gone[:-1]] | edge[:-1])) if len(gone) else np.zeros(0, np.int64)
    end = np.flatnonzero(gone & (np.r_[~gone[1:], True] | edge[1:])) + 1 if len(gone) else np.zeros(0, np.int64)
    row = np.searchsorted(bounds, first, side="right") - 1
    return row, first - bounds[row], end - bounds[row]


def deduplicate(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the digest of the bytes left of every document."""
    rows, shared, found = _tables(docs, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entered("repeats")
        for part, ids, data, bounds in slices(batches):
            gone = covered_bytes(shared, found, part, ids, data, bounds)
            row, _, _ = spans_of(gone, bounds)
            removed = np.concatenate([[0], np.cumsum(gone)])
            kept, at = data[~gone], bounds - removed[bounds]
            digests = [hashlib.sha256(kept[at[k]: at[k + 1]].tobytes()).hexdigest() for k in range(len(ids))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64(), mask=ids == NULL_ID),
                    pa.array(np.diff(bounds)),
                    pa.array(removed[bounds[1:]] - removed[bounds[:-1]]),
                    pa.array(np.bincount(row, minlength=len(ids)).astype(np.int64)),
                    pa.array(digests, pa.string()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
