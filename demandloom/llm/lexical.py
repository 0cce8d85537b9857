"""Ranked lexical search by presence masks.

The terms that items ask for are looked up in every text once; what is left of a text is its length and the counts of those
terms, a small index that all later passes read. Statistics (documents, terms, documents of each term) come from the index.

Each task scores stretches of documents against every item. Bitmaps say which terms a document of the stretch holds; put
side by side for the terms of an item, they give each document's mask, and documents are grouped by it. The most that a
mask can score is the sum, over its terms, of the best impact that the stretch has. Masks are evaluated in descending
order of that bound, and an item is finished with the stretch as soon as the next bound is below its worst kept score.
Only the best few documents of each item leave a task, and are ranked again over all tasks. Texts are never shuffled.

Items are dealt into blocks by the number of their terms, which bounds the vocabulary that is broadcast; a block reads the
documents once for its index.

Scores are 64-bit integers: sum over the item's terms of w * ((10^9 * tf) div (1000 * tf + 8 * m)), with
w = floor(1000 * ln((2N + 2) / (2 df + 1))) and m = 10 + ((90 * n * N) div L).

Defined cases: null texts and texts without terms count in no statistic and are never found; an item with a null text or
without terms has no result; repeated documents count and rank each for itself; items with equal id and text are one, equal
ids with different texts are ranked each for itself; a null doc_id ranks behind others of its score; texts of any length
are read whole; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm.common import ranges, span_hashes, staged, text_slices, word_bounds

#: Distinct terms that the items of a block have together, about; documents scored in one step.
BLOCK_TERMS, STRETCH = 8192, 1024
#: Documents evaluated before the bound is looked at again.
STEP = 32


def _folded_bytes() -> np.ndarray:
    """Lookup that lower-cases A-Z and makes every ASCII byte that is no letter or digit a blank."""
    look = np.arange(256, dtype=np.uint8)
    look[65:91] += 32
    keep = np.zeros(128, dtype=bool)
    for low, high in ((48, 58), (65, 91), (97, 123)):
        keep[low:high] = True
    look[:128][~keep] = 0x20
    return look


_FOLDED = _folded_bytes()


def terms_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, start and end byte of every term, and its row."""
    folded = _FOLDED[data]
    starts, ends = word_bounds(folded, bounds)
    return folded, starts, ends, np.searchsorted(bounds, starts, side="right") - 1


@dataclass
class Terms:
    """A vocabulary that stretches of bytes are looked up in, exactly."""

    words: list[bytes]
    hashes: np.ndarray = field(init=False)
    order: np.ndarray = field(init=False)

    def __post_init__(self):
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.words), np.uint8)
        hashes = span_hashes(self.flat, self.begin, self.begin + self.sizes)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two terms of the items have the same hash")

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of each term, -1 where it is not in the vocabulary."""
        if not len(self.words):
            return np.full(len(starts), -1, np.int64)
        codes = span_hashes(data, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, codes), len(self.hashes) - 1)
        number = np.where(self.hashes[at] == codes, self.order[at], -1)
        number[(number >= 0) & (self.sizes[number] != ends - starts)] = -1
        # of one length, spans of up to eight bytes hash one to one; longer ones are compared
        long = np.flatnonzero((number >= 0) & (ends - starts > 8))
        if len(long):
            size = (ends - starts)[long]
            same = data[ranges(starts[long], size)] == self.flat[ranges(self.begin[number[long]], size)]
            number[long[~np.logical_and.reduceat(same, np.cumsum(size) - size)]] = -1
        return number


@dataclass
class Block:
    """Items of one block: their ids and the numbers of their terms in the block's vocabulary."""

    ids: list[int | None]
    terms: list[np.ndarray]
    vocabulary: Terms
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    documents: int = 0
    total: int = 0


def _item_terms(items: DataFrame) -> DataFrame:
    """item_id and the different terms of every different item that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in text_slices(batch.column(1)):
                folded, starts, ends, row = terms_of(data, bounds)
                raw, own = folded.tobytes(), [set() for _ in range(end - first)]
                for n, a, b in zip(row.tolist(), starts.tolist(), ends.tolist(), strict=True):
                    own[n].add(raw[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array([sorted(x) for x in own], pa.list_(pa.binary()))],
                    names=["item_id", "terms"],
                )

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).distinct()
    return rows.mapInArrow(run, "item_id long, terms array<binary>").where(F.size("terms") > 0)


def blocks_of(items: DataFrame, block_terms: int = BLOCK_TERMS) -> Iterator[Block]:
    """The items in blocks of about `block_terms` terms; only one block at a time is on the driver."""
    rows = staged(_item_terms(items), "item-terms")
    total = rows.agg(F.sum(F.size("terms"))).first()[0] or 0
    count = -(-total // block_terms)
    for n in range(count):
        own = rows.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(count)) == n).orderBy("item_id", "terms").collect()
        words = sorted({bytes(w) for r in own for w in r["terms"]})
        number = {w: k for k, w in enumerate(words)}
        terms = [np.array([number[bytes(w)] for w in r["terms"]], np.int64) for r in own]
        if own:
            yield Block([r["item_id"] for r in own], terms, Terms(words))


def term_counts(docs: DataFrame, block: Block) -> DataFrame:
    """doc_id, n (terms of the text), and numbers and counts of the vocabulary's terms in it, for documents with terms."""
    shared = docs.sparkSession.sparkContext.broadcast(block.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        width = max(len(known.words), 1)
        for batch in batches:
            for first, end, data, bounds in text_slices(batch.column(1)):
                folded, starts, ends, row = terms_of(data, bounds)
                number = known.find(folded, starts, ends)
                hit = number >= 0
                n = np.bincount(row, minlength=end - first)
                pair, count = np.unique(row[hit] * width + number[hit], return_counts=True)
                edges = np.searchsorted(pair, np.arange(end - first + 1) * width).astype(np.int32)
                arrays = [
                    batch.column(0).slice(first, end - first),
                    pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(edges), pa.array(pair % width, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(edges), pa.array(count, pa.int64())),
                ]
                whole = pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "term", "tf"])
                yield whole.filter(pa.array(n > 0))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(run, "doc_id long, n long, term array<int>, tf array<long>")


def with_statistics(block: Block, index: DataFrame) -> Block:
    """The block with the weights of its terms; one row per term of the vocabulary reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, total = np.zeros(width, np.int64), 0, 0
        for batch in batches:
            rows += batch.num_rows
            total += int(batch.column(0).to_numpy().sum())
            held += np.bincount(batch.column(1).flatten().to_numpy(), minlength=width)
        term = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-2, -1, term]), pa.array(np.r_[rows, total, held[term]])], names=["term", "count"]
        )

    width = len(block.vocabulary.words)
    sums = index.select("n", "term").mapInArrow(run, "term long, count long").groupBy("term").agg(F.sum("count").alias("count"))
    found = {r["term"]: r["count"] for r in sums.collect()}
    block.documents, block.total = found.get(-2, 0), found.get(-1, 0)
    held = [found.get(k, 0) for k in range(width)]
    top = 2 * block.documents + 2
    block.weight = np.array([math.floor(1000 * math.log(top / (2 * df + 1))) for df in held], np.int64)
    return block


class Best:
    """The best documents of one item so far: highest score first, then smallest id, null last."""

    def __init__(self, k: int):
        self.k, self.score, self.id, self.null = k, *(np.zeros(0, t) for t in (np.int64, np.int64, bool))

    @property
    def least(self) -> int:
        """Score that a further document must reach."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        fit = score >= self.least
        score, ids, null = (np.concatenate(v) for v in ((self.score, score[fit]), (self.id, ids[fit]), (self.null, null[fit])))
        order = np.lexsort((ids, null, -score))[: self.k]
        self.score, self.id, self.null = score[order], ids[order], null[order]


def masks_of(impact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents (columns) in order of their mask of terms (rows) that they hold, and where each group begins."""
    bits = np.packbits(impact > 0, axis=0)
    words = np.zeros((-(-len(bits) // 8) * 8, bits.shape[1]), np.uint8)
    words[: len(bits)] = bits
    words = np.ascontiguousarray(words.T).view("<u8")
    order = np.lexsort(words.T)
    ordered = words[order]
    return order, np.flatnonzero(np.r_[True, (ordered[1:] != ordered[:-1]).any(axis=1)])


def evaluate(best: Best, impact: np.ndarray, weight: np.ndarray, top: np.ndarray, ids: np.ndarray, null: np.ndarray) -> int:
    """Bring an item's best documents up to date with a stretch; returns the number of documents evaluated.

    `impact` has a row for each term of the item and a column for each document; `top` is the largest of each row.
    """
    most = weight * top
    if most.sum() < best.least:
        return 0
    order, first = masks_of(impact)
    bound = most @ (impact[:, order[first]] > 0)
    size = np.diff(np.append(first, len(order)))
    rank = np.argsort(-bound, kind="stable")
    bound, total = bound[rank], np.cumsum(size[rank])
    at, seen = 0, 0
    while at < len(rank) and bound[at] >= best.least:
        reach = int(np.searchsorted(-bound, -best.least, side="right"))
        end = min(reach, int(np.searchsorted(total, seen + STEP)) + 1)
        masks = rank[at:end]
        docs = order[ranges(first[masks], size[masks])]
        best.add(weight @ impact[:, docs].astype(np.int64), ids[docs], null[docs])
        at, seen = end, int(total[end - 1])
    return seen


def _ranked(index: DataFrame, block: Block, k: int) -> DataFrame:
    """item (number in the block), item_id, doc_id and score of the best documents of each task."""
    shared = index.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        best = [Best(k) for _ in block.ids]
        impact = np.zeros((len(block.vocabulary.words), STRETCH), np.int32)
        for batch in batches:
            for first in range(0, batch.num_rows, STRETCH):
                part = batch.slice(first, STRETCH)
                null = part.column(0).is_null().to_numpy(zero_copy_only=False)
                ids = part.column(0).fill_null(0).to_numpy()
                # whole numbers of any size: 90 * n * N may pass 64 bits before it is divided
                length, back = np.unique(part.column(1).to_numpy(), return_inverse=True)
                m = np.array([10 + 90 * int(n) * block.documents // block.total for n in length], np.int64)[back]
                doc = np.repeat(np.arange(len(ids)), pa.compute.list_value_length(part.column(2)).to_numpy())
                term, tf = part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy()
                impact[term, doc] = 10**9 * tf // (1000 * tf + 8 * m[doc])
                top = impact[:, : len(ids)].max(axis=1)
                for item, terms in enumerate(block.terms):
                    evaluate(best[item], impact[terms, : len(ids)], block.weight[terms], top[terms], ids, null)
                impact[term, doc] = 0
        item = np.repeat(np.arange(len(best)), [len(b.score) for b in best])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(item, pa.int32()),
                pa.array([block.ids[n] for n in item.tolist()], pa.int64()),
                pa.array(np.concatenate([b.id for b in best]), pa.int64(), mask=np.concatenate([b.null for b in best])),
                pa.array(np.concatenate([b.score for b in best]), pa.int64()),
            ],
            names=["item", "item_id", "doc_id", "score"],
        )

    return index.mapInArrow(run, "item int, item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the k best documents of every item, scores above zero only."""
    spark = docs.sparkSession
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for block in blocks_of(items, block_terms):
        index = staged(term_counts(docs, block), "term-counts")
        if not with_statistics(block, index).total:
            break
        rows = _ranked(index, block, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        found = found.unionByName(rows.select("item_id", "rank", "doc_id", "score"))
    return found
