"""Fill-in-the-middle transformation by displacement scatter.

A text is cut at two line starts into prefix, middle and suffix, which are written in another order behind tags. For a
batch of texts the cuts are found by one scan of the line ends; a difference array gets, at the first byte of each part,
the change of displacement that begins there; its running sum is the displacement of every byte, and one scatter writes
all outputs of the batch. Restoring finds the tags, builds the displacements of the inverse the same way and gathers.

The cuts, the order of the parts and the choice of rows come from a digest of the seed and doc_id, so they depend neither
on partitions nor on other rows.

Defined cases: null text is the empty text; empty texts and texts that hold a tag stay as they are (form plain, no counts);
a text of one line has both cuts at its ends, and any of the three parts may be empty; repeated rows are cut alike; a null
doc_id is drawn like an empty id; texts of any length are moved whole, one at a time where they are longer than a slice;
an empty table gives an empty result; further columns of the input are not read. Restored is null where an output does not
hold every tag once, in the order of its form.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import text_slices

PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Recipe:
    """Seed of the draws, share of texts rearranged and of suffix-first ones (in hundredths), tags of the three parts."""

    seed: int = 7
    rate: int = 100
    spm: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        tags = [self.prefix, self.suffix, self.middle]
        # a tag next to any text must not form a further tag
        joined = any(a[-k:] == b[:k] for a in tags for b in tags for k in range(1, min(len(a), len(b))))
        if not all(tags) or joined or any(a in b for i, a in enumerate(tags) for j, b in enumerate(tags) if i != j):
            raise ValueError("tags must not be empty, overlap or contain each other")

    @property
    def tags(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of the tags of prefix, suffix and middle."""
        return tuple(np.frombuffer(tag.encode("utf-8"), np.uint8) for tag in (self.prefix, self.suffix, self.middle))


def draws(seed: int, doc_id: Column) -> list[Column]:
    """Four unsigned 32-bit numbers from the digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def occurrences(data: np.ndarray, bounds: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of a tag and their rows; a tag does not cross rows."""
    if len(data) < len(tag):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    here = data[: len(data) - len(tag) + 1] == tag[0]
    for k in range(1, len(tag)):
        here &= data[k: len(data) - len(tag) + 1 + k] == tag[k]
    at = np.flatnonzero(here)
    row = np.searchsorted(bounds, at, side="right") - 1
    inside = at + len(tag) <= bounds[row + 1]
    return at[inside], row[inside]


def displaced(size: int, starts: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Place that each of `size` bytes moves to or comes from; parts are given in the order of the bytes."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, starts, np.diff(shift, prepend=0))
    return np.cumsum(step[:-1]) + np.arange(size)


def characters(data: np.ndarray) -> np.ndarray:
    """Number of characters that begin before each byte, with the total at the end."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])


def line_cuts(data: np.ndarray, bounds: np.ndarray, first: np.ndarray, second: np.ndarray):
    """Number of lines of each row and the bytes where the lines number first % (n + 1) and second % (n + 1) begin."""
    ends = np.flatnonzero(data == 0x0A)
    before = np.searchsorted(ends, bounds)
    closed = np.diff(before)
    sizes = np.diff(bounds)
    full = sizes > 0
    open_end = np.zeros(len(sizes), dtype=bool)
    open_end[full] = data[bounds[1:][full] - 1] != 0x0A
    n = closed + open_end
    places = np.append(ends + 1, len(data))
    cuts = []
    for draw in (first, second):
        k = draw % (n + 1)
        at = places[np.clip(before[:-1] + k - 1, 0, len(ends))]
        at = np.where(k == 0, bounds[:-1], np.where(k > closed, bounds[1:], at))
        cuts.append(at)
    return n, np.minimum(*cuts), np.maximum(*cuts)


def rearrange(data: np.ndarray, bounds: np.ndarray, low: np.ndarray, high: np.ndarray, form: np.ndarray, recipe: Recipe):
    """Bytes and row bounds of the outputs; form is 0 (plain), 1 (psm) or 2 (spm)."""
    p_tag, s_tag, m_tag = recipe.tags
    start, end = bounds[:-1], bounds[1:]
    moved, spm = form > 0, form == 2
    size = end - start + moved * (len(p_tag) + len(s_tag) + len(m_tag))
    out_bounds = np.concatenate([[0], np.cumsum(size)])
    begin = out_bounds[:-1]
    p_size, m_size, s_size = low - start, high - low, end - high
    p_at = np.where(spm, begin + len(s_tag) + s_size, begin)
    s_at = np.where(spm, begin, begin + len(p_tag) + p_size)
    m_at = begin + size - m_size - len(m_tag)
    whole = begin - start
    shift = np.stack([
        np.where(moved, p_at + len(p_tag) - start, whole),
        np.where(moved, m_at + len(m_tag) - low, whole),
        np.where(moved, s_at + len(s_tag) - high, whole),
    ], axis=1)
    out = np.empty(int(out_bounds[-1]), np.uint8)
    out[displaced(len(data), np.stack([start, low, high], axis=1).ravel(), shift.ravel())] = data
    for at, tag in ((p_at, p_tag), (s_at, s_tag), (m_at, m_tag)):
        out[at[moved][:, None] + np.arange(len(tag))] = tag
    return out, out_bounds


def put_back(data: np.ndarray, bounds: np.ndarray, form: np.ndarray, recipe: Recipe):
    """Bytes and row bounds of the texts that the outputs were made of, and which rows could not be read."""
    rows = len(form)
    at, count = np.zeros((3, rows), np.int64), np.zeros((3, rows), np.int64)
    for k, tag in enumerate(recipe.tags):
        place, row = occurrences(data, bounds, tag)
        at[k, row] = place
        count[k] = np.bincount(row, minlength=rows)
    start, end = bounds[:-1], bounds[1:]
    moved, spm = form > 0, form == 2
    lead, follow = np.where(spm, at[1], at[0]), np.where(spm, at[0], at[1])
    broken = moved & ~((count == 1).all(axis=0) & (lead == start) & (lead < follow) & (follow < at[2]))
    moved = moved & ~broken
    sizes = [len(tag) for tag in recipe.tags]
    p_from = np.where(moved, at[0] + sizes[0], start)
    s_from = np.where(moved, at[1] + sizes[1], end)
    m_from = np.where(moved, at[2] + sizes[2], end)
    p_size = np.where(moved, np.where(spm, at[2], at[1]) - p_from, end - start)
    s_size = np.where(moved, np.where(spm, at[0], at[2]) - s_from, 0)
    m_size = end - m_from
    for part in (p_size, s_size, m_size):
        part[broken] = 0
    out_bounds = np.concatenate([[0], np.cumsum(p_size + m_size + s_size)])
    to = np.stack([out_bounds[:-1], out_bounds[:-1] + p_size, out_bounds[:-1] + p_size + m_size], axis=1)
    source = np.stack([p_from, m_from, s_from], axis=1)
    return data[displaced(int(out_bounds[-1]), to.ravel(), (source - to).ravel())], out_bounds, broken


def _strings(data: np.ndarray, bounds: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    """Arrow strings over flat bytes."""
    column = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data))
    column = column.cast(pa.string())
    return column if missing is None else pa.compute.if_else(pa.array(missing), pa.scalar(None, pa.string()), column)


FORMS = np.array([PLAIN, PSM, SPM], dtype=object)


def transform(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars and the output of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn = [batch.column(2 + k).to_numpy() for k in range(4)]
            for first, end, data, bounds in text_slices(batch.column(1)):
                one, two, three, four = (d[first:end] for d in drawn)
                n, low, high = line_cuts(data, bounds, one, two)
                plain = (np.diff(bounds) == 0) | (three % 100 >= recipe.rate)
                for tag in recipe.tags:
                    plain[occurrences(data, bounds, tag)[1]] = True
                form = np.where(plain, 0, np.where(four % 100 < recipe.spm, 2, 1))
                out, out_bounds = rearrange(data, bounds, low, high, form, recipe)
                before = characters(data)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first),
                        pa.array(n, pa.int64()),
                        pa.array(FORMS[form], pa.string()),
                        pa.array(before[low] - before[bounds[:-1]], pa.int64(), mask=plain),
                        pa.array(before[high] - before[low], pa.int64(), mask=plain),
                        _strings(out, out_bounds),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    rows = rows.select("doc_id", "text", *draws(recipe.seed, F.col("doc_id")))
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(outputs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """The frame with the text (restored) that every output was made of, from columns output and form alone."""
    names = [*outputs.columns, "restored"]
    at, kind = outputs.columns.index("output"), outputs.columns.index("form")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = batch.column(kind).to_numpy(zero_copy_only=False)
            form = np.where(named == SPM, 2, np.where(named == PSM, 1, 0))
            for first, end, data, bounds in text_slices(batch.column(at)):
                text, text_bounds, broken = put_back(data, bounds, form[first:end], recipe)
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*part.columns, _strings(text, text_bounds, broken)], names=names)

    return outputs.mapInArrow(run, outputs.withColumn("restored", F.lit(None).cast("string")).schema)
