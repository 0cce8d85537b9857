"""Quality rules: a calibrated logistic regression on hashed word and character n-grams.

Features of a text are the shares of hashed character n-grams (four UTF-8 bytes inside a line), hashed words and hashed
word pairs, one block of buckets for each. The weights are fitted on labelled rows by full-batch gradient steps with
per-weight rates, the probabilities are calibrated on rows held out from the fit (a logistic curve over the raw scores),
and all documents are scored in Arrow batches against a fixed threshold. Counts of the base rules come from the same flat
byte arrays.

The fit reads at most about `max_labelled` labelled rows, a sample by hash of doc_id; that bound is what keeps the model
small. Scoring, counts and rules read every text whole.

Defined cases: null text is the empty text (no words, so base_failed); labels that are null, or whose document is missing,
are not used; with labels of one class only (or none) every document gets that class (or probability 1); a doc_id that
repeats is scored once for each row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import BYTE_CODES, chain, mix, span_hashes, text_slices, word_bounds

#: Buckets of each of the three feature blocks.
BUCKETS = 1 << 15
SCALE = 16.0
#: Base rules of the contract.
MIN_WORDS, WINDOW, REPEAT_PERCENT = 20, 8, 30
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
#: Documents below this probability of being good are rejected.
THRESHOLD = 0.5


@dataclasses.dataclass
class Model:
    """Weights of the three blocks, their bias, and the calibration of the raw score."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.offset, -40, 40)))


def features(data: np.ndarray, bounds: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray):
    """(bucket, row) of every n-gram of each block, and the number of n-grams in each row."""
    rows = len(bounds) - 1
    blocks = []
    count = len(data) - 3
    if count > 0:
        codes = BYTE_CODES[data]
        grams = codes[:count] + codes[1: count + 1] * np.uint64(3) + codes[2: count + 2] * np.uint64(5) + codes[3:] * np.uint64(7)
        bucket = (grams >> np.uint64(64 - 15)).astype(np.int32)
        row = np.repeat(np.arange(rows, dtype=np.int32), np.diff(bounds))[:count]
        last = np.repeat(bounds[1:], np.diff(bounds))[:count]
        inside = np.arange(count) + 4 <= last
        blocks.append((bucket[inside], row[inside]))
    else:
        blocks.append((np.zeros(0, np.int32), np.zeros(0, np.int32)))
    row = np.searchsorted(bounds, starts, side="right").astype(np.int32) - 1
    blocks.append(((words >> np.uint64(64 - 15)).astype(np.int32) + BUCKETS, row))
    pairs = chain(words, 2)
    same = row[1:] == row[:-1]
    blocks.append(((pairs[same] >> np.uint64(64 - 15)).astype(np.int32) + 2 * BUCKETS, row[:-1][same]))
    return [(bucket, row, np.bincount(row, minlength=rows)) for bucket, row in blocks]


def base_counts(data: np.ndarray, bounds: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of the base rules for every row."""
    rows = len(bounds) - 1
    row = np.searchsorted(bounds, starts, side="right") - 1
    out = {"n_words": np.bincount(row, minlength=rows)}
    # code points in words: bytes that do not continue a character, between word bounds
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    out["word_chars"] = np.bincount(row, leads[ends] - leads[starts], minlength=rows).astype(np.int64)
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    out["n_symbols"] = symbols[bounds[1:]] - symbols[bounds[:-1]]

    # lines: cut at \n and at row bounds; those without a word do not count
    breaks = np.flatnonzero(data == 10)
    line_start = np.union1d(bounds[:-1][np.diff(bounds) > 0], breaks + 1)
    line_start = line_start[line_start < len(data)]
    line_end = np.append(line_start[1:], len(data))
    line_end = line_end - ((line_end > line_start) & (data[np.maximum(line_end - 1, 0)] == 10)) if len(line_end) else line_end
    has_word = np.diff(np.searchsorted(starts, np.append(line_start, len(data)))) > 0
    line_start, line_end = line_start[has_word], line_end[has_word]
    line_row = np.searchsorted(bounds, line_start, side="right") - 1
    keys = mix(span_hashes(data, line_start, line_end) + line_row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(keys, return_index=True)
    out["n_dup_lines"] = np.bincount(line_row, minlength=rows) - np.bincount(line_row[first], minlength=rows)

    # words covered by a window of eight that occurs twice or more in its row
    windows = chain(words, WINDOW)
    covered = np.zeros(len(words) + 1, np.int64)
    if len(windows):
        at = np.flatnonzero(row[WINDOW - 1:] == row[: len(windows)])
        keys = mix(windows[at] + row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(at), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = at[twice]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + WINDOW, -1)
    out["n_repeat_words"] = np.bincount(row, np.cumsum(covered[:-1]) > 0, minlength=rows).astype(np.int64)
    return out


def raw_scores(blocks, weights: np.ndarray, bias: float, rows: int) -> np.ndarray:
    score = np.full(rows, float(bias))
    for bucket, row, counts in blocks:
        score += SCALE * np.bincount(row, weights[bucket], minlength=rows) / np.maximum(counts, 1)
    return score


def labelled_features(docs: DataFrame, labels: DataFrame, max_labelled: int, seed: int = 11) -> DataFrame:
    """Sparse feature shares of a hash sample of the labelled documents: label, held (out of the fit), buckets, shares."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    share = min(1.0, max_labelled / max(1, known.count()))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    known = known.where(draw < share)
    rows = docs.select("doc_id", "text").join(known, "doc_id").select(
        "label", (F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(4)) == 0).alias("held"), "text"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in text_slices(batch.column(2)):
                starts, ends = word_bounds(data, bounds)
                blocks = features(data, bounds, starts, ends, span_hashes(data, starts, ends))
                buckets = [[] for _ in range(end - first)]
                shares = [[] for _ in range(end - first)]
                for bucket, row, counts in blocks:
                    keys, times = np.unique(row.astype(np.int64) * (4 * BUCKETS) + bucket, return_counts=True)
                    owner = keys // (4 * BUCKETS)
                    cut = np.searchsorted(owner, np.arange(end - first + 1))
                    share_ = SCALE * times / counts[owner]
                    for n in range(end - first):
                        buckets[n].append((keys[cut[n]: cut[n + 1]] % (4 * BUCKETS)).astype(np.int32))
                        shares[n].append(share_[cut[n]: cut[n + 1]].astype(np.float32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first),
                        batch.column(1).slice(first, end - first),
                        pa.array([np.concatenate(b) for b in buckets], pa.list_(pa.int32())),
                        pa.array([np.concatenate(s) for s in shares], pa.list_(pa.float32())),
                    ],
                    names=["label", "held", "buckets", "shares"],
                )

    return rows.mapInArrow(run, "label int, held boolean, buckets array<int>, shares array<float>")


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 3000, steps: int = 200) -> Model:
    """Fit on a bounded sample, calibrate on the quarter of it held out."""
    sample = labelled_features(docs, labels, max_labelled).toArrow()  # about max_labelled rows
    label = sample["label"].to_numpy().astype(float)
    weights = np.zeros(3 * BUCKETS)
    if not len(label) or label.min() == label.max():
        return Model(weights, 0.0, 0.0, 40.0 if not len(label) or label[0] else -40.0)
    lists = sample["buckets"].combine_chunks()
    counts = np.diff(lists.offsets.to_numpy())
    bucket = lists.values.to_numpy()
    share = sample["shares"].combine_chunks().values.to_numpy()
    row = np.repeat(np.arange(len(label), dtype=np.int32), counts)
    held = sample["held"].to_numpy(zero_copy_only=False).astype(bool)
    if held.all() or len(set(label[~held])) < 2 or len(set(label[held])) < 2:
        held = np.zeros(len(label), dtype=bool)
    of_fit = ~held[row]
    x_bucket, x_row, x_share = bucket[of_fit], row[of_fit], share[of_fit]
    del lists
    # both classes weigh the same, so a rare class is not ignored
    class_weight = np.where(label > 0, 0.5 / label[~held].mean(), 0.5 / (1 - label[~held].mean())) * ~held
    class_weight /= class_weight.sum()
    bias, seen, seen_bias = 0.0, np.full(len(weights), 1e-8), 1e-8
    for _ in range(steps):
        raw = np.bincount(x_row, weights[x_bucket] * x_share, minlength=len(label)) + bias
        off = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - label) * class_weight
        slope = np.bincount(x_bucket, off[x_row] * x_share, minlength=len(weights)) + 1e-5 * weights
        seen += slope**2
        weights -= 0.3 * slope / np.sqrt(seen)
        seen_bias += off.sum() ** 2
        bias -= 0.3 * off.sum() / np.sqrt(seen_bias)
    raw = np.bincount(row, weights[bucket] * share, minlength=len(label)) + bias
    use = held if held.any() else ~held
    slope, offset = calibrate(raw[use], label[use])
    return Model(weights, bias, slope, offset)


def calibrate(raw: np.ndarray, label: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and offset of the logistic curve of the held-out rows (Newton steps; targets kept off 0 and 1)."""
    good, bad = label.sum(), len(label) - label.sum()
    target = np.where(label > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -40, 40)))
        off, w = p - target, np.maximum(p * (1 - p), 1e-9)
        g = np.array([(off * raw).sum(), off.sum()]) + np.array([1e-6 * a, 0])
        h = np.array([[(w * raw * raw).sum() + 1e-6, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1e-6]])
        move = np.linalg.solve(h, g)
        move *= min(1.0, 2 / max(1e-12, float(np.abs(move).max())))
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-8:
            break
    return max(float(a), 0.0), float(b)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judged(column: pa.Array, model: Model, threshold: float) -> Iterator[tuple[int, int, dict[str, np.ndarray]]]:
    """(first row, end row, counts and verdicts) of the texts, slice by slice."""
    for first, end, data, bounds in text_slices(column):
        starts, ends = word_bounds(data, bounds)
        words = span_hashes(data, starts, ends)
        out = base_counts(data, bounds, starts, ends, words)
        blocks = features(data, bounds, starts, ends, words)
        out["probability"] = model.probability(raw_scores(blocks, model.weights, model.bias, end - first))
        out["base_failed"] = (out["n_words"] < MIN_WORDS) | (
            100 * out["n_repeat_words"] > REPEAT_PERCENT * out["n_words"]
        )
        out["kept"] = ~out["base_failed"] & (out["probability"] >= threshold)
        yield first, end, out


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the calibrated probability of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # three blocks of BUCKETS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, out in judged(batch.column(1), shared.value, threshold):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first),
                        *(pa.array(out[name].astype(np.int64)) for name in COUNTS),
                        *(pa.array(out[name]) for name in ("base_failed", "kept", "probability")),
                    ],
                    names=["doc_id", *COUNTS, "base_failed", "kept", "probability"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    schema = "doc_id long, " + ", ".join(f"{name} long" for name in COUNTS)
    return rows.mapInArrow(run, schema + ", base_failed boolean, kept boolean, probability double")


def kept_rows(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, out in judged(batch.column(at), shared.value, threshold):
                yield batch.slice(first, end - first).filter(pa.array(out["kept"]))

    return docs.mapInArrow(run, docs.schema)
