"""Helpers shared by the operators: tables, staging in the shared folder, flat views of Arrow text."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of spans hashed in one NumPy step.
HASHED_BYTES = 1 << 20
#: Text bytes handled by one NumPy step; longer batches are cut between documents.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see; a temporary one only where a local session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Write the frame as a table in the shared folder and read it back, which cuts its lineage."""
    path = new_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def drop_staged(frame: DataFrame) -> None:
    """Delete the files of a staged frame that no later plan reads."""
    spark = frame.sparkSession
    jvm = spark.sparkContext._jvm
    folders = {path.rsplit("/", 1)[0] for path in frame.inputFiles()}
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_STORES: list[Callable[[], object]] = []
_SERVED = [""]


def emptied_by(clear: Callable[[], object]) -> None:
    """Register how a store that workers keep between tasks is emptied."""
    _STORES.append(clear)


def entered(operator: str) -> None:
    """Called as a task begins: a reused worker that served another operator empties its stores and gives memory back."""
    if _SERVED[0] == operator:
        return
    _SERVED[0] = operator
    for clear in _STORES:
        clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of Linux keeps freed memory otherwise
    if trim:
        trim(0)


def large_text(column: pa.Array) -> pa.Array:
    """The column as large strings without nulls (null counts as empty)."""
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row bounds) of stretches of about `most` bytes; a longer text stands alone.

    The bytes are a view of the Arrow buffer; the bounds have one entry more than rows.
    """
    column = large_text(column)
    rows = len(column)
    if not rows:
        return
    _, bounds_buffer, data_buffer = column.buffers()
    bounds = np.frombuffer(bounds_buffer, dtype=np.int64, count=column.offset + rows + 1)[column.offset:]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None and data_buffer.size else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        end = int(np.searchsorted(bounds, bounds[first] + most, side="right")) - 1
        end = min(max(end, first + 1), rows)
        yield first, end, data[bounds[first]: bounds[end]], bounds[first: end + 1] - bounds[first]
        first = end


def is_space() -> np.ndarray:
    """Lookup of the six separators of words: space and 0x09 to 0x0D."""
    look = np.zeros(256, dtype=bool)
    look[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return look


SPACE = is_space()


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word; words do not cross rows."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each of the byte spans; equal spans hash equally everywhere.

    Every eight bytes of a span are mixed with their place before they are added up, so that no arrangement of the same
    bytes cancels out as it would in a polynomial.
    """
    lengths = ends - starts
    blocks = (lengths + 7) >> 3
    total = int(blocks.sum())
    if 8 * total > 2 * HASHED_BYTES and len(starts) > 1:  # spans may overlap, so their bytes may be many more than the data's
        half = min(max(int(np.searchsorted(np.cumsum(blocks), total // 2)), 1), len(starts) - 1)
        parts = [span_hashes(data, starts[:half], ends[:half]), span_hashes(data, starts[half:], ends[half:])]
        return np.concatenate(parts)
    if not len(starts):
        return np.zeros(0, np.uint64)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each byte on
    begin = np.cumsum(blocks) - blocks
    within = np.arange(total, dtype=np.int64) - np.repeat(begin, blocks)
    words = eights[np.repeat(starts, blocks) + 8 * within]
    full = np.flatnonzero(lengths > 0)
    last = begin[full] + blocks[full] - 1
    words[last] &= ~np.uint64(0) >> ((-lengths[full] & 7) * 8).astype(np.uint64)  # bytes behind the span
    words = mix(words ^ mix((within + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    sums = np.zeros(len(starts), np.uint64)
    if total:
        sums[full] = np.add.reduceat(words, begin[full])
    return mix(sums + mix(lengths.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)))


def chain(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` consecutive entries, len - width + 1 of them."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k: k + count])
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of arange(start, start + length) for every pair."""
    total = int(lengths.sum())
    begin = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - begin, lengths)


def batches_of(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Non-empty batches only."""
    return (batch for batch in rows if batch.num_rows)
