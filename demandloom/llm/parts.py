"""Packed columns, and results that go back to the texts of one stretch of an input file.

A pass over documents can send a few bytes per text to other tasks and get an answer back without shuffling the texts:
answers are stored in the shared folder by the block of PART_ROWS rows of a file that the text is read from ("part"), and
the task that reads the block again looks up its own. Neither the tasks that store answers nor the tables that a worker
loads grow with the size of a file.
"""

from __future__ import annotations

import contextlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import emptied_by, new_path, staged, text_slices

NULL_ID = -(2**63)
#: Rows of a file that share a part.
PART_ROWS = 16_384


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as base and narrow differences."""
    if not len(values):
        return b""
    base = int(values.min())
    span = int(values.max()) - base
    width = next(w for w in (1, 2, 4, 8) if span < 1 << (8 * w))
    if width == 8:
        return bytes([8]) + values.astype("<i8").tobytes()
    return bytes([width]) + base.to_bytes(8, "little", signed=True) + (values - base).astype(f"<u{width}").tobytes()


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    if data[0] == 8:
        return np.frombuffer(data, "<i8", offset=1)
    return np.frombuffer(data, f"<u{data[0]}", offset=9).astype(np.int64) + int.from_bytes(data[1:9], "little", signed=True)


def planes(values: np.ndarray) -> bytes:
    """Whole numbers (signed or not) as the least one and the bytes of the differences, one plane of bytes after another."""
    if not len(values):
        return b""
    least = values.min()
    rest = values.astype("<i8", copy=False).view("<u8") - np.asarray(least).astype("<i8").view("<u8")
    width = (int(rest.max()).bit_length() + 7) // 8
    flat = rest.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + np.asarray(least).astype("<i8").tobytes() + np.ascontiguousarray(flat).tobytes()


def unplanes(data: bytes, count: int, first: int = 0, end: int | None = None) -> np.ndarray:
    """Entries first to end of `count` signed numbers in planes."""
    end = count if end is None else end
    if end <= first:
        return np.zeros(0, np.int64)
    width = data[0]
    flat = np.zeros((end - first, 8), np.uint8)
    if width:
        flat[:, :width] = np.frombuffer(data, np.uint8, offset=9).reshape(width, count)[:, first:end].T
    return (flat.view("<u8").ravel() + np.frombuffer(data, "<u8", 1, 1)).view("<i8")


def hashes_of(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u8")


def cuts_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bounds of the buckets in ascending hashes."""
    edges = (np.arange(1, buckets, dtype=np.uint64) * np.uint64((1 << 63) // buckets)) << np.uint64(1)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])


def located(docs: DataFrame) -> DataFrame:
    """The frame with the block of its file (_part) and the place in the file (_row) of every row; a frame not read from files is written first."""
    place = F.col("_metadata.row_index")
    part = F.xxhash64("_metadata.file_path", F.floor(place / PART_ROWS)).alias("_part")
    row = place.alias("_row")
    if docs.inputFiles():
        with contextlib.suppress(AnalysisException):
            return docs.select("*", part, row)
    return staged(docs, "part-docs").select("*", part, row)


def with_part(docs: DataFrame) -> DataFrame:
    """id, text, part and row of every document."""
    if "_part" not in docs.columns:
        docs = located(docs.select("doc_id", "text"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("_part").alias("part"), F.col("_row").alias("row"))


def stored_by_part(rows: DataFrame, name: str) -> str:
    """Write rows in one folder for each part, in the shared folder."""
    path = new_path(rows.sparkSession, name)
    rows.repartition("part").write.partitionBy("part").parquet(path)
    return path


_PARTS: OrderedDict[tuple[str, int], pa.Table | None] = OrderedDict()
emptied_by(_PARTS.clear)


def part_table(path: str, part: int, columns: list[str]) -> pa.Table | None:
    """The stored rows of a part; a worker keeps the last few."""
    key = (path, part)
    if key not in _PARTS:
        store, folder = fs.FileSystem.from_uri(path)
        place = f"{folder}/part={part}"
        table = None
        if store.get_file_info(place).type == fs.FileType.Directory:
            files = [f.path for f in store.get_file_info(fs.FileSelector(place)) if f.path.endswith(".parquet")]
            tables = []
            for file in files:
                with store.open_input_file(file) as opened:
                    tables.append(pq.ParquetFile(opened).read(columns=columns))
            table = pa.concat_tables(tables) if tables else None
        _PARTS[key] = table
        while len(_PARTS) > 2:
            _PARTS.popitem(last=False)
    return _PARTS[key]


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(part, ids, bytes, bounds) of stretches of rows of one part."""
    for part, _, ids, data, bounds in placed_slices(batches):
        yield part, ids, data, bounds


def placed_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(part, rows in it, ids, bytes, bounds) of stretches of rows of one part."""
    for batch in batches:
        part, row = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        ids = batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else []
        for first, end in zip(edges[:-1], edges[1:], strict=True):
            for a, b, data, bounds in text_slices(batch.column(1).slice(first, end - first)):
                yield int(part[first]), row[first + a: first + b], ids[first + a: first + b], data, bounds
