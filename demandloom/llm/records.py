"""Token ids as length-delimited binary records.

A data file is a row of frames: 8 bytes length, 4 bytes masked checksum of the length, the payload, 4 bytes masked
checksum of the payload (all little-endian; CRC-32, rotated right by 15 bits plus a constant, so a checksum stored in
checked data does not check itself). A payload is the document's ids as unsigned integers, 2 bytes wide where the
vocabulary fits and 4 otherwise. Beside each data file stands an offset index, one (doc_id, start of the frame, number of
ids) per record, so a reader can fetch records in any order. Files follow ascending doc_id.

A task writes its file under a name of its own attempt and renames it, so lost or repeated tasks leave the same files.

Defined cases: null text is empty and holds only the end id; a null doc_id sorts first and is kept by a flag in the index;
repeated rows are written one by one; an empty table gives no files and an empty result; a record of any length is written
whole; other columns of the input are not read. A broken length, payload or index raises ValueError.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm.common import ranges
from demandloom.llm.pieces import text_runs

MASK = 0xA282EAD8
INDEX = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("offset", "<u8"), ("ids", "<u8")])
#: The tokenizer's pattern, as its file states it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same pattern for lowered letters below U+0180: letters, numbers and white space of that range.
_LETTER, _NUMBER, _BLANK = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u017f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be", "\t-\r \u0085\u00a0"
CUT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_BLANK}{_LETTER}{_NUMBER}]+")
#: Letters whose lowering or composition is not simple, and the start of special tokens.
UNUSUAL = re.compile("[\u0130\u0180-\U0010ffff]|<\\|")
#: Distinct cuts kept by a worker before its store is emptied.
KEPT_WORDS = 1_200_000


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = len(payload).to_bytes(8, "little")
    return b"".join(
        (length, masked(length).to_bytes(4, "little"), payload, masked(payload).to_bytes(4, "little"))
    )


def unframe(data: memoryview, offset: int) -> tuple[memoryview, int]:
    """Payload of the frame at an offset, and the offset of the next."""
    length = bytes(data[offset: offset + 8])
    if len(length) < 8 or masked(length) != int.from_bytes(data[offset + 8: offset + 12], "little"):
        raise ValueError(f"broken length at byte {offset}")
    size = int.from_bytes(length, "little")
    payload = data[offset + 12: offset + 12 + size]
    end = offset + 16 + size
    if len(payload) < size or masked(payload) != int.from_bytes(data[end - 4: end], "little"):
        raise ValueError(f"broken payload at byte {offset}")
    return payload, end


class WordCoder:
    """Ids by the tokenizers library, with a bounded store for the pieces of text of a worker.

    The tokenizer lowers letters, drops white space and cuts the text by a pattern before it merges, so the ids of a text
    are those of its cuts in order, and every distinct cut is encoded once. Plain texts (letters below U+0180, where
    lowering and normalising are simple) are cut here by the tokenizer's own pattern; other texts, and texts that may
    name a special token, are cut at blanks only and the library does the rest.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.cuts = PATTERN in json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"][0]["pattern"].values()
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.bounds = np.zeros(1 << 12, np.int64)

    def keys(self, text: str) -> list[str]:
        if self.cuts and not UNUSUAL.search(text):
            return CUT.findall(text.lower())
        return text.replace("\n", " ").split(" ")

    def _learn(self, keys: list[str]) -> None:
        rows = [e.ids for e in self.tokenizer.encode_batch_fast(keys, add_special_tokens=False)]
        counts = np.fromiter(map(len, rows), np.int64, len(rows))
        ids = np.fromiter(itertools.chain.from_iterable(rows), np.uint32, int(counts.sum()))
        have, filled = len(self.known), int(self.bounds[len(self.known)])
        self.flat = _room(self.flat, filled + len(ids))
        self.bounds = _room(self.bounds, have + len(keys) + 1)
        self.flat[filled: filled + len(ids)] = ids
        self.bounds[have + 1: have + len(keys) + 1] = filled + np.cumsum(counts)
        self.known.update(zip(keys, range(have, have + len(keys)), strict=True))

    def encode(self, texts: Sequence[str], end_id: int) -> list[np.ndarray]:
        """Ids of every text, each with the end id."""
        split = [self.keys(text) for text in texts]
        if len(self.known) > KEPT_WORDS:
            self._clear()
        fresh = list(set().union(*split) - self.known.keys())
        for first in range(0, len(fresh), 50_000):
            self._learn(fresh[first: first + 50_000])
        out = []
        for keys in split:
            index = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))
            starts = self.bounds[index]
            counts = self.bounds[index + 1] - starts
            ids = np.empty(int(counts.sum()) + 1, np.uint32)
            ids[:-1] = self.flat[ranges(starts, counts)]
            ids[-1] = end_id
            out.append(ids)
        return out


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """The array, doubled until it has room."""
    while len(array) < size:
        array = np.concatenate([array, np.zeros_like(array)])
    return array


_CODERS: dict[str, WordCoder] = {}


def coder(path: str) -> WordCoder:
    if path not in _CODERS:
        _CODERS[path] = WordCoder(path)
    return _CODERS[path]


def write_records(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, files: int | None = None) -> DataFrame:
    """Write all documents; the manifest (file, data and index path, records, ids), one row per file, in order.

    `files` bounds the bytes of a file; by default the session's shuffle partitions. The documents are ranged by doc_id,
    repeated ids by a hash, and sorted inside a file.
    """
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(files, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = coder(tokenizer_path)
        part = TaskContext.get().partitionId()
        store, folder = fs.FileSystem.from_uri(path)
        name, attempt = f"{folder}/ids-{part:06d}", uuid.uuid4().hex
        index, offset, total = [], 0, 0
        out = None
        for batch, texts in text_runs(batches):
            if out is None:
                store.create_dir(folder, recursive=True)
                out = store.open_output_stream(f"{name}.{attempt}")
            frames = [frame(ids.astype(f"<u{words.width}").tobytes()) for ids in words.encode(texts, end_id)]
            out.write(b"".join(frames))
            for doc_id, framed in zip(batch.column(0).to_pylist(), frames, strict=True):
                count = (len(framed) - 16) // words.width
                index.append((doc_id or 0, doc_id is not None, offset, count))
                offset, total = offset + len(framed), total + count
        if out is None:
            return
        out.close()
        with store.open_output_stream(f"{name}.index.{attempt}") as file:
            file.write(np.array(index, dtype=INDEX).tobytes())
        store.move(f"{name}.{attempt}", f"{name}.records")
        store.move(f"{name}.index.{attempt}", f"{name}.index")
        names = [f"{path}/ids-{part:06d}.records", f"{path}/ids-{part:06d}.index"]
        yield pa.RecordBatch.from_pydict(
            {"file": pa.array([part], pa.int32()), "records": [names[0]], "index": [names[1]],
             "width": pa.array([words.width], pa.int32()), "documents": [len(index)], "ids": [total]}
        )

    return rows.mapInArrow(run, "file int, records string, index string, width int, documents long, ids long")


def fetch(records: str, index: str, width: int, wanted: Iterable[int] | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of the records at the index positions wanted, in that order; all in file order by default."""
    store, place = fs.FileSystem.from_uri(records)
    _, index_place = fs.FileSystem.from_uri(index)
    with store.open_input_file(index_place) as file:
        entries = np.frombuffer(file.read(), dtype=INDEX)
    with store.open_input_file(place) as file:
        for n in range(len(entries)) if wanted is None else wanted:
            entry = entries[n]
            size = int(entry["ids"]) * width
            data = memoryview(file.read_at(16 + size, int(entry["offset"])))
            payload, _ = unframe(data, 0)
            if len(payload) != size:
                raise ValueError(f"index and record {n} disagree")
            yield int(entry["doc_id"]) if entry["known"] else None, np.frombuffer(payload, dtype=f"<u{width}")


def read_records(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every record, read back from the files; one task per file."""
    spark: SparkSession = manifest.sparkSession
    files = manifest.orderBy("file").collect()  # one row per file
    starts, total = [], 0
    for row in files:
        starts.append((row["records"], row["index"], row["width"], total))
        total += row["ids"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not files:
        return spark.createDataFrame([], schema)
    plan = spark.createDataFrame(starts, "records string, index string, width int, start long").repartition(len(files))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                start, out = row["start"], []
                for doc_id, ids in fetch(row["records"], row["index"], row["width"]):
                    out.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, pa.int64()) for column in zip(*out, strict=True)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return plan.mapInArrow(run, schema)
