"""SentencePiece encoding and decoding in vectorised merge rounds.

The text is cut into stretches that no vocabulary piece can cross: at blanks, and between any two characters that are
neighbours in no piece. Each round finds the best pair rank of every stretch with one segmented minimum, merges the
leftmost non-overlapping occurrences of it in all stretches at once and compacts the flat arrays, until no pair is left.
That equals merging one pair at a time, best score first and leftmost among equals, because a longer piece normally
scores worse than its parts; for the few pieces where that fails ("unsafe") only one occurrence is merged in a round.

Blank-separated words repeat, so their ids are kept in a bounded store of the worker and only new words are merged.

Defined cases: null text is the empty text, whose ids are begin and end only; texts of any length are encoded whole; an
empty table gives an empty result; repeated rows are encoded like others; further columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import emptied_by, entered, ranges

BLANK = "▁"
_LED = re.compile(BLANK + "+[^" + BLANK + "]*")
#: Bytes that the words kept by a worker may take, about, before its store is emptied, and of a word besides its text.
KEPT_BYTES, WORD_BYTES = 32 << 20, 130
#: Characters of new words that are merged in one step, characters and rows of texts encoded in one.
MERGED_CHARS, RUN_CHARS, RUN_ROWS = 1 << 18, 1 << 20, 1024


class KeyTable:
    """Positions of known 64-bit keys by open addressing: a few gathers for each key asked."""

    def __init__(self, keys: np.ndarray):
        bits = max(8, int(len(keys) * 8).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.at = np.full(1 << bits, -1, np.int64)
        open_, self.probes = np.arange(len(keys)), 0
        while len(open_):
            slot = self._slots(keys[open_], self.probes)
            slot, first = np.unique(np.where(self.keys[slot] < 0, slot, -1), return_index=True)
            taken = open_[first[slot >= 0]]
            slot = slot[slot >= 0]
            self.keys[slot], self.at[slot] = keys[taken], taken
            open_ = np.setdiff1d(open_, taken)
            self.probes += 1

    def _slots(self, keys: np.ndarray, probe: int) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((spread >> self.shift).astype(np.int64) + probe) & self.mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 where unknown."""
        slot = self._slots(keys, 0)
        out = np.where(self.keys[slot] == keys, self.at[slot], -1)
        open_ = np.flatnonzero((out < 0) & (self.keys[slot] >= 0))
        for probe in range(1, self.probes):
            if not len(open_):
                break
            slot = self._slots(keys[open_], probe)
            hit = self.keys[slot] == keys[open_]
            out[open_[hit]] = self.at[slot[hit]]
            open_ = open_[~hit & (self.keys[slot] >= 0)]
        return out


class PieceModel:
    """Vocabulary, pair ranks and byte pieces of a SentencePiece BPE model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec, trainer = model.normalizer_spec, model.trainer_spec
        kinds = {p.type for p in model.pieces}
        if (
            trainer.model_type != proto.TrainerSpec.BPE
            or not trainer.byte_fallback
            or not spec.escape_whitespaces
            or not spec.add_dummy_prefix
            or spec.remove_extra_whitespaces
            or spec.precompiled_charsmap
            or trainer.treat_whitespace_as_suffix
            or kinds - {1, 2, 3, 6}
        ):
            raise ValueError("only BPE models with byte fallback, a leading blank and an identity normalizer are supported")
        self.begin, self.end, self.unknown = trainer.bos_id, trainer.eos_id, trainer.unk_id
        pieces = [(n, p.piece, p.score) for n, p in enumerate(model.pieces) if p.type == 1]
        self.size = len(model.pieces)
        self.byte_ids = np.zeros(256, np.int64)
        self.surface = [b""] * self.size
        self.is_byte = np.zeros(self.size, dtype=bool)
        for n, p in enumerate(model.pieces):
            if p.type == 6:
                self.byte_ids[int(p.piece[1:-1], 16)] = n
                self.surface[n] = bytes([int(p.piece[1:-1], 16)])
                self.is_byte[n] = True
            elif p.type == 1:
                self.surface[n] = p.piece.replace(BLANK, " ").encode()
            elif p.type == 2:
                self.surface[n] = trainer.unk_surface.encode()

        ids = {text: n for n, text, _ in pieces}
        scores = {n: score for n, _, score in pieces}
        ordered = sorted({score for score in scores.values()}, reverse=True)
        rank = {score: k for k, score in enumerate(ordered)}
        self.chars = np.full(0x110000, -1, np.int64)
        pairs, near = {}, set()
        unsafe = set()
        for n, text, score in pieces:
            if len(text) == 1:
                self.chars[ord(text)] = n
            for k in range(1, len(text)):
                near.add((text[k - 1], text[k]))
                left, right = ids.get(text[:k]), ids.get(text[k:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = (rank[score], n)
                for part in (left, right):
                    # a piece that can turn into one of equal or better score at once
                    if part is not None and scores[part] <= score and len(model.pieces[part].piece) > 1:
                        unsafe.add(part)
        keys = sorted(pairs)
        self.none = len(ordered)
        self.pairs = KeyTable(np.array(keys, dtype=np.int64))
        self.pair_ranks = np.array([*(pairs[k][0] for k in keys), self.none], dtype=np.int64)
        self.pair_ids = np.array([*(pairs[k][1] for k in keys), -1], dtype=np.int64)
        self.unsafe = np.zeros(self.none + 1, dtype=bool)
        self.unsafe[[rank[scores[n]] for n in unsafe]] = True
        self.near = KeyTable(np.array(sorted((ord(a) << 21) | ord(b) for a, b in near), dtype=np.int64))

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of neighbouring symbols; rank `none` where no piece joins them."""
        at = self.pairs.find(np.where((left >= 0) & (right >= 0), left * self.size + right, self.size * self.size))
        return self.pair_ranks[at], self.pair_ids[at]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the words and the number of ids of each."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.chars[codes]
        symbols[symbols < 0] = -1 - codes[symbols < 0]  # a character without a piece, spelled in bytes at the end
        cut = np.zeros(len(codes) + 1, dtype=bool)
        cut[np.cumsum(lengths) - lengths] = True
        cut[-1] = True
        cut[1:-1] |= self.near.find((codes[:-1] << 21) | codes[1:]) < 0
        stretch = np.cumsum(cut[:-1]) - 1
        ids, place = self._rounds(symbols, stretch)
        # spell unknown characters in bytes
        word_of_stretch = np.repeat(np.arange(len(words)), lengths)[np.flatnonzero(cut[:-1])] if len(codes) else place
        word = word_of_stretch[place] if len(place) else place
        odd = np.flatnonzero(ids < 0)
        if len(odd):
            spelled = [chr(-1 - c).encode("utf-8", "surrogatepass") for c in ids[odd].tolist()]
            counts = np.ones(len(ids), np.int64)
            counts[odd] = [len(s) for s in spelled]
            begin = np.cumsum(counts) - counts
            out = np.repeat(ids, counts)
            out[ranges(begin[odd], counts[odd])] = self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
            ids, word = out, np.repeat(word, counts)
        return ids, np.bincount(word, minlength=len(words)).astype(np.int64)

    def _rounds(self, symbols: np.ndarray, stretch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge all stretches to the end; their symbols in order, and the stretch of each."""
        done_ids, done_at, done_stretch = [], [], []
        at = np.arange(len(symbols))  # first character of each symbol keeps the order
        rank = np.full(len(symbols), self.none, np.int64)
        merged = np.zeros(len(symbols), np.int64)
        if len(symbols) > 1:
            rank[:-1], merged[:-1] = self._pairs(symbols[:-1], symbols[1:])
            rank[:-1][stretch[1:] != stretch[:-1]] = self.none
        while len(symbols):
            first = np.flatnonzero(np.r_[True, stretch[1:] != stretch[:-1]])
            counts = np.diff(np.r_[first, len(symbols)])
            best = np.minimum.reduceat(rank, first)
            over = np.repeat(best == self.none, counts)
            if over.any():  # finished stretches leave the arrays
                done_ids.append(symbols[over])
                done_at.append(at[over])
                done_stretch.append(stretch[over])
                keep = ~over
                symbols, stretch, at, rank, merged = symbols[keep], stretch[keep], at[keep], rank[keep], merged[keep]
                if not len(symbols):
                    break
                live = best != self.none
                counts, best = counts[live], best[live]
                first = np.cumsum(counts) - counts
            hit = rank == np.repeat(best, counts)
            index = np.flatnonzero(hit)
            fresh = np.r_[True, np.diff(index) != 1]
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(index)), 0))
            index = index[(np.arange(len(index)) - run) % 2 == 0]
            single = self.unsafe[rank[index]]
            if single.any():
                leader = np.r_[True, stretch[index][1:] != stretch[index][:-1]]
                index = index[~single | leader]
            symbols[index] = merged[index]
            keep = np.ones(len(symbols), dtype=bool)
            keep[index + 1] = False
            changed = (np.cumsum(keep) - 1)[index]
            symbols, stretch, at, rank, merged = symbols[keep], stretch[keep], at[keep], rank[keep], merged[keep]
            for touched in (changed, changed[changed > 0] - 1):
                right = np.minimum(touched + 1, len(symbols) - 1)
                new_rank, new_id = self._pairs(symbols[touched], symbols[right])
                new_rank[(right == touched) | (stretch[right] != stretch[touched])] = self.none
                rank[touched], merged[touched] = new_rank, new_id
        if not done_ids:
            return symbols, stretch
        at = np.concatenate(done_at)
        order = np.argsort(at, kind="stable")
        return np.concatenate(done_ids)[order], np.concatenate(done_stretch)[order]


class PieceCoder:
    """Encoder and decoder of a worker, with its store of words."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.flat = np.zeros(1 << 16, np.int32)
        self.bounds = np.zeros(1 << 12, np.int64)

    def _learn(self, keys: list[str]) -> None:
        ids, counts = self.model.merge([BLANK + key for key in keys])
        have, filled = len(self.known), int(self.bounds[len(self.known)])
        while len(self.flat) < filled + len(ids):
            self.flat = np.r_[self.flat, np.zeros(len(self.flat), np.int32)]
        while len(self.bounds) < have + len(keys) + 1:
            self.bounds = np.r_[self.bounds, np.zeros(len(self.bounds), np.int64)]
        self.flat[filled: filled + len(ids)] = ids
        self.bounds[have + 1: have + len(keys) + 1] = filled + np.cumsum(counts)
        self.known.update(zip(keys, range(have, have + len(keys)), strict=True))

    @staticmethod
    def keys(text: str) -> list[str]:
        """The blank-led stretches of a text with its leading blank, each without its first blank."""
        if not text:
            return []
        if BLANK not in text and "  " not in text and text[0] != " ":
            return text.split(" ")
        return [word[1:] for word in _LED.findall(BLANK + text.replace(" ", BLANK))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text as the library gives them, with begin and end."""
        split = [self.keys(text) for text in texts]
        if self.held > KEPT_BYTES:
            self._clear()
        fresh = list(set().union(*split) - self.known.keys())
        size = np.cumsum([len(key) for key in fresh]) if fresh else np.zeros(0, np.int64)
        first = 0
        while first < len(fresh):
            end = int(np.searchsorted(size, (size[first - 1] if first else 0) + MERGED_CHARS)) + 1
            self._learn(fresh[first:end])
            first = end
        self.held += sum(map(len, fresh)) + WORD_BYTES * len(fresh)
        out = []
        for keys in split:
            index = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))
            starts = self.bounds[index]
            counts = self.bounds[index + 1] - starts
            ids = np.empty(int(counts.sum()) + 2, np.int32)
            ids[0], ids[-1] = self.model.begin, self.model.end
            ids[1:-1] = self.flat[ranges(starts, counts)]
            out.append(ids)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids, as the library gives it."""
        model = self.model
        ids = np.asarray(ids)
        control = np.flatnonzero((ids == model.begin) | (ids == model.end))
        # control ids print nothing but keep the bytes around them apart
        parts = np.split(ids, control)
        parts = [part[1:] if k or len(control) and control[0] == 0 else part for k, part in enumerate(parts)]
        parts = [part for part in parts if len(part)]
        out = []
        for n, part in enumerate(parts):
            raw = b"".join(map(model.surface.__getitem__, part.tolist()))
            if not n and raw[:1] == b" " and not model.is_byte[part[0]] and part[0] != model.unknown:
                raw = raw[1:]  # the blank that encoding put before the text
            try:
                out.append(raw.decode("utf-8"))
            except UnicodeDecodeError:
                out.append(_bytewise(raw))
        return "".join(out)


def _bytewise(raw: bytes) -> str:
    """UTF-8 with one replacement mark for every byte that belongs to no character."""
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at: at + size].decode("utf-8"))
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_CODERS: dict[str, PieceCoder] = {}
emptied_by(_CODERS.clear)


def coder(path: str) -> PieceCoder:
    """The worker's coder for a model file."""
    if path not in _CODERS:
        _CODERS[path] = PieceCoder(path)
    return _CODERS[path]


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, the ids of the whole text with begin and end, and the text decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entered("pieces")
        piece = coder(model_path)
        for batch, texts in text_runs(batches, RUN_CHARS, rows=RUN_ROWS):
            ids = piece.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x.tolist() for x in ids], pa.list_(pa.int32())),
                    pa.array([piece.decode(x) for x in ids], pa.string()),
                ],
                names=["doc_id", "ids", "decoded"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: the digests of `encode_documents`, made where the ids are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entered("pieces")
        piece = coder(model_path)
        for batch, texts in text_runs(batches, RUN_CHARS, rows=RUN_ROWS):
            ids = piece.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(piece.decode(x).encode("utf-8")).hexdigest() for x in ids], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def text_runs(
    batches: Iterator[pa.RecordBatch], most: int = 4 << 20, at: int = 1, rows: int | None = None
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Stretches of rows, with their texts in column `at`, of about `most` characters and at most `rows` rows.

    Memory follows the longest text, not the batch.
    """
    for whole in batches:
        step = rows or max(whole.num_rows, 1)
        for batch in (whole.slice(begin, step) for begin in range(0, whole.num_rows, step)):
            texts = [text or "" for text in batch.column(at).to_pylist()]
            first, size = 0, 0
            for n, text in enumerate(texts):
                size += len(text)
                if size >= most or n == len(texts) - 1:
                    yield batch.slice(first, n + 1 - first), texts[first: n + 1]
                    first, size = n + 1, 0
