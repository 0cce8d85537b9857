"""Secret scans with structural confirmation.

Three patterns report assignments, access keys and hex runs as they stand. Beyond them, encoded candidates are decoded
and parsed before they are reported: signed tokens must have a JSON header that names an algorithm and a JSON payload;
key material (in armour or bare base64, base64url or hex of either case) must be a DER sequence whose nested lengths add
up exactly to the data, or the binary form of a key with length-prefixed fields that end where the data ends. Bare key
material may be wrapped: from a run that begins as a key does, lines are joined (over line ends, escaped ones as in JSON
or source strings, and quotes around them) up to the length that its own header states.

Spans count code points, ends are exclusive. Defined cases: null text is empty; texts of any length are scanned whole;
equal rows give equal results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.pieces import text_runs

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "jwt", "key")

# Fixed patterns of the base scan.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
_NAMES = re.compile(r"[Pp][Aa][Ss][Ss][Ww]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]")
#: A header is a JSON object, so its first base64 letters are e and one of w to z.
JWT = re.compile(r"(?<![A-Za-z0-9_-])(e[w-z][A-Za-z0-9_-]{6,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]+)(?![A-Za-z0-9_-])")
ARMOUR = re.compile(r"""-----BEGIN ([A-Z0-9 ]+)-----([A-Za-z0-9+/=\s\\"',]*)-----END \1-----""")
#: What armour holds besides base64: white space, escaped line ends, quotes of source strings, the backslash of an escaped slash.
_FILL = re.compile(r"""\\+[nrt]|[\s\\"',]""")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}={0,2}(?![A-Za-z0-9+/=])")
#: Magic of the length-prefixed private key form.
OPENSSH = b"openssh-key-v1\x00"
# Wrapped key material: its first letters (the DER tag 30 or the magic), and the line ends, real or escaped, in it.
_BREAK = r"""(?:["']?[ \t]{0,40}(?:[,+][ \t]{0,40})?(?:(?:\\+[nrt])++|\r?\n)[ \t]{0,40}["']?)++"""
_BREAKS = re.compile(_BREAK)
_ESCAPED = re.compile(r"\\[nrt]")


class Wrapped:
    """How one encoding of bare key material is written."""

    def __init__(self, alphabet: str, first: str, letters: str, least: int, bits: int):
        self.alphabet, self.least, self.bits = alphabet, least, bits
        self.first = re.compile(first)
        self.run = re.compile(f"[{letters}]+")
        self.chain = re.compile(f"[{letters}]++(?:{_BREAK}[{letters}]++)*+")
        self.letter = re.compile("[0-9A-Fa-f]" if alphabet == "hex" else "[A-Za-z0-9+/]")


WRAPPED = (
    Wrapped("base64", r"M[A-P][A-Za-z0-9+/_-]|b3BlbnNza", "A-Za-z0-9+/_-", 40, 6),
    Wrapped("hex", r"30[0-9A-Fa-f]{2}|6[fF]70656[eE]", "0-9A-Fa-f", 24, 4),
)


def der_sequence(data: bytes) -> bool:
    """Whether the data is one DER sequence of at least two elements whose nested lengths fit exactly."""
    found = _elements(data, 0, len(data), 0)
    return found == 1 and data[:1] == b"\x30" and (_elements(data, *_content(data, 0), 1) or 0) >= 2


def _content(data: bytes, at: int) -> tuple[int, int]:
    """Start and end of an element's content; (0, -1) where its length field is broken."""
    if at + 2 > len(data):
        return 0, -1
    size, start = data[at + 1], at + 2
    if size & 0x80:
        count = size & 0x7F
        if not 1 <= count <= 4 or start + count > len(data) or data[start] == 0:
            return 0, -1
        size, start = int.from_bytes(data[start: start + count], "big"), start + count
        if size < 0x80:
            return 0, -1
    return start, start + size


def _elements(data: bytes, at: int, end: int, depth: int) -> int | None:
    """Number of elements that fill [at, end) exactly; None where they do not."""
    count = 0
    while at < end:
        if data[at] not in (0x02, 0x03, 0x04, 0x05, 0x06, 0x0C, 0x13, 0x30, 0x31) and not 0xA0 <= data[at] <= 0xA3:
            return None
        start, stop = _content(data, at)
        if stop < start or stop > end or depth > 16:
            return None
        if data[at] & 0x20 and _elements(data, start, stop, depth + 1) is None:
            return None
        at, count = stop, count + 1
    return count


def length_prefixed(data: bytes) -> bool:
    """Whether the data is a binary private key: magic, three fields, the number of keys, then fields to the end."""
    if not data.startswith(OPENSSH):
        return False
    at, fields = len(OPENSSH), 0
    while at < len(data):
        if fields == 3:
            at += 4  # the number of keys
        size = int.from_bytes(data[at: at + 4], "big")
        at, fields = at + 4 + size, fields + 1
    return at == len(data) and fields >= 5


def decoded(text: str, alphabet: str) -> bytes | None:
    """The bytes of a candidate, None where it is not valid in its encoding."""
    try:
        if alphabet == "hex":
            return binascii.unhexlify(text)
        text = text.rstrip("=")
        if len(text) % 4 == 1:
            return None
        text += "=" * (-len(text) % 4)
        return base64.b64decode(text, altchars=b"-_" if alphabet == "url" else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def stated_size(data: bytes) -> int:
    """Bytes of the key that the data begins with, as its own lengths state them; 0 where it begins none."""
    if data[:1] == b"\x30":
        return max(_content(data, 0)[1], 0)
    if not data.startswith(OPENSSH):
        return 0
    at, left = len(OPENSSH), 3
    for fields in (3, None):  # three fields; behind the number of keys, one field each and the private part
        if fields is None:
            left, at = int.from_bytes(data[at: at + 4], "big") + 1, at + 4
        while left and at + 4 <= len(data):
            at, left = at + 4 + int.from_bytes(data[at: at + 4], "big"), left - 1
        if left or at > len(data):
            return 0
    return at


def wrapped_spans(text: str, form: Wrapped) -> list[tuple[int, int]]:
    """Bare key material, in one run or wrapped, that is confirmed up to the size it states."""
    out, stop, done = [], 0, 0
    clean, runs, before = "", [], []
    for m in form.first.finditer(text):
        a = m.start()
        if a < done or a and form.letter.match(text[a - 1]) and not _ESCAPED.fullmatch(text, max(a - 2, 0), a):
            continue
        if a >= stop:
            stop = form.chain.match(text, a).end()
            runs, at = [], a
            while at < stop:  # letters of breaks are no runs
                r = form.run.match(text, at)
                runs.append((r.start(), r.end()))
                at = r.end()
                if at < stop:
                    at = _BREAKS.match(text, at).end()
            before = [0]
            for x, y in runs:
                before.append(before[-1] + y - x)
            clean = "".join(text[x:y] for x, y in runs)
        k = bisect.bisect_right(runs, (a, len(text))) - 1
        first = before[k] + a - runs[k][0]
        if a >= runs[k][1] or len(clean) - first < form.least:
            continue
        # a sequence states its size at once, the other form needs all its fields
        sequence = clean[first] in "M3"
        head = _bytes_of(clean[first: first + (8 if form.bits == 6 else 12)] if sequence else clean[first:], form)
        size = stated_size(head or b"")
        letters = -(-8 * size // form.bits)
        if letters < form.least or first + letters > len(clean):
            continue
        data = _bytes_of(clean[first: first + letters], form)
        if data is None or len(data) != size or not is_key(data):
            continue
        k = bisect.bisect_left(before, first + letters) - 1
        end = runs[k][0] + first + letters - before[k]
        url = form.bits == 6 and re.search("[-_]", clean[first: first + letters])
        if form.bits == 6:
            pad = re.compile("={0,%d}" % (-letters % 4)).match(text, end).end()
        else:
            pad = end
        if pad < len(text) and (form.letter.match(text[pad]) or form.bits == 6 and text[pad] == "=" or url and text[pad] in "-_"):
            continue
        out.append((a, pad))
        done = pad
    return out


def _bytes_of(letters: str, form: Wrapped) -> bytes | None:
    if form.alphabet == "hex":
        return decoded(letters[: len(letters) // 2 * 2], "hex")
    # what follows a key may be in the other alphabet or stop anywhere
    letters = letters[: len(letters) - (len(letters) % 4 == 1)]
    return decoded(letters.replace("-", "+").replace("_", "/"), "plain")


def is_key(data: bytes | None) -> bool:
    return bool(data) and (der_sequence(data) or length_prefixed(data))


def signed_token(header: str, payload: str) -> bool:
    parsed = []
    for part in (header, payload):
        raw = decoded(part, "url")
        try:
            parsed.append(json.loads(raw.decode("utf-8")) if raw else None)
        except (ValueError, RecursionError):
            return False
    return all(isinstance(p, dict) for p in parsed) and isinstance(parsed[0].get("alg"), str)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns of the contract."""
    out = []
    if _NAMES.search(text):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def confirmed_spans(text: str, hex_spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates whose decoded form proves to be a token or a key."""
    out = []
    if "." in text:
        out += [(m.start(), 3, m.end()) for m in JWT.finditer(text) if signed_token(m[1], m[2])]
    if "-----BEGIN " in text:
        out += [(m.start(), 4, m.end()) for m in ARMOUR.finditer(text) if is_key(decoded(_FILL.sub("", m[2]), "plain"))]
    armoured = [(a, b) for a, _, b in out]
    bare = [(m.start(), m.end()) for m in BASE64.finditer(text) if is_key(decoded(m[0], "plain"))]
    bare += [(a, b) for a, _, b in hex_spans if is_key(decoded(text[a:b], "hex"))]
    bare += [span for form in WRAPPED for span in wrapped_spans(text, form)]
    out += [(a, 4, b) for a, b in sorted(set(bare)) if not any(x <= a and b <= y for x, y in armoured)]
    return sorted(out)


def spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans."""
    base = base_spans(text)
    return base, sorted(base + confirmed_spans(text, [s for s in base if s[1] == 2]))


def shown(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def masked(text: str, found: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by the name of its kind; overlapping spans become one."""
    out, at = [], 0
    for start, kind, end in found:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join(out + [text[at:]])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds and of the confirmed ones, digest of the base spans, and all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_runs(batches):
            rows = [spans(text) for text in texts]
            count = lambda kind: pa.array([sum(s[1] == kind for s in all_) for _, all_ in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(count(kind) for kind in range(len(KINDS))),
                    pa.array([hashlib.sha256(shown(base).encode()).hexdigest() for base, _ in rows], pa.string()),
                    pa.array([shown(all_) for _, all_ in rows], pa.string()),
                ],
                names=["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    schema = "doc_id long, " + ", ".join(f"n_{kind} long" for kind in KINDS) + ", base_sha256 string, spans string"
    return rows.mapInArrow(run, schema)


def redact(texts: Column) -> Column:
    """Column of the texts with all found secrets masked; null stays null."""

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        return column.map(lambda text: None if text is None else masked(text, spans(text)[1]))

    return run(texts)
