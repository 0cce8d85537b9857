from __future__ import annotations

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from demandloom.sources import digests, files


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def tree(data: bytes, block: int, fan_out: int) -> str:
    level = [sha(data[k : k + block]) for k in range(0, max(len(data), 1), block)]
    while len(level) > 1:
        groups = [level[k : k + fan_out] for k in range(0, len(level), fan_out)]
        level = [g[0] if len(g) == 1 else sha("".join(g).encode()) for g in groups]
    return level[0]


def test_files_equal_a_plain_hash_tree(spark, tmp_path):
    contents = {"empty.txt": b"", "one.txt": b"x" * 10, "eleven.txt": bytes(range(11)), "deep/a b#1%20.txt": os.urandom(1234)}
    (tmp_path / "deep").mkdir()
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "other.csv").write_bytes(b"not asked for")
    found = digests.file_digests(spark, str(tmp_path), "*.txt", block_bytes=10, fan_out=3, largest=2000).collect()
    assert {r["path"].split(f"{tmp_path}/")[1]: (r["size_bytes"], r["sha256"]) for r in found} == {
        name: (len(data), tree(data, 10, 3)) for name, data in contents.items() if data
    }
    with pytest.raises(Exception, match="larger than 30 bytes"):
        digests.file_digests(spark, str(tmp_path), "*.txt", block_bytes=10, fan_out=3, largest=30).collect()
    whole = digests.file_digests(spark, str(tmp_path), "*.txt")
    assert {r["sha256"] for r in whole.collect()} == {sha(data) for data in contents.values() if data}


def test_a_file_beyond_the_limit_of_one_value(spark, tmp_path):
    size, block = (1 << 31) + 5, 1 << 28
    with open(tmp_path / "large.csv", "wb") as target:
        target.truncate(size)
        target.seek(size - 3)
        target.write(b"end")
    row = files.combined_digests(files.source_digests(spark, str(tmp_path))).first()
    assert row["file"] == "large.csv" and row["size_bytes"] == size and row["parts"] == 1
    blocks = digests.block_digests(spark, str(tmp_path), block_bytes=block).orderBy("block").collect()
    assert [r["block"] for r in blocks] == list(range(9)) and blocks[-1]["sha256"] == sha(b"\0\0end")
    assert len({r["sha256"] for r in blocks[:-1]}) == 1


def test_a_file_that_ends_early_is_an_error(tmp_path):
    (tmp_path / "short").write_bytes(b"abc")
    with pytest.raises(OSError, match="ends 2 bytes before"):
        digests.block_digest(str(tmp_path / "short"), 1, 4)


def test_blocks_are_dealt_over_tasks(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"y" * 4000)
    parts = digests.block_digests(spark, str(tmp_path), block_bytes=10).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 8 and max(r["count"] for r in parts) < 80


def test_a_set_does_not_depend_on_names_order_or_partitions(spark):
    rows = [("s", sha(str(k).encode()), 1) for k in range(300)] + [("s", sha(b"7"), 1)] * 3 + [("t", sha(b"only"), 5)]
    frame = spark.createDataFrame(rows, "file string, sha256 string, size_bytes long")
    one = {r["file"]: tuple(r) for r in digests.set_digest(frame, ["file"]).collect()}
    two = {r["file"]: tuple(r) for r in digests.set_digest(frame.orderBy("sha256").repartition(7), ["file"]).collect()}
    assert one == two and one["t"] == ("t", 5, 1, sha(b"only")) and one["s"][1:3] == (303, 303)
    copies: dict[str, int] = {}
    for file, digest, _ in rows:
        if file == "s":
            copies[digest] = copies.get(digest, 0) + 1
    nodes = {d: d if n == 1 else sha(f"{d}:{n}".encode()) for d, n in copies.items()}
    for digits in (6, 3, 0):
        groups: dict[str, list[str]] = {}
        for prefix in sorted(nodes):
            groups.setdefault(prefix[:digits], []).append(nodes[prefix])
        nodes = {p: g[0] if len(g) == 1 else sha("".join(g).encode()) for p, g in groups.items()}
    assert one["s"][3] == nodes[""]
    fewer = digests.set_digest(frame.where("file = 's'").distinct(), ["file"]).first()
    assert fewer["sha256"] != one["s"][3]
