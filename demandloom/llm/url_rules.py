"""URL filters by cascades of Bloom filters.

A rule list is a set of keys "host/path". All keys that the corpus can ask for are known: the host suffixes of every url
joined with the path prefixes that have the length of some rule's path. Level 1 of a cascade encodes the listed keys,
level 2 the keys of that universe which level 1 reports wrongly, level 3 the listed keys which level 2 reports, and so on
until a level reports nothing wrong. The first level that does not know a key decides, so membership is exact for every
key of the universe, and urls are judged without a join.

Defined cases: a null url, or one without "://", has an empty host and path and fits no rule; repeated pages are judged
one by one; a path may be empty; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclasses.dataclass(frozen=True)
class Rule:
    """A host with all its subdomains and a path prefix; `path` may be empty."""

    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


@dataclasses.dataclass
class Cascade:
    """Levels of (words of bits, number of bits, hashes per key)."""

    levels: list[tuple[np.ndarray, int, int]]

    def holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Membership of each key of the universe, given its two hashes."""
        verdict = np.zeros(len(a), dtype=bool)
        open_ = np.arange(len(a))
        for level, (words, bits, count) in enumerate(self.levels):
            known = np.ones(len(open_), dtype=bool)
            for word, mask in positions(a[open_], b[open_], level, bits, count):
                known &= words[word] & mask != 0
            # unknown at an odd level: not listed; unknown at an even level: listed
            verdict[open_[~known]] = level % 2 == 1
            open_ = open_[known]
        verdict[open_] = len(self.levels) % 2 == 1
        return verdict


def positions(a: np.ndarray, b: np.ndarray, level: int, bits: int, count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word and mask of each of `count` bits; every level has its own."""
    start = a ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    step = (b * np.uint64(2 * level + 3)) | np.uint64(1)
    for k in range(count):
        at = (start + step * np.uint64(k))
        at = (at ^ (at >> np.uint64(31))) % np.uint64(bits)
        yield (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, host, path by the contract's reading of a url."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return (
        pages.select("page_id", "url")
        .withColumn("rest", F.coalesce(rest, F.lit("")))
        .withColumn("raw", F.regexp_extract("rest", r"^([^/?#]*)", 1))
        .withColumn("path", F.regexp_extract(F.expr("substring(rest, length(raw) + 1)"), r"^([^?#]*)", 1))
        .select("page_id", F.translate("raw", UPPER, LOWER).alias("host"), "path")
    )


def candidates(rules: Sequence[Rule]) -> Column:
    """Every key that could be a rule for this host and path, longest first; at most labels x path lengths."""
    most = max(len(rule.host.split(".")) for rule in rules)
    lengths = sorted({len(rule.path) for rule in rules}, reverse=True)
    labels = F.size(F.split("host", r"\."))
    keys = [
        F.when(
            (labels >= count) & (F.length("path") >= length) & (F.length("host") > 0),
            F.struct(
                (F.length(F.substring_index("host", ".", -count)) + length).alias("size"),
                F.concat(F.substring_index("host", ".", -count), F.expr(f"left(path, {length})")).alias("key"),
            ),
        )
        for count in range(1, most + 1)
        for length in lengths
    ]
    return F.transform(F.sort_array(F.array_compact(F.array(*keys)), asc=False), lambda k: k["key"])


def hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("a"), F.xxhash64(key, F.lit(17)).alias("b")]


def build(universe: DataFrame, listed: str, bits_per_key: int = 12, count: int = 6, max_bytes: int = 64 << 20) -> Cascade:
    """A cascade for the keys with the flag `listed`, exact over all keys of the universe (columns a, b, flags).

    Every level is one scan that sets bits in its own batch, joined by a bitwise or per word; the driver receives the
    words of a filter of checked size. A list beyond `max_bytes` must be given in parts, one cascade each.
    """
    cascade = Cascade([])
    while True:
        level = len(cascade.levels)
        inside = F.col(listed) if level % 2 == 0 else ~F.col(listed)
        keys = _reported(universe.where(inside), cascade)
        size = keys.count()
        if not size:
            return cascade
        bits = max(64, -(-size * bits_per_key // 64) * 64)
        if bits // 8 > max_bytes:
            raise ValueError(f"a level of {size} keys needs {bits // 8} bytes; give the list in parts or raise max_bytes")

        def set_bits(parts: Iterator[pd.DataFrame], level: int = level, bits: int = bits) -> Iterator[pd.DataFrame]:
            for part in parts:
                words = np.zeros(0, np.int64)
                masks = np.zeros(0, np.uint64)
                for word, mask in positions(*_unsigned(part), level, bits, count):
                    words, masks = np.concatenate([words, word]), np.concatenate([masks, mask])
                order = np.argsort(words, kind="stable")
                words, masks = words[order], masks[order]
                first = np.flatnonzero(np.r_[True, words[1:] != words[:-1]][: len(words)])
                joined = np.bitwise_or.reduceat(masks, first) if len(first) else masks
                yield pd.DataFrame({"word": words[first], "mask": joined.view(np.int64)})

        rows = keys.mapInPandas(set_bits, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))
        words = np.zeros(bits // 64, np.uint64)
        for row in rows.collect():  # at most bits / 64 rows
            words[row["word"]] = np.uint64(row["mask"] & (2**64 - 1))
        cascade.levels.append((words, bits, count))


def _unsigned(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return part["a"].to_numpy(np.int64).view(np.uint64), part["b"].to_numpy(np.int64).view(np.uint64)


def _reported(keys: DataFrame, cascade: Cascade) -> DataFrame:
    """Keys that all levels so far know."""
    if not cascade.levels:
        return keys
    shared = keys.sparkSession.sparkContext.broadcast(cascade.levels)

    def passed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            a, b = _unsigned(part)
            known = np.ones(len(part), dtype=bool)
            for level, (words, bits, count) in enumerate(shared.value):
                for word, mask in positions(a, b, level, bits, count):
                    known &= words[word] & mask != 0
            yield part[known]

    return keys.mapInPandas(passed, keys.schema)


def judge(
    pages: DataFrame, rules: Sequence[Rule], listed_hosts: Sequence[str] = (), bits_per_key: int = 12
) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    The longest rule that fits decides. Where none fits, a host listed in `listed_hosts` (or a subdomain of one) is
    blocked and any other is allowed.
    """
    asked = [*rules, *(Rule(host, "", "block") for host in listed_hosts)]
    lists = {
        "in_allow": [rule.key for rule in rules if rule.verdict == "allow"],
        "in_block": [rule.key for rule in rules if rule.verdict == "block"],
        "in_hosts": [*listed_hosts],
    }
    spark = pages.sparkSession
    questions = parsed(pages).withColumn("keys", candidates(asked))
    known = [(key, *(key in lists[name] for name in lists)) for key in {k for keys in lists.values() for k in keys}]
    flags = spark.createDataFrame(known, "key string, " + ", ".join(f"{name} boolean" for name in lists))
    seen = questions.select(F.explode("keys").alias("key")).withColumns({name: F.lit(False) for name in lists})
    universe = (
        seen.unionByName(flags)
        .groupBy(*hashes(F.col("key")))
        .agg(*(F.bool_or(name).alias(name) for name in lists))
    )
    universe = staged(universe, "url-keys")
    cascades = spark.sparkContext.broadcast({name: build(universe, name, bits_per_key) for name in lists})

    @F.pandas_udf("rule string, verdict string")
    def decide(keys: pd.Series, a: pd.Series, b: pd.Series) -> pd.DataFrame:
        flat = [key for row in keys for key in row]
        hashed = (np.fromiter((x for row in s for x in row), np.int64, len(flat)).view(np.uint64) for s in (a, b))
        hashed_a, hashed_b = hashed
        held = {name: cascade.holds(hashed_a, hashed_b) for name, cascade in cascades.value.items()}
        hit = held["in_allow"] | held["in_block"]
        rule, verdict, at = [], [], 0
        for n in map(len, keys):
            found = np.flatnonzero(hit[at: at + n])
            if len(found):
                rule.append(flat[at + found[0]])
                verdict.append("block" if held["in_block"][at + found[0]] else "allow")
            else:
                rule.append(None)
                verdict.append("block" if held["in_hosts"][at: at + n].any() else "allow")
            at += n
        return pd.DataFrame({"rule": pd.Series(rule, dtype=object), "verdict": pd.Series(verdict, dtype=object)})

    asked_keys = F.col("keys")
    judged = decide(
        asked_keys,
        F.transform(asked_keys, lambda k: F.xxhash64(k)),
        F.transform(asked_keys, lambda k: F.xxhash64(k, F.lit(17))),
    )
    return questions.withColumn("judged", judged).select("page_id", "host", "path", "judged.rule", "judged.verdict")
