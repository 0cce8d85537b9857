"""Maximal repeats of a set of byte strings by the interval tree of an enhanced suffix array."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from demandloom.llm.common import mix

_STEP = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the `width` bytes at every position, len - width + 1 of them, built from hashes of half the width."""
    if len(data) < width:
        return np.zeros(0, np.uint64)
    out, have = data.astype(np.uint64) + np.uint64(1), 1
    while have < width:
        add = min(have, width - have)
        out = mix(out[: len(out) - add] * _STEP + out[add:])
        have += add
    return out


def repeated_windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
    """Positions whose `least` bytes, inside one string, occur at two positions or more."""
    hashes = gram_hashes(data, least)
    if not len(hashes):
        return np.zeros(0, np.int64)
    edge = np.zeros(len(data) + 1, np.int64)
    counts = np.maximum(ends - starts - least + 1, 0)
    np.add.at(edge, starts[counts > 0], 1)
    np.add.at(edge, (starts + counts)[counts > 0], -1)
    at = np.flatnonzero(np.cumsum(edge)[: len(hashes)] > 0)
    order = at[np.argsort(hashes[at], kind="stable")]
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    return np.sort(order[twice])


def _common(rows: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row and the next."""
    differ = rows[1:] != rows[:-1]
    return np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])


def maximal_repeats(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, value: np.ndarray, least: int
) -> Iterator[tuple[int, np.ndarray, int]]:
    """(length, positions of all occurrences, smallest value) of every left- and right-maximal repeat.

    Strings are the disjoint, ordered byte ranges [start, end) and repeats never cross them; `value` has one number per
    string. Only positions whose first `least` bytes repeat enter the suffix array. A scan over the longest common
    prefixes of neighbours closes intervals on a stack; an interval is a maximal repeat when the bytes to the left of its
    occurrences differ, otherwise the repeat one byte further left has the same occurrences and reports them.
    """
    at = repeated_windows(data, starts, ends, least)
    if not len(at):
        return
    owner = np.searchsorted(starts, at, side="right") - 1
    rest = ends[owner] - at
    words = -(-int(rest.max()) // 8)
    padded = np.concatenate([data, np.zeros(8 * words, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, 8 * words)[at]
    rows[np.arange(8 * words) >= rest[:, None]] = 0
    keys = np.ascontiguousarray(rows).view(">u8")
    order = np.lexsort(tuple(keys[:, k] for k in range(words - 1, -1, -1)))
    at, rest, owner, rows = at[order], rest[order], owner[order], rows[order]
    common = np.concatenate([np.zeros(0, np.int64), *(_common(rows[k: k + 65_537]) for k in range(0, len(rows) - 1, 65_536))])
    common = np.minimum(common, np.minimum(rest[1:], rest[:-1]))
    common[common < least] = 0
    left = np.where(at > starts[owner], data[np.maximum(at - 1, 0)].astype(np.int64), -1)  # -1: bytes differ
    small = value[owner]
    lcp, lefts, values = np.append(common, 0).tolist(), left.tolist(), small.tolist()
    stack: list[list[int]] = []  # depth, first suffix, left byte or -1, smallest value
    for i, depth in enumerate(lcp):
        first, byte, low = i, lefts[i], values[i]
        while stack and stack[-1][0] > depth:
            top = stack.pop()
            first = top[1]
            byte = byte if byte == top[2] else -1
            low = min(low, top[3])
            if byte == -1:
                yield top[0], at[first: i + 1], low
        if not depth:
            continue
        if stack and stack[-1][0] == depth:
            top = stack[-1]
            top[2] = byte if byte == top[2] else -1
            top[3] = min(low, top[3])
        else:
            stack.append([depth, first, byte, low])
