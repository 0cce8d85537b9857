"""Ranked search against scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.llm import lexical, queries
from demandloom.llm.common import table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    """Counter of (item_id, rank, doc_id, score)."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    size, total = len(counts), sum(c.total() for _, c in counts)
    held = Counter(term for _, c in counts for term in c)
    out = Counter()
    for item, text in set(items):
        scored = []
        for i, c in counts:
            m = 10 + 90 * c.total() * size // total
            score = 0
            for term in set(terms(text)) & c.keys():
                w = math.floor(1000 * math.log((2 * size + 2) / (2 * held[term] + 1)))
                score += w * (10**9 * c[term] // (1000 * c[term] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        for rank, (score, null, i) in enumerate(sorted(scored)[:k], 1):
            out[(item, rank, None if null else i, -score)] += 1
    return out


def got(docs, items, **more):
    return Counter(map(tuple, lexical.search(docs, items, **more).select("item_id", "rank", "doc_id", "score").collect()))


def frames(shared, docs, items):
    return (shared.createDataFrame(docs, "doc_id long, text string").repartition(3),
            shared.createDataFrame(items, "item_id long, text string"))


@pytest.mark.parametrize(("seed", "words", "block_terms", "k"), [(0, 12, 8192, 10), (1, 300, 8192, 3), (2, 40, 25, 10)])
def test_search_equals_scoring_all(shared, seed, words, block_terms, k):
    """Few words give ties and large groups of one mask; many words give a mask for nearly every document."""
    rng = random.Random(seed)
    pool = [("w%d" if n % 3 else "Ünïcode%dlongterm") % n for n in range(words)]
    docs = [(n // 2 if n % 50 else None, " ".join(rng.choice(pool) for _ in range(rng.choice([0, 1, 3, 20, 200])))) for n in range(900)]
    items = [(n, ", ".join(rng.choice(pool) for _ in range(rng.choice([1, 2, 9, 80])))) for n in range(30)]
    assert got(*frames(shared, docs, items), k=k, block_terms=block_terms) == plain(docs, items, k)


def test_odd_rows(shared, odd, none):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    items = [(1, None), (2, ""), (3, "—"), (4, "ONE one, Tail"), (4, "ONE one, Tail"), (4, "other ñ"), (None, "id; long"), (5, "--"), (6, "absent")]
    asked = shared.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit(1))
    assert got(odd, asked) == plain(docs, items)
    assert got(none, asked) == Counter() and got(odd, asked.limit(0)) == Counter()
    assert got(odd.where("doc_id < 4"), asked) == Counter()


def test_query_on_the_table(shared):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in table(shared, sf, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in table(shared, sf, "benchmark").collect()]
    found = queries.op11_lexical_search(shared, sf).select("item_id", "rank", "doc_id", "score")
    assert Counter(map(tuple, found.collect())) == plain(docs, items)


def test_masks_and_early_end():
    """Groups are the equal masks, and masks that cannot reach the kept scores are left out."""
    rng = np.random.default_rng(1)
    impact = np.where(rng.random((70, 500)) < 0.02, rng.integers(1, 10**6, (70, 500)), 0).astype(np.int32)
    impact[:, 400:] = impact[:, :100]
    order, first = lexical.masks_of(impact)
    groups = defaultdict(set)
    for n in range(500):
        groups[(impact[:, n] > 0).tobytes()].add(n)
    assert {frozenset(x.tolist()) for x in np.split(order, first[1:])} == {frozenset(g) for g in groups.values()}
    weight = rng.integers(1, 20_000, 70)
    best = lexical.Best(10)
    seen = lexical.evaluate(best, impact, weight, impact.max(axis=1), np.arange(500), np.zeros(500, bool))
    score = weight @ impact.astype(np.int64)
    assert best.id.tolist() == np.lexsort((np.arange(500), -score))[:10].tolist()
    assert 10 <= seen < 400


def test_terms_with_one_hash_or_beyond_64_bits(shared):
    words = lexical.Terms([b"ab", b"abcdefghi", b"abcdefghij"])
    data = np.frombuffer(b"ab abcdefghi abcdefghj abcdefghij a", np.uint8)
    starts, ends = np.array([0, 3, 13, 23, 34]), np.array([2, 12, 22, 33, 35])
    assert words.find(data, starts, ends).tolist() == [0, 1, -1, 2, -1]
    words.hashes[:] = lexical.span_hashes(data, starts[2:3], ends[2:3])  # as if all hashes were that of another term
    assert words.find(data, starts, ends).tolist() == [-1] * 5
