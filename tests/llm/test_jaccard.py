"""The Jaccard join against all pairs."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from cases import ODD

from demandloom.llm import jaccard
from demandloom.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[k: k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def plain(rows):
    """doc_id, set size, smallest reachable doc_id; pairs come from an index of all shingles."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    index = defaultdict(list)
    for n, s in enumerate(sets):
        for shingle in s:
            index[shingle].append(n)
    for n, s in enumerate(sets):
        shared = defaultdict(int)
        for shingle in s:
            for m in index[shingle]:
                if m < n:
                    shared[m] += 1
        for m, k in shared.items():
            if 100 * k >= 80 * (len(s) + len(sets[m]) - k):
                parent[root(n)] = root(m)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[root(n)] = min(least.get(root(n), i), i)
    return sorted(
        ((i, len(s), least.get(root(n)) if s else i) for n, ((i, _), s) in enumerate(zip(rows, sets, strict=True))), key=str
    )


def got(frame):
    return sorted(map(tuple, jaccard.join(frame).collect()), key=str)


def family(rng, size, edits, words=80):
    """Copies of one text with some words changed."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_join_equals_all_pairs(shared, seed):
    rng = random.Random(seed)
    common = " ".join(f"c{k}" for k in range(40))
    texts = []
    for _ in range(25):
        texts += family(rng, rng.randrange(1, 9), rng.randrange(6), rng.choice([3, 4, 5, 6, 20, 60, 200]))
    texts += [f"{common} {' '.join(str(rng.randrange(99)) for _ in range(rng.randrange(60)))}" for _ in range(60)]
    texts += family(rng, 150, 4)
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(12))) for _ in range(80)]
    texts += rng.choices(texts, k=60)
    rng.shuffle(texts)
    rows = [(3 * n + 1, t.upper() if n % 7 == 0 else t.replace(" ", "\n\t") if n % 11 == 0 else t) for n, t in enumerate(texts)]
    assert got(shared.createDataFrame(rows, "doc_id long, text string").repartition(3)) == plain(rows)


def test_large_cell_is_divided(shared):
    rng = random.Random(9)
    texts = family(rng, 420, 9, 120)
    rows = list(enumerate(texts))
    assert len(texts) > 4 * jaccard.BLOCK
    assert got(shared.createDataFrame(rows, "doc_id long, text string").repartition(2)) == plain(rows)


def test_odd_rows(odd, none):
    assert got(odd) == plain(ODD)
    assert got(none) == []


def test_one_of_each_group_stays(shared):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "A B c d e f"), (3, "a b c d e f"), (5, "other words here"),
            (None, "no id at all"), (None, "no id at all"), (7, ""), (8, None), (9, "  ")]
    frame = shared.createDataFrame([(i, t, n, "y") for n, (i, t) in enumerate(rows)], "doc_id long, text string, kind int, part string")
    kept = jaccard.one_of_each(frame.repartition(3))
    assert kept.schema == frame.schema
    got_ = kept.collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in got_) == sorted(
        [(3, "a b c d e f"), (5, "other words here"), (0, "no id at all"), (7, ""), (8, ""), (9, "  ")]
    )


def test_documents(documents):
    assert got(documents) == plain([(r["doc_id"], r["text"]) for r in documents.collect()])


def test_linked_pairs_with_and_without_home(monkeypatch):
    monkeypatch.setattr(jaccard, "LEAF", 8)
    rng = np.random.default_rng(4)
    centres = [rng.choice(10**6, 60, replace=False) for _ in range(12)]
    sets = []
    for n in range(200):
        s = centres[n % 12].copy()
        s[rng.choice(60, rng.integers(0, 12), replace=False)] = rng.choice(10**6, 1)
        sets.append(np.unique(s).astype(np.uint64))
    home = rng.random(200) < 0.5
    want = {
        (a, b) for a in range(200) for b in range(a + 1, 200)
        if (home[a] or home[b]) and 5 * (k := len(np.intersect1d(sets[a], sets[b]))) >= 4 * (len(sets[a]) + len(sets[b]) - k)
    }
    found = {(min(p), max(p)) for p in jaccard.linked_pairs(sets, home)}
    assert found == want and len(want) > 100


def test_components_of_chains_and_stars(shared):
    rng = random.Random(2)
    links = [(n, n + 1) for n in range(0, 300)] + [(1000, 1000 + n) for n in range(1, 200)] + [(5000, 5001), (5001, 5000), (7, 7)]
    rng.shuffle(links)
    got_ = {r["node"]: r["root"] for r in components(shared.createDataFrame(links, "u long, v long")).collect()}
    assert got_ == {**{n: 0 for n in range(301)}, **{1000 + n: 1000 for n in range(200)}, 5000: 5000, 5001: 5000}


def thue_morse(bits):
    """A word of 2 ** bits letters and its complement, which polynomial hashes modulo 2 ** 64 cannot tell apart."""
    word = "".join("ab"[n.bit_count() & 1] for n in range(1 << bits))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_of_thue_morse_differ(shared):
    one, two = thue_morse(11)
    rows = [(1, one), (2, two), (3, f"x {one}"), (4, f"x {two}"), (5, one)]
    assert got(shared.createDataFrame(rows, "doc_id long, text string")) == plain(rows)


def test_span_hashes_are_those_of_the_bytes():
    from demandloom.llm.common import span_hashes

    rng = random.Random(4)
    seen = {}
    for _ in range(300):
        spans = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randrange(40))) for _ in range(30)]
        ends = np.cumsum([len(s) for s in spans])
        for span, code in zip(spans, span_hashes(np.frombuffer(b"".join(spans), np.uint8), ends - [len(s) for s in spans], ends).tolist(), strict=True):
            assert seen.setdefault(span, code) == code
    assert len(set(seen.values())) == len(seen)
