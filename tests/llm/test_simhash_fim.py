"""SimHash links against all pairs; fill-in-the-middle against plain string work."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from cases import ODD

from demandloom.llm import fim, queries, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- simhash ----------------------------------------------------------------------------------------------------------


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_print(text):
    words = WORD.findall(lower(text))
    shingles = [" ".join(words[k: k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Root of every fingerprint over all pairs of at most four different bits."""
    prints = np.array(prints, np.uint64)
    root = np.arange(len(prints))
    for n in range(len(prints)):
        for m in np.flatnonzero(np.bitwise_count(prints[:n] ^ prints[n]) <= 4).tolist():
            a, b = root[n], root[m]
            root[root == max(a, b)] = min(a, b)
    return root


def plain_join(rows):
    prints = [plain_print(t) for _, t in rows]
    root = plain_components(prints)
    least = {}
    for (i, _), r in zip(rows, root, strict=True):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return Counter((i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, prints, root, strict=True))


def got(frame, **more):
    return Counter(map(tuple, simhash.join(frame, **more).collect()))


def test_fingerprints_and_odd_rows(odd, none, shared):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    rng = random.Random(3)
    rows += [(100 + n, "".join(rng.choice("aB é\n\t\x0b") for _ in range(rng.randrange(60)))) for n in range(300)]
    rows += [(None, "only nameless rows here, twice"), (None, "only nameless rows here, twice")]
    assert got(shared.createDataFrame(rows, "doc_id long, text string")) == plain_join(rows)
    assert got(odd.select("*", odd["text"].alias("print"))) == plain_join([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert simhash.join(none).collect() == []


def test_whole_table(shared, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    found = Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in queries.op13_simhash(shared, "/root/testdata/sf0.001").collect())
    assert found == plain_join(rows)


def clusters(rng, sizes, spread):
    """Fingerprints in balls around centres, and chains of steps of four bits."""
    out = [0, 2**64 - 1]
    for size in sizes:
        centre = rng.getrandbits(64)
        for _ in range(size):
            bits = rng.sample(range(64), rng.randrange(spread + 1))
            out.append(centre ^ sum(1 << b for b in bits))
    step = rng.getrandbits(64)
    for _ in range(40):
        step ^= sum(1 << b for b in rng.sample(range(64), rng.choice([4, 4, 4, 5])))
        out.append(step)
    return sorted(set(out))


@pytest.mark.parametrize(("bucket", "spread"), [(20_000, 4), (20_000, 7), (40, 5), (3, 4)])
def test_links_equal_all_pairs(shared, bucket, spread):
    """Small buckets send their members to the longer keys and to the points around them."""
    rng = random.Random(bucket + spread)
    prints = clusters(rng, [300, 60, 20, 5, 2, 2] + [1] * 200, spread)
    frame = shared.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "print long").repartition(3)
    pairs = simhash.links(frame, bucket).collect()
    at = {p: n for n, p in enumerate(prints)}
    for r in pairs:  # every link holds by itself or through others of its bucket: both ends are known
        assert r["u"] % 2**64 in at and r["v"] % 2**64 in at
    ends = np.array([(at[r["u"] % 2**64], at[r["v"] % 2**64]) for r in pairs]).reshape(-1, 2)
    assert np.array_equal(simhash.forest(len(prints), ends[:, 0], ends[:, 1]), plain_components(prints))


def test_dense_group_sends_no_pairs(shared):
    """Five thousand fingerprints around one centre: rows sent stay in proportion to them."""
    rng = random.Random(9)
    centre = rng.getrandbits(64)
    prints = {centre ^ sum(1 << b for b in rng.sample(range(14), rng.randrange(14))) for _ in range(5000)}
    frame = shared.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "print long")
    assert simhash.links(frame).count() <= 40 * len(prints)


def test_code_is_perfect():
    assert (simhash._ERROR >= 0).all() and max(int(e).bit_count() for e in simhash._ERROR) == 3
    words = np.arange(1 << 12) << 11 | simhash._REMAINDER
    assert min(int(w).bit_count() for w in words[1:]) == 7
    assert max(map(len, simhash._neighbours(1))) == 6


def test_words_run_over_batches(shared):
    keys = np.repeat(np.arange(9), [1, 2, 700, 1, 50, 3, 1, 1, 900])
    rng = np.random.default_rng(1)
    prints = (keys.astype(np.uint64) << np.uint64(50)) ^ (np.uint64(1) << rng.integers(0, 9, len(keys)).astype(np.uint64))
    import pyarrow as pa

    for step in (7, 100, 5000):
        parts = [
            pa.RecordBatch.from_arrays([pa.array(keys[k: k + step]), pa.array(prints[k: k + step].view(np.int64))], names=["key", "print"])
            for k in range(0, len(keys), step)
        ]
        out = [r for b in simhash._compared(iter(parts), 600) for r in b.to_pylist()]
        assert sum(r["hot"] for r in out) == 1600
        assert sum(not r["hot"] for r in out) == 1 + 49 + 2


# -- fill-in-the-middle -----------------------------------------------------------------------------------------------


def plain_fim(doc_id, text, rate=100, spm=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k: 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def loose_texts():
    rng = random.Random(5)
    out = ["".join(rng.choice("ab é😀\n\n<>PSM\r") for _ in range(rng.randrange(50))) for _ in range(600)]
    return out + ["\n", "\n\n\n", "x<P>y\n", "<S", "<", "P>", "<<S>", "a\nb", "<P", "\n<M>\n", "line\n" * 300_000, "é\n" * 5]


@pytest.mark.parametrize(("rate", "spm"), [(100, 50), (60, 0), (0, 50), (100, 100)])
def test_fim_equals_plain(shared, odd, none, rate, spm):
    rows = [(n, t) for n, t in enumerate(loose_texts())] + [(r["doc_id"], r["text"]) for r in odd.collect()]
    recipe = fim.Recipe(rate=rate, spm=spm)
    for frame in (shared.createDataFrame(rows, "doc_id long, text string"), odd):
        out = fim.restore(fim.transform(frame, recipe), recipe).collect()
        found = Counter((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["restored"]) for r in out)
        assert found == Counter((r["doc_id"], *plain_fim(r["doc_id"], r["text"], rate, spm), r["text"] or "") for r in frame.collect())
    assert fim.restore(fim.transform(none)).collect() == []


def test_fim_query(shared, documents):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = Counter()
    for r in documents.collect():
        *head, output = plain_fim(r["doc_id"], r["text"])
        want[(r["doc_id"], *head, sha(output), sha(r["text"] or ""))] += 1
    assert Counter(map(tuple, queries.op12_fill_in_middle(shared, "/root/testdata/sf0.001").collect())) == want


def test_fim_broken_outputs_and_tags(shared):
    rows = [("psm", "<P>a<S>b<M>c"), ("psm", "<S>a<P>b<M>c"), ("spm", "<S>a<P>b"), ("psm", "x<P>a<S>b<M>c"), ("psm", "<P><P><S><M>"),
            ("plain", "<P>"), ("spm", "<S>ü<P>ä<M>ö")]
    out = fim.restore(shared.createDataFrame(rows, "form string, output string")).collect()
    assert [r["restored"] for r in out] == ["acb", None, None, None, None, "<P>", "äöü"]
    for tags in (("", "<S>", "<M>"), ("<P>", "<P>", "<M>"), ("aXa", "<S>", "<M>"), ("ab", "bc", "x"), ("a", "cab", "x")):
        with pytest.raises(ValueError):
            fim.Recipe(prefix=tags[0], suffix=tags[1], middle=tags[2])
    odd = fim.Recipe(prefix="<fim_prefix>", suffix="⟨s⟩", middle="|m")
    frame = shared.createDataFrame([(n, t) for n, t in enumerate(loose_texts()[:99])], "doc_id long, text string")
    out = fim.restore(fim.transform(frame, odd), odd).join(frame, "doc_id").collect()
    assert all(r["restored"] == (r["text"] or "") for r in out) and {"psm", "spm"} <= {r["form"] for r in out}
