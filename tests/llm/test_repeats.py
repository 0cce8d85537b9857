"""Repeated byte strings against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from cases import ODD

from demandloom.llm import repeats
from demandloom.llm.suffix_array import maximal_repeats


def plain(rows):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 by a table of all windows."""
    least = {}
    data = [(-(2**63) if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for k in range(len(b) - 49):
            w = b[k: k + 50]
            least[w] = min(least.get(w, i), i)
    out = []
    for (raw, _), (i, b) in zip(rows, data, strict=True):
        gone = np.zeros(len(b) + 1, dtype=bool)
        for k in range(len(b) - 49):
            if least[b[k: k + 50]] < i:
                gone[k: k + 50] = True
        kept = bytes(c for c, g in zip(b, gone, strict=False) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(b) else 0
        out.append((raw, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(frame, **options):
    return sorted(map(tuple, repeats.deduplicate(frame, **options).collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    letters = "ab " if seed % 2 else "abcdefgh é\n"
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [word(rng.choice([48, 49, 50, 51, 60, 99, 200])) for _ in range(12)]
    rows = []
    for n in range(120):
        parts = [rng.choice([word(rng.randrange(80)), rng.choice(shared)]) for _ in range(rng.randrange(5))]
        text = "".join(parts)
        rows.append((n, text))
        if rng.random() < 0.2:
            rows.append((500 + n, text))
        if rng.random() < 0.2 and text:
            cut = rng.randrange(len(text))
            rows.append((700 + n, text[:cut] + "X" + text[cut:]))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("hot", [3, 400])
def test_removal_equals_brute_force(shared, seed, hot):
    rows = corpus(seed)
    frame = shared.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(frame, hot=hot) == plain(rows)


def test_odd_rows(odd, none):
    rows = [*ODD, (30, "a" * 3000), (31, "a" * 49), (32, "a" * 50), (33, "ab" * 700), (34, "b" + "ab" * 60)]
    more = odd.sparkSession.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, part string, file int")
    assert got(more) == plain(rows)
    assert got(none) == []


def test_documents(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert got(documents) == plain(rows)
    spans = repeats.removed_spans(documents).collect()
    assert sum(r["end"] - r["first"] for r in spans) == sum(r[2] for r in plain(rows))


def test_one_file_has_many_parts(shared, documents, monkeypatch, tmp_path):
    from demandloom.llm import jaccard, parts

    path = str(tmp_path / "one")
    documents.coalesce(1).write.parquet(path)
    one = shared.read.parquet(path)
    removed = sorted(map(tuple, repeats.deduplicate(one).collect()), key=str)
    joined = sorted(map(tuple, jaccard.join(one).collect()), key=str)
    kept = sorted(map(tuple, jaccard.one_of_each(one).collect()), key=str)
    monkeypatch.setattr(parts, "PART_ROWS", 30, raising=False)
    rows = [r["_part"] for r in parts.located(one).collect()]
    assert len(one.inputFiles()) == 1 and len(set(rows)) == -(-len(rows) // 30)
    assert max(map(rows.count, set(rows))) == 30
    assert sorted(map(tuple, repeats.deduplicate(one).collect()), key=str) == removed
    assert sorted(map(tuple, jaccard.join(one).collect()), key=str) == joined
    assert sorted(map(tuple, jaccard.one_of_each(one).collect()), key=str) == kept


def test_maximal_repeats_have_all_occurrences():
    rng = random.Random(7)
    parts = ["".join(rng.choice("ab") for _ in range(rng.randrange(5, 40))) for _ in range(9)]
    data = np.frombuffer("".join(parts).encode(), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - [len(p) for p in parts]
    found = {}
    for length, at, low in maximal_repeats(data, starts, ends, np.arange(9), 6):
        text = bytes(data[at[0]: at[0] + length])
        assert text not in found
        found[text] = (sorted(at.tolist()), low)
    want = {}
    whole = [p.encode() for p in parts]
    for n, p in enumerate(whole):
        for a in range(len(p)):
            for b in range(a + 6, len(p) + 1):
                want.setdefault(p[a:b], []).append((n, a))
    for text, places in list(want.items()):
        left = {whole[n][a - 1] if a else (n, "start") for n, a in places}
        right = {whole[n][a + len(text)] if a + len(text) < len(whole[n]) else (n, "end") for n, a in places}
        maximal = len(places) > 1 and (len(left) > 1 or any(isinstance(x, tuple) for x in left))
        maximal &= len(right) > 1 or any(isinstance(x, tuple) for x in right)
        if maximal:
            assert found.pop(text) == (sorted(int(starts[n]) + a for n, a in places), min(n for n, _ in places))
    assert not found


@pytest.mark.parametrize("span", [0, 1, 255, 2**33, 2**64 - 1])
def test_planes_round_trip(span):
    from demandloom.llm.parts import planes, unplanes

    rng = random.Random(span)
    values = np.array([rng.randint(0, span) - 2**63 for _ in range(41)], np.int64)
    packed = planes(values)
    assert unplanes(packed, 41).tolist() == values.tolist()
    assert unplanes(packed, 41, 7, 19).tolist() == values[7:19].tolist()
    assert len(unplanes(planes(values[:0]), 0)) == 0


def test_messages_do_not_multiply_with_parts():
    rng = np.random.default_rng(5)
    hashes = rng.integers(0, 1 << repeats.HASH_BITS, 6000).astype(np.uint64)
    box = repeats.Outbox(8, alone=False)
    for part, own in enumerate(np.split(hashes, 60)):
        box.add(part * 2**50, own, own ^ np.uint64(7), np.full(len(own), part))
        box.add(part * 2**50, own[:3], own[:3] ^ np.uint64(7), np.full(3, part + 1))
    sent = list(box.send())
    assert sum(b.num_rows for b in sent) == 8
    entries = [e for _, e in repeats.by_stretch(iter(sent))]
    got = {name: np.concatenate([e[name] for e in entries]) for name in entries[0]}
    assert sorted(got["hashes"].tolist()) == sorted(hashes.tolist())
    assert set(got["parts"].tolist()) == {part * 2**50 for part in range(60)}
    assert got["many"].sum() == 180 and (got["keys"] == (got["hashes"].astype(np.uint64) ^ np.uint64(7))).all()


def test_stretches_of_minimisers_are_even():
    data = np.random.default_rng(3).integers(97, 123, 200_000).astype(np.uint8)
    h = repeats.runs_with_keys(data, np.array([0, len(data)]))[0]
    shares = np.bincount((h >> np.uint64(repeats.HASH_BITS - 3)).astype(np.int64), minlength=8) / len(h)
    assert 0.11 < shares.min() and shares.max() < 0.14
