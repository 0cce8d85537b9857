"""Sharding, url rules, sentence pieces and binary records against plain forms."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from cases import ODD, SF

from demandloom.llm import pieces, queries, records, sharding, url_rules
from demandloom.llm.common import new_path


def check_shards(rows, texts, shards):
    assert len(rows) == len(texts)
    by = defaultdict(list)
    for row in rows:
        by[row["shard"]].append(row)
        assert row["law"] == "bytes" and row["grown_shard"] is None
    assert set(by) <= set(range(shards))
    for part in by.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    want = sorted((i if i is not None else -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert want == sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["text_crc32"]) for r in rows)
    return {k: sum(r["size"] for r in part) for k, part in by.items()}


def test_shards_are_even_and_slots_gapless(documents):
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    sizes = check_shards(sharding.place(documents, 8).collect(), texts, 8)
    mean = sum(sizes.values()) / 8
    largest = max(len((t or "").encode()) + 1 for _, t in texts)
    assert len(sizes) == 8 and max(abs(s - mean) for s in sizes.values()) <= largest + mean / 50


def test_shards_of_odd_rows(odd, none):
    check_shards(sharding.place(odd, 8).collect(), ODD, 8)
    assert sharding.place(none).collect() == []


def test_hot_text_is_cut_and_small_groups_stay_whole(shared):
    texts = [(n, "hot text") for n in range(3000)] + [(n, f"text {n // 2} " * 9) for n in range(3000, 6000)]
    rows = sharding.place(shared.createDataFrame(texts, "doc_id long, text string"), 8, sample=512).collect()
    sizes = check_shards(rows, texts, 8)
    mean = sum(sizes.values()) / 8
    assert max(abs(s - mean) for s in sizes.values()) <= 0.03 * mean
    where = defaultdict(set)
    for row in rows:
        if row["doc_id"] >= 3000:
            where[row["text_crc32"]].add(row["shard"])
    assert all(len(s) == 1 for s in where.values())


def plain_verdict(url, rules, listed):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:cut], rest[cut:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = tail[: min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
    under = lambda h: host == h or host.endswith("." + h)
    fits = [r for r in rules if under(r.host) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.key))
        return host, path, best.key, best.verdict
    return host, path, None, "block" if any(map(under, listed)) else "allow"


def test_url_rules_against_plain_form(shared):
    random.seed(3)
    names = ["com", "net", "example.com", "www.example.com", "WWW.Example.COM", "xexample.com", "net.", ".com", "", "a.b.net",
             "spam-farm.example.org", "m.spam-farm.example.org", "org"]
    tails = ["", "/", "/en", "/en/", "/en/x?y", "/es/", "/fr/#z", "?q://", "#a", "/a/en/", "/EN/"]
    urls = [None, "", "no scheme", "://", "http://", "x://com/://net/es/", "http://com:80/", "ftp://com/\n/x"]
    urls += [f"http://{n}{t}" for n in names for t in tails]
    urls += ["http://" + ".".join(random.choice(["a", "net", "com", "example"]) for _ in range(4)) + t for t in tails * 40]
    pages = shared.createDataFrame([(n, u, "h", 1) for n, u in enumerate(urls)], "page_id long, url string, rule string, a int")
    got = url_rules.judge(pages, queries.URL_RULES, queries.LISTED_HOSTS, bits_per_key=2).collect()
    want = [(n, *plain_verdict(u, queries.URL_RULES, queries.LISTED_HOSTS)) for n, u in enumerate(urls)]
    assert sorted(map(tuple, got)) == sorted(want, key=lambda r: r[0])
    assert url_rules.judge(pages.limit(0), queries.URL_RULES).collect() == []


def test_cascade_is_exact_with_several_levels(shared):
    keys = shared.range(20_000).selectExpr("xxhash64(id) a", "xxhash64(id, 17) b", "id % 97 = 0 listed")
    cascade = url_rules.build(keys, "listed", bits_per_key=3, count=2)
    assert len(cascade.levels) > 3
    rows = keys.toPandas()
    held = cascade.holds(rows["a"].to_numpy().view(np.uint64), rows["b"].to_numpy().view(np.uint64))
    assert (held == rows["listed"].to_numpy()).all()
    with pytest.raises(ValueError):
        url_rules.build(keys, "listed", max_bytes=8)


MODEL = public_tokenizers.path("piece_bpe_32k.model")


def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pieces_equal_the_library():
    random.seed(5)
    letters = "  ▁▁ab cdeéñ\n\t%%$ßあ😀\x00<0x41></s>"
    texts = ["".join(random.choice(letters) for _ in range(random.randrange(60))) for _ in range(800)]
    texts += ["", " ", "  ", "▁", "▁▁", "a" * 1000, "the" * 500, "ab" * 300 + "▁" * 37, "trail  ", " " * 999 + "a"]
    texts += [" " * n for n in range(40)] + [t or "" for _, t in ODD]
    coder, lib = pieces.PieceCoder(MODEL), library()
    ids = coder.encode(texts)
    assert [x.tolist() for x in ids] == lib.encode(texts, add_bos=True, add_eos=True, num_threads=1)
    assert [coder.decode(x) for x in ids] == [lib.decode(x.tolist()) for x in ids]
    loose = [[random.randrange(400) for _ in range(random.randrange(12))] for _ in range(1500)]
    assert [coder.decode(np.array(x, np.int64)) for x in loose] == [lib.decode(x) for x in loose]


def test_piece_store_may_be_emptied(monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_WORDS", 5)
    coder, lib = pieces.PieceCoder(MODEL), library()
    for text in ("one two three four five six", "seven eight one two", "nine"):
        assert coder.encode([text])[0].tolist() == lib.encode(text, add_bos=True, add_eos=True)


def test_piece_query(documents, odd, none):
    lib = library()
    for frame in (documents, odd):
        got = {(r["doc_id"], r["ids_sha256"]): r for r in pieces.digest_documents(frame, MODEL).collect()}
        for row in frame.collect():
            ids = lib.encode(row["text"] or "", add_bos=True, add_eos=True)
            digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            out = got[row["doc_id"], digest]
            assert out["n_tokens"] == len(ids)
            assert out["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
    assert pieces.digest_documents(none, MODEL).collect() == []
    whole = {r["doc_id"]: r for r in pieces.encode_documents(documents, MODEL).collect()}
    assert all(lib.decode(r["ids"]) == r["decoded"] for r in whole.values())


WORDS = public_tokenizers.path("word_bpe_49k.json")


def plain_records(rows):
    from tokenizers import Tokenizer

    tokenizer, start, out = Tokenizer.from_file(WORDS), 0, []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_records_round_trip(documents):
    got = sorted(map(tuple, queries.op4_binary_output(documents.sparkSession, SF).collect()))
    assert got == plain_records(sorted((r["doc_id"], r["text"]) for r in documents.collect()))


def test_records_of_odd_rows(odd, none):
    spark = odd.sparkSession
    texts = ["<|endoftext|> A<|startoftext|>b", "İΣς ſ K\u0301 a\u0301 b\u00a0c\u2003d\x0b\x85e\r\nf ''ll ' s", "１２ ½ ٣"]
    more = odd.select("doc_id", "text").union(spark.createDataFrame([(20 + n, t) for n, t in enumerate(texts)], "doc_id long, text string"))
    from demandloom.llm.common import staged

    manifest = staged(records.write_records(more, new_path(spark, "t"), WORDS, 2, files=3), "m")
    got = sorted((tuple(r) for r in records.read_records(manifest).collect()), key=lambda r: r[1])
    want = plain_records(sorted(ODD + [(20 + n, t) for n, t in enumerate(texts)], key=lambda r: (r[0] is not None, r[0] or 0)))
    assert [r[:1] + r[2:] for r in got] == [r[:1] + r[2:] for r in want] and [r[1] for r in got] == [r[1] for r in want]
    empty = staged(records.write_records(none, new_path(spark, "t"), WORDS, 2, files=3), "m")
    assert records.read_records(empty).collect() == []


def test_cuts_equal_the_library():
    rng = random.Random(2)
    coder = records.coder(WORDS)
    assert coder.cuts
    latin = [chr(c) for c in range(1, 0x180)]
    texts = ["".join(rng.choice(latin) for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    texts += ["".join(rng.choice("a'sSrRlLmd ve\xa0é½²<|İΣ\u0301") for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    want = [e.ids + [2] for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in coder.encode(texts, 2)] == want


def test_shuffled_reads_and_broken_files(documents):
    from demandloom.llm.common import staged

    spark = documents.sparkSession
    manifest = staged(records.write_records(documents, new_path(spark, "t"), WORDS, 2, files=2), "m").collect()
    row = manifest[0]
    in_order = list(records.fetch(row["records"], row["index"], row["width"]))
    order = list(range(len(in_order)))
    random.Random(1).shuffle(order)
    for n, (doc_id, ids) in zip(order, records.fetch(row["records"], row["index"], row["width"], order), strict=True):
        assert doc_id == in_order[n][0] and (ids == in_order[n][1]).all()
    data = bytearray(records.frame(b"payload"))
    assert bytes(records.unframe(memoryview(bytes(data)), 0)[0]) == b"payload"
    for at in (0, 9, 14, len(data) - 1):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            records.unframe(memoryview(bytes(broken)), 0)
