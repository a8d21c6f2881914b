"""Operators with an exact answer against brute force, and their edge cases."""

import base64
import hashlib
import random
import tracemalloc
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from storeloom.llm import bpe, fingerprints, packing, pieces, queries, repeats, tokenstore, topk, urlfilter
from storeloom.llm.common import shared_folder

from llm_cases import ODD, repeated_bytes

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")

@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, ids string")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="module")
def texts(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    return dict(sorted((r.doc_id, r.text) for r in rows))


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_fingerprints(spark, sf, texts):
    got = {r.doc_id: r for r in queries.op1_fingerprints(spark, sf).collect()}
    ids = list(texts)
    for i, k in enumerate(ids):
        text, following = texts[k], texts[ids[(i + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert got[k].n_chars == len(text)
        assert got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[k].near_next <= 1 and 0 <= got[k].near_edited <= 1
    for a in ids:
        for b in ids[:20]:
            assert (got[a].fingerprint == got[b].fingerprint) == (texts[a] == texts[b])
    assert np.mean([r.near_edited for r in got.values()]) > 0.3 > 0.1 > np.mean([r.near_next for r in got.values()])


def test_fingerprint_order_and_updates(spark, odd, empty):
    docs = spark.createDataFrame([(1, "a\nb\nb"), (2, "b\na\nb"), (3, "a\nb"), (4, "b")], "doc_id long, text string")
    v = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    assert v[1].fingerprint == v[2].fingerprint != v[3].fingerprint
    joined = spark.createDataFrame([(v[3].vector, v[4].vector, v[1].vector)],
                                   "a array<long>, b array<long>, c array<long>")
    row = joined.select(fingerprints.combine("a", "b"), fingerprints.combine("c", "b", -1),
                        fingerprints.likeness(F.col("a"), F.col("a"))).first()
    assert (row[0], row[1], row[2]) == (v[1].vector, v[3].vector, 1.0)
    got = fingerprints.compare_edited(odd).collect()
    assert len(got) == len(ODD) and len({r.fingerprint for r in got if r.doc_id == 5}) == 1
    assert {r.n_chars for r in got if r.doc_id in (1, 2)} == {0}
    assert fingerprints.compare_edited(empty).count() == 0
    alone = fingerprints.compare_edited(docs.filter("doc_id = 1")).first()
    assert alone.near_next == 1.0


def test_topk_edges(spark):
    rows = [(0, [1.0, -0.5], "a"), (50, [0.25, 0.25, 1.0], "b"), (1, [1.0, 1.0], "c"), (2, [1.0, 1.0], "c"),
            (2, [1.0, 1.0], "c"), (3, None, "d"), (4, [1.0, None], "d"), (5, [float("nan"), 1.0], "d"),
            (None, [1.0, 1.0], "e"), (6, [], "f"), (7, [-1e30, 0.0], "g")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    asked = vectors.filter("vec_id % 50 = 0")
    got = [tuple(r) for r in topk.top_k(vectors, asked, k=5).orderBy("query_id", "rank").collect()]

    def parts(v):
        return [int(np.floor(256 * x)) for x in v]

    good = [(i, parts(v)) for i, v, _ in rows[:5]] + [(6, [])]
    want = []
    for q, a in good[:2]:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:5]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    assert got == want
    assert topk.top_k(vectors.filter("false"), asked.filter("false")).count() == 0
    small = topk.top_k(vectors, asked, k=5, block_bytes=24, task_bytes=64)
    assert sorted(map(tuple, small.collect())) == sorted(want)


def test_topk_of_large_components(spark):
    """Finite vectors of any size take part, and scores are exact beyond doubles."""
    rows = [(50, [3e5, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 2.0 ** -8]), (3, [-1e7, 1e12]), (4, [5e7, -7.5]), (5, [0.0, 2e13]),
            (6, [1e9, -2.95e14])]  # both products of the last are beyond 64 bits, their sum is not
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(vectors, vectors.filter("vec_id = 50"), k=5).orderBy("rank").collect()]
    parts = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    scored = sorted((-sum(x * y for x, y in zip(parts[50], parts[i])), i) for i in (1, 2, 3, 4, 5, 6))[:5]
    assert got == [(50, n, i, -score) for n, (score, i) in enumerate(scored, 1)]


def test_repeats_keep_genuine_replacement_characters(spark):
    same = "é" * 40
    rows = [(1, "a" + same), (2, "ab\ufffdcd" + same + "z\ufffd"), (3, "x\ufffd" + "ê" + same[1:] + "y"),
            (4, "q" + same + "ï")]  # the first byte of the last character is covered too
    out = repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 50)
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[1] == rows[0][1] and got[2] == "ab\ufffdcdz\ufffd" and got[4] == "q"
    assert got[3].startswith("x\ufffdê") and got[3].endswith("y") and len(got[3]) < 6


def test_url_edges(spark):
    urls = ["http://Example.COM/en/x", "https://www.example.com/en/", "ftp://a.b.example.com/en", "x", None, "",
            "http://com", "http://com/", "http://notexample.com/en/1", "http://a.net/es/?q#f", "http://é.net/fr/é",
            "http://net/fr/#/en/", "://host/p", "http://user@example.com:80/en/", "http://a.example.com/en/ჿff"]
    pages = spark.createDataFrame([(i // 2 if i else None, u, "h") for i, u in enumerate(urls)],
                                  "page_id long, url string, host string")
    rules = [*queries.URL_RULES, ("block", "com", "/"), ("block", None, "/"), ("allow", "net", None),
             ("block", "a.example.com", "/en/x"), ("allow", "a.example.com", "/en/")]
    got = urlfilter.judge(pages, urlfilter.rule_table(spark, rules)).collect()
    assert len(got) == len(urls)
    kept = {}
    for v, h, p in rules:
        if h and p is not None:
            kept[h, p] = max(v, kept.get((h, p), ""))

    def judge(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
        fits = [(len(h) + len(p), len(h), h + p, v) for (h, p), v in kept.items()
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits) if fits else (0, 0, None, "allow")
        return host, path, best[2], best[3]

    def order(rows):
        return sorted(rows, key=str)

    assert order((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == order(
        (i // 2 if i else None, *judge(u)) for i, u in enumerate(urls))
    assert urlfilter.judge(pages.filter("false"), urlfilter.rule_table(spark, rules)).count() == 0
    assert {r.verdict for r in urlfilter.judge(pages, urlfilter.rule_table(spark, [])).collect()} == {"allow"}


def test_pieces_match_the_libraries(reference):
    rnd = random.Random(3)
    letters = " \t\n\r  ''''stdmrvlleaéß中1²½!?-_  \x1c\x85́😀\0"
    cases = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(4000)]
    cases += ["'" * 5 + "s", "x" * 300 + " 's", " " * 200, "<|endoftext|>", ""]
    assert [i.tolist() for i in pieces.PieceEncoder(RANKS).encode(cases)] == [
        reference.encode_ordinary(c) for c in cases]
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    assert [i.tolist() for i in pieces.PieceEncoder(JSON).encode(cases[:500])] == [
        library.encode(c, add_special_tokens=False).ids for c in cases[:500]]


def test_added_tokens_match_the_library():
    mark = "<|endoftext|>"
    rnd = random.Random(4)
    cases = [f"a {mark} b", mark, mark * 3, f"{mark}x  {mark}", f" \n{mark}\n 's", "<|endoftext|", f"<|endof{mark}", ""]
    cases += ["".join(rnd.choice([mark, " ", "ab", "'s", "\n", "é1", "<|"]) for _ in range(rnd.randint(0, 20)))
              for _ in range(300)]
    library = Tokenizer.from_file(JSON)
    assert [i.tolist() for i in pieces.PieceEncoder(JSON).encode(cases)] == [
        library.encode(c, add_special_tokens=False).ids for c in cases]


def test_chunks_are_stitched(reference):
    rnd = random.Random(5)
    encoder = pieces.PieceEncoder(RANKS)
    for _ in range(800):
        letters = rnd.choice(["ab c", "ab  \n'srevl1", "  \n\t", "a", "'s're 1.,"])
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 300)))
        chunk, overlap = rnd.choice([(16, 6), (32, 8), (10, 10), (50, 4)])
        chunks = bpe.cut(text, chunk, overlap)
        whole, first = bpe.stitch(chunks, [bpe.chunk_boundaries(c) for c in chunks], chunk, overlap)
        assert whole == text and encoder.encode_at(whole, first).tolist() == reference.encode_ordinary(text)


def test_bpe(spark, sf, texts, reference, odd, empty):
    for r in queries.op4_bpe(spark, sf).collect():
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    got = bpe.decode(bpe.encode(odd, RANKS, chunk=64, overlap=8), RANKS).collect()
    assert sorted((str(r.doc_id), r.decoded.decode()) for r in got) == sorted((str(i), t or "") for i, t, _ in ODD)
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == reference.encode_ordinary(r.decoded.decode())
    assert bpe.encode(empty, RANKS).count() == 0


def test_repeats(spark, sf, texts):
    want = repeated_bytes([(i, t.encode()) for i, t in texts.items()], 50)
    got = {r.doc_id: r for r in queries.op6_suffix_dedup(spark, sf).collect()}
    assert {(i, n, g, r, hashlib.sha256(k).hexdigest()) for i, n, g, r, k in want} == {
        (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.values()}


def test_repeat_edges(spark, odd, empty):
    rnd = random.Random(1)
    phrase = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(20, 90))) for _ in range(12)]
    docs = [(rnd.randint(0, 40), "".join(rnd.choice(phrase) for _ in range(rnd.randint(0, 6)))) for _ in range(60)]
    docs += [(100, "long " * 40_000 + phrase[0]), (101, "long " * 40_000), (102, "x" * 70_000), (99, "x" * 49),
             (103, "😀" * 30), (104, "a" + "😀" * 30)] + [(i, t or "") for i, t, _ in ODD]
    frame = spark.createDataFrame([(i, t, "k") for i, t in docs], "doc_id long, text string, kept string")
    got = repeats.remove_repeats(frame).collect()
    want = repeated_bytes([(i, t.encode()) for i, t in docs], 50)
    assert sorted(((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans) // 2, bytes(r.kept)) for r in got),
                  key=str) == sorted(want, key=str)
    assert repeats.remove_repeats(empty).count() == 0
    whole = repeats.without_repeats(odd).collect()
    assert len(whole) == len(ODD) and whole[0].asDict().keys() == {"doc_id", "text", "ids"}


def test_window_groups():
    rnd = np.random.default_rng(2)
    for size in (60, 500, 3000):
        symbols = rnd.integers(1, 3, size)
        symbols[size // 2:size // 2 + 25] = symbols[:25]
        symbols = np.append(symbols, 0)
        order, group = repeats.window_groups(symbols, 20)
        held = {}
        for place, g in zip(order.tolist(), group.tolist()):
            if place + 20 <= size:
                held.setdefault(symbols[place:place + 20].tobytes(), set()).add(g)
        assert all(len(v) == 1 for v in held.values()) and len(set.union(*held.values())) == len(held)


def test_suffixes_take_few_sorts(monkeypatch):
    sorts, argsort = [], np.argsort
    monkeypatch.setattr(repeats.np, "argsort", lambda *a, **k: sorts.append(1) or argsort(*a, **k))
    symbols = np.append(np.tile(np.arange(2, 258, dtype=np.uint16), 40), np.uint16(0))
    repeats.window_groups(symbols, 50)
    # 6 symbols at first, then 12, 24, 48 and 96; one sort of the transform.
    assert len(sorts) <= 6


def test_equal_segments_are_hashed_in_parts():
    rnd = np.random.default_rng(3)
    count = rnd.integers(1, 40, 60_000)
    sizes = count + 49
    flat = rnd.integers(97, 123, int(sizes.sum())).astype(np.uint8)
    doc, anchor = np.arange(len(count)), np.arange(len(count), dtype=np.uint64)
    tracemalloc.start()
    lowest = repeats._smallest(doc, anchor, count, flat, 50)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (lowest == np.repeat(doc, count)).all()
    assert peak < 16 * len(flat)


def _check_pieces(rows, ids, window=1024):
    placed, sequences = {}, {}
    for doc, start, part, total, sequence, offset in rows:
        placed.setdefault(doc, []).append((start, part, total))
        sequences.setdefault(sequence, []).append((offset, len(part)))
    for held in sequences.values():
        end = 0
        for offset, size in sorted(held):
            assert offset == end and size
            end += size
        assert end == window or end & (end - 1) == 0 and end < window
    for doc, parts in placed.items():
        parts.sort(key=lambda p: p[0])
        assert [p[0] for p in parts] == np.cumsum([0, *[len(p[1]) for p in parts]])[:-1].tolist()
        assert np.concatenate([p[1] for p in parts]).tolist() == ids[doc] and parts[0][2] == len(ids[doc])
    assert placed.keys() == ids.keys()


def test_packing(spark, sf, texts, empty):
    library = Tokenizer.from_file(JSON)
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t in texts.items()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(3)
    rows = packing.pack(docs, JSON).collect()
    _check_pieces([(r.doc_id, r.start, np.frombuffer(r.ids, "<u4"), r.doc_tokens, r.sequence_id, r.offset)
                   for r in rows], ids)
    for r in queries.op7_packing(spark, sf).collect():
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4")
        assert zlib.crc32(part.tobytes()) == r.ids_crc32 and len(part) == r.length
    assert packing.pack(empty, JSON).count() == 0


def test_packing_edges_and_rule(spark, odd):
    rows = packing.pack(odd.filter("doc_id IN (1, 2)"), JSON, window=8, stop_id=3).collect()
    assert sorted((r.doc_id, r.start, bytes(r.ids), r.doc_tokens) for r in rows) == [
        (1, 0, b"\3\0\0\0", 1), (2, 0, b"\3\0\0\0", 1)]
    assert len({(r.sequence_id, r.offset) for r in packing.pack(odd, JSON, window=8).collect()}) > len(ODD)
    packer, rnd = packing.Packer(64), random.Random(4)
    for _ in range(300):
        size = rnd.randint(1, 63)
        counts = packer.counts.copy()
        level = packer.level_for(size)

        def cost(h):
            after = counts.copy()
            after[h] -= bool(h)
            after[h + size] += h + size < 64
            return int((after[1:64].astype(int) ** 2).sum())

        usable = [0, *[h for h in range(1, 65 - size) if counts[h]]]
        assert cost(level) == min(map(cost, usable)) and level in usable
        list(packer.add(0, np.zeros(size, np.uint32)))


def test_token_store(spark, sf, texts, odd, empty):
    library, start = Tokenizer.from_file(JSON), 0
    got = {r.doc_id: r for r in queries.op8_token_store(spark, sf).collect()}
    for i, t in texts.items():
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) == len(texts)
    store = tokenstore.write(odd, JSON, f"{shared_folder(spark)}/odd-{uuid.uuid4().hex}", shard_ids=6)
    rows = store.read_all().collect()
    assert len(rows) == len(ODD) and sorted(r.copy for r in rows if r.doc_id == 5) == [0, 1]
    keys = spark.createDataFrame([(5,), (7,), (8,), (None,), (5,), (-1,)], "doc_id long")
    found = {r.doc_id: r for r in store.lookup(keys).collect()}
    assert found.keys() == {5, 7}
    text = dict((i, t) for i, t, _ in ODD)
    for i, r in found.items():
        assert np.frombuffer(r.ids, "<u4").tolist() == [*library.encode(text[i], add_special_tokens=False).ids, 2]
    assert tokenstore.write(empty, JSON, f"{shared_folder(spark)}/none-{uuid.uuid4().hex}").read_all().count() == 0


def test_perfect_hash():
    rnd = np.random.default_rng(1)
    keys = np.unique(rnd.integers(0, 1 << 64, (5000, 2), dtype=np.uint64), axis=0)
    made = tokenstore.PerfectHash.build(keys)
    assert sorted(made.slots(keys).tolist()) == list(range(len(keys)))
