"""Merkle manifest, filter audit and language identification against brute force."""

import hashlib
import re
import unicodedata
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from storeloom.llm import audit, langid, merkle
from storeloom.llm import queries as registered
from llm_cases import ODD

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["tree", "lo", "hi", "of", "digest", "steps", "root", "bucket", "level", "part", "mask", "shard", "words",
         "row", "body", "lang_pred", "score", "gram", "place", "at", "n", "held_out", "word", "row_ends", "good"]


def _docs(spark, rows):
    """Rows with columns whose names the operators use too."""
    return spark.createDataFrame(rows, DOCS).select("*", *[F.lit("own").alias(c) for c in CLASH])


def _hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    n_chars = None if n_chars is None else n_chars + more
    return _hash(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_hash(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def _siblings(levels, at):
    out = []
    for level in levels[:-1]:
        other = at ^ 1
        out.append((level[other] if other < at else "", level[other] if at < other < len(level) else ""))
        at //= 2
    return out


def _manifest(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, _leaf(row), row))
    trees = {lang: sorted(v, key=lambda x: x[:3]) for lang, v in trees.items()}
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    levels = {lang: _levels([x[2] for x in trees[lang]]) for lang in order}
    top = _levels([levels[lang][-1][0] for lang in order])
    out = []
    for n, lang in enumerate(order):
        for at, (_, _, leaf, row) in enumerate(trees[lang]):
            steps = _siblings(levels[lang], at) + _siblings(top, n)
            struck = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = _leaf(row, 1) if struck else leaf
            for left, right in steps:
                node = _hash(left, node, right)
            out.append((row[0], leaf, levels[lang][-1][0], top[-1][0], _hash(*[x + y for x, y in steps]), node,
                        node == top[-1][0]))
    return out


def _sorted(rows):
    return sorted(map(tuple, rows), key=str)


MERKLE = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("rows", [
    [], [(14, "x", "en", "s", 1)],
    [(i, t, None if n % 3 == 0 else f"l{n % 3}", s, None if n % 2 else n) for n, (i, t, s) in enumerate(ODD)],
    [(i, f"text {i}", "é" if i % 5 else "z", "s", i) for i in range(131)]])
def test_merkle(spark, rows):
    assert _sorted(merkle.verify_tampered(_docs(spark, rows)).select(MERKLE).collect()) == _sorted(_manifest(rows))


def test_merkle_of_several_strata(spark):
    """More than 64 * 64 leaves in one language, one leaf in others."""
    rows = [(i, "t", "hot" if i < 4200 else f"l{i}", None, i) for i in range(4270)]
    assert _sorted(merkle.verify_tampered(_docs(spark, rows)).collect()) == _sorted(_manifest(rows))


def test_merkle_nodes(spark):
    rows = [(i, "t", "a" if i < 70 else None, None, i) for i in range(71)]
    got = {(r.lang, r.level, r.lo, r.hi): r.digest for r in merkle.nodes(_docs(spark, rows)).collect()}
    levels = _levels([_leaf(r) for r in rows[:70]])
    want = {("a", k, i << k, min((i + 1) << k, 70) - 1): d for k, level in enumerate(levels) for i, d in enumerate(level)}
    assert got == want | {(None, 0, 0, 0): _leaf(rows[70])}


# --- filter audit ------------------------------------------------------------

LONG = " ".join(f"w{i}" for i in range(400))
AUDITED = [(1, LONG, "a"), (2, LONG, None), (3, "w " * 500, "a"), (4, None, "a"), (5, "", ""), (6, "AB " + LONG, "a"),
           (7, LONG + " #", "b"), (7, LONG + " #", "b"), (8, "A#" * 5000, "a"), (None, LONG, "a"), (None, "x", None),
           (9, "\x0b é\x1c b \t" + LONG, "b"), (10, "W" * 3000 + " " + "ß" * 9, "a"), (11, "w " * 500, "a")]


def _audit(rows, labels):
    first, out = {}, {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    good, toxic = ({i for i, *v in labels if i is not None and v[n] == 1} for n in (0, 1))
    failed = []
    for i, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        marks = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search("[#$%&*|]", text)),
                 "E": i is not None and first.get(text, i) < i}
        failed.append((source or "", {k for k, v in marks.items() if v}, i in good, i in toxic))
    for part in {p for p, *_ in failed}:
        mine = [x for x in failed if x[0] == part]
        removed, shapley = {}, Counter()
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                before = set(order[:step - 1])
                at = [x for x in mine if f in x[1] and not before & x[1]]
                shapley[f] += len(at)
                out[part, order, step] = [
                    sum(not (before | {f}) & x[1] for x in mine), len(at),
                    sum(f in x[1] and bool(before & x[1]) for x in mine), sum(x[1] == {f} for x in mine),
                    sum(x[2] for x in at), sum(x[3] for x in at)]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return out


@pytest.mark.parametrize("rows", [AUDITED, [], AUDITED[4:5]])
def test_audit(spark, rows):
    labels = [(1, 1, 0), (1, 0, None), (6, 1, 1), (7, None, 1), (None, 1, 1), (99, 1, 1), (4, 1, 0)]
    docs = _docs(spark, [(i, t, None, s, None) for i, t, s in rows]).repartition(3)
    got = audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    found = {tuple(r)[:3]: list(r)[3:] for r in got.collect()}
    assert found == _audit(rows, labels)
    assert len(found) == 600 * len({s or "" for _, _, s in rows})


def test_term_matrix(spark, monkeypatch):
    """Small shards: their word numbers are the same in all of them."""
    monkeypatch.setattr(audit, "SHARD", 5000)
    monkeypatch.setattr(audit, "STEP", 2000)
    monkeypatch.setattr(audit, "NUMBERED", 50)
    rows = [(n, t, None, s, None) for n, (_, t, s) in enumerate(AUDITED)]
    docs = _docs(spark, rows).repartition(3)
    words, seen = {}, {}
    shards = audit.term_matrix(docs).collect()
    assert len(shards) > 3
    for shard in shards:
        held = shard.asDict()
        ends, columns, counts = audit.csr_of(held)
        for i, begin, end in zip(held["ids"], np.concatenate([[0], ends[:-1]]), ends):
            assert (np.diff(columns[begin:end]) > 0).all()
            seen[i] = dict(zip(columns[begin:end].tolist(), counts[begin:end].tolist()))
    for n, t, *_ in rows:
        want = Counter(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        assert sorted(want.values()) == sorted(seen[n].values())
        for number in seen[n]:
            words.setdefault(number, set()).add(n)
    holders = {}
    for n, t, *_ in rows:
        for w in set(re.findall(r"[^\x20\x09-\x0D]+", t or "")):
            holders.setdefault(w, set()).add(n)
    assert sorted(map(sorted, words.values())) == sorted(map(sorted, holders.values()))


# --- language identification ---------------------------------------------------

def _grams(text):
    kinds = [unicodedata.category(c)[0] for c in text.lower()]
    words = "".join(c if k in "LM" else " " for c, k in zip(text.lower(), kinds)).split(" ")
    return Counter(f" {w} "[i:i + n] for w in words if w for n in langid.ORDERS for i in range(len(w) + 3 - n))


def _sets(rows):
    counts, totals, best = {}, Counter(), Counter()
    for text, lang in rows:
        if lang is not None:
            counts.setdefault(lang, Counter()).update(_grams(text or ""))
    for lang, c in counts.items():
        totals[lang] = c.total()
        for g, n in c.items():
            best[g] = max(best[g], n / totals[lang])
    return totals, {lang: {g for g, n in c.items() if n / totals[lang] >= max(langid.RATE, langid.NEAR * best[g])}
                    for lang, c in counts.items()}


def test_language_against_exact_sets(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.collect()
    out = {r.doc_id: r for r in registered.op12_language_id(spark, sf).collect()}
    assert len(out) == len(rows)
    kept = [(r.text, r.lang) for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5]
    totals, sets = _sets(kept)
    right = held = 0
    for r in rows:
        got, grams = out[r.doc_id], _grams(r.text)
        assert got.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        share = {lang: sum(n for g, n in grams.items() if g in s) / max(1, grams.total()) for lang, s in sets.items()}
        first, second = sorted(share.values(), reverse=True)[:2]
        if grams:
            assert abs(got.score - share[got.lang_pred]) < 0.02
            assert first - second < 0.02 or share[got.lang_pred] == first
        held += got.held_out
        right += got.held_out and got.lang_pred == r.lang
    assert right >= 0.95 * held > 0


def test_language_edges(spark):
    train = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "en"), (4, "", "fr"),
             (5, "der hund", None), (6, "हिन्दी भाषा", "hi"), (7, "кошка и собака", "ru"), (8, "中文文字", "zh")]
    filters = langid.train(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    assert set(filters.languages) == {"en", "fr", "hi", "ru", "zh"}
    asked = [(1, "The DOG"), (2, "chien, chat!"), (3, None), (4, ""), (5, "12 + 3 -- ?"), (6, "भाषा"), (7, "собака"),
             (8, "中文"), (None, "the cat"), (9, "le " * 50_000), (9, "le " * 50_000)]
    got = langid.identify(_docs(spark, [(i, t, None, None, None) for i, t in asked]), filters)
    assert got.columns.count("lang_pred") == got.columns.count("score") == 1 and set(CLASH) <= set(got.columns)
    rows = got.collect()
    assert sorted((str(r.doc_id), r.lang_pred) for r in rows) == sorted(zip(
        map(str, [1, 2, 3, 4, 5, 6, 7, 8, None, 9, 9]),
        ["en", "fr", "und", "und", "und", "hi", "ru", "zh", "en", "fr", "fr"]))
    assert all(0 <= r.score <= 1 and (r.lang_pred != "und" or r.score == 0) and r.tree == "own" for r in rows)
    # Nothing learned, and nothing asked.
    none = langid.train(spark.createDataFrame([(1, "x", None)], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in langid.identify(_docs(spark, [(1, "abc", None, None, None)]), none).collect()} == {"und"}
    assert langid.predict(_docs(spark, [])).collect() == []


def test_many_languages(spark):
    """More languages than bits in a word of the filter."""
    rows = [(i, " ".join(chr(0x4E00 + 50 * i + j) * 2 for j in range(30)), f"l{i:03}") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = langid.identify(docs, langid.train(docs)).collect()
    assert all(r.lang == r.lang_pred for r in out)


def test_long_texts_in_parts(monkeypatch):
    """Parts of any size give the n-grams of the whole text."""
    texts = ["the quick,  brown fox; " * 40 + "é̃ " * 7, "", "  ", "abc" * 200, "x", "end "]
    alone = [[x for g, _ in langid.grams(*langid.symbols([t])[:2]) for x in g.tolist()] for t in texts]
    want = [Counter(g) for g in alone]
    for step in (1 << 20, 64, 7):
        monkeypatch.setattr(langid, "STEP", step)
        got = [Counter() for _ in texts]
        for gram, doc in langid.grams(*langid.symbols(texts)[:2]):
            for g, d in zip(gram.tolist(), doc.tolist()):
                got[d][g] += 1
        assert got == want
    assert [c.total() for c in want] == [_grams(t).total() for t in texts]
    assert langid.symbols(texts)[2].tolist() == [True, False, False, True, True, True]
