"""Near-duplicate operators, the classifier and the pipeline against brute force."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from storeloom.llm import buckets, components, lines, neardup, quality, queries

from llm_cases import ODD, repeated_bytes


def _groups(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)]
    links += [(rnd.randint(200, 260), rnd.randint(200, 260)) for _ in range(40)] + [(5, 5), (7, None)]
    frame = spark.createDataFrame(links, "a long, b long").repartition(3)
    got = {r.id: r.component for r in components.components(frame).collect()}
    real = [(a, b) for a, b in links if b is not None and a != b]
    assert got == _groups({n for link in real for n in link}, real)
    assert components.components(frame.filter("false")).count() == 0


def _shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def _check_near(rows, docs, percent):
    sets = [(i, _shingles(t)) for i, t in docs]
    links = [(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2) if a is not None and b is not None
             and x and y and 100 * len(x & y) >= percent * len(x | y)]
    found = _groups({i for i, _ in docs if i is not None}, links)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows), key=str) == sorted(
        ((i, len(s), found.get(i), i is None or found[i] == i) for i, s in sets), key=str)


def test_near_duplicates(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    _check_near(queries.op10_minhash(spark, sf).collect(), docs, 85)


def test_near_edges(spark):
    rnd = random.Random(6)
    base = [f"w{rnd.randint(0, 10 ** 6)}" for _ in range(120)]
    docs = [(i, t) for i, t, _ in ODD]
    for i in range(40):  # a chain: each differs from the next in one word
        words = list(base)
        words[:i] = [f"x{j}" for j in range(i)]
        docs.append((200 + i, " ".join(words)))
    docs += [(300, "a b c"), (301, "A  b\tC"), (302, "a b"), (5, " ".join(base)), (303, " \n\t ")]
    rnd.shuffle(docs)
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, component_id int")
    _check_near(neardup.near_duplicates(frame).collect(), docs, 85)
    assert neardup.near_duplicates(frame.filter("false")).count() == 0
    kept = neardup.keep_representatives(frame).collect()
    assert len({r.doc_id for r in kept if r.doc_id is not None}) == len([r for r in kept if r.doc_id is not None])


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


def _norm(line):
    return " ".join("".join(c if c.isalpha() or c.isnumeric() else " " for c in line.lower()).split())


def _removed(spark, docs, percent=80):
    """Line numbers to remove per row, from the edit similarity of all pairs of lines; text hashes from Spark."""
    norms = sorted({n for _, t in docs for n in map(_norm, (t or "").split("\n")) if n})
    texts = spark.createDataFrame([(t or "",) for _, t in docs], "t string").selectExpr("t", "xxhash64(t) AS h")
    text_hash = {r.t: r.h for r in texts.collect()}
    frame = spark.createDataFrame([(n,) for n in norms], "n string").repartition(8)
    pairs = frame.selectExpr("n AS x", "char_length(n) AS p").crossJoin(frame.selectExpr("n AS y", "char_length(n) AS q"))
    allowed = f"cast(greatest(p, q) * {100 - percent}L div 100 AS int)"
    links = [tuple(r) for r in pairs.filter(f"x < y AND abs(p - q) <= {allowed} AND levenshtein(x, y, {allowed}) >= 0")
             .select("x", "y").collect()]
    group = _groups(norms, links)
    places = {}
    for i, t in {(i, t or "") for i, t in docs}:
        for no, line in enumerate(t.split("\n")):
            if _norm(line):
                places.setdefault(group[_norm(line)], []).append(((i is not None, i, text_hash[t], no), (i, t)))
    out = {(i, t or ""): set() for i, t in docs}
    for held in places.values():
        for place, row in sorted(held)[1:]:
            out[row].add(place[3])
    return out, links


def test_lines(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want, links = _removed(spark, docs)
    got = {r.doc_id: r for r in queries.op5_line_dedup(spark, sf).collect()}
    assert links and {i: sorted(v) for (i, _), v in want.items()} == {i: r.removed for i, r in got.items()}
    assert all(got[i].n_lines == len(t.split("\n")) for i, t in docs)


def test_line_edges(spark):
    rnd = random.Random(8)
    base = [f"word{rnd.randint(0, 10 ** 6)}" for _ in range(150)]
    docs = [(i, t) for i, t, _ in ODD] + [(20, "\n\n  \n--\n"), (21, "One LINE, here\none line here!\n"),
                                          (22, " ".join(base)), (23, " ".join(["x", *base[1:]])),
                                          (24, "lead\n" + " ".join([*base[:-1], "y"])), (25, "a\na\nb")]
    frame = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, no int").repartition(2)
    want, links = _removed(spark, docs)
    got = lines.repeated_lines(frame).collect()
    hashes = {r.h: r.t for r in frame.selectExpr("xxhash64(coalesce(text, '')) AS h", "coalesce(text, '') AS t").collect()}
    assert links and {(r.doc_id, hashes[r.th]): set(r.removed) for r in got} == want
    kept = lines.remove_repeated_lines(frame).collect()
    assert len(kept) == len(docs)
    assert next(r.text for r in kept if r.doc_id == 25) == "a\nb"
    assert next(r.text for r in kept if r.doc_id == 1) is None
    assert lines.repeated_lines(frame.filter("false")).count() == 0


def test_simhash_of_very_long_lines(spark):
    hashes = [random.Random(9).getrandbits(64) - (1 << 63) for _ in range(40_000)]
    rows = spark.createDataFrame([(hashes,), (hashes[:127],), (hashes[:128],), (hashes[:16_383],)], "h array<long>")
    got = [r.s for r in lines.with_simhash(rows, "h", "s").collect()]

    def majority(held):
        value = sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in held) > len(held))
        return value - (1 << 64) if value >> 63 else value

    most = lines.MOST
    whole = majority([majority(hashes[i:i + most]) for i in range(0, len(hashes), most)])
    assert got == [whole, *[majority(hashes[:n]) for n in (127, 128, 16_383)]]


@pytest.mark.parametrize("size", [16_384, 32_768])
def test_simhash_takes_the_words_beyond_whole_runs(spark, size):
    bits = random.Random(3)
    hashes = [bits.getrandbits(64) - (1 << 63) for _ in range(size)]
    rows = spark.createDataFrame([(hashes,)], "h array<long>")
    got = lines.with_simhash(rows, "h", "s").first().s & ((1 << 64) - 1)

    def majority(held):
        return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in held) > len(held))

    runs = [hashes[i:i + lines.MOST] for i in range(0, size, lines.MOST)]
    assert len(runs) == size // 16_384 + 1 and got == majority([majority(r) for r in runs])


def test_lines_by_edit_similarity_alone(spark, sf):
    """Links against brute force that knows no SimHash and no sketch, on short lines and with a word changed."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    norms = sorted({_norm(x) for r in docs for x in (r.text or "").split("\n")} - {""})
    rnd = random.Random(12)
    plain = [n for n in norms if len(n) < 90][:150]
    changed = ["hello", "hallo", "abcdefghij", "abcdxfghij", "one two three four", "one two three five"]
    for n in plain:
        held = n.split(" ")
        if len(held) > 3:
            held[rnd.randrange(len(held))] = rnd.choice("pqvxz") * 3
            changed.append(" ".join(held))
    texts = sorted({*plain, *changed})
    pairs = [(a, b) for a, b in itertools.combinations(texts, 2)
             if abs(len(a) - len(b)) * 5 <= max(len(a), len(b)) and _distance(a, b) * 5 <= max(len(a), len(b))]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = sum(not r.removed for r in lines.repeated_lines(frame).collect())
    want = len(set(_groups(texts, pairs).values()))
    # Each missed link may keep one line more; no line may go without a link.
    assert len(pairs) > 100 and want <= kept <= want + 0.05 * len(pairs)


def test_edit_distances_are_counted_after_the_repartition(spark, monkeypatch):
    """Before it there are few tasks, and what a filter there trims is worked out once for each place it is used in."""
    plans = []

    def kept(df, name, write=lines.written):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(lines, "written", kept)
    frame = spark.createDataFrame([(1, "one two three four"), (2, "one two three five"), (3, "six")], "doc_id long, text string")
    assert {r.doc_id: r.removed for r in lines.repeated_lines(frame).collect()} == {1: [], 2: [0], 3: []}
    plans = [p for p in plans if "levenshtein" in p]
    assert plans and all(p.rindex("levenshtein") < p.index("Repartition") for p in plans)


def test_bounds_of_edit_distances(spark):
    """Counts of letters are never above the distance, cuts never below it, and near copies are cut near it."""
    rnd = random.Random(21)
    texts = []
    for i in range(40):
        x = [rnd.choice("abc d\u00e9\u4e2d" if i % 2 else "etaoin shrdlu") for _ in range(rnd.randint(128, 420))]
        y = list(x)
        for _ in range(rnd.randint(0, 12)):
            at = rnd.randrange(len(y))
            y[at:at + rnd.randint(0, 9)] = rnd.choices("xyz ", k=rnd.randint(0, 9))
        texts.append(("".join(x), "".join(y) + "q" * 128))
    texts += [("ab" * 200, "ba" * 200), ("a" * 200, "b" * 200), ("a" * 128, "a" * 300)]
    rows = spark.createDataFrame(texts, "x string, y string")
    rows = lines.with_letters(rows, "x").withColumnRenamed("letters", "p")
    rows = lines.with_letters(rows, "y").withColumnRenamed("letters", "q")
    got = rows.select("x", "y", "p", lines.least_distance("p", "q").alias("least")).selectExpr(
        "*", "levenshtein(x, y) AS d", f"{lines._cut_distance('x', 'y', '300')} AS cut").collect()
    assert all(sum(r.p) == len(r.x) and r.p[5] == r.x.count("e") for r in got)
    assert all(r.least <= r.d and (r.cut >= r.d or r.d > 300 < r.cut) for r in got)
    assert sum(r.cut <= r.d + 20 for r in got) > 30


def test_pairs_of_other_letters_get_no_edit_distance(spark, monkeypatch):
    """Lines that meet in n-grams alone were all judged by their distance."""
    judged = []

    def kept(df, name, write=lines.written):
        out = write(df, name)
        if name.endswith("-judged"):
            judged.append(out.count())
        return out

    monkeypatch.setattr(lines, "written", kept)
    same = "thequickbrownfoxjumpsoverthelazydogandthenitrests"
    rows = [(i, f"{same} {c * 60}") for i, c in enumerate("abcdefgh")] + [(8, f"{same} {'a' * 59}b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.removed for r in lines.repeated_lines(frame).collect()}
    assert got == {i: [0] if i == 8 else [] for i in range(9)}
    assert sum(judged) == 1


def test_keys_are_shuffled_once(spark, monkeypatch):
    """They were counted in one shuffle and joined with the counts in a second."""
    plans = {}

    def kept(df, name, write=buckets.written):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(buckets, "written", kept)
    frame = spark.createDataFrame([(1, "one two three four"), (2, "one two three five")], "doc_id long, text string")
    assert lines.repeated_lines(frame).count() == 2
    assert "Window" in plans["lines-crowd"] and "Join" not in plans["lines-crowd"]


def test_sketches_of_bytes_and_characters_agree(spark):
    texts = [("the quick brown fox jumps over it " * 5,), ("short lines, too",), ("thirty characters or a few more",)]
    rows = spark.createDataFrame(texts, "t string")
    wide = "transform(regexp_extract_all({}, '(?s)(?=(.{{{}}}))', 1), g -> hash(g))"
    for r in rows.select("t", lines.sketch("t", "char_length(t)").alias("s"), *[
            F.expr(f"slice(sort_array(array_distinct({wide.format('t', w)})), 1, {lines.SMALLEST})").alias(f"w{w}")
            for _, w in lines.SKETCHES if w]).collect():
        held = [x for x in r.s if x]
        assert held and all(x in (r.w3, r.w5, r.w8, r.w12) for x in held)


@pytest.fixture(scope="module")
def trusted(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1 AND toxic = 0")
    return [r.text for r in docs.join(good, "doc_id").collect()]


def test_model_is_kneser_ney(spark, trusted):
    order = 3
    counts = {}
    for text in trusted:
        for g in quality.grams(text, order).tolist():
            counts[g] = counts.get(g, 0) + 1
    frame = spark.createDataFrame([(t,) for t in trusted], "text string")
    table = quality.bits(quality.train(frame, order), order)
    assert np.allclose(np.exp2(-table.astype(np.float64)).reshape(-1, quality.SYMBOLS).sum(axis=1), 1, atol=1e-4)

    levels = {order: counts}
    for level in range(order - 1, 0, -1):
        shorter = {}
        for g in levels[level + 1]:
            shorter[g % 32 ** level] = shorter.get(g % 32 ** level, 0) + 1
        levels[level] = shorter

    def discounts(held):
        n = [sum(1 for c in held.values() if c == i) for i in (1, 2, 3, 4)]
        if min(n) == 0:
            return [0.5, 1.0, 1.5]
        y = n[0] / (n[0] + 2 * n[1])
        return [max(0.0, i - (i + 1) * y * n[i] / n[i - 1]) for i in (1, 2, 3)]

    def p(gram, level):
        if level == 0:
            return 1 / 32
        held, cut = levels[level], discounts(levels[level])
        context = [(g, c) for g, c in held.items() if g // 32 == gram // 32]
        lower = p(gram % 32 ** (level - 1), level - 1)
        if not context:
            return lower
        total, count = sum(c for _, c in context), held.get(gram, 0)
        own = max(0.0, count - (min(cut[min(count, 3) - 1], count) if count else 0))
        return own / total + sum(min(cut[min(c, 3) - 1], c) for _, c in context) / total * lower

    for gram in [*list(counts)[:40], 0, 31 * 32 * 32 + 5, 32 ** 3 - 1]:
        assert table[gram] == pytest.approx(-np.log2(p(gram, order)), rel=1e-4)


def test_classifier_keeps_good_and_rejects_bad(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    # Held out: trained on even ids, judged on odd ones.
    judged = quality.classify(docs, labels.filter("doc_id % 2 = 0"))
    rows = judged.filter("doc_id % 2 = 1").join(labels, "doc_id").collect()
    good = [r.rejected for r in rows if r.quality == 1 and r.toxic == 0]
    bad = [r.rejected for r in rows if r.quality == 0]
    assert len(good) > 1000 and np.mean(good) < 0.03 and len(bad) > 150 and np.mean(bad) > 0.75


def test_classifier_edges(spark):
    docs = spark.createDataFrame([(i, t, lang, 0.5) for (i, t, _), lang in zip(ODD, ["en", None, "en", "xx"] * 2)],
                                 "doc_id long, text string, lang string, bits double")
    marks = [(5, 1, 0), (5, 1, 0), (3, None, None), (None, 1, 0), (99, 1, 0), (7, 1, 1)]
    # Plain texts to learn from.
    plain = [(1000 + i, f"text here is number {i}", "en", 0.5) for i in range(40)]
    docs = docs.unionByName(spark.createDataFrame(plain, docs.schema))
    labels = spark.createDataFrame(marks + [(i, 1, 0) for i, *_ in plain], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(ODD) + len(plain)
    assert all(not r.rejected for r in got if r.doc_id in (1, 2)) and next(r.rejected for r in got if r.doc_id == 9)
    assert all(not r.rejected for r in quality.classify(docs, labels.filter("false")).collect())
    assert quality.classify(docs.filter("false"), labels).count() == 0
    kept = quality.keep_good(docs, labels).collect()
    assert len(kept) == sum(not r.rejected for r in got) and {r.bits for r in kept} == {0.5}


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    rejected = {r.doc_id for r in quality.classify(docs, labels).filter("rejected").collect()}

    def run(name, frame):
        out = stages[name](spark, frame, sf)
        rows = out.collect()
        assert name == "packing" or out.columns == columns
        return rows, spark.createDataFrame(rows, out.schema).repartition(2)

    rows, frame = run("quality", docs)
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()} - rejected and rejected
    before = {r.doc_id: r.text for r in rows}
    rows, frame = run("lines", frame)
    want, _ = _removed(spark, list(before.items()))
    assert {r.doc_id: r.text for r in rows} == {
        i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone) for (i, t), gone in want.items()}
    assert all(r.n_chars == len(r.text) for r in rows)
    near = {r.doc_id: r.kept for r in neardup.near_duplicates(frame, percent=80).collect()}
    rows, frame = run("near_duplicates", frame)
    assert {r.doc_id for r in rows} == {i for i, kept in near.items() if kept}
    cut = {i: k.decode("utf-8", "ignore") for i, _, _, _, k in repeated_bytes(
        sorted((r.doc_id, r.text.encode()) for r in rows), 50)}
    rows, frame = run("passages", frame)
    assert {r.doc_id: r.text for r in rows} == cut
    rows, _ = run("packing", frame)
    assert {r.doc_id for r in rows} == set(cut)


def test_model_tells_all_bytes_apart(spark):
    """Scores against Kneser-Ney by brute force over bytes, in scripts that a folded alphabet cannot tell apart."""
    order = 4
    texts = ["мир и дом", "дом и мир", "дом мир дом", "ABBA 1221", "ABBA 3443", "abba", "мир" * 5, "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    good = spark.createDataFrame([(0,), (1,), (3,), (5,)], "doc_id long")
    got = {r.doc_id: r.bits for r in quality.perplexity(docs, good, order).collect()}

    def grams(text):
        data = b" " * (order - 1) + text.encode()
        return [data[i:i + order] for i in range(len(data) - order + 1)]

    levels = {order: {}}
    for i in (0, 1, 3, 5):
        for g in grams(texts[i]):
            levels[order][g] = levels[order].get(g, 0) + 1
    for level in range(order - 1, 0, -1):
        levels[level] = {}
        for g in levels[level + 1]:
            levels[level][g[1:]] = levels[level].get(g[1:], 0) + 1

    def discounts(held):
        n = [sum(c == i for c in held.values()) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if min(n) else 0
        return [max(0.0, i - (i + 1) * y * n[i] / n[i - 1]) if min(n) else i / 2 for i in (1, 2, 3)]

    def p(gram):
        if not gram:
            return 1 / 256
        held = levels[len(gram)]
        cut = discounts(held)
        context = [c for g, c in held.items() if g[:-1] == gram[:-1]]
        if not context:
            return p(gram[1:])
        count = held.get(gram, 0)
        own = count - min(cut[min(count, 3) - 1], count) if count else 0
        rest = sum(min(cut[min(c, 3) - 1], c) for c in context)
        return (own + rest * p(gram[1:])) / sum(context)

    for i, text in enumerate(texts):
        want = -np.mean([np.log2(p(g)) for g in grams(text)]) if text else None
        assert got[i] == (None if want is None else pytest.approx(want, rel=1e-5))
    # Other letters of the same script and case are another text.
    assert got[6] < got[2] + 4 and got[3] < got[4]


@pytest.mark.parametrize("order", [2, 6])
def test_blocks_say_what_the_tables_say(spark, sf, order):
    """All orders inside buckets against the joins of tables by n-gram."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(150).repartition(3)
    good = docs.filter("doc_id % 3 > 0").select("doc_id")
    texts, rows = {r.doc_id: r.text for r in docs.collect()}, {}
    for i, text in texts.items():
        for g in quality.byte_grams(text, order).tolist():
            rows[g] = rows.get(g, 0) + (i % 3 > 0)
    asked = spark.createDataFrame(list(rows.items()), "gram long, n long")
    p = {r.gram: r.p for r in quality.probabilities(asked, order).collect()}
    want = {i: np.mean([-np.log2(p[g]) for g in quality.byte_grams(t, order).tolist()]) for i, t in texts.items() if t}
    got = {r.doc_id: r.bits for r in quality.perplexity(docs, good, order).collect()}
    assert len(want) > 100 and {i: got[i] for i in want} == pytest.approx(want, rel=1e-5)


def test_texts_are_scored_where_they_were_written(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    scored = quality.perplexity(docs, docs.select("doc_id"))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    # What the model says is shuffled to the shards, their texts are not.
    assert plan.count("Exchange hashpartitioning(shard") == 1
    shards = quality._shards(docs, ["doc_id"])
    asked = quality._asked(shards, docs.select("doc_id"), 6)
    assert asked.count() <= shards.count() * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_shards_are_held_in_parts(spark, monkeypatch):
    monkeypatch.setattr(quality, "PART", 1000)
    docs = spark.createDataFrame([(i, "abcd " * 40) for i in range(40)], "doc_id long, text string").coalesce(1)
    shards = quality._shards(docs, ["doc_id"]).collect()
    assert len({r.shard for r in shards}) == 1 and len({r.part for r in shards}) == 8
    assert sorted(i for r in shards for i in r.ids) == list(range(40)) and {len(r.ids) for r in shards} == {5}
    # A shard still asks as one, and each of its parts is scored.
    asked = quality._asked(quality._shards(docs, ["doc_id"]), docs.select("doc_id"), 6)
    assert asked.groupBy("bucket", "shard").count().filter("count > 1").count() == 0
    assert {r.doc_id for r in quality.perplexity(docs, docs.select("doc_id")).collect()} == set(range(40))


def test_no_discount_is_zero(spark):
    """With copies many more n-grams occur four times than thrice, and the estimated third discount is below 0.

    Contexts of such n-grams would leave nothing to those that were not seen.
    """
    counts = [(1,)] * 10 + [(2,)] * 5 + [(3,)] * 2 + [(4,)] * 10
    got = quality._discounts(spark.createDataFrame(counts, "n long")).first()
    # 1 - 2 * 0.5 * 5 / 10, 2 - 3 * 0.5 * 2 / 5 and the fallback.
    assert tuple(got) == pytest.approx((0.5, 1.4, 1.5))
