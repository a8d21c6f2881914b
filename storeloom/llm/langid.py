"""Language identification by a bit-sliced Bloom filter of character n-grams.

N-grams of letters and word ends are counted by language over all training
texts. A language contains an n-gram if it makes up at least ``RATE`` of the
language's n-grams and is not much rarer there than where it is most frequent.
Both are rates, so the rule is the same at every size of the corpus, and a
language contains 1 / ``RATE`` n-grams at most: that bounds the filter.

The filter is one table of positions, each with a bitmask of languages; all
languages share the positions, so the AND of a few entries gives all languages
that contain an n-gram. A text is scored in one scan: of its n-grams the ones of
each language are counted, the share that false positives explain is taken off,
and the language with the largest share wins.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from storeloom.llm.common import groups, text_of, written

ORDERS = (3, 4)
#: The least share of a language's n-grams, and of an n-gram's highest share in any language.
RATE, NEAR = 1e-5, 0.125
#: Positions for each n-gram of the language with the most, and hashes of an n-gram.
ROOM, HASHES = 16, 4
#: Languages are named by the training table; so many are a mistake in it.
MOST_LANGUAGES = 4096
UNKNOWN = "und"
#: Symbols that are hashed at a time, and n-grams that a task holds before it sends its counts.
STEP, HELD = 1 << 20, 1 << 21


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Of every code point: 2 for letters, 1 for marks, which belong to words, 0 for others."""
    kinds = {"L": 2, "M": 1}
    return np.array([kinds.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.uint8)


def _points(text: str) -> bytes:
    return text.lower().encode("utf-32-le", "surrogatepass")


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters and word ends of texts, the text of each, and which texts have a letter.

    A word end is 0. There is one before and after each word, and at the ends of each text.
    """
    held, doc, letters = [np.zeros(1, np.uint32)], [np.zeros(1, np.int32)], np.zeros(len(texts), bool)
    for some in groups(map(len, texts), STEP):
        pieces = [_points(t[i:i + STEP]) for t in texts[some] for i in range(0, len(t), STEP)] \
            if some.stop - some.start == 1 else [_points(t) + bytes(4) for t in texts[some]]
        points = np.frombuffer(b"".join(pieces), np.uint32)
        if some.stop - some.start == 1:
            points, own = np.append(points, np.uint32(0)), np.broadcast_to(np.int32(some.start), len(points) + 1)
        else:
            own = np.repeat(np.arange(some.start, some.stop, dtype=np.int32), [len(p) // 4 for p in pieces])
        kind = _kinds()[points]
        letters[own[kind == 2]] = True
        points = np.where(kind > 0, points, 0)
        first = np.ones(len(points), bool)
        first[1:] = (points[1:] != 0) | (points[:-1] != 0)
        held.append(points[first])
        doc.append(own[first])
    return np.concatenate(held), np.concatenate(doc), letters


def grams(line: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """64-bit hashes of the n-grams of symbols, and the text of each, a part at a time.

    A word end stands only at the first or last place of an n-gram, so none crosses words or texts.
    """
    for start in range(0, len(line), STEP):
        for n in ORDERS:
            part = line[start:start + STEP + n - 1].astype(np.uint64)
            size = len(part) - n + 1
            if size <= 0:
                continue
            inside = np.ones(size, bool)
            for j in range(1, n - 1):
                inside &= part[j:j + size] != 0
            at = np.flatnonzero(inside)
            h = np.full(len(at), n, np.uint64)
            for j in range(n):
                h = (h ^ part[at + j]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
            # The first symbol may be the word end that closes the text before.
            yield h.view(np.int64), doc[start + at + 1]


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    found, where = np.unique(np.concatenate([g for g, _ in held]), return_inverse=True)
    return found, np.bincount(where, np.concatenate([n for _, n in held]), len(found)).astype(np.int64)


def gram_counts(texts: DataFrame) -> DataFrame:
    """``lang``, ``gram``, ``n`` from ``lang``, ``text``: summed in each task, then by key."""
    ddl = "lang string, gram long, n long"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def out(lang: str, held: list) -> pa.RecordBatch:
        gram, n = _merged(held)
        return pa.RecordBatch.from_arrays([pa.repeat(lang, len(gram)), pa.array(gram), pa.array(n)], schema=schema)

    def run(batches):
        held: dict[str, list] = {}
        size = 0
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in dict.fromkeys(langs):
                mine = [t for own, t in zip(langs, texts) if own == lang]
                for some in groups(map(len, mine), STEP):
                    for gram, _ in grams(*symbols(mine[some])[:2]):
                        found = np.unique(gram, return_counts=True)
                        held.setdefault(lang, []).append(found)
                        size += len(found[0])
                        if size > HELD:
                            held = {k: [_merged(v)] for k, v in held.items()}
                            size = sum(len(v[0][0]) for v in held.values())
                            if size > HELD // 2:
                                yield from (out(k, v) for k, v in held.items())
                                held, size = {}, 0
        yield from (out(k, v) for k, v in held.items())

    return texts.select(F.col("lang").cast("string"), text_of().alias("text")).mapInArrow(run, ddl).groupBy(
        "lang", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Filters:
    """Languages, the one with the most n-grams first, and the masks of all positions.

    ``masks`` has a row for each 64 languages; ``false_positive`` the share of
    foreign n-grams that each language seems to contain.
    """

    languages: tuple[str, ...]
    masks: np.ndarray
    false_positive: np.ndarray


def members(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """``gram``, ``place``: the n-grams that each language contains; ``place`` numbers languages."""
    rate = F.col("n") / F.col("total")
    best = F.max("rate").over(Window.partitionBy("gram"))
    # One row for each language, its number checked.
    return (counts.join(F.broadcast(totals), "lang").select("gram", "place", rate.alias("rate"))
            .filter(F.col("rate") >= RATE).withColumn("best", best)
            .filter(F.col("rate") >= NEAR * F.col("best")).select("gram", "place"))


def _positions(gram: Column, positions: int) -> Column:
    low, high = gram.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(gram, 32).bitwiseOR(1)
    return F.array(*[(low + i * high).bitwiseAND(positions - 1).cast("int") for i in range(HASHES)])


def train(docs: DataFrame) -> Filters:
    """The filter from ``text`` and ``lang`` of all rows; null languages are no language.

    All n-grams are counted on the cluster. To the driver come one row for each
    language and the positions that are set, fewer than 2 * ``ROOM`` / ``RATE``
    (3.2 million) for each 63 languages, whatever the size of the corpus.
    Null and empty texts add nothing; repeated rows count each; an empty table
    gives a filter without languages.
    """
    spark = docs.sparkSession
    counts = written(gram_counts(docs.filter("lang IS NOT NULL")), "grams")
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("total")).limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    sizes = sorted(sizes, key=lambda r: (-r.total, r.lang.encode()))
    if not sizes:
        return Filters((), np.zeros((1, 1), np.uint8), np.zeros(0))
    totals = spark.createDataFrame([(r.lang, r.total, i) for i, r in enumerate(sizes)],
                                   "lang string, total long, place int")
    kept = written(members(counts, totals), "members")
    most = kept.groupBy("place").count().agg(F.max("count")).first()[0] or 1
    positions = 1 << (ROOM * most - 1).bit_length()
    bits = (kept.select(F.explode(_positions(F.col("gram"), positions)).alias("at"), "place")
            .groupBy("at", F.floor(F.col("place") / 63).cast("int").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, place % 63)")).alias("mask"))).toArrow()
    words = -(-len(sizes) // 63)
    masks = np.zeros((words, positions), np.uint64)
    masks[bits.column("word").to_numpy(), bits.column("at").to_numpy()] = bits.column("mask").to_numpy()
    filled = np.array([np.count_nonzero(masks[i // 63] >> np.uint64(i % 63) & np.uint64(1)) / positions
                       for i in range(len(sizes))])
    narrow = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64)
                  if words > 1 and t == np.uint64 or len(sizes) <= 8 * np.dtype(t).itemsize)
    return Filters(tuple(r.lang for r in sizes), masks.astype(narrow), filled ** HASHES)


def contained(gram: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """For each n-gram the masks of the languages that contain it, by words of languages."""
    low, high = gram & 0xFFFFFFFF, (gram.view(np.uint64) >> np.uint64(32)).astype(np.int64) | 1
    out = masks[:, low & (masks.shape[1] - 1)]
    for i in range(1, HASHES):
        out &= masks[:, (low + i * high) & (masks.shape[1] - 1)]
    return out


def shares(texts: list[str], filters: Filters) -> tuple[np.ndarray, np.ndarray]:
    """Of each text and language the corrected share of n-grams, 0 to 1, and which texts have a letter."""
    line, doc, letters = symbols(texts)
    hits, size = np.zeros((len(filters.languages), len(texts))), np.zeros(len(texts))
    for gram, of in grams(line, doc):
        size += np.bincount(of, minlength=len(texts))
        masks = contained(gram, filters.masks)
        for i in range(len(filters.languages)):
            has = masks[i // 63] >> masks.dtype.type(i % 63) & masks.dtype.type(1)
            hits[i] += np.bincount(of, has, len(texts))
    found = hits / np.maximum(size, 1)
    false = filters.false_positive[:, None]
    return np.clip((found - false) / np.maximum(1 - false, 1e-9), 0, 1), letters


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the language's corrected share of the text's n-grams.

    Only the text counts. Ties go to the language with more training n-grams,
    then the smaller name. ``und`` with 0 where the text is null or has no
    letter, or no language was learned. Repeated rows, null ids and an empty
    table stay as they are; existing columns of the two names are replaced.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(F.struct(*kept).alias("row"), text_of().alias("body"))
    ddl = StructType([*rows.schema.fields[:1], *StructType.fromDDL("lang_pred string, score double").fields])
    schema = to_arrow_schema(ddl)
    spread = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        held = spread.value
        for batch in batches:
            texts, names, scores = batch.column(1).to_pylist(), [], []
            for some in groups(map(len, texts), STEP):
                if not held.languages:
                    names, scores = names + [UNKNOWN] * (some.stop - some.start), scores + [0.0] * (some.stop - some.start)
                    continue
                share, letters = shares(texts[some], held)
                best = share.argmax(axis=0)
                names += [held.languages[b] if has else UNKNOWN for b, has in zip(best, letters)]
                scores += np.where(letters, share.max(axis=0), 0.0).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()),
                                              pa.array(scores, pa.float64())], names=schema.names)

    return rows.mapInArrow(run, ddl).select("row.*", "lang_pred", "score")


def held_out(folds: int = 5) -> Column:
    """One document in ``folds``, by the CRC-32 of its id; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))) % folds == 0


def predict(docs: DataFrame, folds: int = 5) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of every row, learned from the rows not held out.

    Defined results as in :func:`train` and :func:`identify`; other columns take no part.
    """
    filters = train(docs.filter(~held_out(folds)).select("lang", "text"))
    return identify(docs.select("doc_id", held_out(folds).alias("held_out"), "text"), filters).drop("text")
