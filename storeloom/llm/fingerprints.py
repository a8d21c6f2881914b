"""Homomorphic multiset fingerprints of documents.

A document is the multiset of its paragraphs, cut at line breaks and, within a
line, after sentence marks. Each paragraph is hashed to a wide vector and the
vectors are summed, every lane modulo a power of two. So order does not matter,
and a paragraph is inserted or deleted by adding or subtracting its vector.

The vector has ``WIDE`` uniform lanes of 31 bits, which tell unequal multisets
apart, and ``SIGNS`` lanes of one bit each. Two times a sign lane less the
number of paragraphs is a random-sign projection of the multiset, so the inner
product of two of them estimates how many paragraphs the documents share. The
hashes are 64-bit and not cryptographic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from storeloom.llm.common import text_of, written

WIDE, SIGNS = 16, 128
WIDE_BITS, COUNT_BITS = 31, 16
CUT = r"\n|(?<=[.!?]) "


def _lane_sums(piece: str) -> list[Column]:
    """Sums over the rows of a group; no sum of up to 2**31 rows overflows.

    A sum of signs holds two lanes, 32 bits apart.
    """
    first, second = F.xxhash64(piece), F.xxhash64(F.lit(1), F.col(piece))
    wide = [F.sum(F.xxhash64(first, second, F.lit(i)).bitwiseAND(F.lit((1 << WIDE_BITS) - 1)))
            for i in range(WIDE)]
    pair = F.lit((1 << 32) + 1)
    signs = [F.sum(F.shiftrightunsigned(F.xxhash64(second, F.lit(-1 - w), first), j).bitwiseAND(pair))
             for w in range(SIGNS // 64) for j in range(32)]
    return [F.count(F.lit(1)), *wide, *signs]


def vectors(pieces: DataFrame, by: list[str], piece: str = "piece") -> DataFrame:
    """``by`` and ``vector``: the paragraph count, the wide lanes and the sign lanes."""
    sums = _lane_sums(piece)
    names = [f"lane{i}" for i in range(len(sums))]
    summed = pieces.groupBy(*by).agg(*[s.alias(n) for s, n in zip(sums, names)])
    low = F.lit((1 << 32) - 1)
    lanes = [F.col(names[0])]
    lanes += [F.col(n).bitwiseAND(F.lit((1 << WIDE_BITS) - 1)) for n in names[1:1 + WIDE]]
    lanes += [F.col(n).bitwiseAND(low) for n in names[1 + WIDE:]]
    lanes += [F.shiftrightunsigned(n, 32) for n in names[1 + WIDE:]]
    return summed.select(*by, F.array(*lanes).alias("vector"))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The vector of a document with the paragraphs of ``b`` inserted (or, with -1, deleted)."""
    wide = F.lit((1 << WIDE_BITS) - 1)
    summed = F.zip_with(a, b, lambda x, y: x + F.lit(sign) * y)
    return F.transform(summed, lambda x, i: F.when((i > 0) & (i <= WIDE), x.bitwiseAND(wide)).otherwise(x))


def as_text(vector: Column) -> Column:
    """The fingerprint: every lane in hex, counts modulo 2**16."""
    modulus = F.lit((1 << COUNT_BITS) - 1)
    wide = F.transform(F.slice(vector, 2, WIDE), lambda x: F.lpad(F.hex(x), 8, "0"))
    counts = F.concat(F.slice(vector, 1, 1), F.slice(vector, 2 + WIDE, SIGNS))
    return F.concat(F.array_join(wide, ""), F.array_join(
        F.transform(counts, lambda x: F.lpad(F.hex(x.bitwiseAND(modulus)), 4, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: twice the shared share of paragraphs, as the sign lanes estimate it.

    Equal vectors give 1, documents that share nothing about 0.
    """
    def signs(v: Column) -> Column:
        count = F.element_at(v, 1)
        return F.transform(F.slice(v, 2 + WIDE, SIGNS), lambda x: (2 * x - count).cast("double"))

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    x, y = signs(a), signs(b)
    whole = dot(x, x) + dot(y, y)
    shared = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * dot(x, y) / whole))
    return F.when(a == b, F.lit(1.0)).when(whole > 0, shared).otherwise(F.lit(0.0))


def _rows(docs: DataFrame) -> DataFrame:
    """``k`` (the id as text), ``text``, ``n``, ``h``: what is needed of a row, nothing else."""
    text = text_of()
    return docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("k"),
                       text.alias("text"), F.char_length(text).cast("long").alias("n"),
                       F.xxhash64(text).alias("h"))


def _numbered(rows: DataFrame) -> DataFrame:
    """``copy`` tells rows of one id apart, in the order of length and hash."""
    return rows.withColumn("copy", F.row_number().over(Window.partitionBy("k").orderBy("n", "h")))


def _order(docs: DataFrame) -> DataFrame:
    """Each row's neighbours in ascending id; texts take no part."""
    n = F.char_length(text_of()).cast("long")
    ids = docs.select("doc_id", n.alias("n"), F.xxhash64(text_of()).alias("h"))
    ids = ids.withColumn("k", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    order = ["doc_id", "n", "h", "copy"]
    ranged = written(_numbered(ids).repartitionByRange(*order)
                     .withColumn("part", F.spark_partition_id()), "order")
    me = F.struct("k", "copy", "n")
    inside = Window.partitionBy("part").orderBy(*order)
    near = ranged.select("*", F.lead(me).over(inside).alias("next"), F.lag(me).over(inside).alias("prev"))
    # One row per range partition; the ends of the whole order meet.
    place = F.struct(*order)
    ends = ranged.groupBy("part").agg(F.min_by(me, place).alias("head"), F.max_by(me, place).alias("tail"))
    along = Window.orderBy("part")
    all_of = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("part", F.coalesce(F.lead("head").over(along), F.first("head").over(all_of)).alias("after"),
                       F.coalesce(F.lag("tail").over(along), F.last("tail").over(all_of)).alias("before"))
    near = near.join(F.broadcast(ends), "part").select(
        "k", "copy", "doc_id", F.coalesce("prev", "before").alias("prev"))
    return written(near.select("k", "copy", "doc_id", F.col("prev.k").alias("prev_k"),
                               F.col("prev.copy").alias("prev_copy"), F.col("prev.n").alias("prev_n")),
                   "neighbours")


def _same_copy(a: str, b: str) -> Column:
    # A range, so that it is no join key: the rows stay partitioned by k alone.
    return (F.col(a) - F.col(b)).between(0, 0)


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Edited text: the last half of the characters replaced by the first as many
    of the next document in ascending ``doc_id`` (after the last: the first).
    Returns ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.

    Null texts are empty; an empty text is one empty paragraph. Null ids come
    first, rows of one id in the order of length and hash. A lone document is
    its own next one. An empty table gives an empty result; other columns are
    ignored.

    The texts are shuffled once, by id; the halves that move and one vector per
    document are shuffled too.
    """
    order = _order(docs)
    rows = _numbered(_rows(docs)).alias("d").join(
        order.alias("o"), (F.col("d.k") == F.col("o.k")) & _same_copy("d.copy", "o.copy")).select(
        "d.k", "d.copy", "d.text", "d.n", "o.doc_id", "o.prev_k", "o.prev_copy", "o.prev_n")
    moved = rows.select(F.col("prev_k").alias("k"), F.col("prev_copy").alias("copy"),
                        F.substr("text", F.lit(1), F.floor(F.col("prev_n") / 2).cast("int")).alias("moved"))
    half = F.floor(F.col("n") / 2).cast("int")
    kept = F.substr("text", F.lit(1), F.col("n").cast("int") - half)
    both = (rows.alias("r").join(moved.alias("m"), (F.col("r.k") == F.col("m.k"))
                                 & _same_copy("r.copy", "m.copy"))
            .select("r.*", "m.moved").withColumn("edited", F.concat(kept, F.col("moved")))
            .withColumn("edited_sha256", F.sha2("edited", 256)))
    by = ["k", "copy", "doc_id", "n", "edited_sha256"]
    sides = both.select(*by, F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("text").alias("body")),
        F.struct(F.lit(1).alias("side"), F.col("edited").alias("body")))).alias("s"))
    pieces = sides.select(*by, "s.side", F.explode(F.split("s.body", CUT, -1)).alias("piece"))
    own = vectors(pieces, [*by, "side"])
    paired = own.groupBy(*by).agg(*[
        F.first(F.when(F.col("side") == side, F.col("vector")), ignorenulls=True).alias(name)
        for side, name in ((0, "vector"), (1, "edited_vector"))])
    # Summing the texts once more is cheaper than moving both vectors of every row.
    again = rows.select("prev_k", "prev_copy", "k", "copy", F.explode(F.split("text", CUT, -1)).alias("piece"))
    following = vectors(again, ["k", "copy", "prev_k", "prev_copy"]).select(
        F.col("prev_k").alias("k"), F.col("prev_copy").alias("copy"), F.col("vector").alias("next_vector"))
    return (paired.alias("p").join(following.alias("f"), (F.col("p.k") == F.col("f.k"))
                                   & _same_copy("p.copy", "f.copy"))
            .select("p.doc_id", F.col("p.n").alias("n_chars"), "p.edited_sha256",
                    as_text(F.col("vector")).alias("fingerprint"),
                    as_text(F.col("edited_vector")).alias("edited_fingerprint"),
                    likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
                    likeness(F.col("vector"), F.col("next_vector")).alias("near_next")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with ``vector`` and ``fingerprint`` of the whole text.

    Existing columns of these two names are replaced. The rows are written once
    so that their row ids hold.
    """
    kept = [c for c in docs.columns if c not in ("vector", "fingerprint")]
    rows = written(docs.select(*kept).withColumn("_row", F.monotonically_increasing_id()), "rows")
    pieces = rows.select("_row", F.explode(F.split(text_of(), CUT, -1)).alias("piece"))
    return (rows.join(vectors(pieces, ["_row"]), "_row").drop("_row")
            .withColumn("fingerprint", as_text(F.col("vector"))))
