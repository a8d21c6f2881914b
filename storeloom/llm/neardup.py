"""Near-duplicate documents by MinHash, banding and connected components.

Documents with equal shingle sets are one class from the start. Of each class
one representative goes on: ``HASHES`` universal hash minima of its set, of
which ``ROWS`` at a time make a band key. Members of a bucket (equal band key)
are compared with the bucket's smallest member first; links are confirmed on
the full sets, and components are found. Members of one bucket that are still
in different components are then compared with each other, so no link between
members of a bucket is lost and a bucket of copies costs one comparison each.
The bits of a signature (one per minimum) drop pairs far below the threshold
before the sets are fetched. The second comparison knows what each set shares with the
bucket's smallest member and what it adds. Two sets that add nothing in common
share at most what the one that shares less has of that member, so copies with
several changes each are told apart without looking at the pairs; others meet
by the shingles they both add.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from storeloom.llm.buckets import bucket_links
from storeloom.llm.common import text_of, written
from storeloom.llm.components import components

SHINGLE = 5
#: 32 bands of 6 rows: a pair at a similarity of 0.85 shares no band once in four million.
HASHES, ROWS = 192, 6
#: Signature bits that may differ: over six standard deviations beyond the mean at 0.85.
BITS_APART = 38
#: Words a worker remembers the hash of.
WORDS = 1 << 17


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_HASH = _WordHash()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, width: int = SHINGLE) -> np.ndarray:
    """The sorted set of 64-bit hashes of word shingles; few words make one shingle, none an empty set.

    Words are runs between ASCII white space, A to Z in lower case.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(_HASH.__getitem__, words), np.uint64, len(words))
    size = min(width, len(words))
    with np.errstate(over="ignore"):
        total = np.full(len(words) - size + 1, size, dtype=np.uint64)
        for i in range(size):
            total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[i:len(words) - size + 1 + i])
    return np.unique(total)


@lru_cache(1)
def _family() -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and shifts of the universal hashes ``a * x + b`` modulo 2**32."""
    random = np.random.default_rng(20240601)
    return (random.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1),
            random.integers(0, 1 << 32, HASHES, dtype=np.uint32))


def minima(found: np.ndarray) -> np.ndarray:
    """The smallest value of each universal hash over a set."""
    a, b = _family()
    low = np.full(HASHES, np.iinfo(np.uint32).max, dtype=np.uint32)
    with np.errstate(over="ignore"):
        folded = (_mixed(found) >> np.uint64(32)).astype(np.uint32)
        for start in range(0, len(folded), 512):
            np.minimum(low, (a[:, None] * folded[None, start:start + 512] + b[:, None]).min(axis=1), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low.reshape(-1, ROWS).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.arange(len(rows), dtype=np.uint64)
        for i in range(ROWS):
            key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return key


def signature_bits(low: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.packbits((low * np.uint32(0x9E3779B1)) >> np.uint32(31)).view("<i8")


SIGNATURES = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, bits array<long>"


def signatures(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """``SIGNATURES`` per row; a document without shingles has no bands."""
    schema = to_arrow_schema(StructType.fromDDL(SIGNATURES))

    def run(batches):
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = shingles(text, width)
                row = {"doc_id": doc, "n_shingles": len(found), "bands": [], "bits": []}
                if len(found):
                    low = minima(found)
                    digest = np.frombuffer(xxhash.xxh128_digest(found.tobytes()), "<i8")
                    row |= {"set_a": int(digest[0]), "set_b": int(digest[1]),
                            "bands": band_keys(low).view(np.int64), "bits": signature_bits(low)}
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, SIGNATURES)


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``doc_id``, ``shingles``: the full sets of the wanted documents."""
    ddl = "doc_id long, set_a long, set_b long, shingles array<long>"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        for batch in batches:
            found = [shingles(t, width) for t in batch.column(1).to_pylist()]
            digests = [np.frombuffer(xxhash.xxh128_digest(f.tobytes()), "<i8") for f in found]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([int(d[0]) for d in digests], pa.int64()),
                pa.array([int(d[1]) for d in digests], pa.int64()),
                pa.array([f.view(np.int64) for f in found], schema.field("shingles").type)], schema=schema)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    # The same plan at every size: the wanted ids are not bounded.
    return texts.join(wanted.hint("merge"), "doc_id", "left_semi").mapInArrow(run, ddl)


def _close(a: str, b: str) -> Column:
    """Whether sizes and signature bits allow a link."""
    apart = sum((F.bit_count(F.col(f"{a}.bits")[i].bitwiseXOR(F.col(f"{b}.bits")[i]))
                 for i in range(HASHES // 64)), F.lit(0))
    return apart <= BITS_APART


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` per row.

    Documents are linked at a Jaccard similarity of ``percent`` per cent or
    more of their shingle sets. ``component_id`` is the smallest id that links
    lead to, the own id included, and ``kept`` tells whether it is the own id.
    Null and empty texts and texts of white space are linked with nothing. Rows
    with a null id are linked with nothing, have a null component and are kept.
    Rows of one id are one document with all their links. An empty table gives
    an empty result; other columns are ignored.
    """
    signed = written(signatures(docs, width), "signatures")
    # A class is known by the first hash of its set, as one id may have rows in several.
    classes = (signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_a", "set_b")
               .agg(F.min_by(F.struct("doc_id", "n_shingles", "bands", "bits"), "doc_id").alias("r")))
    classes = written(classes.select(F.col("set_a").alias("id"), "set_b", "r.*"), "classes")
    links = _links(docs, classes, percent, width)

    # Rows of one id in several classes join these classes.
    held = signed.join(classes.select(F.col("id").alias("set_a"), "set_b", F.col("doc_id").alias("rep")),
                       ["set_a", "set_b"], "left")
    held = written(held.select("doc_id", "n_shingles", "rep", F.when(F.col("rep").isNotNull(), F.col("set_a"))
                               .alias("id")), "held")
    homes = held.groupBy("doc_id").agg(F.min("id").alias("home"), F.max("id").alias("other")).filter("home < other")
    shared = held.join(homes, "doc_id").select(F.col("home").alias("a"), F.col("id").alias("b"))
    grouped = components(links.unionByName(shared))
    least = (classes.select("id", "doc_id").join(grouped, "id").groupBy("component")
             .agg(F.min("doc_id").alias("least")))
    found = held.join(grouped.join(least, "component").select("id", "least"), "id", "left")
    component = F.coalesce("least", "rep", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _links(docs: DataFrame, classes: DataFrame, percent: int, width: int) -> DataFrame:
    """Confirmed links ``(a, b)`` between classes."""
    keys = classes.select(F.explode("bands").alias("key"), F.lit(0).cast("byte").alias("kind"), "id")
    nodes = classes.select("id", F.struct(F.col("n_shingles").alias("n"), "bits").alias("m"))
    sets: list[DataFrame] = []

    def confirm(pairs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
        if not sets:  # the texts are read and shuffled once, for both rounds
            sets.append(_sets_of(docs, classes, ids, width))
        return _confirmed(sets[0], pairs, percent, name)

    def likely(a: str, b: str, kind: Column) -> Column:
        return _sizes_allow(a, b, percent) & _close(a, b)

    def meet(apart: DataFrame) -> DataFrame:
        """Pairs that may be links, from what each set shares with the head of its bucket and what it adds."""
        told = apart.select("head", "id", "component", "m").dropDuplicates(["head", "id"])
        told = (told.join(sets[0].select("id", F.col("shingles").alias("x")), "id")
                .join(sets[0].select(F.col("id").alias("head"), F.col("shingles").alias("y")), "head"))
        told = told.withColumn("added", F.array_except("x", "y"))
        told = written(told.select("head", "id", "component", "added", F.struct(
            "m.n", "m.bits", (F.size("x") - F.size("added")).alias("shared")).alias("m")), "near-told")

        def possible(more: Column) -> Column:
            """Two sets have in common what both share with the head at most, and ``more`` that is not in it."""
            most = F.least(F.col("x.m.shared"), F.col("y.m.shared")) + more
            return most * 100 >= (F.col("x.m.n") + F.col("y.m.n") - most) * percent

        apart_too = (F.col("x.component") < F.col("y.component")) & likely("x.m", "y.m", F.lit(0))
        pair = [F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")]
        placed = apart.select("key", "head", "id").join(told.drop("added"), ["head", "id"])
        alike = placed.alias("x").join(placed.alias("y"), (F.col("x.key") == F.col("y.key")) & apart_too
                                       & possible(F.lit(0))).select(*pair)
        # Beyond that a pair needs shingles in common that the head lacks.
        tokens = told.select("head", F.explode("added").alias("token"), "id", "component", "m")
        extra = (F.col("x.m.n") - F.col("x.m.shared"), F.col("y.m.n") - F.col("y.m.shared"))
        common = tokens.alias("x").join(tokens.alias("y"), (F.col("x.head") == F.col("y.head")) & (
            F.col("x.token") == F.col("y.token")) & apart_too & possible(F.least(*extra)))
        counted = common.groupBy("x.head", *pair).agg(
            F.count(F.lit(1)).alias("more"), F.first("x.m").alias("p"), F.first("y.m").alias("q"))
        both = F.least("p.shared", "q.shared") + F.col("more")
        counted = counted.filter(both * 100 >= (F.col("p.n") + F.col("q.n") - both) * percent)
        return alike.union(counted.select("a", "b")).distinct()

    return bucket_links(keys, nodes, likely, confirm, "near", meet)


def _sizes_allow(a: str, b: str, percent: int) -> Column:
    x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _sets_of(docs: DataFrame, classes: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """``id``, ``shingles`` of the classes ``ids``, from the texts of their representatives."""
    wanted = classes.join(ids, "id").select("doc_id", F.col("id").alias("set_a"), "set_b")
    # An id may have rows with other texts; only the class's own set counts.
    found = _sets(docs, wanted.select("doc_id").distinct(), width).join(
        wanted, ["doc_id", "set_a", "set_b"], "left_semi")
    return written(found.select(F.col("set_a").alias("id"), "shingles").dropDuplicates(["id"]), "sets")


def _confirmed(sets: DataFrame, pairs: DataFrame, percent: int, name: str) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    both = (pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
            .join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a"))
    shared = F.size(F.array_intersect("x", "y"))
    linked = both.filter(shared * 100 >= (F.size("x") + F.size("y") - shared) * percent)
    return written(linked.select("a", "b"), f"{name}-links")


def keep_representatives(docs: DataFrame, percent: int = 80, width: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest id.

    Of rows of one id the one with the smallest text hash stays; rows with a
    null id stay.
    """
    kept = near_duplicates(docs, percent, width).filter("kept AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("_kept")).distinct()
    rows = docs.withColumn("_id", F.col("doc_id").cast("long"))
    chosen = rows.join(kept, F.col("_id") == F.col("_kept"), "left_semi")
    place = Window.partitionBy("_id").orderBy(F.xxhash64(text_of()))
    chosen = chosen.withColumn("_place", F.row_number().over(place)).filter("_place = 1")
    return chosen.select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))
