"""How quality filters act on each other, from a sparse document-term matrix.

The words of the corpus are encoded by one global dictionary and the documents
are rows of a sparse matrix in CSR shards. A shard is some megabytes of whole
texts: a task reads them, gives each distinct word of the shard a local number
and writes the shard with these. The distinct words of all shards then meet by
word and get their global numbers, which go back to the shards. So what is
shuffled of the words is one row for each word and shard, not one for each word
and document. Row sums and numbers of nonzero entries decide the filters on
length and repetition; the other filters' flags are attached to the row.

Documents become a mask of the filters they fail. Masks are counted by part,
and all orders of the filters are evaluated on these counts.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from storeloom.llm.common import groups, text_of, written

LETTERS = "ABCDE"
#: Bytes of text in a shard, and in a step of building one; a longer text is one of its own.
SHARD, STEP = 8 << 20, 2 << 20
#: Words that a task numbers at a time.
NUMBERED = 1 << 19

_LOCAL = ("shard long, ids array<long>, parts array<string>, points array<long>, capitals array<long>, "
          "marked array<boolean>, digests array<binary>, words array<string>, "
          "row_ends binary, columns binary, counts binary")
_MATRIX = ("shard long, ids array<long>, parts array<string>, points array<long>, capitals array<long>, "
           "marked array<boolean>, digests array<binary>, row_ends binary, columns binary, counts binary")

_CAPITAL = np.zeros(256, bool)
_CAPITAL[ord("A"):ord("Z") + 1] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "#$%&*|"]] = True


def _packed(numbers: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(numbers).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, size: int, kind: str) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=size * np.dtype(kind).itemsize, codec="zstd",
                                       asbytes=True), kind)


def _per_text(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many flags hold from each start to its end."""
    out, filled = np.zeros(len(starts), np.int64), starts < ends
    if filled.any():
        out[filled] = np.add.reduceat(flags, starts[filled], dtype=np.int64)
    return out


def _characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of each text the number of capitals, and whether it has a mark."""
    capitals, marks = [], []
    for some in groups(pc.binary_length(texts).to_pylist(), STEP):
        part = texts.slice(some.start, some.stop - some.start)
        at = np.concatenate([[0], np.cumsum(pc.binary_length(part).to_numpy(zero_copy_only=False), dtype=np.int64)])
        first = np.frombuffer(part.buffers()[1], np.int32)[part.offset]
        data = np.frombuffer(part.buffers()[2] or b"", np.uint8)[first:first + at[-1]]
        capitals.append(_per_text(_CAPITAL[data], at[:-1], at[1:]))
        marks.append(_per_text(_MARK[data], at[:-1], at[1:]) > 0)
    return np.concatenate(capitals), np.concatenate(marks)


def _cells(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of some texts, and row, word and count of each nonzero entry, by rows."""
    # White space of this function: the space and the five characters from tab to carriage return.
    split = pc.ascii_split_whitespace(texts)
    words = split.flatten()
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    filled = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    coded = words.filter(pa.array(filled)).dictionary_encode()
    width = max(len(coded.dictionary), 1)
    cell, count = np.unique(row[filled] * width + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    return coded.dictionary, *np.divmod(cell, width), count


def _csr(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, the most frequent first, and row ends, columns and counts of the texts."""
    known, parts, begun = pa.array([], pa.string()), [], 0
    for some in groups(pc.binary_length(texts).to_pylist(), STEP):
        words, row, column, count = _cells(texts.slice(some.start, some.stop - some.start))
        known = pa.concat_arrays([known, words.filter(pc.is_null(pc.index_in(words, value_set=known)))])
        place = pc.index_in(words, value_set=known).to_numpy(zero_copy_only=False)
        parts.append([x.astype(np.int32) for x in (row + some.start, place[column], count)])
    row, column, count = map(np.concatenate, zip(*parts))
    order = np.argsort(-np.bincount(column, count, len(known)), kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    return (known.take(pa.array(order)), np.searchsorted(row, np.arange(len(texts)), side="right"),
            place[column], count)


def _local_shards(docs: DataFrame) -> DataFrame:
    """The CSR shards with local word numbers, written: what follows reads them twice."""
    schema = to_arrow_schema(StructType.fromDDL(_LOCAL))
    # A number that no other row has, so the first row's names a shard.
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"),
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       text_of().alias("text"), F.unhex(F.sha2(text_of(), 256)).alias("digest"))

    def run(batches):
        for batch in batches:
            sizes = pc.binary_length(batch.column(3)).to_pylist()
            for held in groups(sizes, SHARD):
                part = batch.slice(held.start, held.stop - held.start)
                row, ids, sources, texts, digests = part.columns
                words, row_ends, columns, counts = _csr(texts)
                capitals, marked = _characters(texts)
                lists = [ids, sources, pc.utf8_length(texts).cast(pa.int64()), pa.array(capitals),
                         pa.array(marked), digests, words]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v).cast(schema.field(n + 1).type)
                         for n, v in enumerate(lists)]
                packed = [_packed(row_ends.astype(np.int64)), _packed(columns), _packed(counts)]
                yield pa.RecordBatch.from_arrays([row.slice(0, 1), *lists, *[pa.array([v]) for v in packed]],
                                                 schema=schema)

    return written(rows.mapInArrow(run, _LOCAL), "shards")


def _dictionary(shards: DataFrame) -> DataFrame:
    """``shard``, ``size``, ``local``, ``global``: the numbers of every distinct word of a shard.

    Words meet and are sorted, and a number is that of the first row of its word
    in the task. A word has one row for each shard, however frequent it is. The
    numbers go out as packed arrays of the words of a shard that a task has seen.
    """
    words = shards.select("shard", F.posexplode("words").alias("local", "word"))
    sorted_words = words.repartition("word").sortWithinPartitions("word")
    ddl = "shard long, size int, local binary, global binary"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def out(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        shard, local, number = map(np.concatenate, zip(*held))
        order = np.argsort(shard, kind="stable")
        shard, local, number = shard[order], local[order], number[order]
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
        rows = [(int(shard[i]), j - i, _packed(local[i:j]), _packed(np.diff(number[i:j], prepend=0)))
                for i, j in zip(cuts, cuts[1:])]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    def run(batches):
        base, last, held, size = None, None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            word = batch.column(2)
            fresh = np.ones(len(word), bool)
            fresh[1:] = pc.not_equal(word.slice(1), word.slice(0, len(word) - 1)).to_numpy(zero_copy_only=False)
            if base is None:
                # The first row of a task has the smallest number of all its rows.
                base = batch.column(3)[0].as_py() - 1
            elif word[0].as_py() == last:
                fresh[0] = False
            numbers = base + np.cumsum(fresh)
            base, last = int(numbers[-1]), word[-1].as_py()
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), numbers))
            size += len(numbers)
            if size >= NUMBERED:
                yield out(held)
                held, size = [], 0
        if held:
            yield out(held)

    return sorted_words.withColumn("global", F.monotonically_increasing_id()).mapInArrow(run, ddl)


def term_matrix(docs: DataFrame) -> DataFrame:
    """CSR shards: a row holds some documents with their rows of the document-term matrix.

    ``row_ends`` (64-bit), ``columns`` (global word numbers, 64-bit, ascending)
    and ``counts`` (32-bit) are Zstandard-compressed arrays, read by ``csr_of``;
    ``ids``, ``parts``, ``points`` (code points), ``capitals``, ``marked`` and
    ``digests`` (SHA-256 of the text) have an entry for each document.

    Null texts are empty and have no entries. Null and repeated ids stay row by
    row. An empty table gives no shards; other columns take no part.
    """
    shards = _local_shards(docs)
    numbers = _dictionary(shards)
    schema = to_arrow_schema(StructType.fromDDL(_MATRIX))

    def join(own: pa.Table, words: pa.Table) -> pa.Table:
        held = own.to_pylist()[0]
        parts = words.to_pylist()
        number = np.empty(sum(p["size"] for p in parts), np.int64)
        for p in parts:
            number[_unpacked(p["local"], p["size"], "i4")] = np.cumsum(_unpacked(p["global"], p["size"], "i8"))
        ends = _unpacked(held["row_ends"], len(held["ids"]), "i8")
        size = int(ends[-1])
        columns, counts = (_unpacked(held[c], size, "i4") for c in ("columns", "counts"))
        row = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        columns = number[columns] if size else np.zeros(0, np.int64)
        order = np.lexsort((columns, row))
        held |= {"columns": _packed(columns[order]), "counts": _packed(counts[order])}
        return pa.Table.from_pylist([{n: held[n] for n in schema.names}], schema)

    return (shards.drop("words").groupBy("shard").cogroup(numbers.groupBy("shard"))
            .applyInArrow(join, _MATRIX))


def csr_of(shard: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row ends, columns and counts of a row of ``term_matrix``."""
    ends = _unpacked(shard["row_ends"], len(shard["ids"]), "i8")
    size = int(ends[-1])
    return ends, _unpacked(shard["columns"], size, "i8"), _unpacked(shard["counts"], size, "i4")


def failures(matrix: DataFrame, words: int = 200, distinct_percent: int = 50, capital_percent: int = 2) -> DataFrame:
    """``doc_id``, ``part``, ``digest``, ``n_words``, ``n_distinct``, ``mask`` of every document of a matrix.

    Bits of ``mask``, from the lowest: A, fewer than ``words`` words; B, under
    ``distinct_percent`` of them distinct; C, over ``capital_percent`` of the
    code points in A to Z; D, one of ``#$%&*|``.
    """
    ddl = "doc_id long, part string, digest binary, n_words long, n_distinct long, mask int"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        for batch in batches:
            for shard in batch.to_pylist():
                ends, _, counts = csr_of(shard)
                starts = np.concatenate([[0], ends[:-1]])
                sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                total, distinct = sums[ends] - sums[starts], ends - starts
                points, capitals = (np.array(shard[c], np.int64) for c in ("points", "capitals"))
                mask = ((total < words) + 2 * (100 * distinct < distinct_percent * total)
                        + 4 * (100 * capitals > capital_percent * points) + 8 * np.array(shard["marked"], bool))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard["ids"], pa.int64()), pa.array(shard["parts"], pa.string()),
                     pa.array(shard["digests"], pa.binary()), pa.array(total), pa.array(distinct),
                     pa.array(mask.astype(np.int32))], schema=schema)

    return matrix.mapInArrow(run, ddl)


def with_copies(failed: DataFrame) -> DataFrame:
    """Adds bit E of ``mask``: a row with a smaller id has the same text.

    Texts are compared by SHA-256. Null ids are neither smaller nor copies.
    """
    least = failed.filter("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("least"))
    copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    return failed.join(least, "digest", "left").withColumn("mask", F.col("mask") + F.when(copy, 16).otherwise(0)).drop(
        "least")


def _orders() -> Column:
    """All orders and steps; 600 of them, whatever the data."""
    steps = []
    for order in permutations(range(len(LETTERS))):
        before = 0
        for step, f in enumerate(order, start=1):
            name = "".join(LETTERS[i] for i in order)
            steps.append(f"struct('{name}' AS filter_order, {step} AS step, {1 << f} AS own, {before} AS before)")
            before |= 1 << f
    return F.expr(f"array({', '.join(steps)})")


def interactions(masks: DataFrame) -> DataFrame:
    """All orders on rows of ``part``, ``mask``, ``good``, ``toxic``.

    The rows are counted by part and mask on the map side, so a part with a
    third of them is no hot key; a part has 32 counts at most from then on.
    """
    one = F.lit(1).cast("long")
    counted = masks.groupBy("part", "mask").agg(
        F.count(one).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    held = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    rows = held.select("part", "masks", F.explode(_orders()).alias("o")).select("part", "masks", "o.*")

    def total(field: str, wanted: str) -> Column:
        return F.expr(f"aggregate(filter(masks, m -> {wanted}), 0L, (s, m) -> s + m.{field})")

    first = "(m.mask & own) > 0 AND (m.mask & before) = 0"
    # A document that fails k filters meets its filter first in 120 / k of the orders.
    shapley = F.expr("aggregate(filter(masks, m -> (m.mask & own) > 0), 0L, "
                     "(s, m) -> s + m.n * (120 div bit_count(m.mask)))")
    return rows.select(
        "part", "filter_order", "step",
        total("n", "(m.mask & (own | before)) = 0").alias("kept"), total("n", first).alias("removed"),
        total("n", "(m.mask & own) > 0 AND (m.mask & before) > 0").alias("redundant"),
        total("n", "m.mask = own").alias("unique_fails"), total("good", first).alias("good_lost"),
        total("toxic", first).alias("toxic_lost"), shapley.alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter removes in each of the 120 orders, for each value of ``source``.

    Returns ``part``, ``filter_order``, ``step``, ``kept``, ``removed``,
    ``redundant``, ``unique_fails``, ``good_lost``, ``toxic_lost`` and
    ``shapley``. Null texts are empty: no words, no characters, filter A fails
    alone. A null source is the empty one. Repeated rows count each. A document
    is good or toxic if any of its labels says so; null labels and labels of
    unknown or null ids count for nothing. An empty table gives an empty result;
    other columns take no part.
    """
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    failed = written(failures(term_matrix(docs)), "failures")
    marked = with_copies(failed).join(marks, "doc_id", "left")
    return interactions(marked.select("part", "mask", F.coalesce("good", F.lit(False)).alias("good"),
                                      F.coalesce("toxic", F.lit(False)).alias("toxic")))
