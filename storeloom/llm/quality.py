"""Quality by an interpolated modified Kneser-Ney n-gram model of UTF-8 bytes.

Every byte is a symbol of its own, so texts of all scripts are told apart, and
the tables of n-grams grow with the corpus. Documents are packed into shards of
whole rows, in parts. A shard sends each distinct n-gram of its texts once, with its count
in the shard's trusted texts, to the bucket of the three bytes before its last.
All n-grams of a context, and all that end in one n-gram of four bytes, are in
one bucket, which so knows sums, continuation counts and context totals of the
orders above four; of four bytes and fewer the tables are aggregations and joins
by n-gram. What the model says of the n-grams of a shard goes back to it, and
the shard, which stays where it was written, gives every whole text its
perplexity. N-grams travel in sorted blocks, one for each shard and bucket. No
table of n-grams is gathered on the driver. A text is rejected if its perplexity
is above a quantile of the trusted texts of its language.

``grams``, ``train`` and ``bits`` are the same model as one dense table over an
alphabet of 32 classes of bytes; no query uses them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc  # noqa: F401
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from storeloom.llm.common import groups, shared_folder, text_of, written

BYTES, ORDER = 256, 6
#: Orders above this one are counted inside buckets.
BASE = 4
#: Bytes of text in a shard and in one of its parts; bytes whose n-grams are sorted together; n-grams merged together.
SHARD, PART, SORTED, MERGED = 32 << 20, 4 << 20, 1 << 20, 1 << 20
#: The dense table's alphabet and order.
SYMBOLS, DENSE_ORDER = 32, 4
SPACE, CAPITAL, DIGIT, STOP, MARK, BEYOND = range(26, 32)
#: One trusted document in so many is kept from training, for the bounds.
FOLDS = 5
#: Quantiles are taken over perplexities in bits, rounded to this.
STEP = 1e-3


def _symbol_table() -> np.ndarray:
    table = np.full(256, BEYOND, dtype=np.uint8)
    table[:128] = MARK
    for first, last, symbol in (("A", "Z", CAPITAL), ("0", "9", DIGIT)):
        table[ord(first):ord(last) + 1] = symbol
    table[ord("a"):ord("z") + 1] = np.arange(26)
    table[[ord(c) for c in " \t\n\r\v\f"]] = SPACE
    table[[ord(c) for c in ".,"]] = STOP
    return table


_TABLE = _symbol_table()


def grams(text: str, order: int = DENSE_ORDER) -> np.ndarray:
    """The number of the n-gram that ends at each byte; a text starts after white space."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    symbols = np.concatenate([np.full(order - 1, SPACE, np.int32), _TABLE[data].astype(np.int32)])
    out = np.zeros(len(data), dtype=np.int32)
    for i in range(order):
        out = out * SYMBOLS + symbols[i:i + len(data)]
    return out


def gram_counts(texts: DataFrame, order: int = DENSE_ORDER) -> DataFrame:
    """``gram``, ``n`` over all texts: counted per task, then summed."""
    schema = to_arrow_schema(StructType.fromDDL("gram int, n long"))

    def run(batches):
        total = np.zeros(SYMBOLS ** order, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                np.add.at(total, *np.unique(grams(text, order), return_counts=True))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], schema=schema)

    return texts.select(text_of()).mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame, by: str | None = None) -> DataFrame:
    """``d1, d2, d3``: the modified discounts, from how many n-grams occur 1 to 4 times.

    Where one of these is 0, as with few symbols and much text, 0.5, 1 and 1.5;
    so is a single one that would not be above 0, as with many copies, since
    it would give n-grams that were not seen no probability at all. Without ``by`` there is one row, and one of ``counts`` for each n-gram; else one for
    each value of ``by``, ``times`` being how many n-grams occur ``n`` times.
    """
    keys = [by] if by else []
    if not by:
        counts = counts.select("n", F.lit(1).alias("times"))
    n1, n2, n3, n4 = (F.coalesce(F.sum(F.when(F.col("n") == i, F.col("times"))), F.lit(0)).cast("double")
                      for i in (1, 2, 3, 4))
    held = counts.groupBy(*keys).agg(n1.alias("n1"), n2.alias("n2"), n3.alias("n3"), n4.alias("n4"))
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
    usable = F.least("n1", "n2", "n3", "n4") > 0

    def discount(i: int):
        value = i - F.try_divide((i + 1) * y * F.col(f"n{i + 1}"), F.col(f"n{i}"))
        return F.when(usable & (value > 0), value).otherwise(F.lit(i / 2)).alias(f"d{i}")

    return held.select(*keys, *[discount(i) for i in (1, 2, 3)])


def train(trusted: DataFrame, order: int = DENSE_ORDER) -> DataFrame:
    """``gram``, ``level``, ``p``, ``rest``: the model's table, at most 32 ** order rows a level.

    ``p`` is the interpolated probability of an n-gram of ``level`` symbols that
    occurs; ``rest`` is the weight that its context leaves to the order below.
    """
    counts = written(gram_counts(trusted, order), "grams")
    tables = {order: counts}
    for level in range(order - 1, 0, -1):
        # Continuation counts: in how many contexts the shorter n-gram occurs.
        tables[level] = (tables[level + 1].groupBy((F.col("gram") % SYMBOLS ** level).alias("gram"))
                         .agg(F.count(F.lit(1)).alias("n")))
    below = None
    out = []
    for level in range(1, order + 1):
        counted = tables[level].withColumn("context", F.floor(F.col("gram") / SYMBOLS).cast("int"))
        n = F.col("n")
        cut = F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))
        # One row of discounts.
        counted = counted.join(F.broadcast(_discounts(counted))).withColumn("cut", F.least(cut, n.cast("double")))
        contexts = counted.groupBy("context").agg(F.sum("n").alias("total"), F.sum("cut").alias("left"))
        joined = counted.join(contexts, "context")
        rest = F.col("left") / F.col("total")
        if below is None:
            lower = F.lit(1 / SYMBOLS)
        else:
            joined = joined.withColumn("shorter", (F.col("gram") % SYMBOLS ** (level - 1)).cast("int")).join(
                below.select(F.col("gram").alias("shorter"), F.col("p").alias("lower")), "shorter")
            lower = F.col("lower")
        below = written(joined.select("gram", F.lit(level).alias("level"),
                                      ((n - F.col("cut")) / F.col("total") + rest * lower).alias("p"),
                                      rest.alias("rest")), f"level{level}")
        out.append(below)
    model = out[0]
    for part in out[1:]:
        model = model.unionByName(part)
    return model


def bits(model: DataFrame, order: int = DENSE_ORDER) -> np.ndarray:
    """Minus the base-2 log probability of every n-gram, seen or not: 32 ** order numbers."""
    held = model.toPandas()
    below = np.full(1, 1 / SYMBOLS)
    for level in range(1, order + 1):
        own = held[held["level"] == level]
        gram = own["gram"].to_numpy(dtype=np.int64)
        rest = np.ones(SYMBOLS ** (level - 1))
        rest[gram // SYMBOLS] = own["rest"]
        # The lower order of n-gram g is g without its first symbol.
        lower = below if level == 1 else np.tile(below, SYMBOLS)
        p = np.repeat(rest, SYMBOLS) * np.resize(lower, SYMBOLS ** level)
        p[gram] = own["p"]
        below = p
    return -np.log2(below).astype(np.float32)


def byte_grams(text: str, order: int = ORDER) -> np.ndarray:
    """The n-gram of bytes that ends at each byte, as a number; a text starts after spaces. ``order`` is 7 at most."""
    data = np.frombuffer(b" " * (order - 1) + text.encode("utf-8", "surrogatepass"), np.uint8)
    out = np.zeros(len(data) - order + 1, dtype=np.int64)
    for i in range(order):
        out = out * BYTES + data[i:i + len(out)]
    return out


def _grams_of(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """``byte_grams`` of some texts one after another, and how many each has."""
    lead = b" " * (order - 1)
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(d) for d in data], dtype=np.int64)
    flat = np.frombuffer(lead + lead.join(data), np.uint8)
    out = np.zeros(max(0, len(flat) - order + 1), dtype=np.int64)
    for i in range(order):
        out = out * BYTES + flat[i:i + len(out)]
    inside = np.ones(len(out), dtype=bool)
    # No n-gram ends in the spaces before the next text.
    ends = np.cumsum(sizes + order - 1)[:-1]
    inside[(ends[:, None] - np.arange(1, order)[None, :]).ravel()] = False
    return out[inside], sizes


def _turned(gram: np.ndarray, order: int) -> np.ndarray:
    """N-grams with their context backwards, nearest byte first, then the last byte; again, and it is undone.

    So an n-gram's order puts both its contexts and the n-grams it ends in side by side.
    """
    out = gram & 255
    for i in range(1, order):
        out |= ((gram >> (8 * i)) & 255) << (8 * (order - i))
    return out


def _bucket(near: np.ndarray | Column, buckets: int):
    """The bucket of a number of ``BASE - 1`` bytes at most, in numpy or in Spark."""
    if isinstance(near, Column):
        return F.pmod(F.shiftright(near * F.lit(2654435761), 16), F.lit(buckets)).cast("int")
    return ((near * 2654435761) >> 16) % buckets


def _buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of some numbers, byte by byte of all, compressed."""
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T for c in columns]
    return zstandard.ZstdCompressor(level=3).compress(np.concatenate(planes).tobytes())


def _unpack(data: bytes, *types: type) -> list[np.ndarray]:
    widths = [np.dtype(t).itemsize for t in types]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(sum(widths), -1)
    edges = np.cumsum([0, *widths])
    return [np.ascontiguousarray(planes[a:b].T).view(t).ravel() for a, b, t in zip(edges, edges[1:], types)]


def _summed(gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams in order, and their sums."""
    order_of = np.argsort(gram)
    gram = gram[order_of]
    heads = np.flatnonzero(np.diff(gram, prepend=-1))
    return gram[heads], np.add.reduceat(n[order_of], heads) if len(heads) else n[:0]


def _merged(parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of some parts in order, and their sums; memory grows with the distinct ones."""
    none = np.zeros(0, np.int64)
    held, size = [(none, none)], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= max(MERGED, len(held[0][0])):
            held, size = [_summed(*map(np.concatenate, zip(*held)))], 0
    return _summed(*map(np.concatenate, zip(*held)))


def _merged_blocks(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return _merged(_unpack(data, np.int64, np.int64) for data in blocks)


def _levels(key: np.ndarray, n: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """Turned n-grams of a bucket in order, their counts, and where in the next entry what they end in stands.

    The first entry is of ``order`` bytes, the last of ``BASE``, or of ``order`` where that is less.
    """
    out = []
    for _ in range(order, BASE, -1):
        below, place = np.unique(((key >> 16) << 8) | (key & 255), return_inverse=True)
        out.append((key, n, place))
        # Continuation counts: in how many contexts the shorter n-gram occurs.
        key, n = below, np.bincount(place[n > 0], minlength=len(below)).astype(np.int64)
    return [*out, (key, n, None)]


def _shards(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``shard``, ``part``, ``ids`` and ``rows``: ``columns`` of some rows as a compressed Arrow stream.

    The text, null being empty, is the stream's last column. A shard is some
    rows of the table, none with more than ``PART`` bytes of text unless it has
    but one, so that no task holds a shard in one piece. The table is bucketed
    by shard in the shared folder, so that no join or group by shard shuffles
    texts.
    """
    ddl = "shard long, part long, ids array<long>, rows binary"
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    rows = docs.select(F.monotonically_increasing_id().alias("_at"), F.col("doc_id").cast("long").alias("_id"),
                       *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], text_of().alias("_text"))

    def run(batches):
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
        for batch in batches:
            sizes = pc.binary_length(batch.column(batch.num_columns - 1)).to_pylist()
            for held in groups(sizes, SHARD):
                shard = batch.column(0).slice(held.start, 1)
                for some in groups(sizes[held], PART):
                    part = batch.slice(held.start + some.start, some.stop - some.start)
                    own = part.select(list(range(2, part.num_columns)))
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, own.schema, options=options) as out:
                        out.write_batch(own)
                    ids = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.column(1))
                    yield pa.RecordBatch.from_arrays(
                        [shard, part.column(0).slice(0, 1), ids.cast(schema.field(2).type),
                         pa.array([sink.getvalue().to_pybytes()])], schema=schema)

    spark, name = docs.sparkSession, f"shards_{uuid.uuid4().hex}"
    (rows.mapInArrow(run, ddl).write.bucketBy(_buckets(spark), "shard")
     .option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name))
    return spark.table(name)


def _unpacked(rows: pa.Buffer) -> pa.Table:
    return pa.ipc.open_stream(rows).read_all()


def _slices(texts: pa.ChunkedArray) -> Iterator[tuple[int, list[str]]]:
    """Some texts at a time, and the place of the first."""
    for some in groups(pc.binary_length(texts).to_pylist(), SORTED):
        yield some.start, texts.slice(some.start, some.stop - some.start).to_pylist()


def _counted(parts: Iterable[tuple[pa.Buffer, set[int]]], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a shard's parts in order, and how often the texts at the places given have each."""
    def counts():
        for rows, taught in parts:
            for begun, some in _slices(_unpacked(rows).column(-1)):
                for known in (True, False):
                    read = [t for i, t in enumerate(some, begun) if (i in taught) == known]
                    if read:
                        gram, n = np.unique(_grams_of(read, order)[0], return_counts=True)
                        yield gram, n * known

    return _merged(counts())


def _asked(shards: DataFrame, good: DataFrame, order: int) -> DataFrame:
    """``bucket``, ``shard``, ``data``: blocks of the distinct n-grams of a shard, turned and in order; written.

    With each goes how often the shard's trusted texts have it.
    """
    ddl = "bucket int, shard long, data binary"
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    buckets, near = _buckets(shards.sparkSession), BYTES ** (min(BASE, order) - 1)
    trusted = (shards.select(F.col("shard").alias("of"), F.col("part").alias("at"),
                             F.posexplode("ids").alias("place", "doc_id"))
               .join(good, "doc_id", "left_semi").groupBy("of", "at").agg(F.collect_list("place").alias("places")))

    def run(own: pa.Table, told: pa.Table) -> pa.Table:
        taught = dict(zip(told.column("at").to_pylist(), map(set, told.column("places").to_pylist())))
        parts = zip(own.column("part").to_pylist(), own.column("rows"))
        gram, n = _counted(((rows.as_buffer(), taught.get(part, set())) for part, rows in parts), order)
        key, bucket = _turned(gram, order), _bucket((gram >> 8) % near, buckets)
        place = np.lexsort((key, bucket))
        key, n, bucket = key[place], n[place], bucket[place]
        heads = np.flatnonzero(np.diff(bucket, prepend=-1))
        blocks = [_pack(key[a:b], n[a:b]) for a, b in zip(heads, np.append(heads[1:], len(key)))]
        return pa.Table.from_arrays(
            [pa.array(bucket[heads], pa.int32()), pa.array([own.column("shard")[0].as_py()] * len(heads), pa.int64()),
             pa.array(blocks, pa.binary())], schema=schema)

    flagged = shards.select("shard", "part", "rows").groupBy("shard").cogroup(trusted.groupBy("of"))
    return written(flagged.applyInArrow(run, ddl), "asked")


def _low_tables(asked: DataFrame, order: int) -> DataFrame:
    """``level``, ``gram``, ``n``, written: all n-grams of ``BASE`` bytes, or of ``order``, with their counts.

    For each level above it and bucket, ``gram`` from 1 to 4 is a count and ``n`` how many n-grams have it.
    """
    ddl = "level int, gram long, n long"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(_, table):
        *above, (key, n, _) = _levels(*_merged_blocks(table.column("data").to_pylist()), order)
        level, gram, count = [np.full(len(key), min(BASE, order))], [_turned(key, min(BASE, order))], [n]
        for i, (_, held, _) in enumerate(above):
            level.append(np.full(4, order - i))
            gram.append(np.arange(1, 5))
            count.append(np.bincount(held[held < 5], minlength=5)[1:])
        return pa.Table.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip((level, gram, count), schema)],
                                    schema=schema)

    return written(asked.groupBy("bucket").applyInArrow(run, ddl), "low")


def _answers(asked: DataFrame, order: int) -> DataFrame:
    """``shard``, ``data``: each block's n-grams with minus the base-2 log of the interpolated probability."""
    base = min(BASE, order)
    low = _low_tables(asked, order)
    sizes = low.filter(F.col("level") > base).groupBy("level", F.col("gram").alias("n")).agg(
        F.sum("n").alias("times"))
    # Three numbers for each order above ``BASE``.
    cuts = {r.level: (r.d1, r.d2, r.d3) for r in _discounts(sizes, "level").collect()}
    below = probabilities(low.filter(F.col("level") == base).select("gram", "n"), base).withColumn(
        "bucket", _bucket(F.shiftright("gram", 8), _buckets(asked.sparkSession)))
    ddl = "shard long, data binary"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(own: pa.Table, told: pa.Table) -> pa.Table:
        shards, blocks = own.column("shard").to_pylist(), own.column("data").to_pylist()
        levels = _levels(*_merged_blocks(blocks), order)
        gram, p = told.column("gram").to_numpy(), told.column("p").to_numpy()
        place = np.argsort(gram)
        p = p[place][np.searchsorted(gram[place], _turned(levels[-1][0], base))]
        for level, (key, n, shorter) in zip(range(base + 1, order + 1), reversed(levels[:-1])):
            d1, d2, d3 = cuts[level]
            cut = np.minimum(np.where(n == 1, d1, np.where(n == 2, d2, d3)), n)
            heads = np.flatnonzero(np.diff(key >> 8, prepend=-1))
            total, left = (np.repeat(np.add.reduceat(x, heads), np.diff(np.append(heads, len(key)))) for x in (n, cut))
            seen = total > 0
            total = np.maximum(total, 1)
            p = (n - cut) / total + np.where(seen, left / total, 1.0) * p[shorter]
        b = -np.log2(p).astype(np.float32)
        told = []
        for data in blocks:
            key = _unpack(data, np.int64, np.int64)[0]
            told.append(_pack(key, b[np.searchsorted(levels[0][0], key)]))
        return pa.Table.from_arrays([pa.array(shards, pa.int64()), pa.array(told, pa.binary())], schema=schema)

    return asked.groupBy("bucket").cogroup(below.groupBy("bucket")).applyInArrow(run, ddl)


def probabilities(asked: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram``, ``p``: the interpolated probability of every n-gram of ``asked``, of which those with ``n`` > 0 were seen.

    The tables of all orders are sharded by n-gram and have a row for each
    distinct one; a context that was not seen leaves all weight to the order below.
    """
    tables = {order: written(asked.groupBy("gram").agg(F.sum("n").alias("n")), "grams")}
    for level in range(order - 1, 0, -1):
        # Continuation counts: in how many contexts the shorter n-gram occurs.
        tables[level] = tables[level + 1].groupBy((F.col("gram") % BYTES ** level).alias("gram")).agg(
            F.count_if(F.col("n") > 0).alias("n"))
    below = None
    for level in range(1, order + 1):
        n = F.col("n")
        keyed = tables[level].withColumn("context", F.shiftright("gram", 8))
        cut = F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))
        # One row of discounts.
        seen = keyed.filter(n > 0)
        seen = seen.join(F.broadcast(_discounts(seen))).withColumn("cut", F.least(cut, n.cast("double")))
        contexts = seen.groupBy("context").agg(F.sum("n").alias("total"), F.sum("cut").alias("left"))
        own = seen.select("gram", (n - F.col("cut")).alias("own"))
        joined = keyed.select("gram", "context").join(own, "gram", "left").join(contexts, "context", "left")
        if below is None:
            joined, lower = joined.drop("context"), F.lit(1 / BYTES)
        else:
            joined = joined.withColumn("shorter", F.col("gram") % BYTES ** (level - 1)).join(
                below.select(F.col("gram").alias("shorter"), F.col("p").alias("lower")), "shorter")
            lower = F.col("lower")
        rest = F.coalesce(F.col("left") / F.col("total"), F.lit(1.0))
        p = F.coalesce(F.col("own") / F.col("total"), F.lit(0.0)) + rest * lower
        below = written(joined.select("gram", p.alias("p")), f"level{level}")
    return below


def perplexity(docs: DataFrame, good: DataFrame, order: int = ORDER, name: str = "bits",
               keep_text: bool = True) -> DataFrame:
    """``docs`` with ``bits``: log2 of the perplexity per byte of the whole text, null without text.

    The model is trained on the documents of ``docs`` whose ids are in ``good``.
    A column of that name is replaced; without ``keep_text`` there is no ``text``.
    """
    columns = [c for c in docs.columns if c != name and (keep_text or c != "text")]
    shards = _shards(docs, columns)
    answers = _answers(_asked(shards, good, order), order)
    out = StructType([*[docs.schema[c] for c in columns], *StructType.fromDDL(f"`{name}` double").fields])
    schema = to_arrow_schema(out)

    def score(own: pa.Table, told: pa.Table) -> pa.Table:
        blocks = [(np.zeros(0, np.int64), np.zeros(0, np.float32)),
                  *(_unpack(d, np.int64, np.float32) for d in told.column("data").to_pylist())]
        key, b = map(np.concatenate, zip(*blocks))
        gram = _turned(key, order)
        place = np.argsort(gram)
        gram, b = gram[place], b[place].astype(np.float64)
        parts = []
        for rows in own.column("rows"):
            held = _unpacked(rows.as_buffer())
            scores = []
            for _, some in _slices(held.column(-1)):
                read, sizes = _grams_of(some, order)
                # In order, each distinct n-gram is looked up once, next to the one before.
                place = np.argsort(read)
                read = read[place]
                heads = np.flatnonzero(np.diff(read, prepend=-1))
                bits = np.empty(len(read))
                bits[place] = np.repeat(b[np.searchsorted(gram, read[heads])], np.diff(np.append(heads, len(read))))
                edges = np.cumsum(sizes)
                scores += [float(bits[z - n:z].mean()) if n else None for z, n in zip(edges.tolist(), sizes.tolist())]
            parts.append(pa.Table.from_arrays(
                [*[c.cast(f.type) for c, f in zip(held.columns[:len(columns)], schema)],
                 pa.chunked_array([pa.array(scores, pa.float64())])], schema=schema))
        return pa.concat_tables(parts) if parts else schema.empty_table()

    return (shards.select("shard", "rows").groupBy("shard").cogroup(answers.groupBy("shard"))
            .applyInArrow(score, out))


def thresholds(scored: DataFrame, quantile: float, least: int) -> DataFrame:
    """``lang``, ``bound``: the quantile of the trusted scores of each language; null is one too.

    Scores are counted in steps, so a language of any size is a bounded
    histogram, and the quantile is exact to a step. A language with fewer than
    ``least`` trusted texts has no row.
    """
    histogram = scored.filter("bits IS NOT NULL").groupBy(
        "lang", F.round(F.col("bits") / STEP).cast("long").alias("step")).agg(F.count(F.lit(1)).alias("n"))
    place = Window.partitionBy("lang").orderBy("step")
    ranked = histogram.select("lang", "step", F.sum("n").over(place).alias("upto"),
                              F.sum("n").over(Window.partitionBy("lang")).alias("all"))
    return (ranked.filter((F.col("upto") >= F.ceil(F.col("all") * quantile)) & (F.col("all") >= least))
            .groupBy("lang").agg(((F.min("step") + 0.5) * STEP).alias("bound")))


def _trusted(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ids of trusted documents: those to train on, and one of ``FOLDS`` parts for the bounds.

    Bounds from the training texts would be too low for other texts.
    """
    marks = labels.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    good = marks.filter("quality = 1 AND coalesce(toxic, 0) <> 1 AND doc_id IS NOT NULL").select("doc_id")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0
    return good.filter(~held), good.filter(held)


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, least: int = 50,
             order: int = ORDER) -> DataFrame:
    """``docs`` without ``text``, with ``bits``, ``bound`` and ``rejected``.

    Trusted are documents with a label of quality 1 and no label of toxic 1;
    four in five train the model and the others give the bounds. A document is
    rejected if its bits exceed the ``quantile`` of the latter in its language
    (null is a language); a language with fewer than ``least`` of them takes
    the quantile of all. Documents without text are not rejected, and nothing
    is where no trusted text is left for the bounds. Labels with null values or
    of unknown ids count for nothing, repeated ones once. Null and repeated ids
    stay, row by row; an empty table gives an empty result; columns of the
    result's names are replaced.
    """
    good, held = _trusted(labels)
    own = [c for c in docs.columns if c not in ("text", "bits", "bound", "rejected")]
    scored = written(perplexity(docs.select(*own, "text"), good, order, keep_text=False), "scored")
    bounds, every = _bounds(scored, held, quantile, least)
    # One row at most.
    scored = scored.join(F.broadcast(every))
    return scored.join(bounds, F.col("lang").eqNullSafe(F.col("of")), "left").select(
        *own, "bits", F.coalesce("own_bound", "any_bound").alias("bound"),
        F.coalesce(F.col("bits") > F.coalesce("own_bound", "any_bound"), F.lit(False)).alias("rejected"))


def _bounds(scored: DataFrame, good: DataFrame, quantile: float, least: int) -> tuple[DataFrame, DataFrame]:
    """Bounds per language, and the one over all languages."""
    trusted = written(scored.select("doc_id", "lang", "bits").join(good, "doc_id", "left_semi")
                      .select("lang", "bits"), "trusted")
    every = thresholds(trusted.select(F.lit("").alias("lang"), "bits"), quantile, 1)
    own = thresholds(trusted, quantile, least).select(F.col("lang").alias("of"), F.col("bound").alias("own_bound"))
    return written(own, "bounds"), every.agg(F.max("bound").alias("any_bound"))


def keep_good(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, least: int = 50,
              order: int = ORDER) -> DataFrame:
    """``docs`` without the rows that ``classify`` rejects.

    The scored rows are written with their texts, so that each text is scored once.
    The bounds are a written table of one row per language, whose size Spark
    checks before it broadcasts it.
    """
    good, held = _trusted(labels)
    scored = written(perplexity(docs, good, order, "_bits"), "scored")
    bounds, every = _bounds(scored.withColumn("bits", F.col("_bits")), held, quantile, least)
    judged = scored.join(F.broadcast(every)).join(bounds, F.col("lang").eqNullSafe(F.col("of")), "left")
    kept = judged.filter(~F.coalesce(F.col("_bits") > F.coalesce("own_bound", "any_bound"), F.lit(False)))
    return kept.select(*docs.columns)
