"""Token ids in shards with a minimal perfect hash index.

Documents are ranged by id, tokenised, and written as a table with one row per
shard: the raw ids of some documents one after another, and the index of the
shard. The index is a minimal perfect hash: at each level the keys left over
are hashed to bits, keys alone on their bit are placed there, and the others go
to the next level. The rank of a key's bit is its slot, and the slot holds the
key's fingerprint and its offset and length in the payload. So a read costs a
few bit tests whatever the size of the shard, and a key that is not there is
told by its fingerprint.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from storeloom.llm import pieces
from storeloom.llm.common import text_of
from storeloom.llm.intervals import END, sweep

#: ``first_id`` and ``last_id`` are of first copies, so no two shards overlap.
SHARD = "part int, shard int, first_id long, last_id long, n_docs long, n_ids long, keys binary, index binary, payload binary"
#: Bits per key at a level, and the most levels before the keys left are listed.
SPARSE, LEVELS = 2, 24


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of ``(id, copy)`` rows."""
    with np.errstate(over="ignore"):
        x = keys[:, 0] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0x632BE59BD9B4E019 % (1 << 64))
        for part in (keys[:, 1], np.uint64(0)):
            x = (x ^ (x >> np.uint64(31)) ^ part) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


class PerfectHash:
    """Slots 0 to n - 1 for n distinct keys."""

    def __init__(self, bits: list[np.ndarray], rest: np.ndarray):
        self.bits, self.rest = bits, rest
        self.ranks, base = [], 0
        for level in bits:
            self.ranks.append(base + np.cumsum(level) - level)
            base += int(level.sum())
        self.placed = base

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        bits, left = [], keys
        while len(left) and len(bits) < LEVELS:
            size = max(64, SPARSE * len(left))
            at = (_mixed(left, len(bits) + 1) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            bits.append(alone.astype(np.int64))
            left = left[~alone[at]]
        return cls(bits, left)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; some slot or -1 for a key that is not among them."""
        out = np.full(len(keys), -1, dtype=np.int64)
        for number, (level, rank) in enumerate(zip(self.bits, self.ranks), start=1):
            left = np.flatnonzero(out < 0)
            at = (_mixed(keys[left], number) % np.uint64(len(level))).astype(np.int64)
            hit = level[at] > 0
            out[left[hit]] = rank[at[hit]]
        for i, key in enumerate(self.rest):
            out[(out < 0) & (keys == key).all(axis=1)] = self.placed + i
        return out


def _index_bytes(keys: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> bytes:
    found = PerfectHash.build(keys)
    slot = found.slots(keys)
    order = np.empty(len(keys), dtype=np.int64)
    order[slot] = np.arange(len(keys))
    out = io.BytesIO()
    np.savez(out, sizes=np.array([len(b) for b in found.bits]),
             bits=np.packbits(np.concatenate([*found.bits, np.zeros(0, np.int64)]).astype(bool)),
             rest=found.rest, prints=(_mixed(keys, 0) >> np.uint64(32)).astype("<u4")[order],
             starts=starts[order], lengths=lengths[order])
    return out.getvalue()


class ShardIndex:
    def __init__(self, data: bytes):
        with np.load(io.BytesIO(data)) as held:
            sizes = held["sizes"]
            flat = np.unpackbits(held["bits"])[:int(sizes.sum())].astype(np.int64)
            self.hash = PerfectHash(np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else [], held["rest"])
            self.prints, self.starts, self.lengths = held["prints"], held["starts"], held["lengths"]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(start, length)`` in the payload; -1 for keys that are not there."""
        slot = self.hash.slots(keys)
        slot[slot >= len(self.prints)] = -1
        there = slot >= 0
        prints = (_mixed(keys, 0) >> np.uint64(32)).astype("<u4")
        there[there] = self.prints[slot[there]] == prints[there]
        start = np.where(there, self.starts[slot] if len(self.starts) else -1, -1)
        return start, np.where(there, self.lengths[slot] if len(self.lengths) else -1, -1)


def _key_rows(ids: list[int | None], before: tuple[int | None, int] | None) -> np.ndarray:
    """``(id, copy)`` per row of sorted ids; copies of an id are numbered, null ids set apart."""
    out = np.empty((len(ids), 2), dtype=np.uint64)
    last, copy = before if before else (object(), 0)
    for i, value in enumerate(ids):
        copy = copy + 1 if value == last else 0
        last = value
        out[i] = (0, copy + (1 << 63)) if value is None else (value % (1 << 64), copy)
    return out


def write(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2, id_col: str = "doc_id",
          text_col: str = "text", shard_ids: int = 1 << 20, mode: str = "errorifexists") -> TokenStore:
    """Tokenise ``docs`` and write them to ``path`` in ascending id order.

    Every document ends in ``end_id``. Null and empty texts are the end id
    alone. Null ids come first; rows of one id stand one after another in the
    order of their text and are told apart by ``copy`` (0, 1, ...). A shard
    closes after ``shard_ids`` ids, so it holds at most one document more.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    schema = to_arrow_schema(StructType.fromDDL(SHARD))

    def shards(batches):
        part, number = TaskContext.get().partitionId(), 0
        encoder = pieces.encoder(tokenizer)
        end = np.array([end_id], dtype=np.uint32)
        names: list[int | None] = []
        held: list[np.ndarray] = []
        size, before = 0, None

        def row():
            keys = _key_rows(names, before)
            lengths = np.fromiter(map(len, held), np.int64, len(held))
            payload = np.concatenate(held)
            width = "<u2" if not len(payload) or payload.max() < 1 << 16 else "<u4"
            known = [n for n, copy in zip(names, keys[:, 1].tolist()) if copy == 0]
            return pa.RecordBatch.from_pylist([{
                "part": part, "shard": number, "first_id": known[0] if known else None,
                "last_id": known[-1] if known else None, "n_docs": len(names), "n_ids": len(payload),
                "keys": keys.astype("<u8").tobytes(),
                "index": _index_bytes(keys, np.cumsum(lengths) - lengths, lengths),
                "payload": bytes([int(width[-1])]) + payload.astype(width).tobytes()}], schema=schema)

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, tokens in zip(ids, _streamed(encoder, texts)):
                names.append(i)
                held.append(np.concatenate([tokens, end]))
                size += len(held[-1])
                if size >= shard_ids:
                    yield row()
                    before = (names[-1], int(_key_rows(names, before)[-1, 1]) & ((1 << 63) - 1))
                    names, held, size, number = [], [], 0, number + 1
        if names:
            yield row()

    (rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(shards, SHARD).write.mode(mode).option("compression", "zstd").parquet(path))
    return TokenStore(docs.sparkSession, path)


def _streamed(encoder: pieces.PieceEncoder, texts: list[str]) -> Iterator[np.ndarray]:
    begun = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= pieces.STEP or i + 1 == len(texts):
            yield from encoder.encode(texts[begun:i + 1])
            begun, size = i + 1, 0


def _ordered(number: Column) -> Column:
    """A long as bytes of the same order."""
    return F.lpad(F.conv((number.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 10, 16),
                  16, "0").cast("binary")


def _payload(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1)


class TokenStore:
    """A written store. Ids come back as little-endian unsigned 32-bit binary."""

    ROW = "part int, shard int, doc_id long, copy long, at long, n_tokens long, ids binary"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def shards(self) -> DataFrame:
        return self.spark.read.schema(SHARD).parquet(self.path)

    def starts(self) -> DataFrame:
        """``part``, ``shard``, ``base``: the ids of all shards before each one."""
        sizes = self.shards().select("part", "shard", "n_ids")
        inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        # One row per range partition.
        parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(
            F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("before"))
        return sizes.join(F.broadcast(parts), "part").select(
            "part", "shard", (F.col("before") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("base"))

    def read_all(self) -> DataFrame:
        """Every document through the index: ``ROW``'s columns. ``at`` counts ids of its shard before it."""
        schema = to_arrow_schema(StructType.fromDDL(self.ROW))

        def run(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    yield from _found(row, np.frombuffer(row["keys"], "<u8").reshape(-1, 2), schema)

        return self.shards().select("part", "shard", "keys", "index", "payload").mapInArrow(run, self.ROW)

    def lookup(self, keys: DataFrame, id_col: str = "doc_id") -> DataFrame:
        """The documents of the given ids (first copies): ``ROW``'s columns, nothing for unknown ids.

        A sorted sweep finds the shard of each id, and only the indexes and
        payloads of these shards are used.
        """
        bounds = self.shards().filter("last_id IS NOT NULL").select(
            _ordered(F.col("first_id")).alias("low"), F.concat(_ordered(F.col("last_id")), F.lit(END)).alias("high"),
            F.struct("part", "shard").alias("top"), F.lit(None).cast("struct<part:int,shard:int>").alias("around"))
        asked = keys.select(F.col(id_col).cast("long").alias("id")).filter("id IS NOT NULL").distinct()
        points = asked.withColumn("key", _ordered(F.col("id"))).withColumn("spread", F.lit(0))
        wanted = (sweep(points, bounds, "lookup").filter("top IS NOT NULL")
                  .groupBy("top.part", "top.shard").agg(F.collect_list("id").alias("asked")))
        schema = to_arrow_schema(StructType.fromDDL(self.ROW))

        def run(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    ids = np.array([k % (1 << 64) for k in row["asked"]], dtype=np.uint64)
                    yield from _found(row, np.stack([ids, np.zeros_like(ids)], axis=1), schema)

        return (self.shards().join(wanted, ["part", "shard"])
                .select("part", "shard", "asked", "index", "payload").mapInArrow(run, self.ROW))


def _found(row: dict, keys: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    start, length = ShardIndex(row["index"]).find(keys)
    payload = _payload(row["payload"])
    there = np.flatnonzero(start >= 0)
    out = pd.DataFrame({
        "part": row["part"], "shard": row["shard"],
        "doc_id": [None if c >> 63 else (k - (1 << 64) if k >> 63 else k) for k, c in keys[there].tolist()],
        "copy": [c & ((1 << 63) - 1) for c in keys[there, 1].tolist()],
        "at": start[there], "n_tokens": length[there],
        "ids": [payload[a:a + n].astype("<u4").tobytes()
                for a, n in zip(start[there].tolist(), length[there].tolist())]})
    out["doc_id"] = out["doc_id"].astype("Int64")
    yield pa.RecordBatch.from_pandas(out, schema=schema, preserve_index=False)
