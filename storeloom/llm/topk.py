"""Exact top-k inner products by a three-phase uniform threshold.

The components of a vector are cut into ``lists`` slices, and each slice gives
every query a score list. Per block of queries:

1. every partition gathers the ``k`` best entries of each local list with their
   totals; the k-th best total over all partitions is a cutoff that the final
   k-th score cannot fall below;
2. the cutoffs (one number per query) go to all tasks. A vector whose total
   reaches the cutoff has at least one slice score of cutoff / lists or more,
   so only entries from there on are collected;
3. of the collected entries, those whose bound still reaches the cutoff get
   their exact totals.

Queries go out in blocks of at most ``block_bytes``, whatever their number; the
vectors are scanned once per block and phase and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from storeloom.llm.common import written



def scaled(vector: Column, factor: int = 256) -> Column:
    """``floor(factor * x)`` per component; null where the vector takes no part.

    That is where a component is null or not finite, or its scaled value no
    64-bit number.
    """
    def wide(x: Column) -> Column:
        return F.lit(float(factor)) * x.cast("double")

    usable = F.forall(vector, lambda x: x.isNotNull() & (F.abs(wide(x)) < float(1 << 63)))
    return F.when(usable, F.transform(vector, lambda x: F.floor(wide(x))))


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), dtype=np.int64)
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def _slices(width: int, lists: int) -> list[slice]:
    edges = np.linspace(0, width, lists + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:]) if b > a] or [slice(0, width)]


def _products(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact integer products.

    Through doubles where every sum stays below 2**53, in 64 bits below 2**63,
    else in Python's integers, which have no bound.
    """
    if vectors.size and queries.size:
        most = int(np.abs(vectors).max()) * int(np.abs(queries).max()) * vectors.shape[1]
        if most < 1 << 53:
            return (vectors.astype(np.float64) @ queries.T.astype(np.float64)).astype(np.int64)
        if most >= 1 << 62:
            return vectors.astype(object) @ queries.T.astype(object)
    return vectors @ queries.T


def _pieces(frames: Iterator[pd.DataFrame], width: int, rows: int):
    for frame in frames:
        for start in range(0, len(frame), rows):
            part = frame.iloc[start:start + rows]
            yield part["vec_id"].to_numpy(), _matrix(part["parts"], width)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, lists: int = 4,
          id_col: str = "vec_id", vector_col: str = "embedding", factor: int = 256,
          block_bytes: int = 32 << 20, task_bytes: int = 32 << 20) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` best rows per query.

    A score is the integer inner product of the scaled vectors; shorter vectors
    count as ended by zeros. Ties go to the smaller id. Rows with the query's
    own id are no candidates; other repeated ids count row by row. A row takes
    no part if its id or vector is null or a component is null, not finite or,
    scaled, beyond 64 bits; neither do repeated query ids after the first (the
    one that sorts first). Scores are exact however large the components are;
    one beyond 64 bits, which the result cannot hold, is an error. Queries with
    fewer than ``k`` candidates get all of
    them. Empty tables give an empty result; other columns are ignored.
    """
    def usable(df: DataFrame) -> DataFrame:
        return (df.select(F.col(id_col).cast("long").alias("vec_id"),
                          scaled(F.col(vector_col), factor).alias("parts"))
                .filter("vec_id IS NOT NULL AND parts IS NOT NULL"))

    spark = vectors.sparkSession
    vectors, asked = usable(vectors), usable(queries)
    asked = asked.groupBy("vec_id").agg(F.min("parts").alias("parts"))
    asked = written(asked, "queries")
    facts = asked.agg(F.count(F.lit(1)), F.max(F.size("parts"))).first()
    width = max(facts[1] or 1, vectors.agg(F.max(F.size("parts"))).first()[0] or 1)
    per_block = max(1, block_bytes // (8 * width))
    blocks = max(1, -(-facts[0] // per_block))
    chosen = _slices(width, lists)
    found = None
    for block in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toPandas()
        part = _search(vectors, spark.sparkContext.broadcast(
            (own["vec_id"].to_numpy(dtype=np.int64), _matrix(own["parts"], width))),
            chosen, width, k, task_bytes)
        found = part if found is None else found.unionByName(part)
    return found


def _search(vectors: DataFrame, queries, chosen: list[slice], width: int, k: int,
            task_bytes: int) -> DataFrame:
    spark = vectors.sparkSession
    asked = max(1, len(queries.value[0]))
    rows = max(1, task_bytes // (8 * asked * (len(chosen) + 1)))

    def gather(frames):
        ids, matrix = queries.value
        kept = [(np.empty((0, len(ids)), np.int64),) * 3 for _ in chosen]
        for vec_ids, own in _pieces(frames, width, rows):
            local = [_products(own[:, s], matrix[:, s]) for s in chosen]
            total = sum(local)
            self_row = vec_ids[:, None] == ids[None, :]
            for j, scores in enumerate(local):
                scores = np.where(self_row, np.iinfo(np.int64).min, scores)
                score = np.concatenate([kept[j][0], scores])
                best = np.argsort(-score, axis=0, kind="stable")[:k] if len(score) > k else \
                    np.tile(np.arange(len(score))[:, None], (1, len(ids)))
                kept[j] = (np.take_along_axis(score, best, 0),
                           np.take_along_axis(np.concatenate([kept[j][1], total]), best, 0),
                           np.take_along_axis(np.concatenate(
                               [kept[j][2], np.broadcast_to(vec_ids[:, None], total.shape)]), best, 0))
        for score, total, who in kept:
            real = score > np.iinfo(np.int64).min
            rank, query = np.nonzero(real)
            yield pd.DataFrame({"query_id": ids[query], "vec_id": who[rank, query],
                                "score": total[rank, query]})

    schema = "query_id long, vec_id long, score long"
    # An entry gathered from two lists is one vector, so a vector counts once.
    gathered = vectors.mapInPandas(gather, schema).distinct()
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    cutoffs = (gathered.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") == k)
               .select("query_id", "score").toPandas())
    cutoff = spark.sparkContext.broadcast(
        dict(zip(cutoffs["query_id"].tolist(), cutoffs["score"].tolist())))

    def collect(frames):
        ids, matrix = queries.value
        floor = np.iinfo(np.int64).min
        least = np.array([cutoff.value.get(int(q), floor) for q in ids], dtype=np.int64)
        # Some slice of a vector that reaches the cutoff has this score at least.
        uniform = np.where(least == floor, floor, -(-least // len(chosen)))
        for vec_ids, own in _pieces(frames, width, rows):
            entry = np.zeros((len(vec_ids), len(ids)), dtype=bool)
            bound = np.zeros(entry.shape)
            local = [_products(own[:, s], matrix[:, s]) for s in chosen]
            for scores in local:
                high = scores >= uniform
                entry |= high
                bound += np.where(high, scores, uniform.astype(np.float64)).astype(np.float64)
            # The bound is in doubles; one unit and a relative margin keep it safe.
            open_ = entry & (bound * (1 + np.sign(bound) * 1e-9) + 1 >= least)
            open_ &= vec_ids[:, None] != ids[None, :]
            row, query = np.nonzero(open_)
            total = sum(scores[row, query] for scores in local)
            real = total >= least[query]
            yield pd.DataFrame({"query_id": ids[query[real]], "vec_id": vec_ids[row[real]],
                                "score": total[real]})

    return (vectors.mapInPandas(collect, schema)
            .withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
