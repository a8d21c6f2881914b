"""Byte-level BPE encoding in overlapping chunks, and decoding.

Matching the pre-token pattern runs from left to right and looks back at
nothing. So two scans that start at different places agree from the first
boundary they share, but for the last few characters that a scan sees. Texts
are cut into chunks that overlap; every chunk is pre-tokenised on its own;
the chunks of a text are stitched at the first boundary that neighbours share
inside the overlap, and the pieces are encoded.

Texts of one chunk need no stitching and stay where they are; the chunks of
longer ones are spread over the cluster.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, StructField, StructType

from storeloom.llm import pieces
from storeloom.llm.common import groups, text_of, written

CHUNK, OVERLAP = 1 << 16, 1 << 10
#: A scan may err on boundaries this close to its end: a match looks ahead two characters.
AHEAD = 3


def cut(text: str, chunk: int, overlap: int) -> list[str]:
    """The chunks of a text, each with ``overlap`` characters of the next."""
    return [text[i:i + chunk + overlap] for i in range(0, max(1, len(text)), chunk)]


def chunk_boundaries(chunk: str) -> np.ndarray:
    """Where pre-tokens start in a chunk scanned from its first character."""
    points = pieces.code_points(chunk)
    starts = np.zeros(1 if len(points) else 0, dtype=np.int64)
    return np.flatnonzero(pieces.boundaries(points, starts))


def stitch(chunks: list[str], marks: list[np.ndarray], chunk: int, overlap: int) -> tuple[str, np.ndarray]:
    """The whole text and its piece starts, from chunks and their boundaries.

    Where neighbours share no boundary, as in one very long word, the scan on
    the left is carried on over the next chunk.
    """
    whole = "".join(c[:chunk] for c in chunks[:-1]) + chunks[-1]
    begun, found = 0, []  # the scan in hand starts at ``begun`` and has these boundaries
    scan, seen = marks[0], len(chunks[0])
    for i in range(1, len(chunks)):
        border = i * chunk
        left = scan + begun
        left = left[left <= begun + seen - AHEAD]
        shared = np.intersect1d(left[left >= border], marks[i] + border, assume_unique=True)
        if len(shared):
            found.append(left[left < shared[0]])
            scan = marks[i] + border
            scan, begun, seen = scan[scan >= shared[0]] - border, border, len(chunks[i])
        else:
            last = int(left[-1]) if len(left) else begun
            found.append(left[left < last])
            stop = min(len(whole), border + chunk + overlap)
            scan, begun, seen = chunk_boundaries(whole[last:stop]), last, stop - last
    found.append(scan + begun)
    return whole, np.concatenate(found)


def _ids_of(path: str, texts: list[str], firsts: list[np.ndarray] | None = None) -> list[bytes]:
    encoder = pieces.encoder(path)
    if firsts is None:
        return [ids.astype("<u4").tobytes() for ids in encoder.encode(texts)]
    return [encoder.encode_at(text, first).astype("<u4").tobytes() for text, first in zip(texts, firsts)]


def encode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``id_col`` and ``ids``: the token ids of every whole text, little-endian unsigned 32-bit.

    ``ranks`` names a rank file that all executors have. Null and empty texts
    get empty ids; special tokens' strings are ordinary text. Null and repeated
    ids stay, row by row; an empty table gives an empty result; other columns
    are ignored. One row's text and ids must fit a task.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = docs.schema[id_col].dataType
    out = f"id {kind.simpleString()}, ids binary"
    is_long = F.char_length("text") > chunk + overlap

    def whole(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for some in groups(map(len, texts)):
                part = batch.column(0)[some.start:some.stop]
                yield pa.RecordBatch.from_arrays(
                    [part, pa.array(_ids_of(ranks, texts[some]), pa.binary())], ["id", "ids"])

    def spread(batches):
        for batch in batches:
            for key, row, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for i, piece in enumerate(cut(text, chunk, overlap)):
                    yield pa.RecordBatch.from_pylist([{"id": key, "row": row, "i": i, "piece": piece}],
                                                     schema=batch_schema)

    def scan(batches):
        for batch in batches:
            marks = [chunk_boundaries(c).astype("<i4").tobytes() for c in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.binary())],
                                             [*batch.schema.names, "marks"])

    def join(_, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("i")
        text, first = stitch(frame["piece"].tolist(), [np.frombuffer(m, "<i4").astype(np.int64)
                                                       for m in frame["marks"]], chunk, overlap)
        return pd.DataFrame({"id": frame["id"].iloc[:1], "ids": _ids_of(ranks, [text], [first])})

    short = rows.filter(~is_long).mapInArrow(whole, out)
    # Written, as the row numbers must hold when a lost task runs again.
    long = written(rows.filter(is_long).withColumn("row", F.monotonically_increasing_id())
                   .select("id", "row", "text"), "long")
    cut_schema = f"id {kind.simpleString()}, row long, i int, piece string"
    batch_schema = to_arrow_schema(StructType.fromDDL(cut_schema))
    chunks = long.mapInArrow(spread, cut_schema).repartition("row", "i")
    stitched = (chunks.mapInArrow(scan, cut_schema + ", marks binary")
                .groupBy("row").applyInPandas(join, out))
    return short.unionByName(stitched).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of its ids. Null ids give null."""
    kept = [c for c in encoded.columns if c != "decoded"]

    def bytes_of(batches):
        encoder = pieces.encoder(ranks)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            for some in groups((len(v or b"") for v in ids), 8 << 20):
                part = batch.slice(some.start, some.stop - some.start)
                texts = [None if v is None else encoder.decode(np.frombuffer(v, "<u4")) for v in ids[some]]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())],
                                                 [*part.schema.names, "decoded"])

    rows = encoded.select(*kept)
    return rows.mapInArrow(bytes_of, StructType([*rows.schema.fields, StructField("decoded", BinaryType())]))
