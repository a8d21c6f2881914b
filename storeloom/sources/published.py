"""Tables in partitions that are replaced together and become visible together.

Each run writes new folders ``<table>/run=<id>/part=<value>`` and then one row
for every partition of every table into the manifest, as one file. Readers take
the newest version of the manifest, so a run that fails on the way changes
nothing, partitions that a run leaves alone keep their files, and all tables of
a version belong together. One writer at a time; older runs stay on disk.

A table is read as plain Parquet folders, so a filter on ``part`` prunes them.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

_MANIFEST = "version bigint, table string, part string, run string"
#: What a partition value may hold, so that folders need no escapes.
_PART = re.compile(r"[A-Za-z0-9._-]+")


@dataclass(frozen=True)
class Store:
    """Published tables below ``root``, any Hadoop path."""

    spark: SparkSession
    root: str

    def _path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _newest(self) -> tuple[int, dict[tuple[str, str], str]]:
        """The newest version, and the run of each of its tables' partitions."""
        try:
            rows = self.spark.read.schema(_MANIFEST).parquet(self._path("manifest"))
            # One row for each partition, like a catalog.
            newest = rows.filter(F.col("version") == rows.agg(F.max("version")).scalar()).collect()
        except AnalysisException:
            return 0, {}
        return max((r.version for r in newest), default=0), {
            (r.table, r.part): r.run for r in newest if r.table is not None}

    def version(self) -> int:
        """The number of the newest version; 0 before the first."""
        return self._newest()[0]

    def parts(self, table: str) -> list[str]:
        return sorted(part for name, part in self._newest()[1] if name == table)

    def read(self, table: str, schema: StructType, parts: Iterable[str] | None = None) -> DataFrame:
        """A table with its column ``part``; ``parts`` limits it to some partitions, by folder."""
        wanted = None if parts is None else set(parts)
        runs = [(part, run) for (name, part), run in sorted(self._newest()[1].items())
                if name == table and (wanted is None or part in wanted)]
        return self._folders(table, schema, runs)

    def _folders(self, table: str, schema: StructType, runs: list[tuple[str, str]]) -> DataFrame:
        whole = StructType([*schema.fields, StructField("part", StringType())])
        if not runs:
            return self.spark.createDataFrame([], whole)
        base = self._path(table)
        return (self.spark.read.schema(StructType([*whole.fields, StructField("run", StringType())])).option("basePath", base)
                .parquet(*[f"{base}/run={run}/part={part}" for part, run in runs]).drop("run"))

    def start(self) -> Run:
        return Run(self, uuid.uuid4().hex)


class Run:
    """The writes of one run, which nobody else sees before :meth:`publish`."""

    def __init__(self, store: Store, name: str):
        self.store, self.name = store, name
        self.version, self.held = store._newest()
        self.replaced: dict[str, set[str]] = {}
        self.written: dict[str, list[str]] = {}

    def replace(self, table: str, rows: DataFrame, touched: Iterable[str]) -> None:
        """Write ``rows``, which have a column ``part``, in place of the ``touched`` partitions.

        A touched partition without rows is gone afterwards. A large partition
        is written by several tasks, small ones share a task.
        """
        touched = set(touched)
        odd = [p for p in touched if not _PART.fullmatch(p)]
        if odd:
            raise ValueError(f"no name of a partition: {odd[0]!r}")
        path = f"{self.store._path(table)}/run={self.name}"
        rows.hint("rebalance", "part").write.partitionBy("part").parquet(path)
        try:
            found = {r.part for r in self.store.spark.read.schema("part string").parquet(path)
                     .select("part").distinct().collect()}
        except AnalysisException:
            found = set()
        if found - touched:
            raise ValueError(f"{table} has rows of other partitions: {sorted(found - touched)[:3]}")
        self.replaced[table], self.written[table] = touched, sorted(found)

    def read(self, table: str, schema: StructType, parts: Iterable[str] | None = None) -> DataFrame:
        """A table as it will be when this run is published."""
        wanted = None if parts is None else set(parts)
        runs = [(part, run) for (name, part), run in sorted(self._next().items())
                if name == table and (wanted is None or part in wanted)]
        return self.store._folders(table, schema, runs)

    def _next(self) -> dict[tuple[str, str], str]:
        kept = {k: run for k, run in self.held.items() if k[1] not in self.replaced.get(k[0], ())}
        return kept | {(t, part): self.name for t, parts in self.written.items() for part in parts}

    def publish(self) -> int:
        """Make all writes visible at once, and return the new version.

        Fails if another run has published since this one started.
        """
        if self.store.version() != self.version:
            raise RuntimeError(f"version {self.version} of {self.store.root} is not the newest any more")
        version = self.version + 1
        rows = [(version, t, part, run) for (t, part), run in self._next().items()]
        # One file, so that a version is there as a whole or not at all; a store without rows has a version too.
        (self.store.spark.createDataFrame(rows or [(version, None, None, None)], _MANIFEST)
         .coalesce(1).write.mode("append").parquet(self.store._path("manifest")))
        return version
