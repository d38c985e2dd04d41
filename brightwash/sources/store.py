"""A versioned store of derived tables, found again by what they derive from.

A table is filed under its name, a hash of its parameters, and a fingerprint of
its source files (path, length and modification time of each). Asking for it
again with the same parameters while no source file has changed reads the
stored copy; anything else builds and stores a new version. Old versions stay,
so a reader of one is never disturbed.

Writers do not need a lock. Each writes into a folder of its own and then, as
the commit, a marker file named after it; of several committed copies of one
version all readers take the same (the first by name). A write that died leaves
a folder without a marker, which no lookup sees.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from brightwash.session import checkpoint_root

# Part of every key: raise it when a change of the package's rules makes
# tables of the same parameters and sources come out differently.
RULES = 1
_MARKER = "/commits/[0-9a-f]{16}/[0-9a-f]{32}/[^/]*$"


@dataclass(frozen=True)
class Stored:
    """A table of the store, and whether it was there already."""

    data: DataFrame
    hit: bool
    path: str


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


class TableStore:
    """Derived tables under ``root`` (default: a folder of the shared checkpoint
    folder, so that executors and later sessions find them)."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or os.path.join(checkpoint_root(spark), "store")

    def get(
        self,
        name: str,
        sources: list[str],
        build: Callable[[], DataFrame],
        params: object = None,
        schema: StructType | None = None,
    ) -> Stored:
        """The table ``name`` derived from the files under ``sources``.

        ``params`` is anything whose ``repr`` tells all that the table depends on
        besides its sources. A hit costs one job that lists the sources and the
        committed versions together; with ``schema`` the stored files need not
        be asked for theirs.
        """
        told = hashlib.sha256(repr((RULES, params)).encode()).hexdigest()[:16]
        folder = os.path.join(self.root, name, told)
        version, committed = self._lookup(sources, folder)
        copy = min((name for of, name in committed if of == version), default=None)
        if copy is not None:
            path = os.path.join(folder, "data", version, copy)
            reader = self.spark.read if schema is None else self.spark.read.schema(schema)
            return Stored(reader.parquet(path), True, path)
        copy = uuid.uuid4().hex
        path = os.path.join(folder, "data", version, copy)
        built = build()
        built.write.parquet(path)
        commit = self.spark.range(1).select(F.lit(path).alias("path")).coalesce(1)
        commit.write.text(os.path.join(folder, "commits", version, copy))
        return Stored(self.spark.read.schema(built.schema).parquet(path), False, path)

    def _lookup(self, sources: list[str], folder: str) -> tuple[str, list[tuple[str, str]]]:
        """Fingerprint of the source files, and (version, copy) of all commits in
        ``folder``: one listing, whose rows carry no file content."""
        markers = os.path.join(folder, "commits", "*", "*")
        try:
            return self._listed([*sources, markers])
        except AnalysisException as absent:
            if absent.getCondition() != "PATH_NOT_FOUND":
                raise
            # nothing stored yet; an absent source raises again
            return self._listed(sources)

    def _listed(self, paths: list[str]) -> tuple[str, list[tuple[str, str]]]:
        reader = self.spark.read.format("binaryFile").option("recursiveFileLookup", True)
        files = reader.load(paths).select("path", "modificationTime", "length")
        marker = F.col("path").rlike(_MARKER)
        state = F.when(~marker, F.xxhash64("path", F.unix_micros("modificationTime"), "length").cast("decimal(38,0)"))
        seen = Observation(f"sources-{uuid.uuid4().hex[:8]}")
        # source files are only summed up in the tasks; versions, few, come back
        files = files.observe(seen, F.count(state).alias("files"), F.coalesce(F.sum(state), F.lit(0)).alias("state"))
        # file sizes do not matter to a listing: few tasks however large the sources
        with _setting(self.spark, "spark.sql.files.maxPartitionBytes", str(1 << 50)):
            rows = files.filter(marker).select("path").collect()
        version = hashlib.sha256(f"{seen.get['files']}:{seen.get['state']}".encode()).hexdigest()[:16]
        return version, [tuple(row.path.split("/")[-3:-1]) for row in rows]
