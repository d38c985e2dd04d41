"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwash.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class Shared:
    """A driver object of bounded size broadcast to the tasks together with
    its class, so that the package need not be installed on the executors."""

    def __init__(self, spark: SparkSession, value: object):
        self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get(self):
        return pickle.loads(self.sent.value)


BATCH_ROWS = 1024


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of ``BATCH_ROWS`` rows at most: rows are
    long here, and a worker holds a whole batch."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` under the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


HOT_KEYS = 4096


def join_one(many: DataFrame, one: DataFrame, on: list[str]) -> DataFrame:
    """Inner join of ``many`` with ``one``, which has one row a key, however
    often a key occurs in ``many``: keys that hold 1/``HOT_KEYS`` of its rows or
    more, at most ``HOT_KEYS`` of them, meet a broadcast of their rows of
    ``one``; only the others are shuffled. ``many`` is read three times, so it
    should be a written table."""
    least = many.count() // HOT_KEYS + 1
    hot = written(many.groupBy(*on).count().filter(F.col("count") >= least).select(*on), "hot")
    often = many.join(F.broadcast(one.join(F.broadcast(hot), on, "left_semi")), on)
    rest = many.join(F.broadcast(hot), on, "left_anti").join(one, on)
    return often.unionByName(rest)


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id written as decimal text, modulo ``modulus``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def utf8_values(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow string column as UTF-8 bytes; null becomes empty."""
    return [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], text: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``max_bytes`` of ``text``
    (one longer text makes a batch of its own), bounding a task's memory."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.array([0 if v is None else v for v in pa.compute.binary_length(column).to_pylist()], np.int64)
        start, used = 0, 0
        for i, size in enumerate(sizes):
            if i > start and used + size > max_bytes:
                yield batch.slice(start, i - start)
                start, used = i, 0
            used += int(size)
        yield batch.slice(start)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return start, np.diff(np.r_[start, len(keys)])


_SEGMENT = 15  # bits of a filter's slot within one row of its table


def bit_filter(keys: DataFrame, bits: int, at_least: int = 1):
    """Broadcast table of 2**bits bits: a bit is set where at least ``at_least``
    rows of ``keys`` (one long column) fall on it. Its size does not grow with
    the rows; a fuller table only lets more other keys pass."""
    slot = F.col(keys.columns[0]).bitwiseAND(F.lit((1 << bits) - 1))
    slots = keys.select(slot.alias("slot")).groupBy("slot").agg(F.count("*").alias("n"))
    slots = slots.filter(F.col("n") >= at_least)
    rows = slots.groupBy(F.shiftright("slot", _SEGMENT).alias("segment")).agg(
        F.collect_list(F.col("slot").bitwiseAND(F.lit((1 << _SEGMENT) - 1)).cast("int")).alias("slots")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for slots in batch.column(1).to_pylist():
                flags = np.zeros(1 << _SEGMENT, np.uint8)
                flags[slots] = 1
                out.append(np.packbits(flags, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["segment", "bits"])

    table = np.zeros(max(1, 1 << max(0, bits - _SEGMENT)), f"V{1 << (_SEGMENT - 3)}")
    found = rows.mapInArrow(pack, "segment long, bits binary").toArrow()
    for segment, data in zip(found.column("segment").to_pylist(), found.column("bits").to_pylist()):
        table[segment] = data
    return keys.sparkSession.sparkContext.broadcast(table.tobytes())


def in_filter(rows: DataFrame, table, column: str) -> DataFrame:
    """The rows whose ``column`` (long) may be among the keys of a bit filter."""
    at = rows.columns.index(column)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(table.value, np.uint8)
        for batch in batches:
            slot = batch.column(at).to_numpy() & (8 * len(bits) - 1)
            hit = (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1
            yield batch.filter(pa.array(hit.astype(bool)))

    return rows.mapInArrow(work, rows.schema)
