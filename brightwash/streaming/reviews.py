"""Incremental deduplication of a review feed (Structured Streaming).

New review files arrive in a folder, and the sink always equals
``dropDuplicates()`` of everything received so far. There is no watermark: a
review is never dropped for arriving late. Two ways, by where the reviews seen
so far are kept:

``start_keyed_dedup`` keeps them as keys in the state store (RocksDB, on
disk, with its changes in the checkpoint folder). A batch costs its own rows and
a look-up for each, however much was stored before; the sink is never read.

``start_review_dedup`` keeps no state: the stored table is the state, and each
micro-batch is deduplicated on its own and then against it. Each batch reads only the stored rows of its own date range (Parquet min/max pushdown),
so the anti join touches a slice of the sink, not all of it. A batch that is
replayed after a failure finds its rows already stored and writes nothing
twice (effectively exactly once with the checkpointed file source).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from brightwash.sources.schemas import REVIEWS


def review_stream(
    spark: SparkSession,
    source_dir: str,
    schema: StructType = REVIEWS,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files of ``source_dir`` as a stream (explicit schema)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source_dir)


def new_reviews(batch: DataFrame, stored: DataFrame | None, date_col: str = "date") -> DataFrame:
    """Rows of ``batch`` (deduplicated) not yet in ``stored``."""
    fresh = batch.dropDuplicates()
    if stored is None:
        return fresh
    bounds = batch.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).first()
    # Stored rows that can match: same date range, or a NULL date.
    relevant = F.col(date_col).isNull()
    if bounds["lo"] is not None:
        relevant = relevant | F.col(date_col).between(bounds["lo"], bounds["hi"])
    window = stored.filter(relevant)
    cols = fresh.columns
    # Full-row match with NULL = NULL, like dropDuplicates.
    cond = [fresh[c].eqNullSafe(window[c]) for c in cols]
    return fresh.join(window, cond, "left_anti")


def start_review_dedup(
    stream: DataFrame,
    sink_path: str,
    checkpoint_path: str,
    available_now: bool = True,
    processing_time: str | None = None,
    partition_by_date: bool = False,
) -> StreamingQuery:
    """Start the incremental dedup into a Parquet table at ``sink_path``.

    ``available_now`` processes everything present and stops (batch-like
    scheduling); otherwise ``processing_time`` sets the trigger interval.
    ``partition_by_date`` stores one folder per review date, so each batch's
    date-range filter on the stored rows prunes whole folders.
    """

    spark = stream.sparkSession
    schema = stream.schema
    parts = ["date"] if partition_by_date else []

    def append(df: DataFrame) -> None:
        df.write.mode("append").partitionBy(*parts).parquet(sink_path)

    # Appending no rows creates the table when it is missing and changes
    # nothing when it exists, so every batch can read it.
    append(spark.createDataFrame([], schema))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        stored = batch.sparkSession.read.schema(schema).parquet(sink_path).select(*schema.names)
        append(new_reviews(batch, stored))

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_path)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def distinct_in_batches(rows: DataFrame) -> DataFrame:
    """The distinct rows of each Arrow batch. A stream has no map-side combine
    before its state: without this, a row that makes up a third of the feed
    would go to one task as often as it occurs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                yield from table.group_by(table.column_names).aggregate([]).select(table.column_names).to_batches()

    return rows.mapInArrow(work, rows.schema)


def start_keyed_dedup(
    stream: DataFrame,
    sink_path: str,
    checkpoint_path: str,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the incremental dedup with the rows seen so far in the state store.

    Rows are equal if all columns are, NULL equal to NULL. The sink is a Parquet
    file sink: its log makes a replayed batch count once. The state is spread
    over ``spark.sql.shuffle.partitions`` of the session at the first start,
    and the provider is set for the session, as for all its later streams.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)
    rows = distinct_in_batches(stream).dropDuplicates()
    writer = rows.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", sink_path).option("checkpointLocation", checkpoint_path)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
