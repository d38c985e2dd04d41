"""Output files of a planned size, and compaction of small files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brightwash.sources.files import write_parquet

TARGET_BYTES = 128 << 20


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(file, folder, bytes) of every data file under ``path``, from the listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    file = F.col("_metadata.file_path")
    return files.select(file.alias("file"), F.regexp_replace(file, "/[^/]*$", "").alias("folder"), F.col("length").alias("bytes"))


def files_for(rows: int, rows_per_file: int) -> int:
    """The least number of files, of equal size, that hold ``rows_per_file`` at most."""
    return max(1, -(-rows // rows_per_file))


def estimated_row_bytes(df: DataFrame, path: str, rows: int, share: float) -> float:
    """Stored bytes a row, from a sample of about ``share`` written to ``path``."""
    write_parquet(df.sample(min(1.0, share), seed=11), path)
    stored = file_sizes(df.sparkSession, path).agg(F.sum("bytes")).first()[0] or 0
    sampled = df.sparkSession.read.parquet(path).count()
    return stored / sampled if sampled else 0.0


def write_planned(df: DataFrame, path: str, rows_per_file: int | None = None, target_bytes: int = TARGET_BYTES, sample_path: str | None = None) -> int:
    """Snappy Parquet in as few files of equal size as the plan allows; their number.

    With ``rows_per_file`` no file holds more rows; otherwise the rows for
    ``target_bytes`` follow from a sample of some 100,000 rows written to
    ``sample_path``. ``df`` is counted first, so it should be a stored table.
    The rows are dealt out evenly, so no task or file is larger than others.
    """
    rows = df.count()
    if rows_per_file is None:
        if sample_path is None:
            raise ValueError("sample_path is needed to estimate the bytes of a row")
        width = estimated_row_bytes(df, sample_path, rows, 100_000 / rows if rows else 1.0)
        rows_per_file = max(1, int(target_bytes / width)) if width else max(1, rows)
    files = files_for(rows, rows_per_file)
    write_parquet(df, path, files=files)
    return files


def compaction_plan(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """(file, folder, bytes, bin) of a listing: files to be merged share a bin.

    Files of less than half the target are taken by size, then name, and a bin
    is closed where their running sum crosses a multiple of half the target; so
    no bin is larger than the target and all but a folder's last are at least
    nearly half full. A larger file is a bin of its own. The window holds a
    folder's file names, not its rows.
    """
    small = F.col("bytes") < target_bytes / 2
    ahead = Window.partitionBy("folder", small.alias("small")).orderBy("bytes", "file").rowsBetween(Window.unboundedPreceding, -1)
    place = F.floor(F.coalesce(F.sum("bytes").over(ahead), F.lit(0)) / F.lit(target_bytes / 2)).cast("string")
    return files.withColumn("bin", F.when(small, F.concat_ws("|", "folder", place)).otherwise(F.col("file")))


def compact(spark: SparkSession, path: str, out: str, target_bytes: int = TARGET_BYTES) -> int:
    """Write the Parquet table at ``path`` (without folders for partitions) to
    ``out``, one file for each bin of the plan; the number of files.

    Each row goes to its file's bin, in one shuffle. The bins of the files are
    broadcast: a name and a number for each file, which the listing of a scan
    holds on the driver as well.
    """
    plan = compaction_plan(file_sizes(spark, path), target_bytes)
    plan = plan.select("file", (F.dense_rank().over(Window.orderBy("bin")) - 1).alias("bin"))
    bins = plan.agg(F.count_distinct("bin")).first()[0]
    rows = spark.read.parquet(path)
    columns = rows.columns
    # a struct keeps the columns' names apart from those of the plan
    named = rows.select(F.col("_metadata.file_path").alias("file"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    dealt = named.join(F.broadcast(plan), "file").repartitionById(max(1, bins), "bin")
    write_parquet(dealt.select("row.*"), out)
    return bins
