"""Views, catalog checks and source resolution."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException


def register_views(tables: dict[str, DataFrame]) -> None:
    """Expose DataFrames to ``spark.sql`` under the given names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    """True when ``name`` resolves to a table or (temporary) view."""
    return spark.catalog.tableExists(name)


def read_parquet_if_present(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The committed Parquet table at ``path``, or ``None`` when there is none.

    A write that has finished leaves the marker ``_SUCCESS``; a folder without
    it is a half-written table and counts as absent. The marker is looked up
    with Spark's own reader, i.e. in the file system that the cluster is
    configured for. Any error but a missing path surfaces.
    """
    if not path:
        return None
    marker = path.rstrip("/") + "/_SUCCESS"
    try:
        # the marker is empty: its row tells that it is there
        spark.read.format("binaryFile").load(marker).select("length").first()
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def load_or_build(
    spark: SparkSession,
    parquet_path: str | None,
    build: Callable[[], DataFrame],
    live_table: str | None = None,
) -> DataFrame:
    """The live table or view when it exists, else the stored clean table, else
    the cleaning plan."""
    if live_table and table_exists(spark, live_table):
        return spark.table(live_table)
    stored = read_parquet_if_present(spark, parquet_path)
    return stored if stored is not None else build()
