"""Inputs and outputs: schemas, CSV / Parquet, catalog, derived test tables."""

from brightwash.sources.catalog import (
    load_or_build,
    read_parquet_if_present,
    register_views,
    table_exists,
)
from brightwash.sources.files import (
    assert_verified,
    corrupt_rows,
    read_csv,
    read_parquet,
    table_fingerprint,
    verify_written,
    write_csv,
    write_parquet,
    write_parquet_observed,
)
from brightwash.sources.schemas import SCHEMAS

__all__ = [
    "SCHEMAS",
    "assert_verified",
    "load_or_build",
    "read_parquet_if_present",
    "corrupt_rows",
    "read_csv",
    "read_parquet",
    "register_views",
    "table_exists",
    "table_fingerprint",
    "verify_written",
    "write_csv",
    "write_parquet",
    "write_parquet_observed",
]
