"""The command-line run of the whole flow, from CSV files."""

import importlib.util
import os

from pyspark.sql import functions as F

from brightwash.session import scratch_dir
from brightwash.sources import testdata, write_csv
from conftest import ROOT, SF001


def _load_script():
    spec = importlib.util.spec_from_file_location("run_etl", os.path.join(ROOT, "scripts", "run_etl.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_run_etl_script_from_csv(spark, capsys):
    folder = scratch_dir(spark, "cli")
    raw = testdata.listings_raw(spark, SF001)
    write_csv(raw.select(*[F.col(c).cast("string") for c in raw.columns]), f"{folder}/listings")
    write_csv(testdata.neighbourhoods_raw(spark, SF001), f"{folder}/neighbourhoods")
    write_csv(testdata.reviews_raw(spark, SF001), f"{folder}/reviews")
    _load_script().main(
        [
            "--listings", f"{folder}/listings",
            "--neighbourhoods", f"{folder}/neighbourhoods",
            "--reviews", f"{folder}/reviews",
            "--out", f"{folder}/out",
            "--files", "listings=1,reviews=2",
        ],
        spark=spark,
    )
    out = capsys.readouterr().out
    assert "price_median_fill" in out and "reduction" in out
    assert spark.read.parquet(f"{folder}/out/listings_clean.parquet").count() == 369
    assert spark.read.parquet(f"{folder}/out/reviews_clean.parquet").count() == 6000 - 36
