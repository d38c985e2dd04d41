"""Run every registered query in Spark and its SQL in DuckDB; compare rows.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]

Rows are compared as multisets after sorting columns by name; floats must
match exactly (``--tol`` relaxes that for a diagnosis). Column types are
compared too (Spark type mapped to the DuckDB type).

Environment: ``PLAIN_SESSION=1`` uses a session without the engine's
defaults (``PLAIN_TZ``, default America/Santiago; ``PLAIN_ANSI``, default
true), the way a foreign driver session may look.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from brightwash.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v, tol):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if tol:
            return round(v, tol)
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    if v is None:
        return None
    if hasattr(v, "item"):
        return _norm(v.item(), tol)
    return v


SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def type_mismatches(spark_dtypes, duck_description, duck_types):
    """Columns whose Spark type does not map to the DuckDB result type."""
    duck = dict(zip([d[0] for d in duck_description], duck_types))
    bad = []
    for name, t in spark_dtypes:
        want = SPARK_TO_DUCK.get(t, t.upper())
        if str(duck.get(name)) != want:
            bad.append((name, t, str(duck.get(name))))
    return bad


def rows_of(columns, rows, tol):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i], tol) for i in order) for r in rows], sorted(columns)


def main(argv):
    tol = None
    if "--tol" in argv:
        i = argv.index("--tol")
        tol = int(argv[i + 1])
        del argv[i : i + 2]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    if os.environ.get("PLAIN_SESSION"):
        # a session without the engine defaults, like a foreign driver's
        from pyspark.sql import SparkSession

        spark = (
            SparkSession.builder.master("local[8]")
            .config("spark.sql.session.timeZone", os.environ.get("PLAIN_TZ", "America/Santiago"))
            .config("spark.sql.ansi.enabled", os.environ.get("PLAIN_ANSI", "true"))
            .getOrCreate()
        )
    else:
        spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as exc:  # noqa: BLE001
            print(f"{name:28s} SPARK ERROR {type(exc).__name__}: {str(exc)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sql:
            print(f"{name:28s} rows={len(srows)} (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.sql(sql[name])
            dtypes = rel.types
            res = con.execute(sql[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as exc:  # noqa: BLE001
            print(f"{name:28s} DUCKDB ERROR {str(exc)[:300]}")
            bad += 1
            continue
        a, ac = rows_of(scols, srows, tol)
        b, bc = rows_of(dcols, drows, tol)
        ok = ac == bc and Counter(a) == Counter(b)
        status = "OK " if ok else "MISMATCH"
        tbad = type_mismatches(df.dtypes, res.description, dtypes)
        print(f"{name:28s} {status} spark={len(a)} duck={len(b)} {ts:.1f}s" + (f" TYPES {tbad}" if tbad else ""))
        if not ok:
            bad += 1
            if ac != bc:
                print("   columns", ac, bc)
            else:
                da, db = Counter(a) - Counter(b), Counter(b) - Counter(a)
                print("   spark-only", list(da.items())[:3])
                print("   duck-only ", list(db.items())[:3])
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
