"""brightwash: cleaning, profiling and analytics of listing-style tables on Spark.

Every operator is a function ``DataFrame -> DataFrame`` (usable with
``df.transform``) built from native Spark expressions, so Catalyst can push
filters and prune columns, and nothing row-level goes through the driver.

Layout:

* ``sources``   - schemas, CSV/Parquet input and output, catalog helpers,
                  and the dirty test tables derived from the driver data.
* ``functions`` - column expressions (casts, price text, predicates, bands).
* ``operators`` - DataFrame operators (types, fills, dedup, geo, quantiles,
                  price, profile, analytics, report, joins).
* ``plans``     - composite flows (clean listings / neighbourhoods / reviews,
                  step accounting, the ETL run and the registered queries).
* ``streaming`` - incremental deduplication of a review feed.
"""

from brightwash.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
