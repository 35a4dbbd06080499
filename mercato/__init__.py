"""mercato: e-commerce analytics as plain Spark DataFrame jobs.

Every operator is a ``DataFrame(s) -> DataFrame`` function built from
``pyspark.sql.functions``; none creates a session, runs an action or
registers a UDF.  Sub-packages:

* ``sources``   explicit schemas, readers for the raw nested JSON, the
                driver-table views, and sinks (Parquet / CSV).
* ``functions`` shared column expressions (money sums, rounding, months,
                deterministic de-duplication, skew-safe ordered neighbours).
* ``operators`` cleaning, enrichment, reports, customer lifetime value,
                chart datasets, data-quality checks, sessionisation.
* ``plans``     query registry, SQL surface over temp views, DuckDB oracle.
* ``streaming`` the sessionisation operator over a Structured Streaming source.
"""

__version__ = "0.1.0"
