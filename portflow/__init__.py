"""portflow — land-port trade, crossing and wait analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; nothing is collected to the driver while a
result is being computed.

Sub-packages:

* ``portflow.functions`` — column expressions (codes, dates, metrics, text).
* ``portflow.operators`` — conforming, joins, aggregates, windows, series
  shaping, dimension building, data-quality checks, profiling, link mining.
* ``portflow.sources``  — file readers (CSV, JSON pages, code lookups,
  archives) and the bindings of the driver tables to the star model.
* ``portflow.plans``    — load jobs, the eighteen result marts, and the
  query registry used by ``__spark_entry__``.
* ``portflow.streaming`` — incremental loads and windowed averages.
"""

__version__ = "0.1.0"
