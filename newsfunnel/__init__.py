"""newsfunnel: a PySpark-native news-article funnel.

Every operator is a ``DataFrame -> DataFrame`` function built on Spark SQL
columns, joins, aggregates and windows.  Sub-packages:

* ``functions``  column-expression helpers (text, URLs, regex builders)
* ``sources``    readers for landed feeds, dimension tables and sinks
* ``operators``  filters, extraction, tagging, verdicts, dedup, scoring, query tables
* ``plans``      composed pipelines, fixtures and the query catalog
* ``streaming``  Structured Streaming ingest
"""

__version__ = "0.1.0"
