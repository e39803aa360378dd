"""feedmart: news-feed ETL (raw -> core -> mart) expressed as Spark DataFrame plans.

Every operator is a function DataFrame -> DataFrame built from Spark's own primitives.
Sub-packages:

* ``functions``  column expressions (date parsing, weekday numbering, defaults)
* ``sources``    RSS/XML scans, the path-based table store, stand-in sources over the test tables
* ``operators``  ingest, keyed insert-if-absent, core, mart, window forms, quality checks
* ``plans``      full and delta load pipelines
* ``streaming``  the landing directory as a Structured Streaming source
"""

from feedmart.session import ensure_checkpoint_dir, get_session

__all__ = ["get_session", "ensure_checkpoint_dir"]
