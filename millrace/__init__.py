"""Sales-order ingestion and analytics as Spark DataFrame jobs.

Landing files become keyed messages, messages become a raw bronze table, bronze
becomes a curated silver table, and a handful of reports read the result. Every
step is a ``DataFrame -> DataFrame`` function, shared by the batch and the
streaming entry points.
"""

from millrace.settings import Settings

__all__ = ["Settings"]
