"""Intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Spark's own clean-up at the end of an execution, off unless set.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)
_applications: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, or its warehouse where none is set."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return named.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under this application's own folder, which ``release`` removes."""
    application = spark.sparkContext.applicationId
    if application not in _applications:
        _applications.add(application)
        atexit.register(release, spark)
    return f"{shared_dir(spark)}/millrace/{application}/{name}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    location = context._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(context._jsc.hadoopConfiguration()).delete(location, True)


def release(spark: SparkSession) -> None:
    """Remove all that this application has staged. Also runs when Python ends."""
    if spark.sparkContext._jsc is not None:
        _delete(spark, f"{shared_dir(spark)}/millrace/{spark.sparkContext.applicationId}")


@contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind. Spark otherwise deletes them when
    the driver collects its garbage, which with small frames it may not do for hours."""
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)


def stage_lean(df: DataFrame, name: str) -> DataFrame:
    """``stage`` for tables as large as a layer: packed closer, without shuffle files left behind."""
    with lean(df.sparkSession):
        return stage(df, name, compression="zstd")


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once and read it back: a lineage cut that survives lost executors
    and, being columnar, lets later passes read only the columns they need."""
    path = fresh_path(df.sparkSession, name)
    opened = _scope.get()
    if opened is not None:
        opened.append(path)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what ``stage`` wrote inside. What is staged outside of any such
    block stays until ``release``, since frames that read it may still be in use."""
    opened: list[str] = []
    token = _scope.set(opened)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in opened:
            _delete(spark, path)
