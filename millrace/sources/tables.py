"""Readers and writers of the bronze, silver, topic and quarantine folders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.shape import nest
from millrace.schemas import (
    BRONZE,
    BRONZE_NESTED,
    KEY,
    MANIFEST,
    RUNS,
    SILVER,
    SILVER_PARTITIONS,
    TOPIC,
    TOPIC_REJECTS,
)
from millrace.staging import lean

COMPRESSION = "zstd"

# Silver's files carry a Bloom filter of their keys per row group: a reader after few keys,
# however scattered, skips the groups that hold none of them. Sized by what a group holds,
# at one false hit in 10,000 keys asked for.
KEY_FILTER = {
    f"parquet.bloom.filter.enabled#{KEY}": "true",
    f"parquet.bloom.filter.fpp#{KEY}": "0.0001",
    "parquet.bloom.filter.adaptive.enabled": "true",
    f"parquet.bloom.filter.candidates.number#{KEY}": "15",
    "parquet.bloom.filter.max.bytes": str(8 << 20),
}


def exists(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    location = context._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(context._jsc.hadoopConfiguration()).exists(location)


def _or_empty(
    spark: SparkSession, path: str, schema: T.StructType, load: Callable[[str], DataFrame]
) -> DataFrame:
    """Only a missing path means "no rows yet"; failing to read one is an error."""
    return load(path) if exists(spark, path) else spark.createDataFrame([], schema)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Flat bronze. Batches and micro-batches write folders of their own below
    ``path``, so it is read recursively."""
    reader = spark.read.schema(BRONZE).option("recursiveFileLookup", True)
    return _or_empty(spark, path, BRONZE, reader.parquet)


def append_bronze(bronze: DataFrame, path: str) -> None:
    """One append, one commit."""
    (
        bronze.select(*BRONZE.fieldNames())
        .write.mode("append")
        .option("compression", COMPRESSION)
        .parquet(path)
    )


def replace_batch(bronze: DataFrame, path: str, batch: str) -> None:
    """Write a batch to the folder its name decides. A batch that is there whole stays:
    its files may have been listed by readers, and a repeated batch has the same rows."""
    if exists(bronze.sparkSession, f"{path}/{batch}/_SUCCESS"):
        return
    (
        bronze.select(*BRONZE.fieldNames())
        .write.mode("overwrite")
        .option("compression", COMPRESSION)
        .parquet(f"{path}/{batch}")
    )


def read_bronze_ndjson(spark: SparkSession, path: str, glob: str = "*.ndjson") -> DataFrame:
    """Nested bronze, one JSON object per line, from the files that match ``glob``, packed by
    gzip or not; other files and blank lines are skipped, an unreadable line is an error."""
    reader = (
        spark.read.schema(BRONZE_NESTED)
        .option("pathGlobFilter", f"{{{glob},{glob}.gz}}")
        .option("recursiveFileLookup", True)
        .option("mode", "FAILFAST")
    )
    return _or_empty(spark, path, BRONZE_NESTED, reader.json)


def write_bronze_ndjson(bronze: DataFrame, path: str, batch: str) -> None:
    """Nested bronze, one JSON object per line, each file sorted by position.

    Names in every line make the text some fifteen times as large as bronze itself, so it is
    packed; Spark names such files ``*.json.gz``. A batch written again replaces itself.
    """
    (
        nest(bronze)
        .sortWithinPartitions("kafka_partition", "kafka_offset")
        .write.mode("overwrite")
        .option("compression", "gzip")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .json(f"{path}/{batch}")
    )


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    rows = _or_empty(spark, path, SILVER, spark.read.schema(SILVER).parquet)
    return rows.select(*SILVER.fieldNames())


def append_silver(
    silver: DataFrame, path: str, *, observe: tuple[Observation, Column] | None = None
) -> None:
    """Append to the table partitioned by order month.

    Rows are first brought together by month, or every task would open a file for
    every month. A rebalance lets the engine split a large month over several tasks
    and join small ones. Files are sorted by key and carry filters of their keys, so that a
    reader after some keys can skip the rest.
    """
    rows = silver.hint("rebalance", *[F.col(c) for c in SILVER_PARTITIONS])
    if observe:
        rows = rows.observe(*observe)
    with lean(silver.sparkSession):
        (
            rows.sortWithinPartitions(*SILVER_PARTITIONS, KEY)
            .write.mode("append")
            .options(compression=COMPRESSION, **KEY_FILTER)
            .partitionBy(*SILVER_PARTITIONS)
            .parquet(path)
        )


def read_topic(spark: SparkSession, path: str) -> DataFrame:
    """Every message of a file-backed topic, from the earliest."""
    return _or_empty(spark, path, TOPIC, spark.read.schema(TOPIC).parquet)


def append_topic(messages: DataFrame, path: str) -> None:
    """JSON values of neighbours are much alike, and close packing tells."""
    with lean(messages.sparkSession):
        messages.select(*TOPIC.fieldNames()).write.mode("append").option("compression", COMPRESSION).parquet(path)


def append_quarantine(rejects: DataFrame, path: str) -> None:
    rejects.write.mode("append").option("compression", COMPRESSION).parquet(path)


def replace_quarantine(rejects: DataFrame, path: str, entry: str, name: str) -> None:
    """Write the rejects of a run that may be repeated to the folder its name decides."""
    rejects.withColumn("entry", F.lit(entry)).write.mode("overwrite").option(
        "compression", COMPRESSION
    ).parquet(f"{path}/{entry}/{name}")


def read_quarantine(spark: SparkSession, path: str, entry: str) -> DataFrame:
    """The rejects of one entry point, of all its runs."""
    reader = spark.read.schema(TOPIC_REJECTS).option("recursiveFileLookup", True)
    return _or_empty(spark, f"{path}/{entry}", TOPIC_REJECTS, reader.parquet)


def quarantine_folders(spark: SparkSession, path: str, entry: str) -> list[str]:
    """The folders of an entry point's runs. A name per run and no more comes to the driver."""
    context = spark.sparkContext
    location = context._jvm.org.apache.hadoop.fs.Path(f"{path}/{entry}")
    files = location.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(location):
        return []
    return [x.getPath().toString() for x in files.listStatus(location) if x.isDirectory()]


def drop_quarantine(spark: SparkSession, folders: list[str]) -> None:
    context = spark.sparkContext
    for folder in folders:
        location = context._jvm.org.apache.hadoop.fs.Path(folder)
        location.getFileSystem(context._jsc.hadoopConfiguration()).delete(location, True)


def note_run(spark: SparkSession, path: str, entry: str, batch: str, counts: dict[str, object]) -> None:
    """Log a micro-batch in the folder its name decides. One that is logged stays as it is: a
    batch repeated after its commit was lost would say that all its rows were skipped."""
    if exists(spark, f"{path}/{entry}/{batch}/_SUCCESS"):
        return
    row = {"entry": entry, "batch": batch, **counts}
    one = spark.createDataFrame([[row[c] for c in RUNS.fieldNames()]], RUNS)
    one.coalesce(1).write.mode("overwrite").parquet(f"{path}/{entry}/{batch}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run log, a row per entry and micro-batch."""
    return _or_empty(spark, path, RUNS, spark.read.schema(RUNS).option("recursiveFileLookup", True).parquet)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Every file version ever noted; ``manifest.latest`` gives the current ones."""
    return _or_empty(spark, path, MANIFEST, spark.read.schema(MANIFEST).parquet)


def append_manifest(rows: DataFrame, path: str) -> None:
    rows.select(*MANIFEST.fieldNames()).write.mode("append").parquet(path)


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()} NOT NULL" for f in schema)


def create_bronze_table(spark: SparkSession, name: str, path: str) -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_columns(BRONZE)}) "
        f"USING parquet OPTIONS (compression '{COMPRESSION}') LOCATION '{path}'"
    )


def create_silver_table(spark: SparkSession, name: str, path: str) -> None:
    """Partitions that jobs append by path show up after ``add_months``, or, whatever they are,
    ``refresh_silver_table``."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_columns(SILVER)}) "
        f"USING parquet OPTIONS (compression '{COMPRESSION}') "
        f"PARTITIONED BY ({', '.join(SILVER_PARTITIONS)}) LOCATION '{path}'"
    )


def refresh_silver_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def add_months(spark: SparkSession, name: str, batch: DataFrame) -> int:
    """Tell the catalog of the months that ``batch`` has rows of, and how large they are now;
    returns their number. No other month is listed, as ``refresh_silver_table`` does with all.

    The months come to the driver; their number is bounded by the calendar.
    """
    months = sorted(map(tuple, batch.select(*SILVER_PARTITIONS).distinct().collect()))
    specs = ["PARTITION (" + ", ".join(f"{c} = {v}" for c, v in zip(SILVER_PARTITIONS, m, strict=True)) + ")" for m in months]
    if specs:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(specs)}")
    for spec in specs:
        spark.sql(f"ANALYZE TABLE {name} {spec} COMPUTE STATISTICS NOSCAN")
    spark.catalog.refreshTable(name)
    return len(specs)


def register_views(spark: SparkSession, bronze_path: str, silver_path: str) -> None:
    """Name both layers for ad-hoc SQL."""
    read_bronze(spark, bronze_path).createOrReplaceTempView("sales_bronze")
    read_silver(spark, silver_path).createOrReplaceTempView("sales_silver")
