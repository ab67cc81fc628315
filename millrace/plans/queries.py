"""Every operator as a query over the shared tables.

Line items stand in for landing rows (``sources.star``); by their dates about half of them
break the rule on shipping, so later layers hold the other half. What a broker or an earlier
job would have left behind, the topic and the bronze and silver tables, is written once per
session and table folder. A query reads the layer before the operator it is named for, and
runs that operator itself.
"""

from __future__ import annotations

import sys
import uuid
import zipfile
from collections.abc import Callable, Iterator
from datetime import date, datetime, timedelta, timezone
from functools import reduce

import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import StreamingQueryException

from millrace.functions.coerce import parse_date, to_double, to_integer
from millrace.operators import audit, gaps, manifest, merge
from millrace.operators.curate import curate, overflowed, to_silver
from millrace.operators.merge import merge_into
from millrace.operators.messages import encode, judge_messages, judge_nested, judge_topic
from millrace.operators.shape import flatten, nest, read_rank
from millrace.operators.validate import (
    count_classes,
    judge_landing,
    rejected,
    run_counters,
    unreadable,
    valid,
)
from millrace.errors import DuplicateKeyError
from millrace.plans import compact, jobs, reports, rollup
from millrace.schemas import HEADERS, KEY, MANIFEST, SALES_COLUMNS, SILVER, TOPIC
from millrace.settings import DEFAULT_TOPIC, DEFAULT_TOPIC_PARTITIONS, Settings
from millrace.sources import archive, landing, star, tables
from millrace.sources.archive import open_filesystem
from millrace.sources.topic import assign_positions
from millrace.staging import fresh_path, stage, stage_lean, staging
from millrace.streaming import ingest

# What runs in Python workers is sent whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed stamps, so that results can be compared.
INGESTED_AT = datetime(2021, 1, 1, tzinfo=timezone.utc)
TRANSFORMED_AT = datetime(2021, 1, 2, tzinfo=timezone.utc)
SOURCE_FILE = "lineitem"
AS_OF = date(1998, 6, 15)
AS_OF_JANUARY = date(1999, 1, 15)

_ORDER = star.MESSAGE_ORDER
_LINE = _ORDER[1:]


def plain(df: DataFrame) -> DataFrame:
    """Dates and decimals as text, timestamps as epoch milliseconds: forms that read the
    same in every engine."""
    out = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            column = F.unix_millis(column)
        elif isinstance(field.dataType, (T.DateType, T.DecimalType)):
            column = column.cast("string")
        out.append(column.alias(field.name))
    return df.select(*out)


# --------------------------------------------------------------------------- layers


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.sales_text(spark, sf_dir)


def judged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_landing(raw_rows(spark, sf_dir), keep=_LINE)


def numbered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Staged, as range bounds are sampled from it before it is sorted.
    return assign_positions(
        stage_lean(valid(judged_rows(spark, sf_dir)), "sales"),
        _ORDER,
        topic=DEFAULT_TOPIC,
        partitions=DEFAULT_TOPIC_PARTITIONS,
    )


def _stamped(messages: DataFrame) -> DataFrame:
    return messages.withColumn("timestamp", F.lit(INGESTED_AT).cast("timestamp")).select(
        *TOPIC.fieldNames()
    )


_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]) -> str:
    """The path of a layer table, written on first use in this session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = fresh_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def topic_path(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        # What is staged on the way goes when the topic is there.
        with staging(spark):
            messages = encode(numbered_rows(spark, sf_dir).drop(*_LINE))
            tables.append_topic(_stamped(messages), path)

    return _once(spark, sf_dir, "topic", write)


def topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_topic(spark, topic_path(spark, sf_dir))


def bronze_path(spark: SparkSession, sf_dir: str) -> str:
    return _once(
        spark,
        sf_dir,
        "bronze",
        lambda path: tables.append_bronze(
            valid(judge_topic(topic(spark, sf_dir), SOURCE_FILE, INGESTED_AT)), path
        ),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_bronze(spark, bronze_path(spark, sf_dir))


def silver_path(spark: SparkSession, sf_dir: str) -> str:
    return _once(
        spark, sf_dir, "silver", lambda path: merge_into(curated(spark, sf_dir), path)
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_silver(spark, silver_path(spark, sf_dir))


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate(bronze(spark, sf_dir), TRANSFORMED_AT).where(F.col("reject_class").isNull())


def _settings(spark: SparkSession, name: str) -> Settings:
    return Settings(root=fresh_path(spark, name), kafka_consumer_timeout_ms=1)


# --------------------------------------------------------------- landing and rejects


def landing_valid(spark, sf_dir):
    return plain(valid(judged_rows(spark, sf_dir)).select(*SALES_COLUMNS))


def _write_landing(raw: DataFrame, path: str) -> None:
    """Half of the rows in files of one column order, half in files of another."""
    even = F.pmod(F.col("_orderkey"), F.lit(2)) == 0
    for part, columns in ((even, HEADERS), (~even, list(reversed(HEADERS)))):
        raw.where(part).select(*[F.col(f"`{c}`") for c in columns]).write.mode("append").option(
            "header", True
        ).option("escape", '"').csv(path)


def landing_csv(spark, sf_dir):
    path = fresh_path(spark, "landing")
    _write_landing(raw_rows(spark, sf_dir), path)
    return plain(valid(judge_landing(landing.read_landing(spark, path))))


def landing_missing_column(spark, sf_dir):
    """Files of odd orders lack a column: their rows are set aside, the others are not."""
    path = fresh_path(spark, "landing")
    even = F.pmod(F.col("_orderkey"), F.lit(2)) == 0
    raw = raw_rows(spark, sf_dir)
    for part, columns in ((even, HEADERS), (~even, [h for h in HEADERS if h != "Country"])):
        raw.where(part).select(*[F.col(f"`{c}`") for c in columns]).write.mode("append").option(
            "header", True
        ).csv(path)
    judged = judge_landing(landing.read_landing(spark, path))
    outcome = F.coalesce("reject_class", F.lit("VALID")).alias("outcome")
    return judged.groupBy(outcome, "reject_field").agg(F.count("*").alias("row_count"))


def row_cap(spark, sf_dir):
    capped = landing.cap_rows(
        raw_rows(spark, sf_dir), 10, ["_orderkey", *_LINE]
    )
    return plain(
        judge_landing(capped, keep=_LINE).select(
            "order_id",
            F.col("_linenumber").alias("line"),
            F.col("reject_class").isNull().alias("is_valid"),
        )
    )


def rejects_by_class(spark, sf_dir):
    return count_classes(judged_rows(spark, sf_dir))


def landing_run_counters(spark, sf_dir):
    return run_counters(judged_rows(spark, sf_dir))


def damaged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with fields broken by rules on the order key, often several in a row."""
    key = F.col("_orderkey")
    damage = {
        "Order Date": F.when(key % 7 == 0, "not-a-date"),
        "Ship Date": F.when(key % 11 == 0, ""),
        "Units Sold": F.when(key % 5 == 0, F.concat(F.col("Units Sold"), F.lit("x"))),
        "Unit Price": F.when(key % 13 == 0, "1e999"),
        "Country": F.when(key % 17 == 0, ""),
    }
    return raw_rows(spark, sf_dir).withColumns(
        {name: F.coalesce(broken, F.col(f"`{name}`")) for name, broken in damage.items()}
    )


def quarantined_rows(spark, sf_dir):
    rejects = rejected(judge_landing(damaged_rows(spark, sf_dir), keep=["_orderkey", *_LINE]))
    return rejects.select(
        F.col("_orderkey").alias("order_key"),
        F.col("_linenumber").alias("line"),
        "reject_class",
        "reject_field",
        "reject_value",
        "reject_reason",
    )


def date_parse_formats(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        (F.col("l_orderkey") % 9).cast("int").alias("form"),
        F.col("l_shipdate").cast("date").alias("day"),
    )
    form, day = F.col("form"), F.col("day")
    year = F.date_format(day, "yyyy")
    text = (
        F.when(form == 0, F.date_format(day, "M/d/yyyy"))
        .when(form == 1, F.date_format(day, "MM/dd/yyyy"))
        .when(form == 2, F.date_format(day, "yyyy-MM-dd"))
        .when(form == 3, F.date_format(day, "yyyy-M-d"))
        .when(form == 4, F.date_format(day, "M/d/yy"))
        .when(form == 5, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00")))
        .when(form == 6, F.concat(F.lit("2/30/"), year))
        .when(form == 7, F.concat(F.lit("13/1/"), year))
        .otherwise(F.concat(F.lit(" "), F.date_format(day, "M/d/yyyy")))
    )
    return plain(
        lines.select("form", text.alias("date_text"))
        .groupBy("form", "date_text")
        .agg(F.count("*").alias("row_count"))
        .withColumn("parsed", parse_date(F.col("date_text")))
    )


def number_coercion(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        (F.col("l_orderkey") % 10).cast("int").alias("form"),
        F.col("l_quantity").cast("int").cast("string").alias("n"),
    )
    form, n = F.col("form"), F.col("n")
    text = (
        F.when(form == 0, n)
        .when(form == 1, F.concat(n, F.lit(".0")))
        .when(form == 2, F.concat(F.lit(" "), n, F.lit(" ")))
        .when(form == 3, F.concat(F.lit("+"), n))
        .when(form == 4, F.concat(F.lit("1_0"), n))
        .when(form == 5, F.concat(n, F.lit("e2")))
        .when(form == 6, F.concat(n, F.lit("d")))
        .when(form == 7, F.concat(n, F.lit(".5")))
        .when(form == 8, F.concat(n, F.lit("__0")))
        .otherwise("nan")
    )
    return (
        lines.select("form", text.alias("number_text"))
        .groupBy("form", "number_text")
        .agg(F.count("*").alias("row_count"))
        .withColumn("as_integer", to_integer(F.col("number_text"), T.IntegerType()))
        .withColumn("as_double", to_double(F.col("number_text")))
    )


# ------------------------------------------------------------------ topic and bronze


def topic_positions(spark, sf_dir):
    return numbered_rows(spark, sf_dir).select(
        "topic",
        "partition",
        "offset",
        F.col("order_id").cast("string").alias("key"),
        F.col("_linenumber").alias("line"),
        F.col("_partkey").alias("part"),
    )


def key_routing(spark, sf_dir):
    return (
        topic(spark, sf_dir)
        .groupBy("key")
        .agg(
            F.count("*").alias("messages"),
            F.min("partition").alias("first_partition"),
            F.max("partition").alias("last_partition"),
        )
    )


def topic_roundtrip(spark, sf_dir):
    judged = judge_messages(topic(spark, sf_dir), keep=["partition", "offset"])
    return plain(valid(judged))


def _damages() -> dict[int, Column]:
    """What becomes of the values whose offsets are multiples of a number; the first that fits counts."""
    value = F.col("value")
    return {
        11: F.expr("substr(value, 1, length(value) - 1)"),
        13: F.lit('{"not": "a sales record"}'),
        17: F.replace(value, F.lit('"order_date":"'), F.lit('"order_date":"x')),
        19: F.regexp_replace(value, '"region":"[^"]*"', '"region":5'),
        23: F.regexp_replace(value, '"units_sold":[0-9]+', '"units_sold":"many"'),
        29: F.lit("[1, 2]"),
        31: F.regexp_replace(value, '"ship_date":"[0-9-]*"', '"ship_date":"1990-01-01"'),
    }


def _poisoned(messages: DataFrame) -> DataFrame:
    """Messages with some values damaged, by rules on the offset."""
    value = reduce(lambda c, d: c.when(F.col("offset") % d[0] == 0, d[1]), _damages().items(), F)
    return messages.withColumn("value", value.otherwise(F.col("value")))


def poison_messages(spark, sf_dir):
    judged = judge_topic(_poisoned(topic(spark, sf_dir)), SOURCE_FILE, INGESTED_AT)
    return rejected(judged).select(
        "kafka_partition", "kafka_offset", "reject_class", "reject_field"
    )


def bronze_enriched(spark, sf_dir):
    path = fresh_path(spark, "bronze")
    judged = judge_topic(topic(spark, sf_dir), SOURCE_FILE, INGESTED_AT)
    tables.append_bronze(valid(judged), path)
    return plain(tables.read_bronze(spark, path))


def bronze_nested_roundtrip(spark, sf_dir):
    """Nested, stored, read back and judged again as records, then flat once more."""
    nested = stage(nest(bronze(spark, sf_dir)), "nested")
    return plain(valid(judge_nested(nested)))


def offset_read_order(spark, sf_dir):
    positions = bronze(spark, sf_dir).select("kafka_topic", "kafka_partition", "kafka_offset")
    ordered = read_rank(positions.unionAll(positions).dropDuplicates(["kafka_partition", "kafka_offset"]))
    return ordered.select("kafka_partition", "kafka_offset", "read_rank")


def created_tables(spark, sf_dir):
    """Both layers as catalog tables over the folders that jobs write."""
    run = uuid.uuid4().hex
    tables.create_bronze_table(spark, f"bronze_{run}", bronze_path(spark, sf_dir))
    tables.create_silver_table(spark, f"silver_{run}", silver_path(spark, sf_dir))
    tables.refresh_silver_table(spark, f"silver_{run}")
    return spark.sql(
        f"""
        SELECT 'bronze' AS layer, country, count(*) AS row_count FROM bronze_{run} GROUP BY country
        UNION ALL
        SELECT 'silver', country, count(*) FROM silver_{run} GROUP BY country
        """
    )


def bronze_ndjson(spark, sf_dir):
    path = fresh_path(spark, "ndjson")
    tables.write_bronze_ndjson(bronze(spark, sf_dir), path, "batch-0")
    tables.write_bronze_ndjson(bronze(spark, sf_dir), path, "batch-0")
    return plain(flatten(tables.read_bronze_ndjson(spark, path, "*.json")))


def bronze_preview(spark, sf_dir):
    return plain(reports.bronze_preview(bronze(spark, sf_dir)))


# --------------------------------------------------------------------------- silver


def silver_transform(spark, sf_dir):
    return plain(to_silver(bronze(spark, sf_dir), TRANSFORMED_AT))


def margin_overflow(spark, sf_dir):
    """Rows whose margin does not fit, once every profit is a thousand times as large."""
    inflated = bronze(spark, sf_dir).withColumn("total_profit", F.col("total_profit") * 1000)
    return overflowed(inflated)


def margin_zero_revenue(spark, sf_dir):
    """Rows of every third offset earn nothing."""
    free = F.col("kafka_offset") % 3 == 0
    rows = bronze(spark, sf_dir).withColumn("total_revenue", F.when(free, 0.0).otherwise(F.col("total_revenue")))
    return plain(to_silver(rows, TRANSFORMED_AT).select(KEY, "margin_pct"))


def silver_rejects(spark, sf_dir):
    """A load of rows of which some don't fit silver: all received are written or set aside."""
    settings = _settings(spark, "rejects")
    inflated = bronze(spark, sf_dir).withColumn("total_profit", F.col("total_profit") * 1000)
    counts = jobs.load_silver(spark, settings, inflated, transformed_at=TRANSFORMED_AT)
    jobs.load_silver(spark, settings, inflated, transformed_at=TRANSFORMED_AT)
    aside = (
        spark.read.option("recursiveFileLookup", True)
        .parquet(f"{settings.layer('quarantine')}/silver")
        .groupBy(F.col("reject_class").alias("outcome"))
        .agg(F.count("*").alias("row_count"))
    )
    stored = tables.read_silver(spark, settings.layer("silver")).agg(F.count("*").alias("row_count"))
    return aside.unionAll(stored.select(F.lit("SILVER"), "row_count")).withColumn(
        "received", F.lit(counts.received).cast("long")
    )


def silver_table(spark, sf_dir):
    path = fresh_path(spark, "silver")
    merge_into(curated(spark, sf_dir), path)
    return plain(tables.read_silver(spark, path))


def silver_file_order(spark, sf_dir):
    """Neighbours in silver's files whose keys are out of order: none."""
    rows = silver(spark, sf_dir).select(
        KEY, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    before = F.lag(KEY).over(Window.partitionBy("file").orderBy("at"))
    return rows.withColumn("before", before).agg(
        F.count("*").alias("row_count"), F.count_if(F.col("before") > F.col(KEY)).alias("out_of_order")
    )


def silver_month(spark, sf_dir):
    return plain(reports.silver_month(silver(spark, sf_dir), 1998, 5))


def silver_partitions(spark, sf_dir):
    return (
        silver(spark, sf_dir)
        .groupBy("order_year", "order_month")
        .agg(F.count("*").alias("row_count"))
    )


def _merged(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_silver(spark, path).select(KEY, "order_id", "margin_pct")


def merge_replay(spark, sf_dir):
    path = fresh_path(spark, "merge")
    batch = curated(spark, sf_dir)
    merge_into(batch.unionAll(batch), path)
    merge_into(batch, path)
    return plain(_merged(spark, path))


def _offset_of(key: str) -> Column:
    return F.substring_index(key, "-", -1).cast("bigint")


def merge_three_runs(spark, sf_dir):
    path = fresh_path(spark, "merge")
    batch = curated(spark, sf_dir)
    step = _offset_of(KEY) % 15
    for run, (low, high) in enumerate([(0, 10), (0, 10), (5, 15)]):
        merge_into(batch.where((step >= low) & (step < high)), path)
    return plain(_merged(spark, path))


def compacted_silver(spark, sf_dir):
    """Three loads of each month, then its small files brought together, and one more load of
    rows that are all there already. A month has one file."""
    path = fresh_path(spark, "compact")
    batch = stage(curated(spark, sf_dir), "batch")
    for run in range(3):
        merge_into(batch.where(_offset_of(KEY) % 3 == run), path)
    compact.compact(spark, path)
    merge_into(batch.where(_offset_of(KEY) % 2 == 0), path)
    files = tables.read_silver(spark, path).withColumn("file", F.col("_metadata.file_name"))
    return plain(files.groupBy("order_year", "order_month").agg(
        F.countDistinct("file").alias("files"), F.count("*").alias("row_count"),
        F.countDistinct(KEY).alias("keys"), F.sum("total_revenue").cast("decimal(28,4)").alias("revenue"),
    ))


def merge_incremental(spark, sf_dir):
    """What a merge adds to a stored table that lacks every fourth offset."""
    path = fresh_path(spark, "merge")
    batch = stage(curated(spark, sf_dir), "batch")
    merge_into(batch.where(_offset_of(KEY) % 4 != 3), path)
    stored = tables.read_silver(spark, path).select(KEY)
    return plain(merge.inserts(batch, stored).select(*SILVER.fieldNames()))


def merge_scattered(spark, sf_dir):
    """A late batch of keys scattered over all offsets, some of them stored, looked up one by one
    where they are few; then one of stretches far from each other."""
    path = fresh_path(spark, "merge")
    batch = curated(spark, sf_dir)
    offset = _offset_of(KEY)
    scattered, stretch = offset % 997 == 0, (offset % 640).between(100, 120)
    merge_into(batch.where(~scattered & ~stretch), path)
    merge_into(batch.where(offset % 997 <= 1), path)
    merge_into(batch.where((offset % 640).between(90, 130)), path)
    return plain(_merged(spark, path))


def strict_merge(spark, sf_dir):
    """A strict merge into a new table, then one of which every fifth key is stored."""
    path = fresh_path(spark, "merge")
    batch = curated(spark, sf_dir)
    merge_into(batch.where(_offset_of(KEY) % 5 == 0), path, strict=True)
    try:
        merge_into(batch, path, strict=True)
    except DuplicateKeyError as refused:
        clashing, sample = refused.clashes, refused.sample
    stored = tables.read_silver(spark, path)
    return stored.agg(F.count("*").alias("stored")).select(
        "stored", F.lit(clashing).cast("long").alias("clashes"), F.lit(sample).alias("sample")
    )


def merge_counters(spark, sf_dir):
    path = fresh_path(spark, "merge")
    batch = curated(spark, sf_dir)
    first = batch.where(_offset_of(KEY) % 2 == 0)
    runs = [merge_into(b, path) for b in (first, batch, batch)]
    return spark.createDataFrame(
        [(i + 1, c.received, c.written, c.skipped) for i, c in enumerate(runs)],
        "run int, received bigint, written bigint, skipped bigint",
    )


def merge_first_copy(spark, sf_dir):
    """Every position arrives twice, the later copy with other content."""
    early = bronze(spark, sf_dir)
    late = early.withColumns(
        {
            "ingested_at": F.col("ingested_at") + F.expr("interval 1 hour"),
            "total_profit": F.col("total_profit") * 0,
        }
    )
    batch = curate(late.unionAll(early), TRANSFORMED_AT).where(F.col("reject_class").isNull())
    path = fresh_path(spark, "merge")
    merge_into(batch, path)
    return plain(tables.read_silver(spark, path).select(KEY, "margin_pct", "bronze_ingested_at"))


def strict_duplicates(spark, sf_dir):
    batch = curated(spark, sf_dir).select(KEY)
    offset = _offset_of(KEY)
    twice = batch.unionAll(batch.where(offset % 3 == 0))
    return merge.clashes(twice, batch.where(offset % 5 == 0))


def dedup_check(spark, sf_dir):
    """Run on an unmerged table, where each third position is stored twice."""
    rows = silver(spark, sf_dir)
    return audit.dedup_check(rows.unionAll(rows.where(_offset_of(KEY) % 3 == 0)))


def distinct_keys(spark, sf_dir):
    rows = bronze(spark, sf_dir)
    return audit.bronze_keys(rows.unionAll(rows))


def missing_in_silver(spark, sf_dir):
    kept = silver(spark, sf_dir).where("order_month <> 2")
    return audit.without_silver(bronze(spark, sf_dir), kept)


def completeness(spark, sf_dir):
    return audit.reconcile(
        topic(spark, sf_dir), bronze(spark, sf_dir), silver(spark, sf_dir)
    )


def _thinned(positions: DataFrame) -> DataFrame:
    """Positions without some single offsets, a stretch now and then and each second thousand."""
    offset = F.col("offset")
    return positions.where((offset % 17 != 4) & ~(offset % 300).between(10, 25) & (offset % 2_000 >= 1_000))


def missing_ranges(spark, sf_dir):
    """The stretches of offsets that bronze lacks, as against the topic's first and last ones."""
    held = _thinned(gaps.bronze_positions(bronze(spark, sf_dir)))
    sent = gaps.message_positions(topic(spark, sf_dir))
    return gaps.missing_ranges(held.unionAll(held.where("offset % 3 = 0")), gaps.bounds_of(sent))


def range_completeness(spark, sf_dir):
    """All layers by ranges: topic and silver whole, bronze thinned and with copies."""
    held = _thinned(gaps.bronze_positions(bronze(spark, sf_dir)))
    return gaps.range_report(
        topic=gaps.message_positions(topic(spark, sf_dir)),
        bronze=held.unionAll(held.where("offset % 3 = 0")),
        silver=gaps.silver_positions(silver(spark, sf_dir)),
    )


def replay_ranges(spark, sf_dir):
    """Silver lacks every third offset. Overlapping ranges are replayed from the topic, one from
    bronze, and all of them again."""
    settings = _settings(spark, "replay")
    messages = topic(spark, sf_dir)
    tables.append_topic(messages, settings.layer("topic"))
    jobs.load_bronze(spark, settings, messages.where("offset % 3 <> 0"), ingested_at=INGESTED_AT)
    jobs.load_silver(spark, settings, transformed_at=TRANSFORMED_AT)
    wanted = [
        ("topic", [(0, 0, 99)]), ("topic", [(0, 50, 149), (1, 0, 9)]), ("bronze", [(0, 0, 149), (2, 5, 20)]),
        ("topic", [(0, 0, 99)]), ("topic", [(0, 0, 149), (1, 0, 9)]),
    ]
    runs = [
        jobs.replay(spark, settings, [jobs.OffsetRange(*r) for r in ranges], source=source, ingested_at=INGESTED_AT, transformed_at=TRANSFORMED_AT)
        for source, ranges in wanted
    ]
    return spark.createDataFrame(
        [(k + 1, c.received, c.written) for k, c in enumerate(runs)], "run int, received bigint, written bigint"
    )


def redrive_rejects(spark, sf_dir):
    """Poisoned messages of even offsets are mended and driven again, twice; then the rest."""
    settings = _settings(spark, "redrive")
    clean = topic(spark, sf_dir)
    jobs.load_bronze(spark, settings, _poisoned(clean), ingested_at=INGESTED_AT)
    jobs.load_silver(spark, settings, transformed_at=TRANSFORMED_AT)
    # Only the messages that were damaged are looked up: no others are shuffled.
    struck = reduce(lambda a, b: a | b, [F.col("offset") % n == 0 for n in _damages()])
    good = clean.where(struck).select("topic", "partition", "offset", "value")

    def mended(which: Column) -> Callable[[DataFrame], DataFrame]:
        return lambda messages: messages.drop("value").where(which).join(good.where(which), ["topic", "partition", "offset"])

    runs = []
    for which in (F.col("offset") % 2 == 0, F.col("offset") % 2 == 0, F.lit(True)):
        counts = jobs.redrive(spark, settings, mended(which), ingested_at=INGESTED_AT, transformed_at=TRANSFORMED_AT)
        layers = audit.layer_counts(
            bronze=tables.read_bronze(spark, settings.layer("bronze")),
            silver=tables.read_silver(spark, settings.layer("silver")),
            quarantine=tables.read_quarantine(spark, settings.layer("quarantine"), "topic"),
        )
        numbers = {r.layer: r.row_count for r in layers.collect()}
        runs.append((len(runs) + 1, counts.opened, counts.stored, numbers["bronze"], numbers["silver"], numbers["quarantine"]))
    return spark.createDataFrame(runs, "run int, opened bigint, stored bigint, bronze bigint, silver bigint, quarantine bigint")


def layer_counts(spark, sf_dir):
    return audit.layer_counts(
        landing=raw_rows(spark, sf_dir),
        topic=topic(spark, sf_dir),
        bronze=bronze(spark, sf_dir),
        silver=silver(spark, sf_dir),
    )


def revenue_by_country(spark, sf_dir):
    return plain(reports.revenue_by_country(silver(spark, sf_dir), AS_OF))


def revenue_by_country_prev_month(spark, sf_dir):
    return plain(reports.revenue_by_country(silver(spark, sf_dir), AS_OF_JANUARY))


def revenue_by_country_reference_mode(spark, sf_dir):
    """Asked in June and in January, when this mode names a month 0 and finds nothing."""
    asked = [
        reports.revenue_by_country(silver(spark, sf_dir), day, mode=reports.REFERENCE).withColumn(
            "as_of", F.lit(str(day))
        )
        for day in (AS_OF, AS_OF_JANUARY)
    ]
    return plain(asked[0].unionAll(asked[1]))


def _summed_silver(spark: SparkSession, sf_dir: str) -> Settings:
    """Silver in four merges: two that are summed, a full replay, and late rows of all months,
    of which the sums know nothing."""
    settings = _settings(spark, "sums")
    rows = curated(spark, sf_dir)
    part = _offset_of(KEY) % 4
    for batch in (rows.where(part == 0), rows.where(part.isin(1, 2)), rows.where(part != 3)):
        merge_into(batch, settings.layer("silver"))
        rollup.refresh(spark, settings)
    merge_into(rows, settings.layer("silver"))
    return settings


def revenue_from_sums(spark, sf_dir):
    return plain(rollup.revenue_by_country(spark, _summed_silver(spark, sf_dir), AS_OF))


def revenue_by_month(spark, sf_dir):
    return plain(rollup.revenue_by_month(spark, _summed_silver(spark, sf_dir)))


def catalog_months(spark, sf_dir):
    """Two loads into a catalog table, told each time of the load's months alone."""
    settings = _settings(spark, "catalog")
    name = f"silver_{uuid.uuid4().hex}"
    tables.create_silver_table(spark, name, settings.layer("silver"))
    rows = bronze(spark, sf_dir)
    early = F.month("order_date") % 2 == 0
    for batch in (rows.where(early), rows.where(~early | (F.col("kafka_offset") % 2 == 0))):
        jobs.load_silver(spark, settings, batch, transformed_at=TRANSFORMED_AT, table=name)
    return spark.table(name).groupBy("order_year", "order_month", "country").agg(
        F.count("*").alias("row_count"), F.sum("units_sold").alias("total_units")
    )


def adhoc_sql(spark, sf_dir):
    """Plain SQL on the named layers."""
    tables.register_views(spark, bronze_path(spark, sf_dir), silver_path(spark, sf_dir))
    return plain(
        spark.sql(
            """
            SELECT s.country, s.order_year, SUM(s.total_revenue) AS total_revenue,
                   SUM(s.units_sold) AS total_units, COUNT(b.kafka_offset) AS raw_rows
            FROM sales_silver s
            JOIN sales_bronze b ON s.source_kafka_offset
              = concat_ws('-', b.kafka_topic, b.kafka_partition, b.kafka_offset)
            GROUP BY s.country, s.order_year
            """
        )
    )


# ------------------------------------------------------------------ files and manifest


def _page_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id",
        "url",
        F.md5("html").alias("etag"),
        F.octet_length("html").cast("bigint").alias("content_length"),
        F.md5("html").alias("checksum_md5"),
    )


def _prior_manifest(pages: DataFrame) -> DataFrame:
    """What an earlier run may have recorded: some pages unknown, some unfinished, some
    without an etag or a length, some since changed."""
    k = F.col("page_id") % 8
    return pages.where(k != 0).select(
        "url",
        F.when(k == 2, "").when(k == 3, F.lit(None)).when(k == 4, "old").otherwise(
            F.col("etag")
        ).alias("etag"),
        F.when(k == 3, F.col("content_length") + 1)
        .when(k == 5, F.lit(None))
        .otherwise(F.col("content_length"))
        .alias("content_length"),
        "checksum_md5",
        F.lit(INGESTED_AT).cast("timestamp").alias("downloaded_at"),
        F.when(k == 1, manifest.EXTRACTED).otherwise(manifest.PRODUCED).alias("status"),
    )


def manifest_changes(spark, sf_dir):
    pages = _page_manifest(spark, sf_dir)
    current = pages.withColumn("etag", F.when(F.col("page_id") % 8 != 6, F.col("etag")))
    return manifest.detect_changes(current, _prior_manifest(pages)).select(
        "page_id", "url", "is_new"
    )


def manifest_states(spark, sf_dir):
    """The state of each page after a further cycle: new versions land and are published."""
    pages = _page_manifest(spark, sf_dir)
    prior = _prior_manifest(pages)
    changed = manifest.detect_changes(pages, prior).where("is_new")
    landed = manifest.as_extracted(changed, INGESTED_AT + timedelta(days=1))
    noted = prior.unionAll(landed)
    done = noted.unionAll(manifest.as_produced(noted))
    return plain(manifest.latest(done).select("url", "downloaded_at", "status"))


_PAGES_PER_FILE = 100


def file_manifest(spark, sf_dir):
    """Pages written as text files of a hundred each, then listed and hashed."""
    path = fresh_path(spark, "pages")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        F.expr(f"page_id div {_PAGES_PER_FILE}").alias("file_no"), "page_id", "html"
    )
    (
        pages.repartition("file_no")
        .sortWithinPartitions("file_no", "page_id")
        .drop("page_id")
        .write.partitionBy("file_no")
        .text(path)
    )
    files = archive.file_manifest(spark, path, "*.txt")
    return files.select(
        F.regexp_extract("path", "file_no=([0-9]+)/", 1).cast("bigint").alias("file_no"),
        "length",
        "checksum_md5",
    )


_PAGES_PER_CHECK = 10


def _page_files(directory: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def write(pages: pd.DataFrame) -> pd.DataFrame:
        filesystem, inner = open_filesystem(directory)
        number = int(pages["file_no"].iloc[0])
        with filesystem.open_output_stream(f"{inner}/{number}.txt") as out:
            out.write("\n".join(pages.sort_values("page_id")["html"]).encode())
        return pd.DataFrame({"file_no": [number]})

    return write


def changed_files(spark, sf_dir):
    """Files of ten pages each, checked against a manifest after some are new, some have other
    content of the same length and some are written again as they were. Untouched ones are
    not opened."""
    path = fresh_path(spark, "pages")
    filesystem, inner = open_filesystem(path)
    filesystem.create_dir(inner)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        F.expr(f"page_id div {_PAGES_PER_CHECK}").alias("file_no"), "page_id", "html"
    )

    def put(rows: DataFrame) -> None:
        stage(rows.groupBy("file_no").applyInPandas(_page_files(path), "file_no bigint"), "page-files")

    kind = F.col("file_no") % 4
    put(pages.where(kind != 0))
    nothing = spark.createDataFrame([], MANIFEST)
    first = jobs.changed_files(archive.file_facts(spark, path, "*.txt"), nothing)
    known = stage(manifest.as_touched(first, INGESTED_AT), "manifest")
    put(pages.where(kind != 3).withColumn("html", F.when(kind == 1, F.translate("html", "<>", "><")).otherwise(F.col("html"))))
    facts = stage(archive.file_facts(spark, path, "*.txt"), "facts")
    found = stage(jobs.changed_files(facts, known), "changed").select("url", F.lit(True).alias("opened"), "is_new")
    return facts.join(found, "url", "left").select(
        F.regexp_extract("url", "([0-9]+)[.]txt$", 1).cast("bigint").alias("file_no"),
        F.coalesce("opened", F.lit(False)).alias("opened"),
        F.coalesce("is_new", F.lit(False)).alias("is_new"),
    )


_MEMBER_ROWS = 2000


def _zip_batches(directory: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, inner = open_filesystem(directory)
        name = f"{inner}/part-{TaskContext.get().partitionId():05d}.zip"
        number = 0
        with filesystem.open_output_stream(name) as out, zipfile.ZipFile(
            out, "w", zipfile.ZIP_DEFLATED
        ) as opened:
            for batch in batches:
                for start in range(0, len(batch), _MEMBER_ROWS):
                    piece = batch.iloc[start : start + _MEMBER_ROWS]
                    opened.writestr(f"rows/{number}.csv", piece.to_csv(index=False))
                    number += 1
        yield pd.DataFrame({"archive": [name], "members": [number]})

    return write


def _write_archives(spark: SparkSession, sf_dir: str, path: str) -> None:
    """All raw rows, packed by their tasks into archives."""
    filesystem, inner = open_filesystem(path)
    filesystem.create_dir(inner)
    rows = raw_rows(spark, sf_dir).select(*[F.col(f"`{h}`") for h in HEADERS])
    stage_lean(rows.mapInPandas(_zip_batches(path), "archive string, members int"), "archive-list")


def archive_records(spark, sf_dir):
    path = fresh_path(spark, "archives")
    _write_archives(spark, sf_dir, path)
    raw, _ = archive.read_archives(spark, path)
    return plain(valid(judge_landing(raw)))


_LONG = 200_000


def archive_rejects(spark, sf_dir):
    """Three files that are no archives and one member that is no data file among the good
    ones, and a field longer than most readers take."""
    path = fresh_path(spark, "archives")
    _write_archives(spark, sf_dir, path)
    filesystem, inner = open_filesystem(path)
    for k in range(3):
        with filesystem.open_output_stream(f"{inner}/broken-{k}.zip") as out:
            out.write(b"no archive" * k)
    first = [spark.read.parquet(f"{sf_dir}/{t}.parquet").first() for t in ("region",)][0]["r_name"]
    with filesystem.open_output_stream(f"{inner}/odd.zip") as out, zipfile.ZipFile(out, "w") as opened:
        opened.writestr("note.txt", first)
        fields = ["1", first, "x" * _LONG, "i", "Online", "H", "1/3/2010", "2/9/2010", "1", "1", "1", "1", "1", "0"]
        opened.writestr("long.csv", "\n".join([",".join(HEADERS), ",".join(fields)]) + "\n")
    raw, members = archive.read_archives(spark, path)
    outcome = F.coalesce("reject_class", F.lit("VALID")).alias("outcome")
    rows = judge_landing(raw).select(outcome, F.length("country").alias("n"))
    rows = rows.groupBy("outcome").agg(F.count("*").alias("row_count"), F.max("n").alias("longest_country"))
    aside = unreadable(members).groupBy(F.col("reject_class").alias("outcome")).agg(F.count("*").alias("row_count"))
    return rows.unionAll(aside.withColumn("longest_country", F.lit(None).cast("int")))


def ingest_cycle_twice(spark, sf_dir):
    """Archives to silver, twice over: the manifest keeps the second cycle from adding."""
    settings = _settings(spark, "cycle")
    _write_archives(spark, sf_dir, settings.layer("archive"))
    for day in range(2):
        jobs.ingest_cycle(spark, settings, at=INGESTED_AT + timedelta(days=day), ingested_at=INGESTED_AT)
    return audit.layer_counts(
        topic=tables.read_topic(spark, settings.layer("topic")),
        bronze=tables.read_bronze(spark, settings.layer("bronze")),
        silver=tables.read_silver(spark, settings.layer("silver")),
    )


# ------------------------------------------------------------------------- streaming


def _drain(*queries) -> None:
    for query in queries:
        query.awaitTermination()


def _stream_layers(
    spark: SparkSession, sf_dir: str, settings: Settings, run: str,
    change: Callable[[DataFrame], DataFrame] = lambda messages: messages,
) -> None:
    """``change`` is made to the messages as they are read."""
    source = change(ingest.topic_stream(spark, topic_path(spark, sf_dir), max_files=3))
    _drain(
        ingest.start_bronze(
            spark,
            settings,
            fresh_path(spark, f"checkpoint-bronze-{run}"),
            source,
            ingested_at=INGESTED_AT,
            source_file=SOURCE_FILE,
        )
    )
    _drain(
        ingest.start_silver(
            spark,
            settings,
            fresh_path(spark, f"checkpoint-silver-{run}"),
            transformed_at=TRANSFORMED_AT,
        )
    )


def stream_to_silver(spark, sf_dir):
    settings = _settings(spark, "stream")
    _stream_layers(spark, sf_dir, settings, "a")
    return plain(tables.read_silver(spark, settings.layer("silver")))


def stream_replay(spark, sf_dir):
    """The topic streamed twice, the second time with no memory of the first."""
    settings = _settings(spark, "stream")
    _stream_layers(spark, sf_dir, settings, "a")
    _stream_layers(spark, sf_dir, settings, "b")
    return audit.layer_counts(
        bronze=tables.read_bronze(spark, settings.layer("bronze")),
        silver=tables.read_silver(spark, settings.layer("silver")),
    )


def stream_resume(spark, sf_dir):
    """A topic that grows between two runs of the same streams."""
    settings = _settings(spark, "stream")
    messages = topic(spark, sf_dir)
    checkpoints = [fresh_path(spark, f"checkpoint-{layer}") for layer in ("bronze", "silver")]
    runs = []
    for arrived in (F.col("offset") % 4 == 0, F.col("offset") % 4 != 0):
        tables.append_topic(messages.where(arrived), settings.layer("topic"))
        merged = []
        _drain(ingest.start_bronze(spark, settings, checkpoints[0], ingested_at=INGESTED_AT))
        _drain(ingest.start_silver(spark, settings, checkpoints[1], on_merge=merged.append))
        runs.append((len(runs) + 1, sum(m.received for m in merged), sum(m.written for m in merged)))
    return spark.createDataFrame(runs, "run int, received bigint, written bigint")


def stream_old_file(spark, sf_dir):
    """Files that come late and carry a stamp far older than those already read."""
    settings = _settings(spark, "stream")
    messages = topic(spark, sf_dir)
    tables.append_topic(messages.where(F.col("offset") % 4 == 0), settings.layer("topic"))
    _drain(ingest.start_bronze(spark, settings, bronze := fresh_path(spark, "checkpoint-bronze"), ingested_at=INGESTED_AT))
    late = fresh_path(spark, "late")
    tables.append_topic(messages.where(F.col("offset") % 4 != 0), late)
    files, folder = _hadoop(spark, late)
    names = [x.getPath() for x in files.listStatus(folder) if x.getPath().getName().startswith("part-")]
    month_ago = names and files.getFileStatus(names[0]).getModificationTime() - 30 * 24 * 3600 * 1000
    _, target = _hadoop(spark, settings.layer("topic"))
    for name in names:
        files.setTimes(name, month_ago, -1)
        files.rename(name, target)
    _drain(ingest.start_bronze(spark, settings, bronze, ingested_at=INGESTED_AT))
    return audit.layer_counts(bronze=tables.read_bronze(spark, settings.layer("bronze")))


def _hadoop(spark: SparkSession, path: str):
    context = spark.sparkContext
    location = context._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(context._jsc.hadoopConfiguration()), location


def stream_repeated_batch(spark, sf_dir):
    """Both streams run once more after the commit of their last batch was lost."""
    settings = _settings(spark, "stream")
    checkpoints = [fresh_path(spark, f"checkpoint-{layer}") for layer in ("bronze", "silver")]
    for _ in range(2):
        source = ingest.topic_stream(spark, topic_path(spark, sf_dir), max_files=3)
        _drain(ingest.start_bronze(spark, settings, checkpoints[0], source, ingested_at=INGESTED_AT))
        _drain(ingest.start_silver(spark, settings, checkpoints[1], transformed_at=TRANSFORMED_AT))
        for checkpoint in checkpoints:
            files, commits = _hadoop(spark, f"{checkpoint}/commits")
            numbers = [x.getPath() for x in files.listStatus(commits) if x.getPath().getName().isdigit()]
            files.delete(max(numbers, key=lambda x: int(x.getName())), False)
    return audit.layer_counts(
        bronze=tables.read_bronze(spark, settings.layer("bronze")),
        silver=tables.read_silver(spark, settings.layer("silver")),
    )


def strict_stream(spark, sf_dir):
    """A strict bronze stream over poisoned messages stops and stores nothing."""
    settings = _settings(spark, "stream")
    messages = fresh_path(spark, "poisoned")
    tables.append_topic(_poisoned(topic(spark, sf_dir)), messages)
    source = ingest.topic_stream(spark, messages, max_files=100_000)
    query = ingest.start_bronze(
        spark, settings, fresh_path(spark, "checkpoint"), source, ingested_at=INGESTED_AT, on_error="strict"
    )
    try:
        query.awaitTermination()
        stopped = False
    except StreamingQueryException as error:
        stopped = "StrictValidationError" in str(error)
    stored = tables.read_bronze(spark, settings.layer("bronze")).agg(F.count("*").alias("stored"))
    return stored.withColumn("stopped", F.lit(stopped))


def stream_poison(spark, sf_dir):
    """Bad messages are set aside and the stream goes on."""
    settings = _settings(spark, "stream")
    _stream_layers(spark, sf_dir, settings, "a", _poisoned)
    aside = (
        spark.read.option("recursiveFileLookup", True)
        .parquet(settings.layer("quarantine"))
        .groupBy(F.col("reject_class").alias("outcome"))
        .agg(F.count("*").alias("row_count"))
    )
    kept = tables.read_silver(spark, settings.layer("silver")).agg(
        F.count("*").alias("row_count")
    )
    return aside.unionAll(kept.select(F.lit("SILVER").alias("outcome"), "row_count"))


def stream_run_log(spark, sf_dir):
    """The run log of both streams over poisoned messages, summed, after each stream's last batch
    ran once more."""
    settings = _settings(spark, "stream")
    checkpoints = [fresh_path(spark, f"checkpoint-{layer}") for layer in ("bronze", "silver")]
    for _ in range(2):
        source = _poisoned(ingest.topic_stream(spark, topic_path(spark, sf_dir), max_files=3))
        _drain(ingest.start_bronze(spark, settings, checkpoints[0], source, ingested_at=INGESTED_AT, log_runs=True))
        _drain(ingest.start_silver(spark, settings, checkpoints[1], transformed_at=TRANSFORMED_AT, log_runs=True))
        for checkpoint in checkpoints:
            files, commits = _hadoop(spark, f"{checkpoint}/commits")
            numbers = [x.getPath() for x in files.listStatus(commits) if x.getPath().getName().isdigit()]
            files.delete(max(numbers, key=lambda x: int(x.getName())), False)
    counted = [F.sum(c).alias(c) for c in ("received", "written", "skipped", "rejected")]
    return tables.read_runs(spark, settings.layer("runs")).groupBy("entry").agg(*counted)


def ingest_end_to_end(spark, sf_dir):
    """The batch jobs one after the other, from CSV files to silver."""
    settings = _settings(spark, "jobs")
    _write_landing(raw_rows(spark, sf_dir), settings.layer("landing"))
    jobs.publish(spark, settings)
    jobs.load_bronze(spark, settings, ingested_at=INGESTED_AT)
    jobs.load_silver(spark, settings, transformed_at=TRANSFORMED_AT)
    jobs.load_silver(spark, settings, transformed_at=TRANSFORMED_AT)
    without = [c for c in SILVER.fieldNames() if c not in (KEY, "silver_transformed_at")]
    return plain(tables.read_silver(spark, settings.layer("silver")).select(*without))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        landing_valid,
        landing_csv,
        landing_missing_column,
        row_cap,
        rejects_by_class,
        landing_run_counters,
        quarantined_rows,
        date_parse_formats,
        number_coercion,
        topic_positions,
        key_routing,
        topic_roundtrip,
        poison_messages,
        bronze_enriched,
        bronze_nested_roundtrip,
        offset_read_order,
        created_tables,
        bronze_ndjson,
        bronze_preview,
        silver_transform,
        margin_overflow,
        margin_zero_revenue,
        silver_rejects,
        silver_table,
        silver_file_order,
        silver_month,
        silver_partitions,
        merge_replay,
        merge_three_runs,
        compacted_silver,
        merge_incremental,
        merge_scattered,
        merge_counters,
        strict_merge,
        merge_first_copy,
        strict_duplicates,
        dedup_check,
        distinct_keys,
        missing_in_silver,
        completeness,
        missing_ranges,
        range_completeness,
        replay_ranges,
        redrive_rejects,
        layer_counts,
        revenue_by_country,
        revenue_by_country_prev_month,
        revenue_by_country_reference_mode,
        revenue_from_sums,
        revenue_by_month,
        catalog_months,
        adhoc_sql,
        manifest_changes,
        manifest_states,
        file_manifest,
        changed_files,
        archive_records,
        archive_rejects,
        ingest_cycle_twice,
        stream_to_silver,
        stream_replay,
        stream_resume,
        stream_poison,
        stream_old_file,
        stream_repeated_batch,
        strict_stream,
        stream_run_log,
        ingest_end_to_end,
    )
}
