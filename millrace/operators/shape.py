"""Flat and nested forms of a bronze record, and its order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.schemas import SALES_COLUMNS, TRANSPORT_COLUMNS
from millrace.sources.topic import number_rows

_ARRIVAL = ["kafka_topic", "kafka_partition", "kafka_offset"]


def flatten(nested: DataFrame) -> DataFrame:
    return nested.select("data.*", *TRANSPORT_COLUMNS)


def nest(flat: DataFrame) -> DataFrame:
    return flat.select(F.struct(*SALES_COLUMNS).alias("data"), *TRANSPORT_COLUMNS)


def in_offset_order(bronze: DataFrame) -> DataFrame:
    """The order of arrival: by topic partition, then offset as a number."""
    return bronze.orderBy(*_ARRIVAL)


def read_rank(bronze: DataFrame) -> DataFrame:
    """The place of each row in the order of arrival, from 0, as ``read_rank``."""
    return number_rows(bronze.withColumn("_all", F.lit(0)), "_all", _ARRIVAL, "read_rank").drop("_all")
