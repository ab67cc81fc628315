"""The schemas of every layer, declared once."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)
MARGIN = T.DecimalType(6, 2)


class Field(NamedTuple):
    name: str
    header: str
    type: T.DataType


# The sales record, in model order, with its CSV headers.
FIELDS = (
    Field("order_id", "Order ID", T.LongType()),
    Field("region", "Region", T.StringType()),
    Field("country", "Country", T.StringType()),
    Field("item_type", "Item Type", T.StringType()),
    Field("sales_channel", "Sales Channel", T.StringType()),
    Field("priority", "Order Priority", T.StringType()),
    Field("order_date", "Order Date", T.DateType()),
    Field("ship_date", "Ship Date", T.DateType()),
    Field("units_sold", "Units Sold", T.IntegerType()),
    Field("unit_price", "Unit Price", T.DoubleType()),
    Field("unit_cost", "Unit Cost", T.DoubleType()),
    Field("total_revenue", "Total Revenue", T.DoubleType()),
    Field("total_cost", "Total Cost", T.DoubleType()),
    Field("total_profit", "Total Profit", T.DoubleType()),
)

SALES_COLUMNS = [f.name for f in FIELDS]
HEADERS = [f.header for f in FIELDS]
MONEY_COLUMNS = [f.name for f in FIELDS if isinstance(f.type, T.DoubleType)]

SALES = T.StructType([T.StructField(f.name, f.type) for f in FIELDS])

# The columns a Kafka source delivers, with key and value already read as text.
TOPIC = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

_TRANSPORT = [
    T.StructField("kafka_topic", T.StringType()),
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("kafka_timestamp_ms", T.LongType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("source_file", T.StringType()),
]
TRANSPORT_COLUMNS = [f.name for f in _TRANSPORT]

BRONZE = T.StructType(SALES.fields + _TRANSPORT)
BRONZE_NESTED = T.StructType([T.StructField("data", SALES)] + _TRANSPORT)

KEY = "source_kafka_offset"
SILVER_PARTITIONS = ["order_year", "order_month"]

SILVER = T.StructType(
    [T.StructField(f.name, f.type) for f in FIELDS[:8]]
    + [
        T.StructField("order_year", T.IntegerType()),
        T.StructField("order_month", T.IntegerType()),
        T.StructField("lead_time_days", T.IntegerType()),
        T.StructField("units_sold", T.IntegerType()),
    ]
    + [T.StructField(name, MONEY) for name in MONEY_COLUMNS]
    + [
        T.StructField("margin_pct", MARGIN),
        T.StructField("bronze_ingested_at", T.TimestampType()),
        T.StructField("silver_transformed_at", T.TimestampType()),
        T.StructField(KEY, T.StringType()),
    ]
)

REJECT_COLUMNS = ["reject_class", "reject_field", "reject_value", "reject_reason"]

# Rejected messages: where they stood, the whole message and why it was set aside.
TOPIC_REJECTS = T.StructType(
    [*_TRANSPORT, *[T.StructField(name, T.StringType()) for name in REJECT_COLUMNS], T.StructField("entry", T.StringType())]
)

MANIFEST = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("etag", T.StringType()),
        T.StructField("content_length", T.LongType()),
        T.StructField("checksum_md5", T.StringType()),
        T.StructField("downloaded_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
    ]
)

# One row per micro-batch: received = written + skipped + rejected.
RUNS = T.StructType(
    [T.StructField("entry", T.StringType()), T.StructField("batch", T.StringType()), T.StructField("started_at", T.TimestampType())]
    + [T.StructField(name, T.LongType()) for name in ("received", "written", "skipped", "rejected")]
)
