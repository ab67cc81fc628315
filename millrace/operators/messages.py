"""Sales records to topic messages and back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.validate import (
    BAD_TYPE,
    MALFORMED_JSON,
    REJECT_COLUMNS,
    _verdict,
    judge,
)
from millrace.schemas import FIELDS, SALES_COLUMNS, TRANSPORT_COLUMNS

_TEXT_FIELDS = [f.name for f in FIELDS if isinstance(f.type, T.StringType)]
_CORRUPT = "_corrupt"

# Numbers and dates are read as text and typed by the common rules. The text fields
# are read as variants, which still know whether the JSON value was a string.
_ENVELOPE = T.StructType(
    [
        T.StructField(
            f.name, T.VariantType() if f.name in _TEXT_FIELDS else T.StringType()
        )
        for f in FIELDS
    ]
    + [T.StructField(_CORRUPT, T.StringType())]
)

# What a consumer reports as the offending field, whichever field it was.
MESSAGE_FIELD = "kafka_message"


def encode(sales: DataFrame) -> DataFrame:
    """Add the message ``key`` and JSON ``value`` and drop the record's own columns."""
    body = F.struct(*SALES_COLUMNS)
    carried = [c for c in sales.columns if c not in SALES_COLUMNS]
    return sales.select(
        *carried,
        F.col("order_id").cast("string").alias("key"),
        F.to_json(body, {"dateFormat": "yyyy-MM-dd"}).alias("value"),
    )


def as_text(messages: DataFrame) -> DataFrame:
    """Kafka delivers key and value as bytes; the rest of the job wants text."""
    return messages.withColumns(
        {"key": F.col("key").cast("string"), "value": F.col("value").cast("string")}
    )


def _text_of(name: str) -> Column:
    column = F.col(f"_j.{name}")
    if name not in _TEXT_FIELDS:
        return column
    return F.when(
        F.schema_of_variant(column) == "STRING", F.try_variant_get(column, "$", "string")
    )


def judge_messages(messages: DataFrame, *, keep: list[str]) -> DataFrame:
    """Decode JSON values and apply every record rule again; unknown fields are ignored.

    Whatever fails is reported against the message as a whole, with the class telling
    the cause.
    """
    parsed = messages.select(
        *keep,
        "value",
        F.from_json("value", _ENVELOPE, {"columnNameOfCorruptRecord": _CORRUPT}).alias("_j"),
    )
    ends_as_object = F.rtrim("value").endswith("}")
    other_json = ~F.startswith(F.schema_of_variant(F.try_parse_json("value")), F.lit("OBJECT"))
    # Only a null can be an absent field, so good messages never list their keys.
    keys = F.json_object_keys("value")
    some_null = F.lit(False)
    for f in FIELDS:
        some_null = some_null | F.col(f"_j.{f.name}").isNull()
    absent = F.when(
        some_null,
        F.array_except(F.array(*[F.lit(c) for c in SALES_COLUMNS]), F.coalesce(keys, F.array())),
    ).otherwise(F.array().cast("array<string>"))
    whole = F.col("value")
    judged = judge(
        parsed.withColumn(
            "_broken",
            F.col("value").isNull() | F.col(f"_j.{_CORRUPT}").isNotNull() | ~ends_as_object,
        ),
        {f.name: _text_of(f.name) for f in FIELDS},
        [*[F.col(c) for c in keep], whole, F.col("_broken")],
        first=[
            (
                F.col("_broken") & other_json,
                _verdict(BAD_TYPE, MESSAGE_FIELD, whole, "not a JSON object"),
            ),
            (
                F.col("_broken"),
                _verdict(MALFORMED_JSON, MESSAGE_FIELD, whole, "not valid JSON"),
            ),
        ],
        absent=absent,
    )
    is_rejected = F.col("reject_class").isNotNull()
    return judged.select(
        *keep,
        *SALES_COLUMNS,
        "reject_class",
        F.when(is_rejected, F.lit(MESSAGE_FIELD)).alias("reject_field"),
        F.when(is_rejected, whole).alias("reject_value"),
        F.when(
            is_rejected, F.concat_ws(": ", F.col("reject_field"), F.col("reject_reason"))
        ).alias("reject_reason"),
    )


def judge_topic(
    messages: DataFrame, source_file: str | None, ingested_at: datetime | Column | None = None
) -> DataFrame:
    """Messages to judged bronze rows: the record plus where it came from.

    Give ``ingested_at`` to have repeated reads of one batch agree. Without a
    ``source_file`` the messages bring their own as a column.
    """
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    stamp = stamp if isinstance(stamp, Column) else F.lit(stamp)
    positions = ["topic", "partition", "offset", "timestamp"]
    judged = judge_messages(messages, keep=positions if source_file is not None else [*positions, "source_file"])
    return judged.select(
        *SALES_COLUMNS,
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.unix_millis("timestamp").alias("kafka_timestamp_ms"),
        stamp.cast("timestamp").alias("ingested_at"),
        (F.lit(source_file) if source_file is not None else F.col("source_file")).alias("source_file"),
        *REJECT_COLUMNS,
    )


def judge_nested(nested: DataFrame) -> DataFrame:
    """Nested bronze as judged flat rows: a stored record must keep every rule again."""
    text = {f.name: F.col(f"data.{f.name}").cast("string") for f in FIELDS}
    return judge(nested, text, [F.col(c) for c in TRANSPORT_COLUMNS])
