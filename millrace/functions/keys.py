"""Message keys and positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_key(topic: Column, partition: Column, offset: Column) -> Column:
    """``topic-partition-offset``: the identity of a message, never its order id."""
    return F.concat_ws("-", topic, partition.cast("string"), offset.cast("string"))
