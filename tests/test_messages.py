import json

import pytest
from pyspark.sql import functions as F

from millrace.operators.messages import as_text, encode, judge_topic
from millrace.sources.topic import assign_positions, next_offsets, number_rows
from millrace.operators.validate import judge_landing, rejected, valid
from millrace.schemas import SALES_COLUMNS, TOPIC

from samples import STAMP


@pytest.fixture
def message(spark, csv_rows):
    base = json.loads(encode(valid(judge_landing(csv_rows({})))).first().value)

    def make(*values):
        rows = [
            ("k", v if v is None or isinstance(v, str) else json.dumps({**base, **v}), "t", 1, i, STAMP)
            for i, v in enumerate(values)
        ]
        return spark.createDataFrame(rows, TOPIC)

    make.base = base
    return make


def test_key_and_value(csv_rows):
    row = encode(valid(judge_landing(csv_rows({"Order ID": "42"})))).first()
    assert row.key == "42"
    value = json.loads(row.value)
    assert list(value) == SALES_COLUMNS
    assert (value["order_date"], value["ship_date"]) == ("2010-01-03", "2010-02-09")
    assert value["total_revenue"] == 2497.5 and value["units_sold"] == 250


def test_round_trip_and_metadata(csv_rows, message):
    sales = valid(judge_landing(csv_rows({}, {"Region": 'a "b", c', "Total Revenue": "1e9"})))
    values = [r.value for r in encode(sales).collect()]
    judged = judge_topic(message(*values), "file.csv", STAMP)
    got = valid(judged)
    assert got.select(*SALES_COLUMNS).exceptAll(sales).count() == 0
    row = got.where("kafka_offset = 1").first()
    assert (row.kafka_topic, row.kafka_partition, row.kafka_timestamp_ms) == ("t", 1, 1609459200000)
    assert (row.source_file, row.ingested_at) == ("file.csv", STAMP.replace(tzinfo=None))


def without(base, name):
    return json.dumps({k: v for k, v in base.items() if k != name})


def test_reject_classes(message):
    base = message.base
    cases = [
        ('{"not": "a sales record"}', "MISSING_FIELD"),
        (without(base, "region"), "MISSING_FIELD"),
        (without(base, "order_date"), "MISSING_FIELD"),
        ({"order_date": "not-a-date"}, "INVALID_DATE"),
        ({"order_date": None}, "INVALID_DATE"),
        (json.dumps({"ship_date": "x"}), "INVALID_DATE"),
        ({"order_date": 20200101}, "INVALID_DATE"),
        ({"ship_date": "1999-01-01"}, "SCHEMA_RULE"),
        ({"region": 5}, "BAD_TYPE"),
        ({"region": None}, "BAD_TYPE"),
        ({"region": {"region": "x"}}, "BAD_TYPE"),
        ({"units_sold": "many"}, "BAD_TYPE"),
        ({"units_sold": 250.5}, "BAD_TYPE"),
        ({"total_cost": None}, "BAD_TYPE"),
        ({"total_cost": float("nan")}, "BAD_TYPE"),
        (json.dumps(base)[:-1], "MALFORMED_JSON"),
        (json.dumps(base) + " x", "MALFORMED_JSON"),
        ("", "MALFORMED_JSON"),
        (None, "MALFORMED_JSON"),
        ("[1, 2]", "BAD_TYPE"),
        ("5", "BAD_TYPE"),
    ]
    judged = judge_topic(message(*[c[0] for c in cases]), "f", STAMP)
    got = {r.kafka_offset: r for r in rejected(judged).collect()}
    assert {i: r.reject_class for i, r in got.items()} == {i: c[1] for i, c in enumerate(cases)}
    assert {r.reject_field for r in got.values()} == {"kafka_message"}
    assert got[0].reject_value == '{"not": "a sales record"}'
    assert "order_date" in got[3].reject_reason and "not-a-date" in got[3].reject_reason


def test_accepted_forms(message):
    cases = [
        {"extra": {"a": [1]}},
        {"units_sold": 250.0},
        {"units_sold": "250"},
        {"units_sold": 1e3},
        {"order_date": "1/3/2010"},
        {"total_cost": "12.5"},
        {"region": ""},
        {"region": "5"},
    ]
    judged = judge_topic(message(*cases), "f", STAMP)
    assert rejected(judged).collect() == []
    rows = {r.kafka_offset: r for r in judged.collect()}
    assert [rows[i].units_sold for i in range(4)] == [250, 250, 250, 1000]
    assert rows[5].total_cost == 12.5 and rows[7].region == "5"


def test_kafka_bytes(message):
    raw = message({}).withColumns(
        {"key": F.col("key").cast("binary"), "value": F.col("value").cast("binary")}
    )
    assert valid(judge_topic(as_text(raw), "f", STAMP)).count() == 1


def test_positions_are_dense_ordered_and_routed(spark):
    rows = spark.range(1000).select(
        (F.col("id") % 97 - 10).alias("order_id"), (1000 - F.col("id")).alias("seq")
    )
    got = assign_positions(rows, ["seq"], topic="t", partitions=3).collect()
    assert all(r.partition == r.order_id % 3 for r in got)
    for part in range(3):
        inside = sorted((r for r in got if r.partition == part), key=lambda r: r.offset)
        assert [r.offset for r in inside] == list(range(len(inside)))
        assert [r.seq for r in inside] == sorted(r.seq for r in inside)


def test_positions_continue_a_topic(spark):
    rows = spark.range(100).select(F.col("id").alias("order_id"), F.col("id").alias("seq"))
    stored = spark.createDataFrame([(0, 6), (0, 9), (2, 3)], "partition int, offset bigint")
    got = assign_positions(rows, ["seq"], topic="t", partitions=3, start=next_offsets(stored))
    first = {r.partition: r.low for r in got.groupBy("partition").agg(F.min("offset").alias("low")).collect()}
    assert first == {0: 10, 1: 0, 2: 4}


def test_numbering_splits_a_hot_group(spark):
    """All rows in one group, a third of them of one order: still many slices."""
    rows = spark.range(30000).select(
        F.lit(0).alias("g"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("order_id"),
        F.col("id").alias("seq"),
    )
    numbered = number_rows(rows, "g", ["order_id", "seq"], "n")
    facts = numbered.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()
    assert tuple(facts) == (0, 29999, 30000)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan  # over the handful of slices
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan
