import os

import pytest

from millrace.operators.curate import curate, to_silver
from millrace.operators.merge import merge_into
from millrace.operators.shape import flatten, in_offset_order, nest
from millrace.schemas import BRONZE, BRONZE_NESTED, SILVER
from millrace.sources import tables
from millrace.sources.tables import (
    append_bronze,
    append_silver,
    read_bronze,
    read_bronze_ndjson,
    read_silver,
    replace_batch,
    write_bronze_ndjson,
)


def names(schema):
    return [(f.name, f.dataType) for f in schema]


def test_missing_and_empty_folders_have_no_rows(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for folder in ("missing", "empty"):
        path = str(tmp_path / folder)
        assert read_bronze(spark, path).count() == 0
        assert read_silver(spark, path).count() == 0
        assert read_bronze_ndjson(spark, path).count() == 0
    assert names(read_silver(spark, str(tmp_path / "missing")).schema) == names(SILVER)


def test_bronze_appends_a_thousand_rows_twice(spark, bronze_rows, tmp_path):
    path = str(tmp_path / "bronze")
    rows = bronze_rows(*[{"order_id": i} for i in range(1000)])
    append_bronze(rows, path)
    append_bronze(rows, path)
    got = read_bronze(spark, path)
    assert got.count() == 2000 and names(got.schema) == names(BRONZE)
    assert got.distinct().exceptAll(rows).count() == 0
    assert any(f.endswith(".zstd.parquet") for f in os.listdir(path))


def test_a_batch_written_again_replaces_itself(spark, bronze_rows, tmp_path):
    path = str(tmp_path / "bronze")
    rows = bronze_rows({"kafka_offset": 5})
    replace_batch(rows, path, "batch-0")
    replace_batch(rows, path, "batch-0")
    replace_batch(bronze_rows({"kafka_offset": 6}), path, "batch-1")
    assert sorted(r.kafka_offset for r in read_bronze(spark, path).collect()) == [5, 6]


def test_ndjson_round_trip(spark, bronze_rows, tmp_path):
    path = str(tmp_path / "nd")
    rows = bronze_rows(*[{"kafka_offset": n} for n in (9, 3, 1, 7)])
    write_bronze_ndjson(rows.coalesce(1), path, "batch-0")
    got = read_bronze_ndjson(spark, path, "*.json")
    assert names(got.schema) == names(BRONZE_NESTED)
    assert flatten(got).exceptAll(rows).count() == 0
    assert [r.kafka_offset for r in got.collect()] == [1, 3, 7, 9]


def test_ndjson_files_of_other_writers(spark, tmp_path):
    line = (
        '{"data": {"order_id": 1, "region": "Europe", "country": "France", "item_type": "Meat",'
        ' "sales_channel": "Online", "priority": "H", "order_date": "2020-01-03",'
        ' "ship_date": "2020-01-10", "units_sold": 1, "unit_price": 9.99, "unit_cost": 5.5,'
        ' "total_revenue": 9.99, "total_cost": 5.5, "total_profit": 4.49}, "kafka_topic": "t",'
        ' "kafka_partition": 2, "kafka_offset": 99, "kafka_timestamp_ms": 1609459200000,'
        ' "ingested_at": "2021-01-01T00:00:00.123456Z", "source_file": "f.csv"}'
    )
    (tmp_path / "p2_o99.ndjson").write_text(f"{line}\n\n  \n{line}\n")
    (tmp_path / "ignore.txt").write_text("not json")
    got = flatten(read_bronze_ndjson(spark, str(tmp_path))).collect()
    assert len(got) == 2 and got[0].kafka_offset == 99
    assert got[0].ingested_at.microsecond == 123456
    (tmp_path / "bad.ndjson").write_text("{broken\n")
    with pytest.raises(Exception):
        read_bronze_ndjson(spark, str(tmp_path)).collect()


def test_flat_and_nested_forms(bronze_rows):
    rows = bronze_rows({}, {"order_id": 2})
    assert nest(rows).schema["data"].dataType.fieldNames() == BRONZE.fieldNames()[:14]
    assert flatten(nest(rows)).exceptAll(rows).count() == 0


def test_offset_order_is_numeric(bronze_rows):
    rows = bronze_rows(*[{"kafka_offset": n, "kafka_partition": n % 2} for n in (10, 2, 9, 1)])
    got = [(r.kafka_partition, r.kafka_offset) for r in in_offset_order(rows).collect()]
    assert got == [(0, 2), (0, 10), (1, 1), (1, 9)]


def test_silver_is_partitioned_and_pruned(spark, bronze_rows, tmp_path):
    path = str(tmp_path / "silver")
    merge_into(curate(bronze_rows({}, {})), path)
    assert os.listdir(f"{path}/order_year=2020") == ["order_month=1"]
    month = read_silver(spark, path).where("order_year = 2020 and order_month = 1")
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan
    assert month.count() == 2
    assert names(read_silver(spark, path).schema) == names(SILVER)


def test_a_month_is_written_together(spark, bronze_rows, tmp_path):
    """Rows from many tasks make one file per month, not one per task and month."""
    path = tmp_path / "silver"
    rows = bronze_rows(*[{} for _ in range(200)]).repartition(16)
    append_silver(to_silver(rows), str(path))
    files = [f for f in (path / "order_year=2020" / "order_month=1").iterdir() if f.suffix == ".parquet"]
    assert len(files) == 1


def test_catalog_tables(spark, bronze_rows, tmp_path):
    bronze_path, silver_path = str(tmp_path / "b"), str(tmp_path / "s")
    rows = bronze_rows({}, {})
    append_bronze(rows, bronze_path)
    merge_into(curate(rows), silver_path)
    for _ in range(2):
        tables.create_bronze_table(spark, "sales_bronze_t", bronze_path)
        tables.create_silver_table(spark, "sales_silver_t", silver_path)
    tables.refresh_silver_table(spark, "sales_silver_t")
    try:
        assert spark.table("sales_bronze_t").count() == 2
        got = spark.sql("SELECT count(*) FROM sales_silver_t WHERE order_year = 2020").first()[0]
        assert got == 2
        tables.register_views(spark, bronze_path, silver_path)
        assert spark.sql("SELECT max(units_sold) FROM sales_silver").first()[0] == 100
    finally:
        spark.sql("DROP TABLE sales_bronze_t")
        spark.sql("DROP TABLE sales_silver_t")
        spark.catalog.dropTempView("sales_bronze")
        spark.catalog.dropTempView("sales_silver")
