"""Partial sums per data file, months in the catalog, and the run log of streams."""

import os
import uuid
from datetime import date

import pytest

from millrace import Settings
from millrace.operators.curate import curate
from millrace.operators.merge import merge_into
from millrace.plans import reports, rollup
from millrace.sources import tables

MAY, JUNE = date(2020, 5, 3), date(2020, 6, 3)
AS_OF = date(2020, 6, 15)


@pytest.fixture
def settings(tmp_path):
    return Settings(root=str(tmp_path / "lake"))


@pytest.fixture
def merge(bronze_rows, settings):
    def send(*rows):
        defaults = {"order_date": MAY, "ship_date": date(2020, 7, 1)}
        return merge_into(curate(bronze_rows(*[{**defaults, **r} for r in rows])), settings.layer("silver"))

    return send


def same(spark, settings, as_of=AS_OF):
    want = reports.revenue_by_country(tables.read_silver(spark, settings.layer("silver")), as_of)
    got = rollup.revenue_by_country(spark, settings, as_of)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert got.collect() == want.collect()
    return got.collect()


def test_report_equals_silver_at_every_step(spark, settings, merge):
    assert rollup.revenue_by_country(spark, settings, AS_OF).collect() == []
    assert rollup.refresh(spark, settings) == 0
    first = [{"kafka_offset": n, "country": c, "units_sold": n + 1} for n, c in enumerate("AABAB")]
    merge(*first)
    same(spark, settings)
    assert rollup.refresh(spark, settings) == 1
    assert rollup.refresh(spark, settings) == 0
    before = same(spark, settings)
    # A replay adds no file.
    assert merge(*first).written == 0
    assert rollup.refresh(spark, settings) == 0
    assert same(spark, settings) == before
    # Late rows of a month count before and after they are summed.
    merge({"kafka_offset": 90, "country": "C", "total_revenue": 0.0}, {"kafka_offset": 91, "order_date": JUNE})
    late = same(spark, settings)
    assert len(late) == len(before) + 1
    assert rollup.refresh(spark, settings) == 2
    assert same(spark, settings) == late
    assert len(same(spark, settings, date(2020, 7, 1))) == 1


def test_only_late_files_are_read(spark, settings, merge):
    merge({"kafka_offset": 1})
    rollup.refresh(spark, settings)
    plan = rollup.revenue_by_country(spark, settings, AS_OF)._jdf.queryExecution().toString()
    assert "units_sold" not in plan
    merge({"kafka_offset": 2})
    plan = rollup.revenue_by_country(spark, settings, AS_OF)._jdf.queryExecution().toString()
    assert "units_sold" in plan


def test_sums_stored_twice_count_once_and_gone_files_not_at_all(spark, settings, merge):
    merge({"kafka_offset": 1, "country": "A"})
    merge({"kafka_offset": 2, "country": "B"})
    rollup.refresh(spark, settings)
    sums = rollup.read_sums(spark, settings.layer("sums")).collect()
    again = spark.createDataFrame(sums, rollup.SUMS)
    again.write.mode("append").partitionBy("order_year", "order_month").parquet(settings.layer("sums"))
    assert len(same(spark, settings)) == 2
    os.remove(f"{settings.layer('silver')}/{sums[0].file}")
    assert [r.country for r in same(spark, settings)] == [sums[1].countries[0].country]
    assert rollup.revenue_by_month(spark, settings).count() == 1


def test_catalog_learns_touched_months_alone(spark, settings, bronze_rows):
    name = f"silver_{uuid.uuid4().hex}"
    path = settings.layer("silver")
    tables.create_silver_table(spark, name, path)
    try:
        for day, known in ((MAY, ["order_year=2020/order_month=5"]), (JUNE, [f"order_year=2020/order_month={m}" for m in (5, 6)])):
            batch = curate(bronze_rows({"order_date": day, "ship_date": date(2020, 7, 1), "kafka_offset": day.month}))
            merge_into(batch, path)
            assert tables.add_months(spark, name, batch) == 1
            assert [r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == known
        assert spark.table(name).count() == 2
        told = spark.sql(f"DESCRIBE EXTENDED {name} PARTITION (order_year = 2020, order_month = 6)").collect()
        assert any(r.col_name == "Partition Statistics" and "bytes" in r.data_type for r in told)
        assert tables.add_months(spark, name, batch.where("false")) == 0
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_a_batch_is_logged_once(spark, tmp_path):
    from samples import STAMP

    path = str(tmp_path / "runs")
    assert tables.read_runs(spark, path).count() == 0
    counts = {"started_at": STAMP, "received": 5, "written": 3, "skipped": 1, "rejected": 1}
    tables.note_run(spark, path, "silver", "batch-1", counts)
    tables.note_run(spark, path, "silver", "batch-1", {**counts, "written": 0, "skipped": 4})
    tables.note_run(spark, path, "silver", "batch-2", counts)
    rows = tables.read_runs(spark, path).collect()
    assert sorted((r.batch, r.received, r.written, r.skipped, r.rejected) for r in rows) == [
        ("batch-1", 5, 3, 1, 1), ("batch-2", 5, 3, 1, 1),
    ]
