"""Which stored keys a merge reads."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import merge
from millrace.operators.curate import curate
from millrace.schemas import KEY
from millrace.sources import tables


def rows_scanned(df):
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


@pytest.fixture
def silver_rows(spark, constant_bronze):
    """Curated rows at the given offsets, dealt over the months of some years, so that every
    file has keys from all over."""

    def make(offsets):
        rows = spark.createDataFrame([(x,) for x in offsets], "kafka_offset long").withColumn(
            "order_date", F.date_add(F.lit("2015-01-01").cast("date"), (F.col("kafka_offset") * 31 % 1_000).cast("int"))
        )
        return curate(constant_bronze(rows.withColumn("ship_date", F.col("order_date"))), F.lit("2021-01-02").cast("timestamp"))

    return make


def test_scattered_keys_skip_row_groups(spark, silver_rows, tmp_path):
    path = f"file://{tmp_path}/silver"
    stored = silver_rows(range(0, 20_000, 2))
    merge.merge_into(stored, path)
    keys = tables.read_silver(spark, path).select(KEY)
    new = silver_rows(range(1, 20_000, 400)).where("reject_class is null")
    assert new.count() == 50
    by_range, by_key = keys.where(merge.near_keys_of(new)), keys.where(merge.keys_of(new))
    # The ranges span all offsets; the filters know that none of the keys is there.
    assert rows_scanned(by_range) == 10_000
    assert rows_scanned(by_key) < 1_000
    one = keys.where(merge.keys_of(silver_rows([4_000])))
    assert one.count() == 1 and rows_scanned(one) < 1_500
    counts = merge.merge_into(new.unionByName(stored.where(F.col(KEY).endswith("00"))), path)
    assert (counts.written, tables.read_silver(spark, path).select(KEY).distinct().count()) == (50, 10_050)


def test_stretches_are_ranges_of_their_own(spark, silver_rows):
    batch = silver_rows([*range(1_000, 1_100), *range(8_000, 8_020), 5])
    keys = spark.range(10_000).select(F.concat(F.lit("sales-events-0-"), "id").alias(KEY))
    held = {int(r[KEY].rsplit("-", 1)[1]) for r in keys.where(merge.near_keys_of(batch)).collect()}
    # Shorter offsets may stand between longer ones; the join leaves them out.
    assert {x for x in held if x >= 1_000} == {*range(1_000, 1_100), *range(8_000, 8_020)} and 5 in held


@pytest.mark.parametrize("lookups", [0, 10_000])
def test_both_ways_give_one_table(spark, silver_rows, tmp_path, monkeypatch, lookups):
    monkeypatch.setattr(merge, "LOOKUPS", lookups)
    rng, path, held = random.Random(1), f"file://{tmp_path}/silver", set()
    for _ in range(3):
        offsets = rng.choices(range(3_000), k=400)
        counts = merge.merge_into(silver_rows(offsets), path)
        assert counts.written == len(set(offsets) - held)
        held |= set(offsets)
    found = [r[KEY] for r in tables.read_silver(spark, path).select(KEY).collect()]
    assert sorted(found) == sorted(f"sales-events-0-{x}" for x in held)
    merge.merge_into(silver_rows([]), path)
    assert tables.read_silver(spark, path).count() == len(held)
