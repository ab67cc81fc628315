"""Compaction: the same rows in fewer files, whatever step a crash comes at."""

from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.operators.curate import curate
from millrace.operators.merge import merge_into
from millrace.plans import compact
from millrace.schemas import KEY
from millrace.sources import tables

FOLDER = "order_year=2020/order_month=5"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 99), max_size=40))
def test_groups_are_whole_and_well_filled(sizes):
    named = [(f"f{k}", size) for k, size in enumerate(sizes)]
    groups = compact.best_fit(named, 100)
    assert sorted(x for group in groups for x in group) == sorted(name for name, _ in named)
    fills = [sum(dict(named)[x] for x in group) for group in groups]
    assert all(x <= 100 for x in fills) and sum(x <= 50 for x in fills) <= 1


@pytest.fixture
def silver(spark, bronze_rows, tmp_path):
    """Six loads of May, the last one also of June."""
    path = str(tmp_path / "silver")
    for n in range(6):
        rows = [{"kafka_offset": 6 * k + n, "order_date": date(2020, 5, 3), "ship_date": date(2020, 7, 1)} for k in range(20)]
        rows += [{"kafka_offset": 900, "order_date": date(2020, 6, 3), "ship_date": date(2020, 7, 1)}] * (n == 5)
        merge_into(curate(bronze_rows(*rows)), path)
    return path


def rows_in(spark, path):
    return sorted(map(tuple, tables.read_silver(spark, path).collect()), key=repr)


def test_the_same_rows_in_one_file(spark, silver):
    before = rows_in(spark, silver)
    assert len(compact._listed(spark, f"{silver}/{FOLDER}")) == 6
    assert compact.compact(spark, silver) == 5
    assert len(compact._listed(spark, f"{silver}/{FOLDER}")) == 1
    assert rows_in(spark, silver) == before and len(before) == 121
    keys = [r[0] for r in spark.read.parquet(f"{silver}/{FOLDER}").select(KEY).collect()]
    assert keys == sorted(keys)
    assert compact.compact(spark, silver) == 0
    assert compact.compact(spark, f"{silver}-none") == 0


def test_large_files_stay(spark, silver):
    sizes = dict(compact._listed(spark, f"{silver}/{FOLDER}"))
    assert compact.compact(spark, silver, [(2020, 5)], min(sizes.values())) == 0
    target = int(2.5 * max(sizes.values()))
    assert compact.compact(spark, silver, [(2020, 5)], target) == 3
    assert not set(sizes) & {x for x, _ in compact._listed(spark, f"{silver}/{FOLDER}")}


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["plan", "swap", "delete"])
def test_a_crash_loses_nothing(spark, silver, monkeypatch, step):
    before = rows_in(spark, silver)
    real, calls = compact.settle, []

    def crash(*_):
        calls.append(1)
        if len(calls) == 2:
            raise Crash
        return real(*_)

    monkeypatch.setattr(compact, "settle", crash)
    with pytest.raises(Crash):
        compact.compact(spark, silver)
    monkeypatch.undo()
    assert rows_in(spark, silver) == before
    files, work = compact._files(spark, f"{silver}/_compact")
    run = files.listStatus(work)[0].getPath().toString()
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if step == "plan":
        # The plan was not whole: all is as it was.
        files.delete(make(f"{run}/plan/_SUCCESS"), False)
        compact.settle(spark, silver)
        assert len(compact._listed(spark, f"{silver}/{FOLDER}")) == 6
    else:
        name = compact._listed(spark, f"{run}/rows/bin=0")[0][0]
        files.rename(make(f"{run}/rows/bin=0/{name}"), make(f"{silver}/{FOLDER}/bin0-{name}"))
        if step == "delete":
            old = next(x for x, _ in compact._listed(spark, f"{silver}/{FOLDER}") if x != f"bin0-{name}")
            files.delete(make(f"{silver}/{FOLDER}/{old}"), False)
        compact.settle(spark, silver)
        assert len(compact._listed(spark, f"{silver}/{FOLDER}")) == 1
    assert rows_in(spark, silver) == before
    assert len(files.listStatus(work)) == 0
