import random

import pytest

from millrace.operators import gaps

SCHEMA = "topic string, partition int, offset long"


def brute(rows, bounds=None):
    held = {}
    for t, p, o in rows:
        if None not in (t, p, o):
            held.setdefault((t, p), set()).add(o)
    ends = bounds or {k: (min(v), max(v)) for k, v in held.items()}
    out = []
    for key, (first, last) in ends.items():
        start = None
        for o in range(first, last + 2):
            lost = o <= last and o not in held.get(key, ())
            if lost and start is None:
                start = o
            if not lost and start is not None:
                out.append((*key, start, o - 1))
                start = None
    return sorted(out)


@pytest.fixture
def positions(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA).repartition(3)


def corpus():
    rng = random.Random(4)
    rows = [("a-b", p, o) for p in range(2) for o in range(100_000) if rng.random() < 0.999 and not 40_000 <= o < 75_000]
    rows += [("a-b", 0, 32_767), ("a-b", 0, 32_768), ("x", 7, 65_536), ("x", 7, 65_536), ("y", 1, 5)]
    return rows + [(None, 1, 1), ("x", None, 3), ("x", 7, None)]


def test_ranges_against_brute_force(positions):
    rows = corpus()
    assert sorted(map(tuple, gaps.missing_ranges(positions(rows)).collect())) == brute(rows)


def test_ranges_within_bounds(spark, positions):
    rows = corpus()
    bounds = {("a-b", 0): (0, 120_000), ("a-b", 1): (50, 60), ("x", 7): (65_530, 65_536), ("y", 1): (0, 5), ("z", 3): (4, 9), ("z", 4): (0, -1)}
    table = spark.createDataFrame([(*k, *v) for k, v in bounds.items()], "topic string, partition int, first long, last long")
    assert sorted(map(tuple, gaps.missing_ranges(positions(rows), table).collect())) == brute(rows, bounds)


def test_nothing_there(spark, positions):
    assert gaps.missing_ranges(positions([])).count() == 0
    bounds = spark.createDataFrame([("a", 0, 3, 5)], "topic string, partition int, first long, last long")
    assert [tuple(r) for r in gaps.missing_ranges(positions([]), bounds).collect()] == [("a", 0, 3, 5)]


def test_report_counts_copies(positions):
    report = gaps.range_report(whole=positions([("t", 0, k) for k in (3, 4, 5)]), torn=positions([("t", 0, 3), ("t", 0, 3), ("t", 0, 5)]))
    assert {tuple(r) for r in report.collect()} == {("whole", "t", 0, 3, 3, 0, 3, 5, True), ("torn", "t", 0, 3, 2, 1, 3, 5, False)}


def test_positions_of_silver_keys(spark):
    keys = spark.createDataFrame([("sales-events-2-17",), ("a-0-0",)], "source_kafka_offset string")
    assert [tuple(r) for r in gaps.silver_positions(keys).collect()] == [("sales-events", 2, 17), ("a", 0, 0)]


def test_rows_are_bitmaps_before_they_are_shuffled(positions):
    plan = gaps.missing_ranges(positions([("t", 0, 1)]))._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan and "Join" not in plan
