"""What jobs and queries leave on disk, or carry through shuffles, that they need not."""

import datetime as dt
import gzip
import os
import time
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace import staging
from millrace.operators import merge
from millrace.operators.curate import curate
from millrace.plans import jobs, queries
from millrace.schemas import KEY
from millrace.sources import archive, star, topic
from millrace.sources.tables import append_silver, read_bronze_ndjson, write_bronze_ndjson

LATER = dt.datetime(2022, 1, 1, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def star_dir(spark, tmp_path_factory):
    """400 line items of 100 orders, of which every second ships too early."""
    path = str(tmp_path_factory.mktemp("star"))
    n = lambda name, k: (F.col("id") % k).alias(name)
    day = F.to_timestamp(F.lit("1998-05-01")) + F.make_dt_interval((F.col("id") % 90).cast("int"))
    shipped = F.to_timestamp(F.lit("1998-04-01")) + F.make_dt_interval((F.col("id") % 2 * 200).cast("int"))
    tables = {
        "region": spark.range(2).select(n("r_regionkey", 9), F.concat(F.lit("R"), "id").alias("r_name")),
        "nation": spark.range(4).select(n("n_nationkey", 9), F.concat(F.lit("N"), "id").alias("n_name"), n("n_regionkey", 2)),
        "customer": spark.range(10).select(n("c_custkey", 99), n("c_nationkey", 4)),
        "part": spark.range(10).select(n("p_partkey", 99), F.concat(F.lit("T"), "id").alias("p_type")),
        "orders": spark.range(100).select(
            n("o_orderkey", 999), n("o_custkey", 10), day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")
        ),
        "lineitem": spark.range(0, 400, 1, 1).select(
            F.expr("id div 4").alias("l_orderkey"), n("l_partkey", 10), n("l_suppkey", 3), (F.col("id") % 4).cast("int").alias("l_linenumber"),
            F.lit(2.0).alias("l_quantity"), (F.col("id") + 10.5).alias("l_extendedprice"), F.lit(0.05).alias("l_discount"),
            F.lit(0.02).alias("l_tax"), F.lit("O").alias("l_linestatus"), shipped.alias("l_shipdate"),
        ),
    }
    for name, rows in tables.items():
        rows.coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return path


def new_folders(spark, run):
    """The names of folders that a run leaves in the one of this application."""
    staging.stage(spark.range(1), "probe")
    path = f"{staging.shared_dir(spark)}/millrace/{spark.sparkContext.applicationId}".removeprefix("file://")
    before = set(os.listdir(path))
    run()
    return {x.rsplit("-", 1)[0] for x in set(os.listdir(path)) - before}


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for k in range(files.size()) if (name := files.apply(k).getName()).startswith("shuffle_")}


def settled(spark, before):
    for _ in range(50):
        if not shuffle_files(spark) - before:
            return True
        time.sleep(0.1)
    return False


def test_lean_writes_leave_no_shuffle_files(spark, bronze_rows, tmp_path):
    key, before = staging._SHUFFLE_CLEANUP, shuffle_files(spark)
    own = spark.conf.get(key, None)
    staged = staging.stage_lean(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "lean")
    silver = curate(bronze_rows(*[{"kafka_offset": n} for n in range(20)])).drop("reject_class", "source_file")
    append_silver(silver, str(tmp_path / "silver"))
    assert settled(spark, before)
    assert staged.agg(F.sum("count")).first()[0] == 1000
    assert spark.conf.get(key, None) == own


def test_a_topic_is_packed_and_what_led_to_it_goes(spark, star_dir):
    assert new_folders(spark, lambda: queries.topic_path(spark, star_dir)) == {"topic"}
    path = queries.topic_path(spark, star_dir).removeprefix("file://")
    assert all(f.endswith(".zstd.parquet") for f in os.listdir(path) if f.startswith("part-"))
    assert queries.topic(spark, star_dir).count() == 200


def test_line_items_are_dealt_for_two_joins(spark, star_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = star.sales_text(spark, star_dir)
        plan = rows._jdf.queryExecution().sparkPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    at = [k for k, line in enumerate(plan) if "SortMergeJoin" in line]
    below = [[x for x in plan[k + 1 :] if depth(x) > depth(plan[k])][: next((i for i, x in enumerate(plan[k + 1 :]) if depth(x) <= depth(plan[k])), None)] for k in at]
    assert len(at) == 5 and sum(any("l_orderkey" in x and "Scan" in x for x in own) for own in below) == 2
    assert rows.count() == 400


@pytest.mark.parametrize("name, gone", [("stream_poison", "poisoned"), ("stream_run_log", "poisoned"), ("merge_scattered", "batch")])
def test_a_query_keeps_no_further_copy_of_a_layer(spark, star_dir, name, gone):
    assert gone not in new_folders(spark, lambda: queries.QUERIES[name](spark, star_dir).collect())


def test_read_order_ranks_positions_alone(spark, star_dir, monkeypatch):
    staged = []
    queries.bronze(spark, star_dir)
    monkeypatch.setattr(topic, "stage_lean", lambda df, name: staged.append(df.columns) or staging.stage_lean(df, name))
    rows = queries.offset_read_order(spark, star_dir).collect()
    assert sorted(r.read_rank for r in rows) == list(range(200))
    assert staged == [["kafka_topic", "kafka_partition", "kafka_offset", "_all", "_slot"]]


def test_only_damaged_messages_are_looked_up(spark, star_dir, monkeypatch):
    class Stop(Exception):
        pass

    def caught(spark, settings, mend, **_):
        held = queries.topic(spark, star_dir).withColumn("source_file", F.lit("f"))
        rows = mend(held.withColumn("value", F.lit("bad")))
        assert {r.offset % 11 == 0 or r.offset % 13 == 0 for r in rows.where("offset in (0, 22, 26)").collect()} == {True}
        assert rows.where("offset in (2, 4, 8)").count() == 0
        raise Stop

    monkeypatch.setattr(jobs, "redrive", caught)
    with pytest.raises(Stop):
        queries.redrive_rejects(spark, star_dir)


def rows_of(spark, bronze_rows, offsets):
    changes = [{"kafka_offset": n, "order_id": k, "ingested_at": LATER if k % 2 else LATER - dt.timedelta(days=k + 1)} for k, n in enumerate(offsets)]
    return staging.stage(curate(bronze_rows(*changes)), "rows")


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


@pytest.mark.parametrize("offsets", [range(40), [*range(40), 3], [*range(40), *range(40), 5], []])
def test_first_of_staged_rows(spark, bronze_rows, offsets):
    batch = rows_of(spark, bronze_rows, list(offsets))
    got = merge.first_of_staged(batch, len(list(offsets)))
    assert got.columns == batch.columns
    wanted = merge.first_wins(batch)
    assert got.exceptAll(wanted).count() == wanted.exceptAll(got).count() == 0


def test_rows_of_unique_keys_are_not_shuffled_to_find_that(spark, bronze_rows):
    batch = rows_of(spark, bronze_rows, list(range(40)))
    stored = spark.createDataFrame([("sales-events-0-99",)], f"{KEY} string")
    assert exchanges(merge.first_of_staged(batch, 40)) == 0
    assert exchanges(merge.inserts(batch, stored, 40)) == 0
    held = spark.createDataFrame([("sales-events-0-3",)], f"{KEY} string")
    assert merge.inserts(batch, held, 40).count() == 39


def test_ndjson_is_packed(spark, bronze_rows, tmp_path):
    path = tmp_path / "nd"
    write_bronze_ndjson(bronze_rows(*[{"kafka_offset": n} for n in range(3)]), str(path), "batch-0")
    files = [f for f in (path / "batch-0").iterdir() if f.name.startswith("part-")]
    assert files and all(f.name.endswith(".json.gz") for f in files)
    text = next(t for f in files if (t := gzip.decompress(f.read_bytes())))
    (path / "plain.json").write_bytes(text.replace(b'"kafka_offset":', b'"kafka_offset":1'))
    (path / "other.txt.gz").write_bytes(gzip.compress(b"not json"))
    assert read_bronze_ndjson(spark, str(path), "*.json").count() == 3 + text.count(b"\n")


def test_small_members_land_packed_and_large_ones_plain(tmp_path, monkeypatch):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as out:
        out.writestr("m.csv", "a\n" * 100)
    batch = pd.DataFrame({"archive": [str(tmp_path / "a.zip")], "member": ["m.csv"], "version": ["v"]})
    extract = archive._extract_batches(str(tmp_path / "out"))
    landed = lambda: [f.name for f in (tmp_path / "out" / "v").iterdir()]
    file = next(iter(extract(iter([batch]))))["file"][0]
    assert file.endswith(".csv.gz") and landed() == [file.removeprefix("v/")]
    assert gzip.decompress((tmp_path / "out" / file).read_bytes()) == b"a\n" * 100
    monkeypatch.setattr(archive, "PACKED", 10)
    file = next(iter(extract(iter([batch]))))["file"][0]
    assert file.endswith(".csv") and landed() == [file.removeprefix("v/")]
