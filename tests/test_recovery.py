"""Replays of chosen offsets, re-driven rejects, and files that need not be read again."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.operators import manifest, messages
from millrace.plans import jobs
from millrace.settings import Settings
from millrace.sources import archive, tables
from samples import STAMP

HEADER = (
    "Order ID,Region,Country,Item Type,Sales Channel,Order Priority,Order Date,Ship Date,Units Sold,Unit Price,"
    "Unit Cost,Total Revenue,Total Cost,Total Profit"
)


@pytest.fixture
def settings(tmp_path):
    return Settings(root=f"file://{tmp_path}/data", kafka_consumer_timeout_ms=1)


@pytest.fixture
def topic_rows(bronze_rows):
    """Messages of partition 0 at offsets 0 to n - 1; some of them broken."""

    def make(n, broken=()):
        rows = messages.encode(bronze_rows(*[{"kafka_offset": k, "order_id": k} for k in range(n)])).select(
            "key", "value", F.col("kafka_topic").alias("topic"), F.col("kafka_partition").alias("partition"),
            F.col("kafka_offset").alias("offset"), F.lit(STAMP).cast("timestamp").alias("timestamp"),
        )
        return rows.withColumn("value", F.when(F.col("offset").isin(list(broken)), "{broken").otherwise(F.col("value")))

    return make


def silver_offsets(spark, settings):
    return sorted(int(r[0].rsplit("-", 1)[1]) for r in tables.read_silver(spark, settings.layer("silver")).select("source_kafka_offset").collect())


def test_replays_of_overlapping_ranges(spark, settings, topic_rows):
    tables.append_topic(topic_rows(40, broken=[7]), settings.layer("topic"))
    first = jobs.replay(spark, settings, [jobs.OffsetRange(0, 5, 14)], ingested_at=STAMP)
    assert (first.received, first.written) == (9, 9)
    more = jobs.replay(spark, settings, [jobs.OffsetRange(0, 10, 19), jobs.OffsetRange(0, 12, 16)], ingested_at=STAMP)
    assert (more.received, more.written) == (10, 5)
    bronze = tables.read_bronze(spark, settings.layer("bronze")).count()
    again = jobs.replay(spark, settings, [jobs.OffsetRange(0, 5, 14)], ingested_at=STAMP)
    assert again.written == 0 and tables.read_bronze(spark, settings.layer("bronze")).count() == bronze
    assert jobs.replay(spark, settings, [jobs.OffsetRange(0, 0, 99)], source="bronze").written == 0
    assert jobs.replay(spark, settings, [jobs.OffsetRange(3, 0, 9)]).received == 0
    assert silver_offsets(spark, settings) == [k for k in range(5, 20) if k != 7]
    with pytest.raises(ValueError):
        jobs.replay(spark, settings, [], source="silver")


def test_replays_prune_the_scan(spark, settings, topic_rows):
    rows = topic_rows(40)
    for k in range(4):
        tables.append_topic(rows.where(F.col("offset") % 4 == k).coalesce(1), settings.layer("topic"))
        tables.append_topic(rows.where(F.col("offset").between(1_000 * k, 1_000 * k + 9)).coalesce(1), settings.layer("topic"))
    read = tables.read_topic(spark, settings.layer("topic")).where(jobs.in_ranges([jobs.OffsetRange(0, 900, 950)]))
    plan = read._jdf.queryExecution().executedPlan()
    pushed = [x for x in plan.toString().splitlines() if "PushedFilters" in x]
    assert "GreaterThanOrEqual(offset,900)" in pushed[0] and "EqualTo(partition,0)" in pushed[0]
    assert read.count() == 0


def test_rejects_are_driven_again(spark, settings, topic_rows):
    clean = topic_rows(12)
    for _ in range(2):
        jobs.load_bronze(spark, settings, topic_rows(12, broken=[2, 3, 9]), ingested_at=STAMP)
    jobs.load_silver(spark, settings)
    aside = lambda: tables.read_quarantine(spark, settings.layer("quarantine"), "topic")
    assert jobs.open_rejects(spark, settings).count() == 3
    good = clean.select("offset", "value")

    def mend(rows):
        return rows.drop("value").where("offset <> 9").join(good, "offset")

    assert jobs.redrive(spark, settings, ingested_at=STAMP) == jobs.RedriveCounts(3, 0)
    first = jobs.redrive(spark, settings, mend, ingested_at=STAMP)
    assert (first.opened, first.stored, first.left) == (3, 2, 1)
    assert [(r.kafka_offset, r.reject_class) for r in aside().collect()] == [(9, "MALFORMED_JSON")]
    assert jobs.redrive(spark, settings, mend, ingested_at=STAMP) == jobs.RedriveCounts(1, 0)
    assert silver_offsets(spark, settings) == [k for k in range(12) if k != 9]
    # A scan of the whole topic sets the bad messages aside again; those stored are not open.
    jobs.load_bronze(spark, settings, topic_rows(12, broken=[2, 3, 9]), ingested_at=STAMP)
    assert [r.kafka_offset for r in jobs.open_rejects(spark, settings).collect()] == [9]
    assert jobs.redrive(spark, settings, lambda x: x.drop("value").join(good, "offset"), ingested_at=STAMP).stored == 1
    assert silver_offsets(spark, settings) == list(range(12)) and aside().count() == 0


def test_a_crash_before_the_quarantine_is_rewritten_stores_nothing_twice(spark, settings, topic_rows, monkeypatch):
    jobs.load_bronze(spark, settings, topic_rows(6, broken=[1, 4]), ingested_at=STAMP)
    jobs.load_silver(spark, settings)
    good = topic_rows(6).select("offset", "value")
    mend = lambda x: x.drop("value").where("offset = 1").join(good, "offset")
    with monkeypatch.context() as broken:
        broken.setattr(jobs, "drop_quarantine", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.redrive(spark, settings, mend, ingested_at=STAMP)
    bronze = tables.read_bronze(spark, settings.layer("bronze")).count()
    assert bronze == 5 and silver_offsets(spark, settings) == [0, 1, 2, 3, 5]
    assert jobs.redrive(spark, settings, mend, ingested_at=STAMP) == jobs.RedriveCounts(1, 0)
    assert tables.read_bronze(spark, settings.layer("bronze")).count() == bronze
    assert [r.kafka_offset for r in tables.read_quarantine(spark, settings.layer("quarantine"), "topic").collect()] == [4]


def put_archive(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with zipfile.ZipFile(f"{folder}/{name}", "w") as opened:
        opened.writestr("rows.csv", f"{HEADER}\n{text}\n")


ROW = "1,Europe,France,Snacks,Online,H,1/3/2010,2/9/2010,250,9.99,5.50,2497.50,1375.00,1122.50"


def test_unchanged_archives_are_not_opened(spark, settings, tmp_path):
    folder = settings.layer("archive").removeprefix("file://")
    for k in range(4):
        put_archive(folder, f"{k}.zip", ROW)

    def cycle(at):
        opened = spark.sparkContext.accumulator(0)
        done = jobs.extract(spark, settings, at=STAMP.replace(day=at), opened=opened)
        jobs.publish_waiting(spark, settings)
        return opened.value, done.written

    assert cycle(1) == (4, 4)
    assert cycle(2) == (0, 0)
    # One has other content, one is only touched, one is new.
    put_archive(folder, "1.zip", ROW.replace("Snacks", "Cereal"))
    os.utime(f"{folder}/2.zip", (1_700_000_000, 1_700_000_000))
    put_archive(folder, "9.zip", ROW)
    assert cycle(3) == (3, 2)
    assert cycle(4) == (0, 0)
    assert tables.read_topic(spark, settings.layer("topic")).count() == 6


def test_a_version_that_was_not_published_is_new_whatever_its_content(spark):
    known = spark.createDataFrame(
        [("a", "e", 1, "m", STAMP, manifest.EXTRACTED), ("b", "e", 1, "m", STAMP, manifest.PRODUCED)],
        "url string, etag string, content_length long, checksum_md5 string, downloaded_at timestamp, status string",
    )
    files = spark.createDataFrame([("a", "m"), ("b", "m"), ("c", "m")], "url string, checksum_md5 string").withColumn("is_new", F.lit(True))
    found = {r.url: r.is_new for r in manifest.confirm_changes(files, known).collect()}
    assert found == {"a": True, "b": False, "c": True}


def test_etags_come_from_the_listing(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one")
    (tmp_path / "b.txt").write_text("")
    facts = {os.path.basename(r.url): r for r in archive.file_facts(spark, f"file://{tmp_path}", "*.txt").collect()}
    assert facts["a.txt"].content_length == 3 and facts["a.txt"].etag.endswith("-3")
    assert facts["b.txt"].content_length == 0
