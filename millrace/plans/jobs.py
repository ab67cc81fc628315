"""The jobs a deployment runs, each from one layer's folder to the next."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from typing import NamedTuple

from pyspark import Accumulator
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators.curate import curate
from millrace.operators.manifest import (
    as_extracted,
    as_produced,
    as_touched,
    confirm_changes,
    detect_changes,
    to_publish,
)
from millrace.operators.merge import MergeCounts, merge_staged, stage_counted
from millrace.operators.messages import encode, judge_topic
from millrace.operators.validate import (
    judge_landing,
    rejected,
    require_strict,
    unreadable,
    valid,
)
from millrace.schemas import KEY, TOPIC
from millrace.settings import Settings
from millrace.sources.archive import extract_members, file_facts, with_checksums
from millrace.sources.landing import SEQUENCE, cap_rows, read_landing
from millrace.sources.tables import (
    add_months,
    append_bronze,
    append_manifest,
    append_quarantine,
    append_topic,
    drop_quarantine,
    quarantine_folders,
    read_bronze,
    read_manifest,
    read_quarantine,
    read_topic,
    replace_batch,
    replace_quarantine,
)
from millrace.sources.topic import assign_positions, next_offsets
from millrace.staging import stage, stage_lean, staging


@dataclass(frozen=True)
class RunCounts:
    written: int
    skipped: int


def changed_files(facts: DataFrame, known: DataFrame, opened: Accumulator | None = None) -> DataFrame:
    """The files of ``facts`` (url, etag, content_length) that may have changed since the
    manifest ``known``, with their checksums and whether they are new by content. No other
    file is opened."""
    suspects = stage(detect_changes(facts, known).where("is_new"), "suspects")
    return confirm_changes(with_checksums(suspects, "url", opened), known)


def extract(
    spark: SparkSession,
    settings: Settings,
    *,
    glob: str = "*.zip",
    at: datetime | None = None,
    opened: Accumulator | None = None,
) -> RunCounts:
    """Unpack the archives whose version the manifest does not hold as published.

    What has changed is found in two steps: by the listing, which opens no file, and by content
    for those that the listing leaves in doubt. Each version gets a landing folder of its own
    and is noted as extracted once all its members have landed. An archive with an unreadable
    member, or none at all, is set aside and stays new, so the next cycle tries it again.
    ``opened`` counts the archives hashed.
    """
    stamp = at or datetime.now(timezone.utc)
    with staging(spark):
        known = read_manifest(spark, settings.layer("state"))
        current = stage(changed_files(file_facts(spark, settings.layer("archive"), glob), known, opened), "archives")
        fresh = current.where("is_new").drop("is_new")
        append_manifest(as_touched(current.where("not is_new"), stamp), settings.layer("state"))
        members = stage(extract_members(fresh, settings.layer("landing")), "members")
        broken = members.where("error is not null").select(F.col("archive").alias("url")).distinct()
        skipped = _quarantine(unreadable(members), settings.layer("quarantine"), "archive")
        done = stage(fresh.join(broken, "url", "left_anti"), "extracted")
        append_manifest(as_extracted(done, stamp), settings.layer("state"))
        return RunCounts(done.count(), skipped)


def publish_waiting(
    spark: SparkSession, settings: Settings, *, multiline: bool = False, on_error: str = "quarantine"
) -> RunCounts:
    """Publish the landing folders of versions that are extracted and not yet produced, then
    note them as produced. Without any, nothing is read or written.

    What comes to the driver is a folder per version that waits, which is what arrived
    since the last cycle.
    """
    with staging(spark):
        waiting = stage(to_publish(read_manifest(spark, settings.layer("state"))), "waiting")
        folders = [f"{settings.layer('landing')}/{r.checksum_md5}" for r in waiting.select("checksum_md5").distinct().collect()]
        if not folders:
            return RunCounts(0, 0)
        counts = publish(spark, settings, path=sorted(folders), multiline=multiline, on_error=on_error)
        append_manifest(as_produced(waiting), settings.layer("state"))
        return counts


def ingest_cycle(
    spark: SparkSession, settings: Settings, *, at: datetime | None = None, ingested_at: datetime | None = None
) -> MergeCounts:
    """Archives to silver, once. A cycle that finds nothing new adds nothing anywhere."""
    extract(spark, settings, at=at)
    if publish_waiting(spark, settings).written == 0:
        return MergeCounts(0, 0)
    load_bronze(spark, settings, ingested_at=ingested_at)
    return load_silver(spark, settings)


def _quarantine(rejects: DataFrame, path: str, entry: str) -> int:
    seen = Observation(entry)
    append_quarantine(
        rejects.withColumn("entry", F.lit(entry)).observe(seen, F.count(F.lit(1)).alias("n")),
        f"{path}/{entry}",
    )
    return seen.get["n"]


def publish(
    spark: SparkSession,
    settings: Settings,
    *,
    path: str | list[str] | None = None,
    multiline: bool = False,
    on_error: str = "quarantine",
) -> RunCounts:
    """Landing CSV to the file-backed topic.

    The text is parsed and judged once; numbering, quarantine and counts read the
    staged result. ``on_error="strict"`` stops on the classes that halt a run. Rejects are
    written first: a crash between the two writes loses neither, and a retry sets aside
    the same rows again rather than sending any twice.
    """
    raw = read_landing(spark, path or settings.layer("landing"), multiline=multiline)
    capped = cap_rows(raw, settings.max_rows)
    with staging(spark):
        judged = stage_lean(judge_landing(capped, keep=SEQUENCE), "judged")
        if on_error == "strict":
            require_strict(judged)
        skipped = _quarantine(rejected(judged), settings.layer("quarantine"), "landing")
        sent = publish_rows(spark, settings, valid(judged), SEQUENCE)
    return RunCounts(sent, skipped)


def publish_rows(
    spark: SparkSession, settings: Settings, sales: DataFrame, order_by: list
) -> int:
    """Append typed records to the file-backed topic, after the messages it holds."""
    numbered = assign_positions(
        sales,
        order_by,
        topic=settings.kafka_topic,
        partitions=settings.kafka_num_partitions,
        start=next_offsets(read_topic(spark, settings.layer("topic"))),
    )
    seen = Observation("publish")
    messages = encode(numbered).withColumn("timestamp", F.current_timestamp())
    append_topic(
        messages.select(*TOPIC.fieldNames()).observe(seen, F.count(F.lit(1)).alias("n")),
        settings.layer("topic"),
    )
    return seen.get["n"]


def load_bronze(
    spark: SparkSession,
    settings: Settings,
    messages: DataFrame | None = None,
    *,
    ingested_at: datetime | None = None,
    on_error: str = "quarantine",
) -> RunCounts:
    """All messages of the topic to bronze in one batch. The streaming form keeps its
    place and is what a running deployment uses.

    Messages are decoded and judged once. ``on_error="strict"`` stops on the classes that
    halt a run before anything is written.
    """
    if messages is None:
        messages = read_topic(spark, settings.layer("topic"))
    stamp = ingested_at or datetime.now(timezone.utc)
    with staging(spark):
        rows, counts = stage_counted(judge_topic(messages, settings.landing_file, stamp), "judged-topic")
        if on_error == "strict":
            require_strict(rows)
        if counts["rejected"]:
            replace_quarantine(rejected(rows), settings.layer("quarantine"), "topic", "rescan")
        append_bronze(valid(rows), settings.layer("bronze"))
    return RunCounts(counts["received"] - counts["rejected"], counts["rejected"])


def load_silver(
    spark: SparkSession,
    settings: Settings,
    bronze: DataFrame | None = None,
    *,
    strict: bool = False,
    transformed_at: datetime | None = None,
    table: str | None = None,
) -> MergeCounts:
    """All of bronze, curated and merged into silver; ``table`` names it in the catalog."""
    if bronze is None:
        bronze = read_bronze(spark, settings.layer("bronze"))
    return merge_curated(settings, curate(bronze, transformed_at), "rescan", strict=strict, table=table)


def merge_curated(
    settings: Settings, curated: DataFrame, name: str, *, strict: bool = False, table: str | None = None
) -> MergeCounts:
    """Merge what fits silver, after setting aside what does not. Rows received are those
    written, those held already, and those rejected. The rejects of ``name`` replace those
    of an earlier run of the same name. The catalog's ``table`` is told of the months it has."""
    with staging(curated.sparkSession):
        rows, counts = stage_counted(curated, "curated")
        if counts["rejected"]:
            bad = rows.where("reject_class is not null").select(KEY, "order_id", "reject_class", "source_file")
            replace_quarantine(bad, settings.layer("quarantine"), "silver", name)
        merged = merge_staged(rows, counts, settings.layer("silver"), strict=strict)
        if table:
            add_months(rows.sparkSession, table, rows.where("reject_class is null"))
        return merged


# ------------------------------------------------------------------ replay and re-drive


class OffsetRange(NamedTuple):
    """Offsets ``first`` to ``last`` of a topic partition, both included."""

    partition: int
    first: int
    last: int


def in_ranges(ranges: Iterable[OffsetRange], partition: str = "partition", offset: str = "offset") -> Column:
    """Whether a row's position is in one of the ranges: plain comparisons, which the scan
    checks against the statistics of files, row groups and pages."""
    tests = [(F.col(partition) == r.partition) & F.col(offset).between(r.first, r.last) for r in ranges]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _digest(*parts: object) -> str:
    return hashlib.md5(repr(parts).encode()).hexdigest()


def replay(
    spark: SparkSession,
    settings: Settings,
    ranges: Iterable[OffsetRange],
    *,
    source: str = "topic",
    messages: DataFrame | None = None,
    ingested_at: datetime | None = None,
    transformed_at: datetime | None = None,
) -> MergeCounts:
    """Send chosen offsets through the same judge and merge once more.

    From the ``topic`` (or any ``messages``) they are decoded, judged and stored in bronze, in a
    folder that the ranges name; from ``bronze`` the stored rows are taken. Only the ranges
    are read. Silver gets what it lacks: a replay of what it holds, whole or in part,
    adds nothing.
    """
    ranges = sorted(set(map(tuple, ranges)))
    chosen = [OffsetRange(*r) for r in ranges]
    name = f"replay-{_digest(ranges)}"
    stamp = ingested_at or datetime.now(timezone.utc)
    with staging(spark):
        if source == "bronze":
            rows = read_bronze(spark, settings.layer("bronze")).where(in_ranges(chosen, "kafka_partition", "kafka_offset"))
        elif source == "topic":
            topic = messages if messages is not None else read_topic(spark, settings.layer("topic"))
            judged = judge_topic(topic.where(in_ranges(chosen)), settings.landing_file, stamp)
            rows, counts = stage_counted(judged, "replayed")
            if counts["rejected"]:
                replace_quarantine(rejected(rows), settings.layer("quarantine"), "topic", name)
            rows = valid(rows)
            replace_batch(rows, settings.layer("bronze"), name)
        else:
            raise ValueError(f"no layer to replay from: {source}")
        return merge_curated(settings, curate(rows, transformed_at), name)


POSITION = ["kafka_topic", "kafka_partition", "kafka_offset"]


def open_rejects(spark: SparkSession, settings: Settings) -> DataFrame:
    """The rejected messages that bronze still lacks, one row a position."""
    aside = read_quarantine(spark, settings.layer("quarantine"), "topic").dropDuplicates(POSITION)
    stored = read_bronze(spark, settings.layer("bronze")).select(*POSITION)
    return aside.join(stored, POSITION, "left_anti")


@dataclass(frozen=True)
class RedriveCounts:
    """Rejects that were open, of which so many were sent again and stored."""

    opened: int
    stored: int

    @property
    def left(self) -> int:
        return self.opened - self.stored


def redrive(
    spark: SparkSession,
    settings: Settings,
    mend: Callable[[DataFrame], DataFrame] | None = None,
    *,
    ingested_at: datetime | None = None,
    transformed_at: datetime | None = None,
) -> RedriveCounts:
    """Judge the rejected messages again, at their own positions, and store those that pass.

    ``mend`` takes messages (topic, partition, offset, timestamp, value, source_file) and
    returns those to be tried, with their values put right; without it the rules themselves
    have changed. Rows leave quarantine once they are stored, others stay. Rows go to a bronze
    folder that their positions name, and a merge only inserts, so a re-drive that is
    repeated, or begun again after a crash at any step, stores nothing twice.
    """
    stamp = ingested_at or datetime.now(timezone.utc)
    with staging(spark):
        folders = quarantine_folders(spark, settings.layer("quarantine"), "topic")
        aside = stage_lean(open_rejects(spark, settings), "open-rejects")
        messages = aside.select(
            F.col("kafka_topic").alias("topic"),
            F.col("kafka_partition").alias("partition"),
            F.col("kafka_offset").alias("offset"),
            F.timestamp_millis("kafka_timestamp_ms").alias("timestamp"),
            F.col("reject_value").alias("value"),
            "source_file",
        )
        judged = judge_topic(mend(messages) if mend else messages, None, stamp)
        passed = stage_lean(valid(judged).dropDuplicates(POSITION), "passed")
        stored = passed.count()
        if stored:
            hashes = F.sum(F.xxhash64(*POSITION).cast("decimal(38,0)"))
            name = f"redrive-{_digest(stored, passed.agg(hashes).first()[0])}"
            replace_batch(passed, settings.layer("bronze"), name)
            merge_curated(settings, curate(passed, transformed_at), name)
        opened = aside.count()
        left = aside.join(passed.select(*POSITION), POSITION, "left_anti")
        if opened > stored:
            replace_quarantine(left.drop("entry"), settings.layer("quarantine"), "topic", f"left-{uuid.uuid4().hex}")
        # The rest stands in its new folder: what was listed before may go.
        drop_quarantine(spark, folders)
    return RedriveCounts(opened, stored)


def note_extracted(
    spark: SparkSession, settings: Settings, files: DataFrame, at: datetime
) -> None:
    """Record the files (url, etag, content_length, checksum_md5) that are new."""
    known = read_manifest(spark, settings.layer("state"))
    changed = detect_changes(files, known).where("is_new")
    append_manifest(as_extracted(changed, at), settings.layer("state"))


def note_produced(spark: SparkSession, settings: Settings) -> None:
    """Record that everything that had landed is published."""
    known = read_manifest(spark, settings.layer("state"))
    append_manifest(as_produced(known), settings.layer("state"))
