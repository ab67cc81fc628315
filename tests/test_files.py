import datetime as dt
import hashlib
import io
import zipfile

import pandas as pd
import pytest

from millrace import Settings
from millrace.operators import manifest
from millrace.operators.validate import judge_landing, rejected, unreadable, valid
from millrace.plans import jobs
from millrace.schemas import HEADERS, MANIFEST
from millrace.sources.archive import file_manifest, list_members, read_archives
from millrace.sources.tables import read_manifest, read_topic

from samples import STABLE_ROW, STAMP


def csv_text(*ids, headers=HEADERS):
    lines = [",".join(headers)]
    lines += [",".join({**STABLE_ROW, "Order ID": str(i)}[h] for h in headers) for i in ids]
    return "\n".join(lines) + "\n"


def write_zip(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for name, text in members.items():
            out.writestr(name, text)


def test_checksums(spark, tmp_path):
    blobs = {f"f{i}.bin": bytes([i]) * size for i, size in enumerate((0, 10, 5000, 3_000_000))}
    for name, blob in blobs.items():
        (tmp_path / name).write_bytes(blob)
    got = file_manifest(spark, str(tmp_path)).collect()
    assert {r.path.rsplit("/", 1)[1]: (r.length, r.checksum_md5) for r in got} == {
        name: (len(blob), hashlib.md5(blob).hexdigest()) for name, blob in blobs.items()
    }


def test_members_and_records(spark, tmp_path):
    write_zip(
        tmp_path / "a b.zip",
        {"one.csv": csv_text(1, 2), "sub/two.CSV": csv_text(3, headers=HEADERS[::-1]), "note.txt": "x"},
    )
    write_zip(tmp_path / "b.zip", {"../../evil.csv": csv_text(4)})
    members = list_members(spark, str(tmp_path)).collect()
    assert sorted(r.member for r in members) == [
        "../../evil.csv", "note.txt", "one.csv", "sub/two.CSV",
    ]
    raw, report = read_archives(spark, str(tmp_path))
    good = valid(judge_landing(raw))
    assert sorted(r.order_id for r in good.collect()) == [1, 2, 3, 4]
    assert [(r.reject_class, r.member) for r in unreadable(report).collect()] == [("SKIPPED_MEMBER", "note.txt")]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a b.zip", "b.zip"]


def test_more_records_than_a_batch_and_quoted_line_ends(spark, tmp_path):
    text = csv_text(*range(25_000)).replace("Europe", '"two\nlines"', 1)
    write_zip(tmp_path / "big.zip", {"big.csv": text})
    raw, _ = read_archives(spark, str(tmp_path), multiline=True)
    good = valid(judge_landing(raw))
    assert good.count() == 25_000
    assert good.where("order_id = 0").first().region == "two\nlines"


def test_corrupt_archives_are_reject_rows(spark, tmp_path):
    (tmp_path / "broken.zip").write_bytes(b"not a zip")
    (tmp_path / "empty.zip").write_bytes(b"")
    write_zip(tmp_path / "good.zip", {"a.csv": csv_text(1)})
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as out:
        out.writestr("cut.csv", csv_text(*range(5000)))
    blob = bytearray(buffer.getvalue())
    blob[2000:4000] = bytes(2000)
    (tmp_path / "damaged.zip").write_bytes(blob)
    write_zip(tmp_path / "long.zip", {"a.csv": csv_text(2).replace("Europe", "x" * 200_000)})
    rows, report = read_archives(spark, str(tmp_path))
    errors = {
        r.archive.rsplit("/", 1)[1]: r.member
        for r in unreadable(report).where("reject_class = 'UNREADABLE_ARCHIVE'").collect()
    }
    assert errors == {"broken.zip": None, "empty.zip": None, "damaged.zip": "cut.csv"}
    # A member lands whole or not at all.
    good = {r.order_id: len(r.region) for r in valid(judge_landing(rows)).collect()}
    assert good == {1: 6, 2: 200_000}


def test_a_fault_of_the_store_is_no_broken_archive(spark, tmp_path, monkeypatch):
    from millrace.sources import archive

    monkeypatch.setattr(archive, "_open", lambda path: (_ for _ in ()).throw(OSError("gone")))
    batch = pd.DataFrame({"archive": ["a.zip"], "member": ["m.csv"], "version": ["v"]})
    with pytest.raises(OSError, match="gone"):
        list(archive._extract_batches(str(tmp_path))(iter([batch])))


def test_a_member_without_a_column(spark, tmp_path):
    write_zip(tmp_path / "a.zip", {"a.csv": csv_text(1, headers=[h for h in HEADERS if h != "Region"])})
    bad = rejected(judge_landing(read_archives(spark, str(tmp_path))[0])).collect()
    assert [(r.reject_class, r.reject_field) for r in bad] == [("MISSING_COLUMN", "Region")]


# (prior etag, prior length, prior status), (etag, length), is it new
DECISIONS = [
    (None, ("e", 1), True),
    (("e", 1, "extracted"), ("e", 1), True),
    (("e", 1, "produced"), ("e", 2), False),
    (("e", 1, "produced"), ("f", 1), True),
    (("", 1, "produced"), ("f", 1), False),
    (("e", 1, "produced"), ("", 1), False),
    (("e", 1, "produced"), (None, 2), True),
    ((None, 0, "produced"), ("e", 0), False),
    ((None, 0, "produced"), (None, 5), True),
    ((None, None, "produced"), ("e", 5), True),
    (("e", 5, "produced"), (None, None), True),
    ((None, None, "produced"), (None, None), True),
]


def test_change_decisions(spark):
    prior = spark.createDataFrame(
        [(f"u{i}", p[0], p[1], "m", STAMP, p[2]) for i, (p, _, _) in enumerate(DECISIONS) if p],
        MANIFEST,
    )
    current = spark.createDataFrame(
        [(f"u{i}", *c) for i, (_, c, _) in enumerate(DECISIONS)],
        "url string, etag string, content_length bigint",
    )
    got = {r.url: r.is_new for r in manifest.detect_changes(current, prior).collect()}
    assert got == {f"u{i}": new for i, (_, _, new) in enumerate(DECISIONS)}


@pytest.fixture
def files(spark):
    schema = "url string, etag string, content_length bigint, checksum_md5 string"
    return lambda *rows: spark.createDataFrame([(*r, "m") for r in rows], schema)


def test_a_version_moves_from_extracted_to_produced(spark, files, tmp_path):
    settings = Settings(root=str(tmp_path))
    states = lambda: {
        (r.url, r.etag): r.status
        for r in manifest.latest(read_manifest(spark, settings.layer("state"))).collect()
    }
    day = lambda n: STAMP + dt.timedelta(days=n)
    jobs.note_extracted(spark, settings, files(("a", "1", 5), ("b", "1", 5)), day(0))
    assert states() == {("a", "1"): "extracted", ("b", "1"): "extracted"}
    jobs.note_produced(spark, settings)
    assert states() == {("a", "1"): "produced", ("b", "1"): "produced"}
    jobs.note_extracted(spark, settings, files(("a", "1", 5), ("b", "2", 5)), day(1))
    waiting = manifest.to_publish(read_manifest(spark, settings.layer("state"))).collect()
    assert [(r.url, r.etag) for r in waiting] == [("b", "2")]
    jobs.note_produced(spark, settings)
    assert states() == {("a", "1"): "produced", ("b", "2"): "produced"}


def test_cycles_are_gated_by_the_manifest(spark, tmp_path):
    settings = Settings(str(tmp_path / "lake"))
    archives = tmp_path / "lake" / "archive"
    archives.mkdir(parents=True)
    write_zip(archives / "a.zip", {"one.csv": csv_text(1, 2), "two.csv": csv_text(3)})
    (archives / "bad.zip").write_bytes(b"not a zip")
    first = jobs.ingest_cycle(spark, settings)
    assert (first.received, first.written) == (3, 3)
    assert jobs.ingest_cycle(spark, settings).written == 0
    assert read_topic(spark, settings.layer("topic")).count() == 3
    # A new version of an archive is published, others are not published again.
    write_zip(archives / "a.zip", {"one.csv": csv_text(1, 2, 4)})
    write_zip(archives / "bad.zip", {"now good.csv": csv_text(9)})
    jobs.ingest_cycle(spark, settings)
    assert read_topic(spark, settings.layer("topic")).count() == 3 + 3 + 1
    aside = spark.read.parquet(f"{settings.layer('quarantine')}/archive")
    assert {r.reject_class for r in aside.collect()} == {"UNREADABLE_ARCHIVE"}
