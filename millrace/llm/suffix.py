"""Repeated passages of a fixed length, removed by a run-length compressed index.

A window is ``length`` bytes of one text. Windows with equal bytes have an equal key, the
least hash of the shorter strings in them, so the corpus falls into runs of windows with one
key each. Runs whose key occurs once are done. The others meet by key: runs that are equal
byte for byte repeat as a whole; of those that differ, a suffix array gives the
Burrows-Wheeler transform, and only the ends of its runs are sampled. Streaming over the text
from sample to sample gives each position's matching statistic: the longest string that
starts there and somewhere else as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import raw, slices, tune, whole
from millrace.staging import stage

#: Bytes of the strings whose least hash is a window's key; a power of two.
GRAM = 32
#: Bytes of text that a worker is handed, and those that it hashes at a time: for each byte it
#: holds some twenty words.
BATCH_BYTES, SLICE_BYTES = 2 << 20, 1 << 18
#: Windows a run has at most. Where it is cut has no bearing on the result.
RUN = 256
#: Bytes that one index holds. A key whose runs hold more is resolved by window hashes.
INDEX_BYTES = 1 << 20
#: Bytes that an index of several keys holds. Keys share no window: where they are parted has
#: no bearing on the result, and an index takes some hundred bytes for each of its own.
GATHERED_BYTES = 1 << 18
#: Bits of the filter of repeated keys: eight a key, up to a bound, beyond which more runs
#: pass that occur once. Those change nothing but the work.
FILTER_BITS_A_KEY, FILTER_BITS_MOST = 8, 1 << 27

SEPARATOR = 256


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    h = data.astype(np.uint64) + np.uint64(1)
    span, base = 1, 0x9E3779B97F4A7C15
    while span < GRAM:
        h = h[:-span] * np.uint64(base) + h[span:]
        base = base * base % (1 << 64)
        span *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _sliding(x: np.ndarray, width: int, least=np.minimum) -> np.ndarray:
    """The least, or by another function the greatest, of each ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        x = least(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return least(x[: len(x) - rest], x[rest:]) if rest else x


def _near_twins(grams: np.ndarray, keys: np.ndarray, width: int) -> np.ndarray:
    """Positions of strings that are the least of some window and equal an earlier such one
    close by: only there can a window repeat inside its own run."""
    edge = np.zeros(width - 1, np.uint64)
    least = np.flatnonzero(grams == _sliding(np.concatenate([edge, keys, edge]), width, np.maximum))
    h = grams[least]
    order = np.argsort(h, kind="stable")
    twin = (h[order][1:] == h[order][:-1]) & (least[order][1:] - least[order][:-1] < RUN + width)
    return np.sort(least[order][1:][twin])


def _runs(flat: np.ndarray, offsets: np.ndarray, length: int, twins: bool = False) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, first window in the row, windows, key, first byte in ``flat``) of each run; with
    ``twins``, also whether some window may occur twice inside it."""
    width = length - GRAM + 1
    for first, last in slices(offsets, SLICE_BYTES):
        start, stop = int(offsets[first]), int(offsets[last])
        for at in range(start, max(start + 1, stop - length + 1), SLICE_BYTES):
            # A text beyond a slice goes on with the window after the slice's last one.
            end = min(stop, at + SLICE_BYTES + length - 1)
            if end - at < length:
                continue
            grams = _gram_hashes(flat[at:end])
            keys = _sliding(grams, width)
            close = _near_twins(grams, keys, width) + at if twins else None
            ends = offsets[first + 1 : last + 1]
            begins = offsets[first:last]
            pos = np.arange(at, at + len(keys))
            row = np.searchsorted(ends, pos, "right")
            fits = pos + length <= ends[np.minimum(row, len(ends) - 1)]
            pos, row, keys = pos[fits], row[fits], keys[fits]
            if not len(pos):
                continue
            new = np.append(True, (keys[1:] != keys[:-1]) | (row[1:] != row[:-1]))
            begun = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            new |= (np.arange(len(new)) - begun) % RUN == 0
            heads = np.flatnonzero(new)
            n = np.diff(np.append(heads, len(new)))
            begin = pos[heads]
            out = (row[heads] + first, begin - begins[row[heads]], n, keys[heads].view(np.int64), begin)
            if twins:
                out += (np.searchsorted(close, begin) < np.searchsorted(close, begin + n + width - 1),)
            yield out


def suffix_ranks(text: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 7, 14, 28, ... symbols (each below 512), until
    they all differ. A rank is the number of suffixes that are smaller."""
    n = len(text)
    padded = np.concatenate([text.astype(np.uint64) + np.uint64(1), np.zeros(7, np.uint64)])
    key = np.zeros(n, np.uint64)
    for k in range(7):
        key = (key << np.uint64(9)) | padded[k : k + n]
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    head = np.append(True, sorted_key[1:] != sorted_key[:-1])
    place = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n, np.int32)
    rank[order] = place
    levels, span = [rank], 7
    open_ = order[~(head & np.append(head[1:], True))]
    while len(open_):
        follow = open_ + span
        second = np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        key = rank[open_].astype(np.int64) * (n + 1) + second
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        old = rank[open_]
        index = np.arange(len(open_))
        head = np.append(True, key[1:] != key[:-1])
        group = np.append(True, old[1:] != old[:-1])
        sub = np.maximum.accumulate(np.where(head, index, 0))
        whole_ = np.maximum.accumulate(np.where(group, index, 0))
        rank = rank.copy()
        rank[open_] = old + sub - whole_
        levels.append(rank)
        open_ = open_[~(head & np.append(head[1:], True))]
        span *= 2
    return levels


class RunIndex:
    """A run-length compressed Burrows-Wheeler transform of distinct strings, each followed
    by a separator, with the common prefixes sampled at both ends of its runs."""

    def __init__(self, text: np.ndarray) -> None:
        n = len(text)
        levels = suffix_ranks(text)
        suffixes = np.empty(n, np.int64)
        suffixes[levels[-1]] = np.arange(n)
        bwt = text[suffixes - 1]
        change = bwt[1:] != bwt[:-1]
        # Around the text's first suffix no symbol precedes: it is a run of its own.
        zero = int(levels[-1][0])
        change[max(0, zero - 1) : zero + 1] = True
        heads = np.flatnonzero(np.append(True, change))
        tails = np.flatnonzero(np.append(change, True))
        self.n, self.text = n, text
        self.runs = len(heads)
        self.heads = self._sample(levels, suffixes, heads, heads - 1)
        self.tails = self._sample(levels, suffixes, tails, tails + 1)

    def _sample(
        self, levels: list[np.ndarray], suffixes: np.ndarray, k: np.ndarray, other: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The text positions of the suffixes at ``k``, in text order, and how long a prefix
        each shares with the one at ``other``."""
        inside = (other >= 0) & (other < self.n)
        a, b = suffixes[k], suffixes[np.where(inside, other, k)]
        shared = np.zeros(len(k), np.int64)
        for level in reversed(range(len(levels))):
            x, y = a + shared, b + shared
            within = inside & (x < self.n) & (y < self.n)
            same = within & (levels[level][np.minimum(x, self.n - 1)] == levels[level][np.minimum(y, self.n - 1)])
            shared += np.where(same, 7 << level, 0)
        going = inside.copy()
        for _ in range(6):  # what is left is less than the first level's seven symbols
            x, y = a + shared, b + shared
            going &= (x < self.n) & (y < self.n)
            going &= self.text[np.minimum(x, self.n - 1)] == self.text[np.minimum(y, self.n - 1)]
            shared += going
        by = np.argsort(a)
        return a[by], shared[by]

    def matching_statistics(self) -> np.ndarray:
        """For each position, the longest string there that also starts elsewhere. Between
        samples it is one less than at the position before."""
        found = np.zeros(self.n, np.int64)
        for at, shared in (self.heads, self.tails):
            last = np.zeros(self.n, np.int64)
            last[at] = at
            last = np.maximum.accumulate(last)
            value = np.zeros(self.n, np.int64)
            value[at] = shared
            found = np.maximum(found, value[last] - (np.arange(self.n) - last))
        return found


def _flag_runs(flags: np.ndarray) -> list[dict[str, int]]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return [
        {"off": int(x), "n": int(y - x)} for x, y in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)
    ]


RUNS = "runs array<struct<off: int, n: int>>"
RUNS_ARROW = pa.list_(pa.struct([("off", pa.int32()), ("n", pa.int32())]))


def _resolve(length: int):
    """Tasks get whole keys, sorted: (h, s, seg, copies). Out come (h, s, runs of windows
    that occur elsewhere)."""

    def index(rows: list[tuple]) -> Iterator[tuple]:
        text = np.concatenate(
            [np.append(np.frombuffer(seg, np.uint8).astype(np.uint16), SEPARATOR) for _, _, seg, _ in rows]
        )
        repeated = RunIndex(text).matching_statistics() >= length
        at = 0
        for h, s, seg, copies in rows:
            flags = repeated[at : at + len(seg) - length + 1]
            at += len(seg) + 1
            if copies > 1:
                yield h, s, [{"off": 0, "n": len(seg) - length + 1}]
            elif flags.any():
                yield h, s, _flag_runs(flags)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            # A key with one run that has copies needs no index.
            done, rest = [], []
            at = 0
            while at < len(rows):
                to = at + 1
                while to < len(rows) and rows[to][0] == rows[at][0]:
                    to += 1
                if to - at == 1 and rows[at][3] > 1:
                    done.append((rows[at][0], rows[at][1], [{"off": 0, "n": len(rows[at][2]) - length + 1}]))
                else:
                    rest += rows[at:to]
                at = to
            if rest:
                done += index(rest)
            if done:
                h, s, runs = zip(*done, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), pa.array(s, pa.int64()), pa.array(runs, RUNS_ARROW)],
                    names=["h", "s", "runs"],
                )

        for batch in batches:
            for row in zip(*(batch.column(x).to_pylist() for x in ("h", "s", "seg", "copies")), strict=True):
                if size >= min(GATHERED_BYTES, INDEX_BYTES) and held[-1][0] != row[0]:
                    yield from out(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[2]) + 1
        if held:
            yield from out(held)

    return run


def _crowded(classes: DataFrame, length: int) -> DataFrame:
    """(h, s, runs) for keys with too many differing runs for one index: their windows are
    counted by a 128-bit hash, which no key keeps together."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, s, seg, copies in zip(*(batch.column(x).to_pylist() for x in ("h", "s", "seg", "copies")), strict=True):
                n = len(seg) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([h] * n, pa.int64()),
                        pa.array([s] * n, pa.int64()),
                        pa.array(range(n), pa.int32()),
                        pa.array([copies] * n, pa.int64()),
                        pa.array([hashlib.blake2b(seg[k : k + length], digest_size=16).digest() for k in range(n)]),
                    ],
                    names=["h", "s", "off", "copies", "w"],
                )

    each = classes.mapInArrow(windows, "h long, s long, off int, copies long, w binary")
    often = each.groupBy("w").agg(F.sum("copies").alias("times")).where("times > 1").select("w")
    return (
        each.join(often, "w", "left_semi")
        .select("h", "s", F.array(F.struct("off", F.lit(1).alias("n"))).alias("runs"))
    )


def repeated_spans(docs: DataFrame, length: int = 200) -> DataFrame:
    """(id, th, spans) of the texts of ``docs`` (id, th, text) in which some window also
    starts elsewhere; a span is the first byte and the number of such windows."""
    spark = docs.sparkSession
    tune(spark, BATCH_BYTES)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = raw(batch.column("text"))
            for _, _, _, h, _ in _runs(flat, offsets, length):
                h, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], names=["h", "n"])

    counted = docs.select("text").mapInArrow(keys, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    repeated = stage(counted.where("n > 1").select("h"), "repeated-keys")
    n_keys = repeated.count()
    bits = 1 << 16
    while bits < min(FILTER_BITS_MOST, n_keys * FILTER_BITS_A_KEY):
        bits *= 2
    word = F.shiftrightunsigned(F.col("h"), 6).bitwiseAND(F.lit(bits // 64 - 1))
    filled = (
        repeated.select(word.alias("word"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    table = np.zeros(bits // 64, np.uint64)
    table[filled.column("word").to_numpy()] = filled.column("bits").to_numpy().view(np.uint64)
    known = spark.sparkContext.broadcast(table)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.value
        for batch in batches:
            flat, offsets = raw(batch.column("text"))
            for row, at, n, h, byte, twin in _runs(flat, offsets, length, twins=True):
                u = h.view(np.uint64)
                word = (u >> np.uint64(6)) & np.uint64(len(table) - 1)
                hit = ((table[word] >> (u & np.uint64(63))) & np.uint64(1) == 1) | twin
                if not hit.any():
                    continue
                row, at, n, h, byte = (x[hit] for x in (row, at, n, h, byte))
                view = memoryview(flat)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(row)),
                        batch.column("th").take(pa.array(row)),
                        pa.array(at.astype(np.int64)),
                        pa.array(h),
                        pa.array([bytes(view[b : b + k + length - 1]) for b, k in zip(byte.tolist(), n.tolist(), strict=True)]),
                    ],
                    names=["id", "th", "at", "h", "seg"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    found = docs.mapInArrow(segments, f"id {kind}, th long, at long, h long, seg binary")
    found = stage(found.withColumn("s", F.xxhash64("seg")), "segments")
    classes = stage(found.groupBy("h", "s", "seg").agg(F.count("*").alias("copies")), "segment-classes")
    crowded = stage(
        classes.groupBy("h").agg(F.sum(F.length("seg") + 1).alias("size")).where(F.col("size") > INDEX_BYTES).select("h"),
        "crowded-keys",
    )
    shape = f"h long, s long, {RUNS}"
    any_crowded = not crowded.isEmpty()
    calm = classes.join(crowded, "h", "left_anti") if any_crowded else classes
    verdict = calm.repartition("h").sortWithinPartitions("h").mapInArrow(_resolve(length), shape)
    if any_crowded:
        verdict = verdict.unionByName(_crowded(classes.join(crowded, "h", "left_semi"), length))
    verdict = stage(verdict, "segment-verdicts")
    return (
        found.select("id", "th", "at", "h", "s")
        .join(verdict, ["h", "s"])
        .select("id", "th", F.explode(F.transform("runs", lambda r: F.struct((F.col("at") + r["off"]).alias("at"), r["n"].alias("n")))).alias("span"))
        .groupBy("id", "th")
        .agg(F.collect_list("span").alias("spans"))
    )


def remove_repeats(
    docs: DataFrame,
    length: int = 200,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept as binary) of every row; with
    ``carry``, also a struct ``carried`` of those columns.

    Each byte that a ``length``-byte string covers which also starts anywhere else, in the
    same text or another, is removed; texts are judged as given. Null is empty, matches
    never cross texts, repeated rows are copies of each other and go whole if they are long
    enough. ``kept`` need not be valid UTF-8, as a repeat may begin or end inside of a
    character.
    """
    tune(docs.sparkSession, BATCH_BYTES)
    carried = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(None).cast("string")
    source = docs.select(
        F.col(f"`{id_col}`").alias("id"), whole(F.col(f"`{text_col}`")).alias("text"), carried.alias("carried")
    ).withColumn("th", F.xxhash64("text"))
    spans = repeated_spans(source.select("id", "th", "text"), length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = raw(batch.column("text"))
            spans, removed, kept = [], [], []
            for row, own in enumerate(batch.column("spans").to_pylist()):
                text = flat[offsets[row] : offsets[row + 1]]
                gone = np.zeros(len(text) + 1, np.int32)
                if own:
                    at = np.array([x["at"] for x in own], np.int64)
                    n = np.array([x["n"] for x in own], np.int64)
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + n + length - 1, -1)
                    covered = np.cumsum(gone)[:-1] > 0
                    spans.append(int(np.count_nonzero(np.diff(np.append(0, covered.astype(np.int8))) == 1)))
                    removed.append(int(covered.sum()))
                    kept.append(text[~covered].tobytes())
                else:
                    spans.append(0)
                    removed.append(0)
                    kept.append(text.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(np.diff(offsets)),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                    pa.array(kept, pa.binary()),
                    batch.column("carried"),
                ],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "carried"],
            )

    spans = spans.select(F.col("id").alias("of"), F.col("th").alias("of_th"), "spans")
    joined = source.join(spans, F.col("id").eqNullSafe(F.col("of")) & (F.col("th") == F.col("of_th")), "left")
    kind = source.schema["id"].dataType.simpleString()
    shape = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    out = joined.select("id", "text", "spans", "carried").mapInArrow(
        cut, f"{shape}, carried {source.schema['carried'].dataType.simpleString()}"
    )
    return (out if carry else out.drop("carried")).withColumnRenamed("id", id_col)
