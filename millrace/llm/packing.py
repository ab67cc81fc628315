"""Best-fit packing by rounds: pack locally, then merge the bins that are not full."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import renamed, tune, whole
from millrace.llm.tokens import word_ids
from millrace.staging import stage

#: Pieces a task packs at a time: what bounds its memory.
PACK_AT_ONCE = 100_000
#: Groups whose bins meet in one task of the next round.
FAN_IN = 8


def best_fit(sizes: Iterable[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Best-fit decreasing: each size's bin and place in it, and how full each bin is.

    Open bins are kept by the room they have left. A bit set of the rooms in use finds the
    smallest that suffices, so a step costs the same however many bins are open.
    """
    sizes = list(sizes)
    bin_of, offset = [0] * len(sizes), [0] * len(sizes)
    fill: list[int] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[i]
        enough = rooms >> size
        if enough:
            room = size + (enough & -enough).bit_length() - 1
            bins = by_room[room]
            b = bins.pop()
            if not bins:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bin_of[i], offset[i] = b, fill[b]
        fill[b] += size
        left = room - size
        if left:
            by_room.setdefault(left, []).append(b)
            rooms |= 1 << left
    return bin_of, offset, fill


def goes_on(fill: list[int], capacity: int, rounds: int) -> list[bool]:
    """Whether each bin of a packed group is an item of the next of so many further rounds.

    Best fit leaves a group one bin at most that is no more than half full, and two fuller ones
    never fit together. So a further round moves ``FAN_IN`` bins at most, each into a bin of
    some fill, and of the bins of one fill ``FAN_IN`` a round are all that can be taken. The
    others stay as they are, and the rounds leave bins as full as if all had gone on.
    """
    met: dict[int, int] = {}
    on = []
    for x in fill:
        met[x] = met.get(x, 0) + 1
        on.append(rounds > 0 and x < capacity and (2 * x <= capacity or met[x] <= FAN_IN * rounds))
    return on


PIECES = "piece int, start long, length long, ids_crc32 long"


def pack(
    docs: DataFrame,
    capacity: int = 4096,
    name: str = "word_bpe_49k.json",
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and ``end_id``; only longer ones than ``capacity`` are cut,
    so a null or empty text is one piece of length one. Every row is packed, repeated ids
    and texts too. Tasks tokenise and pack their own rows; what they stage is a row of
    numbers per piece, never text. Then underfull bins are the items of further best-fit
    rounds, ``FAN_IN`` groups to a task, until one group is left. An empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    tune(spark)
    source = renamed(docs, id=id_col, text=text_col).select("id", whole("text").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    end = end_id.to_bytes(4, "little")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(name)
        task = TaskContext.get().partitionId()
        taken, ids, cut = 0, [], []

        def packed() -> pa.RecordBatch:
            nonlocal taken
            bin_of, offset, fill = best_fit([x[2] for x in cut], capacity)
            columns = [
                pa.concat_arrays(ids).take(pa.array([x[4] for x in cut], pa.int64())),
                pa.array([x[0] for x in cut], pa.int32()),
                pa.array([x[1] for x in cut], pa.int64()),
                pa.array([x[2] for x in cut], pa.int64()),
                pa.array([x[3] for x in cut], pa.int64()),
                pa.array([(task << 33) + taken + b for b in bin_of], pa.int64()),
                pa.array(offset, pa.int64()),
                pa.array([fill[b] for b in bin_of], pa.int64()),
                pa.array([task] * len(cut), pa.int64()),
            ]
            taken += len(fill)
            ids.clear()
            cut.clear()
            return pa.RecordBatch.from_arrays(
                columns, names=["id", "piece", "start", "length", "ids_crc32", "bin", "offset", "fill", "part"]
            )

        for batch in batches:
            before = sum(map(len, ids))
            ids.append(batch.column("id"))
            for row, text in enumerate(batch.column("text").to_pylist()):
                whole_ids = words.encode(text) + end
                for piece, at in enumerate(range(0, len(whole_ids), 4 * capacity)):
                    own = whole_ids[at : at + 4 * capacity]
                    cut.append((piece, at // 4, len(own) // 4, zlib.crc32(own), before + row))
            if len(cut) >= PACK_AT_ONCE:
                yield packed()
        if cut:
            yield packed()

    pieces = stage(
        source.mapInArrow(local, f"id {kind}, {PIECES}, bin long, offset long, fill long, part long"),
        "pieces",
    )
    merged = _merge_rounds(pieces, capacity)
    if merged is not None:
        pieces = pieces.join(merged, "bin", "left").select(
            "id", "piece", "start", "length", "ids_crc32",
            F.coalesce("into", "bin").alias("bin"),
            (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
        )
    return pieces.select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32",
        F.col("bin").alias("sequence_id"), "offset",
    )


def _merge_rounds(pieces: DataFrame, capacity: int) -> DataFrame | None:
    """(bin, into, shift): where the bins that later rounds moved have ended up."""
    groups = pieces.agg(F.max("part")).first()[0]
    if groups is None:
        return None
    n = groups + 1
    # The first piece of a bin stands for it: no shuffle is needed to list them.
    open_bins = pieces.where((F.col("offset") == 0) & (F.col("fill") < capacity)).select("bin", "fill", "part")
    moved = None

    def merge(batches: Iterator[pa.RecordBatch], rounds: int) -> Iterator[pa.RecordBatch]:
        rows: dict[int, list[tuple[int, int]]] = {}
        for batch in batches:
            for b, size, part in zip(*(batch.column(x).to_pylist() for x in ("bin", "fill", "part")), strict=True):
                rows.setdefault(part, []).append((b, size))
        for part, bins in rows.items():
            bins.sort(key=lambda x: (x[1], x[0]))
            bin_of, offset, fill = best_fit([x[1] for x in bins], capacity)
            first = {bin_of[k]: bins[k][0] for k, at in enumerate(offset) if at == 0}
            on = goes_on(fill, capacity, rounds)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in bins], pa.int64()),
                    pa.array([first[b] for b in bin_of], pa.int64()),
                    pa.array(offset, pa.int64()),
                    pa.array([fill[b] for b in bin_of], pa.int64()),
                    pa.array([part] * len(bins), pa.int64()),
                    pa.array([on[b] for b in bin_of], pa.bool_()),
                ],
                names=["bin", "into", "shift", "fill", "part", "on"],
            )

    while True:
        n = -(-n // FAN_IN)
        rounds, left = 0, n
        while left > 1:
            rounds, left = rounds + 1, -(-left // FAN_IN)
        # Of a task's bins, those that go on are chosen where the bins are.
        grouped = open_bins.withColumn("part", F.floor(F.col("part") / FAN_IN)).repartition(n, "part")
        step = stage(
            grouped.mapInArrow(partial(merge, rounds=rounds), "bin long, into long, shift long, fill long, part long, on boolean"),
            "packing-round",
        )
        changed = step.where("bin <> into or shift <> 0").select("bin", "into", "shift")
        if moved is None:
            moved = changed
        else:
            later = changed.select(F.col("bin").alias("into"), F.col("into").alias("next"), F.col("shift").alias("more"))
            earlier = moved.join(later, "into", "left").select(
                "bin", F.coalesce("next", "into").alias("into"),
                (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"),
            )
            moved = earlier.unionByName(changed)
        if n == 1:
            return moved
        open_bins = step.where("on and shift = 0 and bin = into").select("bin", "fill", "part")
