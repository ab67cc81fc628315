"""Shards cut from the rows' order along a Hilbert curve through their metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import renamed, whole
from millrace.llm.ranks import ranked

#: Bits that each dimension is quantised to.
BITS = 5
#: What a row takes besides its text, in bytes.
ROW_BYTES = 16


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """The place of a cell on the Hilbert curve that fills a grid of 2^bits cells a side.

    From the highest bit down, a set bit of a coordinate inverts the lower bits of the
    first coordinate, a clear one exchanges them with those of the first. The Gray code that
    is left, bits of all coordinates in turn, is the place.
    """
    n = len(cells)
    steps = [(1 << b, i) for b in range(bits - 1, 0, -1) for i in range(n)]
    table = F.array(*[F.struct(F.lit(q).alias("q"), F.lit(i).alias("i")) for q, i in steps])

    def turn(x: Column, step: Column) -> Column:
        q, i = step["q"], step["i"]
        own, first = F.element_at(x, i + 1), x[0]
        low = q - 1
        is_set = own.bitwiseAND(q) != 0
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        return F.transform(
            x,
            lambda v, k: F.when(is_set, F.when(k == 0, v.bitwiseXOR(low)).otherwise(v)).otherwise(
                F.when((k == 0) | (k == i), v.bitwiseXOR(swap)).otherwise(v)
            ),
        )

    start = F.array(*[c.cast("int") for c in cells])
    turned = F.aggregate(table, start, turn) if steps else start

    def gray(x: Column) -> Column:
        mixed = F.aggregate(
            F.sequence(F.lit(1), F.lit(n - 1)) if n > 1 else F.array().cast("array<int>"),
            x,
            lambda acc, i: F.transform(acc, lambda v, k: F.when(k == i, v.bitwiseXOR(F.element_at(acc, i))).otherwise(v)),
        )
        flips = F.aggregate(
            F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)]) if bits > 1 else F.array().cast("array<int>"),
            F.lit(0),
            lambda t, q: F.when(F.element_at(mixed, n).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t),
        )
        return F.transform(mixed, lambda v: v.bitwiseXOR(flips))

    # Bits from the highest down, of all coordinates in turn.
    turns = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])
    return F.element_at(
        F.transform(
            F.array(gray(turned)),
            lambda x: F.aggregate(
                turns,
                F.lit(0).cast("long"),
                lambda acc, s: acc * 2 + F.when(F.element_at(x, s["i"] + 1).bitwiseAND(s["q"]) != 0, 1).otherwise(0),
            ),
        ),
        1,
    )


def quantised(df: DataFrame, column: str, bits: int) -> Column:
    """A number's cell by the quantiles of its column, a text's (or other value's) by its
    hash. Null is cell 0."""
    cells = 1 << bits
    if isinstance(df.schema[column].dataType, T.NumericType):
        shares = [k / cells for k in range(1, cells)]
        bounds = df.agg(F.percentile_approx(F.col(column).cast("double"), shares, 1_000)).first()[0] or []
        value = F.col(column).cast("double")
        return F.coalesce(sum((value > b).cast("int") for b in bounds) if bounds else F.lit(0), F.lit(0))
    return F.coalesce(F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(cells)).cast("int") * F.col(column).isNotNull().cast("int"), F.lit(0))


def hilbert_shards(
    docs: DataFrame,
    shards: int = 40,
    dimensions: tuple[str, ...] = ("source", "lang"),
    bits: int = BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, size, text_crc32, curve, law, shard, slot, grown_shard) for every row.

    Rows are ordered by their place on the Hilbert curve through ``dimensions`` and their
    size, then by size, id and text, and the order is cut into ``shards`` runs whose counts
    differ by one at most (law ``rows``). So a shard covers few values of each dimension,
    and a reader that filters on any of them skips most files. Rows alike in all dimensions
    lie in one cell, however many: the order within it decides. A null text has no bytes;
    null ids and dimensions order first; repeated rows take slots of their own.
    """
    named = {"id": id_col, "text": text_col} | {f"d{k}": c for k, c in enumerate(dimensions)}
    source = renamed(docs, **named)
    bytes_ = F.octet_length(whole("text"))
    source = source.select(
        "id",
        (bytes_ + ROW_BYTES).cast("long").alias("size"),
        F.crc32(whole("text").cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("tie"),
        *[f"d{k}" for k in range(len(dimensions))],
    )
    cells = [quantised(source, f"d{k}", bits) for k in range(len(dimensions))] + [quantised(source, "size", bits)]
    placed = source.withColumn("curve", hilbert_index(cells, bits)).select("id", "size", "text_crc32", "tie", "curve")
    order = ["curve", "size", "id", "text_crc32", "tie"]
    rows = ranked(placed, *map(F.col, order))
    # A plain number: what one job has counted, the next one is planned with.
    n = max(1, docs.count())
    shard = F.expr(f"cast(rank * {shards} div {n} as int)")
    begin = F.expr(f"(shard * cast({n} as long) + {shards - 1}) div {shards}")
    return rows.withColumn("shard", shard).select(
        F.col("id").alias(id_col), "size", "text_crc32", "curve", F.lit("rows").alias("law"), "shard",
        (F.col("rank") - begin).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """The rows of ``docs``, whose ids are unique, as a folder per shard in slot order."""
    slots = placed.select(F.col(id_col).alias("_id"), "shard", "slot")
    rows = docs.join(slots, F.col(id_col) == F.col("_id")).drop("_id")
    rows.repartition("shard").sortWithinPartitions("shard", "slot").drop("slot").write.partitionBy("shard").parquet(path)
