"""A Merkle tree over a dataset, stored as subtrees in van Emde Boas order.

A group's leaves are cut into aligned blocks of 16^3. A block is a whole subtree of up to
four levels of nodes, kept in one binary value: the upper half of its levels first, then the
subtrees below that half one after another, and each of these the same way. Arithmetic
alone says where a node stands. Block roots are the leaves of the next tier, and group roots
those of the tree over groups, so neither a group nor their number is bounded by a task.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import tune
from millrace.llm.ranks import SLICE_ROWS, ranked
from millrace.staging import fresh_path, stage, staging

#: Children of a node, the bits of a child's place, and bytes of a digest.
FAN, BITS, DIGEST = 16, 4, 32
#: Levels of nodes above a block's leaves: 16^3 leaves, 140 KB of nodes.
HEIGHT = 3

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest_of(*fields: Column) -> Column:
    """sha256 of the fields, each as its length in UTF-8 bytes, a colon and its value, or as a
    hyphen where it is null."""
    tokens = []
    for field in fields:
        value = field.cast("string")
        tokens.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*tokens).cast("binary"), 256))


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case and nothing else changed."""
    return F.translate(text, _UPPER, _LOWER)


# ------------------------------------------------------------------------- addresses


def nodes_in(leaves: int, levels: int) -> int:
    """Nodes of a tree with that many levels over ``leaves`` leaves."""
    return sum(-(-leaves // FAN**k) for k in range(levels))


def address(level: int, index: np.ndarray, leaves: int, levels: int) -> np.ndarray:
    """Where the nodes ``index`` of a level stand (0: the leaves), in a tree of ``levels``
    levels over ``leaves`` leaves, of which the last run may be short."""
    if levels == 1:
        return index
    below = (levels + 1) // 2
    # The leaves of the upper half are the parents of the lower subtrees' roots.
    upper = -(-leaves // FAN**below)
    if level >= below:
        return address(level - below, index, upper, levels - below)
    span = FAN ** (below - 1)
    tree = index >> BITS * (below - 1 - level)
    inner = index - (tree << BITS * (below - 1 - level))
    last = (leaves - 1) // span
    whole = address(level, inner, span, below)
    short = address(level, np.where(tree == last, inner, 0), leaves - last * span, below)
    return nodes_in(upper, levels - below) + tree * nodes_in(span, below) + np.where(tree == last, short, whole)


def height_of(total: int, most: int) -> int:
    """Levels above ``total`` leaves until one node is left, at most a block's."""
    height = 0
    while height < most and total > FAN**height:
        height += 1
    return height


@functools.lru_cache(maxsize=256)
def layout(leaves: int, height: int) -> list[np.ndarray]:
    """The addresses of all nodes, level by level from the leaves."""
    sizes = [-(-leaves // FAN**k) for k in range(height + 1)]
    return [address(k, np.arange(n), leaves, height + 1) for k, n in enumerate(sizes)]


# ---------------------------------------------------------------------------- blocks


def _hex(digests: bytes) -> bytes:
    return digests.hex().encode()


def grow(leaves: bytes, height: int) -> bytes:
    """The nodes of a subtree over the leaves' digests, in van Emde Boas order."""
    slots = layout(len(leaves) // DIGEST, height)
    nodes = np.zeros((sum(map(len, slots)), DIGEST), np.uint8)
    level = leaves
    for k, places in enumerate(slots):
        nodes[places] = np.frombuffer(level, np.uint8).reshape(-1, DIGEST)
        if k < height:
            runs = range(0, len(level), FAN * DIGEST)
            level = b"".join(hashlib.sha256(_hex(level[a : a + FAN * DIGEST])).digest() for a in runs)
    return nodes.tobytes()


class Block:
    """A stored subtree: what stands at a leaf, and what stands beside its way to the root."""

    def __init__(self, nodes: bytes, total: int, block: int, most: int):
        self.first = block * FAN**most
        self.leaves = min(FAN**most, total - self.first)
        self.height = height_of(total, most)
        self.slots = layout(self.leaves, self.height)
        self.nodes = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)

    def leaf(self, k: int) -> bytes:
        return self.nodes[self.slots[0][k]].tobytes()

    def root(self) -> bytes:
        return self.nodes[self.slots[-1][0]].tobytes()

    def step(self, k: int, level: int) -> tuple[bytes, bytes]:
        """The digests before and after the ancestor of leaf ``k`` on a level, in its run."""
        own = k >> BITS * level
        first = own - own % FAN
        run = self.nodes[self.slots[level][first : first + FAN]]
        return run[: own - first].tobytes(), run[own - first + 1 :].tobytes()

    def steps(self, k: int, lowest: int = 0) -> list[tuple[bytes, bytes]]:
        return [self.step(k, level) for level in range(lowest, self.height)]


def packed(steps: list[tuple[bytes, bytes]]) -> bytes:
    return b"".join(bytes((len(a) // DIGEST, len(b) // DIGEST)) + a + b for a, b in steps)


def unpacked(path: bytes) -> list[tuple[bytes, bytes]]:
    steps, at = [], 0
    while at < len(path):
        before, after = at + 2 + path[at] * DIGEST, at + 2 + (path[at] + path[at + 1]) * DIGEST
        steps.append((path[at + 2 : before], path[before:after]))
        at = after
    return steps


def fold(digest: bytes, steps: list[tuple[bytes, bytes]]) -> bytes:
    """The root that follows from a leaf and the siblings on its way."""
    for before, after in steps:
        digest = hashlib.sha256(_hex(before + digest + after)).digest()
    return digest


# ----------------------------------------------------------------------------- tiers

_BLOCKS = "part string, total long, block long, nodes binary, root binary"


def _blocks(rows: DataFrame, height: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """Rows (part, total, at, leaf, carried) as blocks; what is carried becomes arrays in the
    order of the leaves. A block has at most 16^height rows, whatever its part."""
    own = F.struct("at", "leaf", *carried)
    cut = rows.groupBy("part", "total", F.expr(f"at div {FAN**height}").alias("block")).agg(
        F.sort_array(F.collect_list(own)).alias("own")
    )
    cut = cut.select("part", "total", "block", "own.leaf", *[F.col(f"own.{c}").alias(c) for c in carried])
    kept = [f"{c} {cut.schema[c].dataType.simpleString()}" for c in carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stored, roots = [], []
            for leaves, total, block in zip(
                batch.column("leaf").to_pylist(), batch.column("total").to_pylist(), batch.column("block").to_pylist(), strict=True
            ):
                stored.append(grow(b"".join(leaves), height_of(total, height)))
                roots.append(Block(stored[-1], total, block, height).root())
            known = [batch.column(c) for c in ("part", "total", "block")]
            made = [pa.array(stored, pa.binary()), pa.array(roots, pa.binary())]
            names = ["part", "total", "block", "nodes", "root", *carried]
            yield pa.RecordBatch.from_arrays([*known, *made, *[batch.column(c) for c in carried]], names=names)

    return cut.mapInArrow(run, ", ".join([_BLOCKS, *kept]))


def _tiers(rows: DataFrame, height: int, carried: tuple[str, ...] = ()) -> list[DataFrame]:
    """Blocks over the rows, over those blocks' roots, and so on until every part is one
    block. Each tier has one row for a block of the one before."""
    tiers = [stage(_blocks(rows, height, carried), "merkle-blocks")]
    while True:
        tall = tiers[-1].where(F.col("total") > FAN**height)
        if tall.isEmpty():
            return tiers
        above = F.expr(f"(total + {FAN**height - 1}) div {FAN**height}").alias("total")
        roots = tall.select("part", above, F.col("block").alias("at"), F.col("root").alias("leaf"))
        tiers.append(stage(_blocks(roots, height), "merkle-blocks"))


def _placed(rows: DataFrame) -> DataFrame:
    """(part, id, leaf, ...) with each row's place in its part and the part's rows.

    Rows are range-partitioned by part, id and leaf, so a part that holds most rows is cut
    into slices; a slice adds what its part has in the slices before. No window holds more
    than a row a slice.
    """
    spark = rows.sparkSession
    slices = max(spark.sparkContext.defaultParallelism, -(-rows.count() // SLICE_ROWS))
    at, order = F.monotonically_increasing_id(), ["part", "id", "leaf"]
    sliced = stage(
        rows.repartitionByRange(slices, *order)
        .sortWithinPartitions(*order)
        .withColumn("slice", F.shiftright(at, 33))
        .withColumn("place", at.bitwiseAND(F.lit((1 << 33) - 1))),
        "merkle-slices",
    )
    counts = sliced.groupBy("slice", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    part = Window.partitionBy("part")
    earlier = F.sum("n").over(part.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("slice", "part", F.sum("n").over(part).alias("total"), (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift"))
    return sliced.join(counts, ["slice", "part"]).withColumn("at", F.col("place") + F.col("shift"))


@dataclass(frozen=True)
class Manifest:
    """The stored tree: tiers of blocks per part, the parts in order, and tiers over these.
    ``root`` is None for an empty table."""

    tiers: list[DataFrame]
    parts: DataFrame
    over: list[DataFrame]
    root: bytes | None
    height: int = HEIGHT


def build(leaves: DataFrame, height: int = HEIGHT) -> Manifest:
    """The tree over rows (part, id, leaf, other). Parts are in bytewise order."""
    tiers = _tiers(_placed(stage(leaves, "merkle-leaves")), height, ("id", "other"))
    whole = [x.where(F.col("total") <= FAN**height).select("part", F.col("root").alias("leaf")) for x in tiers]
    subroots = whole[0]
    for more in whole[1:]:
        subroots = subroots.unionByName(more)
    parts = stage(ranked(stage(subroots, "merkle-subroots"), F.col("part"), name="at"), "merkle-parts")
    n = parts.count()
    over = _tiers(parts.select(F.lit("").alias("part"), F.lit(n).cast("long").alias("total"), "at", "leaf"), height)
    top = over[-1].select("root").first()
    return Manifest(tiers, parts, over, bytes(top.root) if top else None, height)


# ---------------------------------------------------------------------------- proofs


def _below(blocks: DataFrame, paths: DataFrame, height: int) -> DataFrame:
    """(part, at, path, subroot): the way up from each leaf of the blocks, given that of the
    blocks' roots (part, block, path, subroot)."""
    both = blocks.select("part", "total", "block", "nodes").join(paths, ["part", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["nodes"], row["total"], row["block"], height)
                n, first = block.leaves, block.first
                ways = [packed(block.steps(k)) + row["path"] for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * n, pa.string()), pa.array(np.arange(first, first + n)),
                        pa.array(ways, pa.binary()), pa.array([row["subroot"]] * n, pa.binary()),
                    ],
                    names=["part", "at", "path", "subroot"],
                )

    return both.mapInArrow(run, "part string, at long, path binary, subroot binary")


def _root_path(blocks: DataFrame) -> DataFrame:
    empty = F.lit(b"")
    return blocks.select("part", "block", empty.alias("path"), F.lit(None).cast("binary").alias("subroot"))


def _block_paths(manifest: Manifest) -> DataFrame:
    """(part, block, path, subroot) for the blocks of the lowest tier."""
    paths = _root_path(manifest.over[-1])
    for tier in reversed(manifest.over):
        paths = stage(_below(tier, paths, manifest.height), "merkle-paths")
        if tier is not manifest.over[0]:
            paths = paths.select("part", F.col("at").alias("block"), "path", "subroot")
    # A part's root is the root of the one block of its highest tier.
    of_parts = paths.select("at", "path").join(manifest.parts, "at")
    of_parts = stage(of_parts.select("part", F.lit(0).cast("long").alias("block"), "path", F.col("leaf").alias("subroot")), "merkle-paths")
    found = None
    for k in reversed(range(len(manifest.tiers))):
        tier = manifest.tiers[k]
        ends = tier.where(F.col("total") <= FAN**manifest.height).select("part", "block")
        own = of_parts.join(ends, ["part", "block"], "left_semi")
        if found is not None:
            above = _below(manifest.tiers[k + 1], found, manifest.height)
            own = own.unionByName(above.select("part", F.col("at").alias("block"), "path", "subroot"))
        found = stage(own, "merkle-paths")
    return found


_PROOFS = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def proofs(manifest: Manifest, id_type: str) -> DataFrame:
    """One row per leaf: its id, its digest, its part's root, the root, the digest of its
    siblings, and the root that follows from them and the leaf (or its ``other``)."""
    root, height = manifest.root, manifest.height

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            for k, row in enumerate(batch.drop_columns(["id"]).to_pylist()):
                block, upper, others = Block(row["nodes"], row["total"], row["block"], height), unpacked(row["path"]), row["other"]
                out: dict[str, list] = {name: [] for name in ("leaf", "proof", "folded", "verified")}
                for i in range(block.leaves):
                    if i % FAN == 0:
                        # All that a run shares: the way up from its parent.
                        shared = [*block.steps(i, 1), *upper] if block.height else upper
                        beyond = b"".join(_hex(a + b) for a, b in shared)
                    own = [block.step(i, 0)] if block.height else []
                    siblings = b"".join(_hex(a + b) for a, b in own)
                    leaf = block.leaf(i)
                    folded = fold(others[i] or leaf, own + shared)
                    out["leaf"].append(leaf.hex())
                    out["proof"].append(hashlib.sha256(siblings + beyond).hexdigest())
                    out["folded"].append(folded.hex())
                    out["verified"].append(folded == root)
                n = block.leaves
                columns = [
                    ids.slice(k, 1).flatten(), pa.array(out["leaf"]), pa.array([row["subroot"].hex()] * n), pa.array([root.hex()] * n),
                    pa.array(out["proof"]), pa.array(out["folded"]), pa.array(out["verified"]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    blocks = manifest.tiers[0].join(_block_paths(manifest), ["part", "block"])
    return blocks.mapInArrow(run, f"id {id_type}, {_PROOFS}")


def merkle_proofs(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "source",
    tampered: Callable[[Column, str], Column] | None = None,
    tampered_where: Column | None = None,
    height: int = HEIGHT,
) -> DataFrame:
    """Every row's leaf, the roots above it, and a check of its proof.

    A leaf is ``digest_of`` the fields. A group's leaves ascend by id, null ids first and rows
    of one id by digest; runs of 16 become their hash until one node is left. Groups' roots,
    the null group first and else by their names' bytes, are joined the same way. Where
    ``tampered_where`` holds, the proof is checked against a leaf whose fields have gone
    through ``tampered(column, name)``. Repeated rows are leaves of their own; null fields
    have their own token; an empty table has no root and gives no row. Other columns are not
    read.
    """
    spark = docs.sparkSession
    tune(spark)
    named = {x: F.col(f"`{x}`") for x in fields}
    part = F.col(f"`{group_col}`").cast("string")
    other = F.lit(None).cast("binary")
    if tampered is not None and tampered_where is not None:
        other = F.when(tampered_where, digest_of(*[tampered(c, x) for x, c in named.items()]))
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), part), F.lit("")).alias("part"),
        F.col(f"`{id_col}`").alias("id"),
        digest_of(*named.values()).alias("leaf"),
        other.alias("other"),
    )
    id_type = leaves.schema["id"].dataType.simpleString()
    path = fresh_path(spark, "merkle-proofs")
    with staging(spark):
        out = proofs(build(leaves, height), id_type).withColumnRenamed("id", id_col)
        out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)
