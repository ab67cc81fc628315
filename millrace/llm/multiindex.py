"""Near-duplicate vectors through an inverted multi-index."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import hash_sample, renamed, tune
from millrace.llm.components import components
from millrace.staging import stage

#: Distinct vectors that the codebooks are fitted to, at most.
FIT_ROWS = 20_000
FIT_STEPS = 10
#: Words in the codebook of each half: about the fourth root of the largest label's vectors,
#: so that the number of cells, and how full they are, both grow as its square root. A visit
#: costs a shuffled row, a comparison only a few dozen machine operations.
WORDS_MOST = 256
#: Vectors that live in a cell, beyond which it is dealt to several tasks; and rows that are
#: compared with them at a time.
CELL, BLOCK = 4_096, 1_024


def usable(v: Column) -> Column:
    """Neither null nor empty nor all zero, and every component a finite number."""
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(v, lambda x: x != 0), F.lit(False))


def _units(binary: list[bytes], dim: int, kind: str = "f8") -> np.ndarray:
    x = np.frombuffer(b"".join(binary), kind).reshape(-1, dim).astype(np.float64)
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _distances(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ words.T + (words * words).sum(1), 0)


def _codebook(x: np.ndarray, n: int) -> np.ndarray:
    """k-means on the distinct rows, begun with rows evenly spaced in the sample's order."""
    words = x[np.unique(np.linspace(0, len(x) - 1, min(n, len(x))).astype(int))].copy()
    for _ in range(FIT_STEPS):
        nearest = _distances(x, words).argmin(1)
        total = np.bincount(nearest, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, nearest, x)
        some = total > 0
        words[some] = sums[some] / total[some, None]
    return np.unique(words, axis=0)


def _bounds(x: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest word, and for every word the least squared distance at which a
    point could have that one as its nearest."""
    d = _distances(x, words)
    own = d.argmin(1)
    apart = np.sqrt(np.maximum(_distances(words, words), 1e-300))[own]
    ahead = np.maximum(d - d[np.arange(len(x)), own][:, None], 0) / (2 * apart)
    ahead[np.arange(len(x)), own] = 0
    return own, ahead * ahead


def traverse(first: np.ndarray, second: np.ndarray, reach: float) -> list[tuple[int, int]]:
    """Cells (i, j) by ascending first[i] + second[j], until that exceeds ``reach``: the
    multi-sequence algorithm, with a heap over two sorted lists."""
    a, b = np.flatnonzero(first <= reach), np.flatnonzero(second <= reach)
    a, b = a[np.argsort(first[a], kind="stable")], b[np.argsort(second[b], kind="stable")]
    x, y = first[a].tolist(), second[b].tolist()
    if not x or not y:
        return []
    heap, out = [(x[0] + y[0], 0, 0)], []
    while heap and heap[0][0] <= reach:
        _, i, j = heapq.heappop(heap)
        out.append((int(a[i]), int(b[j])))
        if j + 1 < len(y):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
    return out


class _Cell:
    """The vectors that live in a cell; others are compared with them as they come."""

    def __init__(self, nodes: list[int], copies: list[int], vectors: np.ndarray, threshold: float) -> None:
        self.nodes, self.copies, self.vectors = np.array(nodes), np.array(copies), vectors
        self.threshold = threshold
        self.label = np.arange(len(nodes))
        self.links = np.zeros(len(nodes), np.int64)
        self.edges: list[tuple[int, int]] = []

    def join(self, node: int, near: np.ndarray) -> None:
        """``node`` links all of ``near``: one edge to each part not yet connected."""
        own = self.label[near]
        kept = near[np.unique(own, return_index=True)[1]]
        self.edges += [(node, int(self.nodes[k])) for k in kept if self.nodes[k] != node]
        if len(kept) > 1:
            self.label[np.isin(self.label, own)] = own.min()

    def inside(self) -> None:
        for at in range(0, len(self.nodes), BLOCK):
            near = self.vectors[at : at + BLOCK] @ self.vectors.T >= self.threshold
            near[np.arange(len(near)), np.arange(at, at + len(near))] = False
            self.links[at : at + BLOCK] += near @ self.copies
            near[np.arange(len(near)), np.arange(at, at + len(near))] = True
            for k, row in enumerate(near, at):
                if row.sum() > 1 and len(set(self.label[row].tolist())) > 1:
                    self.join(int(self.nodes[k]), np.flatnonzero(row))

    def meet(self, nodes: list[int], copies: list[int], vectors: np.ndarray) -> np.ndarray:
        near = vectors @ self.vectors.T >= self.threshold
        self.links += near.T @ np.array(copies)
        for k in np.flatnonzero(near.any(1)):
            self.join(nodes[k], np.flatnonzero(near[k]))
        return near @ self.copies


def link_vectors(
    table: DataFrame,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | None = "label",
    cell: int = CELL,
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row: vectors with equal labels whose
    cosine is ``threshold`` or more are linked.

    Equal vectors collapse to one with a number of copies. Two codebooks, each on one half
    of the unit vectors, make a grid of cells. A vector visits cells from the nearest on, and
    stops when no further one can hold a vector within the threshold: that is proven by
    the distance to the cells' borders, so the recall is whole. Of two cells it suffices to
    visit the one of lower number. Every pair that meets is verified in double precision.

    Null labels, null ids and vectors that are null, empty, zero or hold null or non-finite
    components link with nothing; vectors of different lengths don't either. Repeated rows
    are copies. Without ``label_col`` all rows may link.
    """
    spark = table.sparkSession
    tune(spark)
    named = {"id": id_col, "v": vector_col} | ({"label": label_col} if label_col else {})
    rows = renamed(table, **named)
    if not label_col:
        rows = rows.withColumn("label", F.lit(0))
    if rows.schema["v"].dataType.simpleString() != "array<float>":
        rows = rows.withColumn("v", F.col("v").cast("array<double>"))
    fit_for_use = usable(F.col("v")) & F.col("label").isNotNull() & F.col("id").isNotNull()
    classes = stage(
        rows.where(fit_for_use).groupBy("label", "v").agg(F.min("id").cast("long").alias("node"), F.count("*").alias("copies")),
        "vector-classes",
    )
    linked = None if classes.isEmpty() else _linked(classes, threshold, cell)
    if linked is not None:
        totals, joined = linked
        classes = (
            classes.join(totals, "node", "left")
            .join(joined, "node", "left")
            .select(
                "label", "v",
                (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "node").alias("component_id"),
            )
        )
    else:
        classes = classes.select("label", "v", (F.col("copies") - 1).alias("n_links"), F.col("node").alias("component_id"))
    out = (
        rows.where(fit_for_use).join(classes, ["label", "v"]).select("id", "n_links", "component_id")
        .unionByName(rows.where(~fit_for_use).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").cast("long").alias("component_id")))
    )
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def _linked(classes: DataFrame, threshold: float, cell: int) -> tuple[DataFrame, DataFrame]:
    """(node, links) summed, and (node, component)."""
    spark = classes.sparkSession
    kind = "f4" if classes.schema["v"].dataType.simpleString() == "array<float>" else "f8"
    sample = hash_sample(classes, FIT_ROWS, "node").select("v").toArrow().column("v").to_pylist()
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0]
    wanted = min(WORDS_MOST, int(np.ceil(largest**0.25)))
    books = {}
    for dim in {len(v) for v in sample}:
        x = _units([np.array(v, "f8").tobytes() for v in sample if len(v) == dim], dim)
        books[dim] = (_codebook(x[:, : dim // 2], wanted), _codebook(x[:, dim // 2 :], wanted))
    known = spark.sparkContext.broadcast(books)
    reach = 2 * (1 - threshold) + 1e-9

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = known.value
        for batch in batches:
            vectors = batch.column("v").to_pylist()
            where, cells, lives = [], [], []
            for dim in sorted({len(v) for v in vectors}):
                mine = [k for k, v in enumerate(vectors) if len(v) == dim]
                # A length that the sample lacks has a single cell.
                one = np.zeros((1, dim))
                left, right = books.get(dim, (one[:, : dim // 2], one[:, dim // 2 :]))
                x = _units([np.array(vectors[k], "f8").tobytes() for k in mine], dim)
                own_left, first = _bounds(x[:, : dim // 2], left)
                own_right, second = _bounds(x[:, dim // 2 :], right)
                own = own_left * len(right) + own_right
                for k, at in enumerate(mine):
                    for i, j in traverse(first[k], second[k], reach):
                        visited = i * len(right) + j
                        if visited <= own[k]:
                            where.append(at)
                            cells.append(int(visited))
                            lives.append(bool(visited == own[k]))
            take = pa.array(where, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(x).take(take) for x in ("label", "node", "copies")),
                    pa.array([len(vectors[k]) for k in where], pa.int32()),
                    pa.array(cells, pa.int64()),
                    pa.array(lives, pa.bool_()),
                    pa.array([np.array(v, kind).tobytes() for v in vectors], pa.binary()).take(take),
                ],
                names=["label", "node", "copies", "dim", "cell", "lives", "x"],
            )

    label = classes.schema["label"].dataType.simpleString()
    shape = f"label {label}, node long, copies long, dim int, cell long, lives boolean, x binary"
    dealt = stage(classes.select("label", "v", "node", "copies").mapInArrow(deal, shape), "vector-visits")
    place = ["label", "dim", "cell"]
    crowded = dealt.where("lives").groupBy(*place).count().where(F.col("count") > cell)
    crowded = crowded.select(*place, F.ceil(F.col("count") / cell).cast("int").alias("blocks"))
    # A vector that lives in a crowded cell lives in one of its blocks, and visits those
    # before it; a visitor goes to all of them.
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    spread = (
        dealt.join(crowded, place, "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("home", F.when(F.col("lives"), block).otherwise(F.col("blocks") - 1))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("home"))))
        .withColumn("lives", F.col("lives") & (F.col("block") == F.col("home")))
        .select(*place, "block", "lives", "node", "copies", "x")
    )
    keys = [*place, "block"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        home: list[tuple] = []
        open_: _Cell | None = None
        guests: list[tuple] = []

        def batch_of(counts: list[tuple[int, int]], edges: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
            if counts or edges:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x for x, _ in counts] + [x for x, _ in edges], pa.int64()),
                        pa.array([None] * len(counts) + [y for _, y in edges], pa.int64()),
                        pa.array([y for _, y in counts] + [0] * len(edges), pa.int64()),
                    ],
                    names=["a", "b", "links"],
                )

        def settle(dim: int) -> Iterator[pa.RecordBatch]:
            """Compare the guests so far with the cell, which is built when the first come."""
            nonlocal open_
            if not home:
                guests.clear()
                return
            if open_ is None:
                open_ = _Cell([x[0] for x in home], [x[1] for x in home], _units([x[2] for x in home], dim, kind), threshold)
                open_.inside()
            if guests:
                nodes = [x[0] for x in guests]
                met = open_.meet(nodes, [x[1] for x in guests], _units([x[2] for x in guests], dim, kind))
                edges, open_.edges = open_.edges, []
                yield from batch_of([(x, int(k)) for x, k in zip(nodes, met, strict=True) if k], edges)
                guests.clear()

        def close(dim: int) -> Iterator[pa.RecordBatch]:
            nonlocal open_
            yield from settle(dim)
            if open_ is not None:
                counts = [(int(x), int(k)) for x, k in zip(open_.nodes, open_.links, strict=True) if k]
                yield from batch_of(counts, open_.edges)
            open_ = None
            home.clear()

        for batch in batches:
            columns = [batch.column(x).to_pylist() for x in (*keys, "lives", "node", "copies", "x")]
            for *own, lives, node, copies, x in zip(*columns, strict=True):
                if own != key:
                    if key is not None:
                        yield from close(key[1])
                    key = own
                (home if lives else guests).append((node, copies, x))
                if len(guests) >= BLOCK:
                    yield from settle(key[1])
        if key is not None:
            yield from close(key[1])

    # Those that live in a cell come first.
    met = stage(
        spread.repartition(*keys)
        .sortWithinPartitions(*keys, F.col("lives").desc())
        .mapInArrow(compare, "a long, b long, links long"),
        "vector-links",
    )
    totals = met.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    return totals, components(met.where("b is not null").select("a", "b"))
