"""Near-duplicates at an exact Jaccard similarity of shingles.

Links that a search by fingerprints suggests are checked first. The prefix principle then finds
all that such a search misses, and compares only what is not of one group by then.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import drop_shuffles, renamed, tune, whole
from millrace.llm.components import components
from millrace.llm.simhash import shingle_hashes
from millrace.staging import fresh_path, stage, staging

#: Shingles that are told apart as frequent. No result depends on which they are.
FREQUENT = 500_000
#: Bytes of text that a worker is handed, and those among which shingles must repeat to be counted.
BATCH_BYTES, COUNTED_BYTES = 2 << 20, 8 << 20
#: Pivots a key has in the first round, and how many times as many in each further one.
PIVOTS, MORE_PIVOTS = 1, 16
#: Sets of a key that are all compared to each other at once.
SMALL = 16
#: Parts that pairs are compared in one after another, by their smaller sets: only one part's
#: sets are in shuffle files at a time. And pairs that need no parts.
PARTS, FEW_PAIRS = 4, 10_000
#: Words of 64 bits of a set's parities: whether an even or odd number of its shingles fall into
#: each of 1,024 places. Sets differ in as many shingles at least as in parities.
PARITIES = 16
BITS = [f"p{k}" for k in range(PARITIES)]
#: Places a shingle of a larger set's own parities, which do not fill up as 1,024 do, and the
#: most of a set.
PLACES_A_SHINGLE, MOST_PLACES = 4, 1 << 20


def _shingles(text: str, shingle: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, shingle).view(np.int64))


def _name(hashes: np.ndarray) -> int:
    """64 bits that tell sets apart, as their shingles are told apart; never null."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def _names(source: DataFrame, shingle: int) -> DataFrame:
    """(id, node, n, wide, p0, p1, ...): the name of each row's set of shingles, its size, its
    parities, and of larger sets more parities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_shingles(x, shingle) for x in batch.column("text").to_pylist()]
            bits = np.array([parities(x) for x in sets], np.int64).reshape(-1, PARITIES)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array([_name(x) for x in sets], pa.int64()), pa.array([len(x) for x in sets], pa.int32()),
                    pa.array([_wide(x) for x in sets], pa.binary()), *map(pa.array, bits.T),
                ],
                names=["id", "node", "n", "wide", *BITS],
            )

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, node long, n int, wide binary, " + ", ".join(f"{x} long" for x in BITS))


def parities(hashes: np.ndarray, places: int = 64 * PARITIES) -> np.ndarray:
    """Whether an even or odd number of shingles fall into each of so many places, a power of
    two; half as many places are the two halves' exclusive or."""
    count = np.bincount((hashes >> 10) & (places - 1), minlength=places)
    return np.packbits((count & 1).astype(np.uint8), bitorder="little").view(np.int64)


def _wide(hashes: np.ndarray) -> bytes | None:
    places = min(MOST_PLACES, 1 << (max(1, PLACES_A_SHINGLE * len(hashes)) - 1).bit_length())
    return parities(hashes, places).tobytes() if places > 64 * PARITIES else None


def differing(a: bytes, b: bytes) -> int:
    """Parities that differ, at the fewer places of the two."""
    x, y = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _sets(named: DataFrame, shingle: int) -> DataFrame:
    """(node, hashes) of the rows (node, text) whose text has that name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_shingles(x, shingle) for x in batch.column("text").to_pylist()]
            own = [(node, x) for node, x in zip(batch.column("node").to_pylist(), sets, strict=True) if _name(x) == node]
            offsets = pa.array(np.cumsum([0, *(len(x) for _, x in own)]).astype(np.int32))
            flat = pa.array(np.concatenate([np.zeros(0, np.int64), *(x for _, x in own)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in own], pa.int64()), pa.ListArray.from_arrays(offsets, flat)], names=["node", "hashes"]
            )

    return named.mapInArrow(run, "node long, hashes array<long>")


def _frequent(source: DataFrame, shingle: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The upper halves of the most frequent shingles, in order, and their counts' powers of
    two: all those of at least the smallest power that leaves ``most`` of them.

    Whatever occurs once among the different sets of some batches of texts is not counted there:
    nearly all shingles are such, while a frequent one is met several times in many batches.
    """

    def counted(uppers: dict[int, np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate([np.zeros(0, np.int32), *uppers.values()]), return_counts=True)
        keys, n = keys[n > 1], n[n > 1]
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], names=["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uppers, size = {}, 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                hashes = _shingles(text, shingle)
                uppers[_name(hashes)] = (hashes >> 32).astype(np.int32)
            size += batch.nbytes
            if size >= COUNTED_BYTES:
                yield counted(uppers)
                uppers, size = {}, 0
        yield counted(uppers)

    counts = source.select("text").mapInArrow(run, "key int, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = stage(counts.where("n > 8"), "shingle-counts")
    # A row for each power of two.
    sizes = counts.groupBy(F.floor(F.log2("n")).alias("power")).count().collect()
    least, total = 1 << 62, 0
    for power, n in sorted(sizes, reverse=True):
        total += n
        if total > most:
            break
        least = 1 << power
    found = counts.where(F.col("n") >= least).select("key", F.floor(F.log2("n")).cast("int").alias("power")).toArrow()
    keys, powers = (found.column(k).to_numpy() for k in range(2))
    order = np.argsort(keys)
    return keys[order], powers[order]


def _prefixes(source: DataFrame, shingle: int, threshold: float, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(key, node, n, at): of each set the first n - ceil(threshold n) + 1 shingles, rare ones
    before frequent ones, these by their frequency, and else by hash. Two sets as similar as
    the threshold share one of them, whatever the order."""
    known = source.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, powers = known.value
        for batch in batches:
            # Equal sets are one node; a batch sends it once.
            sets = {_name(x): x for x in (_shingles(x, shingle) for x in batch.column("text").to_pylist())}
            n = np.array([len(x) for x in sets.values()], np.int64)
            flat = np.concatenate([np.zeros(0, np.int64), *sets.values()])
            row = np.repeat(np.arange(len(n)), n)
            late = np.zeros(len(flat), np.int64)
            if len(last):
                upper = flat >> 32
                at = np.minimum(np.searchsorted(last, upper), len(last) - 1)
                late = np.where(last[at] == upper, powers[at], 0)
            # The hashes of a row are in order already.
            order = np.argsort(64 * row + late, kind="stable")
            at = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
            own = at < (n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1)[row]
            row = row[own]
            node = np.array(list(sets), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(flat[order][own]), pa.array(node[row]),
                    pa.array(n[row].astype(np.int32)), pa.array(at[own].astype(np.int32)),
                ],
                names=["key", "node", "n", "at"],
            )

    return source.select("text").mapInArrow(run, "key long, node long, n int, at int")


def _possible(threshold: float) -> Column:
    """Whether two sets that share a key can be as similar, by their sizes and by what
    stands before and behind it."""
    n, m = F.col("n"), F.col("pivot_n")
    common = F.least("at", "pivot_at") + F.least(n - F.col("at"), m - F.col("pivot_at"))
    by_size = F.least(n, m) / F.greatest(n, m) >= threshold
    return by_size & (common >= threshold / (1 + threshold) * (n + m) - 1e-6)


def _alike(threshold: float) -> Column:
    """Whether two sets that share a key can be as similar, by their parities."""
    differ = reduce(add, [F.bit_count(F.col(x).bitwiseXOR(F.col(f"pivot_{x}"))) for x in BITS])
    return differ <= (1 - threshold) / (1 + threshold) * (F.col("n") + F.col("pivot_n")) + 1e-6


def _similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs (a, b) whose sets are as similar as the threshold, exactly. No other
    sets are shuffled."""
    sets = sets.join(_ends(pairs), "node", "left_semi")
    sides = [sets.select(F.col("node").alias(x), F.col("hashes").alias(f"of_{x}")) for x in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    common = both.select("a", "b", F.size(F.array_intersect("of_a", "of_b")).alias("k"), (F.size("of_a") + F.size("of_b")).alias("n"))
    return common.where(F.col("k") / (F.col("n") - F.col("k")) >= threshold).select("a", "b")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _narrowed(pairs: DataFrame, names: DataFrame, threshold: float) -> DataFrame:
    """The pairs that can be as similar, by the parities that larger sets have of their own."""
    wide = names.where("wide is not null").join(_ends(pairs), "node", "left_semi").dropDuplicates(["node"])
    sides = [wide.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("wide").alias(f"of_{x}")) for x in "ab"]
    share = (1 - threshold) / (1 + threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, x, y = (batch.column(c).to_pylist() for c in ("n_a", "n_b", "of_a", "of_b"))
            near = [
                p is None or q is None or differing(p, q) <= share * (i + j) + 1e-6
                for i, j, p, q in zip(n, m, x, y, strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return pairs.join(sides[0], "a", "left").join(sides[1], "b", "left").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, source: DataFrame, names: DataFrame, nodes: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """Those of the pairs whose sets are as similar as the threshold. Only sets of pairs that no
    parities rule out are gathered."""
    pairs = stage(_narrowed(pairs, names, threshold), "close")
    # Staged, so that its size is known: where it is small, no text is shuffled.
    compared = stage(nodes.join(_ends(pairs), "node", "left_semi").where("id is not null").select("node", "id"), "compared")
    sets = stage(_sets(source.join(compared, "id").select("node", "text"), shingle), "sets")
    parts = PARTS if pairs.count() > FEW_PAIRS else 1
    found = []
    for part in range(parts):
        own = pairs.where(F.pmod(F.xxhash64("b"), F.lit(parts)) == part) if parts > 1 else pairs
        found.append(stage(_similar(own, sets, threshold), "near"))
        drop_shuffles(pairs.sparkSession)
    return reduce(DataFrame.unionByName, found)


def links(
    source: DataFrame, names: DataFrame, nodes: DataFrame, shingle: int, threshold: float, frequent: int, first: DataFrame | None = None
) -> DataFrame:
    """(node, component) for the sets that some other one is linked to, but the smallest.

    The pairs ``first`` (a, b) are compared at once, and what they link is never compared again.
    Then a small key's sets are all compared. Others are compared to the key's pivots, its smallest nodes, and what is of one component
    by then is never compared again: a large group of near copies costs a comparison for each
    of them. Pivots leave their keys, the others go on with more pivots until each key's sets
    are of one component or all compared. Pairs that parities rule out are not compared; from
    the second round on rows carry their parities, so that of a key's sets that are alike but
    not enough, hardly a pair is written.
    """
    spark = source.sparkSession
    tested = found = joined = None
    if first is not None:
        tested = stage(_bounded(first, nodes, threshold), "suggested")
        found = _verified(tested, source, names, nodes, shingle, threshold)
        joined = components(found)
        drop_shuffles(spark)
    prefixes = _prefixes(source, shingle, threshold, _frequent(source, shingle, frequent))
    # One shuffle finds the keys that several sets have; few rows are left of it.
    key = Window.partitionBy("key")
    ends = prefixes.withColumn("low", F.min("node").over(key)).withColumn("high", F.max("node").over(key))
    ends = ends.withColumn("size", F.count("*").over(key)).where("low < high")
    rows = ends.select("key", "node", "n", "at", F.col("node").alias("component"), "size").distinct()
    rows, pivots_a_key, bits = stage(rows, "keyed"), PIVOTS, []
    del prefixes, ends
    drop_shuffles(spark)
    if joined is not None:
        rows = _mixed_keys(_labelled(rows, joined), None)
        drop_shuffles(spark)
    while not rows.isEmpty():
        order = F.row_number().over(Window.partitionBy("key").orderBy("node"))
        head = rows.withColumn("order", order).where(F.col("order") <= max(SMALL, pivots_a_key))
        head = head.where((F.col("order") <= pivots_a_key) | (F.col("size") <= SMALL))
        pivots = stage(head.select("key", *[F.col(c).alias(f"pivot_{c}") for c in ("node", "n", "at", "component", *bits)]), "pivots")
        other = (F.col("node") > F.col("pivot_node")) & (F.col("component") != F.col("pivot_component")) & _possible(threshold)
        pairs = rows.join(pivots, "key").where(other & _alike(threshold) if bits else other)
        pairs = pairs.select(F.col("node").alias("a"), F.col("pivot_node").alias("b")).distinct()
        if not bits:
            pairs = _bounded(pairs, nodes, threshold)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        near = _verified(pairs, source, names, nodes, shingle, threshold)
        found = near if found is None else found.unionByName(near)
        joined = components(found)
        last = pivots.groupBy("key").agg(F.max("pivot_node").alias("last"))
        rest = rows.join(last, "key").where("node > last").drop("last")
        rows = _mixed_keys(_labelled(rest, joined), nodes if not bits else None)
        pivots_a_key, bits = pivots_a_key * MORE_PIVOTS, BITS
        drop_shuffles(spark)
    if joined is None:
        return rows.select("node", "component")
    return joined


def _bounded(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs that can be as similar, by their sets' parities."""
    known = nodes.select("node", "n", *BITS)
    other = known.select(*[F.col(c).alias(f"pivot_{c}") for c in known.columns])
    both = pairs.join(known, F.col("a") == F.col("node")).join(other, F.col("b") == F.col("pivot_node"))
    return both.where(_alike(threshold)).select("a", "b")


def _labelled(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """The rows with the components that their nodes are of by now."""
    return rows.drop("component").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _mixed_keys(rows: DataFrame, nodes: DataFrame | None) -> DataFrame:
    """The rows of those keys that have more than one component, with their sets' parities
    if the nodes are given."""
    ends = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = rows.join(ends.where("low < high"), "key", "left_semi")
    return stage(mixed if nodes is None else mixed.join(nodes.select("node", *BITS), "node"), "keyed")


def jaccard_groups(
    docs: DataFrame,
    shingle: int,
    threshold: float,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: int = FREQUENT,
    first: DataFrame | None = None,
) -> DataFrame:
    """(id, component_id) for every row: the smallest id that links reach.

    Documents whose sets of shingles (by 64-bit hashes) have a Jaccard similarity of
    ``threshold`` or more are linked, all of them and no others. Equal sets are one node, so
    null and wordless texts are one group. Null ids form no node: such a row gets its set's
    component. Repeated rows stay. Ids must be whole numbers. Links (a, b) between ids that
    another search suggests may be given as ``first``: they are checked as all others are, and
    spare the comparisons of what they link.
    """
    spark = docs.sparkSession
    tune(spark, BATCH_BYTES)
    source = renamed(docs, id=id_col, text=text_col).select("id", whole("text").alias("text"))
    path = fresh_path(spark, "jaccard-groups")
    with staging(spark):
        names = stage(_names(source, shingle), "set-names")
        bits = [F.first(x).alias(x) for x in ("n", *BITS)]
        nodes = stage(names.groupBy("node").agg(F.min("id").alias("id"), *bits), "set-nodes")
        if first is not None:
            # Of rows that share an id one stands for it: no link has to be found here.
            known = names.where("id is not null").groupBy("id").agg(F.min("node").alias("node"))
            sides = [known.select(F.col("id").alias(x), F.col("node").alias(f"of_{x}")) for x in "ab"]
            pairs = first.join(sides[0], "a").join(sides[1], "b").where("of_a <> of_b")
            first = pairs.select(F.greatest("of_a", "of_b").alias("a"), F.least("of_a", "of_b").alias("b")).distinct()
        joined = links(source, names, nodes, shingle, threshold, frequent, first)
        own = nodes.join(joined, "node", "left").select("node", "id", F.coalesce("component", "node").alias("component"))
        least = own.groupBy("component").agg(F.min("id").cast("long").alias("component_id"))
        out = names.select("id", "node").join(own.drop("id"), "node").join(least, "component").select(F.col("id").alias(id_col), "component_id")
        out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)
