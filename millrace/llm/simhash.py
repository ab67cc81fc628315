"""Near-duplicates by SimHash fingerprints and the generalised pigeonhole principle."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import renamed, tune, whole
from millrace.llm.components import components
from millrace.staging import stage

BITS = 64
#: Shingle hashes whose bits are unpacked at a time.
AT_ONCE = 1 << 15
#: What a probe row and a comparison cost against each other in the allocation of
#: thresholds: a row is hashed, shuffled and sorted, a comparison is two machine words.
ROW_COST, PAIR_COST = 1.0, 0.002
#: Fingerprints that are compared as one bucket. Larger buckets are split by further bits.
BUCKET = 20_000
#: Groups up to this size are compared for a whole batch at once.
SMALL = 16

#: Odd multipliers that derive further hashes from a shingle's first one.
MORE_HASHES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _mixed(h: np.ndarray, by: int) -> np.ndarray:
    h = h * np.uint64(by)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _majority(hashes: np.ndarray, words: int) -> np.ndarray:
    """The fingerprint words of a text's shingle hashes: bits set in over half of them."""
    count = np.zeros((words, BITS), np.int64)
    for at in range(0, len(hashes), AT_ONCE):
        h = hashes[at : at + AT_ONCE]
        for k in range(words):
            own = h if k == 0 else _mixed(h, MORE_HASHES[k - 1])
            bits = np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            count[k] += bits.sum(0, dtype=np.int64)
    return np.packbits(count * 2 > len(hashes), axis=1, bitorder="little").view(np.uint64)[:, 0]


#: A-Z to a-z, all other bytes as they are.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: str, shingle: int, seed: int = 42) -> np.ndarray:
    words = text.encode().translate(LOWER).split()
    if len(words) >= shingle:
        rows = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    else:
        rows = [b" ".join(words)] if words else []
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(x, seed) for x in rows), np.uint64)


def fingerprints(
    docs: DataFrame, shingle: int = 3, words: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, f0, ... as signed longs): one majority fingerprint of 64 bits per word. f0 is
    that of XXH64 with seed 42; further ones are from hashes derived from it. Null and
    wordless texts get zero."""
    tune(docs.sparkSession)
    names = [f"f{k}" for k in range(words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros((batch.num_rows, words), np.uint64)
            for row, text in enumerate(batch.column("text").to_pylist()):
                hashes = shingle_hashes(text, shingle)
                if len(hashes):
                    found[row] = _majority(hashes, words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(found[:, k].view(np.int64)) for k in range(words))],
                names=["id", *names],
            )

    source = renamed(docs, id=id_col, text=text_col).select("id", whole("text").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, " + ", ".join(f"{n} long" for n in names))


@dataclass(frozen=True)
class Probe:
    """Fingerprints meet if they agree on the bits of ``mask``; two that meet may differ
    in ``left`` of the other bits at most."""

    mask: int

    @property
    def signed(self) -> int:
        return self.mask - (1 << 64) if self.mask >> 63 else self.mask


def bit_agreement(fps: DataFrame, column: str = "f0") -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for each two bits the share of pairs of them that agree
    in both; summed over all rows, 64 x 64 counts a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(own, axis=1, bitorder="little").astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
            n += len(bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BITS * BITS + 1)), pa.array(np.append(total.ravel(), n))], names=["cell", "n"]
        )

    counts = fps.select(column).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    both = np.zeros(BITS * BITS + 1, np.int64)
    for cell, n in counts.collect():  # 4,097 rows whatever the input
        both[cell] = n
    n, both = int(both[-1]), both[:-1].reshape(BITS, BITS) / max(1, both[-1])
    one = np.diag(both)
    cells = both, one[:, None] - both, one[None, :] - both, 1 - one[:, None] - one[None, :] + both
    return n, sum(x * x for x in cells)


def _correlated(agree: np.ndarray, widths: list[int]) -> list[list[int]]:
    """Bits in groups of the given widths, each begun with a free bit and filled with those
    whose agreement with its last one exceeds chance the most."""
    single = np.diag(agree)
    excess = agree / np.maximum(np.outer(single, single), 1e-12)
    free, groups = list(range(BITS)), []
    for width in widths:
        group = [max(free, key=lambda b: (max((excess[b, c] for c in free if c != b), default=0), -b))]
        free.remove(group[0])
        while len(group) < width:
            group.append(max(free, key=lambda b: (excess[group[-1], b], -b)))
            free.remove(group[-1])
        groups.append(group)
    return groups


def _chance(bits: list[int], agree: np.ndarray) -> float:
    """Share of pairs that agree on all bits, by a chain of neighbours' agreements."""
    if not bits:
        return 1.0
    single = np.diag(agree)
    p = single[bits[0]]
    for x, y in zip(bits, bits[1:], strict=False):
        p *= min(1.0, agree[x, y] / max(single[x], 1e-12))
    return float(p)


def allocate(n: int, agree: np.ndarray, radius: int) -> list[Probe]:
    """The probes that find all pairs within ``radius`` bits at the least estimated cost.

    Of m partitions with thresholds that sum to radius - m + 1, two such fingerprints are
    within the threshold of one at least; a threshold of -1 leaves a partition out. Being
    within t on a partition means agreeing on it but for some t bits, so its probes are
    its bits less each choice of t. For every m a dynamic programme over partitions picks
    the thresholds.
    """
    best: tuple[float, list[Probe]] | None = None
    for m in range(1, min(BITS, radius + 3) + 1):
        widths = [BITS // m + (k < BITS % m) for k in range(m)]
        groups = _correlated(agree, widths)
        goal = radius - m + 1
        plans: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for group in groups:
            costs = {-1: 0.0}
            for t in range(0, min(radius, len(group) - 1) + 1):
                masks = list(combinations(range(len(group)), t))
                if len(masks) > 500:
                    break
                meet = sum(_chance([b for k, b in enumerate(group) if k not in x], agree) for x in masks)
                costs[t] = ROW_COST * n * len(masks) + PAIR_COST * n * n / 2 * meet
            after: dict[int, tuple[float, tuple[int, ...]]] = {}
            for total, (cost, chosen) in plans.items():
                for t, more in costs.items():
                    option = (cost + more, (*chosen, t))
                    if total + t not in after or option < after[total + t]:
                        after[total + t] = option
            plans = after
        if goal not in plans:
            continue
        cost, chosen = plans[goal]
        if best is None or cost < best[0]:
            probes = [
                Probe(sum(1 << b for k, b in enumerate(group) if k not in x))
                for group, t in zip(groups, chosen, strict=True)
                if t >= 0
                for x in combinations(range(len(group)), t)
            ]
            best = (cost, probes)
    return best[1]


def _split(mask: int, radius: int) -> list[Probe]:
    """What a bucket too large is split by: its bits, and one of radius + 1 groups of the
    others, of which one at least has no differing bit."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    parts = min(len(free), radius + 1)
    return [Probe(mask | sum(1 << b for b in free[k::parts])) for k in range(parts)]


def _linked(x: np.ndarray, y: np.ndarray, radius: int, far: int | None) -> np.ndarray:
    """Whether rows of words are within ``radius`` bits in the first word and, if ``far`` is
    given, within ``far`` in all of them."""
    first = np.bitwise_count(x[..., 0] ^ y[..., 0])
    near = first <= radius
    if far is not None and near.any():
        at = np.nonzero(near)
        rows = np.broadcast_to(x, (*near.shape, x.shape[-1]))[at]
        others = np.broadcast_to(y, (*near.shape, y.shape[-1]))[at]
        near[at] = np.bitwise_count(rows ^ others).sum(-1) <= far
    return near


def _forest(words: np.ndarray, radius: int, far: int | None) -> list[tuple[int, int]]:
    """Links that join what the links of a bucket join, at most one less than its rows."""
    label = np.arange(len(words))
    links = []
    step = max(1, (1 << 20) // len(words))
    for at in range(0, len(words), step):
        near = _linked(words[at : at + step, None], words[None, at:], radius, far)
        for i, row in enumerate(near, at):
            others = np.flatnonzero(row) + at
            own = label[others]
            while (new := np.flatnonzero(own != label[i])).size:
                links.append((i, int(others[new[0]])))
                low, high = sorted((label[i], own[new[0]]))
                label[label == high] = low
                own = label[others]
    return links


def close_pairs(
    nodes: DataFrame, radius: int, words: int = 1, far: int | None = None, bucket: int = BUCKET
) -> DataFrame:
    """(a, b) node ids whose components are those of all pairs of ``nodes`` (node, f0, ...)
    within ``radius`` bits of f0 and ``far`` bits of all words.

    Every bucket emits a forest of its links, not all of them. A bucket that exceeds
    ``bucket`` rows is split by further bits, again by pigeonhole, until it fits or all its
    bits agree, so no pair is lost and none is compared outside of a bounded task.
    """
    names = [f"f{k}" for k in range(words)]
    n, agree = bit_agreement(nodes)
    found: list[DataFrame] = []
    rows, probes = nodes.withColumn("probe", F.lit(-1)), {-1: allocate(n, agree, radius)}

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = []

        def linked(table: np.ndarray) -> Iterator[pa.RecordBatch]:
            key, node, own = table[:, :2], table[:, 2], table[:, 3:].view(np.uint64)
            starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(1)))
            lengths = np.diff(np.append(starts, len(key)))
            group = np.repeat(np.arange(len(starts)), lengths)
            size = lengths[group]
            pairs = [np.zeros((0, 2), np.int64)]
            small = np.flatnonzero((size > 1) & (size <= SMALL))
            for d in range(1, SMALL):
                i = small[small + d < len(group)]
                i = i[group[i] == group[i + d]]
                if not len(i):
                    break
                i = i[_linked(own[i], own[i + d], radius, far)]
                pairs.append(np.stack([node[i], node[i + d]], 1))
            for at, length in zip(starts[lengths > SMALL], lengths[lengths > SMALL], strict=True):
                links = np.array(_forest(own[at : at + length], radius, far), np.int64).reshape(-1, 2)
                pairs.append(node[at : at + length][links])
            out = np.concatenate(pairs)
            if len(out):
                yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["a", "b"])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            rest.append(
                np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], 1)
            )
            last = rest[-1]
            # All but the batch's last bucket is complete.
            begun = np.flatnonzero((last[:, :2] != last[-1, :2]).any(1))
            if len(begun):
                cut = begun[-1] + 1
                table = np.concatenate([*rest[:-1], last[:cut]])
                rest = [last[cut:]]
                yield from linked(table)
        if rest:
            yield from linked(np.concatenate(rest))

    while True:
        # A probe's masks stand in the plan as literals: some dozens, whatever the input.
        number, masks, follow = 0, [], {}
        for old, own in probes.items():
            for probe in own:
                masks.append((old, number, probe))
                follow[number] = probe
                number += 1
        table = F.array(
            *[
                F.struct(F.lit(old).alias("old"), F.lit(k).alias("probe"), F.lit(p.signed).cast("long").alias("mask"))
                for old, k, p in masks
            ]
        )
        keyed = rows.withColumnRenamed("probe", "was").withColumn("m", F.explode(F.filter(table, lambda x: x["old"] == F.col("was"))))
        keyed = keyed.select(
            F.col("m.probe").alias("probe"), F.col("f0").bitwiseAND(F.col("m.mask")).alias("key"), "node", *names
        )
        large = stage(keyed.groupBy("probe", "key").count().where(F.col("count") > bucket).select("probe", "key"), "large-buckets")
        again = sorted(x[0] for x in large.select("probe").distinct().collect())  # at most one per probe
        again = [k for k in again if bin(follow[k].mask).count("1") < BITS]
        if again:
            splittable = large.where(F.col("probe").isin(again))
            fits = keyed.join(splittable, ["probe", "key"], "left_anti")
        else:
            fits = keyed
        grouped = fits.repartition("probe", "key").sortWithinPartitions("probe", "key")
        found.append(stage(grouped.mapInArrow(link, "a long, b long"), "close-pairs"))
        if not again:
            break
        rows = stage(keyed.join(splittable, ["probe", "key"], "left_semi").select("probe", "node", *names), "large-rows")
        probes = {k: _split(follow[k].mask, radius) for k in again}
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def simhash_groups(
    docs: DataFrame,
    shingle: int = 3,
    radius: int = 2,
    words: int = 1,
    far: int | None = None,
    bucket: int = BUCKET,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, f0, ..., component_id) for every row: the smallest id that links reach.

    Documents whose fingerprints differ in ``radius`` bits at most are linked. With more
    words than one, all words together may differ in ``far`` bits at most. Equal
    fingerprints collapse to one node, named by their smallest id, before anything is
    compared; a third of all rows may be copies. Null ids form no node: such a row gets
    its fingerprint's component. Repeated rows stay. Ids must be whole numbers.
    """
    names = [f"f{k}" for k in range(words)]
    prints, nodes, links = _search(docs, shingle, radius, words, far, bucket, id_col, text_col)
    joined = components(links)
    classes = nodes.join(joined, "node", "left").select(*names, F.coalesce("component", "node").alias("component_id"))
    return prints.join(classes, names).select(F.col("id").alias(id_col), *names, "component_id")


def simhash_links(
    docs: DataFrame, shingle: int = 3, radius: int = 2, bucket: int = BUCKET, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(a, b) ids, a above b, that join what ``simhash_groups`` joins: each id to the smallest
    of its fingerprint, and these by the links found. There are at most so many as rows and
    probes, not as pairs."""
    prints, nodes, links = _search(docs, shingle, radius, 1, None, bucket, id_col, text_col)
    copies = prints.join(nodes, "f0").where("id > node").select(F.col("id").cast("long").alias("a"), F.col("node").alias("b"))
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).unionByName(copies).distinct()


def _search(
    docs: DataFrame, shingle: int, radius: int, words: int, far: int | None, bucket: int, id_col: str, text_col: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Each row's fingerprint, the different fingerprints with their smallest ids, and links
    between these."""
    names = [f"f{k}" for k in range(words)]
    prints = stage(fingerprints(docs, shingle, words, id_col, text_col), "fingerprints")
    nodes = stage(prints.groupBy(*names).agg(F.min("id").cast("long").alias("node")), "fingerprint-nodes")
    return prints, nodes, close_pairs(nodes.where("node is not null"), radius, words, far, bucket)
