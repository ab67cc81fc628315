"""Ranked lexical search by Block-Max MaxScore over an index of segments.

A segment is an inverted index of some MB of documents, built where they are read: per term a
list of postings in compressed blocks, and per block the greatest frequency and the least
length, which bound what any of its documents can score whatever the corpus's figures turn
out to be. A search reads the lists of its terms only. In each segment the terms' global
bounds part essential lists from others; only documents of essential lists are candidates,
block maxima of the others reject most of them before a block is decompressed, and the
segments' best documents are merged.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import renamed, tune, whole
from millrace.staging import fresh_path, stage, staging

#: Bytes of text in a segment; a longer text is a segment of its own.
SEGMENT_BYTES = 8 << 20
#: Postings of a block.
BLOCK = 128
#: Documents of a segment that are ranked at a time, at first; later windows are larger, as
#: the best documents so far reject more.
WINDOW = 256
#: Queries that share a reading of a segment's lists.
TOGETHER = 256
#: Bytes of a text that are cut into terms at a time.
CUT_BYTES = 1 << 20

#: The bytes that are no part of a term become spaces, A-Z become a-z.
FOLDED = bytes(
    32 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b
    for b in range(256)
)
#: The row of a segment that holds its documents instead of a term's list.
DOCUMENTS = ""

_INDEX = (
    "segment long, term string, n int, total long, most int, least long, last array<int>, block_most array<int>,"
    " block_least array<long>, stop array<int>, postings binary, ids array<{}>, lengths array<long>"
)


# ---------------------------------------------------------------------------- postings


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time."""
    folded, at = text.translate(FOLDED), 0
    while at < len(folded):
        # No term is cut: a stretch ends at a space.
        end = folded.find(b" ", at + CUT_BYTES)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes of seven bits, the lowest first, and how many bytes each takes."""
    values = values.astype(np.uint64)
    width = np.ones(len(values), np.int64)
    for k in range(1, 10):
        width += values >= np.uint64(1) << np.uint64(7 * k)
    row = np.repeat(np.arange(len(values)), width)
    place = np.arange(len(row)) - np.repeat(np.cumsum(width) - width, width)
    low = (values[row] >> (7 * place).astype(np.uint64)).astype(np.uint8) & 127
    return low | ((place < width[row] - 1).astype(np.uint8) << 7), width


def unpacked(data: np.ndarray) -> np.ndarray:
    last = data < 128
    stops = np.flatnonzero(last)
    first = np.concatenate([[0], stops[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(first, stops - first + 1)
    parts = (data & 127).astype(np.int64) << 7 * place
    return np.add.reduceat(parts, first) if len(first) else np.zeros(0, np.int64)


class Segment:
    """Documents as they come, to be indexed together."""

    def __init__(self):
        self.numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.ids: list = []
        self.lengths: list[int] = []
        self.size = 0
        self.own: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, id_, text: bytes) -> None:
        number, found, length = self.numbers, [], 0
        for terms in terms_of(text):
            ids = np.fromiter(map(number.__getitem__, terms), np.int64, len(terms))
            length += len(ids)
            found.append(np.unique(ids, return_counts=True))
        if len(found) > 1:
            keys = np.concatenate([x for x, _ in found])
            ids, at = np.unique(keys, return_inverse=True)
            found = [(ids, np.bincount(at, np.concatenate([n for _, n in found])).astype(np.int64))]
        self.own.append(found[0] if found else (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        self.ids.append(id_)
        self.lengths.append(length)
        self.size += len(text)

    def rows(self, segment: int, id_type: pa.DataType) -> pa.RecordBatch:
        """The segment's lists, by term, after the row of its documents. Documents are numbered
        in the order of their ids, null first."""
        order = sorted(range(len(self.ids)), key=lambda k: (self.ids[k] is not None, self.ids[k] if self.ids[k] is not None else 0))
        lengths = np.array(self.lengths, np.int64)[order]
        term = np.concatenate([np.zeros(0, np.int64), *(self.own[k][0] for k in order)])
        often = np.concatenate([np.zeros(0, np.int64), *(self.own[k][1] for k in order)])
        doc = np.repeat(np.arange(len(order)), [len(self.own[k][0]) for k in order])
        by_term = np.argsort(term, kind="stable")
        term, often, doc = term[by_term], often[by_term], doc[by_term]
        n = np.bincount(term, minlength=len(self.numbers))
        first = np.cumsum(n) - n
        # A block starts with each list, and after every BLOCK postings of it.
        place = np.arange(len(term)) - np.repeat(first, n)
        starts = np.flatnonzero(place % BLOCK == 0)
        blocks = -(-n // BLOCK)
        ends = np.append(starts[1:], len(term)) if len(starts) else starts
        gap = doc - np.where(place % BLOCK == 0, 0, np.concatenate([[0], doc[:-1]]))[: len(doc)]
        data, width = packed(np.stack([gap, often], 1).ravel())
        stop = np.cumsum(width.reshape(-1, 2).sum(1))
        list_stop = stop[first + n - 1] if len(n) else stop
        in_list = stop[ends - 1] - np.repeat(np.concatenate([[0], list_stop[:-1]])[: len(n)], blocks) if len(starts) else starts
        most, least = (np.maximum.reduceat(often, starts), np.minimum.reduceat(lengths[doc], starts)) if len(starts) else (starts, starts)
        offsets = pa.array(np.concatenate([[0], np.cumsum(blocks)]).astype(np.int32))
        listed = lambda x, kind: pa.ListArray.from_arrays(offsets, pa.array(x, kind))
        cuts = np.concatenate([[0], list_stop]).astype(np.int64)
        flat = data.tobytes()
        whole_most = np.maximum.reduceat(often, first) if len(n) else first
        whole_least = np.minimum.reduceat(lengths[doc], first) if len(n) else first
        lists = pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(n), segment)), pa.array([x.decode() for x in self.numbers], pa.string()),
                pa.array(n, pa.int32()), pa.array(np.zeros(len(n), np.int64)), pa.array(whole_most, pa.int32()),
                pa.array(whole_least, pa.int64()), listed(doc[ends - 1] if len(starts) else starts, pa.int32()),
                listed(most, pa.int32()), listed(least, pa.int64()), listed(in_list, pa.int32()),
                pa.array([flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                pa.nulls(len(n), pa.list_(id_type)), pa.nulls(len(n), pa.list_(pa.int64())),
            ],
            names=NAMES,
        )
        with_terms = int((lengths > 0).sum())
        documents = pa.RecordBatch.from_arrays(
            [
                pa.array([segment]), pa.array([DOCUMENTS]), pa.array([with_terms], pa.int32()), pa.array([int(lengths.sum())]),
                pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.int32())),
                pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.binary()),
                pa.array([[self.ids[k] for k in order]], pa.list_(id_type)), pa.array([lengths.tolist()], pa.list_(pa.int64())),
            ],
            names=NAMES,
        )
        return pa.concat_batches([documents, lists])


NAMES = "segment term n total most least last block_most block_least stop postings ids lengths".split()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index as rows to be written: one per segment and term, and one per segment for its
    documents. Nothing is shuffled. A segment takes its number from the task that made it."""
    tune(docs.sparkSession)
    source = renamed(docs, id=id_col, text=text_col).select("id", whole("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, segment, kind = TaskContext.get().partitionId() << 32, Segment(), None
        for batch in batches:
            kind = batch.schema.field("id").type
            for id_, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                segment.add(id_, text.as_buffer().to_pybytes() if text.is_valid else b"")
                if segment.size >= SEGMENT_BYTES:
                    yield segment.rows(number, kind)
                    number, segment = number + 1, Segment()
        if segment.ids:
            yield segment.rows(number, kind)

    return source.mapInArrow(run, _INDEX.format(source.schema["id"].dataType.simpleString()))


# ------------------------------------------------------------------------------ search


class PostingList:
    """A term's list in a segment. Blocks are decompressed when they are asked for, once."""

    def __init__(self, row: dict):
        self.last = np.array(row["last"], np.int64)
        self.block_most, self.block_least = row["block_most"], row["block_least"]
        self.stop, self.data = [0, *row["stop"]], np.frombuffer(row["postings"], np.uint8)
        self.bound = row["bound"]
        self.opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and frequencies of a block."""
        if k not in self.opened:
            both = unpacked(self.data[self.stop[k] : self.stop[k + 1]]).reshape(-1, 2)
            self.opened[k] = np.cumsum(both[:, 0]), both[:, 1]
        return self.opened[k]

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """The postings of the documents low to high - 1."""
        a, b = np.searchsorted(self.last, [low, high - 1])
        if a >= len(self.last):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        own = [self.block(k) for k in range(a, min(b, len(self.last) - 1) + 1)]
        docs = np.concatenate([x for x, _ in own])
        often = np.concatenate([x for _, x in own])
        i, j = np.searchsorted(docs, [low, high])
        return docs[i:j], often[i:j]


def impact(often, m):
    """What one occurrence-weighted term adds for each unit of weight."""
    return 1_000_000_000 * often // (1_000 * often + 8 * m)


def norms(lengths: list[int], documents: int, total: int) -> np.ndarray:
    """Lengths as the score takes them. The products may need more than 64 bits."""
    return np.array([25 + 75 * n * documents // max(1, total) for n in lengths], np.int64)


class Searcher:
    """Block-Max MaxScore in one segment, for queries over the lists it was given."""

    def __init__(self, lists: list[PostingList], norms_: np.ndarray, norm_of: dict[int, int], k: int):
        self.lists, self.norms, self.k = lists, norms_, k
        self.block_bounds = [
            np.array([impact(f, norm_of[n]) for f, n in zip(x.block_most, x.block_least, strict=True)], np.int64) for x in lists
        ]

    def search(self, query: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """(document, score) of the best documents of a query of (list, weight), best first, of
        equal ones the first."""
        # By global bound: the lists before ``essential`` can't lift a document over the
        # worst of the best so far, all of them together.
        query = sorted(((x, w) for x, w in query if w > 0), key=lambda q: self.lists[q[0]].bound * q[1])
        reach = np.cumsum([0, *(self.lists[x].bound * w for x, w in query)])
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        low, size, n = 0, WINDOW, len(self.norms)
        while low < n:
            high = min(n, low + size)
            worst = int(scores[-1]) if len(scores) == self.k else 0
            essential = int(np.searchsorted(reach, worst, "right")) - 1
            if essential >= len(query):
                break
            own, got = self._window(query, reach, essential, worst, low, high)
            docs, scores = np.concatenate([docs, own]), np.concatenate([scores, got])
            best = np.lexsort((docs, -scores))[: self.k]
            docs, scores = docs[best], scores[best]
            low, size = high, size * 2
        return list(zip(docs.tolist(), scores.tolist(), strict=True))

    def _window(self, query, reach, essential: int, worst: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents low to high - 1 that score above ``worst``, and their scores."""
        partial, met = np.zeros(high - low, np.int64), np.zeros(high - low, bool)
        for x, w in query[essential:]:
            docs, often = self.lists[x].between(low, high)
            partial[docs - low] += w * impact(often, self.norms[docs])
            met[docs - low] = True
        found = np.flatnonzero(met)
        for at in range(essential - 1, -1, -1):
            # Whatever the lists up to this one could add at the most.
            found = found[partial[found] + reach[at + 1] > worst]
            if not len(found):
                break
            x, w = query[at]
            block = np.searchsorted(self.lists[x].last, found + low)
            inside = block < len(self.lists[x].last)
            bound = np.zeros(len(found), np.int64)
            bound[inside] = w * self.block_bounds[x][block[inside]]
            alive = partial[found] + bound + reach[at] > worst
            found, block = found[alive], block[alive]
            for k in np.unique(block[bound[alive] > 0]):
                docs, often = self.lists[x].block(int(k))
                here = found[block == k] + low
                place = np.minimum(np.searchsorted(docs, here), len(docs) - 1)
                hit = docs[place] == here
                partial[here[hit] - low] += w * impact(often[place[hit]], self.norms[here[hit]])
        found = found[partial[found] > worst]
        return found + low, partial[found]


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, term, repeats). Rows of one id are one item."""
    source = renamed(queries, item=id_col, text=text_col).select("item", whole("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, found = batch.column("item"), []
            for k, text in enumerate(batch.column("text")):
                found += [(k, x.decode()) for terms in terms_of(text.as_buffer().to_pybytes()) for x in terms]
            at = pa.array([k for k, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays([items.take(at), pa.array([x for _, x in found], pa.string())], names=["item", "term"])

    kind = source.schema["item"].dataType.simpleString()
    terms = source.mapInArrow(run, f"item {kind}, term string")
    return terms.groupBy("item", "term").agg(F.count("*").alias("repeats"))


def weight(documents: int, df: Column) -> Column:
    return F.floor(1_000 * F.log(F.lit(float(2 * documents + 2)) / (2 * df + 1))).cast("long")


def search(index: DataFrame, queries: DataFrame, k: int = 10, item_col: str = "item_id", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(item, rank, id, score): the best documents of the index for each row of ``queries``.

    The two sides meet on terms. What a query block needs of a segment goes to one task: a
    segment is bounded by ``SEGMENT_BYTES`` and a block by ``TOGETHER`` items, so a term that
    most documents hold is spread over all segments. A segment sends at most ``k`` documents
    an item, and tasks merge theirs before they are shuffled. Items without a term, or of
    terms that no document has, give no rows.
    """
    kind = next(f for f in index.schema if f.name == "ids").dataType.elementType.simpleString()
    sums = index.where(F.col("term") == DOCUMENTS).agg(
        F.sum("n").alias("documents"), F.sum("total").alias("total"), F.count("*").alias("segments")
    ).first()
    documents, total = sums.documents or 0, sums.total or 0
    terms = stage(query_terms(queries, item_col, text_col), "query-terms")
    item_kind = terms.schema["item"].dataType.simpleString()
    blocks = max(1, -(-terms.select("item").distinct().count() // TOGETHER))
    wanted = terms.select("term").distinct()
    lists = stage(index.where(F.col("term") != DOCUMENTS).join(wanted, "term"), "query-lists")
    stats = lists.groupBy("term").agg(F.sum("n").alias("df"), F.max("most").alias("most"), F.min("least").alias("least"))
    norm = F.expr(f"25 + cast(75 as decimal(38, 0)) * least * {documents} div {max(1, total)}")
    bound = F.expr("1000000000L * most div (1000L * most + 8 * norm)")
    stats = stats.withColumn("norm", norm).select("term", weight(documents, F.col("df")).alias("weight"), bound.alias("bound"))
    uses = (
        terms.join(stats, "term")
        .groupBy(F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block"), "term", "bound")
        .agg(F.collect_list(F.struct("item", (F.col("repeats") * F.col("weight")).alias("weight"))).alias("uses"))
    )
    uses = stage(uses, "query-uses")
    kept = ["segment", "term", "last", "block_most", "block_least", "stop", "postings", "ids", "lengths"]
    own = lists.select(*kept).join(uses, "term")
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1).cast("long"))).alias("block")
    docs = index.where(F.col("term") == DOCUMENTS).select(*kept, each)
    # Few bytes are much work here: the engine must not join small partitions.
    tasks = max(1, min(sums.segments * blocks, 4 * index.sparkSession.sparkContext.defaultParallelism))
    both = own.unionByName(docs, allowMissingColumns=True).repartition(tasks, "segment", "block")

    def run(table: pa.Table) -> pa.Table:
        lists, items, lengths, ids = [], {}, [], []
        for row in table.to_pylist():
            if row["term"] == DOCUMENTS:
                lengths, ids = row["lengths"], row["ids"]
                continue
            for use in row["uses"]:
                items.setdefault(use["item"], []).append((len(lists), use["weight"]))
            lists.append(PostingList(row))
        own = norms(lengths, documents, total)
        searcher = Searcher(lists, own, dict(zip(lengths, own.tolist(), strict=True)), k)
        found = [(item, ids[d], s) for item, query in items.items() for d, s in searcher.search(query)]
        names = {"item": table.schema.field("uses").type.value_type.field("item").type, "id": table.schema.field("ids").type.value_type, "score": pa.int64()}
        return pa.table({n: pa.array([x[at] for x in found], t) for at, (n, t) in enumerate(names.items())})

    found = both.groupBy("segment", "block").applyInArrow(run, f"item {item_kind}, id {kind}, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def rank_documents(
    docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """(item, rank, id, score): for each row of ``queries`` (its text in ``text_col`` as well)
    the ``k`` highest-scoring documents with a score above 0, equal scores by ascending id.

    Documents without a term, null and empty texts among them, are never found and count for
    nothing; rows that repeat a document are documents of their own; a null id comes first.
    Items of one id are one item. Empty tables on either side give no rows. Other columns are
    not read.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "ranked-documents")
    with staging(spark):
        index = stage(build_index(docs, id_col, text_col), "index")
        out = search(index, queries, k, item_col, text_col, id_col)
        out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)
