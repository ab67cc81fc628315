"""Text quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WHITE, hash_sample, raw, renamed, slices, tune, whole

#: Labelled documents that the field is fitted to, the first by the hash of their id, and
#: the lines a chain has in fitting: of a longer text a stretch of neighbouring lines, whose
#: place the hash gives. Both bound what comes to the driver.
FIT_DOCS, FIT_LINES = 4_000, 64
FIT_STEPS, RATE, DECAY = 250, 0.1, 1e-3

#: Kinds of bytes.
LOWER, UPPER, DIGIT, SPACE, SYMBOL, BANG, STOP, SIGN, HIGH = range(9)
KIND = np.full(256, SIGN, np.uint8)
KIND[128:] = HIGH
for _kind, _bytes in (
    (LOWER, bytes(range(97, 123))), (UPPER, bytes(range(65, 91))), (DIGIT, bytes(range(48, 58))),
    (SPACE, WHITE), (SYMBOL, b"#*$%&|<>@~^_=+{}[]\\/"), (BANG, b"!?"), (STOP, b".,;:"),
):
    KIND[list(_bytes)] = _kind
#: From where on a share counts as some, more, much.
STEPS = (0.005, 0.05, 0.15, 0.4)

_power = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(1, 65)], np.uint64)


def _hashes(values: np.ndarray, starts: np.ndarray, within: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values * _power[within % 64], starts) if len(starts) else np.zeros(0, np.uint64)


def line_features(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bytes, features) of every line with a word, in order; a text without one has
    one line of no bytes."""
    n, size = len(offsets) - 1, len(flat)
    lengths = np.diff(offsets)
    kind = KIND[flat]
    first = np.zeros(size + 1, bool)
    first[offsets[:-1]] = True
    first = first[:size]
    new_line = first.copy()
    new_line[1:] |= flat[:-1] == 10
    line = np.cumsum(new_line) - 1
    heads = np.flatnonzero(new_line)
    n_lines = len(heads)
    row = np.repeat(np.arange(n), lengths)[heads] if n_lines else np.zeros(0, np.int64)
    counts = np.bincount(line * 9 + kind, minlength=n_lines * 9).reshape(-1, 9).astype(float)
    inside = kind != SPACE
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | first[1:]
    starts = np.flatnonzero(begin)
    word = np.cumsum(begin) - 1
    within = np.arange(size) - starts[np.maximum(word, 0)] if len(starts) else np.zeros(size, np.int64)
    values = np.where(inside, flat.astype(np.uint64) + np.uint64(1), np.uint64(0))
    word_hash = _hashes(values[starts[0] :], starts - starts[0], within[starts[0] :]) if len(starts) else np.zeros(0, np.uint64)
    of = line[starts]
    n_words = np.bincount(of, minlength=n_lines).astype(float)
    again = np.append(False, (word_hash[1:] == word_hash[:-1]) & (of[1:] == of[:-1])) if len(of) else np.zeros(0, bool)
    lettered = np.bincount(word[inside], np.isin(kind[inside], (LOWER, UPPER, HIGH)), len(starts)) if len(starts) else np.zeros(0)
    n_again = np.bincount(of, again, n_lines)
    n_bare = np.bincount(of, lettered == 0, n_lines)
    n_capital = np.bincount(of, kind[starts] == UPPER, n_lines)
    # Lines that have stood in the same text before.
    twice = np.zeros(n_lines)
    worded = np.flatnonzero(n_words)
    if len(worded):
        at = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        place = np.arange(len(of)) - np.repeat(at, np.diff(np.append(at, len(of))))
        line_hash = _hashes(word_hash, at, place)
        order = np.lexsort((worded, line_hash, row[worded]))
        same = (line_hash[order][1:] == line_hash[order][:-1]) & (row[worded][order][1:] == row[worded][order][:-1])
        twice[worded[order[1:][same]]] = 1
    size_of = np.diff(np.append(heads, size)).astype(float)
    marks = np.maximum(size_of - counts[:, SPACE], 1)
    letters = np.maximum(counts[:, LOWER] + counts[:, UPPER], 1)
    words = np.maximum(n_words, 1)
    shares = np.stack(
        [
            counts[:, UPPER] / letters, counts[:, DIGIT] / marks, counts[:, SYMBOL] / marks, counts[:, BANG] / marks,
            counts[:, STOP] / marks, counts[:, SIGN] / marks, counts[:, HIGH] / marks, n_again / words, n_bare / words,
            n_capital / words,
        ],
        1,
    )
    features = np.concatenate(
        [
            shares,
            *(shares > x for x in STEPS),
            np.stack([np.log1p(n_words) / 5, marks / words / 10, twice, (n_words < 4).astype(float)], 1),
        ],
        1,
    )
    keep = n_words > 0
    row, size_of, features = row[keep], size_of[keep], features[keep]
    bare = np.setdiff1d(np.arange(n), row)
    row = np.concatenate([row, bare])
    order = np.argsort(row, kind="stable")
    return (
        row[order],
        np.concatenate([size_of, np.zeros(len(bare))])[order],
        np.concatenate([features, np.zeros((len(bare), features.shape[1]))])[order],
    )


N_FEATURES = 10 * (1 + len(STEPS)) + 4


def with_neighbours(row: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Each line's features, a constant, and those of the line before and after it."""
    n = len(row)
    before, after = np.zeros_like(features), np.zeros_like(features)
    same = row[1:] == row[:-1]
    before[1:][same] = features[:-1][same]
    after[:-1][same] = features[1:][same]
    edge = np.zeros((n, 2))
    edge[0 if n else slice(0), 0] = 1
    edge[1:, 0], edge[:-1, 1] = ~same, ~same
    edge[n - 1 if n else slice(0), 1] = 1
    return np.concatenate([np.ones((n, 1)), features, before, after, edge], 1)


@dataclass
class Field:
    """``weight``: a line's score for good over bad; ``pair``: scores of neighbours' labels;
    ``scale``, ``shift``: from a text's log-odds to those of its label."""

    weight: np.ndarray
    pair: np.ndarray
    scale: float = 1.0
    shift: float = 0.0


class Chains:
    """Chains of lines, longest first, so that a step over positions takes a prefix."""

    def __init__(self, row: np.ndarray) -> None:
        starts = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
        lengths = np.diff(np.append(starts, len(row)))
        self.order = np.argsort(-lengths, kind="stable")
        self.starts, self.lengths = starts[self.order], lengths[self.order]
        self.steps = int(lengths.max()) if len(lengths) else 0

    def active(self, t: int) -> int:
        return int(np.searchsorted(-self.lengths, -t, "left"))

    def forward_backward(self, score: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(probability of good of every line, summed pair marginals, log of the
        normaliser of every chain), from lines' log-odds."""
        n = len(score)
        state = np.stack([np.zeros(n), score], 1)
        alpha, beta = state.copy(), np.zeros((n, 2))
        for t in range(1, self.steps):
            at = self.starts[: self.active(t)] + t
            came = alpha[at - 1][:, :, None] + pair
            alpha[at] += np.logaddexp(came[:, 0], came[:, 1])
        last = self.starts + self.lengths - 1
        log_z = np.logaddexp(alpha[last, 0], alpha[last, 1])
        both = np.zeros((2, 2))
        for t in range(self.steps - 1, 0, -1):
            k = self.active(t)
            at = self.starts[:k] + t
            ahead = state[at] + beta[at]
            goes = pair[None] + ahead[:, None, :]
            both += np.exp(alpha[at - 1][:, :, None] + goes - log_z[:k, None, None]).sum(0)
            beta[at - 1] = np.logaddexp(goes[:, :, 0], goes[:, :, 1])
        good = 1 / (1 + np.exp(np.clip(alpha[:, 0] + beta[:, 0] - alpha[:, 1] - beta[:, 1], -60, 60)))
        return good, both, log_z


def _odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p / (1 - p))


def _marginals(
    field: Field, row: np.ndarray, size: np.ndarray, features: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray]:
    """Every line's probability of good, and each text's length-weighted mean of them."""
    good, _, _ = Chains(row).forward_backward(with_neighbours(row, features) @ field.weight, field.pair)
    return good, _mean(row, size, good, n)


def _mean(row: np.ndarray, size: np.ndarray, good: np.ndarray, n: int) -> np.ndarray:
    weight = size + 1
    return np.bincount(row, good * weight, n) / np.bincount(row, weight, n)


def stretches(row: np.ndarray, hashes: np.ndarray, most: int = FIT_LINES) -> tuple[np.ndarray, np.ndarray]:
    """Which lines fitting takes: all of a text of ``most`` lines or fewer, else so many in
    succession; and which it takes along with the line before and the one after them."""
    starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    lengths = np.diff(np.append(starts, len(row)))
    begin = hashes[row[starts]].astype(np.uint64) % np.maximum(lengths - most + 1, 1).astype(np.uint64)
    place = np.arange(len(row)) - np.repeat(starts + begin.astype(np.int64), lengths)
    return (place >= -1) & (place <= most), (place >= 0) & (place < most)


def fit(
    docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text"
) -> Field:
    """Maximise the likelihood of the lines' labels, each that of its text, over the
    ``FIT_DOCS`` labelled documents that are first by the hash of their id. ``labels`` has the
    ids and labels; ids alone are joined to find the sample, and only its texts are fetched.
    Rows without a label teach nothing; without any label all texts score a half."""
    tune(docs.sparkSession)
    texts = renamed(docs, id=id_col, text=text_col).select("id", whole("text").alias("text"))
    known = renamed(labels, id=id_col, label=label_col).where("label is not null")
    known = known.select("id", F.col("label").cast("int").alias("label")).join(texts.select("id").distinct(), "id")
    # At most FIT_DOCS ids are broadcast; an id that many rows share is cut again.
    wanted = F.broadcast(hash_sample(known, FIT_DOCS, "id", "label").withColumnRenamed("hash", "h"))
    sample = texts.join(wanted, "id").orderBy("h", "label", "text").limit(FIT_DOCS).select("h", "label", "text")

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = raw(batch.column("text"))
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            hashes = batch.column("h").to_numpy()
            for first, last in slices(offsets):
                own = offsets[first : last + 1]
                row, size, features = line_features(flat[own[0] : own[-1]], own - own[0])
                use, inner = stretches(row, hashes[first:last])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("h").take(pa.array(row[use] + first)),
                        pa.array(labels[first:last][row[use]]),
                        pa.array(size[use]),
                        pa.array(inner[use]),
                        pa.FixedSizeListArray.from_arrays(pa.array(features[use].ravel()), N_FEATURES).cast(pa.list_(pa.float64())),
                    ],
                    names=["h", "label", "size", "inner", "features"],
                )

    got = sample.coalesce(1).mapInArrow(lines, "h long, label int, size double, inner boolean, features array<double>").toArrow()
    h = got.column("h").to_numpy()
    if not len(h):
        return Field(np.zeros(3 * N_FEATURES + 3), np.zeros((2, 2)))
    row = np.cumsum(np.append(True, h[1:] != h[:-1])) - 1
    inner = got.column("inner").to_numpy()
    features = np.array(got.column("features").combine_chunks().flatten()).reshape(-1, N_FEATURES)
    # The lines around a stretch are there for their neighbours' sake alone.
    x, row = with_neighbours(row, features)[inner], row[inner]
    label = got.column("label").to_numpy()[inner].astype(float)
    size = got.column("size").to_numpy()[inner]
    chains = Chains(row)
    n = len(chains.starts)
    pairs = np.zeros((2, 2))
    same = row[1:] == row[:-1]
    np.add.at(pairs, (label[:-1][same].astype(int), label[1:][same].astype(int)), 1)
    # A long text must not outweigh a short one: a line's gradient is divided by its
    # chain's lines.
    share = 1 / np.bincount(row)[row]
    field = Field(np.zeros(x.shape[1]), np.zeros((2, 2)))
    moments = [np.zeros(x.shape[1] + 4), np.zeros(x.shape[1] + 4)]
    for step in range(1, FIT_STEPS + 1):
        good, both, _ = chains.forward_backward(x @ field.weight, field.pair)
        up = np.append(x.T @ ((label - good) * share) / n - DECAY * field.weight, (pairs - both).ravel() / len(row) - DECAY * field.pair.ravel())
        moments[0] = 0.9 * moments[0] + 0.1 * up
        moments[1] = 0.99 * moments[1] + 0.01 * up * up
        move = RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        field.weight = field.weight + move[:-4]
        field.pair = field.pair + move[-4:].reshape(2, 2)
    odds = _odds(_mean(row, size, chains.forward_backward(x @ field.weight, field.pair)[0], n))
    truth = np.zeros(n)
    truth[row] = label
    beta = np.array([0.0, 0.0])
    design = np.stack([odds, np.ones(n)], 1)
    for _ in range(30):  # Newton steps of a logistic fit with a little ridge
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -40, 40)))
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(curve, design.T @ (truth - p) - 1e-2 * beta), -2, 2)
    field.scale, field.shift = max(1e-3, float(beta[0])), float(beta[1])
    return field


def score(docs: DataFrame, field: Field, *keep: str | Column, text_col: str = "text") -> DataFrame:
    """The columns ``keep``, score (0 to 1, higher is better) and line_quality (the marginal
    of each line with a word). Null and empty texts are scored as one empty line."""
    spark = docs.sparkSession
    tune(spark)
    known = spark.sparkContext.broadcast(field)
    kept = docs.select(
        F.struct(*[F.col(f"`{c}`") if isinstance(c, str) else c for c in keep]).alias("kept"),
        whole(F.col(f"`{text_col}`")).alias("text"),
    )
    kind = kept.schema["kept"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = known.value
        for batch in batches:
            flat, offsets = raw(batch.column("text"))
            scores, lines = np.zeros(batch.num_rows), []
            for first, last in slices(offsets):
                own = offsets[first : last + 1]
                row, size, features = line_features(flat[own[0] : own[-1]], own - own[0])
                good, mean = _marginals(field, row, size, features, last - first)
                scores[first:last] = 1 / (1 + np.exp(-np.clip(field.scale * _odds(mean) + field.shift, -40, 40)))
                lines += np.split(good, np.flatnonzero(row[1:] != row[:-1]) + 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), pa.array(scores), pa.array(lines, pa.list_(pa.float64()))],
                names=["kept", "score", "line_quality"],
            )

    out = kept.mapInArrow(run, f"kept {kind}, score double, line_quality array<double>")
    return out.select("kept.*", "score", "line_quality")
