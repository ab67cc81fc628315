"""The languages of a text as a mixture, inferred by expectation-maximisation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import letters, raw, renamed, slices, tune, whole

#: Buckets that byte trigrams are hashed to, and the kinds of buckets told apart, for each
#: language and at least: buckets whose likelihoods under all languages are about the same count
#: as one kind.
BUCKETS, KINDS, LEAST_KINDS = 1 << 16, 64, 256
#: Expectation-maximisation ends for a text when a step adds less to its log-likelihood.
RISE = 1e-3
#: A byte is in three trigrams: that much of their likelihoods' sum is evidence.
OVERLAP = 3
SMOOTHING = 0.5

#: A-Z to a-z, all other bytes as they are.
LOWER = np.array([*range(65), *range(97, 123), *range(91, 256)], np.uint8)


def _trigrams(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every trigram of each text between two blanks; as many as bytes."""
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    # A blank before all and one after each text.
    at = np.arange(len(flat)) + np.repeat(np.arange(n), lengths) + 1
    padded = np.full(len(flat) + n + 2, 32, np.uint8)
    padded[at] = LOWER[flat]
    b = padded.astype(np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return np.repeat(np.arange(n), lengths), bucket[at - 1]


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: The kind of each bucket, and each kind's likelihood under each language, where only
    #: the ratios within a kind matter.
    kind: np.ndarray
    likelihood: np.ndarray


def _kinds(vectors: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Weighted k-means from evenly spaced buckets in the order of their best language."""
    best = vectors.argmax(1)
    order = np.lexsort((vectors.max(1), best))
    centres = vectors[order[np.linspace(0, len(order) - 1, min(n, len(order))).astype(int)]]
    for _ in range(8):
        nearest = np.concatenate(
            [
                ((centres**2).sum(1) - 2 * part @ centres.T).argmin(1)
                for part in np.array_split(vectors, max(1, len(vectors) // 4096))
            ]
        )
        total = np.bincount(nearest, weights, len(centres))
        for k in range(vectors.shape[1]):
            mean = np.bincount(nearest, weights * vectors[:, k], len(centres)) / np.maximum(total, 1e-9)
            centres[:, k] = np.where(total > 0, mean, centres[:, k])
    return nearest


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """Count the trigrams of every labelled text. Rows without a language or text teach
    nothing; what comes to the driver is at most ``BUCKETS`` counts a language."""
    tune(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            flat, offsets = raw(batch.column("text"))
            names = sorted(set(langs))
            code = np.array([names.index(x) for x in langs])
            for first, last in slices(offsets):
                own = offsets[first : last + 1]
                row, bucket = _trigrams(flat[own[0] : own[-1]], own - own[0])
                cell = code[first:last][row] * BUCKETS + bucket
                each = np.bincount(cell, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
                for k, name in enumerate(names):
                    found[name] = found.get(name, 0) + each[k].astype(np.int64)
        for name, counts in found.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(counts[some])],
                names=["lang", "bucket", "n"],
            )

    labelled = renamed(docs, lang=lang_col, text=text_col).dropna()
    counts = (
        labelled.select(F.col("lang").cast("string").alias("lang"), "text")
        .mapInArrow(count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    languages = sorted(set(counts.column("lang").to_pylist()))
    if not languages:
        return Model([], np.zeros(BUCKETS, np.int32), np.ones((1, 0)))
    place = {x: k for k, x in enumerate(languages)}
    table = np.zeros((BUCKETS, len(languages)))
    table[counts.column("bucket").to_numpy(), [place[x] for x in counts.column("lang").to_pylist()]] = counts.column("n")
    logs = np.log((table + SMOOTHING) / (table.sum(0) + SMOOTHING * BUCKETS))
    # Kind 0 are the buckets that no language has seen: they say nothing.
    weight = table.sum(1)
    seen = np.flatnonzero(weight)
    vectors = (logs - logs.mean(1, keepdims=True))[seen]
    kinds = max(LEAST_KINDS, KINDS * len(languages))
    kind = np.zeros(BUCKETS, np.int64)
    kind[seen] = 1 + _kinds(vectors, weight[seen], kinds - 1)
    total = np.bincount(kind[seen], weight[seen], kinds)
    means = np.stack(
        [
            np.bincount(kind[seen], weight[seen] * vectors[:, k], kinds) / np.maximum(total, 1e-9)
            for k in range(len(languages))
        ],
        1,
    )
    return Model(languages, kind.astype(np.int32), np.exp(means - means.max(1, keepdims=True)))


def _mix(counts: np.ndarray, likelihood: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's proportions among its allowed languages and their log-likelihood, which no
    step lowers and which is bounded: every row's steps come to an end."""
    share = allowed / allowed.sum(1, keepdims=True)
    reached = np.full(len(counts), -np.inf)
    going = np.arange(len(counts))
    while len(going):
        own, part = counts[going], share[going]
        mean = np.maximum(part @ likelihood.T, 1e-300)
        fit_ = (own * np.log(mean)).sum(1)
        rises = fit_ - reached[going] >= RISE
        reached[going] = fit_
        going, own, part, mean = going[rises], own[rises], part[rises], mean[rises]
        part = part * ((own / mean) @ likelihood)
        share[going] = part / np.maximum(part.sum(1, keepdims=True), 1e-300)
    return share, reached


def infer(model: Model, counts: np.ndarray) -> np.ndarray:
    """The proportions of each row's languages (0 for those not selected). From the likeliest
    one alone, the language of the greatest gain in likelihood is added until none gains half
    the logarithm of the evidence; then those that lose less than that are left out again, the
    least loss first, as long as three or more are left."""
    n_rows, n_langs = len(counts), len(model.languages)
    alone = counts @ np.log(model.likelihood)
    allowed = np.zeros((n_rows, n_langs), bool)
    allowed[np.arange(n_rows), alone.argmax(1)] = True
    chosen, best = allowed.astype(float), alone.max(1) / OVERLAP
    price = 0.5 * np.log(np.maximum(counts.sum(1) / OVERLAP, 2))
    active = np.arange(n_rows)
    for _ in range(1, n_langs):
        own = counts[active]
        slope = (own / np.maximum(chosen[active] @ model.likelihood.T, 1e-300)) @ model.likelihood
        # A share of a language with a lesser slope lowers the likelihood.
        rising = ~allowed[active] & (slope > own.sum(1, keepdims=True))
        top, share, added = np.full(len(active), -np.inf), chosen[active], np.zeros(len(active), int)
        for lang in np.flatnonzero(rising.any(0)):
            some = np.flatnonzero(rising[:, lang])
            wider = allowed[active[some]]
            wider[:, lang] = True
            mixed, fit_ = _mix(own[some], model.likelihood, wider)
            better = fit_ / OVERLAP > top[some]
            at = some[better]
            top[at], share[at], added[at] = fit_[better] / OVERLAP, mixed[better], lang
        pays = top > best[active] + price[active] + 1e-9
        active = active[pays]
        if not len(active):
            break
        best[active], chosen[active] = top[pays], share[pays]
        allowed[active, added[pays]] = True
    active = np.flatnonzero(allowed.sum(1) > 2)
    while len(active):
        own = counts[active]
        top, share, left_out = np.full(len(active), -np.inf), chosen[active], np.zeros(len(active), int)
        for lang in np.flatnonzero(allowed[active].any(0)):
            some = np.flatnonzero(allowed[active, lang])
            fewer = allowed[active[some]]
            fewer[:, lang] = False
            mixed, fit_ = _mix(own[some], model.likelihood, fewer)
            better = fit_ / OVERLAP > top[some]
            at = some[better]
            top[at], share[at], left_out[at] = fit_[better] / OVERLAP, mixed[better], lang
        spared = top > best[active] - price[active] + 1e-9
        active = active[spared]
        best[active], chosen[active] = top[spared], share[spared]
        allowed[active, left_out[spared]] = False
        active = active[allowed[active].sum(1) > 2]
    return chosen


def predict(docs: DataFrame, model: Model, *keep: str | Column, text_col: str = "text") -> DataFrame:
    """The columns ``keep``, lang_pred, score (its share of the text) and languages (all the
    shares). Text without a letter, or a model without languages, gives ``und`` and 0."""
    spark = docs.sparkSession
    tune(spark)
    known = spark.sparkContext.broadcast(model)
    # Where a kept column has a name of this function's own, it must not clash.
    kept = docs.select(
        F.struct(*[F.col(f"`{c}`") if isinstance(c, str) else c for c in keep]).alias("kept"),
        whole(F.col(f"`{text_col}`")).alias("text"),
    ).withColumn("has_letter", letters(F.col("text")))
    kind = kept.schema["kept"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = known.value
        for batch in batches:
            flat, offsets = raw(batch.column("text"))
            n = batch.num_rows
            pred, score, shares = ["und"] * n, np.zeros(n), [[] for _ in range(n)]
            kinds = len(model.likelihood)
            some = batch.column("has_letter").to_numpy(zero_copy_only=False)
            for first, last in slices(offsets) if model.languages else ():
                own = offsets[first : last + 1]
                row, bucket = _trigrams(flat[own[0] : own[-1]], own - own[0])
                cell = row * kinds + model.kind[bucket]
                counts = np.bincount(cell, minlength=(last - first) * kinds).reshape(-1, kinds).astype(float)
                mixed = infer(model, counts)
                for k in np.flatnonzero(some[first:last]):
                    best = int(mixed[k].argmax())
                    pred[first + k], score[first + k] = model.languages[best], min(1.0, mixed[k, best])
                    shares[first + k] = [
                        {"lang": model.languages[x], "share": float(mixed[k, x])} for x in np.flatnonzero(mixed[k])
                    ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("kept"),
                    pa.array(pred, pa.string()),
                    pa.array(score),
                    pa.array(shares, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))),
                ],
                names=["kept", "lang_pred", "score", "languages"],
            )

    out = kept.mapInArrow(
        run,
        f"kept {kind}, lang_pred string, score double, languages array<struct<lang: string, share: double>>",
    )
    return out.select("kept.*", "lang_pred", "score", "languages")
