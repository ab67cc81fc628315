"""Quality rules on words and lines, and perplexity bands under a Kneser-Ney model."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import raw, renamed, slices, tune, whole
from millrace.staging import stage

#: The model predicts a byte from the three before it; three pads stand before a text.
ORDER, PAD = 4, 3
#: Distinct n-grams a task holds before it hands them on.
HELD = 2_000_000
#: How many times the middle half's width a log-perplexity may lie beyond it.
BAND = 3.0
#: A text's mean spreads with the inverse root of its length, up to about so many bytes.
STEADY = 20_000


def _codes(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, n-gram that ends there) for every byte of each text. An n-gram's hash is its
    four bytes."""
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    row = np.repeat(np.arange(n), lengths)
    at = np.arange(len(flat)) + (row + 1) * PAD
    padded = np.full(len(flat) + n * PAD, 3, np.uint8)
    padded[at] = flat
    b = padded.astype(np.uint32)
    code = b.copy()
    for back in range(1, ORDER):
        code[back:] |= b[:-back] << np.uint32(8 * back)
    return row, code[at]


def count_ngrams(docs: DataFrame) -> DataFrame:
    """(lang, code, n) over all texts of ``docs`` (lang, text), counted in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            codes = np.concatenate([x[0] for x in parts])
            counts = np.concatenate([x[1] for x in parts])
            order = np.argsort(codes, kind="stable")
            codes, counts = codes[order], counts[order]
            heads = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
            return codes[heads], np.add.reduceat(counts, heads)

        def out() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                codes, counts = merged(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(counts)],
                    names=["lang", "code", "n"],
                )

        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist())
            flat, offsets = raw(batch.column("text"))
            for first, last in slices(offsets):
                own = offsets[first : last + 1]
                row, code = _codes(flat[own[0] : own[-1]], own - own[0])
                for lang in sorted(set(langs[first:last].tolist())):
                    codes, n = np.unique(code[(langs[first:last] == lang)[row]], return_counts=True)
                    if len(codes):
                        held.setdefault(lang, []).append((codes, n.astype(np.int64)))
                        size += len(codes)
            if size > HELD:
                held = {lang: [merged(parts)] for lang, parts in held.items()}
                size = sum(len(x[0][0]) for x in held.values())
                if size > HELD // 2:
                    yield from out()
                    held, size = {}, 0
        yield from out()

    return (
        docs.mapInArrow(count, "lang string, code long, n long")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
    )


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of 1, 2 and 3 or more."""
    of = [max(1, int((counts == k).sum())) for k in range(1, 5)]
    y = of[0] / (of[0] + 2 * of[1])
    d = [k - (k + 1) * y * of[k] / of[k - 1] for k in range(1, 4)]
    return np.array([0.0, *(min(max(x, 0.05), k + 0.95) for k, x in enumerate(d))])


def _level(codes: np.ndarray, counts: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Interpolated probabilities of sorted n-grams, their contexts, and the weight that
    each context gives to the shorter n-gram; ``lower`` are the shorter ones' values."""
    context = codes >> 8
    heads = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
    group = np.cumsum(np.append(0, context[1:] != context[:-1]))
    total = np.add.reduceat(counts, heads).astype(float)
    discount = _discounts(counts)[np.minimum(counts, 3)]
    left = np.add.reduceat(discount, heads) / total
    return (counts - discount) / total[group] + left[group] * lower, context[heads], left


class Model:
    """One language's model in sorted arrays: all n-grams met, with the logarithms of their
    interpolated probabilities, and the weights of their contexts."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(codes)
        codes, counts = codes[order].astype(np.int64), counts[order].astype(np.int64)
        # Shorter n-grams count the distinct bytes before them.
        three, n_three = np.unique(codes & 0xFFFFFF, return_counts=True)
        two, n_two = np.unique(three & 0xFFFF, return_counts=True)
        one, n_one = np.unique(two & 0xFF, return_counts=True)
        discount = _discounts(n_one)[np.minimum(n_one, 3)]
        p1 = np.full(256, discount.sum() / n_one.sum() / 256)
        p1[one] += (n_one - discount) / n_one.sum()
        seen2, context1, left1 = _level(two, n_two, p1[two & 0xFF])
        weight1 = np.ones(256)
        weight1[context1] = left1
        p2 = (weight1[:, None] * p1[None, :]).ravel()
        p2[two] = seen2
        seen3, context2, left2 = _level(three, n_three, p2[three & 0xFFFF])
        weight2 = np.ones(1 << 16)
        weight2[context2] = left2
        at = np.searchsorted(three, codes & 0xFFFFFF)
        seen4, context3, left3 = _level(codes, counts, seen3[at])
        self.two = np.log(p2).astype(np.float32)
        self.weight2 = np.log(weight2).astype(np.float32)
        self.three, self.log3 = three.astype(np.uint32), np.log(seen3).astype(np.float32)
        self.context3, self.weight3 = context3.astype(np.uint32), np.log(left3).astype(np.float32)
        self.four, self.log4 = codes.astype(np.uint32), np.log(seen4).astype(np.float32)

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def logs(self, code: np.ndarray) -> np.ndarray:
        at, met = self._find(self.four, code)
        out = self.log4[at]
        if not met.all():
            rest = code[~met]
            at, known = self._find(self.context3, rest >> np.uint32(8))
            value = np.where(known, self.weight3[at], 0)
            short = rest & np.uint32(0xFFFFFF)
            at, met3 = self._find(self.three, short)
            lower = self.weight2[short >> np.uint32(8)] + self.two[short & np.uint32(0xFFFF)]
            out[~met] = value + np.where(met3, self.log3[at], lower)
        return out


#: The characters that count as symbols, and the words' white space.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
_word = re.compile(f"[^{SPACES}]+")


def text_measures(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    words = _word.findall(text)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    repeated = 0
    if len(words) > 3:
        h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
        window = h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]
        order = np.argsort(window, kind="stable")
        same = window[order][1:] == window[order][:-1]
        twice = np.zeros(len(words), bool)
        for k in range(3):
            twice[order[1:][same] + k] = True
            twice[order[:-1][same] + k] = True
        repeated = int(twice.sum())
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
    )


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge(
    docs: DataFrame,
    band: float = BAND,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """(id, the five measures, base_failed, log_perplexity, low, high, kept) of every row.

    The model of a language and the band of its log-perplexities (a word) come from all
    its rows; a null language is one of its own. Distances from the median are measured in
    the spread that a text of that length has. The band reaches ``band`` times the distance
    of their quartiles beyond these, over the rows that pass the base rules. Null and empty
    texts have no words and fail; repeated rows count as often as they occur.
    """
    spark = docs.sparkSession
    tune(spark)
    source = renamed(docs, id=id_col, text=text_col, lang=lang_col).select(
        "id", whole("text").alias("text"), F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("lang")
    )
    counts = count_ngrams(source.select("lang", "text")).toArrow()
    langs = np.array(counts.column("lang").to_pylist())
    codes, n = counts.column("code").to_numpy(), counts.column("n").to_numpy()
    known = spark.sparkContext.broadcast({x: Model(codes[langs == x], n[langs == x]) for x in set(langs.tolist())})
    del counts, langs, codes, n

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = known.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            langs = np.array(batch.column("lang").to_pylist())
            flat, offsets = raw(batch.column("text"))
            total = np.zeros(batch.num_rows)
            for first, last in slices(offsets):
                own = offsets[first : last + 1]
                row, code = _codes(flat[own[0] : own[-1]], own - own[0])
                for lang in sorted(set(langs[first:last].tolist())):
                    mine = (langs[first:last] == lang)[row]
                    if mine.any():
                        total[first:last] += np.bincount(row[mine], models[lang].logs(code[mine]), last - first)
            columns = list(zip(*map(text_measures, texts), strict=True)) or [()] * 5
            words = np.array(columns[0])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("lang"),
                    *(pa.array(x, pa.int64()) for x in columns),
                    pa.array(np.diff(offsets)),
                    pa.array(-total / np.maximum(words, 1), mask=words == 0),
                ],
                names=["id", "lang", *MEASURES, "n_bytes", "log_perplexity"],
            )

    kind = source.schema["id"].dataType.simpleString()
    shape = f"id {kind}, lang string, " + ", ".join(f"{x} long" for x in MEASURES)
    shape += ", n_bytes long, log_perplexity double"
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = stage(source.mapInArrow(measure, shape).withColumn("base_failed", failed), "measures")
    # What is broadcast is a row a language, as the models are.
    passed = measured.where("not base_failed")
    middle = passed.groupBy("lang").agg(F.percentile_approx("log_perplexity", 0.5, 10_000).alias("middle"))
    spread = F.sqrt(1 / F.greatest("n_bytes", F.lit(1)) + 1 / F.lit(STEADY))
    away = (F.col("log_perplexity") - F.col("middle")) / spread
    bands = (
        passed.join(F.broadcast(middle), "lang")
        .groupBy("lang", "middle")
        .agg(F.percentile_approx(away, [0.25, 0.75], 10_000).alias("q"))
        .withColumn("width", band * (F.col("q")[1] - F.col("q")[0]))
    )
    return (
        measured.join(F.broadcast(bands), "lang", "left")
        .withColumn("low", F.col("middle") + (F.col("q")[0] - F.col("width")) * spread)
        .withColumn("high", F.col("middle") + (F.col("q")[1] + F.col("width")) * spread)
        .withColumn("inside", F.coalesce(F.col("log_perplexity").between(F.col("low"), F.col("high")), F.lit(False)))
        .select(
            F.col("id").alias(id_col), *MEASURES, "base_failed", "log_perplexity", "low", "high",
            (~F.col("base_failed") & F.col("inside")).alias("kept"),
        )
    )
