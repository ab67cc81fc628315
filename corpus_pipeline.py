"""From raw documents to packed training sequences: each stage is one operator.

Every stage but the last takes and returns the columns of ``documents``. A document is told
apart by its id; rows that repeat one id are one document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import langid
from millrace.llm.common import letters
from millrace.llm.jaccard import jaccard_groups
from millrace.llm.mixing import mix
from millrace.llm.packing import pack
from millrace.llm.simhash import simhash_links
from millrace.llm.suffix import remove_repeats
from millrace.staging import stage, staging

#: The least share of a text that one language must have.
LEAST_SHARE = 0.5
#: Near-duplicates: the least Jaccard similarity of two texts' sets of five-word shingles, and
#: the bits of 64 that fingerprints found to be close differ in. No result depends on the bits.
SHINGLE, JACCARD, NEAR_BITS = 5, 0.8, 8
#: Bytes of a passage that must not occur twice.
PASSAGE = 200


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, and those in which no language has half the text.
    A missing language is filled in. Without any labelled document nothing is dropped but
    texts without a letter."""
    model = langid.fit(docs)
    found = langid.predict(docs, model, _whole(docs))
    clear = (F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)
    if not model.languages:
        clear = letters(_field(docs, "text"))
    named = F.when(F.col("lang_pred") != "und", F.col("lang_pred"))
    lang = F.coalesce(_field(docs, "lang"), named)
    return found.where(clear).select(*_columns(docs, lang=lang))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id of each group. One without an id can't stand
    for a group and goes. Of rows that share an id the one of the least text stays, null before
    any, and of equal texts that of the least language, source and length.

    Near-duplicates are found by SimHash fingerprints, each checked exactly. Fingerprints miss
    pairs near the threshold: a join on shingles finds what is left."""
    with staging(spark):
        close = simhash_links(docs, SHINGLE, NEAR_BITS)
        groups = jaccard_groups(docs, SHINGLE, JACCARD, first=close)
    kept = groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id")
    own = docs.join(kept, "doc_id", "left_semi").select("doc_id", _whole(docs))
    order = F.struct(*[_field(docs, c) for c in ("text", "lang", "source", "n_chars")])
    return own.groupBy("doc_id").agg(F.min_by("document", order).alias("document")).select(*_columns(docs))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out repeated passages. Of a character cut in two, the rest goes as well; a
    document of which nothing but white space is left goes whole."""
    cut = remove_repeats(docs.select("doc_id", "text", _whole(docs)), PASSAGE, carry=("document",))
    cut = cut.withColumn("document", F.col("carried.document"))
    touched = F.col("n_removed") > 0
    cut = cut.withColumn("left", F.when(touched, _readable("kept")).otherwise(_field(docs, "text")))
    cut = cut.where(~touched | F.col("left").rlike(r"[^\x20\x09-\x0D]"))
    n_chars = F.when(touched, F.length("left").cast("long")).otherwise(_field(docs, "n_chars"))
    return cut.select(*_columns(docs, text=F.col("left"), n_chars=n_chars))


def _whole(docs: DataFrame) -> Column:
    """A row's columns as one, by number: whatever they are called, nothing clashes."""
    return F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)]).alias("document")


def _field(docs: DataFrame, name: str) -> Column:
    return F.col(f"document.c{docs.columns.index(name)}")


def _columns(docs: DataFrame, **changed: Column) -> list[Column]:
    """The columns of ``docs`` out of ``document``, some of them changed."""
    return [changed.get(c, _field(docs, c)).alias(c) for c in docs.columns]


def _readable(column: str) -> Column:
    """Bytes as text, without the replacement characters that decoding puts for what is no
    UTF-8, or that the text held itself."""
    return F.regexp_replace(F.make_valid_utf8(F.col(column).cast("string")), "\ufffd", "")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents so that sources take their shares of the words."""
    copies = mix(docs).groupBy("doc_id").agg(F.max("copies").alias("copies")).where("copies > 0")
    times = docs.select("doc_id", _whole(docs)).join(copies, "doc_id")
    each = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    return times.select("document", each).select(*_columns(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 4096 tokens."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near-dedup", near_dedup),
    ("passages", passages),
    ("mixture", mixture),
    ("packing", packing),
]

#: Learned models, fingerprints and tokenizers are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
