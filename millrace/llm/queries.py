"""The queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import langid, linequality, merkle, secretscan
from millrace.llm.common import id_remainder
from millrace.llm.lexical import rank_documents
from millrace.llm.mixing import mix
from millrace.llm.multiindex import link_vectors
from millrace.llm.packing import pack
from millrace.llm.perplexity import judge
from millrace.llm.sharding import hilbert_shards
from millrace.llm.simhash import simhash_groups
from millrace.llm.suffix import remove_repeats
from millrace.llm.tokens import count_tokens


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = id_remainder("doc_id", 4) == 2
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs, model, "doc_id", held_out.alias("held_out")).drop("languages")


def op2_line_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = id_remainder("doc_id", 5) == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    field = linequality.fit(docs.where(~held_out), labels, "quality")
    scored = linequality.score(docs, field, "doc_id", held_out.alias("held_out"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op4_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), threshold=0.98)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), length=200).drop("kept")


def op6_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards(documents(spark, sf_dir), shards=40).drop("curve")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(documents(spark, sf_dir))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op8_entropy_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash_groups(documents(spark, sf_dir), shingle=3, radius=2)
    return grouped.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


def op10_perplexity_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir)).drop("low", "high")


def secret_report(docs: DataFrame) -> DataFrame:
    """Findings as numbers and span lists; the first three kinds are the base."""
    found = F.col("findings")
    base = secretscan.of_kinds(found, "assign", "access", "hex")
    return secretscan.find_secrets(docs).select(
        "doc_id",
        *[F.size(secretscan.of_kinds(found, k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secretscan.span_list(base).cast("binary"), 256).alias("base_sha256"),
        secretscan.span_list(found).alias("spans"),
    )


def op11_secret_lexing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(documents(spark, sf_dir))


def op12_merkle_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    fifth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.merkle_proofs(
        documents(spark, sf_dir),
        tampered=lambda value, name: merkle.lowered(value) if name == "text" else value,
        tampered_where=fifth,
    )


def op13_block_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_mixture": op1_language_mixture,
    "op2_line_field": op2_line_field,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op8_entropy_balance": op8_entropy_balance,
    "op9_simhash_groups": op9_simhash_groups,
    "op10_perplexity_bands": op10_perplexity_bands,
    "op4_multi_index": op4_multi_index,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_hilbert_shards": op6_hilbert_shards,
    "op7_token_counts": op7_token_counts,
    "op11_secret_lexing": op11_secret_lexing,
    "op12_merkle_blocks": op12_merkle_blocks,
    "op13_block_max": op13_block_max,
}

def _token(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_token, ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text))) + ")"


def _climb(name: str, levels: int) -> str:
    """Levels over ``name``_n0 (part, i, h), and the ways of ``name``_w0 (rid, part, i, node,
    proof) along them; a part of one node stays as it is."""
    steps = []
    for k in range(levels):
        steps.append(f"""
        {name}_c{k} AS (SELECT part, count(*) AS n FROM {name}_n{k} GROUP BY part),
        {name}_n{k + 1} AS (
            SELECT part, i // 16 AS i, CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE max(h) END AS h
            FROM {name}_n{k} JOIN {name}_c{k} USING (part) GROUP BY part, i // 16
        ), {name}_w{k + 1} AS (
            SELECT rid, w.part, any_value(w.i) // 16 AS i,
                   CASE WHEN max(n) > 1 THEN sha256(string_agg(CASE WHEN s.i = w.i THEN node ELSE h END, '' ORDER BY s.i))
                        ELSE max(node) END AS node,
                   max(proof) || coalesce(string_agg(h, '' ORDER BY s.i) FILTER (s.i <> w.i), '') AS proof
            FROM {name}_w{k} w JOIN {name}_n{k} s ON w.part = s.part AND w.i // 16 = s.i // 16
            JOIN {name}_c{k} c ON c.part = w.part GROUP BY rid, w.part
        )""")
    return ",".join(steps)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = f"translate(text, '{_UPPER}', '{_LOWER}')"
#: crc32 of the id's decimal digits.
_CRC32 = """
    xor(list_reduce(
        list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
        lambda crc, b: list_reduce(
            [0, 1, 2, 3, 4, 5, 6, 7], lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, b)
        ),
        4294967295
    ), 4294967295)
"""

ORACLES: dict[str, str] = {
    "op4_multi_index": """
        WITH RECURSIVE vec AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS v,
                   label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
                   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                   AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
            FROM embeddings
        ), link AS (
            SELECT a.vec_id AS a, b.vec_id AS b
            FROM vec a JOIN vec b ON a.label = b.label AND a.vec_id <> b.vec_id AND a.usable AND b.usable
            AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98
        ), reach AS (
            SELECT vec_id AS a, vec_id AS b FROM vec
            UNION
            SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
        ), least AS (
            SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
        )
        SELECT vec_id, (SELECT count(*) FROM link WHERE link.a = least.vec_id) AS n_links, component_id,
               vec_id = component_id AS kept
        FROM least
    """,
    "op5_suffix_dedup": """
        WITH doc AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n_bytes FROM documents
        ), win AS (
            SELECT doc_id, p, md5(substr(h, 2 * p + 1, 400)) AS w
            FROM (SELECT doc_id, h, unnest(range(n_bytes - 199)) AS p FROM doc WHERE n_bytes >= 200)
        ), hit AS (
            SELECT doc_id, p FROM win WHERE w IN (SELECT w FROM win GROUP BY w HAVING count(*) > 1)
        ), stepped AS (
            SELECT doc_id, p, CASE WHEN p - lag(p) OVER own <= 200 THEN 0 ELSE 1 END AS new
            FROM hit WINDOW own AS (PARTITION BY doc_id ORDER BY p)
        ), numbered AS (
            SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM stepped
        ), span AS (
            SELECT doc_id, k, min(p) AS a, max(p) + 200 AS b FROM numbered GROUP BY doc_id, k
        ), edge AS (
            SELECT doc_id, k, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY k), 0) AS f, a AS t FROM span
            UNION ALL
            SELECT doc_id, count(*) + 1, max(b), NULL FROM span GROUP BY doc_id
        ), kept AS (
            SELECT doc_id, string_agg(substr(h, 2 * f + 1, 2 * (coalesce(t, n_bytes) - f)), '' ORDER BY k) AS h
            FROM edge JOIN doc USING (doc_id) GROUP BY doc_id
        ), total AS (
            SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM span GROUP BY doc_id
        )
        SELECT doc_id, n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept.h, doc.h))) AS kept_sha256
        FROM doc LEFT JOIN total USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    # Levels for 16^5 rows of a source and 16^3 sources.
    "op12_merkle_blocks": f"""
        WITH doc AS (
            SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '') AS part, {_leaf("text")} AS leaf,
                   CASE WHEN {_CRC32} % 5 = 0 THEN {_leaf(_LOWERED)} ELSE {_leaf("text")} END AS held
            FROM documents
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM doc
        ), low_n0 AS (SELECT part, i, leaf AS h FROM placed),
        low_w0 AS (SELECT rid, part, i, held AS node, '' AS proof FROM placed),
        {_climb("low", 5)},
        subroot AS (SELECT part, h, row_number() OVER (ORDER BY encode(part)) - 1 AS i FROM low_n5),
        top_n0 AS (SELECT '' AS part, i, h FROM subroot),
        top_w0 AS (SELECT rid, '' AS part, s.i, node, proof FROM low_w5 w JOIN subroot s ON w.part = s.part),
        {_climb("top", 3)}
        SELECT doc_id, leaf, s.h AS subroot, r.h AS root, sha256(w.proof) AS proof_sha256, w.node AS folded_root,
               w.node = r.h AS verified
        FROM doc JOIN subroot s USING (part) JOIN top_w3 w USING (rid), top_n3 r
    """,
    "op13_block_max": f"""
        WITH term AS (
            SELECT rid, doc_id, unnest(regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
            FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)
        ), n AS (
            SELECT rid, count(*) AS n FROM term GROUP BY rid
        ), total AS (
            SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM n
        ), tf AS (
            SELECT rid, doc_id, term, count(*) AS tf FROM term GROUP BY rid, doc_id, term
        ), weight AS (
            SELECT term, floor(1000 * ln((2 * max(docs) + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM tf, total GROUP BY term
        ), item AS (
            SELECT item_id, unnest(regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
            FROM benchmark
        ), score AS (
            SELECT item_id, rid, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // len))))::BIGINT AS score
            FROM item JOIN tf USING (term) JOIN weight USING (term) JOIN n USING (rid), total
            GROUP BY item_id, rid, doc_id
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
            FROM score WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
    """,
}
