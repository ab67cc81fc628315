import os
import random

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from millrace.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng = random.Random(12)

    def words(n):
        return " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(2, 8))) for _ in range(n))

    passage = words(60)
    texts = [(k, words(150), "en", f"s{k % 2}") for k in range(30)]
    texts += [(100 + k, texts[0][1], "en", "s0") for k in range(5)]
    near = texts[1][1].split()
    near[70] = "other"
    texts += [(200, " ".join(near), "en", "s1"), (300, words(80) + " " + passage, "en", "s0"), (301, passage + " " + words(80), "en", "s1")]
    texts += [(400, None, "en", "s0"), (401, "", None, None), (402, "123 456", "en", "s0"), (403, words(50), None, None)]
    return texts, passage


def test_stages(spark, documents):
    rows, passage = corpus()
    docs = documents(rows).selectExpr("*", "'x' as document", "'x' as copies", "'x' as copy", "'x' as _copies", "'x' as `a.b`")
    steps = dict(corpus_pipeline.STAGES)
    kept = steps["language"](spark, docs, "").cache()
    assert kept.columns == docs.columns
    assert {r[0] for r in rows} - {r.doc_id for r in kept.collect()} == {400, 401, 402}
    assert kept.where("doc_id = 403").first().lang == "en"
    unique = steps["near-dedup"](spark, kept, "").cache()
    assert unique.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} - {r.doc_id for r in unique.collect()} == {100, 101, 102, 103, 104, 200}
    cut = steps["passages"](spark, unique, "").cache()
    assert cut.columns == docs.columns
    texts = {r.doc_id: r.text for r in cut.collect()}
    before = {r.doc_id: r.text for r in unique.collect()}
    assert {k for k in texts if texts[k] != before[k]} == {300, 301}
    assert passage not in texts[300] and texts[300] == before[300].removesuffix(passage).rstrip() + texts[300][len(texts[300].rstrip()) :]
    mixed = steps["mixture"](spark, cut, "").cache()
    assert mixed.columns == docs.columns
    assert {r["count"] for r in mixed.groupBy("doc_id").count().collect()} <= {1, 2}
    packed = steps["packing"](spark, mixed, "")
    assert packed.where("piece = 0").count() == mixed.count()
    for frame in (kept, unique, cut, mixed):
        frame.unpersist()


def test_one_row_of_an_id_stays(spark, documents):
    rows = [(1, "b text of its own", "en", "s"), (1, "a text of its own", "en", "s"), (1, None, "en", "s"), (2, "words", "fr", "t"), (2, "words", "en", "t")]
    for docs in (documents(rows), documents(rows[::-1])):
        kept = sorted(tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, "").select("doc_id", "text", "lang").collect())
        assert kept == [(1, None, "en"), (2, "words", "en")]


def test_empty_and_unlabelled_tables(spark, documents):
    empty = documents([])
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, empty, "")
        assert out.count() == 0 and (name == "packing" or out.columns == empty.columns)
    unlabelled = documents([(1, "some text", None, None), (2, "12", None, None)])
    assert [r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, unlabelled, "").collect()] == [1]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="shared tables not here")
@pytest.mark.parametrize("name", ORACLES)
def test_queries_match_their_sql(spark, name):
    import duckdb

    duck = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    wanted = duck.execute(ORACLES[name])
    columns = [d[0] for d in wanted.description]
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(columns) == sorted(got.columns)
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == sorted(wanted.fetchall())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="shared tables not here")
def test_the_contract_names_every_query(spark):
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert {"doc_id", "sequence_id", "offset"} <= set(contract.queries()["pipeline"](spark, SF_DIR).columns)
