import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    """Documents (id, text) and items (id, text) to (item, rank, id, score)."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    n = sum(1 for _, b in bags if b)
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(x for _, b in bags for x in b)
    queries, out = {}, []
    for item, text in items:
        queries.setdefault(item, []).extend(terms(text))
    for item, query in queries.items():
        scored = []
        for doc, bag in bags:
            score = 0
            for x in query:
                if tf := bag[x]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1)))
                    m = 100 - 75 + (75 * sum(bag.values()) * n) // total
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc is not None, doc))
        out += [(item, r, doc, -score) for r, (score, _, doc) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def found(docs, items, **how):
    return sorted((tuple(r) for r in lexical.rank_documents(docs, items, **how).collect()), key=repr)


def corpus(rng, n, words=400):
    """Texts in which some words are in nearly all documents and most are rare."""
    vocab = [f"w{k}" for k in range(words)] + ["ÀB", "é", "x1", "日本"]
    odds = [1 / (k + 1) for k in range(len(vocab))]
    texts = []
    for _ in range(n):
        text = rng.choice([" ", "-", "\n", "\x7f"]).join(rng.choices(vocab, odds, k=rng.choice([0, 1, 5, 30, 200])))
        texts.append(text.upper() if rng.random() < 0.1 else text)
    return texts


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' as term", "'y' as doc_id")


@pytest.mark.parametrize("k", [1, 10])
def test_against_brute_force(documents, items, k):
    rng = random.Random(k)
    texts = corpus(rng, 3_000)
    texts += texts[:50] + [None, "", "...", "w0 " * 5_000]
    rows = list(enumerate(texts)) + [(7, texts[7]), (None, "w3 w9 é"), (None, "w3 w9 é")]
    asked = [(k, x) for k, x in enumerate(corpus(rng, 60))] + [(100, "w0"), (101, "w0 w0 w399 É é"), (102, None), (103, "?!"), (104, "unknown"), (100, "w0")]
    got = found(documents(rows), items(asked), k=k)
    assert got == brute(rows, asked, k)
    assert len({g[0] for g in got}) > 40


def test_empty_tables(documents, items):
    assert found(documents([]), items([(1, "a")])) == []
    assert found(documents(["a b"]), items([])) == []
    assert found(documents([None, ""]), items([(1, "a")])) == []


def test_terms_of_long_texts(monkeypatch):
    text = ("ab,CD" * 50 + " " + "é" * 300 + "\n") * 20
    wanted = [x.encode() for x in terms(text)]
    for size in (1, 7, 100, 1 << 20):
        monkeypatch.setattr(lexical, "CUT_BYTES", size)
        assert [x for own in lexical.terms_of(text.encode()) for x in own] == wanted


def test_numbers_survive_packing():
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.integers(0, 1 << b, 50) for b in (1, 7, 8, 14, 21, 40, 62)])
    assert lexical.unpacked(lexical.packed(values)[0]).tolist() == values.tolist()


def segment(texts):
    made = lexical.Segment()
    for k, text in enumerate(texts):
        made.add(k, text.encode())
    rows = made.rows(0, lexical.pa.int64()).to_pylist()
    documents, total = rows[0]["n"], rows[0]["total"]
    norms = lexical.norms(rows[0]["lengths"], documents, total)
    norm_of = dict(zip(rows[0]["lengths"], norms.tolist(), strict=True))
    for row in rows[1:]:
        row["bound"] = lexical.impact(row["most"], norm_of[row["least"]])
    lists = [lexical.PostingList(row) for row in rows[1:]]
    weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * row["n"] + 1))) for row in rows[1:]]
    return lexical.Searcher(lists, norms, norm_of, 10), {row["term"]: k for k, row in enumerate(rows[1:])}, weights


def test_blocks_are_rejected_without_being_opened():
    rng = random.Random(5)
    texts = corpus(rng, 6_000)
    for k in range(12):
        texts[k] = "rare " * 30
    searcher, number, weights = segment(texts)
    query = [(number[x], weights[number[x]]) for x in ("rare", "w0", "w1", "w2")]
    got = searcher.search(query)
    assert {d for d, _ in got} <= set(range(12)) and len(got) == 10
    frequent = searcher.lists[number["w0"]]
    assert len(frequent.opened) < len(frequent.last) / 4
    wanted = brute(list(enumerate(texts)), [(0, "rare w0 w1 w2")])
    assert sorted(got) == sorted((d, s) for _, _, d, s in wanted)
