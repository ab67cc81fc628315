"""Operators that learn: against brute force where there is one, else on held-out rows."""

import random
import re
from collections import Counter

import numpy as np

from millrace.llm import langid, linequality, perplexity

WORD = re.compile("[^\x20\x09-\x0d]+")
SYLLABLES = {"en": ["th", "er", "ing", "on", "wh"], "de": ["sch", "ei", "ung", "ü", "ß"], "fr": ["eau", "é", "ou", "ç", "que"]}


def words(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n))


def test_languages_and_mixtures(documents, rows_of):
    rng = random.Random(1)
    rows = [(k, words(rng, lang, 40), lang, "s") for k, lang in enumerate(["en", "de", "fr"] * 20)]
    model = langid.fit(documents([*rows, (900, None, "en", "s"), (901, "text", None, "s"), (902, None, None, None)]))
    assert model.languages == ["de", "en", "fr"]
    test = [words(rng, lang, 25) for lang in ("en", "de", "fr")] * 5
    mixed = words(rng, "en", 300) + "\n" + words(rng, "de", 100)
    texts = [*test, None, "", "12 34 !?", mixed, mixed, "ß " * 100_000]
    docs = documents(texts).drop("score")
    found = rows_of(langid.predict(docs, model, "doc_id", "key"), "lang_pred", "score", "languages")
    assert [found[k][0][0] for k in range(15)] == ["en", "de", "fr"] * 5
    assert all(found[k][0][1] > 0.9 for k in range(15))
    assert [found[k][0][:2] for k in (15, 16, 17)] == [("und", 0.0)] * 3
    for k in (18, 19):
        pred, score, shares = found[k][0]
        assert pred == "en" and 0.6 < score < 0.9
        assert {s.lang for s in shares} == {"en", "de"} and abs(sum(s.share for s in shares) - 1) < 1e-9
    assert found[20][0][0] == "de"


def test_no_language_to_learn(documents):
    model = langid.fit(documents([(1, "text", None, "s")]))
    assert [tuple(r)[1:3] for r in langid.predict(documents(["some text"]).drop("score"), model, "doc_id").collect()] == [("und", 0.0)]
    assert langid.predict(documents([]).drop("score"), model, "doc_id").count() == 0


def test_expectation_maximisation_ends_at_the_best_shares():
    """Where no share can rise: the slope of each language met is that of the mean."""
    rng = np.random.default_rng(2)
    likelihood, counts = rng.random((300, 4)), rng.integers(0, 5, (6, 300)).astype(float)
    allowed = np.ones((6, 4), bool)
    allowed[3:, 1] = False
    share, reached = langid._mix(counts, likelihood, allowed)
    assert np.allclose(share.sum(1), 1) and not share[3:, 1].any()
    slope = (counts / (share @ likelihood.T)) @ likelihood / counts.sum(1, keepdims=True)
    assert (slope[allowed] < 1.02).all() and np.allclose(slope[share > 0.05], 1, atol=0.02)
    for _ in range(200):
        other = rng.dirichlet(np.ones(4), 6) * allowed
        other /= other.sum(1, keepdims=True)
        assert ((counts * np.log(other @ likelihood.T)).sum(1) <= reached + 0.05).all()


def test_forward_backward_against_all_labellings():
    import itertools

    rng = np.random.default_rng(4)
    row = np.array([0, 0, 0, 0, 1, 2, 2, 2])
    score, pair = rng.normal(size=8), rng.normal(size=(2, 2))
    good, both, log_z = linequality.Chains(row).forward_backward(score, pair)
    pairs = np.zeros((2, 2))
    totals = []
    for chain in range(3):
        at = np.flatnonzero(row == chain)
        weights = {}
        for labels in itertools.product((0, 1), repeat=len(at)):
            value = sum(score[a] * y for a, y in zip(at, labels, strict=True))
            value += sum(pair[x, y] for x, y in itertools.pairwise(labels))
            weights[labels] = np.exp(value)
        z = sum(weights.values())
        totals.append(np.log(z))
        for k, a in enumerate(at):
            assert np.isclose(good[a], sum(w for y, w in weights.items() if y[k]) / z)
        for labels, w in weights.items():
            for x, y in itertools.pairwise(labels):
                pairs[x, y] += w / z
    assert np.allclose(both, pairs) and np.allclose(sorted(log_z), sorted(totals))


def test_line_features_see_each_text_alone():
    texts = ["a b\na b\n\nC!!", "", "\n \n", "the the the", "x", "é é\tü #"]
    flat = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    row, size, features = linequality.line_features(flat, offsets)
    assert row.tolist() == [0, 0, 0, 1, 2, 3, 4, 5]
    assert size.tolist() == [4, 4, 3, 0, 0, 11, 1, 10]
    for k, text in enumerate(texts):
        own = text.encode()
        alone = linequality.line_features(np.frombuffer(own, np.uint8), np.array([0, len(own)]))
        assert np.array_equal(alone[2], features[row == k])
    twice = features[:, -2]
    assert twice.tolist() == [0, 1, 0, 0, 0, 0, 0, 0]


def test_quality_on_held_out_texts(spark, documents, rows_of):
    rng = random.Random(6)
    good = [(k, "\n".join(words(rng, "en", 12) + "." for _ in range(rng.randrange(1, 9)))) for k in range(120)]
    bad = [(200 + k, "\n".join(" ".join(w + "##" for w in words(rng, "en", 12).split()) for _ in range(rng.randrange(1, 9)))) for k in range(40)]
    rows = [(k, t, "en", "s") for k, t in good + bad]
    labels = spark.createDataFrame([(k, int(k < 200)) for k, _ in good + bad if k % 4] + [(500, None)], "doc_id long, quality int")
    odd = [(600, None, "en", "s"), (601, "", "en", "s"), (602, "word " * 200_000, "en", "s")]
    docs = documents([*rows, *odd]).drop("score")
    field = linequality.fit(docs, labels, "quality")
    found = rows_of(linequality.score(docs, field, "doc_id"), "score", "line_quality")
    assert all((found[k][0][0] >= 0.3) == (k < 200) for k, _ in good + bad if k % 4 == 0)
    assert all(0 <= x[0][0] <= 1 for x in found.values())
    assert len(found[0][0][1]) == good[0][1].count("\n") + 1
    nothing = linequality.fit(docs, labels.limit(0), "quality")
    assert all(abs(r.score - 0.5) < 1e-9 for r in linequality.score(docs, nothing, "doc_id").collect())


def test_long_texts_are_fitted_by_true_neighbours():
    row = np.repeat([0, 1, 2], [7, 100, 64])
    use, inner = linequality.stretches(row, np.array([5, -3, 11]), 64)
    assert np.bincount(row[inner]).tolist() == [7, 64, 64]
    features = np.arange(171.0)[:, None] + np.zeros(linequality.N_FEATURES)
    full = linequality.with_neighbours(row, features)
    assert np.array_equal(linequality.with_neighbours(row[use], features[use])[inner[use]], full[inner])
    taken = np.flatnonzero(inner[row == 1])
    assert (np.diff(taken) == 1).all()


def plain_measures(text):
    found = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(found[k : k + 3]) for k in range(len(found) - 2))
    inside = {k + j for k in range(len(found) - 2) if windows[tuple(found[k : k + 3])] > 1 for j in range(3)}
    return (
        len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text),
        sum(lines[k] in lines[:k] for k in range(len(lines))), len(inside),
    )


def test_measures():
    rng = random.Random(9)
    for _ in range(300):
        text = "".join(rng.choices("aab é#|\n\n \t\x0b\x85\xa0", k=rng.randrange(80)))
        assert perplexity.text_measures(text) == plain_measures(text)


def test_kneser_ney_sums_to_one():
    rng = random.Random(3)
    text = "".join(rng.choices("abcde ", weights=[9, 5, 3, 2, 1, 4], k=4000)).encode()
    flat = np.frombuffer(text, np.uint8)
    _, code = perplexity._codes(flat, np.array([0, 1500, 1500, len(flat)]))
    codes, counts = np.unique(code, return_counts=True)
    model = perplexity.Model(codes, counts)
    for context in (b"abc", b"\3\3\3", b"zzz", b"aez"):
        head = np.uint32(int.from_bytes(context, "big")) << np.uint32(8)
        assert np.isclose(np.exp(model.logs(head + np.arange(256, dtype=np.uint32)).astype(float)).sum(), 1, atol=1e-4)


def test_counts_are_those_of_each_language(documents):
    texts = [(1, "abab", "en", "s"), (2, "ab", "fr", "s"), (3, "abab", "en", "s"), (4, "", "en", "s")]
    rows = perplexity.count_ngrams(documents(texts).select("lang", "text")).collect()
    expected = Counter()
    for _, text, lang, _ in texts:
        padded = b"\3\3\3" + text.encode()
        for k in range(len(text)):
            expected[lang, int.from_bytes(padded[k : k + 4], "big")] += 1
    assert {(r.lang, r.code): r.n for r in rows} == expected


def test_perplexity_bands(documents, rows_of):
    rng = random.Random(5)
    rows = [(k, words(rng, lang, 120), lang, "s") for k, lang in enumerate(["en", "de", None] * 40) if lang]
    rows += [(k, words(rng, "fr", 100), None, "s") for k in range(200, 230)]
    odd = [(900, "".join(rng.choices("0123456789QXZ ", k=900)), "en", "s"), (901, None, "en", "s"), (902, "few words", "de", "s")]
    odd += [(903, "same same same " * 40, "en", "s"), (904, None, None, None)]
    result = perplexity.judge(documents([*rows, *odd]))
    found = rows_of(result, *perplexity.MEASURES, "base_failed", "kept")
    for k, text, _, _ in rows + odd:
        assert found[k][0][:5] == plain_measures(text or "")
    assert [found[k][0][5] for k in (900, 901, 902, 903, 904)] == [False, True, True, True, True]
    assert not any(found[k][0][6] for k in (900, 901, 902, 903, 904))
    assert sum(found[k][0][6] for k, *_ in rows) >= len(rows) - 1
    assert perplexity.judge(documents([])).count() == 0
