import random

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import jaccard


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(texts):
    """The smallest id that each id reaches at a Jaccard similarity of 0.8."""
    sets = [shingles(x) for x in texts]
    least = list(range(len(texts)))
    near = [
        (a, b) for b in range(len(sets)) for a in range(b)
        if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in near:
            if least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return least


def corpus():
    """Texts with versions around the threshold, short ones, a large group of near copies,
    and a passage that texts otherwise unlike share."""
    rng = random.Random(8)

    def words(n):
        return rng.choices([f"w{k}" for k in range(2_000)], k=n)

    texts = []
    for size in [8, 9, 12, 14, 30, 60, 120, 300] * 3:
        base = words(size)
        texts.append(" ".join(base))
        for _ in range(5):
            own = list(base)
            for _ in range(rng.randrange(1, 2 + size // 30)):
                own[rng.randrange(size)] = "other"
            texts.append(" ".join(own))
        # From one word after another to a chain whose ends are unlike.
        for k in range(1, 4):
            texts.append(" ".join(base + words(max(1, size // 10 * k))))
    hub, passage = words(100), words(40)
    for _ in range(60):
        texts.append(" ".join([*hub[: rng.randrange(80, 101)], *words(2)]))
    texts += [" ".join(words(30) + passage) for _ in range(40)]
    texts += [None, "", "one", "One", *texts[:3]]
    rng.shuffle(texts)
    return texts


def test_near_dedup_against_brute_force(spark, documents):
    texts = corpus()
    least = brute(texts)
    assert 20 < len({x for x in least if least.count(x) > 1}) and len(set(least)) < len(texts) - 60
    kept = corpus_pipeline.near_dedup(spark, documents(texts), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least))


@pytest.mark.parametrize("frequent", [0, 3])
def test_order_of_shingles_changes_nothing(documents, frequent):
    texts = corpus()
    found = jaccard.jaccard_groups(documents(texts), 5, 0.8, frequent=frequent)
    assert dict(map(tuple, found.collect())) == dict(enumerate(brute(texts)))


def test_parities_never_exceed_what_differs():
    rng = np.random.default_rng(1)
    base = rng.integers(-(2**63), 2**63 - 1, 3_000)
    for n in (0, 1, 10, 500, 3_000):
        for k in (0, 1, 7, 300):
            a, b = np.unique(base[:n]), np.unique(np.concatenate([base[: max(0, n - k)], rng.integers(-(2**63), 2**63 - 1, k)]))
            differ = len(np.setxor1d(a, b))
            told = sum(int(x).bit_count() for x in (jaccard.parities(a) ^ jaccard.parities(b)).view(np.uint64))
            assert told <= differ and (told - differ) % 2 == 0
            assert differ > 100 or 2 * told >= differ


def test_unlike_texts_of_one_key_make_few_pairs(spark, documents, monkeypatch):
    """A large group of texts that share most of their shingles and stay below the threshold."""
    rng = random.Random(9)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for k in range(300):
        own = list(base)
        for at in rng.sample(range(60), 3):
            own[at] = f"x{k}_{at}"
        texts.append(" ".join(own))
    sizes, stage = [], jaccard.stage

    def counted(df, name):
        out = stage(df, name)
        if name == "pairs":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stage", counted)
    found = jaccard.jaccard_groups(documents(texts), 5, 0.8, frequent=3)
    assert dict(map(tuple, found.collect())) == dict(enumerate(brute(texts)))
    assert sum(sizes) < 300 * 299 / 2 / 5


def test_null_and_repeated_ids(documents):
    rows = [(None, "a b c"), (5, "a b c"), (5, "a b c"), (None, "x y z q"), (2, "")]
    found = sorted((r.doc_id or -1, r.component_id or -1) for r in jaccard.jaccard_groups(documents(rows), 5, 0.8).collect())
    assert found == [(-1, -1), (-1, 5), (2, 2), (5, 5), (5, 5)]
    assert jaccard.jaccard_groups(documents([]), 5, 0.8).count() == 0


def test_wide_parities_fold_and_never_exceed_what_differs():
    rng = np.random.default_rng(2)
    base = rng.integers(-(2**63), 2**63 - 1, 9_000)
    for n, m in ((300, 300), (2_000, 2_100), (5_000, 8_900), (9_000, 9_000)):
        a = np.unique(base[:n])
        b = np.unique(np.concatenate([base[: m // 2], rng.integers(-(2**63), 2**63 - 1, m - m // 2)]))
        differ = len(np.setxor1d(a, b))
        told = jaccard.differing(jaccard._wide(a), jaccard._wide(b))
        assert 0.7 * differ <= told <= differ and (told - differ) % 2 == 0
        assert jaccard.differing(jaccard._wide(a), jaccard._wide(a)) == 0
    assert jaccard._wide(base[:200]) is None


def counted_stages(monkeypatch):
    rows, stage = {}, jaccard.stage

    def counted(df, name):
        out = stage(df, name)
        rows[name] = rows.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard, "stage", counted)
    return rows


def test_near_dedup_goes_by_fingerprints(spark, documents, monkeypatch):
    """What fingerprints link and an exact check confirms is not compared again by shingles."""
    rng = random.Random(10)
    texts = []
    for base in range(5):
        words = [f"b{base}w{k}" for k in range(400)]
        texts.append(" ".join(words))
        for k in range(12):
            own = list(words)
            own[rng.randrange(400)] = f"x{base}_{k}"
            texts.append(" ".join(own))
    rows = counted_stages(monkeypatch)
    kept = corpus_pipeline.near_dedup(spark, documents(texts), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute(texts)))
    assert rows["suggested"] >= 60 and rows.get("pairs", 0) == 0


def test_fingerprints_are_checked_exactly(documents):
    """Links that are suggested hold only at the threshold, whatever suggests them."""
    texts = corpus()
    spark = documents(texts).sparkSession
    wrong = spark.createDataFrame([(k, k - 1) for k in range(1, len(texts))] + [(5_000, 1)], "a long, b long")
    found = jaccard.jaccard_groups(documents(texts), 5, 0.8, first=wrong)
    assert dict(map(tuple, found.collect())) == dict(enumerate(brute(texts)))


def test_sets_of_long_unlike_texts_are_not_gathered(documents, monkeypatch):
    """Long texts that share half of their words fill up 1,024 parities, not their own."""
    rng = random.Random(11)
    shared = [f"s{k}" for k in range(3_000)]
    texts = [" ".join([*shared, *(f"t{j}_{rng.random()}" for _ in range(1_500))]) for j in range(6)]
    rows = counted_stages(monkeypatch)
    found = jaccard.jaccard_groups(documents(texts), 5, 0.8)
    assert dict(map(tuple, found.collect())) == {k: k for k in range(6)}
    assert rows["pairs"] > 0 and rows["sets"] == 0
