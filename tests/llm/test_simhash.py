import random
import re

import numpy as np
import pytest
import xxhash

from millrace.llm import simhash
from millrace.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")


def fingerprint(text, shingle=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    rows = [" ".join(words[k : k + shingle]) for k in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in rows]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(prints, radius):
    """The smallest id that each id reaches."""
    least = {k: k for k in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= radius and least[b] < least[a]:
                    least[a], changed = least[b], True
    return least


def test_groups_against_brute_force(documents, rows_of):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    base = [" ".join(rng.choices(words, k=120)) for _ in range(12)]
    texts = [None, "", " \n", "One", "one", "É one two", *base, *base[:4]]
    for text in base * 4:
        own = text.split()
        own[rng.randrange(len(own))] = "changed"
        texts.append(" ".join(own))
    texts.append("long " * 20_000)
    prints = {k: fingerprint(x) for k, x in enumerate(texts)}
    expected = brute(prints, 2)
    found = rows_of(simhash.simhash_groups(documents(texts)))
    assert {k: v[0][0] % (1 << 64) for k, v in found.items()} == prints
    assert {k: v[0][1] for k, v in found.items()} == expected
    assert len(set(expected.values())) < len(texts) - 4


def test_null_and_repeated_ids(documents):
    rows = [(None, "a b c"), (5, "a b c"), (5, "a b c"), (None, "x y z q"), (2, "")]
    found = sorted((r.doc_id or -1, r.component_id or -1) for r in simhash.simhash_groups(documents(rows)).collect())
    assert found == [(-1, -1), (-1, 5), (2, 2), (5, 5), (5, 5)]
    assert simhash.simhash_groups(documents([])).count() == 0


@pytest.mark.parametrize(("radius", "bucket"), [(2, 20_000), (2, 5), (6, 40)])
def test_all_close_pairs_are_joined(spark, radius, bucket):
    """Clusters of fingerprints that differ by some bits, with buckets that must be split."""
    rng = random.Random(radius * bucket)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(radius + 3))))
    prints = dict(enumerate(sorted(prints)))
    rows = [(k, v - (1 << 64) if v >> 63 else v) for k, v in prints.items()]
    nodes = spark.createDataFrame(rows, "node long, f0 long")
    links = simhash.close_pairs(nodes, radius, bucket=bucket)
    least = dict(components(links).collect())
    expected = brute(prints, radius)
    assert {k: least.get(k, k) for k in prints} == expected


def test_further_words_verify(spark):
    rows = [(1, 0, 0), (2, 1, 1), (3, 3, -1)]
    nodes = spark.createDataFrame(rows, "node long, f0 long, f1 long")
    assert {tuple(r) for r in simhash.close_pairs(nodes, 2, words=2, far=4).collect()} == {(1, 2)}


def test_allocation_covers_every_difference():
    rng = np.random.default_rng(1)
    agree = np.full((64, 64), 0.25) + np.diag(np.full(64, 0.25))
    for radius, n in ((2, 10), (2, 10**9), (5, 10**6)):
        probes = simhash.allocate(n, agree, radius)
        for _ in range(300):
            diff = sum(1 << int(b) for b in rng.choice(64, radius, replace=False))
            assert any(p.mask & diff == 0 for p in probes)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    rng.shuffle(edges)
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{k: 0 for k in range(1, 41)}, **{k: 100 for k in range(101, 160)}, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_join_what_groups_join(documents, spark):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(300)]
    base = [" ".join(rng.choices(words, k=120)) for _ in range(8)]
    texts = [None, "", *base, *base[:4], *(f"{x} changed" for x in base)]
    rows = [*enumerate(texts), (None, base[0])]
    groups = {r.doc_id: r.component_id for r in simhash.simhash_groups(documents(rows), 5, 6).collect() if r.doc_id is not None}
    links = simhash.simhash_links(documents(rows), 5, 6)
    assert links.where("a <= b or a is null or b is null").count() == 0
    least = dict(components(links).collect())
    assert {k: least.get(k, k) for k in groups} == groups
    assert len(set(groups.values())) < len(texts) - 4
