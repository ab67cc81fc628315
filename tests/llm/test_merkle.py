import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def climb(nodes):
    """The node that remains, and for each leaf its (before, after) siblings by level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = i - i % 16
            ways[k].append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 16])))
        at = [i // 16 for i in at]
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0], ways


def brute(rows):
    """Rows (doc_id, source, lang, n_chars, text) to their result rows."""
    parts = {}
    for row in rows:
        parts.setdefault("" if row[1] is None else "=" + row[1], []).append(row)
    trees = {}
    for part, own in parts.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[part] = climb([leaf_of(r) for r in own])
    names = sorted(trees, key=str.encode)
    root, over = climb([trees[x][0] for x in names])
    out = []
    for part, upper in zip(names, over, strict=True):
        for row, way in zip(parts[part], trees[part][1], strict=True):
            proof = sha("".join(a + b for a, b in way + upper))
            node = leaf_of(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4])
                node = leaf_of((*row[:4], lower))
            for a, b in way + upper:
                node = sha(a + node + b)
            out.append((row[0], leaf_of(row), trees[part][0], root, proof, node, node == root))
    return out


def found(docs, **how):
    tampered = {
        "tampered": lambda c, name: merkle.lowered(c) if name == "text" else c,
        "tampered_where": F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
    }
    return sorted((tuple(r) for r in merkle.merkle_proofs(docs, **tampered, **how).collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_addresses_fill_the_block(levels):
    for leaves in {1, 2, 15, 16, 17, 255, 256, 257, 300, 4095, 4096, 65_536}:
        if leaves > 16 ** (levels - 1):
            continue
        sizes = [-(-leaves // 16**k) for k in range(levels)]
        slots = [merkle.address(k, np.arange(n), leaves, levels) for k, n in enumerate(sizes)]
        assert sorted(np.concatenate(slots).tolist()) == list(range(sum(sizes)))
        assert slots[-1].tolist() == [0]
    if levels == 4:
        # Halves of two levels: the root and its children, then each child's own subtree.
        slots = [merkle.address(k, np.arange(16 ** (3 - k)), 4096, 4) for k in range(4)]
        assert slots[2].tolist() == list(range(1, 17))
        assert slots[1][:3].tolist() == [17, 34, 51] and slots[0][:3].tolist() == [18, 19, 20]


@pytest.mark.parametrize("height", [1, 2, 3])
def test_against_brute_force(spark, documents, height):
    rng = random.Random(height)
    texts = ["Some Text", "lower only", "ÄÖÜ É", "", None, "x" * 50, "A\x00B"]
    rows = [(k, rng.choice(texts), rng.choice(["en", None]), rng.choice(["a"] * 6 + ["b", "ü", "", None])) for k in range(600)]
    rows += [(k + 600, "Word", "en", f"s{k}") for k in range(20)]
    rows += [(5, "Word", "en", "a"), (5, "Word", "en", "a"), (5, "other", "en", "a"), (None, "Null", None, "a"), (None, None, None, None)]
    docs = documents(rows)
    plain = [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]
    got = found(docs, height=height)
    assert got == sorted(brute(plain), key=repr)
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)


def test_a_source_of_many_blocks(spark):
    """Over 4,096 leaves a source stands in several blocks of the height in use."""
    docs = spark.range(9_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 9 == 0, F.lit("small")).otherwise("hot").alias("source"),
        F.lit("en").alias("lang"), F.lit(3).cast("long").alias("n_chars"),
        F.concat(F.lit("Doc "), F.col("id")).alias("text"),
    )
    assert found(docs) == sorted(brute([tuple(r) for r in docs.select(*merkle.FIELDS).collect()]), key=repr)


@pytest.mark.parametrize("rows", [[(1, "One")], [(1, "One"), (2, "Two")], [(1, "One", "en", "a"), (2, "Two", "en", "b")]])
def test_few_rows(documents, rows):
    docs = documents(rows)
    assert found(docs) == sorted(brute([tuple(r) for r in docs.select(*merkle.FIELDS).collect()]), key=repr)


def test_empty_table(documents):
    result = merkle.merkle_proofs(documents([]))
    assert result.count() == 0
    assert result.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
