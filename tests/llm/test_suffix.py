import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import suffix


def brute(texts, length):
    parts = [(x or "").encode() for x in texts]
    seen = Counter(b[k : k + length] for b in parts for k in range(len(b) - length + 1))
    out = []
    for b in parts:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def cases(rng):
    def words(n):
        return " ".join("".join(rng.choices("abcdeé", k=rng.randrange(1, 7))) for _ in range(n))

    passage, long = words(90), words(3000)
    texts = [None, "", "short", "short", passage, "x" + passage, words(30) + passage + words(20) + passage[50:]]
    texts += ["a" * 700, "ab" * 110, "abc" * 67 + "d", "z" + "ab" * 104, long, long, long[:4000] + "!" + long[4000:]]
    for _ in range(25):
        at = rng.randrange(len(long) - 400)
        texts.append(words(20) + long[at : at + rng.randrange(150, 400)] + words(15))
    return texts


@pytest.mark.parametrize(("slice_bytes", "index_bytes"), [(1 << 20, 1 << 20), (700, 3000)])
def test_against_brute_force(documents, rows_of, monkeypatch, slice_bytes, index_bytes):
    """Also with slices that cut texts, and keys too crowded for one index."""
    monkeypatch.setattr(suffix, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(suffix, "INDEX_BYTES", index_bytes)
    runs = suffix._runs

    def sliced(*args, **more):
        suffix.SLICE_BYTES = slice_bytes
        return runs(*args, **more)

    monkeypatch.setattr(suffix, "_runs", sliced)
    texts = cases(random.Random(4))
    found = rows_of(suffix.remove_repeats(documents(texts)).drop("kept"))
    assert [found[k] for k in range(len(texts))] == [[x] for x in brute(texts, 200)]


def test_nulls_repeated_ids_and_carried_columns(documents):
    text = "".join(chr(97 + k * k % 23) for k in range(260))
    rows = [(None, text), (1, text), (1, text[:230]), (1, None), (2, "é" * 150)]
    found = suffix.remove_repeats(documents(rows), carry=("source", "key")).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in found) == [
        (0, 260, 260), (1, 0, 0), (1, 230, 230), (1, 260, 260), (2, 300, 300)
    ]
    assert {r.carried.key for r in found} == {"x"}
    assert suffix.remove_repeats(documents([])).count() == 0


def test_matching_statistics():
    rng = random.Random(2)
    for alphabet in ("ab", "abcdefgh"):
        strings = sorted({"".join(rng.choices(alphabet, k=rng.randrange(1, 40))) for _ in range(30)})
        text = np.concatenate([np.append(np.frombuffer(s.encode(), np.uint8).astype(np.uint16), 256) for s in strings])
        flat = text.tolist()

        def shared(i, j):
            n = 0
            while max(i, j) + n < len(flat) and flat[i + n] == flat[j + n]:
                n += 1
            return n

        index = suffix.RunIndex(text)
        expected = [max(shared(i, j) for j in range(len(flat)) if j != i) for i in range(len(flat))]
        assert index.matching_statistics().tolist() == expected
        assert index.runs <= len(flat)


def most_held(make):
    tracemalloc.start()
    try:
        out = [x for x in make()]
        return tracemalloc.get_traced_memory()[1] / 1e6, out
    finally:
        tracemalloc.stop()


def test_a_worker_holds_little():
    """In MB, for 2 MB of text: two workers share what an executor has besides its heap."""
    rng = np.random.default_rng(6)
    flat = rng.integers(97, 123, 2 << 20).astype(np.uint8)
    offsets = np.arange(0, len(flat) + 1, 1 << 12)
    mb, runs = most_held(lambda: suffix._runs(flat, offsets, 200, twins=True))
    assert mb < 60 and sum(int(x[2].sum()) for x in runs) == (len(offsets) - 1) * ((1 << 12) - 199)

    segs = [flat[k * 1000 : k * 1000 + 400].tobytes() for k in range(2000)]
    rows = [(k, 2 * k + s, seg) for k, seg in enumerate(segs) for s, seg in enumerate((seg, b"x" + seg[:300]))]
    h, s, seg = zip(*rows, strict=True)
    batch = pa.RecordBatch.from_arrays([pa.array(h), pa.array(s), pa.array(seg), pa.array([1] * len(rows))], names=["h", "s", "seg", "copies"])
    mb, found = most_held(lambda: suffix._resolve(200)(iter([batch])))
    assert mb < 60
    runs = [x for part in found for x in part.to_pylist()]
    assert [(x["h"], x["s"], x["runs"]) for x in runs] == [
        (k, 2 * k + s, [{"off": s, "n": 101}]) for k in range(2000) for s in (0, 1)
    ]
