import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import packing, tokens

ODD = [
    "", " ", "\n\n", "a <|endoftext|>b\n\n<|endoftext|> \n", "it's  DON'T 'S x'll", "ΣΑΣ İx ß ẞ", "x y z\x85q",
    "\x1c a\x1db", "12345 ½ ²³ ª º µ", "A\xadb", "日本語 テキスト", "🙂👍🏽 x", "trail \n", "<|startoftext|>x <|STARTOFTEXT|>",
    "É×÷ø ÿŸ", "é café",
]
SOME = st.text(alphabet="aA1 \n\t'sé´¨¯¸ªºµ²½ß.#<|>\xad·Σ́\x85", max_size=40)


def library(name):
    return Tokenizer.from_file(tokens.vocabulary(name))


@settings(max_examples=300, deadline=None)
@given(SOME)
def test_ids_and_counts_are_the_library_s(text):
    words, counts = tokens.word_ids("word_bpe_49k.json"), tokens._counter("byte_bpe_50k.json", "test", {})
    ids = library("word_bpe_49k.json") if not hasattr(test_ids_and_counts_are_the_library_s, "ids") else None
    ids = ids or test_ids_and_counts_are_the_library_s.ids
    test_ids_and_counts_are_the_library_s.ids = ids
    assert np.frombuffer(words.encode(text), "<u4").tolist() == ids.encode(text, add_special_tokens=False).ids
    assert counts.count(text) == len(counts.tokenizer.encode(text, add_special_tokens=False).ids)


def test_old_generations_lend_to_new_ones(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 3)

    class Upper(tokens.Generations):
        made = 0

        def make(self, piece):
            self.made += 1
            return piece.upper()

    cache = Upper({"given": "GIVEN"})
    assert [cache[x] for x in "abcdab"] == list("ABCDAB") and cache["given"] == "GIVEN"
    assert cache.made == 4 and len(cache) <= 1 + 3


def test_counts_of_whole_texts(documents, rows_of):
    texts = [None, *ODD, "word " * 3000, "same", "same"]
    library_ = library("byte_bpe_50k.json")
    found = rows_of(tokens.count_tokens(documents(texts)))
    for k, text in enumerate(texts):
        text = text or ""
        assert found[k] == [(len(text.encode()), len(library_.encode(text, add_special_tokens=False).ids))]
    assert tokens.count_tokens(documents([])).count() == 0


@pytest.mark.parametrize("capacity", [16, 4096])
def test_packing_round_trip(documents, capacity):
    texts = [None, *ODD, "some more words here " * 40, "same", "same", *(f"n{k} " * (k % 13) for k in range(120))]
    rows = packing.pack(documents(texts), capacity=capacity).collect()
    library_ = library("word_bpe_49k.json")
    by_doc = {}
    for row in rows:
        by_doc.setdefault(row.doc_id, []).append(row)
    for k, text in enumerate(texts):
        ids = [*library_.encode(text or "", add_special_tokens=False).ids, 1]
        pieces = sorted(by_doc[k], key=lambda r: r.piece)
        for n, piece in enumerate(pieces):
            own = ids[n * capacity : (n + 1) * capacity]
            crc = zlib.crc32(np.array(own, "<u4").tobytes())
            assert (piece.piece, piece.start, piece.length, piece.ids_crc32) == (n, n * capacity, len(own), crc)
        assert sum(p.length for p in pieces) == len(ids)
    bins = {}
    for row in rows:
        bins.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in rows)
    assert len(bins) <= -(-total // capacity) * 1.1 + 1
    assert packing.pack(documents([])).count() == 0


def test_rounds_merge_what_tasks_left_open(spark):
    """Sixty-four groups, each with a bin of one sixteenth."""
    pieces = spark.range(64).selectExpr(
        "id", "0 as piece", "0L as start", "256L as length", "0L as ids_crc32", "(id << 33) as bin", "0L as offset",
        "256L as fill", "id as part",
    )
    moved = packing._merge_rounds(pieces, 4096).collect()
    where = {r.bin: (r.into, r.shift) for r in moved}
    ends = {where.get(k << 33, (k << 33, 0)) for k in range(64)}
    assert len(ends) == 64 and len({x for x, _ in ends}) == 4
    assert {x for _, x in ends} == set(range(0, 4096, 256))


def test_rounds_leave_bins_as_full_as_if_all_went_on(spark):
    """Against rounds in plain Python that hand on every bin; most are more than half full."""
    rng = random.Random(8)
    groups = [[rng.choice([33, 34, 40, 47, 48, 63, 64]) for _ in range(400)] + [rng.randrange(1, 33)] for _ in range(70)]
    rows = [(k, 0, 0, x, 0, (g << 33) + k, 0, x, g) for g, own in enumerate(groups) for k, x in enumerate(own)]
    shape = "id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, fill long, part long"
    moved = {r.bin: (r.into, r.shift) for r in packing._merge_rounds(spark.createDataFrame(rows, shape), 64).collect()}
    found = {}
    for row in rows:
        into, shift = moved.get(row[5], (row[5], 0))
        found.setdefault(into, []).append((shift, row[3]))
    for own in found.values():
        assert [at for at, _ in sorted(own)] == [sum(x for _, x in sorted(own)[:k]) for k in range(len(own))]
    while len(groups) > 1:
        merged = [sum(groups[k : k + packing.FAN_IN], []) for k in range(0, len(groups), packing.FAN_IN)]
        groups = [packing.best_fit(own, 64)[2] for own in merged]
    assert sorted(sum(x for _, x in own) for own in found.values()) == sorted(groups[0])
    assert sum(packing.goes_on([40] * 400, 64, 2)) == 2 * packing.FAN_IN


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_best_fit_is_a_packing(sizes):
    bin_of, offset, fill = packing.best_fit(sizes, 32)
    for b in range(len(fill)):
        own = sorted((offset[k], sizes[k]) for k in range(len(sizes)) if bin_of[k] == b)
        assert [x for x, _ in own] == [sum(y for _, y in own[:k]) for k in range(len(own))]
        assert fill[b] == sum(y for _, y in own) <= 32
    assert sum(1 for x in fill if x <= 16) <= 1
