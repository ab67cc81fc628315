"""Token ids and token counts of whole texts, piece by piece through worker caches.

Both vocabularies never merge across the pieces that white space cuts, so a text is the
sequence of its pieces and each distinct piece need be encoded only once per worker.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.common import hash_sample, renamed, tune, whole

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces of a generation of a worker's cache. A full one becomes the old one, and pieces
#: met again move over to the new: the frequent ones stay.
CACHE_PIECES = 250_000
#: Documents whose pieces are counted for the broadcast table, its rows, and the longest
#: piece it holds: together they bound its size.
TABLE_DOCS = 2_000
TABLE_ROWS = 50_000
TABLE_PIECE = 48

#: The characters that the vocabularies' patterns call white space.
SPACE = "\t-\r \x85\xa0  -     　"
#: A piece is a run without white space with one blank before it, if there is one; of
#: other white space, all but what directly precedes a piece, then that.
PIECES = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def vocabulary(name: str) -> str:
    """A path is taken as it is, a bare name as one of the installed public files."""
    return name if os.path.sep in name else public_tokenizers.path(name)


class Generations(dict):
    """What was made of the pieces met, in two generations, besides a given table."""

    def __init__(self, given: dict) -> None:
        super().__init__(given)
        self.given, self.old = given, {}

    def __missing__(self, piece: str):
        value = self.old.get(piece)
        if value is None:
            value = self.make(piece)
        if len(self) >= len(self.given) + CACHE_PIECES:
            self.old = dict(self)
            self.clear()
            self.update(self.given)
        self[piece] = value
        return value


class PieceCounts(Generations):
    """How many tokens a piece has: first the frequent pieces, then those met since."""

    def __init__(self, name: str, frequent: dict[str, int]) -> None:
        super().__init__(frequent)
        self.tokenizer = Tokenizer.from_file(vocabulary(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = re.compile("|".join(re.escape(x.content) for x in added) or r"(?!)")

    def make(self, piece: str) -> int:
        return len(self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def count(self, text: str) -> int:
        """The special strings are one token each; what is between them stands alone."""
        parts = self.special.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, PIECES.findall(x))) for x in parts)


_counts: dict[tuple, PieceCounts] = {}


def _counter(name: str, key: str, frequent: dict[str, int]) -> PieceCounts:
    """A worker's cache, kept from task to task of one run."""
    if (name, key) not in _counts:
        _counts.clear()
        _counts[name, key] = PieceCounts(name, frequent)
    return _counts[name, key]


def frequent_pieces(
    docs: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text"
) -> dict[str, int]:
    """The token counts of the most frequent pieces in a bounded sample of documents:
    the ``TABLE_DOCS`` first by the hash of their id and text. It only saves work: a piece that
    is not in it is encoded where it is met."""
    tune(docs.sparkSession)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found.update(x for x in PIECES.findall(text) if len(x) <= TABLE_PIECE)
        best = found.most_common(TABLE_ROWS)
        own = PieceCounts(name, {})
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in best], pa.string()), pa.array([own[x] for x, _ in best], pa.int32())],
            names=["piece", "n"],
        )

    source = renamed(docs, id=id_col, text=text_col).select("id", whole("text").alias("text"))
    sample = hash_sample(source, TABLE_DOCS, "id", "text").select("text")
    rows = sample.coalesce(1).mapInArrow(tally, "piece string, n int").toPandas()
    return dict(zip(rows["piece"].tolist(), rows["n"].tolist(), strict=True))


def count_tokens(
    docs: DataFrame,
    name: str = "byte_bpe_50k.json",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_bytes, n_tokens) of every text, in one pass without a shuffle.

    Tier one is a broadcast table of the frequent pieces' counts, tier two each worker's
    cache of the pieces it has met; whatever neither holds is encoded. Null and empty
    texts have no tokens; repeated rows stay; a null id stays null; other columns are not
    read.
    """
    spark = docs.sparkSession
    tune(spark)
    table = spark.sparkContext.broadcast(frequent_pieces(docs, name, id_col, text_col))
    run_id = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(name, run_id, table.value)
        for batch in batches:
            n = [counter.count(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(n, pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    source = renamed(docs, id=id_col, text=text_col).select(
        "id", whole("text").alias("text"), F.octet_length(whole("text")).cast("long").alias("n_bytes")
    )
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)


class WordIds(Generations):
    """The ids of a run without ASCII white space, as little-endian unsigned 32-bit
    bytes, for a vocabulary of byte pairs with word ends.

    Runs of plain Latin letters, digits and signs go through the merges alone. The word
    end is a byte that UTF-8 never has, joined to the last byte before all other merges.
    Every other run goes to the library, which knows how to normalise it.
    """

    def __init__(self, name: str) -> None:
        super().__init__({})
        path = vocabulary(name)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        model = parts["model"]
        self.words = regex.compile(parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        special = [x["content"] for x in parts["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)").search
        suffix = model["end_of_word_suffix"]
        vocab = model["vocab"]
        shown = _shown_bytes()

        def as_bytes(token: str) -> bytes:
            end = token.endswith(suffix)
            return bytes(shown[c] for c in (token[: -len(suffix)] if end else token)) + b"\xff" * end

        single = {as_bytes(k): v for k, v in vocab.items() if k not in special}
        ranks = {bytes([b]): b for b in range(256)}
        ids = [single.get(bytes([b]), 0) for b in range(256)]
        for end in (bytes([b, 255]) for b in range(256)):
            if end in single:
                ranks[end] = len(ids)
                ids.append(single[end])
        for pair in model["merges"]:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            ranks[as_bytes(left + right)] = len(ids)
            ids.append(vocab[left + right])
        self.ids = [x.to_bytes(4, "little") for x in ids]
        self.joined = b"".join
        self.merges = tiktoken.Encoding(
            "words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={}
        )._core_bpe.encode_single_piece

    #: Characters that normalising leaves alone but for their case, which has one letter.
    plain = re.compile("[!-~\xa1-\xa7\xa9\xab-\xae\xb0\xb1\xb6\xb7\xbb\xbf-\xff]+").fullmatch

    def make(self, run: str) -> bytes:
        if self.plain(run) and not self.special(run):
            low = run.lower()
            if low.isalpha():
                return self.joined(map(self.ids.__getitem__, self.merges(low.encode() + b"\xff")))
            found = (i for x in self.words.findall(low) for i in self.merges(x.encode() + b"\xff"))
            return self.joined(map(self.ids.__getitem__, found))
        return np.array(self.tokenizer.encode(run, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, _runs(text)))


_runs = re.compile("[^\t\n\r ]+").findall
_words: dict[str, WordIds] = {}


def word_ids(name: str) -> WordIds:
    if name not in _words:
        _words[name] = WordIds(name)
    return _words[name]


def _shown_bytes() -> dict[str, int]:
    """Byte-level vocabularies show a byte as the Latin-1 character of its number, or as
    the next character from U+0100 on where that one isn't printable."""
    shown, beyond = {}, 256
    for b in range(256):
        c = chr(b)
        if b in (0x20, 0xAD) or unicodedata.category(c) in ("Cc", "Zs"):
            c, beyond = chr(beyond), beyond + 1
        shown[c] = b
    return shown
