"""Secrets in texts, by patterns and by assignment-aware lexing.

Source and configuration syntax is read as pairs of a name and a value: assignments, typed
declarations, keyed entries, arguments, options, elements and setter calls. A value is a chain
of literals and names; names stand for the literals that they were given elsewhere in the
text. A literal is scored by the most sensitive name that it reaches.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import renamed, tune, whole

KINDS = ("assign", "access", "hex", "named")
#: The least score of a name and literal that are reported.
LEAST_SCORE = 0.5

#: The patterns that always count, and how long a match of each must be.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

#: How sensitive a word of a name, or two in a row, makes it.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "secret": 1.0, "secrets": 1.0,
    "token": 1.0, "tokens": 1.0, "apikey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "privatekey": 1.0, "authkey": 1.0,
    "signingkey": 1.0, "encryptionkey": 1.0, "masterkey": 1.0, "accountkey": 1.0, "sharedkey": 1.0, "storagekey": 1.0,
    "credential": 0.8, "credentials": 0.8, "creds": 0.8, "bearer": 0.8, "auth": 0.7, "authorization": 0.7, "key": 0.55,
}
#: A name that ends in one of these, or holds one of the second set, is no secret's.
HARMLESS = set(
    "id ids name names path file dir url uri host port endpoint length len size count min max limit type kind field label"
    " prompt hint error message msg regex pattern policy rule expiry expires ttl age time date param header column"
    " placeholder example version index format provider manager class service helper status state enabled required".split()
)
NEVER = {"public", "primary", "foreign", "sort", "cache", "hot", "keyboard", "test", "dummy", "example"}
#: Calls that read something rather than set it.
READERS = set("get fetch read load has is check validate verify find parse decode require input prompt ask print log".split())
#: Every sensitive name holds one of these.
ROOTS = ("pass", "pwd", "secret", "token", "key", "cred", "auth", "bearer")

_NAME = r"[A-Za-z_$@][\w$]*+(?:(?:\.|->|::|-)[A-Za-z_][\w$]*+)*+"
_TYPE = r"[A-Za-z_][\w.|]*+(?:\[[\w., |]*+\])?+"
SITE = re.compile(
    rf"""(?<![\w$@])(?:
      --(?P<option>{_NAME})(?:=|[ \t]++)
    | <(?P<element>{_NAME})>
    | (?P<call>{_NAME})\([ \t]*+(?=["'`])
    | (?:(?P<q>["'`])(?P<quoted>{_NAME})(?P=q)|(?P<bare>{_NAME}))
      [ \t]*+\]?[ \t]*+
      (?::[ \t]*+{_TYPE}[ \t]*+(?==[^=]))?
      (?::=|=>|=(?![=>])|:(?![:/=]))[ \t]*+
    )""",
    re.X | re.A,
)
STRING = re.compile(
    r'''[rbfuRBFU@$]{0,2}(?:"""(?P<a>(?:[^\\]|\\.)*?)"""|"(?P<b>(?:[^"\\\n]|\\.)*+)"|'(?P<c>(?:[^'\\\n]|\\.)*+)'|`(?P<d>[^`\n]*+)`)''',
    re.S,
)
REFERENCE = re.compile(rf"({_NAME})", re.A)
BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>]++""")
JOIN = re.compile(r"""[ \t]*+(?:(?:\+|\.\.?|&)[ \t]*+(?:\\?\n[ \t]*+)?(?=["'`A-Za-z_$])|(?:\\\n[ \t]*+)?(?=["'`]))""")
SCHEME = re.compile(r"(?:Bearer|Basic|Token)[ \t]++", re.A | re.I)
CONTENT = re.compile(r"\s*+([^<\s](?:[^<]*[^<\s])?)\s*+</")
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
PLACEHOLDER = re.compile(
    r"""(.)\1*$|[<{%]|\$[({A-Za-z_]|(?:your|my|the|some|example|sample|test|dummy|fake|change|insert|enter|replace|place|todo
    |none|null|nil|undefined|true|false|default|redacted|hidden|secret|password|token)(?:[^A-Za-z]|$|me|holder)""",
    re.I | re.A | re.X,
)


def words_of(name: str) -> list[str]:
    return [x.lower() for x in WORDS.findall(name)]


def sensitivity(name: str) -> float:
    """0 to 1, by the words of a name in any of the usual spellings."""
    words = words_of(name)
    if not words or words[-1] in HARMLESS or not NEVER.isdisjoint(words):
        return 0.0
    pairs = [a + b for a, b in zip(words, words[1:], strict=False)]
    return max((SENSITIVE.get(x, 0.0) for x in (*words, *pairs)), default=0.0)


def plausibility(value: str, quoted: bool, phrase: bool = False) -> float:
    """0 to 1: whether a literal looks like a secret, by its variety of characters. Plain words
    hardly do, and unquoted ones not at all; several words only where the name says so."""
    if len(value) < 6 or PLACEHOLDER.match(value):
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    score = min(1.0, entropy / 3.5)
    if n < 8:
        score *= 0.7
    if not phrase and any(x.isspace() for x in value):
        score *= 0.4
    if value.isalpha() and (value.islower() or value.isupper() or value.istitle()):
        score *= 0.45
    if not quoted and not (any(x.isdigit() for x in value) and any(x.isalpha() for x in value)):
        score *= 0.4
    return score


class Part(NamedTuple):
    """A piece of a value: a literal's place in the text, or the name that stands there."""

    start: int
    end: int
    quoted: bool
    name: str | None


def _plain(name: str) -> str:
    """The last part of a name, under which its constant is known."""
    return re.split(r"\.|->|::", name)[-1].lstrip("$@")


def _value(text: str, at: int, element: bool) -> list[Part]:
    if element:
        found = CONTENT.match(text, at)
        return [Part(*found.span(1), True, None)] if found else []
    parts: list[Part] = []
    while True:
        if found := STRING.match(text, at):
            start, stop = found.span(next(x for x in "abcd" if found[x] is not None))
            scheme = SCHEME.match(text, start, stop)
            parts.append(Part(scheme.end() if scheme else start, stop, True, None))
        elif scheme := SCHEME.match(text, at):
            at = scheme.end()
            continue
        elif found := BARE.match(text, at):
            if text.startswith("(", found.end()):
                return parts
            name = REFERENCE.fullmatch(found[0])
            parts.append(Part(*found.span(), False, _plain(name[1]) if name else None))
        else:
            return parts
        joined = JOIN.match(text, found.end())
        if not joined:
            return parts
        at = joined.end()


def pairs(text: str) -> Iterator[tuple[str, int, list[Part]]]:
    """The names that are given a value, where, and the values."""
    for site in SITE.finditer(text):
        name = site["option"] or site["element"] or site["call"] or site["quoted"] or site["bare"]
        if site["call"] and words_of(name)[:1] and words_of(name)[0] in READERS:
            continue
        if value := _value(text, site.end(), site["element"] is not None):
            yield name, site.start(), value


class Constants:
    """What each name of a text was given, and where."""

    def __init__(self, found: list[tuple[str, int, list[Part]]]):
        self.known: dict[str, tuple[list[int], list[list[Part]]]] = {}
        for name, at, value in found:
            places, values = self.known.setdefault(_plain(name), ([], []))
            places.append(at)
            values.append(value)

    def literals(self, value: list[Part], at: int) -> list[Part]:
        """The literals that a value at a place consists of, in order: a name stands for the
        last value it was given before, or else its first. A name that no value is known of
        is an unquoted literal; one met again adds nothing."""
        out, rest, seen = [], [(x, at) for x in reversed(value)], set()
        while rest:
            part, here = rest.pop()
            if part.name not in self.known or part.name in seen:
                if part.name not in seen:
                    out.append(part)
                continue
            seen.add(part.name)
            places, values = self.known[part.name]
            k = max(0, bisect_left(places, here) - 1)
            rest.extend((x, places[k]) for x in reversed(values[k]))
        return out


def named_literals(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, name, score) of the literals that reach a sensitive name. A value of
    several literals is scored as a whole."""
    found = list(pairs(text))
    constants = Constants(found)
    best: dict[tuple[int, int], tuple[float, str]] = {}
    for name, at, value in found:
        weight = sensitivity(name)
        if weight < LEAST_SCORE:
            continue
        literals = constants.literals(value, at)
        joined = "".join(text[x.start : x.end] for x in literals)
        score = weight * plausibility(joined, all(x.quoted for x in literals), "passphrase" in words_of(name))
        if score < LEAST_SCORE:
            continue
        for x in literals:
            if x.end > x.start and score > best.get((x.start, x.end), (0.0, ""))[0]:
                best[x.start, x.end] = score, name
    return sorted((start, end, name, score) for (start, end), (score, name) in best.items())


def scan(text: str) -> list[tuple[str, int, int, str | None, float]]:
    """(kind, start, end, name, score) in code points, by start and then kind. A named literal
    inside a span of ``assign`` or ``access`` is not said twice."""
    lower = text.lower()
    suspect = any(root in lower for root in ROOTS)
    out: list[tuple[str, int, int, str | None, float]] = []
    if suspect:
        out += [("assign", *m.span(), m[1], 1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    out += [("access", *m.span(), None, 1.0) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    told = sorted((a, b) for _, a, b, _, _ in out)
    out += [("hex", *m.span(), None, 1.0) for m in HEX.finditer(text)]
    if suspect:
        at, reached = 0, 0
        for start, end, name, score in named_literals(text):
            while at < len(told) and told[at][0] <= start:
                reached = max(reached, told[at][1])
                at += 1
            if end > reached:
                out.append(("named", start, end, name, score))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


FINDINGS = "array<struct<kind: string, start: int, end: int, name: string, score: double>>"


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, findings) for every row: all secrets of the whole text, in code points, ends
    exclusive, by start and then kind.

    Kinds ``assign``, ``access`` and ``hex`` are fixed patterns; ``named`` are literals that reach
    a sensitive name. A null text is empty; empty texts have no findings; repeated rows and
    null ids stay; other columns are not read. A text is read by one task in one pass over
    its characters; what is kept beside it are its name and value pairs.
    """
    spark = docs.sparkSession
    tune(spark)
    source = renamed(docs, id=id_col, text=text_col).select("id", whole("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("name", pa.string()), ("score", pa.float64())]))
        names = ("kind", "start", "end", "name", "score")
        for batch in batches:
            found = [[dict(zip(names, x, strict=True)) for x in scan(text.as_py())] for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, kind)], names=["id", "findings"])

    id_type = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {id_type}, findings {FINDINGS}").withColumnRenamed("id", id_col)


def span_list(findings: Column) -> Column:
    """kind:start:end of each finding, comma-joined."""
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def of_kinds(findings: Column, *kinds: str) -> Column:
    return F.filter(findings, lambda x: x["kind"].isin(*kinds))
