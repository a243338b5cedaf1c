"""Secret scans: fixed patterns, and Shannon entropy in a sliding window per character class.

Candidate strings are the longest runs of a class's characters. A window moves along each; the
counts of its characters change by one entering and one leaving character, and the sum that the
entropy needs changes with them. Windows at or above the class's entropy are joined to spans.
Strings that an allow-list knows as harmless give none, and neither do spans that lie within one
of a narrower class. Patterns are reported besides, whatever the windows say. Sums are whole numbers, so the order of steps changes nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS = "array<struct<kind:string,start:int,end:int>>"
#: Name, pattern, group whose length counts, least length of it.
PATTERNS = (
    (
        "assign",
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.IGNORECASE | re.ASCII,
        ),
        2,
        8,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]{32,}"), 0, 32),
)


class Alphabet(NamedTuple):
    """A character class: its characters, the window's length and the bits that make it suspect."""

    kind: str
    characters: str
    window: int
    bits: float


#: Narrow classes first: what one has reported, a later one does not report again.
ALPHABETS = (
    Alphabet("entropy_hex", "0-9A-Fa-f", 20, 3.0),
    Alphabet("entropy_base32", "A-Z2-7", 20, 3.5),
    Alphabet("entropy_base64", "A-Za-z0-9+/_=-", 20, 3.8),
)
#: Candidate strings that are no secrets: words, numbers, and paths or compounds of them; UUIDs;
#: the usual placeholders.
ALLOWED = (
    r"[-+/_=]*(?:[A-Za-z]+|[0-9]+)(?:[-+/_=]+(?:[A-Za-z]+|[0-9]+))*[-+/_=]*",
    r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
    r"(?i:.*(?:example|sample|placeholder|changeme|dummy|your[-_]?(?:key|token|secret)).*)",
    r"(?i:.*(?:0123456789|abcdefghijkl|qwertyuiop).*)",
)
#: Texts without a match of this have no span of any kind.
SUSPECT = r"(?i:passw|secret|token|api_?key)|AKIA|"
SCALE = 1 << 32


def entropy_sum(count: int) -> int:
    """``count * log2(count)`` as a whole number of ``1 / SCALE``."""
    return round(count * math.log2(count) * SCALE) if count else 0


def entropy_spans(codes: bytes, window: int, bits: float) -> Iterator[tuple[int, int]]:
    """Spans of ``codes`` covered by windows with an entropy of ``bits`` or more.

    The entropy of a window is ``log2(window) - sum(c * log2(c)) / window`` over its counts c.
    """
    most = math.floor((math.log2(window) - bits) * window * SCALE)
    steps = [entropy_sum(c + 1) - entropy_sum(c) for c in range(window + 1)]
    counts = [0] * 256
    total, start, end = 0, -1, -1
    for i, code in enumerate(codes):
        total += steps[counts[code]]
        counts[code] += 1
        if i >= window:
            gone = codes[i - window]
            counts[gone] -= 1
            total -= steps[counts[gone]]
        if i >= window - 1 and total <= most:
            if i - window + 1 > end:
                if start >= 0:
                    yield start, end
                start = i - window + 1
            end = i + 1
    if start >= 0:
        yield start, end


class Scanner:
    """Finds the spans of one text; made once per task."""

    def __init__(self, alphabets: Sequence[Alphabet], allowed: Sequence[str]):
        self.alphabets = [(a, re.compile(f"[{a.characters}]{{{a.window},}}")) for a in alphabets]
        self.allowed = [re.compile(pattern, re.DOTALL) for pattern in allowed]
        order = [name for name, *_ in PATTERNS] + [a.kind for a in alphabets]
        self.rank = {kind: i for i, kind in enumerate(order)}
        self.suspect = SUSPECT + "|".join(["[0-9a-f]{32}", *(f"[{a.characters}]{{{a.window}}}" for a in alphabets)])

    def __call__(self, text: str) -> list[tuple[str, int, int]]:
        base = [
            (kind, *match.span())
            for kind, pattern, group, least in PATTERNS
            for match in pattern.finditer(text)
            if match.end(group) - match.start(group) >= least
        ]
        more: list[tuple[str, int, int]] = []
        for alphabet, runs in self.alphabets:
            fresh = []
            for match in runs.finditer(text):
                if any(pattern.fullmatch(match.group()) for pattern in self.allowed):
                    continue
                for start, end in entropy_spans(match.group().encode("ascii"), alphabet.window, alphabet.bits):
                    fresh.append((alphabet.kind, match.start() + start, match.start() + end))
            more += uncovered(fresh, sorted(more, key=lambda span: span[1]))
        return sorted(base + more, key=lambda span: (span[1], self.rank[span[0]], span[2]))


def uncovered(spans: list[tuple[str, int, int]], covering: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The spans that lie in none of ``covering``; both in order of start.

    One pass: of the covering spans that start no later, only the furthest end matters.
    """
    left, at, reach = [], 0, -1
    for span in spans:
        while at < len(covering) and covering[at][1] <= span[1]:
            reach = max(reach, covering[at][2])
            at += 1
        if span[2] > reach:
            left.append(span)
    return left


def span_column(text: Column, alphabets: Sequence[Alphabet] = ALPHABETS, allowed: Sequence[str] = ALLOWED) -> Column:
    """The spans of a text column: ``kind, start, end`` in code points, end exclusive.

    Evaluated on Arrow batches of texts alone; texts without a suspect run of characters are told
    by one linear pattern and not looked at further.
    """
    alphabets, allowed = tuple(alphabets), tuple(allowed)

    @F.arrow_udf(SPANS)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(alphabets, allowed)
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        for texts in batches:
            suspect = pc.match_substring_regex(texts, scanner.suspect).fill_null(False)
            found = [
                [dict(zip(("kind", "start", "end"), span)) for span in scanner(text.as_py())] if flag.as_py() else []
                for text, flag in zip(texts, suspect)
            ]
            yield pa.array(found, pa.list_(kind))

    return scan(text.cast("string"))


def find_secrets(
    docs: DataFrame, text_column: str = "text", alphabets: Sequence[Alphabet] = ALPHABETS, allowed: Sequence[str] = ALLOWED
) -> DataFrame:
    """All rows and columns of ``docs`` with ``spans``, in order of start, then of kind.

    Kinds are those of ``PATTERNS``, then those of ``alphabets``. NULL and empty texts have no
    spans; texts are read whole, however long; repeated rows are scanned each. Other columns may
    have any name; one named ``spans`` is replaced. An empty table gives an empty result.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "spans"]
    return docs.select(*kept, span_column(F.col(f"`{text_column}`"), alphabets, allowed).alias("spans"))


def redact(found: DataFrame, text_column: str = "text", mark: str = "[secret]") -> DataFrame:
    """The rows of ``find_secrets`` with every span in the text replaced by ``mark``.

    Overlapping spans are replaced once, from the first start to the last end. NULL stays NULL.
    """
    text = F.col(f"`{text_column}`")
    step = lambda acc, span: F.when(
        span["end"] <= acc["at"], acc
    ).otherwise(
        F.struct(
            F.when(
                span["start"] >= acc["at"],
                F.concat(acc["done"], F.substring(text, acc["at"] + 1, span["start"] - acc["at"]), F.lit(mark)),
            )
            .otherwise(acc["done"])
            .alias("done"),
            span["end"].alias("at"),
        )
    )
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    whole = F.aggregate("spans", start, step, lambda acc: F.concat(acc["done"], F.substr(text, acc["at"] + 1)))
    return found.withColumn(text_column, whole)


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
