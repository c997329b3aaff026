"""Secrets in texts: a keyword automaton, patterns only where it hits, and check sums inside tokens.

An Aho-Corasick automaton finds the words that a secret starts with, another finds runs of digits of hex
numbers in a text reduced to two letters. Only at those places a pattern is tried, anchored there. Tokens
that carry a check sum of themselves count only if it is right.

Kinds, in their order: ``assign`` (a value given to a name such as ``password``), ``access`` (access key
identifiers), ``hex`` (long hexadecimal numbers), ``forge`` and ``registry`` (tokens whose last six
characters are the CRC-32 of the thirty before, in base 62).

A null text counts as empty and has no secret. Texts of any length are scanned whole, one at a time; ties
of spans at one place follow the order of the kinds; repeated rows give repeated results, an empty table
an empty one. Only the column that is asked for is read, so names of other columns do not matter.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "forge", "registry")
#: Kinds without a check sum.
BASE_KINDS = KINDS[:3]
#: Words that start a secret, by kind.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("AKIA",),
    "forge": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "registry": ("npm_",),
}
#: Patterns, tried at a hit, and how many bytes the last group has at least.
PATTERNS = {
    "assign": (rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6),
    "access": (rb"(AKIA[A-Z0-9]+)", 20),
    "hex": (rb"([0-9a-f]+)", 24),
    "forge": (rb"(gh[pousr]_[0-9A-Za-z]+)", 40),
    "registry": (rb"(npm_[0-9A-Za-z]+)", 40),
}
HEX_RUN = PATTERNS["hex"][1]
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_HEX_VIEW = bytes(ord("h") if chr(i) in "0123456789abcdef" else ord(".") for i in range(256))


def checksum(secret: str) -> str:
    """Six characters of base 62: the CRC-32 that a token carries of its random part."""
    value, out = zlib.crc32(secret.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        out = BASE62[digit] + out
    return out.rjust(6, "0")


def _sound(token: bytes) -> bool:
    """Whether a token of exactly 36 characters behind its prefix ends in its own check sum."""
    body = token.partition(b"_")[2].decode()
    return len(body) == 36 and checksum(body[:30]) == body[30:]


class Scanner:
    """Finds spans, as ``(start, kind number, end)`` in code points."""

    def __init__(self) -> None:
        self.words, self.runs = ahocorasick.Automaton(), ahocorasick.Automaton()
        held: dict[str, list[int]] = {}
        for kind, words in KEYWORDS.items():
            for word in words:
                held.setdefault(word.lower(), []).append(KINDS.index(kind))
        for word, kinds in held.items():
            self.words.add_word(word, (len(word), kinds))
        self.runs.add_word("h" * HEX_RUN, HEX_RUN)
        self.words.make_automaton(), self.runs.make_automaton()
        self.patterns = [(re.compile(p), least) for p, least in (PATTERNS[k] for k in KINDS)]

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        # One byte for each code point: what lies above Latin-1 becomes a question mark, which no pattern has.
        view = text.encode("latin-1", "replace")
        found: list[tuple[int, int, int]] = []
        ends = [0] * len(KINDS)

        def attempt(kind: int, start: int) -> None:
            """A match at ``start`` takes its place even where it is too short, as in a search from the left."""
            if start < ends[kind]:
                return
            pattern, least = self.patterns[kind]
            match = pattern.match(view, start)
            if match:
                ends[kind] = match.end()
                if len(match[1]) >= least and (kind < len(BASE_KINDS) or _sound(match[1])):
                    found.append((start, kind, match.end()))

        for last, (size, kinds) in self.words.iter(view.lower().decode("latin-1")):
            for kind in kinds:
                attempt(kind, last - size + 1)
        hexadecimal = KINDS.index("hex")
        for last, size in self.runs.iter(view.translate(_HEX_VIEW).decode("latin-1")):
            attempt(hexadecimal, last - size + 1)
        return sorted(found)


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_secrets(text: Column) -> Column:
    """A struct for each text: ``base`` and ``spans`` (``kind:start:end``, comma-joined), and counts by kind."""

    @F.pandas_udf("struct<base: string, spans: string, " + ", ".join(f"n_{k}: long" for k in KINDS) + ">")
    def scan(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        find = scanner().spans
        for texts in parts:
            rows = []
            for value in texts:
                spans = find(value) if value else []
                held = [kind for _, kind, _ in spans]
                base = spans_text([s for s in spans if s[1] < len(BASE_KINDS)])
                rows.append((base, spans_text(spans), *(held.count(k) for k in range(len(KINDS)))))
            yield pd.DataFrame(rows, columns=["base", "spans", *(f"n_{k}" for k in KINDS)])

    return scan(text)
