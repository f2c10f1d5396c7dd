"""Secrets in texts: keyword automaton, anchored patterns at its hits, checksums.

One pass of an Aho-Corasick automaton finds the keywords of all rules; a rule's
pattern is only tried at the places of its own keywords, from left to right and
never inside its previous match, which gives the same matches as a search of the
whole text.  Runs of hexadecimal digits have no keyword: a run of 24 covers
three multiples of 8, so only places with three such digits at
neighbouring multiples of 8 are looked at.  Tokens that embed a checksum of
themselves are kept only if it fits.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from canvass.llm.arrow import add_columns, by_row, release

DIGITS62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc32_base62(payload: str, digits: int = 6) -> str:
    """Checksum of a token's payload as its issuers append it: CRC-32 in base 62, padded with zeros."""
    value, out = zlib.crc32(payload.encode()), ""
    for _ in range(digits):
        value, digit = divmod(value, 62)
        out = DIGITS62[digit] + out
    return out


def embeds_checksum(match: re.Match) -> bool:
    body = match[1]
    return crc32_base62(body[:-6]) == body[-6:]


@dataclass(frozen=True)
class Rule:
    """A kind of secret: lower-case keywords its matches start with, the pattern, and what a match has to pass."""

    kind: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    passes: Callable[[re.Match], bool]


def six_or_more(match: re.Match) -> bool:
    return len(match[2]) >= 6


def twenty_or_more(match: re.Match) -> bool:
    return match.end() - match.start() >= 20


# ASCII matters with IGNORECASE: without it a long s or a Kelvin sign would count as a letter of a keyword.
RULES = (
    Rule(
        "assign",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
        ),
        six_or_more,
    ),
    Rule("access", ("akia",), re.compile(r"AKIA[A-Z0-9]+"), twenty_or_more),
    Rule("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_([0-9A-Za-z]{36})(?![0-9A-Za-z])"), embeds_checksum),
    Rule("npm", ("npm_",), re.compile(r"npm_([0-9A-Za-z]{36})(?![0-9A-Za-z])"), embeds_checksum),
)
BASE = ("assign", "access", "hex")
# Kinds in the order in which spans that start together are listed.
KINDS = (*BASE, "github", "npm")

HEX_RUN = re.compile(r"[0-9a-f]{24,}")
HEX_SAMPLES = re.compile(r"[0-9a-f]{3,}")
STRIDE = 8

Span = tuple[str, int, int]


class Scanner:
    def __init__(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for rule in RULES:
            for word in rule.keywords:
                self.automaton.add_word(word, (rule, len(word)))
        self.automaton.make_automaton()

    def spans(self, text: str) -> list[Span]:
        """All spans by start, then kind; code points, end exclusive."""
        found = [*self.by_keyword(text), *hex_runs(text)]
        found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
        return found

    def by_keyword(self, text: str) -> Iterator[Span]:
        # the capital dotted I is the one character whose lower case is longer
        lowered = text.replace("İ", "i").lower()
        hits = [(end + 1 - size, rule) for end, (rule, size) in self.automaton.iter(lowered)]
        hits.sort(key=lambda h: h[0])
        free = dict.fromkeys((rule.kind for rule in RULES), 0)
        for at, rule in hits:
            if at >= free[rule.kind] and (match := rule.pattern.match(text, at)):
                if rule.passes(match):
                    yield rule.kind, at, match.end()
                elif rule.kind not in BASE:
                    continue  # a token that fails its checksum hides nothing
                free[rule.kind] = match.end()


def hex_runs(text: str) -> Iterator[Span]:
    for samples in HEX_SAMPLES.finditer(text[::STRIDE]):
        begin, end = max(0, (samples.start() - 1) * STRIDE + 1), samples.end() * STRIDE
        for run in HEX_RUN.finditer(text, begin, min(end, len(text))):
            yield "hex", run.start(), run.end()


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each run of overlapping spans replaced by the first one's kind in brackets."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPANS = ArrayType(StructType([
    StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()),
]))


def secret_spans(df: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """`df` with the spans of secrets in the whole text.

    Null and empty texts have no spans.  A row's result depends on its text
    alone: repeated rows give repeated results, no row is lost, and an empty
    table gives no rows.  A column named like the result is replaced.
    """

    def make() -> Callable[[str | None], tuple]:
        release()
        scanner = Scanner()
        return lambda value: ([dict(zip(("kind", "start", "end"), s)) for s in scanner.spans(value or "")],)

    return add_columns(df, [text], [StructField(into, SPANS)], by_row(make))


def redact_secrets(df: DataFrame, text: str = "text", size: str = "n_chars") -> DataFrame:
    """`df` with secrets in `text` replaced, and `size` (if there is such a column) counted anew.

    All rows stay; a null text stays null.  Types and order of columns stay.
    """
    kinds = {f.name: f for f in df.schema.fields}
    counted = size in kinds

    def make() -> Callable[..., tuple]:
        release()
        scanner = Scanner()

        def row(value: str | None, before: int | None = None) -> tuple:
            new = None if value is None else redacted(value, scanner.spans(value))
            after = before if new is None or new == value else len(new)
            return (new, after) if counted else (new,)

        return row

    names = [text, size] if counted else [text]
    return add_columns(df, names, [kinds[n] for n in names], by_row(make)).select(*[f"`{c}`" for c in df.columns])
