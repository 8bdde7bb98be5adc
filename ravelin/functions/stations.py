"""Tracking stations: their names in text, and the marks of passes and revolutions that follow them.

A name is known if one of its variants, without up to two leading words and without stop words in front, is a
keyword. The scorer for near names is kept apart, as its sums stay below the least score that would count.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from ravelin.functions.texts import STOP_WORDS, station_variants

#: A station with its mark; in texts of pages (with a misread mark), and in merged texts.
READ = re.compile(r"\b([A-Z0-9 ]{3,40}?)\s*\((REV|PASS|RFV)\s*(\d+)\)\s*", re.IGNORECASE)
MERGED = re.compile(r"\b([A-Z][A-Z0-9 ]{2,40}?)\s*\.?\s*\((REV|PASS)\s*(\d+)\)\s*", re.IGNORECASE)
SPOKEN = re.compile(r"\b([A-Z][A-Z0-9 ]{2,40}?)\s*\((REV|PASS)\s*(\d+)\)", re.IGNORECASE)
#: Scores of a near name: last word, first word, each shared word, as many words, one more or less; the least that counts.
LAST, FIRST, SHARED, AS_MANY, NEARLY, LEAST = 0.04, 0.03, 0.02, 0.1, 0.05, 0.55
_stops = set(STOP_WORDS.split("|"))


def variants(name: str) -> list[str]:
    """The name without its first none, one or two words, less stop words in front; distinct."""
    words = re.sub("[^A-Z0-9 ]", "", name.upper()).split()
    out: dict[str, None] = {}
    for skip in range(min(3, len(words))):
        first = next((i for i in range(skip, len(words)) if words[i] not in _stops), len(words))
        out[" ".join(words[first:])] = None
    return [v for v in out if v]


def matched(name: str, keywords: Iterable[str]) -> str | None:
    known = set(keywords)
    return next((v for v in variants(name) if v in known), None)


def likeness(variant: str, keyword: str) -> float:
    a, b = variant.split(), keyword.split()
    if not a or not b:
        return 0.0
    apart = abs(len(a) - len(b))
    return LAST * (a[-1] == b[-1]) + FIRST * (a[0] == b[0]) + SHARED * len({*a} & {*b}) + (AS_MANY if apart == 0 else NEARLY if apart == 1 else 0.0)


def near(name: str, keywords: Iterable[str]) -> str | None:
    """The exact match, else the likest keyword whose score reaches the least."""
    keywords = list(keywords)
    if found := matched(name, keywords):
        return found
    best = max(((likeness(v, k), k) for v in variants(name) for k in keywords), key=lambda x: x[0], default=(0.0, None))
    return best[1] if best[0] >= LEAST else None


class Spot(NamedTuple):
    """A name with its mark in a text: where, the station it is known as (None if it is none), and what the mark says."""

    start: int
    end: int
    station: str | None
    mark: str
    number: str

    @property
    def label(self) -> str:
        return f"{self.station} ({self.mark.upper().replace('RFV', 'REV')} {self.number})"


def spots(text: str, pattern: re.Pattern, known: Callable[[str], str | None]) -> Iterator[Spot]:
    """What ``pattern`` finds in a text, one behind the other."""
    for m in pattern.finditer(text):
        yield Spot(m.start(), m.end(), known(m[1].strip()), m[2], m[3])


def among(keywords: Iterable[str]) -> Callable[[str], str | None]:
    """Names to the keyword that they are known as."""
    upper = {k.upper() for k in keywords}
    return lambda name: matched(name, upper)


def _replaced(text: str, found: list[Spot], by: Callable[[Spot], str]) -> str:
    ends = [0, *(s.end for s in found)]
    return "".join(text[a : s.start] + by(s) for a, s in zip(ends, found, strict=False)) + text[ends[-1] :]


def without_stations(text: str, keywords: Iterable[str]) -> tuple[str, list[str]]:
    """A merged text without the known stations in it, and their labels."""
    known = among(keywords)
    found = [s for s in spots(text, MERGED, lambda name: known(re.split("[.:;]", name)[-1])) if s.station]
    rest = re.sub(r"\s{2,}", " ", _replaced(text, found, lambda s: ""))
    return rest.strip(" -;,.").strip(), [s.label for s in found]


def taken_from_page_text(text: str, keywords: Iterable[str]) -> tuple[str, list[str]]:
    """A page's text without its leading run of stations; the first unknown one ends it. Without keywords all are known."""
    keywords, labels = list(keywords), []
    known = among(keywords) if keywords else str.upper
    while (first := next(spots(text, READ, known), None)) and first.station:
        labels.append(first.label)
        text = _replaced(text, [first], lambda s: "").strip()
    return text, labels


def named_as_known(text: str, keywords: Iterable[str]) -> str:
    """Stations in a text by their known names."""
    found = [s for s in spots(text, SPOKEN, among(keywords)) if s.station]
    return _replaced(text, found, lambda s: s.label)


def is_station_line(text: str, keywords: Iterable[str]) -> bool:
    return bool(without_stations(text, keywords)[1])


def known_station(c: Column, keywords: list[str]) -> Column:
    """``matched`` as a column expression."""
    return F.get(F.filter(station_variants(c), lambda v: v.isin(keywords)), F.lit(0))
