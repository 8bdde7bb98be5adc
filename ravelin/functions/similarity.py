"""Gestalt similarity and what rests on it: nearest names, fuzzy keywords, noise, places.

The ratio is that of the standard library's sequence matcher, which is not symmetric; Spark has no
such function, so these run as Arrow batches, each distinct text of a batch once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable
from difflib import SequenceMatcher, get_close_matches
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ravelin.functions.speakers import LOCATIONS, REMARKS, SPEAKER_FIXES, SPEAKERS
from ravelin.shipping import ship

#: Least ratios.
KEYWORD, HEADER, FOOTER, GOSS, PLACE, NAME = 0.6, 0.6, 0.75, 0.72, 0.7, 0.6
#: The texts compared with.
HEADER_TEXT, FOOTER_TEXT, GOSS_TEXT = "AIRTOGROUNDVOICETRANSCRIPTION", "THREE ASTERISKS DENOTE CLIPPING OF WORDS AND PHRASES", "GOSSNET1"
#: Words up to this length are kept with the name that they are nearest to.
LONG_WORD = 32
#: Letters confused in names of three letters, tried in order.
CONFUSED = [("FILKY", "R"), ("F", "P"), ("HN", "M")]


def ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def reaches(a: str, b: str, least: float) -> bool:
    """Whether ``ratio`` is ``least`` or more; most texts are too unequal in length, or share too few letters, for it to be worked out."""
    both = len(a) + len(b)
    if not both:
        return least <= 1.0
    if 2.0 * min(len(a), len(b)) / both < least:
        return False
    return 2.0 * sum(min(n, a.count(c)) for c, n in _letters(b)) / both >= least and ratio(a, b) >= least


@lru_cache(maxsize=1024)
def _letters(text: str) -> list[tuple[str, int]]:
    return list(Counter(text).items())


@lru_cache(maxsize=1 << 16)
def _like(word: str, keyword: str, least: float) -> bool:
    return reaches(word, keyword, least)


def nearest(word: str, names: Iterable[str], least: float) -> str | None:
    """The likest of the names; most words come again, and those of their length are kept with what they are like."""
    names = tuple(names)
    return _nearest(word, names, least) if len(word) <= LONG_WORD else _likest(word, names, least)


def _likest(word: str, names: tuple[str, ...], least: float) -> str | None:
    return next(iter(get_close_matches(word, names, n=1, cutoff=least)), None)


_nearest = lru_cache(maxsize=1 << 15)(_likest)


def has_keyword(text: str, keyword: str, least: float = KEYWORD) -> bool:
    """Short keywords as whole words; longer ones anywhere, or like one of the words."""
    text, keyword = (text or "").upper(), (keyword or "").upper()
    if not text or not keyword:
        return False
    if len(keyword) <= 3:
        return re.search(rf"\b{re.escape(keyword)}\b", text) is not None
    # Words of other lengths are left out by their length alone, so only short ones are kept.
    size = len(keyword)
    return keyword in text or any(2.0 * min(len(word), size) / (len(word) + size) >= least and _like(word, keyword, least) for word in text.split())


def is_header(text: str) -> bool:
    upper = (text or "").strip().upper().replace("0", "O")
    return 0 < len(upper) <= 90 and "VOICE" in upper and "TRANS" in upper and ratio(re.sub("[^A-Z]", "", upper), HEADER_TEXT) >= HEADER


def is_footer(text: str) -> bool:
    return reaches(re.sub("[^A-Z ]", "", (text or "").upper().strip()), FOOTER_TEXT, FOOTER)


#: Misread characters of the net's label, and how long it may be.
GOSS_MISREAD, GOSS_CHARS = str.maketrans("0537IL", "OSET11"), 40
#: Variants of the net's label, as tests of its upper case: a net-like word and 1 among two zeros at least, a bare number, its letters.
GOSS_RULES: list[Callable[[str], bool]] = [
    lambda x: len(re.findall("[0O]", x)) >= 2 and re.search(r"\b(NET|NOT|NI|HOT|N[IE][T1])\s*['\"]?\s*1\b", x) is not None,
    lambda x: re.fullmatch(r"\(?\d{2,4}\)?", x) is not None,
    lambda x: like_goss(re.sub("[^A-Z0-9]", "", x).translate(GOSS_MISREAD)),
]


def like_goss(letters: str) -> bool:
    return letters != "" and (GOSS_TEXT in letters or reaches(letters, GOSS_TEXT, GOSS))


def is_goss_net(text: str) -> bool:
    """Whether any of ``GOSS_RULES`` takes a short text."""
    upper = (text or "").strip().upper()
    return 0 < len(upper) <= GOSS_CHARS and any(rule(upper) for rule in GOSS_RULES)


def place(text: str | None, valid: Iterable[str] = tuple(LOCATIONS), remarks: Iterable[str] = tuple(REMARKS)) -> str:
    """A known place, exact or near; blank for remarks, half digits and all else."""
    s = "".join(c for c in (text or "").upper().strip() if c.isalnum() or c == " ")
    if s in valid:
        return s
    if not s or s in remarks or 2 * sum(c.isdigit() for c in s) >= len(s):
        return ""
    return nearest(s, valid, PLACE) or ""


class SpeakerBook:
    """Known speakers, known misreadings, and words that are neither."""

    def __init__(self, valid: list[str] | None = None, fixes: dict[str, str] | None = None, keywords: tuple[str, ...] = ()) -> None:
        self.valid, self.fixes = valid or SPEAKERS, SPEAKER_FIXES if fixes is None else fixes
        self.keywords = {k.upper() for k in keywords}

    def is_garbage(self, name: str) -> bool:
        s = name.upper().strip()
        if s in self.valid or s in self.fixes:
            return False
        tokens = s.split()
        odd = s.isdigit() or not any(c.isalnum() for c in s) or any(c in "?!." for c in s) or s.count("(") + s.count(")") >= 3
        return odd or len(set(tokens)) < len(tokens) or s in self.keywords

    def known(self, key: str) -> str | None:
        """Exact, or by a fix to a known name; None if undecided."""
        if key in self.valid:
            return key
        fix = self.fixes.get(key)
        return fix if fix is not None and (fix == "" or fix in self.valid) else None

    def correct(self, raw: str | None) -> str:
        whole = (raw or "").upper().strip().translate({0xA0: " ", 0x200B: None, 0x2011: "-"})
        bare = lambda x: "".join(c for c in x if c.isalnum() or c == "/")
        for key in (whole, bare(whole.split()[0]) if whole else "", bare(whole)):
            if key and (found := self.known(key)) is not None:
                return found
        key, names = bare(whole), self.valid
        if not key or (key.isdigit() and len(key) <= 2):
            return ""
        if len(key) == 3:
            names = [n for n in names if len(n) == 3]
            for letters, to in CONFUSED:
                if (tried := re.sub(f"[{letters}]", to, key)) in self.valid:
                    return tried
            if key[0] == "I":
                tried = "L" + key[1:]
                if found := tried if tried in self.valid else nearest(tried, names, NAME):
                    return found
        return nearest(key, names, NAME) or next((n for n in self.valid if len(n) >= 2 and key.startswith(n)), "")

    def in_text(self, text: str) -> str | None:
        """A speaker among the first four words, of two words or one."""
        words = text.split()
        for i, word in enumerate(words[:4]):
            if not word.strip("0123456789:'-"):
                continue
            pair = " ".join(words[i : i + 2]).upper()
            if i + 1 < len(words) and pair in self.valid:
                return pair
            name = self.correct(word)
            if name and name not in self.keywords:
                return name
        return None


def _each(f: Callable[[str], object], kind: str) -> Callable[[Column], Column]:
    """``f`` as a column function over Arrow batches; null input is the empty text."""

    def apply(s: pd.Series) -> pd.Series:
        held = s.fillna("")
        return held.map({t: f(t) for t in held.unique()})

    if spark := SparkSession.getActiveSession():
        ship(spark)
    apply.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(apply, kind)


def header_noise(c: Column) -> Column:
    return _each(is_header, "boolean")(c)


def footer_line(c: Column) -> Column:
    return _each(is_footer, "boolean")(c)


def goss_net(c: Column) -> Column:
    return _each(is_goss_net, "boolean")(c)


def near_place(c: Column) -> Column:
    return _each(place, "string")(c)


def near_speaker(c: Column, book: SpeakerBook | None = None) -> Column:
    return _each((book or SpeakerBook()).correct, "string")(c)
