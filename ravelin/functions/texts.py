"""Text measures, predicates and repairs as column expressions."""

from __future__ import annotations

import re
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Misread words and their repairs, in order; the flag is the case.
OCR_REPAIRS = [
    (r"\b0MNI\b", "OMNI"),
    (r"\bPYR0\b", "PYRO"),
    (r"\bC0MM\b", "COMM"),
    (r"(?i)\b0ver\b", "Over"),
    (r"(?i)\b0ut\b", "Out"),
    (r"(?i)\bfive-boy\b", "five-by"),
    (r"(?i)\bfive-try\b", "five-by"),
    (r"(?i)\bPFESS\b", "PRESS"),
    (r"(?i)\bPASS\s+light\b", "PRESS light"),
    (r"(?i)\bMASTEP\b", "MASTER"),
    ("Unindentifiable", "Unidentifiable"),
]
#: Radio calls that stand in parentheses.
RADIO_CALLS = ["OVER", "OUT", "ROGER", "COPY", "WILCO", "GO AHEAD", "SAY AGAIN", "STAND BY", "STANDBY"]
#: Page and tape footers at the end of a text.
FOOTERS = [
    r"(?i)[\s.]+T[A-Z0-9]{2,}\s*[\d/IX]+\s+P[A-Z0-9]{2,}\s*[\d/IX]+\s*$",
    r"(?i)[\s.]+P[A-Z0-9]{2,}\s*[\d/IX]+\s+T[A-Z0-9]{2,}\s*[\d/IX]+\s*$",
    r"(?i)[\s.]+(TAPS|TAPC|TAPE|TYPE|TANE|PAGE|PAGS|PACE|PAXE|PAGO|PAZE)\s*[\d/IX]+\s*$",
]
#: Words that don't begin a station's name.
STOP_WORDS = "AND|THE|AT|IN|ON|OF"


#: What a pattern's parts mean in SQL engines: words and blanks of ASCII, an end that is the text's, and case folded for two more letters.
_BLANKS, _PARTS = r"\t\n\f\r ", re.compile(r"\[(?:\\.|[^\]\\])*\]|\\.|\$|[KkSs]")
_MEANT = {r"\b": r"(?:(?<!\w)(?=\w)|(?<=\w)(?!\w))", r"\s": f"[{_BLANKS}]", "$": r"\z"}
_FOLDED = {"k": "\u212a", "s": "\u017f"}


def as_in_sql(pattern: str) -> str:
    """A pattern for Spark's engine that finds what SQL engines find; that one's edges of words count all letters, theirs those of ASCII."""
    small = pattern.startswith("(?i)")

    def part(m: re.Match) -> str:
        x = m[0]
        if x.startswith("["):
            more = "".join(_FOLDED.values()) if small and re.search("a-z|A-Z", x) and not x.startswith("[^") else ""
            return x[:-1].replace(r"\s", _BLANKS) + more + "]"
        if x.lower() in _FOLDED:
            return f"[{x}{_FOLDED[x.lower()]}]" if small else x
        return _MEANT.get(x, x)

    return _PARTS.sub(part, pattern)


def upper(c: Column) -> Column:
    """Upper case as far as it is ASCII, letter by letter, so that no length changes."""
    return F.translate(c, string.ascii_lowercase + "\u0131\u017f", string.ascii_uppercase + "IS")


def repaired(c: Column, repairs: list[tuple[str, str]] = OCR_REPAIRS) -> Column:
    for pattern, to in repairs:
        c = F.regexp_replace(c, pattern, to)
    return c


def without_footer(c: Column) -> Column:
    return F.trim(repaired(c, [(as_in_sql(p), "") for p in FOOTERS]))


def radio_called(c: Column, calls: list[str] = RADIO_CALLS) -> Column:
    """Calls in parentheses become bare upper case, with their end mark."""
    for call in calls:
        c = F.regexp_replace(c, rf"(?i)\(\s*{call}\s*([.!?]?)\s*\)", f"{call}$1")
    return c


def squeezed(c: Column) -> Column:
    """Runs of white space are one blank."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def comparable(c: Column) -> Column:
    return squeezed(F.regexp_replace(F.lower(c), "[^a-z0-9 ]+", " "))


def is_noise(c: Column) -> Column:
    """Blank, one character, only marks, a number of one or two digits, or a digit with a mark."""
    t = F.trim(F.coalesce(c, F.lit("")))
    return (F.length(t) < 2) | t.rlike(r"^[?!.*-]+$") | t.rlike(r"^\d{1,2}$") | t.rlike(r"^\d[.-]$")


def word_count(c: Column) -> Column:
    """Words of two ASCII letters or more."""
    return F.size(F.regexp_extract_all(c, F.lit(r"([A-Za-z]{2,})"), F.lit(1)))


def is_substantive(c: Column) -> Column:
    return F.coalesce((word_count(c) >= 3) & (F.length(F.trim(c)) >= 20), F.lit(False))


def quality(c: Column) -> Column:
    """Share of letters, plus an eighth per word, less the share of odd symbols (half at most)."""
    n = F.length(c)
    kept = lambda pattern: F.length(F.regexp_replace(c, pattern, ""))
    letters = n - kept(r"\p{L}")
    odd = kept(r"[\p{L}\p{Nd}\s.,;:'\"\-()/?!]")
    return F.when(n > 0, letters / n + word_count(c) / 8.0 - F.least(F.lit(0.5), odd / n)).otherwise(0.0)


def word_set(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != ""))


def overlap(a: Column, b: Column) -> Column:
    """Shared words over the smaller word set; null if either has none."""
    x, y = word_set(a), word_set(b)
    least = F.least(F.size(x), F.size(y))
    return F.when(least > 0, F.size(F.array_intersect(x, y)) / least)


def letter_words(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"([a-z]+)"), F.lit(1)))


def jaccard(a: Column, b: Column) -> Column:
    x, y = letter_words(a), letter_words(b)
    return F.size(F.array_intersect(x, y)) / F.greatest(F.lit(1), F.size(F.array_union(x, y)))


def station_variants(c: Column) -> Column:
    """A station's name without its first none, one or two words, less stop words in front; distinct."""
    tokens = F.filter(F.split(F.regexp_replace(F.upper(c), "[^A-Z0-9 ]", ""), " +"), lambda t: t != "")
    shifts = F.sequence(F.lit(0), F.least(F.lit(2), F.size(tokens) - 1))
    names = F.transform(shifts, lambda i: F.regexp_replace(F.array_join(F.slice(tokens, i + 1, F.size(tokens)), " "), rf"^(({STOP_WORDS})( |$))+", ""))
    return F.when(F.size(tokens) > 0, F.array_distinct(F.filter(names, lambda v: v != ""))).otherwise(F.array().cast("array<string>"))


def with_line_feeds(c: Column) -> Column:
    """Newlines of all kinds as line feeds."""
    return F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def ordered_union(*lists: Column) -> Column:
    """The distinct non-blank members of all lists in their first order; null lists are empty."""
    every = F.concat(*(F.coalesce(x, F.array().cast("array<string>")) for x in lists))
    return F.array_distinct(F.filter(every, lambda w: w.isNotNull() & (w != "")))


def words_of(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def stitched(a: Column, b: Column, most: int = 12) -> Column:
    """``b`` behind ``a``, the longest words that end the one and begin the other only once; the longer where one holds the other."""
    x, y = words_of(a), words_of(b)
    sizes = F.sequence(F.lit(most), F.lit(1))
    fits = F.filter(sizes, lambda k: (k <= F.size(x)) & (k <= F.size(y)) & (F.slice(x, F.size(x) - k + 1, k) == F.slice(y, F.lit(1), k)))
    k = F.get(fits, F.lit(0))
    joined = F.when(k.isNotNull(), F.array_join(F.concat(x, F.slice(y, k + 1, F.size(y))), " ")).otherwise(F.trim(F.concat_ws(" ", a, b)))
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    return F.when(blank(a), b).when(blank(b), a).when(F.contains(a, b), a).when(F.contains(b, a), b).otherwise(joined)


def without_repeats(c: Column, w: Column, spans: range = range(12, 5, -1), within: int = 20) -> Column:
    """The second place of the first repeated phrase, of the longest span, goes; texts of under twelve words stay.

    ``w`` are the words of ``c``, as a column that is there already. A place is given by its first word; the
    phrase may come again up to ``within`` words behind its end.
    """
    n = F.size(w)

    def second(span: int) -> Column:
        """Where a phrase of this span comes again, for the first place that it does; null if none."""
        same = lambda i, j: (F.get(w, i) == F.get(w, j)) & (F.get(w, i + 1) == F.get(w, j + 1)) & (F.slice(w, j + 1, span) == F.slice(w, i + 1, span))
        ahead = lambda i: F.filter(F.sequence(i + span, F.least(n - span, i + span + within - 1)), lambda j: same(i, j))
        again = F.transform(F.sequence(F.lit(0), n - 2 * span), lambda i: F.get(ahead(i), F.lit(0)))
        return F.when(n >= 2 * span, F.get(F.filter(again, lambda j: j.isNotNull()), F.lit(0)))

    found = F.coalesce(*(F.when(j.isNotNull(), F.struct(j.alias("at"), F.lit(span).alias("span"))) for span in spans for j in [second(span)]))
    rest = F.transform(F.array(found), lambda f: F.array_join(F.concat(F.slice(w, F.lit(1), f["at"]), F.slice(w, f["at"] + f["span"] + 1, n)), " "))
    return F.when(n >= 12, F.coalesce(F.get(rest, F.lit(0)), c)).otherwise(c)
