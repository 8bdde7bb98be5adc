"""What a line of page text is, and repairs of its edges, as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ravelin.functions.texts import as_in_sql, upper

#: Patterns of lines; all are plain enough for every regular-expression engine.
HEADER_WORDS = r"\b(GOSS|NET|TAPE|PAGE|APOLLO)\b|AIR[- ]TO[- ]GROUND"
TRANSITIONS = r"REST PERIOD|NO COMMUNICATION|LOSS OF SIGNAL|SILENCE|\b(AOS|LOS)\b"
IGNITION = r"(?i)^\s*TIG\s+\d+\s+\d{2}\s+\d{2}\s+\d{2}\s+\d{2}"
_PAGE, _TAPE = r"(PAGE|PLAY|LAY)\s*\d{1,4}", r"TAPE\s*\d{1,2}\s*/\s*\d{1,2}"
HEADER_ONLY = rf"(?i)^\s*({_PAGE}|{_TAPE}|{_TAPE}\s+{_PAGE}|{_PAGE}\s+{_TAPE})\s*$"
GARBLED_SHORT = r"(?i)^([PTL][a-z]{2,4}|[PTLU][a-z])\s+\d+[\d/]*$"
GARBLED_LABEL = r"(?i)\b(Porch|Page|Type|Tape|Ptc|Low|Lack|Up|Pyro|P\s*\dc)\s+[\d/]+|\b(page|tape)\s+\d+"
NOT_ONE = r"\(?[0-9%]{1,2}[:%.][0-9]{2}\s+NOT\s+1\)?"
NOT_ONE_SHORT = r"^\(?\s*[A-Z0-9.:\-_%\"' ]{0,20}\s*NOT\s*1\)?\s*$"
END_OF_TAPE = r"(?i)\*\*\s*END\s+OF\s+TAPE\s*\*\*"
#: What a footer leaves in a text, in order.
FOOTER_REST = [r"(?i)\b(PAGE|TAPE)\s+\d+(/\d+)?", r"\b\d{1,3}/\d{1,3}\b", r"^\d{1,4}\s+", r"\s+\d{1,4}$"]
#: Letters that are misread digits in a program's number.
MODE_LETTERS, MODE_DIGITS = "OQDUILZSB", "000011258"


def has_header_word(c: Column) -> Column:
    return upper(c).rlike(as_in_sql(HEADER_WORDS))


def has_transition(c: Column) -> Column:
    return upper(c).rlike(as_in_sql(TRANSITIONS))


def is_ignition_time(c: Column) -> Column:
    return c.rlike(as_in_sql(IGNITION))


def is_header_only(c: Column) -> Column:
    return c.rlike(as_in_sql(HEADER_ONLY))


def is_garbled_label(c: Column) -> Column:
    """A page's or tape's label, misread, in a text of at most 60 characters."""
    t = F.trim(c)
    return (F.length(c) <= 60) & (((F.length(t) < 15) & t.rlike(as_in_sql(GARBLED_SHORT))) | c.rlike(as_in_sql(GARBLED_LABEL)))


def is_not_one(c: Column) -> Column:
    """Rests of a footer that end in NOT 1."""
    raw = upper(F.trim(c))
    return (F.length(raw) <= 36) & (raw.rlike(as_in_sql(NOT_ONE)) | raw.rlike(as_in_sql(NOT_ONE_SHORT)))


def starts_continuation(c: Column) -> Column:
    return c.rlike(r"^(\p{Ll}|\.\.\.)")


def looks_truncated(c: Column) -> Column:
    """At least three characters, with a hyphen or a small letter of a longer word at the end."""
    t = F.rtrim(c)
    last = F.element_at(F.split(t, as_in_sql(r"\s+")), -1)
    return (F.length(t) >= 3) & (t.endswith("-") | (t.rlike(as_in_sql(r"\p{Ll}$")) & (F.length(last) > 2)))


def continues(before: Column, text: Column, flagged: Column) -> Column:
    """Whether a continuation belongs to the text before it: flagged, begun in small letters, or that one has no end mark."""
    both = (F.coalesce(before, F.lit("")) != "") & (F.coalesce(text, F.lit("")) != "")
    return both & (F.coalesce(flagged, F.lit(False)) | starts_continuation(text) | F.trim(before).rlike(r"[^.?!]$"))


def without_tape_end(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, as_in_sql(END_OF_TAPE), ""))


def without_footer_rest(c: Column) -> Column:
    for pattern in FOOTER_REST:
        c = F.regexp_replace(c, as_in_sql(pattern), "")
    return F.trim(c)


def replaced(c: Column, pairs: dict[str, str]) -> Column:
    """Literal replacements, one after another."""
    for old, new in pairs.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def named_speaker(c: Column, names: list[str]) -> Column:
    """The first of ``names`` that the text begins with, a blank or colon behind it; else null."""
    return F.coalesce(*(F.when(c.startswith(n + " ") | c.startswith(n + ":"), n) for n in names))


def program_mode(c: Column) -> Column:
    """``P`` and two digits of a misread program number (one character stands for ten times it); else null."""
    raw = F.regexp_replace(F.upper(c), "[^A-Z0-9]", "")
    tail = F.rpad(F.translate(F.substring(raw, 2, 2), MODE_LETTERS, MODE_DIGITS), 2, "0")
    return F.when(raw.startswith("P") & (F.length(raw) >= 2) & tail.rlike(r"^\d\d$"), F.concat(F.lit("P"), tail))


#: Lines that are a speaker's name (of up to three words, a place behind it) or a place.
_WORD = r"[A-Za-z0-9]{1,8}\??(/[A-Za-z0-9]{1,8})?\??"
NAME_LINE, PLACE_LINE = rf"^{_WORD}(\s+{_WORD}){{0,2}}(\s*\([A-Za-z0-9]+\))?$", r"^\s*\([A-Z0-9\s]+\)\s*$"


def is_column_text(c: Column) -> Column:
    """Whether a line of the text column is said: no name, no place, no label, not blank."""
    t = F.trim(c)
    return (t != "") & ~(t.rlike(as_in_sql(NAME_LINE)) | t.rlike(as_in_sql(PLACE_LINE)) | t.rlike(as_in_sql(HEADER_ONLY)))


def is_scrap(speaker: Column, text: Column) -> Column:
    """What a nameless voice says in under three characters, none a letter or digit."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return F.coalesce((speaker == "SC") & (F.length(t) < 3) & ~t.rlike(r"[\p{L}\p{Nd}]"), F.lit(False))


def replaced_by_patterns(c: Column, table: dict[str, str]) -> Column:
    """Patterns and replacements, groups written ``\\1``, one after another."""
    for pattern, to in table.items():
        java = re.sub(r"\\(\d)|\\\\|([\\$])", lambda m: f"${m[1]}" if m[1] else f"\\{m[2] or m[0][0]}", to)
        c = F.regexp_replace(c, as_in_sql(pattern), java)
    return c
