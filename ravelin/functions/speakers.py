"""Speakers and locations: lookups with several keys, and predicates on garbage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Misread speaker codes.
SPEAKER_FIXES = {
    "CT": "CMP", "CTP": "CMP", "CMF": "CMP", "CMFVERB": "CMP", "CMI": "CMP", "CMP IS": "CMP", "CMP?": "CMP",
    "IMF": "LMP", "IMP": "LMP", "LMF": "LMP", "LIF": "LMP", "LIP": "LMP", "LML": "LMP", "LMI": "LMP", "LME": "LMP", "LMP?": "LMP", "LMP IS": "LMP", "IMI": "LMP",
    "CDF": "CDR", "CDI": "CDR", "CDY": "CDR", "CDK": "CDR", "CD": "CDR", "CDR IS": "CDR", "CIR": "CDR", "CLR": "CDR",
    "CC?": "CC", "C": "CC", "COMM": "CC", "HOUSTON": "CC", "HIM": "LMP",
}
#: Speakers, places, and remarks that are no places.
SPEAKERS = ["CC", "CDR", "CMP", "CT", "HORNET", "LMP", "MCC", "MS", "MSFN", "PAO", "PRESIDENT NIXON", "RECOVERY", "SC", "SWIM 1", "SWIM 2"]
LOCATIONS = ["COLUMBIA", "EAGLE", "TRANQ"]
REMARKS = ["LAUGHING", "LAUGHTER", "LAUGH", "GARBLE", "GARBLED", "PAUSE", "PAUSED"]


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in values.items() for x in kv))


def corrected_speaker(c: Column, fixes: dict[str, str] | None = None, valid: list[str] | None = None) -> Column:
    """The speaker by the whole text, its first word, or its letters and digits; blank if none is known."""
    known, table = F.array(*map(F.lit, valid or SPEAKERS)), _map(fixes if fixes is not None else SPEAKER_FIXES)
    whole = F.trim(F.upper(c))
    bare = lambda x: F.regexp_replace(x, "[^A-Z0-9/]", "")
    first = bare(F.get(F.split(whole, r"\s+"), F.lit(0)))
    tries = []
    for key in (whole, first, bare(whole)):
        fixed = F.try_element_at(table, key)
        tries += [F.when(F.array_contains(known, key), key), F.when(F.array_contains(known, fixed), fixed)]
    return F.coalesce(*tries, F.lit(""))


def is_garbage_speaker(c: Column, keywords: list[str] | None = None, fixes: dict[str, str] | None = None, valid: list[str] | None = None) -> Column:
    s = F.upper(F.trim(c))
    tokens = F.split(s, r"\s+")
    parens = F.length(s) - F.length(F.translate(s, "()", ""))
    bad = s.rlike(r"^\d+$") | ~s.rlike(r"[A-Z0-9]") | s.rlike(r"[?!.]") | (parens >= 3) | ((F.size(tokens) >= 2) & (F.size(F.array_distinct(tokens)) < F.size(tokens))) | s.isin([k.upper() for k in keywords or []])
    known = s.isin(valid or SPEAKERS) | s.isin(list(fixes if fixes is not None else SPEAKER_FIXES))
    return F.when(c.isNull() | (c == ""), True).when(known, False).otherwise(bad)


def exact_location(c: Column, valid: list[str] | None = None, remarks: list[str] | None = None) -> Column:
    """A known place, blank for remarks and for texts that are half digits, else null (undecided)."""
    s = F.regexp_replace(F.trim(F.upper(c)), r"[^\p{L}\p{Nd} ]", "")
    digits = F.length(s) - F.length(F.regexp_replace(s, r"\d", ""))
    return F.when(c.isNull() | (c == ""), "").when(s.isin(valid or LOCATIONS), s).when(s.isin(remarks or REMARKS), "").when(digits * 2 >= F.length(s), "")
