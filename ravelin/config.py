"""Settings: the shipped defaults, a file of them, a mission's own on top; prompts of the page reader."""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass, field, fields

from ravelin.functions.speakers import LOCATIONS, REMARKS, SPEAKER_FIXES, SPEAKERS
from ravelin.sources import files

#: Words of all missions: stations, ships, phases, systems, technical terms.
KEYWORDS = """ANTIGUA|ASCENSION|BERMUDA|CANARY|CARNARVON|GOLDSTONE|GUAM|GUAYMAS|HAWAII|HONEYSUCKLE|HONOLULU|HUNTSVILLE|MADRID|MERRITT ISLAND|MILA|REDSTONE|TANANARIVE|ARIA|TEXAS|VANGUARD|MSFN
TEI|TLI|LOI|COI|EVA|LM|CSM|CMC|LGC|DSKY|GRAND BAHAMA ISLANDS|GRAND BAHAMA ISLAND
S-IVB|S-IV|AIR-TO-GROUND|NO-GO|DELTA-P|DELTA-V|DELTA-VC|DELTA-H|DELTA-VZ|DELTA-VT|DELTA-TIG|DELTA-R|DELTA-VX|LOI-2""".replace("\n", "|").split("|")
#: Patterns that all missions replace, in order.
TEXT_REPLACEMENTS = {
    r"\bRFV\b": "REV",
    r"\bRE V\b": "REV",
    r"\bre\s+id\b": "read",
    r"(?i)air[-\s]?two[-\s]?ground voice transposition": "AIR-TO-GROUND VOICE TRANSCRIPTION",
    r"(?i)air[-\s]?to[-\s]?ground voice transposition": "AIR-TO-GROUND VOICE TRANSCRIPTION",
    r"(?i)\(\s*go(?:ss|s|st)\s*net\s*1\s*\)": "(GOSS NET 1)",
    r"\bwc've\b": "we've",
    "GRAINED BEAM": "GRAND BAHAMA",
    "Gunymas": "Guaymas",
    r"\bO([1-9])\b": r"0\1",
    r"\btwelve\s+(been|had|done|come|got|seen)\b": r"we've \1",
    r"^[Rr]'?id\b": "I'd",
}
#: The readings that a mission may switch on or off, and what the parts of a text are asked for.
READINGS = {"ocr_dual_pass": "raw_fallback", "ocr_faint_pass": "faint_fallback", "ocr_text_column_pass": "textcol"}
PROMPTS = {
    "plain": "Read all text of this page from top to bottom and left to right, with its line breaks, whole lines across all columns. Add nothing.",
    "column": "Read this page of a transcript. Its columns are time, speaker and text; read whole lines across them, with their line breaks. Add nothing.",
    "text_column": "This is the right column of a page of a transcript. Read its text only, one line for each line, from top to bottom.",
}


def union(*lists: list[str] | None) -> list[str]:
    """The distinct members of all lists in their first order."""
    return list(dict.fromkeys(x for xs in lists for x in xs or [] if x))


@dataclass
class Settings:
    """What differs between missions; the defaults are the shipped ones."""

    valid_speakers: list[str] = field(default_factory=lambda: list(SPEAKERS))
    valid_locations: list[str] = field(default_factory=lambda: list(LOCATIONS))
    invalid_location_annotations: list[str] = field(default_factory=lambda: list(REMARKS))
    speaker_ocr_fixes: dict[str, str] = field(default_factory=lambda: dict(SPEAKER_FIXES))
    mission_keywords: list[str] = field(default_factory=list)
    text_replacements: dict[str, str] = field(default_factory=dict)
    manual_speaker_corrections: dict[str, str] = field(default_factory=dict)
    footer_text_overrides: dict[int, str] = field(default_factory=dict)
    post_merge: dict[str, str] = field(default_factory=dict)
    page_offset: int = 0
    readings: list[str] = field(default_factory=lambda: ["raw", *READINGS.values()])
    lexicon: str | None = None
    ocr_url: str | None = None
    ocr_model: str = ""
    ocr_prompt: str = "plain"
    ocr_timeout: int = 120
    ocr_max_tokens: int = 4096
    dpi: int = 300

    @classmethod
    def of(cls, values: dict) -> Settings:
        """From a configuration's values; keys that are no setting are left out."""
        return cls(**{k: v for k, v in values.items() if k in {f.name for f in fields(cls)}})


def layered(default: dict, mission: dict | None = None) -> Settings:
    """The shipped defaults, a file's over them, and the mission's on top.

    Keywords are united in order; tables of replacements and of speakers' names are layered, right wins; a mission
    may also turn a reading off. ``post_merge`` keeps its literal replacements only.
    """
    mission = mission or {}
    lexicon, parser, correctors = (default.get(k) or {} for k in ("lexicon", "parser", "correctors"))
    values = Settings.of({**{k: v for k, v in default.items() if not isinstance(v, dict)}, **mission})
    values.mission_keywords = union(lexicon.get("mission_keywords", KEYWORDS), mission.get("mission_keywords"))
    values.text_replacements = {**parser.get("text_replacements", TEXT_REPLACEMENTS), **mission.get("text_replacements", {})}
    fixes = correctors.get("speaker_ocr_fixes", SPEAKER_FIXES)
    values.speaker_ocr_fixes = {**fixes, **mission.get("speaker_ocr_fixes", {})}
    values.invalid_location_annotations = list(correctors.get("invalid_location_annotations", {}).get("annotations", REMARKS))
    values.footer_text_overrides = {int(k): v for k, v in mission.get("footer_text_overrides", {}).items()}
    values.post_merge = dict((mission.get("post_merge") or {}).get("text_replacements", {}))
    values.readings = ["raw", *(name for key, name in READINGS.items() if mission.get(key, default.get(key, True)))]
    values.lexicon = lexicon.get("path")
    return values


def _text(path: str | None) -> str:
    if not path or not os.path.exists(path):
        return ""
    with open(path, encoding="utf-8") as f:
        return f.read()


def load(default: str | None = None, missions: str | None = None, document: str | None = None) -> Settings:
    """Settings from the files ``default`` and ``missions``, if they exist, for the document's file name."""
    names = [document] if document and "." in document else [f"{document}.pdf"] if document else []
    mission: dict = {}
    for name in names:
        mission = files.configuration("", _text(missions), name)
    return layered(tomllib.loads(_text(default)), mission)


def prompts(path: str | None = None) -> dict[str, str]:
    """What the page reader is asked, by kind; a file's ``*_prompt`` keys replace the shipped ones."""
    told = {k.removesuffix("_prompt").removesuffix("_ocr"): v.strip() for k, v in tomllib.loads(_text(path)).items() if k.endswith("_prompt")}
    return {**PROMPTS, **told}


def source_path(name: str, folder: str) -> str:
    """The path of a document: as given if it exists, else in the folder, ``.pdf`` added where there is no suffix."""
    return name if os.path.exists(name) else os.path.join(folder, name if os.path.splitext(name)[1] else f"{name}.pdf")
