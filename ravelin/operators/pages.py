"""Page text to rows, and two readings of a page to one.

A page is the unit: its lines depend on each other, pages don't. Reading is a map over page rows;
merging brings the two readings of a page together by one shuffle on (document, page_num).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ravelin.functions import lines as known
from ravelin.functions.similarity import has_keyword, is_footer, nearest, reaches
from ravelin.functions.speakers import SPEAKERS
from ravelin.operators.scans import Machine, Row, ordered_scan, row_map, type_of

#: Shapes of lines and of their parts.
_TWO, _DIGITS, _GAP = r"[\dOI'():?.-]{2}", r"((?=[0-9OIilCSB]*\d)[0-9OIilCSB]{1,2})", r"[^0-9OIilCSB]+"
_NAME = r"[A-Za-z0-9]{1,8}\??(?:/[A-Za-z0-9]{1,8})?\??"
TIME = re.compile(rf"({_TWO}(?:\s+{_TWO}){{2,3}})(?:$|\b)")
LONE_TIME = re.compile(rf"{_TWO}(?:\s+{_TWO}){{2,3}}")
INNER_TIME = re.compile(rf"\s+({_TWO}(?:\s+{_TWO}){{2,3}})\b")
ANY_TIME = re.compile(rf"(?<!\d){_GAP.join([_DIGITS] * 4)}(?!\d)")
TENTHS = re.compile(r"\b(\d{2}\s+\d{2}\s+\d{2})\s+\.(\d)\b")
TAG = re.compile(r"\[(HEADER|FOOTER|ANNOTATION|COMM|META)\]\s*", re.IGNORECASE)
REVISION = re.compile(r"\([RE][FV]\s+\d+\)", re.IGNORECASE)
NAME = re.compile(_NAME)
NAMES = re.compile(rf"{_NAME}(?:\s+{_NAME}){{0,2}}(?:\s*\([A-Za-z0-9]+\))?")
NAME_IN_PARENS = re.compile(r"\([A-Za-z0-9]+\)")
PLACE = re.compile(r"\s*\(([A-Z0-9\s]+)\)\s*")
COMMAND = re.compile(r"(NOUN|VERB)\s*\d", re.IGNORECASE)
LABEL = re.compile(r"\b(?:(?:PAGE|PLAY|LAY)\s*\d{1,4}|TAPE\s*\d{1,2}\s*/\s*\d{1,2})\b", re.IGNORECASE)
TAPE = re.compile(r"\bTAPE\s*(\d{1,2}\s*/\s*\d{1,2})\b", re.IGNORECASE)
TAPE_END = "END OF TAPE"
LUNAR = re.compile(r"--\s*(BEGIN|END)\s+LUNAR\s+REV\s+\d+\b", re.IGNORECASE)
REST = re.compile(r"\bREST\s+PERIOD\b", re.IGNORECASE)
LOOK_ALIKE = str.maketrans("OoIilCcSsBb°", "001110055880")
#: Timestamps in a row that make a list; least ratios of names.
LIST_RUN, NAME_LIKE, TOKEN_LIKE = 5, 0.65, 0.7

_header_word, _transition, _ignition, _header_only = (re.compile(p) for p in (known.HEADER_WORDS, known.TRANSITIONS, known.IGNITION, known.HEADER_ONLY))


def is_timed(line: str) -> bool:
    return TIME.match(line) is not None


def with_clear_times(line: str) -> str:
    """Four groups of digits or look-alikes, whatever stands between them, are a timestamp; tenths are seconds."""
    clear = ANY_TIME.sub(lambda m: " ".join(g.translate(LOOK_ALIKE).rjust(2, "0") for g in m.groups()), line)
    return TENTHS.sub(r"\1 1\2", clear)


def _spoken(rest: str) -> bool:
    """Whether a name follows, perhaps after a remark in parentheses."""
    rest = rest.lstrip()
    tries = [rest, rest[rest.find(")") + 1 :]] if rest.startswith("(") and ")" in rest else [rest]
    return any(t.split() and NAME.fullmatch(t.split()[0]) for t in tries)


def split_lines(text: str, keywords: Iterable[str] = ()) -> list[tuple[str, str | None]]:
    """(line, tag): lines cut before each timestamp with a speaker, revision mark or long keyword within them."""
    long_words = [re.compile(rf"\s+{re.escape(k)}", re.IGNORECASE) for k in keywords if len(k) > 3]
    out = []
    for raw in text.splitlines():
        line, tag = with_clear_times(raw.strip()), None
        if m := TAG.match(line):
            line, tag = line[m.end() :].strip(), m[1].lower()
        while line:
            skip = 12 if is_timed(line) else 0
            cuts = [m.start() for p in (REVISION, *long_words) if (m := p.search(line, skip or 1))]
            if (m := INNER_TIME.search(line, skip)) and _spoken(line[m.end() :]):
                cuts.append(m.start())
            cut = min((c for c in cuts if c > 0), default=len(line))
            out.append((line[:cut].strip(), tag))
            line = line[cut:].strip()
    return [x for x in out if x[0]]


@dataclass
class Draft:
    """The utterance being read."""

    ts: str = ""
    hint: str | None = None
    speaker: str = ""
    location: str = ""
    text: list[str] = field(default_factory=list)
    comm: bool = False


class PageReader:
    """Reads the lines of one page; each line goes to the first rule that takes it."""

    def __init__(self, names: list[str] | None = None, keywords: Iterable[str] = ()) -> None:
        self.names, self.keywords = [n.upper() for n in (SPEAKERS if names is None else names)], list(keywords)
        self.rows: list[Row] = []
        self.draft = Draft()
        self.run, self.run_from = 0, 0
        self.listing, self.at = False, 0
        self.after_comm = self.begun = False

    # rows

    def add(self, kind: str, text: str) -> None:
        self.close()
        self.rows.append({"type": kind, "timestamp": "", "speaker": "", "location": "", "text": text, "hint": None})

    def close(self) -> None:
        d, self.draft = self.draft, Draft()
        if d.ts or d.speaker or d.text:
            self.rows.append({"type": "comm" if d.ts or d.comm else "text", "timestamp": d.ts, "speaker": d.speaker, "location": d.location, "text": " ".join(d.text).strip(), "hint": d.hint})
        elif d.comm:
            self.draft.comm = True

    def named(self, text: str) -> str:
        if not self.names:
            return text
        if COMMAND.match(text.strip()):
            return ""
        key = text.strip().upper().rstrip("?")
        return key if key in self.names else nearest(key, self.names, NAME_LIKE) or text

    def take_names(self, words: list[str]) -> tuple[str, list[str]]:
        """Names in front: one of several words, else up to three of one word each."""
        found: list[str] = []
        while words and len(found) < 3:
            for n in (3, 2):
                if len(words) >= n and (several := " ".join(words[:n]).upper()) in self.names:
                    return several, words[n:]
            key = words[0].rstrip("?").upper()
            if len(words[0]) == 1 or not NAME.fullmatch(words[0]):
                break
            name = (key if key in self.names else nearest(key, self.names, TOKEN_LIKE)) if self.names else words[0].rstrip("?")
            if not name:
                break
            found.append(name)
            words = words[1:]
        return " ".join(found), words

    # what a tag means here

    def retagged(self, line: str, tag: str | None, i: int) -> str | None:
        upper, small, timed = line.upper(), any(map(str.islower, line)), is_timed(line) and not _ignition.match(line)
        stars, ends = line.startswith("***"), has_keyword(line, TAPE_END)
        if self.listing and tag not in (None, "comm"):
            kept = {"footer": stars, "meta": ends, "header": bool(_header_only.match(line))}
            tag = tag if kept.get(tag) else None
        if tag not in (None, "comm") and timed:
            tag = "comm"
        if tag == "meta":
            if self.first is not None and i <= self.first and LABEL.search(line):
                tag = "header"
            elif self.draft.ts or self.after_comm or small:
                tag = "comm"
        if tag is None and self.after_comm and not small and len(line) <= 8 and not stars:
            return "comm"
        revised = "(REV" in upper or "(RFV" in upper
        if tag == "annotation" and not revised and (small or len(line) <= 4 or is_timed(line)):
            return "comm"
        if tag == "header" and revised:
            return "annotation"
        if tag == "footer" and not stars:
            return "meta" if ends else "comm"
        return tag

    # rules, in order

    def header_only(self, line: str, tag: str | None, i: int) -> bool:
        return bool(_header_only.match(line)) and not is_timed(line)

    def place(self, line: str, tag: str | None, i: int) -> bool:
        m, last = PLACE.fullmatch(line), self.rows[-1] if self.rows else None
        if m and self.draft.ts:
            self.draft.location = m[1].strip()
        elif m and last and last["type"] == "comm" and not last["location"]:
            last["location"] = m[1].strip()
        else:
            return False
        return True

    def late_name(self, line: str, tag: str | None, i: int) -> bool:
        last = self.rows[-1] if self.rows else None
        if self.draft.ts or self.listing or not NAMES.fullmatch(line) or not last or last["type"] != "comm" or last["speaker"]:
            return False
        last["speaker"] = self.named(line)
        return True

    def tape_end(self, line: str, tag: str | None, i: int) -> bool:
        if tag is not None or not has_keyword(line, TAPE_END):
            return False
        self.add("meta", line)
        self.after_comm = False
        return True

    def tagged(self, line: str, tag: str | None, i: int) -> bool:
        if tag == "comm":
            self.draft.comm = self.begun = True
        if tag in (None, "comm"):
            return False
        self.add(tag, line)
        self.after_comm = tag == "annotation" and any(map(str.islower, line))
        return True

    def timed(self, line: str, tag: str | None, i: int) -> bool:
        m = TIME.match(line)
        if not m or _ignition.match(line):
            return False
        self.close()
        d = self.draft = Draft(ts=line if LONE_TIME.fullmatch(line) else m[1])
        self.run_from = self.run_from if self.run else len(self.rows)
        self.run += 1
        if self.run >= LIST_RUN and not self.listing:
            self.listing, self.at = True, self.run_from
        rest = line[len(d.ts) :].strip()
        if len(d.ts.split()) == 3 and (plus := re.match(r"\+(\d)\b", rest)):
            d.ts, rest = f"{d.ts} 4{plus[1]}", rest[plus.end() :].strip()
        words = rest.split()
        if len(words) > 1 and re.fullmatch(r"\d{1,2}", words[0]) and NAME.fullmatch(words[1]):
            d.hint = words.pop(0)
        d.speaker, words = self.take_names(words)
        if d.speaker and words and re.fullmatch(r"\([^)]+\)", words[0]):
            d.location = words.pop(0).strip("()")
        d.text = [" ".join(words)] if words else []
        self.after_comm = self.begun = True
        return True

    def run_over(self, line: str, tag: str | None, i: int) -> bool:
        if self.listing and self.draft.ts and not self.draft.speaker and not self.draft.text:
            self.close()
        if not self.listing:
            self.run = 0
        return False

    def orphan(self, line: str, tag: str | None, i: int) -> bool:
        return not self.draft.ts and not self.listing and bool(NAMES.fullmatch(line) or PLACE.fullmatch(line))

    def listed(self, line: str, tag: str | None, i: int) -> bool:
        if not self.listing or self.draft.ts or tag is not None or not self.rows:
            return False
        self.at = self.deal(min(self.at, len(self.rows) - 1), line)
        return True

    def deal(self, at: int, line: str) -> int:
        """Give a speaker, place or text to the list's row, or the next if that one has it; its place."""
        row = self.rows[at]
        part = "speaker" if NAMES.fullmatch(line) else "location" if PLACE.fullmatch(line) else "text"
        taken = row[part] and (part != "text" or row["speaker"] or row["location"])
        if taken and at + 1 < len(self.rows):
            at += 1
            row = self.rows[at]
        row[part] = {"speaker": lambda: self.named(line), "location": lambda: line.strip("()").strip(), "text": lambda: f"{row['text']} {line}".strip()}[part]()
        return at

    def implied(self, line: str, tag: str | None, i: int) -> bool:
        if tag is not None or self.draft.ts:
            return False
        upper = line.upper()
        caps = len(line) <= 30 and not any(map(str.islower, line)) and any(has_keyword(line, k) for k in self.keywords)
        if has_keyword(line, TAPE_END) or _transition.search(upper):
            kind = "meta"
        elif self.first is not None and i <= self.first and _header_word.search(upper):
            kind = "header"
        elif "(REV" in upper or "(RFV" in upper or caps:
            kind = "annotation"
        else:
            return False
        self.add(kind, line)
        return True

    def said(self, line: str, tag: str | None, i: int) -> bool:
        d = self.draft
        if self.begun and d.ts:
            if m := PLACE.match(line):
                d.location, line = m[1].strip(), line[m.end() :].strip()
            if line and (NAMES.fullmatch(line) or NAME_IN_PARENS.fullmatch(line)):
                d.speaker = f"{d.speaker} {line}" if d.speaker else self.named(line)
            elif line:
                d.text.append(line)
                self.after_comm = True
            return True
        d.text.append(line)
        self.after_comm = self.after_comm or (self.begun and d.comm)
        return True

    def read(self, text: str | None) -> tuple[list[Row], bool]:
        """The rows of the page, and whether it has the standard footer."""
        lines = split_lines(text or "", self.keywords)
        feet = {i for i, (line, _) in enumerate(lines) if is_footer(line)}
        stars = {i - 1 for i in feet if i and re.fullmatch(r"\*{3,}", lines[i - 1][0])}
        lines = [x for i, x in enumerate(lines) if i not in feet | stars]
        self.first = next((i for i, (line, _) in enumerate(lines) if is_timed(line)), None)
        rules: list[Callable[[str, str | None, int], bool]] = [self.header_only, self.place, self.late_name, self.tape_end, self.tagged, self.timed, self.run_over, self.orphan, self.listed, self.implied, self.said]
        for i, (line, tag) in enumerate(lines):
            tag = self.retagged(line, tag, i)
            any(rule(line, tag, i) for rule in rules)
        self.close()
        timed = [i for i, (line, _) in enumerate(lines) if is_timed(line)]
        if self.listing and timed and not any(r["speaker"] for r in self.rows if r["timestamp"]):
            self.deal_again([line for line, _ in lines[timed[-1] + 1 :]])
        return self.rows, bool(feet)

    def deal_again(self, lines: list[str]) -> None:
        """A list without any speaker: its rows are emptied and the lines after it dealt once more."""
        for row in self.rows[self.run_from :]:
            row.update(speaker="", location="", text="")
        at = self.run_from
        for line in lines:
            if at < len(self.rows) and not _header_only.match(line):
                at = self.deal(at, line)
        while self.rows and not any(self.rows[-1][k] for k in ("timestamp", "speaker", "location", "text")):
            self.rows.pop()


def meta_type(text: str) -> str | None:
    if has_keyword(text, TAPE_END):
        return "end_of_tape"
    return "lunar_rev" if LUNAR.match(text) else "rest_period" if REST.search(text) else None


def parsed(pages: DataFrame, names: list[str] | None = None, keywords: Iterable[str] = ()) -> DataFrame:
    """(document, page_num, block_idx, type, timestamp, speaker, location, text, hint, meta_type, footer) of (document, page_num, text).

    Header rows are left out and unattached text is a continuation. A null or empty text gives no rows.
    """
    words = tuple(keywords)

    def each(page: Row) -> list[Row]:
        rows, footer = PageReader(names, words).read(page["text"])
        kept = (r for r in rows if r["type"] != "header")
        return [{**r, "document": page["document"], "page_num": page["page_num"], "block_idx": i, "type": "continuation" if r["type"] == "text" else r["type"], "meta_type": meta_type(r["text"]) if r["type"] == "meta" else None, "footer": footer} for i, r in enumerate(kept)]

    rows = pages.select("document", F.col("page_num").cast("long"), "text")
    return row_map(rows, each, f"document {type_of(rows, 'document')}, page_num long, block_idx long, type string, timestamp string, speaker string, location string, text string, hint string, meta_type string, footer boolean", dealt=True)


# two readings of a page

_letters = re.compile("[A-Za-z]+").findall
_words = re.compile("[A-Za-z]{2,}").findall


def quality(text: str) -> float:
    """Share of letters, an eighth per word, less the share of odd symbols (half at most)."""
    if not text:
        return 0.0
    odd = sum(not (c.isalpha() or c.isdigit() or c.isspace() or c in ".,;:'\"-()/?!") for c in text)
    return sum(map(str.isalpha, text)) / len(text) + len(_words(text)) / 8 - min(0.5, odd / len(text))


def likeness(a: str, b: str) -> float:
    x, y = set(_letters(a.lower())), set(_letters(b.lower()))
    return len(x & y) / max(1, len(x | y))


def verdict(held: str, other: str) -> str:
    """What the other reading of an utterance is: another quote, a better text, more text, or nothing new."""
    a, b = set(held.lower().split()), set(other.lower().split())
    if a and b and len(a & b) < 0.3 * min(len(a), len(b)):
        return "quote"
    longer, alike = len(other) - len(held) >= 8, likeness(held, other)
    if held and longer and (held in other or alike >= 0.85):
        return "better"
    score = quality(held)
    if held and score >= 0.8 and len(held.strip()) <= 15 and len(other.strip()) >= 25 and alike < 0.2:
        return "more"
    return "better" if not held or score < 0.6 or quality(other) > score + 0.4 else "same"


def merged_blocks(held: list[Row], other: list[Row]) -> list[Row]:
    """The preferred blocks of a page, mended and filled from another reading's."""

    def find(timestamp: str | None, speaker: str = "", location: str = "", last: bool = False) -> int | None:
        """First (or last) comm block of that time with speaker and place, else the first of that time."""
        same = [i for i, b in enumerate(held) if timestamp and b["type"] == "comm" and b["timestamp"] == timestamp]
        agrees = lambda want, has: not want or want.upper().strip() == (has or "").upper()
        strict = [i for i in same if agrees(speaker, held[i]["speaker"]) and agrees(location, held[i]["location"])]
        return (strict[-1] if last else strict[0]) if strict else next(iter(same), None)

    held, bare = list(held), {"timestamp": None, "speaker": None, "location": None}
    norm = lambda t: " ".join(t.lower().split())
    texts = [b["text"] for b in held if b["text"]]
    seen = set(map(norm, texts))
    times = [b["timestamp"] if b["type"] == "comm" else None for b in other]
    for i, b in enumerate(other):
        text = b["text"] or ""
        if times[i] and text and (k := find(times[i], b["speaker"] or "", b["location"] or "")) is not None:
            said = verdict(held[k]["text"] or "", text)
            if said in ("quote", "more"):
                held.insert(k + 1, b if said == "quote" else {**b, **bare, "type": "continuation"})
                seen.add(norm(text))
                texts += [text] if said == "quote" else []
            elif said == "better":
                held[k] = {**held[k], "text": text, "speaker": held[k]["speaker"] or b["speaker"], "location": held[k]["location"] or b["location"]}
        elif b["type"] == "continuation" and len(_words(text)) >= 3 and len(text.strip()) >= 20 and norm(text) not in seen:
            said = norm(text)
            if not any(reaches(said, norm(t), 0.9) for t in texts):
                before = find(next((t for t in reversed(times[:i]) if t), None), last=True)
                after = find(next((t for t in times[i + 1 :] if t), None))
                held.insert(before + 1 if before is not None else after or 0, {**b, **bare})
                seen.add(norm(text))
    return held


class PassMerge(Machine):
    """Collects both readings of one page, the preferred one first, and writes the merged blocks."""

    def __init__(self) -> None:
        self.held: list[Row] = []
        self.other: list[Row] = []

    def push(self, row: Row) -> list[Row]:
        (self.other if row["rank"] else self.held).append(row)
        return []

    def end(self) -> list[Row]:
        return [{**b, "block_idx": i} for i, b in enumerate(merged_blocks(self.held, self.other))]


_BLOCK = ["type", "timestamp", "speaker", "location", "text"]


def merged_passes(preferred: DataFrame, fallback: DataFrame) -> DataFrame:
    """The preferred blocks of each page, mended and filled from the fallback's.

    A page without preferred blocks gives no rows, as its fallback has nothing to attach to, but for
    substantive continuations.
    """
    both = [df.select("document", F.col("page_num").cast("long"), F.col("block_idx").cast("long"), *_BLOCK, F.lit(rank).alias("rank")) for rank, df in enumerate((preferred, fallback))]
    return ordered_scan(both[0].union(both[1]), ["document", "page_num"], ["rank", "block_idx"], PassMerge, f"document {type_of(both[0], 'document')}, page_num long, block_idx long, type string, timestamp string, speaker string, location string, text string")
