"""Pages built from their readings: one row per page with its header and ordered blocks.

All readings of a page meet in one task, the best-named first; each is read, put together by page steps and
merged into what the ones before gave. Then what lines of the text column hold fills blocks without text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ravelin.functions import lines as known
from ravelin.functions.similarity import has_keyword, is_goss_net, is_header
from ravelin.functions.texts import FOOTERS
from ravelin.operators import pages, stitches
from ravelin.operators.scans import Machine, Row, ordered_scan, row_map, type_of

#: The readings of a page, the preferred first; the last is of its text column only.
PASSES, COLUMN = ("raw", "raw_fallback", "faint_fallback"), "textcol"
#: Lines before the first time, or so many, are the header; its words; the footer; what a time in a text looks like.
HEADER_LINES, TITLE_WORDS = 10, ("APOLLO", "TRANSCRIPTION")
FOOTER = "*** Three asterisks denote clipping of words and phrases."
TITLE, REST = "AIR-TO-GROUND VOICE TRANSCRIPTION", "REST PERIOD - NO COMMUNICATIONS"
EMBEDDED = re.compile(r"\(?\b[0-9OIil]{1,2}[:\s-][0-9OIil]{1,2}[:\s-][0-9OIil]{1,2}[ .:\-][0-9OIil]{1,2}\b\)?")
IGNITION_BEFORE = re.compile(r"\bTIG\s+\d{1,3}\s*$", re.IGNORECASE)
NET = re.compile(r"\(?\s*GOSS\s+NET\s+1\s*\)?", re.IGNORECASE)
TAPE_ONLY = re.compile(r"\s*TAPE\s*\d{1,4}\s*", re.IGNORECASE)
COMMANDED = re.compile(r"(NOUN|VERB)\s*\d", re.IGNORECASE)
LOCATED = re.compile(r"\(([^)]+)\)\s*(.*)")
DIGIT_LIKE, AS_DIGITS = re.compile("[0-9OIilCSB]"), str.maketrans("OoCcIilSsBb", "00001115588")
PAGE_AT_END = re.compile(r"\s+Page\s+\d+\s*$", re.IGNORECASE)

FIELDS = ["type", "timestamp", "speaker", "location", "text", "meta_type", "timestamp_correction", "hint"]
BLOCK = "struct<type:string,timestamp:string,speaker:string,location:string,text:string,meta_type:string,timestamp_correction:string,hint:string,continuation_from_prev:boolean>"
HEADER = "struct<page:int,tape:string,is_apollo_title:boolean,page_type:string,footer:boolean>"
_header_only = re.compile(known.HEADER_ONLY)


@dataclass
class Building:
    """What of the settings a page is built by."""

    names: list[str] | None = None
    keywords: tuple[str, ...] = ()
    places: tuple[str, ...] = ()
    inline_terms: tuple[str, ...] = stitches.INLINE
    footers: dict[int, str] = field(default_factory=dict)
    page_offset: int = 0


def block(kind: str, text: str | None = None, **rest: object) -> Row:
    return {**dict.fromkeys([*FIELDS, "continuation_from_prev"]), "type": kind, "text": text, **rest}


def page_header(text: str, page: int) -> Row:
    """The page's number, its last tape label and whether it has the title, from the lines before the first time."""
    held = [x.strip() for x in text.splitlines() if x.strip()]
    first = next((i for i, x in enumerate(held) if pages.is_timed(x)), HEADER_LINES)
    zone = held[:first]
    tapes = [m[1].replace(" ", "") for x in zone if (m := pages.TAPE.search(x))]
    title = any(all(has_keyword(" ".join(x.split()), w) for w in TITLE_WORDS) for x in zone)
    return {"page": page, "tape": tapes[-1] if tapes else None, "is_apollo_title": title, "page_type": None, "footer": False}


def blocks_of(rows: list[Row], footers: dict[int, str], page: int) -> list[Row]:
    """Blocks of a reading's rows: headers and labels go, loose text joins the block before, footers are canonical."""
    out: list[Row] = []
    for r in rows:
        kind, text = "continuation" if r["type"] == "text" else r["type"], r["text"] or ""
        if kind == "header" or (kind == "comm" and text and (_header_only.match(text) or TAPE_ONLY.fullmatch(text))):
            continue
        b = block(kind, text or None)
        if kind == "comm":
            b.update(timestamp=_carried(r["timestamp"]), speaker=r["speaker"] or None, location=r["location"] or None, hint=r["hint"])
        elif kind == "meta" and text and has_keyword(text, pages.TAPE_END):
            b["meta_type"] = "end_of_tape"
        elif kind == "footer" and text:
            b["text"] = footers.get(page, FOOTER if text.lstrip().startswith("***") else text)
        if b["text"] and kind in ("continuation", "meta", "annotation") and (NET.fullmatch(b["text"]) or is_goss_net(b["text"]) or stitches.is_not_one(b["text"])):
            continue
        last = out[-1] if out else None
        loose = kind == "continuation" and last is not None
        untyped = kind == "meta" and b["text"] and last is not None and last["type"] == "meta" and not last["meta_type"] and not b["meta_type"]
        if loose or untyped:
            if b["text"]:
                last["text"] = f"{last['text'] or ''} {b['text']}".strip()
        else:
            out.append(b)
    return out


def _carried(timestamp: str | None) -> str | None:
    """Parts over their range carry into the next; other than four numbers stay as they are."""
    parts = (timestamp or "").split()
    if len(parts) != 4 or not all(re.fullmatch(r"[+-]?\d+", p) for p in parts):
        return timestamp or None
    d, h, m, s = map(int, parts)
    seconds = ((d * 24 + h) * 60 + m) * 60 + s
    return f"{seconds // 86400:02} {seconds // 3600 % 24:02} {seconds // 60 % 60:02} {seconds % 60:02}"


def embedded_time(raw: str) -> str | None:
    """The first eight digits or look-alikes as a timestamp; null if there are fewer."""
    digits = "".join(DIGIT_LIKE.findall(raw)).translate(AS_DIGITS)[:8]
    return " ".join(digits[i : i + 2] for i in range(0, 8, 2)) if len(digits) == 8 else None


def said_at(timestamp: str, text: str) -> Row:
    """A comm block of what stands behind a time in a text: a speaker, a place, what is said."""
    words, speaker, location = text.split(), None, None
    if words and pages.NAME.fullmatch(words[0]) and not COMMANDED.match(words[0]):
        speaker, text = words[0], " ".join(words[1:])
    if m := LOCATED.fullmatch(text):
        location, text = m[1].strip().upper(), m[2].strip()
    return block("comm", text.lstrip(":-").strip() or None, timestamp=timestamp, speaker=speaker, location=location)


def split_times(blocks: list[Row]) -> list[Row]:
    """Times within texts begin blocks of their own, unless they are of an ignition; what stands before the first stays."""
    out: list[Row] = []
    for b in blocks:
        text = b["text"] or ""
        found = [m for m in EMBEDDED.finditer(text) if not IGNITION_BEFORE.search(text[max(0, m.start() - 10) : m.start()])]
        if not found:
            out.append(b)
            continue
        if before := text[: found[0].start()].strip():
            out.append({**b, "text": before})
        ends = [m.start() for m in found[1:]] + [len(text)]
        out += [said_at(t, text[m.end() : end].strip()) for m, end in zip(found, ends, strict=True) if (t := embedded_time(m[0]))]
    return out


def lunar(blocks: list[Row]) -> list[Row]:
    """Comm blocks of a lunar revolution are meta with open seconds."""
    for b in blocks:
        if b["type"] == "comm" and (m := pages.LUNAR.match((b["text"] or "").strip())):
            parts = (b["timestamp"] or "").split()
            at = " ".join([*parts[:3], "--"]) if len(parts) in (3, 4) else b["timestamp"]
            b.update(type="meta", meta_type="lunar_rev", timestamp=at, speaker=None, location=None, text=f"{m[1].upper()} LUNAR REV {re.findall(r'[0-9]+', m[0])[-1]}")
    return blocks


def canonical(blocks: list[Row]) -> tuple[list[Row], bool]:
    """Rest periods and titles have one text; a rest period's page drops the title. Whether there is a rest period."""
    rest = any(pages.REST.search(b["text"] or "") for b in blocks)
    out = []
    for b in blocks:
        text = b["text"] or ""
        if pages.REST.search(PAGE_AT_END.sub("", text)):
            b = {**b, "type": "meta", "meta_type": "rest_period", "text": REST, "speaker": None, "location": None, "timestamp_correction": None}
        if text and is_header(text):
            if rest:
                continue
            b = {**b, "type": "meta", "meta_type": "transcript_header", "text": TITLE}
        out.append(b)
    return out, rest


_feet = [re.compile(p) for p in FOOTERS]


def tidied(text: str, places: Iterable[str]) -> str:
    """Without a footer at the end, its noise in front, and tags of places."""
    for pattern in _feet:
        text = pattern.sub("", text)
    text = stitches.clean_start(text.strip())
    for name in places:
        text = re.sub(rf"(?i)\(\s*{re.escape(name)}\s*\)\s*", " ", text).strip()
    return text.strip()


def read_page(text: str, page_num: int, b: Building) -> tuple[Row, list[Row]]:
    """Header and blocks of one reading of a page."""
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    page = page_num + b.page_offset
    rows, footer = pages.PageReader(b.names, b.keywords).read(text)
    blocks = blocks_of(rows, b.footers, page)
    for step in (split_times, stitches.twins(1), stitches.twins(stitches.LOOK_BACK), lunar, stitches.begun_small, stitches.continued, stitches.inline(b.inline_terms), stitches.fragments):
        blocks = step(blocks)
    blocks, rest = canonical(blocks)
    for x in blocks:
        x["text"] = tidied(x["text"], b.places) if x["text"] else x["text"]
    header = page_header(text, page)
    return {**header, "footer": footer, "page_type": "rest_period" if rest else None}, blocks


def is_column_line(line: str) -> bool:
    """A line of the text column that is said: no name, no place, no label."""
    return bool(line) and not (pages.NAMES.fullmatch(line) or pages.PLACE.fullmatch(line) or _header_only.match(line))


def filled(blocks: list[Row], column: str) -> list[Row]:
    """Comm blocks without text take the column's lines in order; those that go on in small letters join the block before."""
    empty = [i for i, b in enumerate(blocks) if b["type"] == "comm" and not b["text"]]
    said = [x for x in (raw.strip() for raw in column.splitlines()) if is_column_line(x)]
    given = dict(zip(empty, said, strict=False))
    out: list[Row] = []
    for i, b in enumerate(blocks):
        b = {**b, "text": given.get(i, b["text"])}
        last = out[-1] if out else None
        if i in given and last and last["type"] == "comm" and last["text"] and (b["text"][0] in ";,.)" or b["text"][0].islower()):
            last["text"] = f"{last['text']} {b['text']}"
        elif not (given and b["type"] == "comm" and not b["text"] and not b["speaker"] and b["timestamp_correction"] == "inferred_missing"):
            out.append(b)
    return out


class PageBuilder(Machine):
    """The readings of one page, by rank, to its row."""

    def __init__(self, building: Building) -> None:
        self.building, self.key, self.header, self.blocks, self.column = building, None, None, None, ""

    def push(self, row: Row) -> list[Row]:
        self.key = {k: row[k] for k in ("document", "page_num")}
        if row["rank"] == len(PASSES):
            self.column = row["text"] or ""
            return []
        header, blocks = read_page(row["text"] or "", row["page_num"], self.building)
        if self.blocks is None:
            self.header, self.blocks = header, blocks
        else:
            self.blocks = pages.merged_blocks(self.blocks, blocks)
        return []

    def end(self) -> list[Row]:
        blocks = filled(self.blocks, self.column) if self.blocks is not None else []
        header = self.header or page_header("", self.key["page_num"] + self.building.page_offset)
        return [{**self.key, "header": header, "blocks": blocks}]


def built_pages(page_texts: DataFrame, building: Building) -> DataFrame:
    """(document, page_num, header, blocks): one row per page of (document, page_num, text) or (document, page_num, pass, text).

    Null and empty texts give a page without blocks; of several rows of one page and pass the ones after the first
    are merged like further readings.
    """
    rank = F.lit(0)
    if "pass" in page_texts.columns:
        rank = F.coalesce(*(F.when(F.col("pass") == name, i) for i, name in enumerate((*PASSES, COLUMN))))
    rows = page_texts.select("document", F.col("page_num").cast("long").alias("page_num"), rank.alias("rank"), "text")
    output = f"document {type_of(rows, 'document')}, page_num long, header {HEADER}, blocks array<{BLOCK}>"
    if "pass" not in page_texts.columns:

        def each(row: Row) -> list[Row]:
            builder = PageBuilder(building)
            builder.push(row)
            return builder.end()

        return row_map(rows, each, output, dealt=True)
    return ordered_scan(rows, ["document", "page_num"], ["rank", "text"], lambda: PageBuilder(building), output)


def continued_pages(built: DataFrame) -> DataFrame:
    """Pages whose first block is a continuation of the page before say so, if that one ends in comm or continuation."""
    before = F.lag(F.try_element_at("blocks", F.lit(-1))["type"]).over(Window.partitionBy("document").orderBy("page_num"))
    flag = (F.get("blocks", F.lit(0))["type"] == "continuation") & before.isin("comm", "continuation")
    marked = built.withColumn("_flag", F.coalesce(flag, F.lit(False)))
    blocks = F.transform("blocks", lambda b, i: b.withField("continuation_from_prev", F.when((i == 0) & F.col("_flag"), F.lit(True)).otherwise(b["continuation_from_prev"])))
    return marked.withColumn("blocks", blocks).drop("_flag")


def exploded(page_rows: DataFrame) -> DataFrame:
    """(document, page_num, block_idx, the block's fields), one row per block."""
    at = page_rows.select("document", F.col("page_num").cast("long").alias("page_num"), F.posexplode("blocks").alias("block_idx", "b"))
    fields = page_rows.schema["blocks"].dataType.elementType.names
    return at.select("document", "page_num", F.col("block_idx").cast("long").alias("block_idx"), *(F.col(f"b.{c}").alias(c) for c in fields))


def page_rows(blocks: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """(document, page_num, header, blocks) again; blank members are absent. Pages of ``headers`` without blocks stay."""
    names = [c for c in [*FIELDS, "continuation_from_prev"] if c in blocks.columns]
    kept = lambda c: F.when(F.col(c).cast("string") != "", F.col(c))
    one = F.struct("block_idx", F.struct(*(kept(c).alias(c) for c in names)).alias("b"))
    held = F.transform(F.sort_array(F.collect_list(one)), lambda x: x["b"])
    grouped = blocks.groupBy("document", "page_num").agg(held.alias("blocks"))
    if headers is None:
        return grouped.select("document", "page_num", F.struct(F.col("page_num").cast("int").alias("page")).alias("header"), "blocks")
    kind = grouped.schema["blocks"].dataType.simpleString()
    return headers.join(grouped, ["document", "page_num"], "left").select("document", "page_num", "header", F.coalesce("blocks", F.array().cast(kind)).alias("blocks"))


def end_of_tape(blocks: Column) -> Column:
    """Whether a page's blocks hold an end of tape."""
    return F.coalesce(F.exists(blocks, lambda b: (b["type"] == "meta") & F.upper(b["text"]).contains("END OF TAPE")), F.lit(False))

