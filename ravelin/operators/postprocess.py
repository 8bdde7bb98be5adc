"""Blocks corrected, in the order of the stages: structure, texts, times, speakers, places, words, stations, kinds, noise.

Three ordered scans: the first and the last see a page at a time, so a document with many pages is spread over
tasks; only the times between them are read in document order. Kinds, noise and neighbours of one speaker are column
expressions and windows by page behind them.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ravelin.functions import repairs, similarity, stations
from ravelin.functions.speakers import LOCATIONS, REMARKS, SPEAKER_FIXES, SPEAKERS
from ravelin.functions.timecodes import formatted
from ravelin.operators import blocks as ops
from ravelin.operators import building, corrections, stitches
from ravelin.operators.building import FIELDS
from ravelin.operators.scans import Machine, Row, ordered_scan, type_of

COLUMNS = [*FIELDS, "continuation_from_prev"]
DDL = ", ".join([*(f"{c} string" for c in FIELDS), "continuation_from_prev boolean"])
SAID = ("comm", "annotation", "continuation")


@dataclass
class Correction:
    """What of the settings blocks are corrected by; no speakers, places or corrector leave theirs out."""

    speakers: list[str] = field(default_factory=lambda: list(SPEAKERS))
    fixes: dict[str, str] = field(default_factory=lambda: dict(SPEAKER_FIXES))
    places: list[str] = field(default_factory=lambda: list(LOCATIONS))
    remarks: list[str] = field(default_factory=lambda: list(REMARKS))
    keywords: list[str] = field(default_factory=list)
    manual: dict[str, str] = field(default_factory=dict)
    corrector: repairs.TextCorrector | None = None


def said_cleanly(places: Iterable[str]) -> stitches.Step:
    def step(blocks: list[Row]) -> list[Row]:
        return [{**b, "text": repairs.cleaned(b["text"], places)} if b["type"] in SAID and b["text"] else b for b in blocks]

    return step


def put_together(c: Correction) -> list[stitches.Step]:
    return [building.split_times, stitches.twins(1), stitches.twins(stitches.LOOK_BACK), stitches.continued, stitches.inline(c.remarks), stitches.fragments, said_cleanly(c.places)]


def named(c: Correction) -> stitches.Step:
    """Manual names by time; names with words behind them are split; then who speaks, and no name twice."""

    def step(blocks: list[Row]) -> list[Row]:
        voices = corrections.Voices(similarity.SpeakerBook(c.speakers, c.fixes, tuple(c.keywords)))
        known = {s.upper() for s in c.speakers}
        for b in blocks:
            if b["type"] != "comm":
                continue
            b["speaker"] = c.manual.get(b["timestamp"] or "", b["speaker"])
            first, _, rest = (b["speaker"] or "").strip().partition(" ")
            if rest.strip() and (first.upper() in known or c.fixes.get(first.upper()) in known):
                b["speaker"], b["text"] = first.upper(), f"{rest.strip()} {b['text'] or ''}".strip()
            found = voices.told(b["speaker"], b["text"])
            b["speaker"], text = found["speaker"] or None, found["text"]
            if found["speaker"] and text.upper().startswith((found["speaker"].upper() + " ", found["speaker"].upper() + ":")):
                text = text[len(found["speaker"]) + 1 :].lstrip()
            b["text"] = text or None
        return blocks

    return step


def located(c: Correction) -> stitches.Step:
    def step(blocks: list[Row]) -> list[Row]:
        return [{**b, "location": similarity.place(b["location"], c.places, c.remarks) or None} if b["type"] == "comm" and b["location"] else b for b in blocks]

    return step


def worded(c: Correction) -> stitches.Step:
    def step(blocks: list[Row]) -> list[Row]:
        return [{**b, "text": c.corrector.text(b["text"])} if b["text"] and b["type"] != "footer" else b for b in blocks]

    return step


def stationed(keywords: list[str]) -> stitches.Step:
    """Stations in texts become annotations behind their block; a comm block of nothing else becomes the first of them."""

    def step(blocks: list[Row]) -> list[Row]:
        out: list[Row] = []
        for b in blocks:
            text, found = stations.taken_from_page_text(b["text"] or "", keywords)
            marks = [building.block("annotation", t) for t in found]
            if not found:
                out.append(b)
            elif not text and b["type"] == "comm" and not b["timestamp"]:
                out += [{**b, "type": "annotation", "text": found[0], "speaker": None, "location": None}, *marks[1:]]
            else:
                out += [{**b, "text": text}, *marks]
        return [b for b in out if b["text"]]

    return step


def corrected(c: Correction) -> list[stitches.Step]:
    steps: list[stitches.Step] = [named(c)] if c.speakers else []
    steps += [located(c)] if c.places else []
    steps += [worded(c)] if c.corrector else []
    return [*steps, stationed(c.keywords)]


class Page(Machine):
    """Holds the blocks of one page and takes them through steps; they are numbered anew."""

    def __init__(self, steps: list[stitches.Step]) -> None:
        self.steps, self.key, self.blocks = steps, {}, []

    def push(self, row: Row) -> list[Row]:
        self.key = {k: row[k] for k in ("document", "page_num")}
        self.blocks.append({c: row[c] for c in COLUMNS})
        return []

    def end(self) -> list[Row]:
        blocks = self.blocks
        for step in self.steps:
            blocks = step(blocks)
        return [{**self.key, "block_idx": i, **b} for i, b in enumerate(blocks)]


def paged(blocks: DataFrame, steps: list[stitches.Step]) -> DataFrame:
    absent = {c: F.lit(None).cast("boolean" if c == "continuation_from_prev" else "string") for c in COLUMNS if c not in blocks.columns}
    rows = blocks.withColumns(absent).select("document", *(F.col(c).cast("long").alias(c) for c in ("page_num", "block_idx")), *COLUMNS)
    return ordered_scan(rows, ["document", "page_num"], ["block_idx"], lambda: Page(steps), f"document {type_of(rows, 'document')}, page_num long, block_idx long, {DDL}")


def postprocessed(blocks: DataFrame, c: Correction, listed: DataFrame | None = None) -> DataFrame:
    """(document, page_num, block_idx, ...) of the corrected blocks; null and blank texts are pruned.

    ``listed`` has the times of other pages of the documents, from which a selection of pages takes its first ones.
    """
    timed = corrections.timed_blocks(paged(blocks, put_together(c)), "timestamp", "hint", listed)
    comm = F.col("type") == "comm"
    told = timed.withColumns({"timestamp": F.when(comm & F.col("fixed").isNotNull(), formatted(F.col("fixed"))).otherwise(F.col("timestamp")), "timestamp_correction": F.when(comm, F.coalesce("correction", "timestamp_correction")).otherwise(F.col("timestamp_correction"))})
    said = ops.one_voice(ops.quiet(ops.reclassified(paged(told, corrected(c)).drop("hint"))))
    said = said.where(F.trim(F.regexp_replace("text", r"\s+", " ")) != "")
    return said.withColumn("block_idx", (F.row_number().over(ops.by_page()) - 1).cast("long"))
