"""Token counts per section by offset-mapped attribution.

A text is encoded once as a whole; the tokens' character spans are then joined to the
sections' intervals. A token that crosses a boundary is allocated by ``rule``:

* ``first``  - wholly to the section with its first character (the default);
* ``last``   - wholly to the section with its last character;
* ``larger`` - wholly to the section that holds most of its characters, ties to the earlier.

Without ``sections`` the sections of a text are its lines, each with its line feed, so they
cover the text. Given sections are ``(doc_id, section, begin, end)`` rows; tokens outside all of them
go to section -1. Sections are taken in the order of (begin, end, section): one that overlaps those before
it begins where the furthest of them ends, and may be left empty, so each character has one owner. Rows with
a null in doc_id, begin or end, and those that end before they begin, are no sections; a null section name is
a name. The sections of a document are held in one row, as its text is.

Defined cases: a null or empty text has one section 0 without tokens; a very long text is encoded whole; an
empty table gives no rows; equal rows are counted each, also those that share an id and so its sections; a null
doc_id stays null and has no given sections; of equally large parts the earlier gets the token; other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ravelin.llm.common import map_arrow
from ravelin.llm.tokens import encoder, vocabulary_path

SCHEMA = "doc_id long, section int, begin long, end long, n_tokens long, n_crossing long"
ARROW = pa.schema([("doc_id", pa.int64()), ("section", pa.int32()), ("begin", pa.int64()), ("end", pa.int64()), ("n_tokens", pa.int64()), ("n_crossing", pa.int64())])


def line_bounds(text: str) -> np.ndarray:
    """Starts of the lines and the end of the text."""
    at = np.cumsum([len(x) + 1 for x in text.split("\n")])
    at[-1] -= 1
    if len(at) > 1 and at[-1] == at[-2]:
        at = at[:-1]
    return np.concatenate([[0], at])


def allocate(starts: np.ndarray, ends: np.ndarray, begins: np.ndarray, stops: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The interval (index, -1: none) of each token, and whether it crosses a boundary.

    ``begins`` are sorted and the intervals are disjoint.
    """

    def holder(chars: np.ndarray) -> np.ndarray:
        i = np.searchsorted(begins, chars, "right") - 1
        return np.where((i >= 0) & (chars < stops[np.maximum(i, 0)]), i, -1)

    last_char = np.maximum(ends - 1, starts)
    first, last = holder(starts), holder(last_char)
    crossing = first != last
    if rule == "first":
        return first, crossing
    if rule == "last":
        return last, crossing
    chosen = first.copy()
    for t in np.flatnonzero(crossing):
        held = holder(np.arange(starts[t], last_char[t] + 1))
        kinds, at, n = np.unique(held, return_index=True, return_counts=True)
        chosen[t] = kinds[np.lexsort((at, -n))[0]]
    return chosen, crossing


def section_token_counts(documents: DataFrame, sections: DataFrame | None = None, tokenizer_path: str | None = None, kind: str = "byte", rule: str = "first") -> DataFrame:
    """One row per document and section; see the module's text."""
    path = tokenizer_path or vocabulary_path("byte_bpe_50k.json")
    docs = documents.select(F.col("doc_id").cast("long"), "text")
    if sections is not None:
        spans = F.sort_array(F.collect_list(F.struct(*(F.col(c).cast("long").alias(c) for c in ("begin", "end", "section")))))
        given = sections.where(F.col("doc_id").isNotNull() & (F.col("begin") <= F.col("end")) & (F.col("end") >= 0))
        docs = docs.join(given.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(spans.alias("spans")), "doc_id", "left")

    by_line = sections is None

    def run(batches):
        token_spans = encoder(path, kind).token_spans
        for batch in batches:
            out = [[] for _ in ARROW]
            given = batch["spans"].to_pylist() if "spans" in batch.schema.names else [None] * batch.num_rows
            for doc_id, text, spans in zip(batch["doc_id"].to_pylist(), batch["text"], given, strict=True):
                text = text.as_py() or ""
                if by_line:
                    bounds = line_bounds(text)
                    begins, stops = bounds[:-1], bounds[1:]
                    names = list(range(len(begins)))
                else:
                    begins, stops = (np.array([s[k] for s in spans or []], np.int64) for k in ("begin", "end"))
                    names = [s["section"] for s in spans or []]
                    furthest = np.maximum.accumulate(np.append(0, stops))[:-1]
                    begins, stops = np.maximum(begins, furthest), np.maximum(stops, furthest)
                starts, ends = token_spans(text)
                if len(begins):
                    owner, crossing = allocate(starts, ends, begins, stops, rule)
                else:
                    owner, crossing = np.full(len(starts), -1), np.zeros(len(starts), bool)
                n = np.bincount(owner + 1, minlength=len(begins) + 1)
                over = np.bincount(owner + 1, weights=crossing, minlength=len(begins) + 1).astype(np.int64)
                skip = 0 if n[0] else 1
                for column, values in zip(out, ([doc_id] * (len(n) - skip), [-1, *names][skip:], [0, *begins.tolist()][skip:], [len(text), *stops.tolist()][skip:], n[skip:].tolist(), over[skip:].tolist()), strict=True):
                    column.extend(values)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, ARROW, strict=True)], schema=ARROW)

    return map_arrow(docs, run, SCHEMA)
