"""Readers of page images: a backend is asked once per page and reading; errors are rows, not failures.

Backends are plain objects that travel to the executors. ``HttpOcr`` asks a server with a chat interface for images;
``StoredOcr`` answers from texts that are there already.
"""

from __future__ import annotations

import base64
import json
import urllib.error
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ravelin.operators.scans import type_of
from ravelin.shipping import ship
from ravelin.sources import images


class OcrError(Exception):
    """A page that could not be read."""


class OcrConnectionError(OcrError):
    """The server was not reached."""


class OcrResponseError(OcrError):
    """The server's answer holds no text."""


class OcrBackend(Protocol):
    def read(self, image: bytes, prompt: str, document: str, page_num: int, name: str) -> str:
        """The text of an encoded image."""


@dataclass
class StoredOcr:
    """Texts by (document, page_num, pass); a page that is not there is an error."""

    texts: dict[tuple[str, int, str], str] = field(default_factory=dict)

    def read(self, image: bytes, prompt: str, document: str, page_num: int, name: str) -> str:
        try:
            return self.texts[document, page_num, name]
        except KeyError:
            raise OcrResponseError("no text for this page") from None


@dataclass
class HttpOcr:
    """A server that takes messages with images and answers with text, without randomness."""

    url: str
    model: str = ""
    timeout: int = 120
    max_tokens: int = 4096

    @property
    def endpoint(self) -> str:
        base = self.url.rstrip("/")
        return f"{base if base.endswith('/v1') else base + '/v1'}/chat/completions"

    def request(self, image: bytes, prompt: str) -> dict:
        kind = "png" if image[:4] == b"\x89PNG" else "jpeg"
        picture = {"type": "image_url", "image_url": {"url": f"data:image/{kind};base64,{base64.b64encode(image).decode()}"}}
        return {"model": self.model, "messages": [{"role": "user", "content": [{"type": "text", "text": prompt}, picture]}], "max_tokens": self.max_tokens, "temperature": 0.0}

    def read(self, image: bytes, prompt: str, document: str, page_num: int, name: str) -> str:
        asked = urllib.request.Request(self.endpoint, json.dumps(self.request(image, prompt)).encode(), {"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(asked, timeout=self.timeout) as answer:
                return json.loads(answer.read())["choices"][0]["message"]["content"].strip()
        except (urllib.error.URLError, TimeoutError) as e:
            raise OcrConnectionError(str(e)) from e
        except (KeyError, IndexError, TypeError, ValueError) as e:
            raise OcrResponseError(f"no text in the answer: {e!r}") from e


def read_images(pages: DataFrame, backend: OcrBackend, asked: dict[str, str], at_once: int = 4, column: float = 0.3) -> DataFrame:
    """(document, page_num, pass, text, error) of ``pages`` (document, page_num, image), for each reading and its prompt.

    ``at_once`` tasks ask the backend. The text column is the part of the image right of ``column`` of its width;
    the faint reading gets an image of stronger contrast.
    """
    ship(pages.sparkSession)
    rows = pages.select("document", F.col("page_num").cast("long").alias("page_num"), "image")
    schema = pa.schema([("document", pa.string()), ("page_num", pa.int64()), ("pass", pa.string()), ("text", pa.string()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page in batch.to_pylist():
                out = []
                for name, prompt in asked.items():
                    try:
                        image = images.for_reading(page["image"], name, column)
                        out.append((str(page["document"]), page["page_num"], name, backend.read(image, prompt, str(page["document"]), page["page_num"], name), None))
                    except (OcrError, ValueError) as e:
                        out.append((str(page["document"]), page["page_num"], name, None, f"{type(e).__name__}: {e}"))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)] if out else [pa.array([], f.type) for f in schema], schema=schema)

    read = rows.repartition(at_once, "document", "page_num").mapInArrow(run, "document string, page_num long, pass string, text string, error string")
    return read.withColumn("document", F.col("document").cast(type_of(rows, "document")))
