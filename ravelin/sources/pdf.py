"""Pages of PDF files as rows. The library that draws them is optional: it is looked for when a file is opened.

Executors get the file from Spark's own file server, open it once per task and draw the pages dealt to them; a page
that fails is a row with its error.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from ravelin.shipping import ship
from ravelin.sources import images

POINTS = 72
DDL = "document string, page_num long, image binary, width_pts double, height_pts double, width_px int, height_px int, rotation int, error string"
_KINDS = [pa.string(), pa.int64(), pa.binary(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
SCHEMA = pa.schema([(part.split()[0], kind) for part, kind in zip(DDL.split(", "), _KINDS, strict=True)])
#: Names of a file's properties, ours and the library's.
PROPERTIES = {"title": "title", "author": "author", "creator": "creator", "producer": "producer", "creation_date": "creationDate", "modification_date": "modDate"}


def library() -> Any:
    try:
        import fitz
    except ImportError as e:
        raise ImportError("PDF pages need PyMuPDF, which is optional and not installed") from e
    return fitz


def opened(path: str) -> Any:
    if not os.path.exists(path):
        raise FileNotFoundError(f"no PDF: {path}")
    return library().open(path)


def info(path: str) -> dict[str, Any]:
    """Number of pages and the file's properties; absent ones are blank."""
    with opened(path) as doc:
        told = doc.metadata or {}
        return {"page_count": len(doc), **{k: told.get(v) or "" for k, v in PROPERTIES.items()}}


def in_bounds(start: int, end: int | None, pages: int) -> range:
    """Page numbers counted from 0, from ``start`` to before ``end``, clamped."""
    return range(max(0, start), pages if end is None else min(end, pages))


def page_size(page: Any, dpi: int = 300) -> dict[str, Any]:
    width, height = page.rect.width, page.rect.height
    return {"width_pts": width, "height_pts": height, "width_px": int(width * dpi / POINTS), "height_px": int(height * dpi / POINTS), "rotation": page.rotation}


def drawn(page: Any, dpi: int = 300) -> bytes:
    """The page as PNG."""
    fitz, zoom = library(), dpi / POINTS
    picture = page.get_pixmap(matrix=fitz.Matrix(zoom, zoom), alpha=False)
    return images.png(images.pixels(picture.samples, picture.height, picture.width))


def single_page(path: str, page_num: int, target: str) -> str:
    """One page, counted from 0, as a file of its own."""
    with opened(path) as doc:
        if not 0 <= page_num < len(doc):
            raise IndexError(f"page {page_num} of {len(doc)}")
        os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
        with library().open() as one:
            one.insert_pdf(doc, from_page=page_num, to_page=page_num)
            one.save(target, garbage=4, deflate=True)
    return target


def page_images(spark: SparkSession, path: str, pages: Iterable[int], dpi: int = 300, tasks: int | None = None, enhance: bool = True) -> DataFrame:
    """(document, page_num from 1, image, sizes, error) of the pages, counted from 0; images are deskewed, normalised and enhanced."""
    ship(spark)
    wanted = sorted(set(pages))
    spark.sparkContext.addFile(path)
    name = os.path.basename(path)
    document = os.path.splitext(name)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with opened(SparkFiles.get(name)) as doc:
            for batch in batches:
                for n in batch["page"].to_pylist():
                    row: dict[str, Any] = dict.fromkeys(SCHEMA.names) | {"document": document, "page_num": n + 1}
                    try:
                        page = doc.load_page(n)
                        row |= page_size(page, dpi)
                        picture = drawn(page, dpi)
                        row["image"] = images.enhanced(picture) if enhance else picture
                    except Exception as e:  # a damaged page is a row, not the end of the document
                        row["error"] = f"{type(e).__name__}: {e}"
                    yield pa.RecordBatch.from_pylist([row], SCHEMA)

    rows = spark.createDataFrame([(n,) for n in wanted], "page long").repartition(tasks or max(1, min(len(wanted), 64)), "page")
    return rows.mapInArrow(run, DDL)
