"""A run that is killed half-way, started again."""

import os
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from ravelin import engine, ocr
from ravelin.sources import images, pagefiles, resume


def reader(notes, dies=(), fails=()):
    """A backend that notes every page that it is asked for, and fails as told; its class goes to the workers by value."""
    folder = str(notes)

    class Marked(ocr.OcrBackend):
        def read(self, image, prompt, document, page_num, name):
            open(f"{folder}/{page_num}-{name}-{uuid.uuid4().hex}", "w").close()
            if page_num in dies:
                raise RuntimeError("killed")
            if page_num in fails:
                raise ocr.OcrResponseError("nothing")
            return f"01 02 0{page_num} 04 CDR This is page {page_num}."

    return Marked()


def asked(notes):
    found = sorted(int(f.split("-")[0]) for f in os.listdir(notes))
    for f in os.listdir(notes):
        os.remove(f"{notes}/{f}")
    return found


def test_a_killed_run_does_only_the_rest(spark, tmp_path):
    notes = tmp_path / "notes"
    notes.mkdir()
    target, e = str(tmp_path / "out"), engine.TranscriptEngine(spark, engine.Settings(readings=["raw"]))
    png = images.png(np.zeros((20, 30), np.uint8))
    pages = spark.createDataFrame([("A", n, png + bytes([n])) for n in range(1, 7)], "document string, page_num long, image binary")
    with pytest.raises(Exception, match="killed"):
        engine.read_all(e, pages, reader(notes, dies=[4]), target, step=1)
    first = set(asked(notes))
    done = sorted(r.page_num for r in resume.done_pages(spark, target + "_read").collect()) if os.path.exists(target + "_read") else []
    assert 4 in first and 4 not in done
    texts = engine.read_all(e, pages, reader(notes, fails=[6]), target, step=2)
    assert asked(notes) == [n for n in range(1, 7) if n not in done]
    assert sorted(r.page_num for r in texts.collect()) == [1, 2, 3, 4, 5]  # the sixth failed
    texts = engine.read_all(e, pages, reader(notes), target)
    assert asked(notes) == [6]
    whole = engine.read_all(e, pages, reader(notes), str(tmp_path / "whole"))
    assert sorted(map(tuple, texts.collect())) == sorted(map(tuple, whole.collect())) and len(asked(notes)) == 6
    names = lambda root: sorted((r.document, r.page_num, r.reading, r.content) for r in pagefiles.read_files(spark, root, "text").collect())
    assert names(target + "_ocr") == names(str(tmp_path / "whole_ocr"))
    other = pages.withColumn("image", F.when(F.col("page_num") == 2, F.lit(png)).otherwise(F.col("image")))
    engine.read_all(e, other, reader(notes), target)
    assert asked(notes) == [2]  # another image is another input
    assert engine.read_all(e, pages.limit(0), reader(notes), target).collect() == [] and asked(notes) == []
