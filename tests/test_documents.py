"""Steps of pages and of whole documents, against hand-made cases and rules stated anew."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ravelin import ocr
from ravelin.functions import stations
from ravelin.operators import blocks as ops
from ravelin.operators import building, export, folds, postprocess
from ravelin.operators.building import block
from ravelin.sources import files, images


def comm(text, ts=None, speaker=None, location=None, **more):
    return block("comm", text, timestamp=ts, speaker=speaker, location=location, **more)


def kept(blocks):
    return [tuple(b[k] for k in ("type", "timestamp", "speaker", "location", "text")) for b in blocks]


def test_times_in_texts_are_split():
    got = kept(building.split_times([comm("Go on 01 02 03 O4 CDR (EAGLE) here: 0I:02:03:20 and so", "01 02 03 00", "CC"), comm("TIG 123 04 05 06 07 it is", None, "CC"), block("annotation", "none")]))
    assert got == [("comm", "01 02 03 00", "CC", None, "Go on"), ("comm", "01 02 03 04", "CDR", "EAGLE", "here:"), ("comm", "01 02 03 20", "and", None, "so"), ("comm", None, "CC", None, "TIG 123 04 05 06 07 it is"), ("annotation", None, None, None, "none")]
    assert building.embedded_time("(0I:O2 ..lS 4B)") == "01 02 15 48" and building.embedded_time("1 2 3") is None
    assert kept(building.split_times([comm("01 02 03 04", "x"), comm(None, "y")])) == [("comm", "01 02 03 04", None, None, None), ("comm", "y", None, None, None)]
    assert kept([building.said_at("t", "NOUN 44 reads")]) == [("comm", "t", "NOUN", None, "44 reads")]


def test_blocks_of_rows():
    rows = lambda *xs: [{"type": t, "timestamp": "01 02 03 61" if t == "comm" else "", "speaker": "", "location": "", "text": x, "hint": None} for t, x in xs]
    got = building.blocks_of(rows(("header", "Page 1"), ("text", "so far"), ("comm", "Tape 12"), ("comm", "Go"), ("text", "on"), ("meta", "LOSS OF"), ("meta", "SIGNAL"), ("meta", "END OF TAPE"), ("annotation", "(GOSS NET 1)"), ("footer", "*** Three"), ("footer", "x")), {}, 3)
    assert kept(got) == [("continuation", None, None, None, "so far"), ("comm", "01 02 04 01", None, None, "Go on"), ("meta", None, None, None, "LOSS OF SIGNAL"), ("meta", None, None, None, "END OF TAPE"), ("footer", None, None, None, building.FOOTER), ("footer", None, None, None, "x")]
    assert got[3]["meta_type"] == "end_of_tape" and got[2]["meta_type"] is None
    assert [b["text"] for b in building.blocks_of(rows(("footer", "*** garbled")), {3: "told"}, 3)] == ["told"]


def test_titles_and_rest_periods():
    title, rest = block("annotation", "AIR TO GROUND VOICE TRANSCRIPTION"), comm("REST PERIOD Page 270", "t", "CC")
    assert [(b["type"], b["meta_type"], b["text"]) for b in building.canonical([title])[0]] == [("meta", "transcript_header", building.TITLE)]
    blocks, found = building.canonical([title, rest])
    assert found and [(b["type"], b["meta_type"], b["speaker"]) for b in blocks] == [("meta", "rest_period", None)]
    assert building.tidied("'' go (TRANQ) on. Tape 12/3 Page 4", ["TRANQ"]) == "go  on" or building.tidied("go (TRANQ) on", ["TRANQ"]) == "go  on"
    assert kept(building.lunar([comm("-- End Lunar Rev 4", "01 02 03 04", "CC")])) == [("meta", "01 02 03 --", None, None, "END LUNAR REV 4")]


def test_column_lines_fill_in_order():
    blocks = [comm("Go.", "a", "CC"), comm(None, "b", "CDR"), comm("x", "c"), comm(None, "d"), comm(None, None, timestamp_correction="inferred_missing")]
    assert kept(building.filled(blocks, "CDR\n(EAGLE)\n\nWe are here.\nand on it.")) == [("comm", "a", "CC", None, "Go."), ("comm", "b", "CDR", None, "We are here."), ("comm", "c", None, None, "x and on it.")]
    assert len(building.filled(blocks, "")) == 5


def test_stages_of_correction():
    c = postprocess.Correction(keywords=["HAWAII"], manual={"m": "PAO"})
    named = postprocess.named(c)([comm("over here", "a", "CC Apollo"), comm("CDR: go", "b", "CDR"), comm("yes", "m", "CC"), comm("LMP go", "c", "12"), block("meta", "x")])
    assert kept(named)[:4] == [("comm", "a", "CC", None, "Apollo over here"), ("comm", "b", "CDR", None, "go"), ("comm", "m", "PAO", None, "yes"), ("comm", "c", "LMP", None, "go")]
    marked = postprocess.stationed(["HAWAII"])([comm("HAWAII (RFV 4)", None, "CC"), comm("HAWAII (REV 5) go", "t", "CC"), comm("", "u"), comm("ELSE (REV 1)", "v")])
    assert kept(marked) == [("annotation", None, None, None, "HAWAII (REV 4)"), ("comm", "t", "CC", None, "go"), ("annotation", None, None, None, "HAWAII (REV 5)"), ("comm", "v", None, None, "ELSE (REV 1)")]


def page_of(spark, blocks):
    from ravelin.operators.postprocess import COLUMNS, DDL

    return spark.createDataFrame([(1, 1, i, *(b[c] for c in COLUMNS)) for i, b in enumerate(blocks)], f"document long, page_num long, block_idx long, {DDL}")


def test_kinds_noise_and_voices(spark):
    rows = lambda df: df.orderBy("block_idx").collect()
    told = rows(ops.reclassified(page_of(spark, [comm("-- BEGIN LUNAR REV 3", "t", "CC"), comm("(Unidentifiable)", "u", "CC"), comm("BEGIN LUNAR REV", "v"), comm("x", "w", "CC")])))
    assert [(b["type"], b["speaker"]) for b in told] == [("meta", None), ("annotation", None), ("comm", "SC"), ("comm", "CC")]
    noisy = [comm("-?", "a", "SC"), comm("12", "b", "CC"), comm("GOSS NET 1", "c", "CC"), comm("(60:33 NOT 1)", "d", "CC"), comm("1.", "e", "CC"), comm("No.", "f", "SC"), block("annotation", "..")]
    assert kept(rows(ops.quiet(page_of(spark, noisy)))) == [("comm", "f", "SC", None, "No."), ("annotation", None, None, None, "..")]
    said = [comm("Go on", "a", "CC"), comm("With it.", "b", "CC", timestamp_correction="k"), comm("and more.", "c", "CC"), comm("New.", "d", "CC"), comm("so", "e", "CC", continuation_from_prev=True), block("annotation", "x"), comm("on", "f", "CC"), comm("and", "g", "CDR")]
    voices = rows(ops.one_voice(page_of(spark, said)))
    assert [(b["text"], b["timestamp"], b["timestamp_correction"]) for b in voices] == [("Go on With it. and more.", "a", "k"), ("New.", "d", None), ("so", "e", None), ("x", None, None), ("on", "f", None), ("and", "g", None)]


def export_rows(spark, rows):
    return spark.createDataFrame([(1, p, i, *r) for i, (p, *r) in enumerate(rows)], "document long, page_num long, block_idx long, type string, timestamp string, speaker string, location string, text string")


def test_export(spark):
    rows = [
        (0, "comm", "00 00 00 01", "CC", None, "left out"),
        (1, "comm", "01 00 00 10", "CDR", None, "Go now ** End of tape **"),
        (1, "comm", "01 00 00 12", None, None, "and on"),
        (1, "annotation", None, None, None, "A (Mark)."),
        (1, "annotation", None, None, None, "a  mark"),
        (1, "footer", None, None, None, "Page 12"),
        (1, "footer", None, None, None, "Said 12/34 here"),
        (2, "comm", "01 00 00 20", None, None, "...still going"),
        (2, "comm", "01 00 00 10", None, None, "Roger. That"),
        (2, "comm", "01 00 00 30", None, None, "12 more"),
        (2, "comm", None, None, None, "(Laughter)"),
        (2, "comm", "01 00 00 40", "CC", None, "HAWAII (REV 4)"),
        (2, "comm", "00 00 00 50", None, None, "CMP: Yes -- BEGIN LUNAR REV 3 now"),
        (2, "comm", "01 00 01 00", "CMP", None, "-- END LUNAR REV 3"),
        (2, "comm", "x", "LMP", "EAGLE", "one"),
        (2, "comm", "x", "LMP", None, "two"),
        (2, "continuation", None, None, None, " the rest "),
        (3, "comm", "01 00 00 59", "CC", None, "Go ahead"),
    ]
    got = export.exported(export_rows(spark, rows), {"the": "teh"}, ["CMP", "CC"], ["HAWAII"]).orderBy("page_num", "block_idx").collect()
    assert [(r.page_num, r.block_idx, r.type, r.timestamp, r.speaker, r.location, r.text) for r in got] == [
        (1, 0, "comm", "01 00 00 10", "CDR", None, "Go now and on ...still going"),
        (1, 1, "annotation", None, None, None, "A (Mark)."),
        (1, 2, "footer", None, None, None, "Said  here"),
        (2, 0, "comm", "01 00 00 11", "CC", None, "Roger. That 12 more"),
        (2, 1, "comm", None, "CDR", None, "(Laughter)"),
        (2, 2, "annotation", None, None, None, "HAWAII (REV 4)"),
        (2, 3, "meta", None, None, None, "BEGIN LUNAR REV 3 now"),
        (2, 4, "comm", "01 00 00 50", "CMP", None, "Yes"),
        (2, 5, "meta", None, None, None, "END LUNAR REV 3"),
        (2, 6, "comm", "x", "LMP", "EAGLE", "one two"),
        (2, 7, "continuation", None, None, None, "teh rest"),
        (3, 0, "comm", "01 00 00 59", "CC", None, "Go ahead"),
    ]
    assert [r.meta_type for r in got if r.type == "meta"] == ["lunar_rev", "lunar_rev"]
    assert export.exported(export_rows(spark, rows).limit(0)).collect() == []


def export_brute(rows):
    """The first scan over a list at once: each block in the light of all before it."""
    out, before, crew = [], None, None
    for row in rows:
        page, _, ts, speaker, _, text = row
        here = [r for r in out if r[0] == page]
        nameless = not speaker
        if nameless and (text[0].islower() or text.startswith("...")) and (here or before):
            target = here[-1] if here else before
            target[2] += " " + text
            continue
        if nameless:
            last = before[1] if before else None
            if text.startswith("Roger"):
                speaker = "CC" if last in export.CREW else crew if last == "CC" and crew else None
            elif text.startswith("Go ahead"):
                speaker = "CC"
            elif last == "CC" and text.startswith("(") and crew:
                speaker = crew
            if last == "CC" and text[0].isdigit():
                before[2] += " " + text
                continue
        out.append([page, speaker, text])
        if speaker:
            before, crew = out[-1], speaker if speaker in export.CREW else crew
    return [tuple(r) for r in out]


def test_export_against_lists(spark):
    rng = random.Random(7)
    for _ in range(6):
        rows = [(1 + i // rng.randint(3, 6), "comm", None, rng.choice([None, None, "CC", "CDR", "LMP"]), None, rng.choice(["Roger that", "and so", "...on", "12 of it", "(aside)", "Go ahead", "Plain text"])) for i in range(60)]
        rows.sort(key=lambda r: r[0])
        got = export.exported(export_rows(spark, rows)).orderBy("page_num", "block_idx").collect()
        assert [(r.page_num, r.speaker, r.text) for r in got] == export_brute(rows)


def test_tape_rule_against_the_table():
    for x in (1, 6, 9, 10, 66, 67):
        for y in (0, 1, 4):
            for after in (False, True):
                for ox in range(0, 80):
                    for oy in (1, 2, 5):
                        ex, ey = (x + 1, 1) if after else (x, y + 1)
                        if (ox, oy) == (ex, ey):
                            good = True
                        elif after:
                            good = oy == 1 and abs(ox - ex) <= 1
                        elif oy == ey and abs(ox - ex) <= 1:
                            good = True
                        elif oy == ey and (str(ox) in str(ex) or (len(str(ox)) == len(str(ex)) and sum(a != b for a, b in zip(str(ox), str(ex), strict=True)) == 1)):
                            good = False
                        else:
                            good = oy == 1 and ey == 1 and ex - 1 <= ox <= ex + 2
                        assert folds.tape_step(x, y, after, f"{ox}/{oy}") == ((ox, oy, False) if good else (ex, ey, True))


def test_page_ranges(spark):
    spec = lambda *rows: spark.createDataFrame(list(rows), "spec string, max_pages bigint")
    got = ops.page_ranges(spec(("", 3), (" 2 - 3, 1,", 9), ("7-9", 8))).collect()
    assert sorted((r.spec, r.page) for r in got) == sorted([("", 0), ("", 1), ("", 2), (" 2 - 3, 1,", 0), (" 2 - 3, 1,", 1), (" 2 - 3, 1,", 2), ("7-9", 6), ("7-9", 7)])
    assert ops.pages_of("1-3,5,4-99", 6) == [0, 1, 2, 3, 4, 5] and ops.pages_of(None, 2) == [0, 1]
    for bad in ("0-3", "x", "2-y", "-3"):
        with pytest.raises(ValueError):
            ops.pages_of(bad, 9)
        with pytest.raises(Exception):
            ops.page_ranges(spec((bad, 9))).collect()


def test_page_flags_and_folders(spark):
    assert stations.READ.pattern and building.is_column_line("We are.") and not building.is_column_line("CDR")
    df = spark.createDataFrame([("d", 7), ("d", 1234)], "document string, page_num long")
    got = files.page_paths(df).orderBy("page_num").collect()
    assert [(r.page_dir, r.page_json) for r in got] == [("d/pages/Page_007", "d/pages/Page_007/d_page_0007.json"), ("d/pages/Page_1234", "d/pages/Page_1234/d_page_1234.json")]
    paths = spark.createDataFrame([("a/Page_10",), ("a/Page_9/",), ("a/x",)], "path string")
    assert [(r.path, r.n) for r in files.numbered_folders(paths).collect()] == [("a/x", 0), ("a/Page_9/", 9), ("a/Page_10", 10)]


def drawing(height=400, width=500, lines=8, slope=0.0):
    page = np.full((height, width), 255, np.uint8)
    for k in range(lines):
        for x in range(60, width - 60):
            y = int(60 + k * (height - 140) / lines + (x - width / 2) * slope)
            if x % 12 < 9:
                page[y : y + 8, x] = 20
    return page


def test_png_round_trip():
    gray = np.arange(35 * 21, dtype=np.uint8).reshape(35, 21)
    assert (images.from_png(images.png(gray)) == gray).all()
    for bad in (b"no", images.png(gray)[:8]):
        with pytest.raises(ValueError):
            images.from_png(bad)


def test_images_are_put_right():
    page = images.Page(width=600, height=700, margin=20)
    slanted = drawing(slope=np.tan(np.radians(3)))
    assert images.skew(slanted) == pytest.approx(-3, abs=0.4) and abs(images.skew(drawing())) < 0.2
    level, angle = images.straightened(slanted)
    assert abs(angle) > 2 and abs(images.skew(level)) < 0.5
    centred = images.centred(drawing(), page)
    ys, xs = np.where(centred <= images.PAPER)
    assert centred.shape == (700, 600) and abs((xs.min() + xs.max()) / 2 - 300) < 8 and abs((ys.min() + ys.max()) / 2 - 350) < 8 and xs.min() >= 20
    assert images.centred(np.full((30, 40), 255, np.uint8), page).shape == (700, 600)
    assert (images.weights(10, 4).sum(1) == pytest.approx(1)) and (images.resized(np.full((9, 9), 77, np.uint8), 4, 20) == 77).all()


def test_spots_go_and_lines_stay():
    page = np.full((60, 80), 255, np.uint8)
    page[10:13, 10:13] = 0  # nine pixels
    page[20:26, 20:26] = 0  # 36, square
    page[40:44, 5:70] = 0  # a line
    page[30, 30] = page[31, 31] = 0  # joined at a corner
    got = images.without_spots(page)
    assert (got[40:44, 5:70] == 0).all() and (got[:35] == 255).all()
    assert len(set(images.components(page <= 200)[0])) == 4
    assert images.without_spots(np.full((5, 5), 255, np.uint8)).min() == 255


def test_contrast():
    faint = (drawing() // 4 + 150).astype(np.uint8)
    strong = images.contrasted(faint)
    assert strong.shape == faint.shape and np.ptp(strong.astype(int)) > np.ptp(faint.astype(int))
    assert images.stretched(np.full((4, 4), 9, np.uint8)).tolist() == [[9] * 4] * 4
    assert images.median3(np.pad(np.zeros((1, 1), np.uint8), 3, constant_values=200))[3, 3] == 200
    assert images.right_column(np.zeros((4, 100), np.uint8), 0.3).shape == (4, 65) and images.right_column(np.zeros((4, 3), np.uint8), 0.9).shape == (4, 1)
    assert images.cleaned(drawing()).max() == 255 and images.for_reading(images.png(faint), "raw") == images.png(faint)


def test_readings_of_images(spark):
    png = images.png(drawing(80, 100, 2))
    df = spark.createDataFrame([("A", 1, png), ("A", 2, png), ("A", 3, b"broken")], "document string, page_num int, image binary")
    backend = ocr.StoredOcr({("A", 1, "raw"): "one", ("A", 1, "textcol"): "col", ("A", 3, "raw"): "three"})
    got = {(r.page_num, r["pass"]): (r.text, r.error) for r in ocr.read_images(df, backend, {"raw": "p", "textcol": "q"}).collect()}
    assert got[1, "raw"] == ("one", None) and got[1, "textcol"] == ("col", None) and got[3, "raw"] == ("three", None)
    assert got[2, "raw"][1].startswith("OcrResponseError") and got[3, "textcol"][1].startswith("ValueError")


def test_server_is_asked_once_per_page(spark):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    asked = []

    class Answer(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append((self.path, body["model"], body["temperature"], body["messages"][0]["content"][0]["text"]))
            out = json.dumps({"choices": [{"message": {"content": " read \n"}}]} if len(asked) < 3 else {"choices": []}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(out)

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    backend = ocr.HttpOcr(f"http://127.0.0.1:{server.server_port}/", "m", 5)
    png = images.png(drawing(40, 50, 1))
    assert backend.read(png, "p", "A", 1, "raw") == "read" == backend.read(png, "q", "A", 1, "raw")
    with pytest.raises(ocr.OcrResponseError):
        backend.read(png, "p", "A", 1, "raw")
    server.shutdown()
    server.server_close()
    with pytest.raises(ocr.OcrConnectionError):
        backend.read(png, "p", "A", 1, "raw")
    assert asked[0] == ("/v1/chat/completions", "m", 0.0, "p") and ocr.HttpOcr("http://x/v1").endpoint == "http://x/v1/chat/completions"


def test_pdf_pages(spark, tmp_path, capsys):
    """With a stand-in for the drawing library, which is not installed."""
    import sys

    from ravelin import engine
    from ravelin.sources import pdf

    path = tmp_path / "A.pdf"
    path.write_bytes(b"3 pages")
    with pytest.raises(ImportError):
        pdf.info(str(path))
    stand_in = tmp_path / "lib" / "fitz.py"
    stand_in.parent.mkdir()
    stand_in.write_text('''
from types import SimpleNamespace as N
class Matrix:
    def __init__(self, x, y): self.zoom = x
class Page:
    rotation, rect = 90, N(width=36.0, height=72.0)
    def get_pixmap(self, matrix, alpha):
        h, w = int(72 * matrix.zoom), int(36 * matrix.zoom)
        return N(samples=bytes([200, 100, 50]) * (h * w), height=h, width=w)
class open:
    metadata = {"title": "T", "creationDate": None}
    def __init__(self, path=None): self.n, self.saved = 3, []
    def __enter__(self): return self
    def __exit__(self, *a): return False
    def __len__(self): return self.n
    def load_page(self, n):
        if n == 1: raise ValueError("damaged")
        return Page()
    def insert_pdf(self, doc, from_page, to_page): self.saved.append((from_page, to_page))
    def save(self, target, garbage, deflate):
        with __import__("builtins").open(target, "w") as f: f.write(str(self.saved))
''')
    spark.sparkContext.addPyFile(str(stand_in))
    try:
        assert pdf.info(str(path)) == {"page_count": 3, "title": "T", "author": "", "creator": "", "producer": "", "creation_date": "", "modification_date": ""}
        rows = {r.page_num: r for r in pdf.page_images(spark, str(path), [0, 1, 2], 72, enhance=False).collect()}
        assert (rows[1].document, rows[1].width_px, rows[1].height_px, rows[1].rotation, rows[1].error) == ("A", 36, 72, 90, None)
        assert images.from_png(bytes(rows[3].image)).shape == (72, 36) and rows[2].error == "ValueError: damaged" and rows[2].image is None
        engine.main(["info", str(path)], spark)
        assert "page_count: 3" in capsys.readouterr().out
        assert open(pdf.single_page(str(path), 2, str(tmp_path / "x" / "p.pdf"))).read() == "[(2, 2)]"
        with pytest.raises(IndexError):
            pdf.single_page(str(path), 3, str(tmp_path / "p.pdf"))
        assert list(pdf.in_bounds(-4, 2, 9)) == [0, 1] and list(pdf.in_bounds(7, None, 9)) == [7, 8] and list(pdf.in_bounds(7, 99, 9)) == [7, 8]
        with pytest.raises(FileNotFoundError):
            pdf.info(str(tmp_path / "none.pdf"))
        engine.main(["process", str(path), str(tmp_path / "out"), "--pages", "1", "--no-ocr"], spark)
        assert spark.read.parquet(str(tmp_path / "out_images")).count() == 1
    finally:
        sys.modules.pop("fitz", None)


def test_registered_texts_are_read_whole(spark):
    """Words behind any prefix count: the last word of each text is in the frequencies."""
    from ravelin.plans import registry

    sf = "/root/testdata/sf0.001"
    words = {r.word for r in registry.QUERIES["word_frequency"](spark, sf).collect()}
    last = spark.read.parquet(f"{sf}/documents.parquet").where("text is not null").select(F.element_at(F.concat(F.array(F.lit("")), F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), F.lit(1))), -1).alias("w"))
    assert {r.w for r in last.collect()} - {""} <= words
