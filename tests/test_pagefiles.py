"""Page files: where they lie, which are opened, what a failed job leaves."""

import os

import pytest
from pyspark.sql import functions as F

from ravelin.sources import pagefiles

ROWS = [("A", 1, "one"), ("A", 2, "zwei é"), ("A", 1203, ""), ("B", 1, "b")]


def files_below(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names)


def test_files_have_their_names_and_come_back(spark, tmp_path):
    root = str(tmp_path / "out")
    df = spark.createDataFrame(ROWS, "document string, page_num long, content string")
    pagefiles.write_files(df.repartition(3), root)
    assert files_below(root) == ["A/pages/Page_001/A_page_0001.json", "A/pages/Page_002/A_page_0002.json", "A/pages/Page_1203/A_page_1203.json", "B/pages/Page_001/B_page_0001.json"]
    assert not [d for d in os.listdir(root) if d.startswith("_job")]
    pagefiles.write_files(df.where("document = 'B'").withColumn("content", F.lit("new")), root)
    got = {(r.document, r.page_num): (r.content, r.error) for r in pagefiles.read_files(spark, root).collect()}
    assert got == {("A", 1): ("one", None), ("A", 2): ("zwei é", None), ("A", 1203): ("", None), ("B", 1): ("new", None)}
    pagefiles.write_files(df.where("page_num = 2").withColumn("reading", F.lit("raw")), root)
    assert [(r.document, r.page_num, r.reading, r.content) for r in pagefiles.read_files(spark, root, "text").collect()] == [("A", 2, "raw", "zwei é")]
    assert pagefiles.read_files(spark, str(tmp_path / "none")).collect() == []


def test_page_ranges_open_only_their_files(spark, tmp_path):
    root = str(tmp_path / "out")
    pagefiles.write_files(spark.createDataFrame([("A", n, f"page {n}") for n in range(1, 9)], "document string, page_num long, content string"), root)
    for n in (1, 5, 8):  # what is opened there is an error
        path = f"{root}/{pagefiles.page_name('A', n)}"
        os.remove(path)
        with open(path, "wb") as f:
            f.write(b"\xff broken")
    read = pagefiles.read_files(spark, root, pages="2-4,6-7", group=2)
    assert read.rdd.getNumPartitions() == 3
    assert [(r.page_num, r.error) for r in read.orderBy("page_num").collect()] == [(n, None) for n in (2, 3, 4, 6, 7)]
    broken = pagefiles.read_files(spark, root, pages="5").first()
    assert broken.content is None and broken.error.startswith("UnicodeDecodeError")
    spark.conf.set(pagefiles.PUSHDOWN, "true")
    try:
        rows = pagefiles.read_files(spark, root, group=1).where("page_num >= 2 AND page_num < 5 AND document = 'A' AND length(content) > 0")
        assert rows.rdd.getNumPartitions() == 3 and rows.count() == 3
    finally:
        spark.conf.unset(pagefiles.PUSHDOWN)


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    root = str(tmp_path / "out")
    good = spark.createDataFrame(ROWS, "document string, page_num long, content string")
    bad = F.when(F.col("page_num") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("content"))
    with pytest.raises(Exception, match="lost"):
        pagefiles.write_files(good.repartition(4).withColumn("content", bad), root)
    assert files_below(root) == []


def test_a_task_that_ran_twice_wrote_once(tmp_path):
    root = str(tmp_path / "out")
    writer = pagefiles.PageWriter({"path": root})
    row = {"document": "A", "page_num": 1, "reading": None, "content": "x"}
    writer.write(iter([{**row, "content": "first try"}]))  # its message is lost with its executor
    writer.commit([writer.write(iter([row])), None])
    assert files_below(root) == ["A/pages/Page_001/A_page_0001.json"] and open(f"{root}/A/pages/Page_001/A_page_0001.json").read() == "x"
