"""Trees of page files: round trip, names, overwriting, appending, aborted jobs."""

import os
import tempfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from webloom.sources import io as IO
from webloom.sources import pagefiles as PF


@pytest.fixture
def tree():
    return os.path.join(tempfile.mkdtemp(prefix="webloom-files-"), "tree")


def listing(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(path) for f in fs if not f.endswith(".crc"))


def frame(spark, rows):
    return spark.createDataFrame(rows, "host string, file_name string, content string")


def test_round_trip_and_names(spark, tree):
    rows = [("a.com", "index.html", "<p>é 𝄞</p>\r\n"), ("a.com", "x.html", ""), ("b.com:8080", "page.md", "x" * 100000),
            ("a.com", "n.html", None), ("..", "..", "stays inside"), ("c.com", "z" * 300 + ".html", "long"), ("c.com", "z" * 300 + "y.html", "longer"),
            ("d.com", "a/b", "slash")]
    PF.write_page_files(frame(spark, rows).repartition(5), tree)
    got = {(r.host, r.file_name): r.content for r in PF.read_page_files(spark, tree, 2).collect()}
    want = {(PF.safe_name(h), PF.safe_name(n)): c or "" for h, n, c in rows}
    assert got == want and len(want) == len(rows)
    assert all(len(n.encode()) <= 255 for _, n in got) and ("%2E%2E", "%2E%2E") in got
    assert listing(os.path.dirname(tree)) == sorted(f"tree/{h}/{n}" for h, n in got)
    raw = {tuple(r.path.rsplit("/", 2)[1:]): r.html for r in IO.read_capture_files(spark, tree).collect()}
    # Spark's file scans skip empty files
    assert raw["a.com", "index.html"] == rows[0][2] and len(raw) == sum(bool(c) for _, _, c in rows)


def test_overwrite_append_and_empty(spark, tree):
    PF.write_page_files(frame(spark, [("a.com", "1", "old"), ("b.com", "1", "b")]), tree)
    PF.write_page_files(frame(spark, [("a.com", "2", "more"), ("c.com", "1", "c"), ("a.com", "1", "new")]), tree, mode="append")
    assert {(r.host, r.file_name): r.content for r in PF.read_page_files(spark, tree).collect()} == {
        ("a.com", "1"): "new", ("a.com", "2"): "more", ("b.com", "1"): "b", ("c.com", "1"): "c"}
    PF.write_page_files(frame(spark, [("z.com", "1", "only")]), tree)
    assert listing(os.path.dirname(tree)) == ["tree/z.com/1"]
    PF.write_page_files(frame(spark, []), tree)
    assert PF.read_page_files(spark, tree).count() == 0 and os.listdir(os.path.dirname(tree)) == ["tree"]


def test_failed_job_leaves_what_was_there(spark, tree):
    PF.write_page_files(frame(spark, [("a.com", "1", "old")]), tree)
    rows = spark.range(0, 400, 1, 4).select(
        F.lit("a.com").alias("host"), F.col("id").cast("string").alias("file_name"),
        F.when(F.col("id") == 399, F.raise_error(F.lit("lost"))).otherwise("x").alias("content"))
    for mode in ("overwrite", "append"):
        with pytest.raises(Exception, match="lost"):
            PF.write_page_files(rows, tree, mode=mode)
        assert listing(os.path.dirname(tree)) == ["tree/a.com/1"]
    with pytest.raises(Exception, match="needs a host"):
        PF.write_page_files(frame(spark, [(None, "x", "y")]), tree)
    assert listing(os.path.dirname(tree)) == ["tree/a.com/1"]


def test_lost_attempt_leaves_nothing_behind(tree):
    batch = pa.record_batch([pa.array(["a.com"] * 3), pa.array(["1", "2", "3"]), pa.array(["x", "y", "z"])],
                            names=["host", "file_name", "content"])

    def lost():
        yield batch.slice(0, 1)
        raise OSError("executor lost")

    job = PF.PageFilesWriter(tree, ["host", "file_name", "content"], False)
    with pytest.raises(OSError):
        job.write(lost())
    assert not os.path.exists(tree)
    written = job.write(iter([batch]))
    job.commit([written])
    assert written.files == 3 and listing(os.path.dirname(tree)) == ["tree/a.com/1", "tree/a.com/2", "tree/a.com/3"]


def test_store_that_python_cant_open():
    with pytest.raises(ValueError, match="dbfs"):
        PF.open_store("dbfs:/x/y")
    assert PF.open_store("file:/tmp/x")[1] == PF.open_store("file:///tmp/x")[1] == PF.open_store("/tmp/x")[1] == "/tmp/x"
