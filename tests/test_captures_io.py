"""Capture selection, lookups, sources and sinks."""

import os
import random
import tempfile

from pyspark.sql import functions as F

from webloom.operators import captures as C
from webloom.operators.captures import follow_redirects, redirect_closure
from webloom.sources import io as IO


def test_first_successful_attempt(spark):
    ok = "<html>" + "x" * 300 + "</html>"
    a = spark.createDataFrame([("u", 0, 200, 0, "<p>tiny</p>"), ("u", 1, 503, 0, ok), ("u", 2, 200, 6, ok),
                               ("u", 3, 200, 1, ok), ("v", 0, 404, 0, ok)],
                              "url string, ord int, status int, redirects int, html string")
    got = {r.url: r.ord for r in C.first_successful_attempt(a).collect()}
    assert got == {"u": 3}


def test_latest_capture_and_redirects(spark):
    w = spark.createDataFrame([("u", 0, "a"), ("u", 2, "c"), ("u", 1, "b")], "url string, ord int, html string")
    assert C.latest_captures(w, carry=("html",)).first().html == "c"
    m = spark.createDataFrame([("u", 0, "u#x"), ("v", 0, "v")], "url string, ord int, final_url string")
    urls = spark.createDataFrame([("u",), ("w",)], "url string")
    got = {r.url: r.resolved for r in C.resolve_redirects(urls, C.redirect_map(m)).collect()}
    assert got == {"u": "u#x", "w": "w"}


def test_challenge_flag(spark):
    df = spark.createDataFrame([("https://x.pages.dev/", "<p>hi</p>"), ("https://a.com", "<p>" + "a" * 20000 + "cf-ray</p>"),
                                ("https://a.com", "<!-- CF-Ray -->")], "url string, html string")
    assert [r.challenge for r in C.flag_challenge_pages(df, scan_chars=C.CHALLENGE_SCAN_CHARS).collect()] == [True, False, True]
    assert [r.challenge for r in C.flag_challenge_pages(df).collect()] == [True, True, True]


def test_seed_csv_and_normalisation(spark):
    d = tempfile.mkdtemp(prefix="webloom-seeds-")
    p = os.path.join(d, "input.csv")
    with open(p, "w") as f:
        f.write("website\nhttps://a.com/\na.com/x/\nhttps://a.com/\n")
    got = [r.url for r in IO.read_seeds(spark, p).orderBy("seed").collect()]
    assert got == ["https://a.com/", "https://a.com/x", "https://a.com/"]


def test_markdown_and_html_sinks_round_trip(spark):
    d = tempfile.mkdtemp(prefix="webloom-sink-")
    pages = spark.createDataFrame([(1, "https://a.com/x/", "<p>1</p>"), (2, "https://a.com/x", "<p>2</p>"),
                                   (3, "https://a.com/about/team", "<p>3</p>")], "page_id long, url string, html string")
    manifest = IO.write_html_tree(pages, os.path.join(d, "html"))
    back = spark.read.parquet(os.path.join(d, "html"))
    assert sorted((r.host, r.file_name, r.content) for r in back.collect()) == [
        ("a.com", "aboutus.html", "<p>3</p>"), ("a.com", "x.html", "<p>2</p>")]
    assert sorted(r.page_id for r in manifest.filter(~F.col("winner")).collect()) == [1]
    links = spark.createDataFrame([("https://a.com/x", "https://b.org/")], "src string, dst string")
    IO.write_external_links(links, os.path.join(d, "ext"))
    csv = spark.read.option("header", True).csv(os.path.join(d, "ext"))
    assert csv.columns[:2] == ["Source URL", "External URL"]


def test_decode_and_read_capture_files(spark):
    d = tempfile.mkdtemp(prefix="webloom-files-")
    with open(os.path.join(d, "abc.html"), "wb") as f:
        f.write("<p>café</p>".encode() + b"\xff")
    got = IO.read_capture_files(spark, d).first()
    assert got.key == "abc" and got.html == "<p>café</p>�"


def test_read_markdown_files(spark):
    d = tempfile.mkdtemp(prefix="webloom-md-")
    with open(os.path.join(d, "index.md"), "w") as f:
        f.write("URL: https://a.com/\n\n---\n\nsome text here\n")
    r = IO.read_markdown(spark, d).first()
    assert r.markdown.startswith("URL: https://a.com/")


def test_decode_matches_python_replacement_per_bad_run(spark):
    cases = [b"a\xffb", b"\xe2\x82", b"\xe2\x82a", b"\xed\xa0\x80x", b"\xf0\x9f\x98", b"\xc0\xafz",
             b"\xf4\x90\x80\x80", b"\x80\x80\x80", b"ok\xe2\x82\xacok", b"\xf8\x88\x80\x80\x80", b"\xe0\x80\xaf", b"\xc3"]
    df = spark.createDataFrame([(bytearray(c),) for c in cases], "b binary")
    got = [r[0] for r in df.select(IO.decode_content(F.col("b"))).collect()]
    assert got == [c.decode("utf-8", errors="replace") for c in cases]


def test_scratch_tables_are_dropped(spark, monkeypatch):
    from webloom import session
    monkeypatch.setattr(session, "_SCRATCH", [])
    kept = spark.range(3)
    path = session.scratch_dir(spark, "t-drop")
    kept.write.parquet(path)
    session.scratch_dir(spark, "t-never-written")
    assert spark.read.parquet(path).count() == 3
    assert session.drop_scratch(spark) == 1 and session.drop_scratch(spark) == 0
    assert kept.count() == 3


def test_redirect_closure_against_walks(spark):
    rng = random.Random(2)
    nodes = [f"u{i}" for i in range(120)]
    hop = {u: rng.choice(nodes) for u in nodes if rng.random() < .9}
    hop |= {f"c{i}": f"c{i + 1}" for i in range(37)} | {"l0": "l1", "l1": "l2", "l2": "l0", "into": "l0", "self": "self", "s": "self"}
    hop |= {f"hot{i}": "c30" for i in range(50)}
    rows = [*hop.items(), (None, "x"), ("y", None), ("c0", "a")]          # of two targets the largest
    got = {r.from_url: (r.to_url, r.hops, r.state) for r in redirect_closure(
        spark.createDataFrame(rows, "from_url string, to_url string"), 5).collect()}

    def walk(u):
        at, n = u, 0
        while at in hop and hop[at] != at and n < 500:
            at, n = hop[at], n + 1
        return (None, None, "loop") if n == 500 else (at, n, "too_many" if n >= 5 else "ok")

    assert got == {u: walk(u) for u in hop if hop[u] != u}
    assert {s for _, _, s in got.values()} == {"ok", "too_many", "loop"} and max(n or 0 for _, n, _ in got.values()) == 37
    closure = spark.createDataFrame([(u, *x) for u, x in got.items()], "from_url string, to_url string, hops long, state string")
    urls = spark.createDataFrame([("l0",), ("c0",), ("c36",), ("plain",), (None,)], "url string")
    assert {r.url: (r.resolved, r.hops, r.state) for r in follow_redirects(urls, closure).collect()} == {
        "l0": (None, None, "loop"), "c0": (None, 37, "too_many"), "c36": ("c37", 1, "ok"), "plain": ("plain", 0, "ok"),
        None: (None, 0, "ok")}
    assert redirect_closure(spark.createDataFrame([], "from_url string, to_url string")).count() == 0
