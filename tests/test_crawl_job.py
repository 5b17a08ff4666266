"""End-to-end crawl job: seeds + captures -> visited pages and outputs."""

import tempfile

from pyspark.sql import functions as F

from webloom.functions import urls as U
from webloom.plans.crawl_job import crawl_site, normalized_captures, run_crawl
from webloom.sources import io as IO

PAD = "<!--" + "x" * 200 + "-->"


def test_crawl_site_writes_outputs(spark):
    pages = spark.createDataFrame([
        (0, "https://a.com/", '<title>Home</title><body><a href="/x">x</a><a href="https://b.org/">b</a>hi there all</body>' + PAD),
        (1, "https://a.com/x", '<title>X</title><body><a href="/">home</a><a href="/y.pdf">pdf</a>page x text</body>' + PAD),
    ], "page_id long, url string, html string")
    seeds = spark.createDataFrame([(0, "a.com")], "seed long, website string").select(
        "seed", U.normalize_url(F.col("website")).alias("url"))
    out = tempfile.mkdtemp(prefix="webloom-site-")
    visited = {(r.url, r.depth, r.fetched) for r in crawl_site(seeds, normalized_captures(pages), out).collect()}
    assert visited == {("https://a.com/", 0, True), ("https://a.com/x", 1, True)}
    md = IO.read_markdown(spark, f"{out}/markdown", tree=True)
    assert sorted(r.path for r in md.collect()) == ["a.com/index.md", "a.com/x.md"]
    assert sorted(r.path for r in IO.read_tree(spark, f"{out}/html").collect()) == ["a.com/index.html", "a.com/x.html"]
    ext = IO.read_external_links(spark, f"{out}/external_links")
    assert [tuple(r) for r in ext.collect()] == [("a.com", "https://a.com/", "https://b.org/")]


def test_crawl_gate_variants_redirects_and_files(spark):
    def page(body):
        return f"<body>{body} some words here</body>" + PAD
    # a rejected attempt, the first good one, a later one; www only; a redirect; two pages with one file name
    captures = spark.createDataFrame([
        ("https://a.com/", 0, 503, None, page('<a href="/bad">b</a>')),
        ("https://a.com/", 1, 200, None, page('<a href="/x/p">x</a><a href="/y/p">y</a><a href="/old">o</a>')),
        ("https://a.com/", 1, 200, None, page('<a href="/x/p">x</a><a href="/y/p">y</a><a href="/old">o</a>')),
        ("https://a.com/", 2, 200, None, page('<a href="/later">l</a>')),
        ("https://a.com/x/p", 0, 200, None, page("first")),
        ("https://a.com/y/p", 0, 200, None, page("second")),
        ("https://a.com/old", 0, 200, "https://a.com/new/here", page('<a href="leaf">leaf</a>')),
        ("https://a.com/new/leaf", 0, 200, None, "<p>small</p>"),
    ], "url string, ord int, status int, final_url string, html string")
    seeds = spark.createDataFrame([(0, "https://www.a.com/")], "seed long, url string")
    got = run_crawl(seeds, captures)
    assert {(r.url, r.depth, r.fetched) for r in got.visited.collect()} == {
        ("https://www.a.com/", 0, True), ("https://a.com/x/p", 1, True), ("https://a.com/y/p", 1, True),
        ("https://a.com/old", 1, True), ("https://a.com/new/leaf", 2, False)}
    files = {(r.seed_host, r.file_name): r.content for r in got.html.collect()}
    assert sorted(files) == [("www.a.com", "here.html"), ("www.a.com", "index.html"), ("www.a.com", "p.html")]
    assert "second" in files["www.a.com", "p.html"]
    assert len(got.markdown.collect()) == 3
    assert {r.url for r in run_crawl(seeds, captures, max_urls=2).visited.collect()} == {
        "https://www.a.com/", "https://a.com/old"}


def test_crawl_site_respects_robots(spark):
    pages = spark.createDataFrame([
        (0, "https://a.com/", '<body><a href="/private/x">x</a><a href="/open">o</a>home page text</body>' + PAD),
        (1, "https://a.com/private/x", '<body><a href="/deep">d</a>secret page text</body>' + PAD),
        (2, "https://a.com/open", '<body>open page text</body>' + PAD),
    ], "page_id long, url string, html string")
    seeds = spark.createDataFrame([(0, "https://a.com/")], "seed long, url string")
    robots = spark.createDataFrame([("a.com", "User-agent: *\nDisallow: /private")], "host string, body string")
    got = {r.url: r.fetched for r in crawl_site(seeds, normalized_captures(pages), robots=robots).collect()}
    assert got == {"https://a.com/": True, "https://a.com/private/x": False, "https://a.com/open": True}


def test_crawl_skips_failed_hosts_and_counts_hosts_inside(spark):
    def page(body):
        return f"<body>{body} some words here</body>" + PAD
    captures = spark.createDataFrame([
        ("https://a.com/", page('<a href="/b">b</a><a href="/c">c</a>')), ("https://a.com/b", page('<a href="/d">d</a>')),
        ("https://a.com/c", page("")), ("https://a.com/d", page("")), ("https://bad.com/", page('<a href="/x">x</a>'))],
        "url string, html string")
    seeds = spark.createDataFrame([(0, "https://a.com/"), (1, "https://bad.com/")], "seed long, url string")
    failed = spark.createDataFrame([("bad.com",)], "host string")
    lost = spark.createDataFrame([("https://a.com/c",)], "url string")
    got = run_crawl(seeds, captures, max_per_host=2, failed_hosts=failed, blocked=lost)
    assert {r.url: r.reason for r in got.visited.collect()} == {
        "https://a.com/": None, "https://a.com/b": None, "https://a.com/c": "host_cap", "https://a.com/d": "host_cap",
        "https://bad.com/": "failed_host"}
    assert {r.file_name for r in got.html.collect()} == {"index.html", "b.html"}
