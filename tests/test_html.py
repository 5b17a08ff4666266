"""HTML reader and Markdown layout: tree rules, entities, content areas."""

import time

from pyspark.sql import functions as F

from webloom.functions.htmlkernel import read_page
from webloom.operators.extract import html_to_markdown, parse_pages


def text_of(html):
    return read_page(html)[2]


def test_title_rules():
    assert read_page("<title> A &amp; B </title>")[0] == "A & B"
    assert read_page("<title>a<!--c-->b</title>")[0] is None          # two strings
    assert read_page("<title><!--c-->Foo</title>")[0] == "Foo"
    assert read_page("<title><b>x</b></title>")[0] == "x"             # followed down
    assert read_page("<title>   </title>")[0] == ""
    assert read_page("<p>no title</p>")[0] is None


def test_description_first_exact_name():
    h = '<meta name="keywords" content="k"><meta name="Description" content=" d1 "><meta name="description" content="d2">'
    assert read_page(h)[1] == "d1"
    assert read_page('<meta name="DESCRIPTION" content="x">')[1] == ""
    assert read_page('<meta name="description" content=""><meta name="description" content="y">')[1] == ""


def test_unwanted_subtrees_and_comments():
    h = "<body>a<script>x</script><noscript>n</noscript><svg><text>i</text></svg>b<!-- c -->c</body>"
    assert text_of(h) == "a b c"


def test_unclosed_svg_swallows_to_parent_end():
    h = "<body><div>a<svg><path>p</path>lost</div>kept</body>"
    assert text_of(h) == "a kept"


def test_end_tag_closes_nearest_and_above():
    # </div> closes the open <span> too; the stray </span> is ignored
    h = '<body><div id="content">x<span>y</div>z</span></body>'
    assert text_of(h) == "x y"


def test_p_does_not_autoclose():
    h = '<body><div class="post"><p>a<p>b</div>c</body>'
    assert text_of(h) == "a b"


def test_content_areas_id_then_class_and_double_match():
    h = ('<body><div class="main">one</div><section id="post-1">two</section>'
         '<article id="content" class="article">three</article><article>no</article></body>')
    # id matches first (section, article), then class matches (div, article)
    assert text_of(h) == "two three one three"


def test_bare_article_not_a_content_area():
    assert text_of("<body><article>x</article><p>y</p></body>") == "x y"


def test_no_body_uses_whole_document_without_doctype():
    h = "<!DOCTYPE html><html><head><title>T</title></head><p>x</p></html>"
    assert text_of(h) == "T x"


def test_entities():
    h = "<body>&copy; &middot; &quot;q&quot; &amp &ampx &#65;&#x42; &#150; &unknown; a&b</body>"
    assert text_of(h) == '© · "q" & &ampx AB – &unknown a&b'


def test_void_elements_and_skipped_parents():
    h = '<body><br>a<br/>b<meta name="x"/>c</body>'
    # "<br/>" after "<br>" stays open (the explicit close is consumed), text stays in body
    assert text_of(h).startswith("a b")


def test_hrefs_all_anchors_in_order():
    h = '<a href="/a">x</a><!-- <a href="/c"> --><svg><a href="/b">y</a></svg><a>z</a><a href="">e</a>'
    assert read_page(h)[3] == ["/a", "/b", ""]


def test_truncated_page():
    h = "<html><body><p>alpha <b>beta &amp"
    assert text_of(h).startswith("alpha beta")


def test_markdown_layout(spark):
    pages = spark.createDataFrame(
        [(1, "https://a.com/x", "<title> T </title><meta name='description' content=' D '><body>hello  world</body>"),
         (2, "https://a.com/y", "<title></title><body>   </body>"),
         (3, "https://a.com/z", "<title>  </title><body>x</body>")],
        "page_id long, url string, html string")
    got = {r.page_id: r for r in html_to_markdown(pages).collect()}
    assert got[1].markdown == "URL: https://a.com/x\n\nPage Title: T\n\nMeta Description: D\n\n---\n\nhello world"
    assert got[2].markdown == "URL: https://a.com/y\n\nPage Title: No Title\n\n---\n\nNo content extracted from page"
    assert got[3].markdown == "URL: https://a.com/z\n\n---\n\nx"
    assert got[1].error is None


def test_python_whitespace_collapse(spark):
    """JVM collapse matches Python's notion of whitespace on every BMP code point."""
    import re
    from webloom.functions.text import collapse_whitespace
    s = "".join(chr(c) for c in range(0, 0x3100) if not 0xD800 <= c <= 0xDFFF)
    df = spark.createDataFrame([("a" + s + "b",)], "t string")
    got = df.select(collapse_whitespace(F.col("t"))).first()[0]
    assert got == re.sub(r"\s+", " ", "a" + s + "b")


def test_text_after_body_end_is_not_body_text():
    assert text_of("<html><body>a</body>b</html>c") == "a"


def test_content_area_inside_unwanted_subtree_is_ignored():
    h = '<body><svg><div id="content">hidden</div></svg><p>shown</p></body>'
    assert text_of(h) == "shown"


def test_script_string_with_end_tag_does_not_close_early():
    h = '<body><script>var t="</p>";</script><p>x</p></body>'
    assert text_of(h) == "x"


def test_first_body_wins_and_nested_areas_repeat():
    h = '<body><main class="main"><div id="post">in</div></main></body>'
    # id match first (div), then class match (main, which contains the div)
    assert text_of(h) == "in in"


def test_dedupe_areas_option_emits_each_text_once():
    h = '<body><main class="main"><div id="post">in</div>out</main><article id="content" class="post">x</article></body>'
    assert text_of(h) == "in x in out x"
    assert read_page(h, dedupe_areas=True)[2] == "in out x"


def test_keep_paragraphs_option(spark):
    h = "<body><h1>Title  here</h1><p>one\n two</p><span>inline</span> <p>three</p></body>"
    assert read_page(h)[2] == "Title  here one\n two inline three"
    assert read_page(h, keep_paragraphs=True)[2] == "Title here\n\none two\n\ninline three"
    pages = spark.createDataFrame([(1, "https://a.com/", h)], "page_id long, url string, html string")
    md = html_to_markdown(pages, keep_paragraphs=True).first().markdown
    assert md.endswith("---\n\nTitle here\n\none two\n\ninline three")


def test_title_of_nested_elements_is_linear():
    def seconds(n):
        page = "<svg><title>" + "<g>" * n + "deep" + "</g>" * n + "</title></svg>"
        best = 9e9
        for _ in range(3):
            t = time.perf_counter()
            title = read_page(page)[0]
            best = min(best, time.perf_counter() - t)
        assert title == "deep"
        return best

    assert seconds(8000) < 8 * seconds(2000)
    assert read_page("<title>a<b>c</b></title>")[0] is None and read_page("<title><b>c</b></title>")[0] == "c"
    assert read_page("<title></title>")[0] is None and read_page("<title>")[0] is None


def test_a_large_batch_is_parsed_a_piece_at_a_time(monkeypatch):
    import pyarrow as pa

    from webloom.operators import extract
    page = "<title>t</title><body><a href='/x'>" + "word " * 400 + "</a></body>"
    pages = [page if i % 5 else None for i in range(4000)]
    parsed = []
    monkeypatch.setattr(extract, "read_page", lambda *a: parsed.append(1) or read_page(*a))
    for fn in (extract.parse_html.func, extract.parse_udf(dedupe_areas=True).func):
        parsed.clear()
        out = fn(iter([pa.array(pages[:10]), pa.array([], pa.string()), pa.array(pages)]))
        sizes = [len(next(out)), len(next(out))]
        assert sizes[0] == 10 and len(parsed) == sum(sizes) < 1000       # a part of the large batch
        sizes += [len(x) for x in out]
        assert sum(sizes) == len(parsed) == 4010 and max(sizes) < 1000


def test_parse_of_batches_of_many_pieces(spark):
    n, page = 3000, "concat('<title>t', id, '</title><body>', repeat('word ', 400), '<a href=\"/', id, '\">x</a></body>')"
    html = spark.range(n).coalesce(1).selectExpr("id as page_id", "'https://a.com/' as url",
                                                 f"case when id % 7 = 3 then null else {page} end as html")
    got = {r.page_id: r.p for r in parse_pages(html).collect()}
    assert len(got) == n
    for i, p in got.items():
        want = (None, []) if i % 7 == 3 else (f"t{i}", [f"/{i}"])
        assert (p.title, p.hrefs) == want and p.error is None
