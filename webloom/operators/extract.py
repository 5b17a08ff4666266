"""HTML extraction as a Spark job: one parse per page, everything else native.

``parse_pages`` runs the HTML reader once per page inside an Arrow UDF, a
piece of a batch at a time, and returns a struct; ``html_to_markdown`` and the link
operators only use native Column expressions on that struct.  Only
``(keys, url, html)`` enter the Python worker, and ``html`` is dropped right
after the parse so it never travels through a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import urls as U
from ..functions.htmlkernel import read_page
from ..functions.text import NO_CONTENT, NO_TITLE, clean_text

PARSED = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("hrefs", T.ArrayType(T.StringType())),
    T.StructField("error", T.StringType()),
])


# the same for Arrow, and how many characters of HTML are parsed before their rows are
# handed on: what a task holds doesn't grow with the Arrow batches that Spark sends
_PARSED = pa.struct([("title", pa.string()), ("description", pa.string()), ("text", pa.string()),
                     ("hrefs", pa.list_(pa.field("element", pa.string()))), ("error", pa.string())])
PIECE = 1 << 20


def pieces(pages: pa.Array) -> Iterator[list]:
    """The values of an Arrow batch in lists of about ``PIECE`` characters."""
    part, size = [], 0
    for page in pages:
        part.append(page.as_py())
        size += 64 + (len(part[-1]) if isinstance(part[-1], str) else 0)
        if size >= PIECE:
            yield part
            part, size = [], 0
    if part:
        yield part


def _parse_all(html, dedupe_areas=False, keep_paragraphs=False):
    rows = []
    for h in html:
        try:
            row = *read_page(h if isinstance(h, str) else "", dedupe_areas, keep_paragraphs), None
        except Exception as e:  # a bad page becomes an error row, never a failed job
            row = None, "", "", [], f"{type(e).__name__}: {e}"
        rows.append(row)
    return pa.array(rows, _PARSED)


def _parse_batches(html: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in html:
        for part in pieces(batch):
            yield _parse_all(part)


# Declared non-deterministic on purpose: Catalyst then never copies the call
# into a pushed-down filter (e.g. the non-empty-array filter it infers for
# ``posexplode``), so every page is parsed exactly once.
parse_html = F.arrow_udf(_parse_batches, PARSED).asNondeterministic()
"""Column function: ``parse_html(html) -> STRUCT<title, description, text,
hrefs ARRAY<STRING>, error>``."""

_VARIANTS = {}


def parse_udf(dedupe_areas: bool = False, keep_paragraphs: bool = False):
    """The parse UDF for the given options (the default one is ``parse_html``)."""
    if not dedupe_areas and not keep_paragraphs:
        return parse_html
    key = (dedupe_areas, keep_paragraphs)
    if key not in _VARIANTS:
        def batches(html: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in html:
                for part in pieces(batch):
                    yield _parse_all(part, dedupe_areas, keep_paragraphs)
        _VARIANTS[key] = F.arrow_udf(batches, PARSED).asNondeterministic()
    return _VARIANTS[key]


def parse_pages(pages: DataFrame, keys=("page_id",), url: str = "url", html: str = "html",
                dedupe_areas: bool = False, keep_paragraphs: bool = False) -> DataFrame:
    """``(keys..., url, html)`` -> ``(keys..., url, p STRUCT)``: the single
    parse of every page, in the partitions that the input has.  ``html`` is not
    carried past this point.  Spark bounds an Arrow batch by bytes, and a task
    parses ``PIECE`` characters of it at a time, so the session's settings are
    left alone."""
    src = pages.select(*keys, url, html)
    fn = parse_udf(dedupe_areas, keep_paragraphs)
    return src.select(*keys, url, fn(F.col(html)).alias("p"))


def render_markdown(url: Column, title: Column, description: Column, text: Column,
                    error: Column) -> Column:
    """Markdown document layout: URL, optional title and description lines,
    a ``---`` rule, then the text."""
    nl2 = F.lit("\n\n")
    md = F.concat(
        F.lit("URL: "), url, nl2,
        F.when(title != "", F.concat(F.lit("Page Title: "), title, nl2)).otherwise(F.lit("")),
        F.when(description != "", F.concat(F.lit("Meta Description: "), description, nl2))
        .otherwise(F.lit("")),
        F.lit("---"), nl2, text)
    failed = F.concat(F.lit("URL: "), url, nl2, F.lit("Error converting content: "), error)
    return F.when(error.isNull(), md).otherwise(failed)


def html_to_markdown(pages: DataFrame, keys=("page_id",), url: str = "url", html: str = "html",
                     dedupe_areas: bool = False, keep_paragraphs: bool = False) -> DataFrame:
    """Flagship operator: pages -> ``(keys..., url, title, description, text,
    markdown, error)``.  ``dedupe_areas`` bounds the text of pages whose
    content areas nest or match twice; ``keep_paragraphs`` keeps body text
    in paragraphs (both off by default, as in the contract)."""
    parsed = parse_pages(pages, keys, url, html, dedupe_areas, keep_paragraphs)
    return markdown_from_parsed(parsed, keys, url, keep_paragraphs)


def markdown_from_parsed(parsed: DataFrame, keys=("page_id",), url: str = "url",
                         keep_paragraphs: bool = False) -> DataFrame:
    """Markdown documents from an existing parse (``parse_pages`` output)."""
    text = (F.when(F.col("p.text") == "", F.lit(NO_CONTENT)).otherwise(F.col("p.text"))
            if keep_paragraphs else clean_text(F.col("p.text")))
    out = parsed.select(
        *keys, F.col(url).alias("url"),
        F.coalesce(F.col("p.title"), F.lit(NO_TITLE)).alias("title"),
        F.col("p.description").alias("description"),
        text.alias("text"),
        F.col("p.error").alias("error"))
    return out.select(
        *keys, "url", "title", "description", "text",
        render_markdown(F.col("url"), F.col("title"), F.col("description"), F.col("text"),
                        F.col("error")).alias("markdown"),
        "error")


# ---------------------------------------------------------------------------
# Links (#15-#17, #22, #52-#54)
# ---------------------------------------------------------------------------

def page_anchors(parsed: DataFrame, keys=("page_id",), url: str = "url") -> DataFrame:
    """One row per ``<a href>`` occurrence, in page order:
    ``(keys..., src, pos, href)``."""
    return parsed.select(*keys, F.col(url).alias("src"),
                         F.posexplode(F.col("p.hrefs")).alias("pos", "href"))


def classify_links(anchors: DataFrame) -> DataFrame:
    """Drop non-links and same-page links, resolve the rest and tag each as
    internal or external.  Adds ``link`` (resolved), ``internal`` (bool),
    ``dst`` (normalised for internal, raw for external).

    Resolution, locality and normalisation come from one expression
    evaluated inside a one-row generator: Catalyst cannot push later filters
    below a generator, so nothing is evaluated twice (a plain projection
    would have the filters on ``link``/``dst`` pushed below it, each with a
    copy of the URL expressions)."""
    a = anchors.filter(U.is_followable_href(F.col("href")))
    info = F.expr(U.link_info_sql("src", "href"))
    a = a.select(*a.columns, F.inline(F.array(info)))
    return a.filter(~F.col("same")).drop("same")


def internal_links(links: DataFrame, keys=("page_id",)) -> DataFrame:
    """Distinct normalised internal links per page (no order)."""
    return (links.filter(F.col("internal") & F.col("dst").isNotNull())
            .select(*keys, "src", "dst").dropDuplicates([*keys, "dst"]))


def external_links(links: DataFrame, keys=("page_id",)) -> DataFrame:
    """Every external link occurrence with its source page."""
    return links.filter(~F.col("internal")).select(*keys, "src", "pos", F.col("link").alias("dst"))


def external_link_count(links: DataFrame, by=None) -> DataFrame:
    """Per source host (or the columns ``by``): external link occurrences and how
    many different targets they have (``links`` as :func:`external_links` returns
    them)."""
    keys = by or [U.host_of(F.col("src")).alias("host")]
    return links.groupBy(*keys).agg(F.count(F.lit(1)).alias("links"), F.countDistinct("dst").alias("targets"))
