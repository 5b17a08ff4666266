"""SQL surface: everything a SQL user needs to run the extraction in SQL.

``register_all(spark)`` defines, in the session:

* ``webloom_<name>(...)`` URL functions (see :mod:`webloom.functions.urls`);
* ``webloom_parse_html(html)`` - the one-parse-per-page Arrow UDF returning
  ``STRUCT<title, description, text, hrefs ARRAY<STRING>, error>``;
* ``webloom_markdown_of(url, webloom_parse_html(html))`` - the Markdown document
  of a page, as :func:`webloom.operators.extract.html_to_markdown` lays it out;
* ``webloom_page_hrefs(html)`` - a table function yielding ``(pos, href)``
  for every ``<a href>`` of a page, for ``LATERAL`` joins;
* ``webloom_extract_links(TABLE(...))`` - a table function over Arrow batches of a table
  with columns ``url`` and ``html``, yielding ``(url, pos, href)``;
* ``webloom_link_info(url, href)`` - ``STRUCT<link, same, internal, dst>``: the resolved
  link, whether it leads back to the page, whether it stays on the site, and its
  normalised form (internal) or itself.

Examples::

    SELECT p.page_id, h.pos, webloom_resolve_url(p.url, h.href) AS link
    FROM pages p, LATERAL webloom_page_hrefs(p.html) h

    SELECT url, pos, l.link, l.internal
    FROM (SELECT url, pos, webloom_link_info(url, href) AS l
          FROM webloom_extract_links(TABLE(SELECT url, html FROM pages)) WHERE href <> '')
    WHERE NOT l.same
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf, udtf

from ..operators.extract import parse_html, pieces
from .htmlkernel import read_hrefs, scan_hrefs
from .text import NO_CONTENT, NO_TITLE, PY_SPACE
from .urls import link_info_sql, register_functions


@udtf(returnType="pos int, href string", useArrow=True)
class PageHrefs:
    """Every ``<a href>`` of one page, in document order."""

    def eval(self, html: str):
        if html is None:
            return
        try:
            hrefs = read_hrefs(html)
        except Exception:  # an unreadable page has no links
            return
        for i, h in enumerate(hrefs):
            yield i, h


@arrow_udtf(returnType="url string, pos int, href string")
class ExtractLinks:
    """Every ``<a href>`` of a batch of pages, in document order; pages keep their
    partitions."""

    def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        pages = batch.column("html")
        # pages without an anchor aren't looked at in Python
        some = pc.fill_null(pc.match_substring_regex(pages, "<[aA][^a-zA-Z]"), False)
        batch = batch.filter(some)
        at = 0
        for part in pieces(batch.column("html")):
            yield self._links(batch.slice(at, len(part)), part)
            at += len(part)

    def _links(self, batch: pa.RecordBatch, pages: list[str]) -> pa.Table:
        found = []
        for html in pages:
            try:
                found.append(scan_hrefs(html))
            except Exception:  # an unreadable page has no links
                found.append([])
        sizes = np.array([len(f) for f in found], np.int64)
        row = np.repeat(np.arange(len(found)), sizes)
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        return pa.table({"url": batch.column("url").take(pa.array(row)),
                         "pos": pa.array((np.arange(len(row)) - first).astype(np.int32)),
                         "href": pa.array([h for f in found for h in f], pa.string())})


LINK_INFO = ("CREATE OR REPLACE TEMPORARY FUNCTION webloom_link_info(page STRING, href STRING) RETURNS "
             "STRUCT<link: STRING, same: BOOLEAN, internal: BOOLEAN, dst: STRING> RETURN ")

# the layout of render_markdown over a parse, as a SQL function
MARKDOWN_OF = r"""
CREATE OR REPLACE TEMPORARY FUNCTION webloom_markdown_of(url STRING,
    p STRUCT<title: STRING, description: STRING, text: STRING, hrefs: ARRAY<STRING>, error: STRING>)
RETURNS STRING
RETURN CASE WHEN p IS NULL OR url IS NULL THEN NULL
  WHEN p.error IS NOT NULL THEN concat('URL: ', url, '\n\nError converting content: ', p.error)
  ELSE concat('URL: ', url, '\n\n',
    if(coalesce(p.title, '{no_title}') <> '', concat('Page Title: ', coalesce(p.title, '{no_title}'), '\n\n'), ''),
    if(p.description <> '', concat('Meta Description: ', p.description, '\n\n'), ''), '---\n\n',
    coalesce(nullif(trim(regexp_replace(p.text, '{space}+', ' ')), ''), '{no_content}')) END
"""


def register_all(spark: SparkSession) -> None:
    register_functions(spark)
    spark.udf.register("webloom_parse_html", parse_html)
    spark.sql(MARKDOWN_OF.format(no_title=NO_TITLE, no_content=NO_CONTENT, space=PY_SPACE.replace("\\", "\\\\")))
    spark.udtf.register("webloom_page_hrefs", PageHrefs)
    spark.udtf.register("webloom_extract_links", ExtractLinks)
    spark.sql(LINK_INFO + link_info_sql("page", "href"))
