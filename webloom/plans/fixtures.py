"""Derived input tables (fixtures F2-F9), built from the given tables.

Each fixture is defined once as SQL expression text that both Spark and
DuckDB accept; Spark evaluates it with ``selectExpr`` and the DuckDB
oracles embed the same text in a CTE (see :mod:`webloom.plans.oracle`).
Row fan-out uses ``explode`` of a literal array in Spark (a generator, not
a join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table

# switches on links, metadata, content areas, unwanted tags, challenge
# markers and missing body tags.
PAGES_X_HTML = """replace(replace(replace(html, '</head>',
      concat('<meta name="', case page_id % 3 when 0 then 'Description' when 1 then 'description' else 'keywords' end,
             '" content=" About page ', page_id, ' "></head>')),
    '<article>', concat('<div class="more"><a href="https://partner.example.net/x?id=', page_id, '">ext</a>',
      '<a href="https://partner.example.net/x?id=', page_id, '">ext again</a><a href="//cdn.example.org/a">cdn</a>',
      '<a href="mailto:a@example.com">mail</a><a href="tel:123">tel</a><a href="javascript:void(0)">js</a>',
      '<a href="#top">top</a><a href="../up/">up</a><a href="?page=3">next</a><a href="">empty</a>',
      '<a href="/files/', page_id, '.pdf">pdf</a><a href="/wp-admin/x">admin</a></div>',
      '<noscript>enable scripts</noscript><svg><path d="M0"></path><text>icon</text></svg>',
      case when page_id % 7 = 0 then '<!-- cf-ray: 1 -->' else '' end,
      case page_id % 4 when 0 then '<article id="main-content">' when 1 then '<article class="x Post-body">'
                       when 2 then '<article id="post-1" class="article">' else '<article>' end)),
    '<body>', case when page_id % 11 = 10 then '' else '<body>' end)"""

# link graph, five out-links per node (three page links, one external,
# one rejected file link); ``n`` is the number of pages.
EDGE_SRC = "concat('https://site.example.com/p/', page_id)"
EDGE_DST = """case k when 3 then concat('https://other.example.org/', page_id)
         when 4 then concat('https://site.example.com/p/', page_id, '.pdf')
         else concat('https://site.example.com/p/', (page_id * 37 + 101 * (k + 1)) % n) end"""
EDGE_K = 5

# one robots file per host.
ROBOTS_HOST = "regexp_extract(url, '^https?://([^/?#]+)', 1)"
ROBOTS_BODY = """concat('User-agent: *', chr(10), 'Disallow: /fr/', chr(10), 'disallow: ',
  case when host like 'm.%' then '/en/1' when host like '%.org' then '' else '/none/' end, chr(10), 'Allow: /')"""

# four capture attempts per page.
ATTEMPT_METHODS = [(0, "cache"), (1, "fast"), (2, "rendered"), (3, "library")]
ATTEMPT_COLS = {
    "status": "case when (page_id + ord) % 4 = 0 then 503 when (page_id + ord) % 5 = 0 then 404 else 200 end",
    "redirects": "(page_id * 3 + ord * 2) % 8",
    "final_url": "case when page_id % 9 = 0 then concat(url, '#moved') else url end",
    "html": "case when (page_id + 2 * ord) % 6 = 0 then '<html></html>' else html end",
}

# request arrivals; delay 6 hours.
POLITENESS_DELAY_US = 6 * 3600 * 1_000_000

# seed list in the seed-file format, several spellings per page URL.
SEED_VARIANTS = [
    "url",
    "regexp_replace(url, '^https?://', '')",
    "concat('  ', url, '/ ')",
    "concat(regexp_extract(url, '^(https?://[^/?#]+)', 1), "
    "case when url like 'https:%' then ':443' else ':80' end, "
    "regexp_replace(url, '^https?://[^/?#]+', ''))",
]

# documents with repeated lines.
REPEATS_TEXT = ("replace(text, chr(10), concat(chr(10), 'Read more about this', chr(10), "
                "'Read more about this', chr(10)))")

# linked sites on the pages' own hosts, with three capture attempts a page.
# Page ``idx`` of a host of ``cnt`` pages links to its four children in a tree, to a
# page that isn't there and to another site.  Some pages are stored under www only,
# some redirect to URLs that share a file name.
SITE_PLACE = ["row_number() over (partition by host order by page_id) - 1 as idx",
              "count(*) over (partition by host) as cnt"]
SITE_URL = "concat('https://', case when idx % 6 = 5 then 'www.' else '' end, host, '/p/', idx)"
SITE_FINAL = f"case when idx % 7 = 3 then concat('https://', host, '/moved/', idx % 10) else {SITE_URL} end"
SITE_TEXT = "concat(repeat('words of the page ', 12), page_url, ' attempt ', ord)"
SITE_FAN = 4
SITE_LINKS = ("concat('<a href=\"/p/', idx + cnt, '\">gone</a>', " + ", ".join(
    f"case when {SITE_FAN} * idx + {j} < cnt then concat('<a href=\"/p/', {SITE_FAN} * idx + {j}, '\">next</a>') else '' end"
    for j in range(1, SITE_FAN + 1)) + ")")
SITE_HTML = (f"concat('<html><head><title>Page ', page_id, '</title></head><body><article><p>', {SITE_TEXT}, "
             f"'</p></article><nav>', {SITE_LINKS}, '<a href=\"https://ext.example.org/', page_id, '\">out</a></nav></body></html>')")
SITE_STATUS = "case when ord = 0 and page_id % 4 = 0 then 503 else 200 end"
SITE_ATTEMPTS = 3
SITE_SEED = "idx % 40 = 0"
# hosts on the failed list, URLs on it, robots files
SITE_FAILED_HOST = "length(host) % 13 = 5"
SITE_FAILED_URL = "page_id % 17 = 4"
SITE_ROBOTS = "concat('User-agent: *', chr(10), 'Disallow: /p/2', case when length(host) % 3 = 0 then '' else '99' end)"

# redirects among the pages, in groups of ten: chains of one to eight hops; some
# groups close them to a loop, and the last pages of two groups point at each other.
CHAIN_FROM = "concat('https://r.example.com/', page_id)"
CHAIN_TO = """concat('https://r.example.com/', case when page_id % 10 = 9 then case when page_id % 20 = 9 then page_id + 10 else page_id - 10 end
  when page_id % 10 = 8 then page_id - 8 else page_id + 1 end)"""
CHAIN_MOVED = "page_id % 10 <> 8 or page_id % 50 = 48"

# Crawl seeds over the F3 graph, in the spellings of a seed file.
CRAWL_SEED = "page_id % 25 = 0"


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages")


def pages_x(spark: SparkSession, sf: str) -> DataFrame:
    return pages(spark, sf).selectExpr("page_id", "url", PAGES_X_HTML + " as html")


def edges(spark: SparkSession, sf: str) -> DataFrame:
    p = pages(spark, sf).select("page_id")
    n = p.select(F.count(F.lit(1))).scalar()
    k = p.select("page_id", F.explode(F.array(*[F.lit(i) for i in range(EDGE_K)])).alias("k"))
    return k.withColumn("n", n).selectExpr(f"{EDGE_SRC} as src", f"{EDGE_DST} as dst")


def graph_captures(spark: SparkSession, sf: str) -> DataFrame:
    return pages(spark, sf).selectExpr(f"{EDGE_SRC} as url", "html")


def robots(spark: SparkSession, sf: str) -> DataFrame:
    h = pages(spark, sf).selectExpr(f"{ROBOTS_HOST} as host").distinct()
    return h.selectExpr("host", f"{ROBOTS_BODY} as body")


def attempts(spark: SparkSession, sf: str) -> DataFrame:
    m = F.array(*[F.struct(F.lit(o).alias("ord"), F.lit(n).alias("method")) for o, n in ATTEMPT_METHODS])
    a = pages(spark, sf).select("page_id", "url", "html", F.inline(m))
    return a.selectExpr("page_id", "url", "ord", "method",
                        *[f"{v} as {k}" for k, v in ATTEMPT_COLS.items()])


def redirect_chains(spark: SparkSession, sf: str) -> DataFrame:
    return pages(spark, sf).filter(CHAIN_MOVED).selectExpr(f"{CHAIN_FROM} as from_url", f"{CHAIN_TO} as to_url")


def arrivals(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.col("user_id").alias("host"), "ts")


def seed_list(spark: SparkSession, sf: str) -> DataFrame:
    """``(page_id, variant, website)``: every page URL in four spellings."""
    v = F.array(*[F.struct(F.lit(i).alias("variant"), F.expr(e).alias("website"))
                  for i, e in enumerate(SEED_VARIANTS)])
    return pages(spark, sf).select("page_id", F.inline(v))


def crawl_seeds(spark: SparkSession, sf: str) -> DataFrame:
    """``(seed, website)``: every 25th page of the F3 graph, in five spellings."""
    website = (f"case page_id div 25 % 5 when 1 then concat('site.example.com/p/', page_id, '/') "
               f"when 3 then concat('http://site.example.com:80/p/', page_id) when 4 then '' else {EDGE_SRC} end")
    return pages(spark, sf).filter(CRAWL_SEED).selectExpr("page_id as seed", f"{website} as website")


def repeats(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").selectExpr("doc_id", f"{REPEATS_TEXT} as text")


def site_pages(spark: SparkSession, sf: str) -> DataFrame:
    """``(page_id, page_url, host, idx, cnt)``: the pages' places on their hosts."""
    p = pages(spark, sf).selectExpr("page_id", "url as page_url", f"{ROBOTS_HOST} as host")
    return p.selectExpr("*", *SITE_PLACE)


def site_attempts(spark: SparkSession, sf: str) -> DataFrame:
    a = site_pages(spark, sf).select("*", F.explode(F.array(*[F.lit(i) for i in range(SITE_ATTEMPTS)])).alias("ord"))
    return a.selectExpr("page_id", f"{SITE_URL} as url", "ord", f"{SITE_STATUS} as status", f"{SITE_FINAL} as final_url",
                        f"{SITE_HTML} as html")


def site_captures(spark: SparkSession, sf: str) -> DataFrame:
    """The given pages' own HTML behind the links of F10, one capture a page."""
    html = pages(spark, sf).select("page_id", "html")
    return site_pages(spark, sf).join(html, "page_id").selectExpr(
        "page_id", f"{SITE_URL} as url", f"concat({SITE_LINKS}, html) as html")


def site_seeds(spark: SparkSession, sf: str) -> DataFrame:
    """Every 40th page of each host."""
    return site_pages(spark, sf).filter(SITE_SEED).selectExpr("page_id as seed", f"{SITE_URL} as url")


def site_failed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Failed URLs ``(url)`` and failed hosts ``(host)``."""
    p = site_pages(spark, sf)
    return (p.filter(SITE_FAILED_URL).selectExpr(f"{SITE_URL} as url"),
            p.filter(SITE_FAILED_HOST).select("host").distinct())


def site_robots(spark: SparkSession, sf: str) -> DataFrame:
    return site_pages(spark, sf).select("host").distinct().selectExpr("host", f"{SITE_ROBOTS} as body")
