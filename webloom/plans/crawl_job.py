"""End-to-end crawl of a seed list over a table of captured pages.

Seeds and capture attempts -> the fetch gate (acceptable attempts, the first
good one per URL, redirects, variants, robots rules, failed list) -> one parse
-> breadth-first crawl over the links found -> HTML, Markdown and external-link
outputs under the seed's host.  Acceptable attempts are laid out once in the
checkpoint folder, clustered by URL, and the parse results of those that win beside
them in the same buckets.  From then on only URLs, keys and file names move: choosing
the winners, the parse and the outputs find HTML and text where they lie.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import captures as C
from ..operators import extract as X
from ..operators import frontier as FR
from ..operators import policy as P
from ..session import scratch_dir
from ..sources import io as IO
from ..sources.store import buckets_for, write_bucketed

BUCKET_PAGES = 2000            # captures of a bucket, about 100 MB


def usable_attempts(captures: DataFrame) -> DataFrame:
    """The attempts that pass the fetch gate, as ``(url, ord, mark, final_url, html)``.

    ``captures`` has ``(url, html)`` and, where known, ``ord`` (order of the
    attempts of a URL), ``status``, ``redirects``, ``method`` and ``final_url``;
    each check applies where its column exists.  ``mark`` is a hash of the
    content and breaks ties of ``ord``."""
    known = set(captures.columns)
    ok = C.big_enough("html", C.min_chars_for("method" if "method" in known else None))
    if "status" in known:
        ok = ok & (F.col("status") < 400)
    if "redirects" in known:
        ok = ok & (F.col("redirects") < C.MAX_REDIRECTS)
    final = F.coalesce(F.col("final_url"), F.col("url")) if "final_url" in known else F.col("url")
    return captures.filter(ok & F.col("url").isNotNull()).select(
        "url", (F.col("ord").cast("long") if "ord" in known else F.lit(0).cast("long")).alias("ord"),
        F.xxhash64("html").alias("mark"), final.alias("final_url"), "html")


def first_attempts(attempts: DataFrame) -> DataFrame:
    """``(url, final_url, html)`` of each URL's first attempt, by ``(ord, mark,
    final_url)``.  ``attempts`` are clustered by ``url`` and have a number ``row``:
    neither the aggregation of the narrow columns nor the join that fetches the HTML
    moves a row."""
    place = F.struct("ord", "mark", "final_url", "row")
    first = attempts.groupBy(F.col("url").alias("_url")).agg(F.min(place).alias("_first"))
    # no equality beside the URL's, as only that is the buckets' key
    win = attempts.join(first, (F.col("url") == F.col("_url")) & (place <= F.col("_first")))
    return win.select("url", "final_url", "html")


@dataclass
class Crawl:
    """What a crawl leaves behind: ``visited`` (seed, url, depth, fetched, reason),
    ``html``, ``markdown`` (seed_host, file_name, url, final_url, content) and
    ``external`` (seed_host, src, dst), all lazy."""

    visited: DataFrame
    html: DataFrame
    markdown: DataFrame
    external: DataFrame


def run_crawl(seeds: DataFrame, captures: DataFrame, max_depth: int = FR.DEFAULT_MAX_DEPTH,
              max_urls: int | None = None, blocked: DataFrame | None = None,
              robots: DataFrame | None = None, max_per_host: int | None = None,
              failed_hosts: DataFrame | None = None) -> Crawl:
    """Crawl ``seeds`` ``(seed, url)`` (normalised) over ``captures`` (see
    :func:`usable_attempts`, URLs normalised).

    A URL without a usable capture takes that of its first variant that has
    one.  Links resolve against, and files are named after, the final URL.
    ``robots`` ``(host, body)``, ``blocked`` ``(url)`` (the failed list) and
    ``failed_hosts`` ``(host)`` name pages that are visited but not fetched;
    ``max_urls`` is a seed's budget and ``max_per_host`` the number of pages that all
    seeds together may fetch from a host; ``visited.reason`` tells which rule
    stopped a page.  Each
    fetched page is stored under its seed's host; of pages that share a file the
    one visited last, by ``(depth, url, seed)``, stays."""
    spark = seeds.sparkSession
    base = scratch_dir(spark, "site")
    attempts = usable_attempts(captures).withColumn("row", F.monotonically_increasing_id())
    buckets = buckets_for(spark, captures.count(), BUCKET_PAGES)
    attempts = write_bucketed(attempts, f"{base}/attempts", "url", buckets)
    parsed = X.parse_pages(first_attempts(attempts), keys=("url",), url="final_url")
    parsed = write_bucketed(parsed, f"{base}/parsed", "url", buckets, clustered=True)

    links = X.classify_links(X.page_anchors(parsed, keys=("url",), url="final_url"))
    edges = FR.follow_edges(links.filter("internal").select("url", "src", F.col("link").alias("dst")), page="url")
    edges.write.parquet(f"{base}/edges")
    edges = spark.read.schema(edges.schema).parquet(f"{base}/edges")
    asked = edges.select(F.col("dst").alias("url")).unionByName(
        seeds.select("url").filter(F.col("url").isNotNull())).distinct()
    stand_in = C.match_variants(asked, parsed.select("url")).select("url", F.col("variant").alias("page"))
    pages = parsed.select("url", F.col("url").alias("page")).unionByName(stand_in)
    pages.write.parquet(f"{base}/pages")
    pages = spark.read.schema(pages.schema).parquet(f"{base}/pages")
    borrowed = (pages.filter("url <> page").join(edges.withColumnRenamed("src", "page"), "page")
                .select(F.col("url").alias("src"), "dst"))

    if robots is not None:
        asked_for = asked.unionByName(pages.select("url")).distinct()
        ruled = P.blocked_by_robots(asked_for, P.parse_robots(robots)).select("url", F.lit("robots").alias("reason"))
    if blocked is not None:
        blocked = blocked.select("url", F.lit("failed_url").alias("reason"))
    if robots is not None:
        blocked = ruled if blocked is None else blocked.unionByName(ruled)
    visited = FR.crawl(seeds, edges.unionByName(borrowed), pages.select("url"), max_depth=max_depth,
                       blocked=blocked, max_urls=max_urls, max_per_host=max_per_host, failed_hosts=failed_hosts)

    homes = seeds.filter(F.col("url").isNotNull()).select("seed", U.host_of(F.col("url")).alias("seed_host"))
    stored = (visited.filter("fetched").join(homes.distinct(), "seed").join(pages, "url")
              .select("seed_host", "page", F.struct("depth", "url", "seed").alias("seq")))
    named = stored.join(parsed.select(F.col("url").alias("page"), "final_url"), "page")
    # the docs are rebuilt from the stored parse; the HTML is that of the attempt that won
    docs = X.markdown_from_parsed(parsed.withColumnRenamed("url", "page"), keys=("page",), url="final_url").select(
        F.col("page").alias("url"), F.col("markdown").alias("content"))
    raw = first_attempts(attempts).select("url", F.col("html").alias("content"))

    def files(markdown: bool) -> DataFrame:
        name = (U.markdown_file_name if markdown else U.page_file_name)(F.col("final_url"))
        last = (named.withColumn("file_name", name).groupBy("seed_host", "file_name")
                .agg(F.max_by(F.struct("page", "final_url"), F.col("seq")).alias("w")))
        last = last.select("seed_host", "file_name", F.col("w.page").alias("url"), "w.final_url")
        return last.join(docs if markdown else raw, "url").select("seed_host", "file_name", "url", "final_url", "content")

    hosts = stored.select("seed_host", F.col("page").alias("url")).distinct()
    external = (links.filter(~F.col("internal")).select("url", "src", "pos", F.col("link").alias("dst"))
                .join(hosts, "url").select("seed_host", "src", "pos", "dst"))
    return Crawl(visited, files(False), files(True), external)


def crawl_site(seeds: DataFrame, captures: DataFrame, out_dir: str | None = None, **options) -> DataFrame:
    """:func:`run_crawl` (whose options it takes), returning the visited pages
    ``(seed, url, depth, fetched, reason)``.  With ``out_dir``, also writes the trees
    ``html/`` and ``markdown/`` and the CSV files ``external_links/``."""
    got = run_crawl(seeds, captures, **options)
    if out_dir is not None:
        for kind, tree in (("html", got.html), ("markdown", got.markdown)):
            IO.write_files(tree.withColumnRenamed("seed_host", "host"), f"{out_dir}/{kind}", "content")
        IO.write_external_links(got.external, f"{out_dir}/external_links", host="seed_host")
    return got.visited


def normalized_captures(pages: DataFrame) -> DataFrame:
    """Captures keyed the way a crawl requests them (normalised URL)."""
    rest = [c for c in pages.columns if c != "url"]
    return (pages.select(U.normalize_url(F.col("url")).alias("url"), *rest)
            .filter(F.col("url").isNotNull()))
