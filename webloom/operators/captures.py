"""Capture predicates, lookups and first-success selection (#3, #34-#37,
#39-#41, #44, #48, #50-#51).

"Fetching" is a join from URLs to a table of captured pages.  Selection of
one capture per URL is an aggregation (``min_by`` / ``max_by``), which Spark
pre-aggregates map-side, instead of a window that would sort every attempt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.text import py_strip
from ..session import scratch_dir

# Capture acceptance thresholds (a rendered page may be
# shorter than a static one).
MIN_STATIC_CHARS = 200
MIN_RENDERED_CHARS = 100
RENDERED_METHOD = "rendered"
MAX_REDIRECTS = 5
MAX_HOST_FAILURES = 3
# Challenge-page detection.
CHALLENGE_HOSTS = ["cloudflare.com", "workers.dev", "pages.dev"]
CHALLENGE_MARKERS = ["cloudflare", "cf-ray", "cf-browser-verification",
                     "cf_chl_", "cf-please-wait", "__cf_", "turnstile"]
CHALLENGE_SCAN_CHARS = 10000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- predicates ---------------------------------------------------------------

def big_enough(html, min_chars=MIN_STATIC_CHARS) -> Column:
    """Stripped content has at least ``min_chars`` characters (an int or a
    Column)."""
    h = _c(html)
    return h.isNotNull() & (F.length(py_strip(h)) >= min_chars)


def min_chars_for(method: str | None = "method") -> Column:
    """Per-attempt size threshold: 100 characters for rendered captures,
    200 otherwise (a plain literal when there is no method column)."""
    if method is None:
        return F.lit(MIN_STATIC_CHARS)
    return F.when(F.col(method) == RENDERED_METHOD, F.lit(MIN_RENDERED_CHARS)).otherwise(
        F.lit(MIN_STATIC_CHARS))


def drop_small_pages(df: DataFrame, html: str = "html", method: str | None = "method") -> DataFrame:
    if method is not None and method not in df.columns:
        method = None
    return df.filter(big_enough(html, min_chars_for(method)))


def drop_http_errors(df: DataFrame, status: str = "status") -> DataFrame:
    return df.filter(F.col(status) < 400)


def drop_redirect_loops(df: DataFrame, redirects: str = "redirects",
                        limit: int = MAX_REDIRECTS) -> DataFrame:
    return df.filter(F.col(redirects) < limit)


def acceptable(status: str = "status", redirects: str = "redirects", html: str = "html",
               method: str | None = "method", max_redirects: int = MAX_REDIRECTS) -> Column:
    """An attempt that yields a usable capture: status below 400, fewer
    redirects than the limit, and enough content for its method."""
    return ((F.col(status) < 400) & (F.col(redirects) < max_redirects)
            & big_enough(html, min_chars_for(method)))


def is_challenge(url, html, scan_chars: int | None = None) -> Column:
    """Interstitial / bot-challenge page: a challenge host, or a marker in
    the page (case-insensitive).  The whole page is searched unless ``scan_chars``
    asks for its beginning only (``CHALLENGE_SCAN_CHARS`` is the usual window)."""
    host = F.lower(U.host_of(url))
    page = _c(html)
    head = F.lower(page if scan_chars is None else F.substring(page, 1, scan_chars))
    hit = F.lit(False)
    for h in CHALLENGE_HOSTS:
        hit = hit | host.contains(h)
    for m in CHALLENGE_MARKERS:
        hit = hit | F.coalesce(head.contains(m), F.lit(False))
    return hit


def flag_challenge_pages(df: DataFrame, url: str = "url", html: str = "html",
                         scan_chars: int | None = None) -> DataFrame:
    return df.withColumn("challenge", is_challenge(url, html, scan_chars))


# -- selection ----------------------------------------------------------------

def first_successful_attempt(attempts: DataFrame, key: str = "url", order: str = "ord",
                             ok: Column | None = None, carry=()) -> DataFrame:
    """Per ``key``, the lowest-``order`` acceptable attempt.  ``carry`` lists
    columns of the winning attempt to keep (keep ``html`` out unless
    needed: it would travel through the shuffle)."""
    if ok is None:
        ok = acceptable(method="method" if "method" in attempts.columns else None)
    cols = [order, *carry]
    win = F.min_by(F.struct(*cols), F.col(order))
    return (attempts.filter(ok).groupBy(key).agg(win.alias("w"))
            .select(key, *[F.col("w")[c].alias(c) for c in cols]))


def latest_captures(writes: DataFrame, url: str = "url", order: str = "ord", carry=()) -> DataFrame:
    """Upsert semantics of the capture store: per ``md5(url)`` the last
    write wins."""
    cols = [url, order, *carry]
    return (writes.withColumn("key", U.capture_key(F.col(url)))
            .groupBy("key").agg(F.max_by(F.struct(*cols), F.col(order)).alias("w"))
            .select("key", *[F.col("w")[c].alias(c) for c in cols]))


def cache_lookup(urls: DataFrame, cache: DataFrame, url: str = "url", carry=("html",)) -> DataFrame:
    """Left join URLs to the capture store on ``md5(url)``; the capture is
    attributed to the requested URL.  Adds ``cached`` and ``carry``.  A cache with a
    column ``key`` is joined on that: bucketed by it (:class:`webloom.sources.store.
    KeyedStore`), its captures stay where they are and only the URLs move."""
    key = F.col("key") if "key" in cache.columns else U.capture_key(F.col(url))
    c = cache.select(key.alias("key"), *carry)
    return (urls.withColumn("key", U.capture_key(F.col(url)))
            .join(c, "key", "left")
            .withColumn("cached", F.col(carry[0]).isNotNull() if carry else F.lit(None))
            .drop("key"))


def fetch_captures(frontier: DataFrame, captures: DataFrame, url: str = "url") -> DataFrame:
    """Frontier URL -> captured content (inner equi join on the URL)."""
    return frontier.join(captures, url, "inner")


def match_variants(urls: DataFrame, captures: DataFrame, url: str = "url") -> DataFrame:
    """For URLs without a capture, the first of their variants that has one.
    Adds ``rank`` (from 1) and ``variant``; URLs that no variant helps are left
    out, as are those captured under their own name.  Null URLs match nothing."""
    store = captures.select(F.col(url).alias("variant")).distinct()
    missing = urls.join(store.withColumnRenamed("variant", url), url, "left_anti")
    # a SQL function can't stand inside a generator
    tried = missing.withColumn("_all", U.url_variants(F.col(url))).select(
        *urls.columns, F.posexplode("_all").alias("rank", "variant"))
    hits = tried.join(store, "variant", "left_semi")
    best = F.min_by(F.struct("rank", "variant"), F.col("rank")).alias("_b")
    return hits.groupBy(*urls.columns).agg(best).select(
        *urls.columns, (F.col("_b.rank") + 1).alias("rank"), F.col("_b.variant").alias("variant"))


def redirect_map(attempts: DataFrame, url: str = "url", final: str = "final_url") -> DataFrame:
    """``(from_url, to_url)`` wherever a capture's final URL differs; one
    row per ``from_url`` (the last recorded wins)."""
    moved = attempts.filter(F.col(final) != F.col(url))
    if "ord" in attempts.columns:
        agg = F.max_by(F.col(final), F.col("ord"))
    else:
        agg = F.max(F.col(final))
    return moved.groupBy(F.col(url).alias("from_url")).agg(agg.alias("to_url"))


def resolve_redirects(urls: DataFrame, redirects: DataFrame, url: str = "url") -> DataFrame:
    """One hop through the redirect map: adds ``resolved``."""
    return (urls.join(redirects, urls[url] == redirects["from_url"], "left")
            .withColumn("resolved", F.coalesce(F.col("to_url"), F.col(url)))
            .drop("from_url", "to_url"))


def redirect_closure(redirects: DataFrame, limit: int = MAX_REDIRECTS) -> DataFrame:
    """Where each redirect leads in the end: ``(from_url, to_url, hops, state)``.
    ``state`` is ``ok``, ``too_many`` (``limit`` hops or more) or ``loop``, whose
    ``to_url`` and ``hops`` are null.  Of several targets of a URL the largest counts;
    rows without one of the URLs, or from a URL to itself, are no redirects.

    Pointer doubling: every URL first knows its next hop, and takes over its target's
    knowledge round by round, so a chain of n hops takes log2(n) rounds.  A round that
    ends no chain shows that the rest are loops: a chain's own URLs are chains of
    every shorter length, so some of them would have ended.  Each round is written
    to the checkpoint folder; the driver sees two counts a round.  A target that many
    URLs share is a skewed join side, which adaptive execution splits."""
    spark = redirects.sparkSession
    base = scratch_dir(spark, "redirects")
    hop = redirects.where("from_url <> to_url").groupBy("from_url").agg(F.max("to_url").alias("at"))
    sources = hop.select(F.col("from_url").alias("_source"))
    state = hop.join(sources, F.col("at") == F.col("_source"), "left").select(
        "from_url", "at", F.lit(1).cast("long").alias("hops"), F.col("_source").isNull().alias("ended"))
    is_open, n = -1, 0
    while True:
        path = f"{base}/round={n}"
        state.write.parquet(path)
        state = spark.read.schema(state.schema).parquet(path)
        left = state.where("not ended").count()
        if left in (0, is_open):
            break
        is_open, n = left, n + 1
        jump = state.select(F.col("from_url").alias("_via"), F.col("at").alias("_at"), F.col("hops").alias("_hops"),
                            F.col("ended").alias("_ended"))
        moved = state.where("not ended").join(jump, F.col("at") == F.col("_via")).select(
            "from_url", F.col("_at").alias("at"), (F.col("hops") + F.col("_hops")).alias("hops"), F.col("_ended").alias("ended"))
        state = state.where("ended").unionByName(moved)
    why = F.when(~F.col("ended"), "loop").when(F.col("hops") >= limit, "too_many").otherwise("ok")
    return state.select("from_url", F.when(F.col("ended"), F.col("at")).alias("to_url"),
                        F.when(F.col("ended"), F.col("hops")).alias("hops"), why.alias("state"))


def follow_redirects(urls: DataFrame, closure: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``resolved``, ``hops`` and ``state`` from a :func:`redirect_closure`; a URL
    that isn't redirected is resolved to itself with no hops, one in a loop or behind
    too many hops to null."""
    c = closure.select(F.col("from_url").alias("_from"), F.col("to_url").alias("_to"), F.col("hops").alias("_hops"), "state")
    out = urls.join(c, F.col(url) == F.col("_from"), "left")
    state = F.coalesce("state", F.lit("ok"))
    resolved = F.when(F.col("_from").isNull(), F.col(url)).when(state == "ok", F.col("_to"))
    hops = F.when(F.col("_from").isNull(), F.lit(0)).otherwise(F.col("_hops"))
    return out.select(*urls.columns, resolved.alias("resolved"), hops.cast("long").alias("hops"), state.alias("state"))


# -- failures -------------------------------------------------------------------

def failures_per_host(outcomes: DataFrame, url: str = "url", failed: str = "failed",
                      threshold: int = MAX_HOST_FAILURES) -> DataFrame:
    """Failures per host with the skip decision (``>= threshold``)."""
    return (outcomes.groupBy(U.host_of(F.col(url)).alias("host"))
            .agg(F.sum(F.col(failed).cast("long")).alias("failures"))
            .withColumn("skip", F.col("failures") >= threshold))


def exclude_failed(urls: DataFrame, failed_urls: DataFrame, failed_hosts: DataFrame,
                   url: str = "url") -> DataFrame:
    """Drop URLs on the failed list and URLs whose host is on the failed-host
    list (two anti joins; the host list is small and AQE broadcasts it when
    its measured size allows)."""
    u = urls.join(failed_urls.select(F.col(url)), url, "left_anti")
    u = u.withColumn("_host", U.host_of(F.col(url)))
    return (u.join(failed_hosts.select(F.col("host").alias("_host")), "_host", "left_anti")
            .drop("_host"))


def pages_per_host(pages: DataFrame, url: str = "url") -> DataFrame:
    return pages.groupBy(U.host_of(F.col(url)).alias("host")).agg(F.count(F.lit(1)).alias("pages"))
