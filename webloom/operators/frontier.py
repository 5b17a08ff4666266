"""Frontier and traversal (#38, #41, #52-#59): breadth-first crawls over a
link graph held as an edge table.

The traversal is level-synchronous: each level is one join of the new
frontier with the edge table, an anti join against everything visited, and
a reliable checkpoint that cuts the lineage (the plan would otherwise grow
with every level).  All seeds advance together in the same jobs; the
driver only loops over depth levels and never sees URLs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import urls as U
from ..session import scratch_dir
from ..sources.store import default_buckets, open_parts, write_part
from .policy import limit_per_group

# Crawl defaults.
DEFAULT_MAX_DEPTH = 5
DEFAULT_MAX_URLS = 5000

# From so many followable edges on, visited pages are stored in buckets: below, what
# they save is less than a level's bucket files cost.
BUCKET_EDGES = 10_000_000


def follow_edges(edges: DataFrame, src: str = "src", dst: str = "dst", page: str | None = None) -> DataFrame:
    """Edges a crawl follows: internal to the source page's host and
    pointing at a page-like URL; targets normalised, duplicates removed.
    ``page`` names the column that identifies a source whose links resolve
    against another URL, ``src`` (after a redirect)."""
    e = edges.select(F.col(page or src).alias("page"), F.col(src).alias("src"), F.col(dst).alias("raw"))
    # one generator row per edge: the filter stays above it, so the URL
    # expressions are evaluated once per edge
    e = e.select("page", F.inline(F.array(F.expr(U.follow_target_sql("src", "raw")))))
    return e.filter("ok").select(F.col("page").alias("src"), "dst").dropDuplicates(["src", "dst"])


def unseen(candidates: DataFrame, seen: DataFrame, keys=("seed", "url")) -> DataFrame:
    """Queue-time de-duplication: candidates not already seen, once each."""
    return candidates.dropDuplicates(list(keys)).join(seen.select(*keys), list(keys), "left_anti")


def _write_level(df: DataFrame, path: str, name: str, keys=None, buckets: int = 0):
    """Write one BFS level as a table in the shared checkpoint folder and read
    it back: the lineage is cut and a lost executor recovers from here.  The
    row count is observed during the same write (no extra job).  With ``keys``, the
    rows come clustered by them and are written in buckets."""
    obs = Observation(name)
    df = df.observe(obs, F.count(F.lit(1)).alias("urls"))
    if keys:
        write_part(df, path, keys, buckets)
    else:
        df.write.mode("overwrite").parquet(path)
    # the schema is known: no footer reads to infer it again
    return df.sparkSession.read.schema(df.schema).parquet(path), obs.get["urls"]


def next_level(level: DataFrame, edges: DataFrame, visited: DataFrame) -> DataFrame:
    """``(seed, url)`` that the links of a level lead to for the first time.  If
    ``visited`` is stored in buckets by seed and URL, which is how new URLs are brought
    together, it is read where it lies; edges meet the level by an ordinary join, of which
    Spark splits a page that many seeds are at or that has many links."""
    return (level.select("seed", F.col("url").alias("src")).join(edges, "src")
            .select("seed", F.col("dst").alias("url"))
            .dropDuplicates(["seed", "url"])
            .join(visited, ["seed", "url"], "left_anti"))


def _within_budget(found: DataFrame, visited: DataFrame, max_urls: int) -> DataFrame:
    """The first new URLs of each seed that its budget still has room for."""
    spent = visited.groupBy("seed").agg(F.count(F.lit(1)).alias("_spent"))
    first = limit_per_group(found, ["seed"], ["url"], max_urls).join(spent, "seed", "left")
    rank = F.row_number().over(Window.partitionBy("seed").orderBy("url"))
    return (first.withColumn("_rn", rank)
            .filter(F.col("_rn") + F.coalesce(F.col("_spent"), F.lit(0)) <= max_urls).drop("_rn", "_spent"))


PAGE = ["seed", "url"]         # what a visit is known by

# Why a visited page wasn't fetched; the first rule that stops it counts.
STOPS = ("failed_host", "host_cap", "failed_url", "robots", "blocked", "no_capture")


def _gate(captured: DataFrame | None, blocked: DataFrame | None, url: str) -> DataFrame | None:
    """``(url, _stop)`` of every URL that the fetch gate knows: why it can't be
    fetched, null if it can."""
    parts = []
    if captured is not None:
        parts.append(captured.select(F.col(url).alias("url"), F.lit(len(STOPS)).alias("_rule")))
    if blocked is not None:
        why = F.coalesce(F.col("reason"), F.lit("blocked")) if "reason" in blocked.columns else F.lit("blocked")
        rule = F.coalesce(F.array_position(F.array(*map(F.lit, STOPS)), why), F.lit(STOPS.index("blocked") + 1))
        parts.append(blocked.select(F.col(url).alias("url"), (rule - 1).cast("int").alias("_rule")))
    if not parts:
        return None
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # the number of the first rule that applies; a hash aggregate, as the buffer is a number
    first = rows.groupBy("url").agg(F.min("_rule").alias("_rule"))
    return first.select("url", F.get(F.array(*map(F.lit, STOPS)), F.col("_rule")).alias("_stop"), F.lit(True).alias("_known"))


def _stopped(found: DataFrame, gate: DataFrame | None, all_captured: bool, failed_hosts: DataFrame | None) -> DataFrame:
    """Adds ``host`` and ``reason`` (null: can be fetched) to URLs of a level."""
    rows, reason = found.withColumn("host", U.host_of(F.col("url"))), F.lit(None).cast("string")
    if gate is not None:
        rows = rows.join(gate, "url", "left")
        known = F.coalesce(F.col("_known"), F.lit(False))
        reason = F.col("_stop") if all_captured else F.when(known, F.col("_stop")).otherwise("no_capture")
    if failed_hosts is not None:
        rows = rows.join(failed_hosts.select(F.col("host").alias("_fh")).distinct(), F.col("host") == F.col("_fh"), "left")
        reason = F.when(F.col("_fh").isNotNull(), "failed_host").otherwise(reason)
    return rows.select(*found.columns, "host", reason.alias("reason"))


def _within_cap(rows: DataFrame, spent: DataFrame | None, cap: int, write) -> tuple[DataFrame, DataFrame]:
    """Applies the host counters to a level.  Of a host's URLs that can be fetched,
    in ``(seed, url)`` order, the first that its counter has room for are fetched;
    from then on the host is full, and every URL behind stops at ``host_cap``.
    Returns the level and the counters ``(host, _n, _last)`` after it; ``_last`` is
    the host's last page of this level.

    The prefix is counted in two stages: at most ``cap`` rows of a host leave a map
    task, and they are cut again in ``LIMIT_SPREAD`` tasks before they meet."""
    order = [F.col("seed"), F.col("url")]
    first = limit_per_group(rows.where("reason is null").select("seed", "url", "host"), ["host"], order, cap)
    rank = F.row_number().over(Window.partitionBy("host").orderBy(*order))
    first = first.withColumn("_rn", rank)
    if spent is not None:
        first = first.join(spent.select("host", "_n"), "host", "left").where(F.col("_rn") + F.coalesce("_n", F.lit(0)) <= cap)
    new = first.groupBy("host").agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct(*order)).alias("_last"))
    if spent is not None:
        old = spent.select("host", "_n", F.lit(None).cast(new.schema["_last"].dataType).alias("_last"))
        new = old.unionByName(new).groupBy("host").agg(F.sum("_n").alias("_n"), F.max("_last").alias("_last"))
    spent = write(new, "hosts")
    full = spent.where(F.col("_n") >= cap).select(F.col("host").alias("_full"), "_last")
    behind = F.lit(cap < 1) | F.col("_full").isNotNull() & (F.col("_last").isNull() | (F.struct(*order) > F.col("_last")))
    reason = F.when(behind & (F.coalesce("reason", F.lit("")) != "failed_host"), "host_cap").otherwise(F.col("reason"))
    level = rows.join(full, F.col("host") == F.col("_full"), "left").withColumn("reason", reason)
    return level.drop("_full", "_last"), spent


def crawl(seeds: DataFrame, edges: DataFrame, captured: DataFrame | None = None,
          max_depth: int = DEFAULT_MAX_DEPTH, seed: str = "seed", url: str = "url",
          stats: list | None = None, blocked: DataFrame | None = None,
          max_urls: int | None = None, max_per_host: int | None = None,
          failed_hosts: DataFrame | None = None, bucket_edges: int = BUCKET_EDGES) -> DataFrame:
    """Breadth-first traversal from every seed.

    ``seeds``: ``(seed, url)`` with ``url`` already normalised; ``edges``:
    followable ``(src, dst)`` (see :func:`follow_edges`); ``captured``:
    URLs with a usable capture - a page without one is visited but not
    expanded (``None`` means every page is captured).

    Returns ``(seed, url, depth, fetched, reason)``; every URL keeps its smallest
    depth, pages are expanded only if fetched and while ``depth < max_depth``, and
    ``reason`` names the first rule (of :data:`STOPS`) that kept a page from being
    fetched.  When a list is passed as ``stats``, ``(depth, new_urls)`` is appended
    per level.  ``blocked`` URLs (robots rules, the failed list; an optional column
    ``reason`` tells which) and URLs of ``failed_hosts`` ``(host)`` are visited but
    never fetched.  ``max_urls`` is each seed's budget: levels
    are cut to it as they are found, in URL order, so no more than seeds times
    budget rows are ever written.  That equals :func:`limit_total` of the whole
    traversal, as every page before the cut was fully expanded.  ``max_per_host``
    is the number of pages that all seeds together fetch from a host: a table of
    host counters is carried from level to level, and within a level pages are
    fetched in ``(seed, url)`` order; pages of a full host are visited only.

    Plan shape: the edges of captured sources are written as a table once.
    Each level joins it as a plain scan on ``src``: Spark broadcasts a frontier
    that it measured small, and splits a page that holds a large share of the
    edges.  Each level is written as a table under the reliable checkpoint
    directory, which keeps lineage and plans flat and lets a lost executor be
    recovered from the last level instead of from the seeds.  On a graph of
    ``bucket_edges`` or more, levels lie in buckets by (seed, url), so a level moves its
    own new URLs and never those visited before (:func:`next_level`).  The driver loops
    over depth levels only.
    """
    spark = seeds.sparkSession
    base, buckets = scratch_dir(spark, "crawl"), default_buckets(spark)
    e = edges.select("src", "dst")
    if captured is not None:
        e = e.join(captured.select(F.col(url).alias("src")).distinct(), "src", "left_semi")
    if blocked is not None:
        e = e.join(blocked.select(F.col(url).alias("src")).distinct(), "src", "left_anti")
    e, n_edges = _write_level(e, f"{base}/edges", "crawl_edges")
    keys = PAGE if n_edges >= bucket_edges else None
    gate, hosts = _gate(captured, blocked, url), None
    # only a host's state decides which pages go on; the rest can wait for the end
    inside = max_per_host is not None or failed_hosts is not None
    if inside and gate is not None:
        gate.write.parquet(f"{base}/gate")
        gate = spark.read.schema(gate.schema).parquet(f"{base}/gate")

    def store(found: DataFrame, d: int):
        nonlocal hosts
        rows = found.withColumn("depth", F.lit(d))
        if inside:
            rows = _stopped(rows, gate, captured is None, failed_hosts)
            if max_per_host is not None:
                rows, _ = _write_level(rows, f"{base}/asked={d}", f"crawl_asked_{d}")
                rows, hosts = _within_cap(rows, hosts, max_per_host, lambda df, name: _write_level(
                    df, f"{base}/{name}={d}", f"crawl_{name}_{d}")[0])
            rows = rows.drop("host")
        if keys and (inside or max_urls is not None or d == 0):
            rows = rows.repartition(buckets, *PAGE)     # as the new URLs of a plain level already are
        level, n = _write_level(rows.drop("depth"), f"{base}/levels/depth={d}", f"crawl_level_{d}", keys, buckets)
        if stats is not None:
            stats.append((d, n))
        return level.withColumn("depth", F.lit(d)), n

    start = (seeds.select(F.col(seed).alias("seed"), F.col(url).alias("url"))
             .filter(F.col("url").isNotNull()).dropDuplicates(["seed", "url"]))
    if max_urls is not None:
        start = limit_per_group(start, ["seed"], ["url"], max_urls)
    level, n = store(start, 0)
    for d in range(max_depth):
        go_on = level.where("reason is null") if inside else level
        visited = (open_parts(spark, f"{base}/levels", level.drop("depth").schema, PAGE, buckets, "depth", range(d + 1))
                   if keys else spark.read.schema(level.schema).parquet(f"{base}/levels"))
        found = next_level(go_on, e, visited.select(*PAGE))
        if max_urls is not None:
            found = _within_budget(found, visited, max_urls)
        level, n = store(found, d + 1)
        if n == 0:
            break
    out = spark.read.schema(level.schema).parquet(f"{base}/levels")
    if not inside:
        out = _stopped(out, gate, captured is None, None)
    return out.select("seed", "url", "depth", F.col("reason").isNull().alias("fetched"), "reason")


def limit_total(visited: DataFrame, max_urls: int) -> DataFrame:
    """Budget: the first ``max_urls`` visits per seed in ``(depth, url)``
    order - equal to stopping a FIFO crawl once that many pages were
    visited, because every page before the cut was fully expanded."""
    return limit_per_group(visited, ["seed"], ["depth", "url"], max_urls)


def _limit_fetched(visited: DataFrame, group, order, max_urls: int) -> DataFrame:
    d = visited.withColumn("host", U.host_of(F.col("url")))
    first = limit_per_group(d.filter("fetched"), group, order, max_urls)
    return first.unionByName(d.filter(~F.col("fetched")))


def limit_per_seed_host(visited: DataFrame, max_urls: int) -> DataFrame:
    """Per (seed, host): at most ``max_urls`` fetched pages in
    ``(depth, url)`` order; pages that were not fetched are kept."""
    return _limit_fetched(visited, ["seed", "host"], ["depth", "url"], max_urls)


def limit_shared_host(visited: DataFrame, max_urls: int) -> DataFrame:
    """Per host, over all seeds together: at most ``max_urls`` fetched pages in
    ``(depth, seed, url)`` order; pages that were not fetched are kept.  This cuts a
    finished traversal; what a cap keeps a crawl from finding is decided inside it
    (``max_per_host`` of :func:`crawl`)."""
    return _limit_fetched(visited, ["host"], ["depth", "seed", "url"], max_urls)


def rule_counts(visited: DataFrame) -> DataFrame:
    """Per seed: visited pages by the rule that stopped them (``fetched`` if none
    did); the counts of a seed add up to what it visited."""
    return visited.groupBy("seed", F.coalesce("reason", F.lit("fetched")).alias("rule")).agg(
        F.count(F.lit(1)).alias("urls"))


def unfetched(visited: DataFrame) -> DataFrame:
    """The frontier left: URLs that were queued but have no fetched page."""
    return visited.filter(~F.col("fetched")).select("seed", "url", "depth")


def crawl_summary(visited: DataFrame) -> DataFrame:
    """Per seed and depth: pages visited and pages fetched."""
    return visited.groupBy("seed", "depth").agg(
        F.count(F.lit(1)).alias("visited"),
        F.sum(F.col("fetched").cast("long")).alias("fetched"))


def links_per_page(links: DataFrame, keys=("page_id",)) -> DataFrame:
    """Number of distinct valid internal links found per page."""
    return (links.filter(U.is_page_url(F.col("dst")))
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("links")))
