"""Crawl policy: robots rules, per-host caps, politeness schedule
(#42, #43, #47, #49)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import urls as U
from ..functions.text import py_strip
from ..session import ensure_checkpoint_dir
from .lines import split_lines


# -- robots ---------------------------------------------------------------------

def parse_robots(robots: DataFrame, host: str = "host", body: str = "body") -> DataFrame:
    """``(host, body)`` -> ``(host, prefix)``: every ``Disallow:`` line (any
    case) with a non-empty path; user-agent groups, ``Allow`` and wildcards
    are not interpreted."""
    lines = robots.select(F.col(host).alias("host"), F.explode(split_lines(F.col(body))).alias("line"))
    rules = lines.filter(F.lower(F.col("line")).startswith("disallow:"))
    rules = rules.select("host", py_strip(F.regexp_extract("line", r"(?s)^[^:]*:(.*)$", 1)).alias("prefix"))
    return rules.filter(F.col("prefix") != "")


def robots_index(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rules as an index: ``(host, prefix)`` without the rules that a shorter one of
    their host implies, and ``(host, lengths)``, the distinct lengths of what is left.
    At most one prefix of a path is in it.  A host's rules, those of one robots file, make
    one row on the way.  A ``/`` rule blocks the whole host, paths
    without a slash included, so it is the empty prefix."""
    whole = F.when(F.col("prefix") == "/", "").otherwise(F.col("prefix"))
    r = rules.filter("host is not null and prefix is not null").groupBy("host").agg(F.collect_set(whole).alias("all"))
    # in string order, what a rule implies comes right behind it
    first = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(None).cast("string").alias("last"))

    def keep(done, prefix):
        more = F.struct(F.concat(done["kept"], F.array(prefix)).alias("kept"), prefix.alias("last"))
        return F.when(prefix.startswith(done["last"]), done).otherwise(more)

    r = r.select("host", F.aggregate(F.array_sort("all"), first, keep, lambda done: done["kept"]).alias("kept"))
    free = r.select("host", F.explode("kept").alias("prefix"))
    return free, r.select("host", F.array_sort(F.array_distinct(F.transform("kept", F.length))).alias("lengths"))


def blocked_by_robots(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Rows whose URL some robots prefix blocks.  A URL is looked up by its path's
    beginnings of the lengths that rules of its host have: equi joins only, and the
    work doesn't grow with a host's rules times its URLs."""
    free, lengths = robots_index(rules)
    u = urls.withColumn("_host", U.host_of(F.col(url))).withColumn("_path", U.url_path(F.col(url)))
    u = u.join(lengths.select(F.col("host").alias("_host"), "lengths"), "_host")
    u = u.withColumn("_lengths", F.filter("lengths", lambda n: n <= F.length("_path")))
    u = u.select(*urls.columns, "_host", "_path", F.explode("_lengths").alias("_n"))
    u = u.withColumn("_prefix", F.expr("substring(_path, 1, _n)"))
    hit = u.join(free.select(F.col("host").alias("_host"), F.col("prefix").alias("_prefix")), ["_host", "_prefix"], "left_semi")
    return hit.select(*urls.columns)


def exclude_robots(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Rows whose URL no robots prefix blocks (a ``/`` rule blocks the whole host).
    Whether a URL is blocked depends on the URL alone."""
    blocked = blocked_by_robots(urls.select(url), rules, url)
    return urls.join(blocked, url, "left_anti").select(*urls.columns)


# -- caps ------------------------------------------------------------------------

LIMIT_SPREAD = 64


def limit_per_group(df: DataFrame, group, order, n: int) -> DataFrame:
    """At most ``n`` rows per group, first by ``order``.

    Spark keeps the first ``n`` rows of a group in each map task before the
    shuffle.  The rows that the map tasks kept of one group are then cut in
    ``LIMIT_SPREAD`` tasks, by the partition they come from, before they meet:
    the last task sees at most ``LIMIT_SPREAD * n`` rows however many map tasks
    there were.  The spread doesn't show in the result."""
    part = Window.partitionBy(*group, "_part").orderBy(*order)
    whole = Window.partitionBy(*group).orderBy(*order)
    d = df.withColumn("_part", F.spark_partition_id() % LIMIT_SPREAD)
    for w in (part, whole):
        d = d.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    return d.drop("_rn", "_part")


def limit_per_host(df: DataFrame, n: int, url: str = "url", order=None) -> DataFrame:
    """At most ``n`` pages per host (``host_of(url)``), ordered by ``order``
    (default: the URL)."""
    d = df.withColumn("host", U.host_of(F.col(url)))
    return limit_per_group(d, ["host"], order or [F.col(url)], n)


# -- politeness -------------------------------------------------------------------

def epoch_micros(df: DataFrame, ts: str) -> F.Column:
    """Microseconds since the epoch; a zone-less timestamp is read as UTC
    whatever the session time zone is."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")
    return F.unix_micros(F.col(ts))


def politeness_schedule(arrivals: DataFrame, delay_us: int, host: str = "host",
                        ts: str = "ts", tie: str = "event_id",
                        partitions: int | None = None, last: DataFrame | None = None) -> DataFrame:
    """Start time of every request when each host admits one request per
    ``delay_us``: ``start_i = max(arrival_i, start_{i-1} + delay)`` in
    ``(ts, tie)`` order, the first request starting at once.

    Closed form: ``start_i = max_{j<=i}(a_j - j*d) + i*d``.  It is computed
    as a distributed prefix scan so that a host holding a large share of
    all rows is still split over many tasks:

    1. range-partition on ``(host, ts, tie)`` - range bounds are sampled on
       the full key, so a hot host spans several balanced partitions;
    2. per (partition, host) chunk: local row numbers and running maxima;
    3. a small per-chunk summary gives each chunk its row offset and the
       best value of earlier chunks of the same host;
    4. put the summary of the chunks that continue a host back to their rows.

    The per-chunk scan (steps 1-2) is checkpointed once and read by both
    step 3 and step 4, so the large shuffles run a single time.  The rows are
    not shuffled for step 4: a range partition continues at most the one host
    that the partition before it ended with, so there is no more than a row
    per partition to broadcast, whatever the input.

    ``last`` ``(host, last_start_us)`` continues an earlier schedule: a host's last
    start goes before its requests as one that arrives and starts then, which is what
    the rule asks for (``rn`` counts it).

    Returns ``(tie, host, arrival_us, rn, start_us)``.
    """
    spark = arrivals.sparkSession
    p = partitions or max(spark.sparkContext.defaultParallelism,
                          int(spark.conf.get("spark.sql.shuffle.partitions")))
    d = F.lit(int(delay_us)).cast("long")
    a = arrivals.select(F.col(tie), F.col(host).alias("host"),
                        epoch_micros(arrivals, ts).alias("arrival_us"))
    order = ["arrival_us", tie]
    if last is not None:
        asked = a.select(F.col("host").alias("_host")).distinct()
        go_on = last.join(asked, F.col("host").eqNullSafe(F.col("_host")), "left_semi").select(
            F.lit(None).cast(a.schema[tie].dataType).alias(tie), "host", F.col("last_start_us").alias("arrival_us"),
            F.lit(0).alias("own"))
        a = a.withColumn("own", F.lit(1)).unionByName(go_on)
        order = ["own", *order]
    ranged = a.repartitionByRange(p, "host", *order).withColumn(
        "chunk", F.spark_partition_id())
    w_local = Window.partitionBy("chunk", "host").orderBy(*order)
    local = (ranged.withColumn("lrn", F.row_number().over(w_local).cast("long"))
             .withColumn("lv", F.col("arrival_us") - F.col("lrn") * d)
             .withColumn("lmax", F.max("lv").over(w_local.rowsBetween(Window.unboundedPreceding, 0))))
    # Both the per-chunk summary and the final join read this scan.  The
    # chunk id is non-deterministic to Catalyst, so the two branches would
    # not share an exchange: materialise it once in the reliable checkpoint
    # directory (this also cuts lineage before the small second phase).
    ensure_checkpoint_dir(spark)
    local = local.checkpoint(eager=True)
    summary = local.groupBy("chunk", "host").agg(
        F.count(F.lit(1)).alias("cnt"), F.max("lv").alias("cmax"))
    w_host = Window.partitionBy("host").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    summary = (summary.withColumn("offset", F.coalesce(F.sum("cnt").over(w_host), F.lit(0)))
               # best (a_j - j*d) of this chunk in host-global row numbers
               .withColumn("gmax", F.col("cmax") - F.col("offset") * d))
    summary = summary.withColumn("prev_max", F.max("gmax").over(w_host)).select(
        F.col("chunk").alias("s_chunk"), F.col("host").alias("s_host"), "offset", "prev_max")
    carried = summary.filter("offset > 0")          # at most p rows
    # null-safe: requests without a host share one schedule
    j = local.join(F.broadcast(carried), (F.col("chunk") == F.col("s_chunk"))
                   & F.col("host").eqNullSafe(F.col("s_host")), "left")
    before = F.coalesce("offset", F.lit(0))
    rn = before + F.col("lrn")
    # greatest() skips the null prev_max of a host's first chunk
    best = F.greatest(F.col("lmax") - before * d, F.col("prev_max"))
    if last is not None:
        j = j.where("own = 1")
    return j.select(tie, "host", "arrival_us", rn.alias("rn"), (best + rn * d).alias("start_us"))


def politeness_schedule_windowed(arrivals: DataFrame, delay_us: int, host: str = "host",
                                 ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """Single-window form of :func:`politeness_schedule` (one task per host);
    kept as the reference formulation for tests."""
    d = F.lit(int(delay_us)).cast("long")
    a = arrivals.select(F.col(tie), F.col(host).alias("host"), F.col(ts),
                        epoch_micros(arrivals, ts).alias("arrival_us"))
    a = a.withColumn("rn", F.row_number().over(Window.partitionBy("host").orderBy(ts, tie)).cast("long"))
    m = F.max(F.col("arrival_us") - F.col("rn") * d).over(
        Window.partitionBy("host").orderBy("rn").rowsBetween(Window.unboundedPreceding, 0))
    return a.select(tie, "host", "arrival_us", "rn", (m + F.col("rn") * d).alias("start_us"))
