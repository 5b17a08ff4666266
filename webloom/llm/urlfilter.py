"""URL filtering by dated lists: a temporal list join.

List entries are dated: on a day an entry is added to or removed from a list.
The entries of one (list, kind, value) become validity intervals, from an
addition to the next removal.  A capture is matched by equality on what its URL
could be listed as (its host, every parent domain, every path prefix as deep as
the lists go) and by the interval that holds its fetch time: an as-of join, as
at most one interval of an entry holds at a time.

Intervals are also dealt by calendar month, so a key that has been listed and
delisted often meets a capture only within a month, and the equi-join on (kind,
value, month) leaves a host that holds a third of all captures to be split.
Entries that repeat on a day are one, so an entry has at most a change a day.

The most specific active entry decides: a path prefix before a host before a
domain, the longer before the shorter, an allow list before a block list.

Defined cases: a null or unparsable URL matches nothing and isn't blocked; a
null fetch time neither; an addition and a removal on the same day leave the
entry listed; entries with nulls are ignored; repeated captures are all
returned; empty tables give an empty result or nothing blocked; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import table
from .common import saved

RANK = {"domain": 1, "host": 2, "prefix": 3}


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-case host, without user and port, and path, without query."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    return host, F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def intervals(entries: DataFrame) -> DataFrame:
    """``(list, allow, kind, value, since, until)`` of entries ``(list, allow, kind, value,
    listed_on, added)``; until is exclusive and null while the entry stands."""
    key = ["list", "allow", "kind", "value"]
    days = entries.where(" and ".join(f"{c} is not null" for c in (*key, "listed_on", "added"))).groupBy(
        *key, "listed_on").agg(F.max("added").alias("added"))
    order = Window.partitionBy(*key).orderBy("listed_on")
    changes = days.withColumn("was", F.lag("added").over(order)).where("was is null or was <> added")
    return changes.withColumn("until", F.lead("listed_on").over(order)).where("added").select(
        *key, F.col("listed_on").alias("since"), "until")


def _keys(host: Column, path: Column, depth: int) -> Column:
    """What a URL may be listed as: structs ``(kind, value)``."""
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
        F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, n), ".").alias("value")))
    steps = F.slice(F.split(path, "/", -1), 2, max(1, depth))
    prefixes = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(steps))), lambda i: F.struct(
        F.lit("prefix").alias("kind"), F.concat(host, F.lit("/"), F.array_join(F.slice(steps, 1, i), "/")).alias("value")))
    whole = F.array(F.struct(F.lit("host").alias("kind"), host.alias("value")))
    return F.array_distinct(F.concat(whole, domains, prefixes) if depth else F.concat(whole, domains))


def by_month(valid: DataFrame, rows: DataFrame) -> DataFrame:
    """Intervals once for each month that they reach and that has captures (``at``): as
    many as the calendar has at most."""
    months = rows.where("at is not null").select(_month(F.col("at")).alias("m")).distinct().orderBy("m").toPandas()["m"]
    until = F.coalesce(_month(F.date_sub("until", 1)), F.lit(1 << 30))
    return valid.withColumn("month", F.explode(F.filter(
        F.lit(months.to_numpy("int32")), lambda m: (m >= _month(F.col("since"))) & (m <= until))))


def filter_captures(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
                    time_col: str = "fetched_at") -> DataFrame:
    """Every capture's ``(<id_col>, blocked, n_active, list, kind, value)``: how many
    entries are active on its URL at its fetch time, and the one that decides."""
    host, path = host_and_path(F.col(url_col).cast("string"))
    rows = saved(captures.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
                                 host.alias("host"), path.alias("path"), F.col(time_col).alias("at")), "urls-captures")
    valid = saved(intervals(entries), "urls-intervals")
    depth = valid.where("kind = 'prefix'").agg(F.max(F.size(F.split("value", "/", -1)) - 1)).first()[0] or 0
    listed = by_month(valid, rows)
    listed = listed.withColumnsRenamed({"kind": "l_kind", "value": "l_value", "month": "l_month"})
    asked = rows.where("host <> '' and at is not null").select(
        "rid", "at", _month(F.col("at")).alias("month"), F.inline(_keys(F.col("host"), F.col("path"), depth)))
    active = asked.join(listed, (F.col("kind") == F.col("l_kind")) & (F.col("value") == F.col("l_value"))
                        & (F.col("month") == F.col("l_month")) & (F.col("at") >= F.col("since"))
                        & (F.col("until").isNull() | (F.col("at") < F.col("until"))))
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(r)) for k, r in RANK.items()])
    found = active.groupBy(F.col("rid").alias("of")).agg(
        F.count(F.lit(1)).alias("n_active"),
        F.max(F.struct(rank.alias("rank"), F.char_length("value").alias("long"), "allow", "list", "kind", "value")).alias("top"))
    return rows.join(found, F.col("rid") == F.col("of"), "left").select(
        F.col("id").alias(id_col), F.coalesce(~F.col("top.allow"), F.lit(False)).alias("blocked"),
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.col("top.list").alias("list"), F.col("top.kind").alias("kind"), F.col("top.value").alias("value"))


# -- query: captures and dated lists derived from the pages table -------------------

# Text that Spark and DuckDB both read.
HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]+)', 1))"
STEP = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]*)', 1)"
DOMAIN = f"regexp_extract({HOST}, '([^.]+[.][^.]+)$', 1)"
NOISE = "(ascii(substr(md5(value), 1, 1)) * 11 + ascii(substr(md5(value), 2, 1)) * 7 + ascii(substr(md5(value), 3, 1)) * 29)"
LISTS = f"""
select 'hosts' as list, false as allow, 'host' as kind, {HOST} as value from pages
union select 'domains', false, 'domain', {DOMAIN} from pages
union select 'paths', false, 'prefix', concat({HOST}, '/', {STEP}) from pages
union select 'exempt', true, 'prefix', concat({HOST}, '/', {STEP}) from pages where {STEP} <> 'en'"""
# every entry is added, removed, and added once more; the days follow from its value
CHANGES = [(f"{NOISE} % 200", "true"), (f"{NOISE} % 200 + 20 + {NOISE} % 61", "false"), (f"{NOISE} % 200 + 90 + {NOISE} % 83", "true"),
           (f"{NOISE} % 200 + 190 + {NOISE} % 47", "false")]


def op8_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    captures = pages.select("page_id", "url", F.expr(
        "timestamp '2024-01-01 00:00:00' + make_dt_interval(cast(page_id % 366 as int), cast(page_id % 24 as int))"
    ).alias("fetched_at"))
    lists = spark.sql(LISTS.replace("from pages", "from {pages}"), pages=pages)
    changes = F.inline(F.array(*[F.struct(F.expr(f"cast({d} as int)").alias("day"), F.expr(a).alias("added"))
                                 for d, a in CHANGES]))
    entries = lists.select("list", "allow", "kind", "value", changes).select(
        "list", "allow", "kind", "value", F.expr("date_add(date '2024-01-01', day)").alias("listed_on"), "added")
    return filter_captures(captures, entries)


ORACLE = f"""
with lists as ({LISTS}),
changes as ({' union all '.join(f"select *, {d} as day, {a} as added from lists" for d, a in CHANGES)}),
days as (select list, allow, kind, value, date '2024-01-01' + cast(day as int) as day, bool_or(added) as added
         from changes where value is not null group by all),
spans as (select *, lead(day) over (partition by list, allow, kind, value order by day) as until from days),
captures as (select page_id, {HOST} as host, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) as path,
             timestamp '2024-01-01' + to_days(cast(page_id % 366 as int)) + to_hours(cast(page_id % 24 as int)) as seen from pages),
asked as (
  select page_id, seen, 'host' as kind, host as value from captures where host <> ''
  union select page_id, seen, 'domain', array_to_string(list_slice(string_split(host, '.'), i, 99), '.')
    from (select *, unnest(range(1, len(string_split(host, '.')) + 1)) as i from captures where host <> '')
  union select page_id, seen, 'prefix', concat(host, '/', split_part(path, '/', 2)) from captures where host <> ''),
active as (select page_id, {{'rank': case asked.kind when 'domain' then 1 when 'host' then 2 else 3 end,
             'long': length(asked.value), 'allow': allow, 'list': list, 'kind': asked.kind, 'value': asked.value}} as e
           from asked join spans on asked.kind = spans.kind and asked.value = spans.value
           where spans.added and seen >= spans.day and (spans.until is null or seen < spans.until)),
top as (select page_id, count(*) as n, max(e) as e from active group by page_id)
select c.page_id, coalesce(not e.allow, false) as blocked, coalesce(n, 0) as n_active,
       e.list as list, e.kind as kind, e.value as value
from captures c left join top on c.page_id = top.page_id"""
