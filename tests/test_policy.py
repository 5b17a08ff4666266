"""Robots rules, per-host caps and the politeness schedule."""

import datetime as dt
import random
import re


from pyspark.sql import functions as F

from webloom.operators import policy as P


def py_schedule(rows, d):
    out, last = {}, {}
    for eid, host, us in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        s = us if host not in last else max(us, last[host] + d)
        last[host] = s
        out[eid] = s
    return out


def test_politeness_prefix_scan_with_hot_host(spark):
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        host = 7 if i % 3 else (i % 11)          # one host holds two thirds of all rows
        rows.append((i, host, base + dt.timedelta(seconds=(i * 37) % 5000)))
    df = spark.createDataFrame(rows, "event_id long, host long, ts timestamp_ntz")
    d = 2_000_000
    got = {r.event_id: r.start_us for r in P.politeness_schedule(df, d, partitions=8).collect()}
    epoch = dt.datetime(1970, 1, 1)
    want = py_schedule([(e, h, (t - epoch) // dt.timedelta(microseconds=1)) for e, h, t in rows], d)
    assert got == want
    win = {r.event_id: r.start_us for r in P.politeness_schedule_windowed(df, d).collect()}
    assert win == want


def test_robots_rules_and_blocking(spark):
    robots = spark.createDataFrame([("a.com", "User-agent: *\nDisallow: /private\nDISALLOW: /tmp/\ndisallow:\nAllow: /"),
                                    ("b.com", "Disallow: /")], "host string, body string")
    rules = P.parse_robots(robots)
    assert sorted((r.host, r.prefix) for r in rules.collect()) == [("a.com", "/private"), ("a.com", "/tmp/"), ("b.com", "/")]
    urls = spark.createDataFrame([(1, "https://a.com/private/x"), (2, "https://a.com/ok?q=/private"),
                                  (3, "https://b.com/anything"), (4, "https://c.com/private")], "id long, url string")
    assert sorted(r.id for r in P.exclude_robots(urls, rules).collect()) == [2, 4]
    assert sorted(r.id for r in P.blocked_by_robots(urls, rules).collect()) == [1, 3]


def test_limit_per_host_plans_partial_group_limit(spark):
    df = spark.createDataFrame([(i, f"https://h{i % 2}.com/{i}") for i in range(20)], "id long, url string")
    out = P.limit_per_host(df, 3)
    got = out.groupBy("host").count().collect()
    assert all(r["count"] == 3 for r in got)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_politeness_keeps_requests_without_a_host(spark):
    df = spark.createDataFrame([(1, None, 10), (2, "a", 10), (3, None, 11)], "event_id long, user_id string, t long")
    df = df.select("event_id", F.col("user_id").alias("host"), F.timestamp_seconds("t").alias("ts"))
    got = {r.event_id: (r.rn, r.start_us) for r in P.politeness_schedule(df, 5_000_000).collect()}
    assert got == {1: (1, 10_000_000), 3: (2, 15_000_000), 2: (1, 10_000_000)}


def test_politeness_joins_its_summary_without_a_shuffle(spark):
    df = spark.range(5000).selectExpr("id as event_id", "if(id % 3 = 0, id % 7, 7) as host", "timestamp_seconds(id) as ts")
    out = P.politeness_schedule(df, 1_000_000, partitions=8)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # the broadcast side: a row per partition that continues a host, at most
    chunks = df.repartitionByRange(8, "host", "ts", "event_id").withColumn("chunk", F.spark_partition_id())
    spans = chunks.groupBy("host").agg(F.countDistinct("chunk").alias("n")).agg(F.sum(F.col("n") - 1)).first()[0]
    assert 0 < spans < 8
    assert out.filter("rn > 1").count() == 5000 - df.select("host").distinct().count()


def test_robots_index_against_brute_force(spark):
    rng = random.Random(6)
    def path():
        return "/" + "".join(rng.choice("ab/") for _ in range(rng.randrange(7)))
    rules = [(f"h{rng.randrange(4)}.com", path()) for _ in range(60)] + [("h0.com", "/a"), ("h0.com", "/a/b"), ("h3.com", "/"), ("h2.com", "é/x")]
    urls = [(i, f"https://h{rng.randrange(5)}.com{path()}?q=/a") for i in range(300)]
    urls += [(300, None), (301, "https://h3.com?x"), (302, "https://h0.com"), (5, urls[5][1]), (303, "not a url")]
    r = spark.createDataFrame(rules, "host string, prefix string")
    u = spark.createDataFrame(urls, "id long, url string")
    def blocked(url):
        m = re.match(r"https?://([^/?#]*)([^?#]*)", url or "")
        return bool(m) and any(h == m[1] and (p == "/" or m[2].startswith(p)) for h, p in rules)
    assert sorted(x.id for x in P.blocked_by_robots(u, r).collect()) == sorted(i for i, x in urls if blocked(x))
    assert sorted(x.id for x in P.exclude_robots(u, r).collect()) == sorted(i for i, x in urls if not blocked(x))
    free = [tuple(x) for x in P.robots_index(r)[0].collect()]
    assert not any(h == g and p != q and q.startswith(p) for h, p in free for g, q in free)
    assert P.exclude_robots(u, r.where("false")).count() == len(urls) and P.blocked_by_robots(u.where("false"), r).count() == 0


def test_robots_lookup_is_linear_on_a_hot_host(spark):
    """A thousand rules of one host and its URLs meet on equal keys only: a URL is
    looked up once for each length that the rules have."""
    rules = spark.range(1000).selectExpr("concat('hot', id % 1, '.com') as host", "concat('/dir', lpad(id, 4, '0'), '/') as prefix")
    urls = spark.range(20000).selectExpr("concat('https://hot', id % 1, '.com/dir', lpad(id % 4000, 4, '0'), '/page', id) as url")
    free, lengths = P.robots_index(rules)
    assert free.count() == 1000 and [tuple(x) for x in lengths.collect()] == [("hot0.com", [9])]
    got = P.blocked_by_robots(urls, rules)
    assert got.count() == 5000
    plan = got._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.split("\n") if "Join " in x and "==" not in x]
    assert joins and not any("startswith" in x.lower() or "NestedLoop" in x or "Cartesian" in x for x in joins)
