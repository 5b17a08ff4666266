"""Breadth-first crawl against a plain queue-based traversal."""

import random
from collections import Counter, deque

from webloom.operators import frontier as FR
from webloom.operators.policy import limit_per_group


def py_bfs(seed, edges, captured, max_depth):
    adj = {}
    for s, d in edges:
        adj.setdefault(s, []).append(d)
    depth = {seed: 0}
    q = deque([seed])
    while q:
        u = q.popleft()
        if depth[u] >= max_depth or u not in captured:
            continue
        for v in adj.get(u, []):
            if v not in depth:
                depth[v] = depth[u] + 1
                q.append(v)
    return depth


def test_crawl_matches_queue_bfs(spark):
    n = 60
    edges = [(f"https://s.com/p/{i}", f"https://s.com/p/{(i * 7 + k * 11) % n}") for i in range(n) for k in range(3)]
    captured = {f"https://s.com/p/{i}" for i in range(n) if i % 5 != 3}
    e = spark.createDataFrame(edges, "src string, dst string")
    cap = spark.createDataFrame([(u,) for u in captured], "url string")
    seeds = spark.createDataFrame([(0, "https://s.com/p/0"), (1, "https://s.com/p/1")], "seed long, url string")
    got = FR.crawl(seeds, e, cap, max_depth=3).collect()
    assert sorted(FR.crawl(seeds, e, cap, max_depth=3, bucket_edges=0).collect(), key=str) == sorted(got, key=str)
    for s, url in [(0, "https://s.com/p/0"), (1, "https://s.com/p/1")]:
        want = py_bfs(url, edges, captured, 3)
        mine = {r.url: r.depth for r in got if r.seed == s}
        assert mine == want
        assert all(r.fetched == (r.url in captured) for r in got if r.seed == s)


def test_depth_never_jumps_along_edges(spark):
    n = 40
    edges = [(f"https://s.com/p/{i}", f"https://s.com/p/{(i * 3 + 1) % n}") for i in range(n)]
    e = spark.createDataFrame(edges, "src string, dst string")
    seeds = spark.createDataFrame([(0, "https://s.com/p/0")], "seed long, url string")
    depth = {r.url: r.depth for r in FR.crawl(seeds, e, None, max_depth=50).collect()}
    for s, d in edges:
        if s in depth and d in depth:
            assert depth[d] <= depth[s] + 1


def test_follow_edges_keeps_internal_valid_normalised(spark):
    e = spark.createDataFrame([("https://www.s.com/a", "https://s.com/b/"), ("https://s.com/a", "https://x.com/b"),
                               ("https://s.com/a", "https://s.com/f.pdf"), ("https://s.com/a", "https://s.com/b")],
                              "src string, dst string")
    got = sorted((r.src, r.dst) for r in FR.follow_edges(e).collect())
    assert got == [("https://s.com/a", "https://s.com/b"), ("https://www.s.com/a", "https://s.com/b")]


def test_budget_is_first_n_in_depth_url_order(spark):
    v = spark.createDataFrame([(0, "u3", 1, True), (0, "u1", 0, True), (0, "u2", 1, True), (1, "z", 0, True)],
                              "seed long, url string, depth int, fetched boolean")
    got = sorted((r.seed, r.url) for r in FR.limit_total(v, 2).collect())
    assert got == [(0, "u1"), (0, "u2"), (1, "z")]
    plan = FR.limit_total(v, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_unseen_dedups_and_excludes_seen(spark):
    cand = spark.createDataFrame([(0, "a"), (0, "a"), (0, "b"), (1, "a")], "seed long, url string")
    seen = spark.createDataFrame([(0, "b")], "seed long, url string")
    assert sorted(tuple(r) for r in FR.unseen(cand, seen).collect()) == [(0, "a"), (1, "a")]


def test_limit_per_seed_host_keeps_failures(spark):
    v = spark.createDataFrame([(0, "https://a.com/1", 0, True), (0, "https://a.com/2", 1, True),
                               (0, "https://a.com/3", 1, False), (0, "https://b.com/1", 1, True)],
                              "seed long, url string, depth int, fetched boolean")
    got = sorted(r.url for r in FR.limit_per_seed_host(v, 1).collect())
    assert got == ["https://a.com/1", "https://a.com/3", "https://b.com/1"]


def test_blocked_pages_are_visited_not_expanded(spark):
    edges = [("https://s.com/a", "https://s.com/b"), ("https://s.com/b", "https://s.com/c")]
    e = spark.createDataFrame(edges, "src string, dst string")
    seeds = spark.createDataFrame([(0, "https://s.com/a")], "seed long, url string")
    blocked = spark.createDataFrame([("https://s.com/b",)], "url string")
    got = {r.url: (r.depth, r.fetched) for r in FR.crawl(seeds, e, None, blocked=blocked).collect()}
    assert got == {"https://s.com/a": (0, True), "https://s.com/b": (1, False)}


def test_crawl_reports_level_sizes(spark):
    edges = [("https://s.com/a", "https://s.com/b"), ("https://s.com/a", "https://s.com/c"),
             ("https://s.com/b", "https://s.com/d")]
    e = spark.createDataFrame(edges, "src string, dst string")
    seeds = spark.createDataFrame([(0, "https://s.com/a")], "seed long, url string")
    stats = []
    FR.crawl(seeds, e, None, max_depth=5, stats=stats)
    assert stats == [(0, 1), (1, 2), (2, 1), (3, 0)]


def test_budget_bounds_what_a_level_writes(spark):
    seeds = spark.createDataFrame([(0, "https://h.com/0"), (1, "https://h.com/1")], "seed long, url string")
    # page 0 links to everything, everything links on
    e = spark.range(2000).selectExpr("'https://h.com/0' as src", "concat('https://h.com/', id) as dst").unionByName(
        spark.range(2000).selectExpr("concat('https://h.com/', id) as src", "concat('https://h.com/', (id + 1) % 2000) as dst"))
    whole = FR.limit_total(FR.crawl(seeds, e, None, max_depth=4), 10)
    stats = []
    cut = FR.crawl(seeds, e, None, max_depth=4, max_urls=10, stats=stats)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))
    assert sum(n for _, n in stats) <= 20


def test_hot_page_is_split(spark):
    kept = {k: spark.conf.get(k) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor")}
    try:
        for k, v in zip(kept, ("-1", "50k", "50k", "2")):
            spark.conf.set(k, v)
        hub = spark.range(0, 40000, 1, 8).selectExpr(
            "case when id % 3 = 0 then 'https://h.com/hub' else concat('https://h.com/', id) end as src",
            "concat('https://h.com/', sha2(string(id), 512)) as dst")
        level = spark.range(0, 2000, 1, 4).selectExpr("id as seed", "'https://h.com/hub' as url").filter("seed = 0").unionByName(
            spark.range(0, 4000, 1, 4).selectExpr("id as seed", "concat('https://h.com/', id) as url"))
        joined = level.withColumnRenamed("url", "src").join(hub, "src").select("seed", "dst")
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "skew=true" in plan
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_limit_per_group_over_many_partitions(spark):
    rows = spark.range(0, 5000, 1, 100).selectExpr("id % 3 as g", "id as o")
    got = limit_per_group(rows, ["g"], ["o"], 4).collect()
    assert sorted((r.g, r.o) for r in got) == sorted((g, g + 3 * k) for g in range(3) for k in range(4))


def py_queue_crawl(seeds, edges, captured, max_depth, cap, failed_hosts=(), blocked=()):
    """Plain queues, a depth of all seeds after the other, in (seed, url) order, with
    one counter a host; host rules are asked before those of the URL."""
    fetched, out = Counter(), {}
    level = sorted(seeds)
    for depth in range(max_depth + 1):
        found = set()
        for seed, url in level:
            host = url.split("/")[2]
            reason = ("failed_host" if host in failed_hosts else "host_cap" if cap is not None and fetched[host] >= cap
                      else blocked[url] if url in blocked else None if url in captured else "no_capture")
            out[seed, url] = depth, reason
            if reason is None:
                fetched[host] += 1
                found |= {(seed, d) for d in edges.get(url, ())}
        level = sorted(x for x in found if x not in out)
    return out


def test_host_cap_ends_the_chain_behind_a_capped_page(spark):
    chain = ["https://a.com/", "https://a.com/b", "https://a.com/c", "https://a.com/d"]
    edges = spark.createDataFrame(list(zip(chain, chain[1:])), "src string, dst string")
    cap = spark.createDataFrame([(u,) for u in chain[:3]], "url string")
    seeds = spark.createDataFrame([(0, chain[0])], "seed long, url string")
    got = {r.url: (r.depth, r.reason) for r in FR.crawl(seeds, edges, cap, max_per_host=1).collect()}
    assert got == {chain[0]: (0, None), chain[1]: (1, "host_cap")}


def test_host_counters_are_shared_and_exact(spark):
    rng = random.Random(4)
    urls = [f"https://h{i % 3}.com/{i}" for i in range(90)]
    graph = {u: rng.sample(urls, 4) for u in urls}
    edges = spark.createDataFrame([(s, d) for s, ds in graph.items() for d in ds], "src string, dst string")
    seeds = [(i, rng.choice(urls)) for i in range(6)]
    captured = {u for u in urls if rng.random() < .8}
    blocked = {u: rng.choice(["robots", "failed_url"]) for u in rng.sample(urls, 12)}
    frames = dict(captured=spark.createDataFrame([(u,) for u in captured], "url string"),
                  blocked=spark.createDataFrame(list(blocked.items()), "url string, reason string"))
    start = spark.createDataFrame(seeds, "seed long, url string")
    for cap, failed in ((1, ()), (5, ("h1.com",)), (40, ()), (None, ("h0.com",)), (0, ())):
        hosts = spark.createDataFrame([(h,) for h in failed], "host string") if failed else None
        got = FR.crawl(start, edges, max_depth=4, max_per_host=cap, failed_hosts=hosts, bucket_edges=0 if cap == 5 else 1000,
                       **frames).collect()
        want = py_queue_crawl(seeds, graph, captured, 4, cap, failed, blocked)
        assert {(r.seed, r.url): (r.depth, r.reason) for r in got} == want
        assert all(r.fetched == (r.reason is None) for r in got)
    counts = FR.rule_counts(FR.crawl(start, edges, max_depth=4, max_per_host=5, **frames)).collect()
    want = py_queue_crawl(seeds, graph, captured, 4, 5, (), blocked)
    assert {(r.seed, r.rule): r.urls for r in counts} == Counter((s, reason or "fetched") for (s, _), (_, reason) in want.items())


def test_cap_after_budget(spark):
    edges = spark.createDataFrame([("https://a.com/", f"https://a.com/{i}") for i in range(9)], "src string, dst string")
    seeds = spark.createDataFrame([(0, "https://a.com/")], "seed long, url string")
    got = FR.crawl(seeds, edges, None, max_urls=5, max_per_host=3).collect()
    assert Counter(r.reason for r in got) == {None: 3, "host_cap": 2}


def test_visited_pages_stay_in_their_buckets(spark, tmp_path):
    from webloom.sources.store import open_parts, write_part
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        for d in range(2):
            pages = spark.range(100 * d, 100 * d + 100).selectExpr("id % 7 as seed", "concat('https://a.com/', id) as url")
            write_part(pages.repartition(n, "seed", "url"), f"{tmp_path}/depth={d}", FR.PAGE, n)
        visited = open_parts(spark, str(tmp_path), pages.schema, FR.PAGE, n, "depth", range(2)).select(*FR.PAGE)
        edges = spark.range(300).selectExpr("concat('https://a.com/', 100 + id % 100) as src", "concat('https://a.com/', id) as dst")
        found = FR.next_level(pages, edges, visited)
        assert found.count() == len({((100 + i % 100) % 7, f"https://a.com/{i}") for i in range(300)}
                                    - {(i % 7, f"https://a.com/{i}") for i in range(200)})
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        right = plan[plan.index("LeftAnti"):]
        # below the anti join: the exchange of the new URLs (and those of the edge join) on the left, a bucketed scan on the right
        assert "Bucketed: true" in right and "Exchange" not in right[right.rindex("Sort ["):]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
