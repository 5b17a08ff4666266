"""The bucketed capture store: versions, what an upsert writes, lost jobs, reading."""

import os

import pytest
from pyspark.sql import functions as F

from webloom.operators import captures as C
from webloom.sources.store import KeyedStore, write_bucketed

SCHEMA = "url string, ord long, html string"


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def store_of(spark, path, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    store = KeyedStore(spark, str(path), df.schema, **kw)
    store.upsert(df)
    return store


def test_upsert_writes_one_bucket_for_one_key(spark, tmp_path):
    store = store_of(spark, tmp_path, [(f"https://a.com/{i}", 0, f"html {i}") for i in range(500)], buckets=8)
    before = files(f"{tmp_path}/data")
    assert len(before) == 8
    store.upsert(spark.createDataFrame([("https://a.com/7", 1, "new"), ("https://a.com/7", 0, "old"), (None, 1, "no url")], SCHEMA))
    after = files(f"{tmp_path}/data")
    assert before.items() <= after.items() and len(after) == 9
    again = KeyedStore(spark, str(tmp_path))
    assert (again.buckets, again.schema, again.versions()) == (8, store.schema, [1, 2])
    got = {r.url: r.html for r in again.read().collect()}
    assert len(got) == 500 and got["https://a.com/7"] == "new" and got["https://a.com/8"] == "html 8"


def test_versions_fold_and_old_ones_go(spark, tmp_path):
    store = store_of(spark, tmp_path, [("u1", 0, "a"), ("u2", 0, "b")], buckets=2)
    for i in range(3):
        store.upsert(spark.createDataFrame([("u1", i, f"a{i}"), (f"n{i}", 0, None)], SCHEMA))
    want = sorted(store.read().collect())
    held = store.read()
    store.compact()
    assert len(store.versions()) == 1 and sorted(store.read().collect()) == want and sorted(held.collect()) == want
    assert store.vacuum() > 0 and sorted(KeyedStore(spark, str(tmp_path)).read().collect()) == want
    assert {(r.url, r.html) for r in store.read().collect()} == {("u1", "a2"), ("u2", "b"), ("n0", None), ("n1", None), ("n2", None)}


def test_a_lost_upsert_leaves_the_store_whole(spark, tmp_path):
    store = store_of(spark, tmp_path, [("u1", 0, "a")], buckets=2)
    bad = spark.createDataFrame([("u1", 1, "x"), ("u2", 1, "y")], SCHEMA).withColumn(
        "html", F.when(F.col("url") == "u2", F.raise_error(F.lit("lost"))).otherwise(F.col("html")))
    with pytest.raises(Exception, match="lost"):
        store.upsert(bad)
    assert [tuple(r)[1:] for r in KeyedStore(spark, str(tmp_path)).read().collect()] == [("u1", 0, "a")]
    store.upsert(spark.createDataFrame([("u2", 1, "y")], SCHEMA))
    assert {r.url for r in KeyedStore(spark, str(tmp_path)).read().collect()} == {"u1", "u2"}


def test_empty_store_and_missing_one(spark, tmp_path):
    store = store_of(spark, tmp_path, [], buckets=2)
    assert store.read().count() == 0 and store.read().columns == ["key", "url", "ord", "html"]
    with pytest.raises(ValueError):
        KeyedStore(spark, f"{tmp_path}/elsewhere")


def test_cache_lookup_on_a_store(spark, tmp_path):
    store = store_of(spark, tmp_path, [(f"u{i}", 0, f"h{i}") for i in range(50)], buckets=4)
    urls = spark.createDataFrame([("u3",), ("u99",), (None,), ("u3",)], "url string")
    got = sorted(((r.url, r.cached, r.html) for r in C.cache_lookup(urls, store.read()).collect()), key=str)
    assert got == [("u3", True, "h3"), ("u3", True, "h3"), ("u99", False, None), (None, False, None)] or set(got) == {
        ("u3", True, "h3"), ("u99", False, None), (None, False, None)} and len(got) == 4


def test_bucketed_join_moves_one_side(spark, tmp_path):
    big = write_bucketed(spark.range(1000).selectExpr("id as k", "repeat('x', 100) as wide"), f"{tmp_path}/t", "k", 4)
    small = spark.range(500).selectExpr("id * 2 as k")
    joined = big.join(small.hint("merge"), "k")
    assert joined.count() == 500
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.split("== Initial Plan ==")[0].count("Exchange") <= 1
