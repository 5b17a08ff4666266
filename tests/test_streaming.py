"""Streaming forms equal their batch forms; keyed state spans micro-batches."""

import datetime as dt
import os
import tempfile

from webloom.sources.store import KeyedStore
from webloom.streaming.jobs import (read_stream, run_to_table, schedule_into_table, stream_markdown, stream_politeness,
                                    unseen_into_store, unseen_store)
from webloom.operators.extract import html_to_markdown

SF = "/root/testdata/sf0.001"


def test_stream_markdown_equals_batch(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    s = read_stream(spark, SF, "pages.parquet", pages.schema)
    got = run_to_table(stream_markdown(s).select("page_id", "markdown"), "t-md")
    want = html_to_markdown(pages).select("page_id", "markdown")
    assert sorted(got.collect()) == sorted(want.collect())


def test_politeness_state_carries_across_batches(spark):
    d = tempfile.mkdtemp(prefix="webloom-arrivals-")
    base = dt.datetime(2024, 1, 1)
    rows = [(i, i % 3, base + dt.timedelta(seconds=i)) for i in range(30)]
    for part in range(3):      # three files -> three micro-batches in time order
        chunk = rows[part * 10:(part + 1) * 10]
        spark.createDataFrame(chunk, "event_id long, host long, ts timestamp_ntz") \
            .coalesce(1).write.parquet(os.path.join(d, f"b{part}"))
    schema = "event_id long, host long, ts timestamp_ntz"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", True).parquet(d)
    delay = 5_000_000
    got = {r.event_id: r.start_us for r in run_to_table(stream_politeness(stream, delay), "t-pol").collect()}
    last, want = {}, {}
    for e, h, t in rows:
        us = (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
        s = us if h not in last else max(us, last[h] + delay)
        last[h], want[e] = s, s
    assert got == want


def test_politeness_of_requests_without_a_host(spark):
    d = tempfile.mkdtemp(prefix="webloom-nohost-")
    rows = [(1, None, dt.datetime(2024, 1, 1)), (2, 4, dt.datetime(2024, 1, 1)), (3, None, dt.datetime(2024, 1, 1))]
    schema = "event_id long, host long, ts timestamp_ntz"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(d, "b0"))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(d)
    out = run_to_table(stream_politeness(stream, 7), "t-nohost").collect()
    first = 1_704_067_200_000_000
    assert {r.event_id: (r.host, r.start_us) for r in out} == {1: (None, first), 2: (4, first), 3: (None, first + 7)}


def test_unseen_urls_with_watermark_bounded_state(spark):
    from webloom.streaming.jobs import stream_unseen_urls
    d = tempfile.mkdtemp(prefix="webloom-captures-")
    base = dt.datetime(2024, 1, 1)
    batches = [
        [(0, "https://a.com/", '<a href="/x">x</a><a href="/y">y</a>', base)],
        [(1, "https://a.com/z", '<a href="/x">x</a><a href="/w">w</a>', base + dt.timedelta(minutes=5))],
    ]
    schema = "page_id long, url string, html string, ts timestamp"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(d, f"b{i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", True).parquet(d)
    out = run_to_table(stream_unseen_urls(stream, event_time="ts", delay="1 hour"), "t-unseen")
    got = sorted(r.url for r in out.collect())
    assert got == ["https://a.com/w", "https://a.com/x", "https://a.com/y"]


def arrivals_in_files(spark, rows, files):
    d = tempfile.mkdtemp(prefix="webloom-arrivals-")
    size = -(-len(rows) // files)
    schema = "event_id long, host long, ts timestamp_ntz"
    for i in range(files):
        spark.createDataFrame(rows[i * size:(i + 1) * size], schema).coalesce(1).write.parquet(os.path.join(d, f"b{i}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(d)


def test_schedule_table_equals_keyed_state_with_a_hot_host(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, None if i % 41 == 0 else 7 if i % 3 else i % 11, base + dt.timedelta(seconds=(i // 400) * 400 + (i * 37) % 390))
            for i in range(1600)]
    stream, delay = arrivals_in_files(spark, rows, 4), 3_000_000
    path = tempfile.mkdtemp(prefix="webloom-schedule-")
    got = {r.event_id: (r.host, r.start_us) for r in
           schedule_into_table(stream, delay, path, f"{path}/offsets", partitions=8).collect()}
    last, want = {}, {}
    for part in range(4):
        for e, h, t in sorted(rows[part * 400:(part + 1) * 400], key=lambda r: (r[2], r[0])):
            us = (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
            last[h] = s = us if h not in last else max(us, last[h] + delay)
            want[e] = h, s
    assert got == want
    hosts = KeyedStore(spark, f"{path}/hosts")
    assert hosts.tag() == 3 and {r.host: r.last_start_us for r in hosts.read().collect()} == last
    # nothing but offsets in the checkpoint: no operator state
    assert not os.path.exists(f"{path}/offsets/state")


def test_repeated_micro_batch_changes_nothing(spark, monkeypatch):
    rows = [(i, i % 2, dt.datetime(2024, 1, 1)) for i in range(8)]
    stream = arrivals_in_files(spark, rows, 2)
    path = tempfile.mkdtemp(prefix="webloom-schedule-")
    upsert, calls = KeyedStore.upsert, []

    def lost(self, *args, **kw):
        calls.append(kw)
        if len(calls) == 2:            # the second batch's rows are written, its state isn't
            raise OSError("driver lost")
        return upsert(self, *args, **kw)

    monkeypatch.setattr(KeyedStore, "upsert", lost)
    try:
        schedule_into_table(stream, 5, path, f"{path}/offsets")
        raise AssertionError("should fail")
    except Exception as e:
        assert "driver lost" in str(e)
    got = schedule_into_table(stream, 5, path, f"{path}/offsets").collect()
    first = 1_704_067_200_000_000
    assert sorted((r.event_id, r.start_us - first) for r in got) == [(i, 5 * (i // 2)) for i in range(8)]


def test_idle_hosts_are_forgotten(spark, tmp_path):
    rows = [(i, i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(10)]
    schedule_into_table(arrivals_in_files(spark, rows, 10), 1, str(tmp_path), f"{tmp_path}/offsets", idle_us=3 * 3600 * 1_000_000)
    assert {r.host for r in KeyedStore(spark, f"{tmp_path}/hosts").read().collect()} <= set(range(4, 10))


def test_seen_urls_in_a_store_across_restarts(spark, tmp_path):
    schema = "page_id long, url string, html string"
    folder = str(tmp_path / "in")

    def arrive(i, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/b{i}")

    def run():
        store = unseen_store(spark, f"{tmp_path}/seen", buckets=4)
        stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder))
        unseen_into_store(stream, store, f"{tmp_path}/offsets")
        return {r.url: r.first_page for r in store.read().collect()}

    arrive(0, [(5, "https://a.com/", '<a href="/x">x</a><a href="/y">y</a>'), (4, "https://a.com/q", '<a href="/x">x</a>')])
    arrive(1, [(1, "https://a.com/z", '<a href="/x">x</a><a href="/w">w</a><a href="/f.pdf">f</a>')])
    assert run() == {"https://a.com/x": 4, "https://a.com/y": 5, "https://a.com/w": 1}
    arrive(2, [(0, "https://a.com/z", '<a href="/w">w</a><a href="/x">x</a>')])
    arrive(3, [(2, "https://a.com/z", '<a href="/v">v</a>')])
    assert run() == {"https://a.com/x": 4, "https://a.com/y": 5, "https://a.com/w": 1, "https://a.com/v": 2}
    assert not os.path.exists(f"{tmp_path}/offsets/state")


def test_seen_urls_in_a_session_that_has_no_functions_yet(spark, tmp_path):
    fresh = spark.newSession()
    schema = "page_id long, url string, html string"
    fresh.createDataFrame([(3, "https://a.com/", '<a href="/x">x</a><a href="/f.pdf">f</a>')], schema).coalesce(1).write.parquet(f"{tmp_path}/in/b0")
    store = unseen_store(fresh, f"{tmp_path}/seen", buckets=4)
    stream = fresh.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    unseen_into_store(stream, store, f"{tmp_path}/offsets")
    assert [tuple(r) for r in store.read().select("url", "first_page").collect()] == [("https://a.com/x", 3)]
