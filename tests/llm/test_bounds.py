"""Cases that once grew or broke: far fetch times, stores that Python can't open,
an optional part that can't be imported."""

import datetime as dt
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from webloom.llm import urlfilter, warc


def test_far_fetch_times_dont_multiply_the_lists(spark):
    at = ["2024-01-05", "2024-03-05", "9999-12-31", "0001-01-01", None]
    captures = spark.createDataFrame([(i, "https://a.com/x", t) for i, t in enumerate(at)], "page_id long, url string, at string").select(
        "page_id", "url", F.col("at").cast("timestamp").alias("fetched_at"))
    entries = spark.createDataFrame([("l", False, "host", "a.com", dt.date(2024, 2, 1), True), ("l", False, "domain", "a.com", dt.date(2023, 1, 1), True),
                                     ("l", False, "domain", "a.com", dt.date(2024, 2, 1), False)],
                                    "list string, allow boolean, kind string, value string, listed_on date, added boolean")
    out = urlfilter.filter_captures(captures, entries)
    assert {r.page_id: (r.blocked, r.n_active) for r in out.collect()} == {0: (True, 1), 1: (True, 1), 2: (True, 1), 3: (False, 0), 4: (False, 0)}
    assert urlfilter.filter_captures(captures.where("false"), entries).count() == 0
    # an entry is dealt to the months with captures from its day to its end
    listed = urlfilter.by_month(urlfilter.intervals(entries), captures.select(F.col("fetched_at").alias("at")))
    assert sorted((r.kind, r.month) for r in listed.collect()) == [("domain", 2024 * 12 + 1), ("host", 2024 * 12 + 3), ("host", 9999 * 12 + 12)]


def test_archives_need_a_folder_that_tasks_can_open(spark):
    chunks = spark.createDataFrame([], "id long, url string, digest string, size long, refers long, revisit boolean, chunk_no int, data binary")
    with pytest.raises(ValueError, match="dbfs"):
        warc.write_archives(chunks, "dbfs:/archives")


@pytest.mark.parametrize("absent", ["zstandard", "corpus_pipeline", "webloom.llm"])
def test_entry_imports_without(absent):
    code = (f"import sys, warnings; warnings.simplefilter('ignore'); sys.modules[{absent!r}] = None\n"
            "import __spark_entry__ as e; print(sum(x.startswith('op') for x in e.queries()), len(e.queries()) > 70)")
    got = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=__file__.rsplit("/tests/", 1)[0])
    assert got.stdout.split() == ["0", "True"], got.stderr[-500:]


def test_shuffle_files_go_with_the_query_that_wrote_them(spark):
    import glob
    import time

    from webloom.llm.common import saved, shuffles_dropped
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def left():
        before = {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")}
        counted = saved(spark.range(100, numPartitions=3).groupBy((F.col("id") % 7).alias("k")).count(), "t-shuffled")
        until = time.time() + 5
        while (new := {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")} - before) and time.time() < until:
            time.sleep(0.2)
        assert counted.count() == 7
        return new

    with shuffles_dropped(spark):
        assert spark.conf.get(setting) == "true" and not left()
    assert spark.conf.get(setting) == "false" and left()


def test_exact_dedup_reads_texts_in_small_batches(spark, monkeypatch, tmp_path):
    from webloom.llm import exact_dedup
    setting, seen, write = "spark.sql.parquet.columnarReaderBatchSize", [], exact_dedup.saved

    def saved(df, name):
        seen.append((name, int(spark.conf.get(setting))))
        return write(df, name)

    monkeypatch.setattr(exact_dedup, "saved", saved)
    rows = [(1, "a b"), (2, "a  b"), (3, "b a"), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/d")
    before = spark.conf.get(setting)
    # a weak hash, so that a collision is split by its texts too
    groups = exact_dedup.exact_groups(spark.read.parquet(f"{tmp_path}/d"), content_hash=lambda c: F.octet_length(c).cast("string"))
    # what is left reads hashes alone
    assert not any(f.startswith(f"file:{tmp_path}") for f in groups.inputFiles())
    assert spark.conf.get(setting) == before and int(before) > 256
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in groups.collect()) == [
        (1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True)]
    assert {n for n, _ in seen} == {"exact-keys", "exact-many", "exact-collisions", "exact-parts"}
    assert all(n <= 256 for _, n in seen)


def test_lm_drops_its_tables_before_the_depths(spark, monkeypatch):
    import os

    from webloom import session
    from webloom.llm import lm

    def there():
        return {os.path.basename(p).rsplit("-", 1)[0] for p in session._SCRATCH[first:]
                if os.path.exists(p.removeprefix("file:"))}

    first, seen, count = len(session._SCRATCH), [], lm.count_grams
    monkeypatch.setattr(lm, "count_grams", lambda *a: (seen.append(there()), count(*a))[1])
    rows = [(i, "a b c a b c d") for i in range(6)] + [(6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = lm.score(df, F.coalesce(F.col("doc_id") == 3, F.lit(False)))
    # the tokens stay in the portions' states alone
    assert len(seen) > 1 and all(x == {"webloom-lm-ids", "webloom-lm-portions"} for x in seen)
    assert there() == {"webloom-lm-ids", "webloom-lm-portions"}
    assert sorted((r.doc_id, r.held_out, r.n_tokens, r.train_tokens) for r in got.collect()) == [
        (i, i == 3, 8 if i < 6 else 1, 41) for i in range(7)]


def test_lm_grams_are_shuffled_packed(spark, monkeypatch):
    import numpy as np

    from webloom.llm import lm
    seen, count = [], lm.count_grams
    monkeypatch.setattr(lm, "count_grams", lambda asked, *a: (seen.append(asked.collect()), count(asked, *a))[1])
    rng = np.random.default_rng(3)
    # every second word is the same, so one context has half of all grams
    rows = [(i, " ".join(f"the w{x}" for x in rng.integers(0, 3000, 2000))) for i in range(8)]
    got = lm.score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") == 3)
    assert got.count() == 8
    first = seen[0]
    # a row for each portion and bucket, not for each gram of a portion
    assert len(first) == len({(r.pid, r.bucket) for r in first}) <= 8 * lm.BUCKETS
    pairs = [0] * lm.BUCKETS
    for r in first:
        pairs[r.bucket] += len(lm._unsqueeze(r.place, np.int32))
    # and the frequent context is spread over the buckets
    assert sum(pairs) > 50 * len(first) and max(pairs) < 1.5 * sum(pairs) / lm.BUCKETS


def test_exact_dedup_shuffles_few_texts_but_the_repeated(spark, monkeypatch):
    from webloom.llm import exact_dedup
    hashed = spark.range(20000).select(F.md5(F.col("id").cast("string").cast("binary")).alias("h"), F.col("id").alias("text"))
    many = hashed.where("text % 100 = 0").select("h")
    got = exact_dedup.suspects(hashed, many)
    assert got.columns == hashed.columns
    texts = [r.text for r in got.collect()]
    assert len(texts) == len(set(texts)) and set(range(0, 20000, 100)) <= set(texts)
    # one bit in sixteen is set at most
    assert len(texts) < 200 + 20000 / 10
    assert exact_dedup.suspects(hashed, many.limit(0)).count() == 0
    # bitmaps that grew too large are left out
    monkeypatch.setattr(exact_dedup, "MAP_BYTES", 8)
    assert exact_dedup.suspects(hashed, many).count() == 20000


def test_lm_does_deep_contexts_in_rounds(spark, monkeypatch):
    import numpy as np

    from webloom.llm import lm
    seen, counted, done, count = [], [], lm._done, lm.count_grams
    monkeypatch.setattr(lm, "_done", lambda sent, depth, words, *a: (seen.append((depth, words)), done(sent, depth, words, *a))[1])
    monkeypatch.setattr(lm, "count_grams", lambda *a: (counted.append(a), count(*a))[1])
    # each word depends on the four before
    rng = np.random.default_rng(5)
    odds, rows = rng.dirichlet([0.15] * 4, (4, 4, 4, 4)), []
    for i in range(6):
        w = [0, 1, 2, 3]
        for _ in range(1000):
            w.append(int(rng.choice(4, p=odds[tuple(w[-4:])])))
        rows.append((i, " ".join(f"w{x}" for x in w)))
    got = lm.score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") == 5)
    assert got.count() == 6
    # two depths are shuffled one by one, the others some at a time
    assert len(counted) == 2 and seen[0][0] == lm.TOGETHER and seen[0][1] > 1


class _Work:
    """Stands for a table, to get at the function that a step gives to its groups or batches."""
    def __getattr__(self, name):
        return lambda *a: a[0] if name in ("applyInArrow", "mapInArrow") else self


def _round(lm, texts, at, context, symbol, continued=False):
    import numpy as np
    words = np.append(-1, 7 * np.arange(1, 60))
    size, none = np.array([len(x) for x in texts]), np.zeros(0)
    word = lm._squeeze(np.concatenate([np.asarray(x) for x in texts]), np.int32)
    return lm.Round(1, continued, np.arange(len(size)), np.ones(len(size), bool), size, size, size * 1.0, size * 1.0, lm._rising(words), word,
                    np.array(at), np.array(context), np.array(symbol), np.ones(len(at)), none, none, none)


def test_lm_windows_against_plain_ones():
    import numpy as np

    from webloom.llm import lm
    rng = np.random.default_rng(2)
    # few words, some not kept (0), and a text that is there three times
    one = rng.integers(1, 50, 400).tolist()
    texts = [rng.integers(0, 3, 300).tolist(), one, [5], rng.integers(0, 3, 200).tolist(), one, one[1:], [1] * 300]
    flat, starts = np.concatenate(texts), np.cumsum([0] + [len(x) for x in texts])
    row = np.repeat(np.arange(len(texts)), np.diff(starts))
    for depth, words, before in ((3, 2, 0), (5, 12, 4), (17, 500, 0), (3, 40, 30)):
        at = np.flatnonzero((np.arange(len(flat)) - starts[row] >= depth - (before if before else 0) * (row == 0)) & (rng.random(len(flat)) < 0.6) & (row != 3))
        context, symbol = rng.integers(0, 3, len(at)), rng.integers(-1, 2, len(at))
        earlier = 7 * rng.integers(1, 3, before)
        w = lm.windows(_round(lm, texts, at, context, symbol, before > 0), earlier, depth, words)
        plain = []
        for i in at:
            known = [*(earlier.tolist() if row[i] == 0 else []), *[7 * x or -1 for x in flat[starts[row[i]]:i].tolist()]]
            known = known[:max(0, len(known) - depth)][::-1][:words]
            plain.append(tuple(known[:known.index(-1)] if -1 in known else known))
        assert [tuple(x[x >= 0].tolist()) for x in w.words(np.arange(len(at)))] == plain
        keys = [*zip(context.tolist(), symbol.tolist(), plain)]
        # equal windows are one, but for such as a chain of equal ones before them differs
        assert all(keys[w.first[p]] == k for p, k in zip(w.place, keys)) and len(w.first) <= len(set(keys)) + 2
        assert (np.diff(context[w.first]) >= 0).all()


def test_lm_rounds_skip_words_that_all_windows_share(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from webloom.llm import lm
    monkeypatch.setattr(lm, "saved", lambda df, name: df)
    seen, sums = [], lm._context_sums
    monkeypatch.setattr(lm, "_context_sums", lambda *a: (seen.append(1), sums(*a))[1])
    words, portions = 2000, 40
    rows = []
    # after 1,500 equal words half of the windows have other words, and other symbols follow
    for pid in range(portions):
        spelled = np.append(np.full(1500, 3), np.full(words - 1500, 4 + pid % 2))
        rows.append((pid, 0, lm._rising(np.array([2])), lm._squeeze(np.array([10 + pid % 2]), np.int64), lm._squeeze(np.array([0.01]), np.float64),
                     lm._squeeze(np.array([5]), np.int64), lm._squeeze(spelled, np.int64)))
    t = lm._table(rows, lm.SENT)
    done = lm._done(_Work(), 5, words, 1, 2, 10 ** 6, True)(t)
    states, out = lm._unsqueeze(done.column("depth")[0].as_py(), np.int64), done.slice(1)
    # the context as given is retained, and the two that it splits to
    assert np.flatnonzero(states).tolist()[0] == 0 and states[1501] == 2 and not states[2:1501].any()
    assert pa.compute.sum(out.column("pid")).as_py() == sum(range(portions))
    for r in range(portions):
        depth = lm._unsqueeze(out.column("depth")[r].as_py(), np.int64).tolist()
        change = lm._unsqueeze(out.column("change")[r].as_py(), np.float64)
        n, p = 5 * portions, 0.01
        want = [(n / 2 + lm.STRENGTH * p) / (n + lm.STRENGTH)]
        want.append((n / 2 + lm.STRENGTH * want[0]) / (n / 2 + lm.STRENGTH))
        assert depth[0] == 5 and 5 + 1501 in depth
        assert np.allclose(change[[0, depth.index(5 + 1501)]], np.log10([want[0] / p, want[1] / want[0]]))
    # not once a word
    assert len(seen) < 40


def test_lm_shuffles_counts_instead_of_the_roots_probabilities(spark, monkeypatch):
    import numpy as np

    from webloom.llm import lm
    seen, count = [], lm.count_grams
    monkeypatch.setattr(lm, "count_grams", lambda asked, *a: (seen.append(asked.collect()), count(asked, *a))[1])
    rng = np.random.default_rng(3)
    # many words of many different counts
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 4000) % 3000)) for i in range(8)]
    got = lm.score(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(False))
    assert got.count() == 8 and len(seen) == 2
    for r in seen[0]:
        b = lm._risen(r.b)
        n = lm._unsqueeze(r.p, np.int64)
        assert len(n) == len(b) and (n >= 2).all()
        # contexts are told apart by what is left of their numbers
        assert (np.diff(lm._risen(r.contexts)) == 1).mean() > 0.3 or len(lm._risen(r.contexts)) < 10
