"""Helpers shared by the training-data operators: intermediate tables on the
shared scratch folder, whole-text word splitting, and connected components."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

# The word and white-space classes that the operators share.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

BLOCK_BYTES = 1 << 20          # a text is split into words at most this many bytes at a time
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared scratch folder and read it back.
    This cuts the lineage: a lost executor rereads files, not earlier stages."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Meanwhile, shuffle files go when the query that wrote them ends (as when a
    :func:`saved` table is written) instead of when the driver collects its garbage."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 256) -> Iterator[None]:
    """Meanwhile, Parquet is read at most ``rows`` rows at once: a batch of long texts
    stays a few MB, where the default of 4,096 rows takes arrays of tens of MB a task."""
    setting = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(min(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def drop_saved(df: DataFrame) -> None:
    """Delete a table of :func:`saved` that nothing will read again."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for at in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path(at).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path(at), True)


def word_blocks(data: bytes, limit: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words of a whole text, in lists of about ``limit`` bytes each, so a
    very long text never becomes one very long list."""
    at, end = 0, len(data)
    while at < end:
        stop = min(at + limit, end)
        if stop < end:
            cut = _SPACE.search(data, stop)
            stop = cut.start() if cut else end
        words = data[at:stop].split()
        if words:
            yield words
        at = stop


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, root)`` for the undirected long edges ``(a, b)``; ``root`` is the
    smallest node reachable.

    Alternates large-star and small-star steps.  Each step is two shuffles of
    the edge list and is written to the scratch folder; the driver sees only a
    row count and a checksum.  Rows never exceed the edge count, and a hot
    centre is a skewed equi-join that adaptive execution splits.
    """
    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    cur = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .distinct(), name)
    seen = mark(cur)
    while seen[0]:
        both = cur.union(cur.select("b", "a"))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        large = (both.join(low, both.a == low.u).where("b > a")
                 .select(F.col("b").alias("a"), F.least("m", "u").alias("b")).where("a <> b").distinct())
        large = saved(large, name)
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = (large.join(low, large.a == low.u).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("u", "m")).distinct())
        cur, last = saved(small, name), seen
        seen = mark(cur)
        if seen == last:
            break
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
