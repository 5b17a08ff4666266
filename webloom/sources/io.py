"""Sources and sinks (#1-#8, #46).

Sources: seed CSV, capture tables (parquet) or raw capture files
(``binaryFile``), Markdown files.  Sinks: host-partitioned HTML / Markdown
datasets with a manifest, and per-host external-link CSVs.  Per-page file
trees become datasets that carry host and file name as columns, so a sink is
one distributed write; real trees of page files are in :mod:`.pagefiles`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import urls as U

SEED_SCHEMA = T.StructType([T.StructField("website", T.StringType())])


# -- sources ----------------------------------------------------------------------

def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Seed CSV with a ``website`` header; quoted cells may span lines, and blank
    ones are seeds like any other.  Duplicates are kept (each is its own crawl).
    Adds ``seed`` (row identity) and ``url`` (normalised).  A file without the
    column or without a seed is an error."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("emptyValue", "").option(
        "nullValue", "\x00").csv(path)
    if "website" not in raw.columns:
        raise ValueError(f"no website column in {path}")
    if raw.isEmpty():
        raise ValueError(f"no seeds in {path}")
    return normalize_seeds(raw.select("website"))


def write_seeds(seeds: DataFrame, path: str, website: str = "website", mode: str = "overwrite") -> None:
    """Seed list as CSV that :func:`read_seeds` reads back."""
    (seeds.select(F.col(website).alias("website")).write.mode(mode).option("header", True)
     .option("quoteAll", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def normalize_seeds(seeds: DataFrame, website: str = "website") -> DataFrame:
    s = seeds.filter(F.col(website).isNotNull())
    s = s.withColumn("seed", F.monotonically_increasing_id()) if "seed" not in s.columns else s
    return s.select("seed", F.col(website).alias("website"),
                    U.normalize_url(F.col(website)).alias("url"))


def read_capture_files(spark: SparkSession, path: str) -> DataFrame:
    """Raw capture files, in folders of any depth -> ``(path, key, html)``; bytes are
    decoded as UTF-8 with invalid sequences replaced.  Empty files are skipped."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path",
                        F.regexp_extract("path", r"([^/]*)\.html?$", 1).alias("key"),
                        decode_content(F.col("content")).alias("html"))


def decode_content(content) -> Column:
    """Bytes -> text, UTF-8 with U+FFFD for invalid sequences."""
    c = F.col(content) if isinstance(content, str) else content
    return F.make_valid_utf8(c.cast("string"))


def read_markdown(spark: SparkSession, path: str, tree: bool = False) -> DataFrame:
    """Markdown documents as ``(path, markdown)``: a folder of Markdown files, one
    row per file, or with ``tree`` what :func:`write_markdown_tree` wrote."""
    if tree:
        return read_tree(spark, path).select("path", F.col("content").alias("markdown"))
    return (spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path)
            .select(F.input_file_name().alias("path"), F.col("value").alias("markdown")))


# -- collisions and manifests --------------------------------------------------------

def name_files(pages: DataFrame, url: str = "url", seq: str = "page_id", markdown: bool = False,
               host_col=None) -> DataFrame:
    """Adds ``host``, ``file_name`` and ``winner``: distinct URLs that map to
    the same host and file name overwrite each other, the last write (highest
    ``seq``, which is unique) wins.

    Only ``seq`` and the names meet in the aggregate; the few rows that lose are
    marked by a join on ``seq`` alone, which no hot host or name can skew."""
    name = U.markdown_file_name(F.col(url)) if markdown else U.page_file_name(F.col(url))
    host = host_col if host_col is not None else U.host_of(F.col(url))
    d = pages.withColumn("host", host).withColumn("file_name", name)
    keys = d.select("host", "file_name", F.col(seq).alias("_seq"))
    top = keys.groupBy("host", "file_name").agg(F.max("_seq").alias("_last"))
    lost = keys.join(top, ["host", "file_name"]).filter("_seq <> _last").select("_seq", F.lit(True).alias("_lost"))
    return (d.join(lost, d[seq] == F.col("_seq"), "left")
            .withColumn("winner", F.col("_lost").isNull()).drop("_lost", "_seq"))


def name_collisions(pages: DataFrame, url: str = "url", seq: str = "page_id") -> DataFrame:
    """Pages whose stored file is overwritten by a later page."""
    return name_files(pages.select(seq, url), url, seq).filter(~F.col("winner")).drop("winner")


# -- sinks ----------------------------------------------------------------------------

FILE_ROWS = 200_000


def write_files(files: DataFrame, path: str, content: str, mode: str = "overwrite",
                buckets: int | None = None) -> None:
    """Write ``(host, file_name, url, content)``: ``host`` is a column of the
    dataset, so that as many hosts as there are make no more directories or files
    than the tasks of the write.  With ``buckets``, hosts are first clustered into
    that many tasks and sorted, and a reader of one host can skip most files;
    without it nothing is shuffled."""
    out = files.select("host", "file_name", "url", F.col(content).alias("content"))
    if buckets:
        # a host of many pages is spread over tasks by file name
        spread = F.pmod(F.xxhash64("file_name"), F.lit(16))
        out = out.repartition(buckets, "host", spread).sortWithinPartitions("host", "file_name")
    out.write.mode(mode).option("maxRecordsPerFile", FILE_ROWS).parquet(path)


def write_tree(named: DataFrame, path: str, content: str, mode: str = "overwrite") -> None:
    """Write the winners (see :func:`write_files`)."""
    write_files(named.filter("winner"), path, content, mode)


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    """A tree written by a sink: ``(path, host, file_name, url, content)``, where
    ``path`` is the name that the page has below its host."""
    return spark.read.parquet(path).select(
        F.concat_ws("/", "host", "file_name").alias("path"), "host", "file_name", "url", "content")


def write_html_tree(pages: DataFrame, path: str, url: str = "url", seq: str = "page_id",
                    html: str = "html", mode: str = "overwrite") -> DataFrame:
    """HTML sink; returns the manifest ``(host, file_name, url, winner)``."""
    named = name_files(pages, url, seq)
    write_tree(named, path, html, mode)
    return named.drop(html)


def write_markdown_tree(docs: DataFrame, path: str, url: str = "url", seq: str = "page_id",
                        markdown: str = "markdown", mode: str = "overwrite") -> DataFrame:
    """Markdown sink (file extension ``.md``); returns the manifest."""
    named = name_files(docs, url, seq, markdown=True)
    write_tree(named, path, markdown, mode)
    return named.drop(markdown)


def write_external_links(links: DataFrame, path: str, mode: str = "overwrite", host: str | None = None) -> None:
    """CSV with header ``Source URL,External URL,host``, one row per occurrence,
    under the host of the source page unless a column names another.  The host is
    a column: a folder for each would be one for every host of the web."""
    of = U.host_of(F.col("src")) if host is None else F.col(host)
    (links.select(F.col("src").alias("Source URL"), F.col("dst").alias("External URL"), of.alias("host"))
     .write.mode(mode).option("header", True).csv(path))


def read_external_links(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`write_external_links` wrote: ``(host, src, dst)``."""
    raw = spark.read.option("header", True).schema(
        "`Source URL` string, `External URL` string, host string").csv(path)
    return raw.select("host", F.col("Source URL").alias("src"), F.col("External URL").alias("dst"))
