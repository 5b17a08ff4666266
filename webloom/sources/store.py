"""Bucketed tables: rows clustered by a key on disk, so that later joins and
aggregations on the key move only the other side.

:func:`write_bucketed` lays rows out once.  :class:`KeyedStore` is a store of one row a
key in that layout that grows by versions: of captures by URL (#3, #40), of the URLs
that a stream has seen, of the last request of each host.  An upsert writes the new
rows alone, into the buckets of their keys, as a new version; nothing that is stored is
read or written again.  A version counts once its manifest is there, which is written
last, so a lost job leaves the store as it was.  Readers see the newest row of
each key: which version that is is an aggregation over the key column, and both it
and the join that fetches the row keep to the buckets, so stored HTML never crosses a
shuffle.  :meth:`KeyedStore.compact` folds the versions into one.

Tables are registered in the session's catalog under names of their own and need no
metastore: the layout is on disk, and a store can be opened from any session.
:func:`forget_tables` (and :func:`webloom.session.drop_scratch`) drops the entries.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 64
COMPACT_AFTER = 16             # versions


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


_TABLES: list[str] = []


def _name() -> str:
    _TABLES.append(f"webloom_bucketed_{uuid.uuid4().hex[:12]}")
    return _TABLES[-1]


def forget_tables(spark: SparkSession) -> None:
    """Drop the catalog's entries of this process's tables; files stay.  DataFrames that
    still read them are lost."""
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")


def default_buckets(spark: SparkSession) -> int:
    """As many as a shuffle has partitions, so that one shuffle meets the buckets."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def buckets_for(spark: SparkSession, rows: int, per_bucket: int) -> int:
    """Buckets for so many rows: enough to keep every core busy, and no more than a
    shuffle has partitions."""
    most = default_buckets(spark)
    return min(most, max(spark.sparkContext.defaultParallelism, -(-rows // per_bucket)))


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int | None = None, clustered: bool = False) -> DataFrame:
    """Write ``df`` clustered by ``key`` in ``buckets`` files and read it back.  Each
    task writes one bucket; rows that come ``clustered``, from tables with these
    buckets, are written where they are."""
    n = buckets or default_buckets(df.sparkSession)
    name = _name()
    rows = df if clustered else df.repartition(n, key)
    rows.write.format("parquet").bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def write_part(df: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Write ``df``, which comes clustered by ``keys``, as a folder of bucket files that
    :func:`open_parts` opens together with others of the same layout."""
    name = _name()
    (df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name))
    df.sparkSession.sql(f"DROP TABLE {name}")            # the files stay


def open_parts(spark: SparkSession, path: str, schema: StructType, keys: list[str], buckets: int, part: str, values) -> DataFrame:
    """The folders ``<path>/<part>=<value>`` as one table clustered by ``keys``, with the
    whole number ``part`` as a column."""
    name, by = _name(), ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE {name} ({_columns(schema)}, `{part}` int) USING parquet PARTITIONED BY (`{part}`) "
              f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
    for v in values:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (`{part}` = {v}) LOCATION '{path}/{part}={v}'")
    return spark.table(name)


class KeyedStore:
    """Rows by ``key``, the MD5 of the column ``by`` (a capture's URL); see the module's
    text.  A store that is at ``path`` already is opened as it was made, and the other
    arguments are ignored."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | None = None, by: str = "url",
                 buckets: int = BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")
        found = self._manifest()
        if found:
            schema, buckets, by = StructType.fromJson(json.loads(found["schema"])), found["buckets"], found["by"]
        elif schema is None:
            raise ValueError(f"no store at {path}")
        self.schema, self.buckets, self.by = schema, buckets, by

    def key(self) -> Column:
        """What a row is stored under."""
        return F.md5(F.col(self.by).cast("string").cast("binary"))

    # -- versions ----------------------------------------------------------------

    def _folder(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _manifest(self) -> dict | None:
        """The newest complete manifest."""
        path, fs = self._folder("manifests")
        if not fs.exists(path):
            return None
        done = [int(f.getPath().getName()) for f in fs.listStatus(path)
                if fs.exists(self._folder(f"manifests/{f.getPath().getName()}/_SUCCESS")[0])]
        return self.spark.read.parquet(f"{self.path}/manifests/{max(done)}").first().asDict() if done else None

    def versions(self) -> list[int]:
        """The versions that make up the store, oldest first."""
        found = self._manifest()
        return list(found["versions"]) if found else []

    def _next(self) -> int:
        """A number that no version has, committed or lost."""
        used = [0]
        for kind in ("data", "manifests"):
            path, fs = self._folder(kind)
            if fs.exists(path):
                used += [int(f.getPath().getName().rpartition("=")[2]) for f in fs.listStatus(path)]
        return max(used) + 1

    def tag(self) -> int | None:
        """The number that the last committed :meth:`upsert` was given."""
        found = self._manifest()
        return found["tag"] if found else None

    def _add(self, rows: DataFrame, versions: list[int], tag: int | None) -> bool:
        """Write ``rows``, clustered by key, as a new version after ``versions`` and
        commit; without rows there is nothing new but a tag."""
        new = self._next()
        seen = Observation()
        rows = rows.select("key", *self.schema.names).observe(seen, F.count(F.lit(1)).alias("rows"))
        write_part(rows, f"{self.path}/data/v={new}", ["key"], self.buckets)
        some = seen.get["rows"] > 0
        if some or not versions or tag is not None:
            manifest = self.spark.createDataFrame(
                [([*versions, new] if some or not versions else versions, self.buckets, self.by, json.dumps(self.schema.jsonValue()), tag)],
                "versions array<int>, buckets int, by string, schema string, tag long")
            manifest.coalesce(1).write.parquet(f"{self.path}/manifests/{new}")
        return some

    # -- writing -----------------------------------------------------------------

    def upsert(self, writes: DataFrame, order: str = "ord", tag: int | None = None) -> int:
        """Add rows; per key the last by ``order`` of ``writes`` (one of them, the same
        each time, if several are) replaces what is stored.  Rows without a key are left
        out.  ``tag`` is committed with them, for a caller that may repeat an upsert.
        Returns the number of versions."""
        rows = writes.where(F.col(self.by).isNotNull()).withColumn("key", self.key())
        row = F.struct(*self.schema.names)
        last = F.max_by(row, F.struct(order, F.xxhash64(row))).alias("_last")
        rows = rows.repartition(self.buckets, "key").groupBy("key").agg(last).select("key", "_last.*")
        versions = self.versions()
        self._add(rows, versions, tag)
        if len(versions) >= COMPACT_AFTER:
            self.compact()
        return len(self.versions())

    def compact(self, keep: Column | None = None) -> None:
        """Fold all versions into one, of the rows that ``keep`` holds for (all if not
        given); the files of the others stay until :meth:`vacuum`, for readers that are
        still at work."""
        if len(self.versions()) > 1 or keep is not None:
            rows = self.read()
            self._add(rows if keep is None else rows.where(keep), [], self.tag())

    def vacuum(self) -> int:
        """Delete what the newest manifest doesn't name: folded and lost versions, and
        older manifests.  Returns how many folders went."""
        keep, gone = set(self.versions()), 0
        path, fs = self._folder("manifests")
        newest = max((int(f.getPath().getName()) for f in fs.listStatus(path)
                      if fs.exists(self._folder(f"manifests/{f.getPath().getName()}/_SUCCESS")[0])), default=0) if fs.exists(path) else 0
        for kind, held in (("data", keep), ("manifests", {newest})):
            path, fs = self._folder(kind)
            for f in fs.listStatus(path) if fs.exists(path) else []:
                if int(f.getPath().getName().rpartition("=")[2]) not in held:
                    gone += bool(fs.delete(f.getPath(), True))
        return gone

    # -- reading -----------------------------------------------------------------

    def read(self) -> DataFrame:
        """``(key, <columns>)``: the newest row of each key."""
        versions = self.versions()
        if not versions:
            return self.spark.createDataFrame([], StructType.fromDDL(f"key string, {_columns(self.schema)}"))
        stored = StructType.fromDDL(f"key string, {_columns(self.schema)}")
        rows = open_parts(self.spark, f"{self.path}/data", stored, ["key"], self.buckets, "v", versions)
        if len(versions) > 1:
            newest = rows.groupBy("key").agg(F.max("v").alias("_v")).withColumnRenamed("key", "_key")
            # no equality on v, which is no bucket column: equal keys alone meet
            rows = rows.join(newest, (F.col("key") == F.col("_key")) & (F.col("v") >= F.col("_v")))
        return rows.select("key", *self.schema.names)
