"""Nearest neighbours by inner product: adaptive dimension scan over probed lists.

Equal vectors are one candidate that carries its smallest ids, so a vector that
a third of all rows share is scanned once.  Vectors get one more dimension that
makes all norms equal, which turns the largest inner product into the smallest
Euclidean distance, and are rotated by a seeded random rotation, after which any
columns are a random sample of the directions.

Candidates lie in lists around centres that are fitted on a bounded sample
(``SAMPLE`` vectors); every vector is in a list.  A query probes its nearest lists
until they hold the share ``PROBE`` of all vectors.  Within a list it scans column
blocks: after each block a candidate is abandoned if its partial distance is
significantly larger than the query's bound, the test being
``partial * D / d > bound * (1 + SIGMA / sqrt(d)) ** 2``.  The bound is the k-th
nearest of a bounded pilot sample of candidates.  Survivors are scored with the
original vectors in double precision.

Lists are dealt to shards of about ``SHARD`` vectors, queries to blocks of
``QUERIES``; each pair of a shard and a block is one task's work.

Defined cases: vectors that are null, zero, of another than the commonest length
(the shorter of ties), or hold null or non-finite components take no part, as
queries or candidates; a row repeated with the same id counts once; with fewer
than k candidates all are returned; ties go to the smaller id; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import table
from .common import saved

K = 20                         # neighbours of a query
PROBE = 0.6                    # share of all vectors in the lists that a query probes
SIGMA = 2.1                    # strictness of the test
BLOCK = 16                     # columns scanned between tests
SAMPLE = 16384                 # vectors, at most, that centres are fitted on
PILOT = 4096                   # of these, at most, that give a query its bound
LISTS = 4096                   # lists, at most
SHARD = 8192                   # vectors of a shard, about
QUERIES = 8192                 # queries of a block, about
PAIRS = 1 << 20                # partial distances held at once
SEED = 7


class Index:
    """Rotation, centres and pilot sample; bounded by ``SAMPLE`` and ``LISTS``."""

    def __init__(self, sample: np.ndarray, radius: float, n: int, probe: float, k: int):
        self.radius, self.k = radius, k
        rng = np.random.default_rng(SEED)
        dim = sample.shape[1] + 1
        self.turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0].astype(np.float32)
        x = self.rotate(sample)
        lists = min(LISTS, len(x), max(1, int(2 * math.sqrt(n)))) if n > 4 * k else 1
        self.centres = x[rng.choice(len(x), lists, replace=False)].copy()
        for _ in range(6 if lists > 1 else 0):
            own = self.nearest(x)
            total = np.zeros_like(self.centres)
            np.add.at(total, own, x)
            many = np.bincount(own, minlength=lists)
            self.centres[many > 0] = total[many > 0] / many[many > 0, None]
        # neighbouring lists get neighbouring numbers, so that shards hold neighbours
        self.centres = self.centres[np.argsort(self.centres @ _main_direction(self.centres))]
        self.pilot = x[:PILOT]
        self.share = np.bincount(self.nearest(x), minlength=lists) / len(x)
        self.probe = probe

    def rotate(self, x: np.ndarray) -> np.ndarray:
        """Vectors with the dimension that completes their norm, rotated."""
        rest = np.sqrt(np.maximum(self.radius ** 2 - (x.astype(np.float64) ** 2).sum(1), 0))
        return np.column_stack([x, rest]).astype(np.float32) @ self.turn

    def rotate_query(self, q: np.ndarray) -> np.ndarray:
        return np.column_stack([q, np.zeros(len(q))]).astype(np.float32) @ self.turn

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """Each vector's list."""
        half = 0.5 * (self.centres ** 2).sum(1)
        return np.concatenate([np.argmax(x[i:i + 4096] @ self.centres.T - half, 1) for i in range(0, len(x), 4096)])

    def probes(self, q: np.ndarray) -> np.ndarray:
        """Which lists (queries x lists) each rotated query probes."""
        order = np.argsort(0.5 * (self.centres ** 2).sum(1) - q @ self.centres.T, 1)
        held = np.cumsum(self.share[order], 1)
        out = np.zeros(order.shape, bool)
        np.put_along_axis(out, order, held - self.share[order] < self.probe, 1)
        return out

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Squared distance of each rotated query's k-th nearest pilot (one more,
        as the query may be among them)."""
        if len(self.pilot) <= self.k:
            return np.full(len(q), np.inf)
        d = (q ** 2).sum(1)[:, None] + (self.pilot ** 2).sum(1)[None] - 2 * q @ self.pilot.T
        return np.partition(d, self.k, 1)[:, self.k] + 1e-4 * self.radius ** 2


def _main_direction(x: np.ndarray) -> np.ndarray:
    v = np.linalg.svd(x - x.mean(0), full_matrices=False)[2]
    return v[0] if len(v) else np.zeros(x.shape[1])


def scan(q: np.ndarray, bound: np.ndarray, x: np.ndarray, sigma: float = SIGMA,
         block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) places of one list that no test abandons."""
    dim, found = q.shape[1], []
    step = max(1, PAIRS // max(1, len(x)))
    head = (x[:, :block] ** 2).sum(1)
    for at in range(0, len(q), step):
        a, limit = q[at:at + step], bound[at:at + step]
        d = (a[:, :block] ** 2).sum(1)[:, None] + head[None] - 2 * a[:, :block] @ x[:, :block].T
        seen = min(block, dim)
        i, j = np.nonzero(d * (dim / seen) <= (limit * (1 + (sigma / math.sqrt(seen) if seen < dim else 0)) ** 2)[:, None])
        part = d[i, j]
        while seen < dim and len(i):
            cols = slice(seen, min(seen + block, dim))
            part = part + ((a[i, cols] - x[j, cols]) ** 2).sum(1)
            seen = cols.stop
            slack = 1 + (sigma / math.sqrt(seen) if seen < dim else 0)
            live = part * (dim / seen) <= limit[i] * slack ** 2
            i, j, part = i[live], j[live], part[live]
        found.append((i + at, j))
    return (np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])) if found else (
        np.zeros(0, int), np.zeros(0, int))


def _best(query: np.ndarray, score: np.ndarray, low: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best rows of each query."""
    order = np.lexsort((low, -score, query))
    q = query[order]
    first = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, int)
    nth = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    return order[nth < k]


def _valid(vec: Column) -> Column:
    fine = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    return vec.isNotNull() & fine & F.exists(vec, lambda v: v != 0)


def nearest_neighbours(df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
                       probe: float = PROBE) -> DataFrame:
    """``(query_id, rank, <id_col>, score)``: for every row that ``is_query`` selects
    its k nearest other rows."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"),
                     F.coalesce(is_query, F.lit(False)).alias("q")).where(F.col("id").isNotNull() & _valid(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    spark, empty = df.sparkSession, "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], empty).withColumnRenamed("vec_id", id_col)
    rows = rows.where(F.size("v") == lengths.d)

    # equal vectors become one, with its k + 1 smallest ids
    few = rows.withColumn("nth", F.dense_rank().over(Window.partitionBy("v").orderBy("id"))).where(F.col("nth") <= k + 1)
    ids = few.groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    asked = rows.where("q").select("v", F.col("id").alias("query_id")).distinct()
    have = asked.select("v").distinct().withColumn("asked", F.lit(True)).withColumnRenamed("v", "qv")
    vectors = saved(ids.join(have, F.col("v") == F.col("qv"), "left").select(
        F.monotonically_increasing_id().alias("key"), "v", "ids", F.col("asked").isNotNull().alias("asked")), "ann-vectors")

    n, n_asked, radius = vectors.agg(F.count(F.lit(1)), F.count_if("asked"), F.max(F.sqrt(F.aggregate(
        "v", F.lit(0.0), lambda s, x: s + x * x)))).first()
    drawn = vectors if n <= SAMPLE else vectors.where(
        F.pmod(F.xxhash64("key"), F.lit(1 << 40)) < int((1 << 40) * SAMPLE / n * 0.95)).limit(SAMPLE)
    drawn = drawn.select("key", "v", F.col("ids")[0].alias("low")).toPandas().sort_values("key")
    # in a random, repeatable order: the first ones are the pilot
    drawn = drawn.iloc[np.random.default_rng(SEED).permutation(len(drawn))]
    vs = np.stack(drawn["v"].to_list())
    index = spark.sparkContext.broadcast(Index(vs, float(radius) * (1 + 1e-9), n, probe, k))
    pilot = spark.sparkContext.broadcast((vs[:PILOT], drawn["key"].to_numpy()[:PILOT], drawn["low"].to_numpy()[:PILOT]))
    shards, blocks = max(1, round(n / SHARD)), max(1, round(n_asked / QUERIES))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ix = index.value
        for f in frames:
            if len(f):
                own = ix.nearest(ix.rotate(np.stack(f["v"].to_list())))
                shard = own * shards // len(ix.centres)
                for b in range(blocks):
                    yield pd.DataFrame({"shard": shard, "block": b, "list": own, "key": f["key"], "v": f["v"],
                                        "low": f["ids"].str[0]})

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ix = index.value
        of = np.arange(len(ix.centres)) * shards // len(ix.centres)
        for f in frames:
            if len(f):
                on = ix.probes(ix.rotate_query(np.stack(f["v"].to_list())))
                for s in range(shards):
                    go = on[:, of == s].any(1)
                    if go.any():
                        yield pd.DataFrame({"shard": s, "block": (f["key"][go] % blocks), "key": f["key"][go], "v": f["v"][go]})

    def work(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        ix = index.value
        if not len(q) or not len(x):
            return pd.DataFrame({"query": [], "key": [], "low": [], "score": []})
        qv, xv = np.stack(q["v"].to_list()), np.stack(x["v"].to_list())
        qr, xr = ix.rotate_query(qv), ix.rotate(xv)
        on, bound = ix.probes(qr), ix.bounds(qr)
        own, qk, xk, low = (c.to_numpy() for c in (x["list"], q["key"], x["key"], x["low"]))
        out = []
        for one in np.unique(own):
            of, asks = np.flatnonzero(own == one), np.flatnonzero(on[:, one])
            i, j = scan(qr[asks], bound[asks], xr[of])
            i, j = asks[i], of[j]
            score = np.concatenate([np.einsum("ij,ij->i", qv[i[a:a + 65536]], xv[j[a:a + 65536]])
                                    for a in range(0, max(1, len(i)), 65536)])
            keep = _best(qk[i], score, low[j], k + 1)
            out.append(pd.DataFrame({"query": qk[i[keep]], "key": xk[j[keep]], "low": low[j[keep]], "score": score[keep]}))
        all_ = pd.concat(out)
        return all_.iloc[_best(all_["query"].to_numpy(), all_["score"].to_numpy(), all_["low"].to_numpy(), k + 1)]

    def known(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pv, key, low = pilot.value
        for f in frames:
            for at in range(0, len(f), 512):
                part = f.iloc[at:at + 512]
                score = np.stack(part["v"].to_list()) @ pv.T
                j = np.argpartition(-score, min(k, len(pv) - 1), 1)[:, :k + 1]
                i = np.repeat(np.arange(len(part)), j.shape[1])
                j = j.ravel()
                exact = np.einsum("ij,ij->i", np.stack(part["v"].to_list())[i], pv[j])
                yield pd.DataFrame({"query": part["key"].to_numpy()[i], "key": key[j], "low": low[j], "score": exact})

    held = vectors.mapInPandas(place, "shard int, block int, list int, key long, v array<double>, low long")
    sent = vectors.where("asked").select("key", "v").mapInPandas(ask, "shard int, block int, key long, v array<double>")
    found = sent.groupBy("shard", "block").cogroup(held.groupBy("shard", "block")).applyInPandas(
        work, "query long, key long, low long, score double")

    # the pilot's nearest always count, so a query never has fewer than k
    sure = vectors.where("asked").select("key", "v").mapInPandas(known, "query long, key long, low long, score double")
    found = found.union(sure).groupBy("query", "key").agg(F.min("low").alias("low"), F.max("score").alias("score"))
    by = Window.partitionBy("query").orderBy(F.desc("score"), "low")
    near = found.withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= k + 1)
    owners = vectors.select(F.col("key").alias("of"), "ids")
    near = near.join(owners, near.key == owners.of).select("query", "score", F.explode("ids").alias("id"))
    near = near.withColumn("nth", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id")))
    near = near.where(F.col("nth") <= k + 1).select("query", "score", "id")
    asking = asked.join(vectors.where("asked").select("key", F.col("v").alias("of_v")), F.col("v") == F.col("of_v"))
    out = asking.select("query_id", "key").join(near, F.col("key") == F.col("query")).where("id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


# -- query -------------------------------------------------------------------------

def op5_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)
