"""SimHash near-duplicate groups by a vantage-point tree.

A fingerprint is 64 majority votes over the XXH64 values of a text's word
shingles.  Documents whose fingerprints differ in at most ``max_bits`` bits
are linked, and a group is everything reachable over links.

Equal fingerprints are one node, so copies never meet each other.  The nodes
are partitioned by a vantage-point tree: an inner node holds a vantage point v
and a radius r; fingerprints within r go inside, the others outside.  By the
triangle inequality a link crosses a boundary only from the band
``r - max_bits < d <= r``, so exactly that band is also sent outside; then both
ends of every link meet in at least one shard.  The upper tree is fitted on a
bounded sample (``SAMPLE``) and only steers the work; every fingerprint is
routed, and each shard goes on splitting by the same rule until a branch is
small enough to compare in blocks.  A shard returns a spanning forest, never
all pairs, and a distributed star contraction joins the shards' forests.

Defined cases: a null or blank text has fingerprint zero and is linked like any
other; repeated rows are all returned; a null id never becomes a component id
unless its whole group has none; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from .common import connected_components, saved, word_blocks

SHINGLE = 3                    # words per shingle
MAX_BITS = 2                   # fingerprints at this distance or nearer are linked
SEED = 42                      # XXH64 seed
SAMPLE = 16384                 # fingerprints, at most, that the upper tree is fitted on
SHARD = 8192                   # fingerprints aimed at in a shard
LEAF = 512                     # a branch this small is compared pair by pair
CELLS = 1 << 21                # comparisons held in memory at once


# -- fingerprints ------------------------------------------------------------------

def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one whole text (UTF-8)."""
    votes, total, tail, first = np.zeros(64, np.int64), 0, [], []
    digest = xxhash.xxh64_intdigest
    for words in word_blocks((text or b"").lower()):
        words = tail + words
        if len(words) < shingle:
            first = tail = words
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        n = len(words) - shingle + 1
        hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts[:n].tolist(), ends[shingle - 1:].tolist())),
                             np.uint64, n)
        for at in range(0, n, 1 << 16):
            part = hashes[at:at + (1 << 16)]
            votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += n
        tail = words[n:]
    if not total:
        return digest(b" ".join(first), SEED) if first else 0
    return int(np.packbits(2 * votes > total, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id, fp)`` of every row; fp is the fingerprint's bits as a long."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.large_binary() if pa.types.is_large_string(b.column(1).type) else pa.binary())
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


# -- the tree ----------------------------------------------------------------------

def _split(x: np.ndarray, bits: int, rng: np.random.Generator) -> tuple[int, int] | None:
    """The vantage point and radius, of a few tried, whose larger branch (band
    included) is smallest; None if no branch would be smaller than ``x``."""
    best, found = 0.9 * len(x), None
    for v in x[rng.integers(0, len(x), 6)]:
        n = np.cumsum(np.bincount(np.bitwise_count(x ^ v), minlength=65))
        for r in np.flatnonzero((n >= 0.2 * len(x)) & (n <= 0.8 * len(x))):
            band = n[r] - (n[r - bits] if r >= bits else 0)
            if (larger := max(n[r], len(x) - n[r] + band)) < best:
                best, found = larger, (int(v), int(r))
    return found


def _parts(x: np.ndarray, v: int, r: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions that go inside, and those that go outside with the band."""
    d = np.bitwise_count(x ^ np.uint64(v))
    return np.flatnonzero(d <= r), np.flatnonzero(d > r - bits)


def fit_tree(sample: np.ndarray, shards: float, bits: int = MAX_BITS, seed: int = SEED) -> list:
    """Nodes ``(v, r, inside, outside)``, or None for a leaf, of a tree whose
    leaves hold about ``1 / shards`` of the sample each."""
    rng, nodes, todo = np.random.default_rng(seed), [None], [(0, sample)]
    least = max(8.0, len(sample) / max(shards, 1e-9))
    while todo:
        at, x = todo.pop()
        if len(x) <= least or not (cut := _split(x, bits, rng)):
            continue
        inside, outside = _parts(x, *cut, bits)
        nodes[at] = (*cut, len(nodes), len(nodes) + 1)
        nodes += [None, None]
        todo += [(len(nodes) - 2, x[inside]), (len(nodes) - 1, x[outside])]
    return nodes


def route(x: np.ndarray, nodes: list, bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(shard, position) of every shard that each fingerprint belongs to."""
    shard, where, todo = [], [], [(0, np.arange(len(x)))]
    while todo:
        at, i = todo.pop()
        if not len(i):
            continue
        if nodes[at] is None:
            shard.append(np.full(len(i), at))
            where.append(i)
            continue
        v, r, a, b = nodes[at]
        inside, outside = _parts(x[i], v, r, bits)
        todo += [(a, i[inside]), (b, i[outside])]
    none = [np.zeros(0, np.int64)]
    return np.concatenate(shard or none), np.concatenate(where or none)


def _roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest position reachable from each of n over edges u-v."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(x: np.ndarray, bits: int) -> np.ndarray:
    """Roots of the links among x, all compared in blocks of rows."""
    n, root = len(x), np.arange(len(x))
    rows = max(1, CELLS // n)
    for at in range(0, n, rows):
        u, v = np.nonzero(np.bitwise_count(x[at:at + rows, None] ^ x[None, at:]) <= bits)
        keep = u < v
        u, v = np.concatenate([u[keep] + at, np.arange(n)]), np.concatenate([v[keep] + at, root])
        root = _roots(n, u, v)
    return root


def link_shard(x: np.ndarray, bits: int = MAX_BITS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (position, root position) of the links among distinct
    fingerprints: branches are split on vantage points until ``LEAF``."""
    rng, todo, us, vs = np.random.default_rng(seed), [np.arange(len(x))], [], []
    while todo:
        i = todo.pop()
        if len(i) < 2:
            continue
        cut = _split(x[i], bits, rng) if len(i) > LEAF else None
        if cut:
            inside, outside = _parts(x[i], *cut, bits)
            todo += [i[inside], i[outside]]
            continue
        root = _compare(x[i], bits)
        moved = np.flatnonzero(root != np.arange(len(i)))
        us.append(i[moved])
        vs.append(i[root[moved]])
    if not us:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    root = _roots(len(x), np.concatenate(us), np.concatenate(vs))
    moved = np.flatnonzero(root != np.arange(len(x)))
    return moved, root[moved]


def links(fps: DataFrame, max_bits: int = MAX_BITS, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """Edges ``(a, b)`` that connect whatever is connected among the distinct
    longs ``fp``: a spanning forest of each shard."""
    n = fps.count()
    drawn = fps if n <= sample else fps.where(
        F.pmod(F.xxhash64("fp"), F.lit(1 << 40)) < int((1 << 40) * sample / n * 0.95)).limit(sample)
    drawn = np.sort(drawn.select("fp").toPandas()["fp"].to_numpy(np.int64)).view(np.uint64)
    nodes = fit_tree(drawn, n / shard, max_bits) if n else [None]

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            x = f["fp"].to_numpy(np.int64)
            s, i = route(x.view(np.uint64), nodes, max_bits)
            yield pd.DataFrame({"shard": s, "fp": x[i]})

    def link(group: pd.DataFrame) -> pd.DataFrame:
        x = np.sort(group["fp"].to_numpy(np.int64))
        u, v = link_shard(x.view(np.uint64), max_bits)
        return pd.DataFrame({"a": x[u], "b": x[v]})

    return fps.select("fp").mapInPandas(send, "shard long, fp long").groupBy("shard").applyInPandas(link, "a long, b long")


def _labelled(df: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int, shard: int, sample: int) -> DataFrame:
    """``(id, fp, label, component_id)`` of every row; the label is its group's."""
    docs = saved(fingerprints(df, id_col, text_col, shingle), "simhash-docs")
    nodes = saved(docs.groupBy("fp").agg(F.min("id").alias("low")), "simhash-nodes")
    roots = connected_components(saved(links(nodes, max_bits, shard, sample), "simhash-links"), "simhash-cc")
    labelled = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("label"))
    lowest = labelled.groupBy("label").agg(F.min("low").alias("component_id"))
    of = labelled.join(lowest, "label").select(F.col("fp").alias("of_fp"), "label", "component_id")
    return docs.join(of, docs.fp == of.of_fp).select("id", "fp", "label", "component_id")


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   max_bits: int = MAX_BITS, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """``(<id_col>, fingerprint, component_id)`` of every row: the fingerprint in
    16 hex digits and the smallest id of the row's near-duplicate group."""
    return _labelled(df, id_col, text_col, shingle, max_bits, shard, sample).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                         max_bits: int = MAX_BITS, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``df``, all columns, of which one document per near-duplicate
    group stays: that with the smallest id, and of rows that share that id one of
    those with the smallest fingerprint.  An id repeated over several groups is
    decided in each of them.  Rows without an id stay."""
    groups = saved(_labelled(df, id_col, text_col, shingle, max_bits, shard, sample).where("id is not null"), "simhash-rows")
    ids = groups.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("id") == F.col("component_id")).alias("low"))
    once = df.join(saved(ids.where("n > 1 or not low").select(F.col("id").alias(id_col)), "simhash-gone"), id_col, "left_anti")
    once = once.select(df.columns)
    twice = saved(ids.where("n > 1").select("id"), "simhash-twice")
    if twice.isEmpty():
        return once
    # repeated ids: match rows on id and fingerprint, and keep one of each group
    key, fp = "__simhash_id", "__simhash_fp"
    kept = groups.where("id = component_id").groupBy("label").agg(F.min("id").alias(key), F.min("fp").alias("__simhash_kept"))
    few = df.join(twice.select(F.col("id").alias("__simhash_of")), F.col(id_col) == F.col("__simhash_of"), "left_semi")
    few = few.withColumn(fp, _fingerprint(F.col(text_col).cast("string"), shingle))
    few = few.join(kept.drop("label"), (F.col(id_col) == F.col(key)) & (F.col(fp) == F.col("__simhash_kept")), "left_semi")
    return once.unionByName(few.dropDuplicates([id_col, fp]).select(df.columns))


def _fingerprint(text: Column, shingle: int) -> Column:
    """The fingerprint's bits as a long."""
    def work(texts: pd.Series) -> pd.Series:
        fps = [fingerprint(None if t is None else t.encode(), shingle) for t in texts]
        return pd.Series(np.array(fps, np.uint64).view(np.int64))

    return F.pandas_udf(work, "long")(text)


# -- query -------------------------------------------------------------------------

def op1_simhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_groups(table(spark, sf, "documents"))
