"""Mixing sources to target weights by subset-sum budget fitting.

A document's size is its number of words.  Sources, in code point order with
null last, weigh 3, 1, 2, repeating, and share 150 % of all words; a target stops
at twice its source's words, and what it leaves is shared again by weight.

A source takes whole passes over its documents while its target allows; the
rest is fitted by subset sum over counts of documents by exact size:

1. the same share of every size's documents is taken (rounded down), which keeps
   the mix of lengths;
2. of the sizes, longest first, one more document each, down to ``EXACT`` words;
3. a bounded-knapsack dynamic programme over the remaining documents' sizes
   picks the sum nearest to what is still missing.

Which documents of a size are taken a second time (or at all) is decided by a
seeded hash of the id, so reruns agree.  The fit sees one row per source and
size, never documents.  Ranks are counted within hash buckets of about
``BUCKET`` documents, so copies that fill one size of one source don't meet in
one task.

Defined cases: null text has size 0 and is taken 0 words; sources without words
have target 0; rows that repeat an id are ranked as separate documents; an empty
table gives an empty result; other columns are ignored by the query and kept by
:func:`mixed`.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import table
from .common import WORD, saved

WEIGHTS = (3, 1, 2)            # of sources in order, repeating
SHARE = 1.5                    # words of the mix, of all words
CAP = 2                        # a target's most, in words of its source
SEED = 42
EXACT = 4096                   # words left for the dynamic programme, about
BUCKET = 4096                  # documents of one size and source ranked together, about


def n_words(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``(source, source_size, target)``.  Targets are ``least(cap, level * weight)``
    at the level where they add up; the level is the largest of those that
    follow from capping the sources that reach their caps first.  One row per
    source passes through the unpartitioned windows."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                (nth % len(weights) + 1).cast("int")))
    per = per.withColumn("most", F.col("source_size") * float(cap))
    by = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    capped = F.coalesce(F.sum("most").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("total", F.sum("source_size").over(everything) * share)
    per = per.withColumn("level_from", (F.col("total") - capped) / open_weight)
    per = per.withColumn("level", F.max("level_from").over(everything))
    return per.select("source", "source_size", F.least("most", F.col("level") * F.col("weight")).alias("target"))


def nearest_sum(sizes: list[int], counts: list[int], want: int) -> list[int]:
    """How many of each size to take so that their sum is nearest to ``want``
    (below it on ties): bounded knapsack over a bit set of reachable sums."""
    take = [0] * len(sizes)
    if want <= 0 or not sizes:
        return take
    top = 2 * want                           # any farther above loses to taking nothing
    mask = (1 << (top + 1)) - 1
    reach, steps = 1, []
    for i, (size, n) in enumerate(zip(sizes, counts)):
        n, lot = min(n, top // size), 1
        while n > 0 and not reach >> want & 1:
            lot = min(lot, n)
            steps.append((i, lot, reach))
            reach |= reach << size * lot & mask
            n, lot = n - lot, lot * 2
    below = (reach & ((1 << (want + 1)) - 1)).bit_length() - 1
    above = reach >> (want + 1)
    up = want + 1 + ((above & -above).bit_length() - 1) if above else None
    at = up if up is not None and up - want < want - below else below
    for i, lot, before in reversed(steps):
        if not before >> at & 1:
            take[i] += lot
            at -= sizes[i] * lot
    return take


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: float, exact: int = EXACT) -> np.ndarray:
    """How many documents of each (distinct, positive) size to take for a budget
    of less than all their words."""
    sizes, counts = sizes.astype(np.int64), counts.astype(np.int64)
    all_words = int((sizes * counts).sum())
    if not all_words or budget <= 0:
        return np.zeros(len(sizes), np.int64)
    want = min(all_words, int(round(budget)))
    k = np.minimum(counts, np.floor(counts * (want / all_words)).astype(np.int64))
    left = want - int((sizes * k).sum())
    for i in np.argsort(-sizes, kind="stable"):
        if left - exact < 0:
            break
        if k[i] < counts[i] and sizes[i] <= left - exact:
            k[i] += 1
            left -= int(sizes[i])
    order = [i for i in np.argsort(sizes, kind="stable").tolist() if k[i] < counts[i] and sizes[i] <= 2 * left]
    for i, n in zip(order, nearest_sum([int(sizes[i]) for i in order], [int(counts[i] - k[i]) for i in order], left)):
        k[i] += n
    return k


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    sizes, counts = group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
    total, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    passes = min(int(target // total), CAP) if total else 0
    k = np.zeros(len(group), np.int64)
    if total and passes < CAP:
        some = sizes > 0
        k[some] = fit_counts(sizes[some], counts[some], target - passes * total)
    return pd.DataFrame({"source": group["source"], "size": sizes, "n": counts, "passes": passes, "more": k,
                         "source_size": total, "target": target})


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: int = SEED) -> DataFrame:
    """Every row's ``(<id_col>, source, size, source_size, target, times, taken)``."""
    docs = saved(df.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                           n_words(F.col(text_col).cast("string")).alias("size")), "mix-sizes")
    lengths = docs.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    goals = source_targets(docs).withColumnRenamed("source", "of")
    plan = lengths.join(goals, F.col("source").eqNullSafe(F.col("of"))).drop("of").groupBy("source").applyInPandas(
        _fit, "source string, size long, n long, passes long, more long, source_size long, target double")
    plan = saved(plan.select(F.col("source").alias("p_source"), F.col("size").alias("p_size"), "n", "passes", "more",
                             "source_size", "target"), "mix-plan")
    h = F.pmod(F.xxhash64(F.lit(seed), F.col("id").cast("string")), F.lit(1 << 40))
    rows = docs.join(plan, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size"))).select(
        "id", "source", "size", "n", "passes", "more", "source_size", "target", h.alias("h"))
    part = F.floor(F.col("h") * F.ceil(F.col("n") / F.lit(BUCKET)) / F.lit(float(1 << 40)))
    some = saved(rows.where("more > 0 and more < n").withColumn("part", part), "mix-ranked")
    # documents of the hash buckets before a bucket
    key = ["source", "size", "part"]
    before = some.groupBy(*key).agg(F.count(F.lit(1)).alias("m")).select(
        F.col("source").alias("b_source"), F.col("size").alias("b_size"), F.col("part").alias("b_part"),
        (F.sum("m").over(Window.partitionBy("source", "size").orderBy("part")) - F.col("m")).alias("before"))
    ranked = some.join(before, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("size") == F.col("b_size"))
                       & (F.col("part") == F.col("b_part")))
    rank = F.col("before") + F.row_number().over(Window.partitionBy(*key).orderBy("h", "id"))
    ranked = ranked.withColumn("times", F.col("passes") + (rank <= F.col("more")).cast("long"))
    plain = rows.where("not (more > 0 and more < n)").withColumn(
        "times", F.col("passes") + (F.col("more") > 0).cast("long"))
    out = plain.drop("h").unionByName(ranked.drop("h", "part", "b_source", "b_size", "b_part", "before"))
    return out.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", "times",
                      (F.col("times") * F.col("size")).alias("taken"))


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          seed: int = SEED) -> DataFrame:
    """The mix itself: the rows of ``df``, all columns, each as often as it is
    taken.  Rows that repeat an id and a size are taken alike."""
    chosen = mix(df, id_col, text_col, source_col, seed).where("times > 0 and size > 0").groupBy(id_col, "size").agg(
        F.max("times").cast("int").alias("__mix_times"))
    chosen = saved(chosen.select(F.col(id_col).alias("__mix_id"), F.col("size").alias("__mix_size"), "__mix_times"),
                   "mix-chosen")
    rows = df.withColumn("__mix_n", n_words(F.col(text_col).cast("string")))
    rows = rows.join(chosen.hint("merge"), F.col(id_col).eqNullSafe(F.col("__mix_id")) & (F.col("__mix_n") == F.col("__mix_size")))
    again = F.explode(F.sequence(F.lit(1), F.col("__mix_times")))
    return rows.withColumn("__mix_copy", again).select(df.columns)


# -- query -------------------------------------------------------------------------

def op4_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mix(table(spark, sf, "documents")).drop("times")
