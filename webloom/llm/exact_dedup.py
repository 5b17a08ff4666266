"""Exact deduplication with DataFrame functions only.

Texts are equal when they agree after every run of ASCII white space becomes
one space.  Rows are grouped by the 128-bit MD5 of that text; the smallest id of
a group stays.  Bytes are compared inside groups by ``min(text) = max(text)``:
equal bytes give equal extremes.  That comparison is an aggregate, so copies
collapse in each map task and a group holding a third of all rows never meets
in one task.  Only texts whose hash occurs more than once take part.  A hash
shared by different texts (a collision) is split exactly, by the text itself.
Bitmaps of the repeated hashes keep most other texts out of the shuffle.

Defined cases: null text counts as empty; of rows that repeat both the id and
the text one is kept; a row without an id is kept only if no row of its group
has one, and then one row is; an empty table gives an empty result; other
columns of the input don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import table
from .common import SPACE, saved, small_batches

SLOTS = 16                     # bits of the bitmaps for each repeated hash
MAP_BYTES = 64 << 20           # of bitmaps, at most


def normalised(text: Column) -> Column:
    """``text`` with each run of ASCII white space as one space; null is empty."""
    # a lone space already is what it would become
    runs = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), runs, " ")


def suspects(hashed: DataFrame, many: DataFrame) -> DataFrame:
    """The rows of ``hashed`` whose ``h`` is among ``many``, and a few others.  A row is
    let through by one bit of bitmaps with ``SLOTS`` bits a hash; where these would pass
    ``MAP_BYTES``, all rows are."""
    slots = SLOTS * max(1, many.count())
    if slots > 8 * MAP_BYTES:
        return hashed
    slot = F.pmod(F.xxhash64("h"), F.lit(slots))
    maps = many.groupBy(F.bitmap_bucket_number(slot).alias("of")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    place = F.bitmap_bit_position(slot).cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    return hashed.join(F.broadcast(maps), F.bitmap_bucket_number(slot) == F.col("of")).where(
        F.getbit(byte, place % 8) == 1).select(hashed.columns)


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", content_hash=F.md5) -> DataFrame:
    """Every row's ``(<id_col>, keep_id, group_size, kept, text_sha256)``.

    ``content_hash`` maps the normalised text's bytes to the grouping hash; a
    weak one may be given, the result is the same.  The texts are read here, a few
    hundred at once; the result reads only their hashes.
    """
    with small_batches(df.sparkSession):
        return _exact_groups(df, id_col, text_col, content_hash)


def _exact_groups(df: DataFrame, id_col: str, text_col: str, content_hash) -> DataFrame:
    text = normalised(F.col(text_col))
    rows = df.select(F.col(id_col).alias("id"), text.alias("text"))
    keys = saved(rows.select("id", content_hash(F.col("text").cast("binary")).alias("h"),
                             F.sha2(F.col("text").cast("binary"), 256).alias("sha")), "exact-keys")
    many = saved(keys.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "exact-many")

    # equal bytes inside each group of two or more
    hashed = rows.withColumn("h", content_hash(F.col("text").cast("binary")))
    # (a merge join at every size: the hashes grow with the input)
    texts = suspects(hashed, many).join(many.withColumnRenamed("h", "many_h").hint("merge"), F.col("h") == F.col("many_h"))
    # grouping by a derived key leaves the join free to split a hot hash, and the
    # partial aggregate folds each part before the next exchange
    mixed = saved(texts.groupBy(F.concat(F.col("h").cast("string"), F.lit("|")).alias("g"))
                  .agg(F.min("text").alias("lo"), F.max("text").alias("hi"), F.min("h").alias("h"))
                  .where("lo <> hi").select("h"), "exact-collisions")

    keys = keys.withColumn("part", F.lit(""))
    if not mixed.isEmpty():
        # split colliding groups by their texts; sha only names a part, bytes made it
        parts = (hashed.join(mixed.select(F.col("h").alias("mixed_h")), F.col("h") == F.col("mixed_h"))
                 .groupBy("h", "text").agg(F.min("id").alias("i"))
                 .select("h", F.sha2(F.col("text").cast("binary"), 256).alias("s")).distinct()
                 .select(F.col("h").alias("part_h"), "s"))
        parts = saved(parts, "exact-parts")
        keys = keys.join(parts, (F.col("h") == F.col("part_h")) & (F.col("sha") == F.col("s")), "left").select(
            "id", "h", "sha", F.coalesce("s", F.lit("")).alias("part"))

    groups = keys.groupBy("h", "part").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.select(F.col("h").alias("gh"), F.col("part").alias("gp"), "keep_id", "group_size")
    out = keys.join(groups, (F.col("h") == F.col("gh")) & (F.col("part") == F.col("gp")))
    # of rows that repeat the kept id, one stays: the window holds only those
    first = F.col("id").eqNullSafe(F.col("keep_id"))
    again = F.row_number().over(Window.partitionBy("h", "part", first).orderBy(F.lit(1)))
    keepers = out.where(first).withColumn("kept", again == 1)
    rest = out.where(~first).withColumn("kept", F.lit(False))
    return keepers.unionByName(rest).select(F.col("id").alias(id_col), "keep_id", "group_size", "kept",
                                            F.col("sha").alias("text_sha256"))


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, that are kept.  Where an id itself is
    repeated, one row stays for each id and text."""
    groups = saved(exact_groups(df, id_col, text_col), "exact-groups")
    ids = groups.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("any"))
    gone = ids.where(f"n = 1 and not any and `{id_col}` is not null").select(id_col)
    twice = saved(ids.where(f"n > 1 or `{id_col}` is null").select(id_col), "exact-twice")
    if twice.isEmpty():
        return df.join(saved(gone, "exact-gone"), id_col, "left_anti").select(df.columns)
    # repeated ids: match rows on id and text, and keep one of each
    sha, key = "__exact_sha", "__exact_id"
    kept = groups.where("kept").groupBy(F.col(id_col).alias(key), F.col("text_sha256").alias("__exact_kept")).agg(
        F.count(F.lit(1)).alias("__exact_n"))
    full = df.withColumn(sha, F.sha2(normalised(F.col(text_col)).cast("binary"), 256))
    few = full.join(twice.select(F.col(id_col).alias("__exact_of")),
                    F.col(id_col).eqNullSafe(F.col("__exact_of")), "left_semi")
    few = few.join(kept, F.col(id_col).eqNullSafe(F.col(key)) & (F.col(sha) == F.col("__exact_kept")), "left_semi")
    few = few.dropDuplicates([id_col, sha]).select(df.columns)
    once = df.join(saved(gone, "exact-gone"), id_col, "left_anti")
    once = once.join(twice.select(F.col(id_col).alias("__exact_of")),
                     F.col(id_col).eqNullSafe(F.col("__exact_of")), "left_anti").select(df.columns)
    return once.unionByName(few)


# -- query -------------------------------------------------------------------------

ORACLE = f"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g') as x from documents),
g as (select x, min(doc_id) as keep_id, count(*) as group_size from t group by x)
select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, sha256(t.x) as text_sha256
from t join g on t.x = g.x"""


def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_groups(table(spark, sf, "documents"))
