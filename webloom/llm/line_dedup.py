"""Line deduplication with DataFrame functions only.

A text is split at line feeds.  A line's key is the line without ASCII white space
at its ends, A-Z lower-cased.  A key of at least ``MIN_CHARS`` code points that
several documents hold loses all its lines except in the document with the
smallest id; the others stay.

Lines become narrow rows ``(hash, document, position)`` with the key's 128-bit MD5
(equal hashes count as equal keys).  They are range-partitioned on the hash and
sorted by hash, document and position, so the first occurrence of each key streams
past before the later ones, and a later one of another document is dropped.  A key
that holds more than about ``GROUP`` lines is dealt out over several ranges by row
number; each range streams its own first occurrence, and the least of them, one
row a hot key, decides.  Which keys are hot is estimated on ``SAMPLE`` lines at
most; that steers partitioning only and doesn't show in the result.

The result is a bitmap per document instead of its text: 64 lines to a word, bit
set for lines that stay, and words whose lines all stay left out.  :func:`kept_text`
applies a bitmap.

Defined cases: null or empty text is one empty line; rows that repeat an id are one
document: they keep the lines that they share, and each has the bitmap of its own
text; documents without an id count as one document that comes after all others;
an empty table gives an empty result; other columns of the input are ignored by
the bitmaps and kept by :func:`drop_repeated_lines`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import table
from .common import saved

# White space that isn't part of a line's key.
ENDS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MIN_CHARS = 10                 # code points of the shortest key that is compared
GROUP = 1024                   # lines of a key in one range, about
SAMPLE = 1 << 20               # lines on which hot keys are estimated
SEEN = 16                      # lines of a hot key in the sample, at least
WORD = 64                      # lines to a bitmap word


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased.  (On a text of
    ASCII characters alone, ``lower`` does that and is faster.)"""
    bare = F.btrim(line, F.lit(ENDS))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def signature(text: Column) -> Column:
    """Tells texts of rows that repeat an id apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def hot_keys(lines: DataFrame, group: int = GROUP, sample: int = SAMPLE) -> DataFrame:
    """``(hot_h, ranges)`` of the keys that are dealt out; ``sample / SEEN`` rows
    at most."""
    n = lines.count()
    share = min(1.0, sample / max(n, 1))
    some = lines.select("h") if share == 1.0 else lines.select("h").sample(share, 7)
    count = F.count(F.lit(1)).alias("seen")
    hot = some.groupBy("h").agg(count).where(F.col("seen") > max(SEEN, group * share))
    return hot.select(F.col("h").alias("hot_h"), F.ceil(F.col("seen") / F.lit(share * group)).cast("long").alias("ranges"))


def dropped_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                  group: int = GROUP) -> DataFrame:
    """``(doc, sig, pos)`` of every line that goes."""
    rows = df.select(F.col(id_col).alias("doc"), signature(F.col(text_col)).alias("sig"),
                     F.posexplode(lines_of(F.col(text_col))).alias("pos", "line"))
    keys = rows.select("doc", "sig", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    lines = saved(keys.select("doc", "sig", "pos", F.unhex(F.md5(F.col("key").cast("binary"))).alias("h"),
                              F.monotonically_increasing_id().alias("row")), "line-keys")
    hot = saved(hot_keys(lines, group), "line-hot")

    # the hot keys are few by construction: SAMPLE / SEEN rows of 24 bytes
    dealt = lines.join(F.broadcast(hot), F.col("h") == F.col("hot_h"), "left").select(
        "h", F.coalesce(F.pmod(F.xxhash64("row"), F.col("ranges")), F.lit(-1)).alias("range"), "doc", "sig", "pos")
    ranged = dealt.repartitionByRange("h", "range")
    # the window finds its rows clustered by the range partitioning: no exchange
    passed = Window.partitionBy("h", "range").orderBy(F.col("doc").asc_nulls_last(), "pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    streamed = ranged.withColumn("first", F.first("doc").over(passed))
    later = saved(streamed.where("range >= 0 or not (doc <=> first)"), "line-later")

    # first occurrences of the ranges of a hot key
    least = later.where("range >= 0").groupBy(F.col("h").alias("hot_h")).agg(F.min("first").alias("hot_first"))
    later = later.join(F.broadcast(least), (F.col("h") == F.col("hot_h")) & (F.col("range") >= 0), "left")
    first = F.when(F.col("range") >= 0, F.col("hot_first")).otherwise(F.col("first"))
    return later.where(~F.col("doc").eqNullSafe(first)).select("doc", "sig", "pos")


def keep_bitmaps(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                 group: int = GROUP) -> DataFrame:
    """``(doc, sig, keep)`` of each id and text (signature) that loses lines;
    ``keep`` lists the words, as (number, bits), in which some line goes."""
    gone = dropped_lines(df, id_col, text_col, min_chars, group)
    word = gone.groupBy("doc", "sig", F.expr(f"pos div {WORD}").cast("int").alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast(pos % {WORD} as int)))").alias("gone"))
    kept = F.struct("word", F.bitwise_not(F.col("gone")).alias("bits"))
    return word.groupBy("doc", "sig").agg(F.sort_array(F.collect_list(kept)).alias("keep"))


def n_dropped(keep: str) -> Column:
    """Lines that a bitmap drops (null: none)."""
    return F.expr(f"coalesce(aggregate({keep}, 0L, (n, w) -> n + bit_count(~w.bits)), 0L)")


def kept_text(text: Column, keep: str) -> Column:
    """The lines of ``text`` that the bitmap column ``keep`` (null: all) keeps,
    joined by line feeds.  Words and lines are bound once, and a line finds its
    bit by position: linear in the text."""
    words, all_kept = F.col(keep), F.lit(-1).cast("long")

    def spread(w: Column, i: Column) -> Column:
        before = F.when(i == 0, 0).otherwise(F.get(words, i - 1)["word"] + 1)
        return F.concat(F.array_repeat(all_kept, w["word"] - before), F.array(w["bits"]))

    def cut(bound: Column) -> Column:
        def stays(line: Column, i: Column) -> Column:
            bits = F.coalesce(F.get(bound["words"], F.floor(i / WORD).cast("int")), all_kept)
            return F.call_function("shiftright", bits, i % WORD).bitwiseAND(F.lit(1)) == 1
        return F.array_join(F.filter(bound["lines"], stays), "\n")

    bound = F.array(F.struct(lines_of(text).alias("lines"), F.flatten(F.transform(words, spread)).alias("words")))
    whole = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(words.isNull(), whole).otherwise(F.get(F.transform(bound, cut), F.lit(0)))


def with_bitmaps(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                 group: int = GROUP) -> DataFrame:
    """The rows of ``df``, all columns, and ``__keep``: the row's bitmap, null if
    all its lines stay."""
    maps = keep_bitmaps(df, id_col, text_col, min_chars, group).select(
        F.col("doc").alias("__doc"), F.col("sig").alias("__of"), F.col("keep").alias("__keep"))
    return df.join(maps, F.col(id_col).eqNullSafe(F.col("__doc")) & (signature(F.col(text_col)) == F.col("__of")),
                   "left").select(*(df[c] for c in df.columns), "__keep")


def drop_repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                        group: int = GROUP) -> DataFrame:
    """The rows of ``df``, all columns, whose texts hold only the lines that stay
    (texts that lose none are as they were)."""
    rows = with_bitmaps(df, id_col, text_col, min_chars, group)
    text = F.when(F.col("__keep").isNull(), F.col(text_col)).otherwise(kept_text(F.col(text_col), "__keep"))
    return rows.withColumn(text_col, text).select(df.columns)


# -- query -------------------------------------------------------------------------

ORACLE = f"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents),
k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') as key
    from l),
g as (select key, min(doc_id) as first from k where length(key) >= {MIN_CHARS} group by key having count(distinct doc_id) > 1),
m as (select doc_id, line, pos, g.first is not null and g.first <> doc_id as gone from k left join g using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from m group by doc_id"""


def op12_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_bitmaps(table(spark, sf, "documents"))
    return rows.select("doc_id", F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"),
                       n_dropped("__keep").alias("n_dropped"),
                       F.sha2(kept_text(F.col("text"), "__keep").cast("binary"), 256).alias("kept_sha256"))
