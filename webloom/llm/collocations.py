"""Phrase collocation mining by Toivonen's sampling.

Words are what spaces and tabs separate in a piece, pieces what punctuation and
line ends separate in a text, A-Z lower-cased; phrases are up to ``LONGEST`` words
within a piece.  A phrase of a language is frequent from ``SUPPORT`` occurrences
on, overlaps included.

1. *Sample.*  One document in ``SHARE`` (by a hash of id and text) proposes the
   phrases that reach the lowered support there: words, then longer phrases level
   by level.
2. *Full pass.*  All documents are counted once, exactly: every word, and every
   longer phrase whose two longest parts (all but the last word, all but the first)
   are proposed.  Those are the proposals and their negative border.
3. *Expansion.*  A border phrase that turns out frequent was missed by the sample.
   If there are any, another pass counts what is eligible only through them: a part
   now also passes if it is a missed phrase or holds one.  A frequent phrase that
   the full pass didn't count holds a missed phrase (the shortest of its parts that
   isn't proposed), and so does each of its parts that isn't proposed; so this pass
   counts it, whatever its length, and the set is closed.

A pass finds proposals and missed phrases in filters of ``GATE_BITS`` bits each, the
only things that are broadcast; their size doesn't depend on the data.  What a filter
lets through by mistake is counted like any border phrase and falls to the support,
so results are exact; the more proposals beyond about ``GATE_BITS / 20``, the more a
pass counts, at most all phrases, which is linear in the text.  Whether a phrase is
eligible depends on the phrase alone, so each is counted in exactly one pass.

Python tasks encode blocks of text (about ``BLOCK`` bytes of a language) as numbers
of a block's distinct words and count phrases by sorting numbers, without hashing.
A phrase leaves a block as one row; Spark adds them up, first in each map task, so
the most frequent phrase has a row a task.  Counts and proposals are tables.

Defined cases: null text has no words; null languages count as ``und``, together
with languages of that name; repeated rows are counted as often as they occur; a
text beyond a block is cut where a piece ends, or else at a gap, with the next
words looked at but not counted; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.policy import limit_per_group
from ..session import table
from .common import saved

# What ends a piece, what separates words, the language of null.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
GAPS = b" \t"
NO_LANG = "und"

SUPPORT = 30                   # occurrences of a frequent phrase
LONGEST = 4                    # words of a phrase
INSIDE = 80                    # percent of a phrase's occurrences in a longer one that drop it
SCALE = 2000000                # of scores
TOP = 2000                     # phrases of a language
SHARE = 4                      # one document in so many is in the sample
LOWER = 1.0                    # part of the expected support that the sample asks for
BLOCK = 4 << 20                # bytes of a language that a task counts together, about
HELD = 4                       # blocks that a task gathers at once, of all languages
GATE_BITS = 1 << 27            # of the filter of proposals: 16 MB

_KIND = np.zeros(256, np.uint8)
_KIND[list(GAPS)], _KIND[list(PIECE_ENDS)] = 1, 2
_END = re.compile(rb"[.,;:!?\n-\r]")
_GAP = re.compile(rb"[ \t.,;:!?\n-\r]")
_NEXT = re.compile(rb"(?:[ \t]+[^ \t.,;:!?\n-\r]+){0,%d}" % (LONGEST - 1))
_SCHEMA = pa.schema([("lang", pa.string()), ("words", pa.int8()), ("phrase", pa.string()), ("n", pa.int64())])


def segments(data: bytes, limit: int = BLOCK) -> Iterator[tuple[bytes, int]]:
    """A text in parts of about ``limit`` bytes, and how many bytes of each are
    its own: phrases that start behind them belong to the next part."""
    at = 0
    while len(data) - at > limit:
        stop = at + limit
        end = _END.search(data, stop, stop + limit)
        if end:
            stop = more = end.end()
        else:
            gap = _GAP.search(data, stop)
            stop = gap.start() if gap else len(data)
            more = _NEXT.match(data, stop).end()
        yield data[at:more], stop - at
        at = stop
    yield data[at:], len(data) - at


class Block:
    """Texts of one language as word numbers: ``ids`` into ``vocabulary``, whether
    the next word follows in the same piece, and whether a word is the block's own."""

    def __init__(self, parts: list[tuple[bytes, int]]):
        data = np.frombuffer(b"\n".join(p for p, _ in parts).lower(), np.uint8)
        kind = _KIND[data]
        word = np.zeros(len(data) + 2, bool)
        word[1:-1] = kind == 0
        at = np.flatnonzero(word[1:] & ~word[:-1])
        ends = np.flatnonzero(word[:-1] & ~word[1:])
        offsets = np.zeros(len(at) + 1, np.int32)
        np.cumsum(ends - at, out=offsets[1:])
        packed = pa.py_buffer(data[word[1:-1]])
        words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), packed]).dictionary_encode()
        self.vocabulary, self.ids = words.dictionary, words.indices.to_numpy()
        pieces = np.searchsorted(np.flatnonzero(kind == 2), at)
        self.joined = pieces[1:] == pieces[:-1]
        self.own = np.ones(len(at), bool)
        begin = 0
        for part, own in parts:
            if own < len(part):
                self.own[np.searchsorted(at, begin + own):np.searchsorted(at, begin + len(part))] = False
            begin += len(part) + 1


def _mix(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of all but its last word and of that word."""
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + word
    return h ^ (h >> np.uint64(32))


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _places(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a hash in a filter of ``size`` bits."""
    return h % np.uint64(size), (h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) % np.uint64(size)


class Gate:
    """Filter of proposed phrases, over 64-bit words of bits."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for place in _places(h, 64 * len(self.bits)):
            found &= (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def _distinct(columns: list[np.ndarray], size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of columns of numbers below ``size``, and how often each
    occurs.  Rows are packed into one number; where that would pass 62 bits, what is
    packed so far is numbered anew."""
    key, top, steps = columns[0].astype(np.int64), size, []
    for column in columns[1:]:
        if top > (1 << 62) // size:
            table, key = np.unique(key, return_inverse=True)
            top = len(table)
            steps.append(table)
        key, top = key * size + column, top * size
        steps.append(None)
    key, n = np.unique(key, return_counts=True)
    out = []
    for table in reversed(steps):
        if table is None:
            key, last = np.divmod(key, size)
            out.append(last)
        else:
            key = table[key]
    return [key, *reversed(out)], n


def count_block(lang: str, parts: list[tuple[bytes, int]], levels: tuple, gate: Gate | None,
                missed: Gate | None) -> Iterator[pa.RecordBatch]:
    """Counts of the block's phrases of ``levels`` words that are eligible by the
    proposals in ``gate``; given ``missed``, of those that are only through it.  All
    words are eligible; one empty phrase counts them together."""
    b = Block(parts)
    words, ids, own = b.vocabulary, b.ids, b.own

    def batches(k: int, phrases: pa.Array, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(n), 1 << 16):
            some = phrases[i:i + (1 << 16)].cast(pa.string())
            yield pa.record_batch([pa.array([lang] * len(some), pa.string()), pa.array(np.full(len(some), k, np.int8)), some,
                                   pa.array(n[i:i + (1 << 16)], pa.int64())], schema=_SCHEMA)

    if 1 in levels and own.any():
        n = np.bincount(ids[own], minlength=len(words))
        yield from batches(1, words.filter(pa.array(n > 0)), n[n > 0])
        yield from batches(0, pa.array([b""]), np.array([own.sum()]))
    if max(levels) == 1 or not len(ids):
        return

    # by the place where a phrase of k - 1 words starts: its hash, whether it lets a
    # longer one pass, did so before, and whether it is or holds a missed phrase
    word_hash = _word_hashes(lang, words.to_pylist())
    hashes, before = word_hash[ids], gate.has(word_hash)[ids]
    holds = missed.has(word_hash)[ids] if missed else np.zeros(len(ids), bool)
    passes = before | holds
    for k in range(2, max(levels) + 1):
        now, was = passes[:-1] & passes[1:], before[:-1] & before[1:]
        if k == 2:
            now, was = now & b.joined, was & b.joined
        if k in levels:
            at = np.flatnonzero((now & ~was if missed else now) & own[:len(now)])
            if len(at):
                numbers, n = _distinct([ids[at + i] for i in range(k)], len(words))
                yield from batches(k, pc.binary_join_element_wise(*(words.take(pa.array(x)) for x in numbers), b" "), n)
        at = np.flatnonzero(now)
        h = _mix(hashes[at], word_hash[ids[at + k - 1]])
        hashes, proposed = np.zeros(len(now), np.uint64), np.zeros(len(now), bool)
        hashes[at], proposed[at] = h, gate.has(h)
        before = proposed & was
        holds = holds[:-1] | holds[1:]
        if missed:
            holds[at] |= missed.has(h)
        passes = (proposed | holds) & now


def lang_of(lang_col: str) -> Column:
    return F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG))


def phrase_counts(docs: DataFrame, levels: tuple, gate=None, missed=None, block: int = BLOCK) -> DataFrame:
    """``(lang, words, phrase, n)`` of one pass over ``docs (lang, text)``; gates are
    broadcast bit words."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gates = [Gate(np.frombuffer(g.value, np.uint64)) if g else None for g in (gate, missed)]
        waiting, size = defaultdict(list), defaultdict(int)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part in segments(text.as_buffer().to_pybytes(), block):
                    waiting[lang].append(part)
                    size[lang] += len(part[0])
                    if size[lang] >= block or sum(size.values()) >= HELD * block:
                        for full in [lang] if size[lang] >= block else [*waiting]:
                            yield from count_block(full, waiting.pop(full), levels, *gates)
                            del size[full]
        for lang, parts in waiting.items():
            yield from count_block(lang, parts, levels, *gates)

    rows = docs.mapInArrow(work, "lang string, words tinyint, phrase string, n long")
    return rows.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))


def gate_of(proposals: DataFrame, bits: int = GATE_BITS):
    """The filter of a table of phrases, broadcast.  Tasks set bits, Spark joins
    them, and the driver receives at most ``bits / 64`` words."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang = defaultdict(list)
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang[lang].append(phrase.encode().split(b" "))
            for lang, phrases in by_lang.items():
                flat = _word_hashes(lang, [w for p in phrases for w in p])
                size = np.array([len(p) for p in phrases])
                begin = np.cumsum(size) - size
                h = flat[begin]
                for k in range(1, int(size.max())):
                    more = size > k
                    h[more] = _mix(h[more], flat[begin[more] + k])
                place = np.concatenate(_places(h, bits))
                word, bit = (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))
                order = np.argsort(word, kind="stable")
                word, at = np.unique(word[order], return_index=True)
                yield pa.record_batch([pa.array(word), pa.array(np.bitwise_or.reduceat(bit[order], at).view(np.int64))],
                                      names=["at", "bits"])

    rows = proposals.select("lang", "phrase").mapInArrow(work, "at long, bits long")
    words = rows.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words["at"].to_numpy()] = words["bits"].to_numpy()
    return proposals.sparkSession.sparkContext.broadcast(out.tobytes())


def frequent_phrases(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     support: int = SUPPORT, longest: int = LONGEST, share: int = SHARE, lower: float = LOWER,
                     gate_bits: int = GATE_BITS, block: int = BLOCK) -> DataFrame:
    """``(lang, words, phrase, n)`` of every frequent phrase, by language and
    number of words; a row with 0 words and an empty phrase holds a language's
    word occurrences."""
    text = F.col(text_col).cast("string")
    docs = df.select(lang_of(lang_col).alias("lang"), text.alias("text"),
                     F.xxhash64(F.col(id_col).cast("string"), text).alias("h")).where("text is not null")
    sample = saved(docs.where(F.pmod("h", F.lit(share)) == 0).select("lang", "text"), "phrases-sample")
    docs = docs.select("lang", "text")

    least = max(2, int(np.ceil(support / share * lower)))
    proposed, gate = None, None
    for k in range(1, longest):
        level = phrase_counts(sample, (k,), gate, block=block).where(f"n >= {least} and words > 0").select("lang", "phrase")
        level = saved(level, f"phrases-proposed-{k}")
        proposed = level if proposed is None else proposed.unionByName(level)
        if gate:
            gate.destroy()
        gate = gate_of(proposed, gate_bits)

    least = f"n >= {support} or words = 0"
    found = saved(phrase_counts(docs, tuple(range(1, longest + 1)), gate, block=block).where(least), "phrases-counted")
    missed = found.where(f"words between 1 and {longest - 1}").select("lang", "phrase").join(
        proposed, ["lang", "phrase"], "left_anti")
    missed = saved(missed, "phrases-missed")
    if not missed.isEmpty():
        through = gate_of(missed, gate_bits)
        more = phrase_counts(docs, tuple(range(2, longest + 1)), gate, through, block).where(least)
        found = found.unionByName(saved(more, "phrases-expanded"))
        through.destroy()
    gate.destroy()
    return found


def collocations(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 support: int = SUPPORT, top: int = TOP, inside: int = INSIDE, **mining) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)`` of each language's first ``top``
    phrases of two words or more: occurrences of the phrase and of the two parts of
    its weakest cut, the language's words, and ``SCALE * a / (l + r)`` rounded down."""
    found = frequent_phrases(df, id_col, text_col, lang_col, support, **mining)
    parts = found.where("words > 0").select("lang", "phrase", "n")
    phrases = found.where("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"),
                                              F.split("phrase", " ").alias("w"))

    # the weakest cut: both parts of each cut are frequent, so they are there
    cuts = phrases.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        of = parts.select(F.col("lang").alias("of_lang"), F.col("phrase").alias("of"), F.col("n").alias(name))
        cuts = cuts.join(of, (F.col("lang") == F.col("of_lang")) & (F.col(side) == F.col("of"))).drop("of_lang", "of", side)
    exact = F.expr(f"cast(a as decimal(20,0)) * cast({SCALE} as decimal(8,0)) div (cast(l as decimal(20,0)) + r)")
    cuts = cuts.withColumn("score", exact.cast("long"))
    scored = cuts.groupBy("lang", "phrase").agg(F.min("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # the most frequent longer phrase around each phrase
    longer = phrases.where("words > 2").select("lang", "w", "a", F.explode(F.expr(
        "flatten(transform(sequence(2, size(w) - 1), k -> transform(sequence(1, size(w) - k + 1), i -> array_join(slice(w, i, k), ' '))))"
    )).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(
        F.expr(f"around is null or cast(around as decimal(20,0)) * 100 < cast(a as decimal(20,0)) * {inside}"))

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = limit_per_group(kept, ["lang"], order, top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    totals = found.where("words = 0").select(F.col("lang").alias("of_lang"), "n")
    return best.withColumn("rank", rank).join(totals, F.col("lang") == F.col("of_lang")).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


# -- query -------------------------------------------------------------------------

ORACLE = f"""
with p as (select coalesce(lang, '{NO_LANG}') as lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from p),
t as (select lang, cast(sum(len(w)) as bigint) as n from w group by lang),
g as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase from (
    select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from w, range(1, {LONGEST + 1}) as r(k))),
f as (select lang, k, phrase, count(*) as a from g group by all having count(*) >= {SUPPORT}),
c as (select lang, phrase, a, i, array_to_string(v[1:i], ' ') as x, array_to_string(v[i + 1:], ' ') as y from (
    select lang, phrase, a, string_split(phrase, ' ') as v, unnest(range(1, k)) as i from f where k > 1)),
s as (select c.lang, c.phrase, c.a, i, f.a as l, h.a as r, (2000000::hugeint * c.a) // (f.a + h.a) as score
    from c join f on f.lang = c.lang and f.phrase = x join f as h on h.lang = c.lang and h.phrase = y),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, i) = 1),
o as (select lang, array_to_string(v[i:i + j - 1], ' ') as phrase, max(a) as a from (
    select lang, v, a, j, unnest(range(1, k - j + 2)) as i from (
        select lang, k, a, string_split(phrase, ' ') as v, unnest(range(2, k)) as j from f where k > 2)) group by all),
q as (select b.*, row_number() over (partition by b.lang order by b.score desc, b.a desc, b.phrase) as rank
    from b left join o using (lang, phrase) where o.a is null or 100::hugeint * o.a < {INSIDE}::hugeint * b.a)
select q.lang, rank, phrase, a, l, r, n, cast(score as bigint) as score
from q join t on t.lang = q.lang where rank <= {TOP}"""


def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations(table(spark, sf, "documents"))
