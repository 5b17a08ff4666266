"""Language identification by compression.

For every language a raw-content zstandard dictionary is cut from a bounded
sample of distinct labelled training texts.  A text is compressed with each language's
dictionary, block by block over its whole length, and the language with the
smallest sum of sizes wins; a narrow margin rejects.

Only the dictionaries are fitted on a sample: at most ``SAMPLE_ROWS`` texts per
language, of each at most ``PIECE_BYTES`` bytes from anywhere in the text, in all
at most ``DICT_BYTES`` for a dictionary.  Which rows is decided by a hash of the
text, so reruns agree.  Lines that several languages share (licences, spam) and
repeated lines teach nothing about a language and are left out.  Prediction
reads whole texts.  Dictionaries and texts are lower-cased, and every block
ends in a short run of zero bytes, which keeps very short texts from being
stored uncompressed, where all languages would tie.

Defined cases: null text or text without a letter gives ``und`` with score 0
and is rejected; no labelled training row gives ``und`` everywhere; ties go to
the language first by code point; an empty table gives an empty result; other
columns are kept by the filter and ignored by the query, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import table

SAMPLE_ROWS = 128              # distinct training texts per language, at most
PIECE_BYTES = 1024             # bytes taken of a training row, at most
DICT_BYTES = 32768             # bytes of a language's dictionary, at most
BLOCK_BYTES = 1024             # a text is compressed in blocks of this size
PAD = b"\0" * 64               # ends every block
MARGIN = 0.002                 # rejected if the second best is within this share of the best
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")


def fit_dictionaries(train: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS,
                     piece_bytes: int = PIECE_BYTES, dict_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """Language -> raw dictionary, from the rows with a language and a text.
    Texts are drawn by their distinct hashes, so copies count once; only the drawn
    texts' pieces, at most ``sample_rows`` per language and task, are shuffled."""
    text = F.col(text_col).cast("string")
    room = F.greatest(F.lit(1), F.octet_length(text) - piece_bytes + 1)
    start = (F.pmod(F.xxhash64(text, F.lit(1)), room) + 1).cast("int")
    rows = train.where(F.col(lang_col).isNotNull() & (F.octet_length(text) > 0)).select(
        F.col(lang_col).cast("string").alias("lang"), F.xxhash64(text).alias("h"),
        F.substr(text.cast("binary"), start, F.lit(piece_bytes)).alias("piece"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    drawn = rows.select("lang", "h").distinct().withColumn("nth", nth).where(F.col("nth") <= sample_rows).select(
        F.col("lang").alias("drawn_lang"), F.col("h").alias("drawn_h"))
    rows = rows.join(F.broadcast(drawn), (F.col("lang") == F.col("drawn_lang")) & (F.col("h") == F.col("drawn_h")))
    rows = rows.groupBy("lang", "h").agg(F.min("piece").alias("piece")).orderBy("lang", "h")
    lines: dict[str, list[str]] = {}
    for r in rows.toLocalIterator():
        lines.setdefault(r.lang, []).extend(bytes(r.piece).decode("utf-8", "ignore").lower().split("\n"))
    owners: dict[str, set[str]] = {}
    for lang, own in lines.items():
        for line in own:
            owners.setdefault(line, set()).add(lang)
    return {lang: "\n".join(x for x in dict.fromkeys(own) if len(owners[x]) == 1).encode()[:dict_bytes]
            for lang, own in lines.items()}


class Classifier:
    """Compressors of all languages; a Python worker makes them once."""

    def __init__(self, dictionaries: dict[str, bytes], margin: float = MARGIN, block: int = BLOCK_BYTES):
        self.names, self.margin, self.block, self.each = sorted(dictionaries), margin, block, []
        for name in self.names:
            how = zstandard.ZstdCompressionParameters(
                strategy=zstandard.STRATEGY_LAZY, min_match=4, hash_log=15, chain_log=15, window_log=17, search_log=3)
            content = zstandard.ZstdCompressionDict(dictionaries[name] + PAD, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=how)
            self.each.append(zstandard.ZstdCompressor(compression_params=how, dict_data=content))

    def sizes(self, data: bytes) -> list[int]:
        """Compressed bytes of the whole text by language."""
        n = [0] * len(self.each)
        for at in range(0, len(data), self.block):
            part = data[at:at + self.block] + PAD
            for k, c in enumerate(self.each):
                n[k] += len(c.compress(part))
        return n

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected); the score is how much larger the second
        best is, in proportion, at most 1 (1 if there is one language)."""
        if not text or not self.names or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        n = self.sizes(text.lower().encode("utf-8", "replace"))
        best = min(range(len(n)), key=n.__getitem__)
        others = [x for k, x in enumerate(n) if k != best]
        score = min(1.0, min(others) / n[best] - 1) if others else 1.0
        return self.names[best], score, bool(others) and score < self.margin


_READY: dict[int, Classifier] = {}


def language(text: Column, dictionaries: dict[str, bytes], margin: float = MARGIN) -> Column:
    """Struct ``(lang_pred, score, rejected)`` of a text column."""
    def work(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        key = hash((margin, *sorted(dictionaries.items())))
        if key not in _READY:
            _READY.clear()
            _READY[key] = Classifier(dictionaries, margin)
        for s in parts:
            yield pd.DataFrame([_READY[key].predict(t) for t in s], columns=["lang_pred", "score", "rejected"])

    kind = "lang_pred string, score double, rejected boolean"
    # non-deterministic: otherwise a filter on one field would run it again
    return F.pandas_udf(work, kind).asNondeterministic()(text)


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is kept from training: crc32 of the id as text, by fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def keep_identified(df: DataFrame, train: DataFrame, text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """The rows of ``df``, all columns, whose language isn't rejected."""
    found = df.withColumn("__langid", language(F.col(text_col).cast("string"), fit_dictionaries(train, text_col), margin))
    return found.where(~F.col("__langid.rejected")).select(df.columns)


# -- query -------------------------------------------------------------------------

def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    dictionaries = fit_dictionaries(docs.where(~held_out()))
    found = docs.select("doc_id", held_out().alias("held_out"), language(F.col("text"), dictionaries).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.rejected")
