"""Whole queries against plain versions, and inputs whose other columns have the
names that operators use inside."""

import re
import struct
import zlib

import numpy as np
import xxhash
import zstandard
from pyspark.sql import functions as F

from webloom.llm import ann, bpe, langid

SF = "/root/testdata/sf0.001"


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def plain_dictionaries(rows):
    """Language -> dictionary, one row after the other."""
    drawn = {}
    for text, lang in rows:
        if text and lang is not None:
            data = text.encode()
            h = signed(xxhash.xxh64_intdigest(data, 42))
            room = max(1, len(data) - langid.PIECE_BYTES + 1)
            start = signed(xxhash.xxh64_intdigest(struct.pack("<i", 1), h % (1 << 64))) % room
            drawn.setdefault(lang, {})[h] = data[start:start + langid.PIECE_BYTES]
    lines = {}
    for lang, pieces in drawn.items():
        first = [pieces[h] for h in sorted(pieces)[:langid.SAMPLE_ROWS]]
        lines[lang] = [line for p in first for line in p.decode("utf-8", "ignore").lower().split("\n")]
    out = {}
    for lang, own in lines.items():
        alone = [x for x in own if not any(x in other for name, other in lines.items() if name != lang)]
        out[lang] = "\n".join(dict.fromkeys(alone)).encode()[:langid.DICT_BYTES]
    return out


def plain_prediction(text, dictionaries):
    if not text or not re.search(r"[^\W\d_]", text):
        return "und", 0.0
    data, size = text.lower().encode("utf-8", "replace"), {}
    for name, dictionary in sorted(dictionaries.items()):
        how = zstandard.ZstdCompressionParameters(strategy=zstandard.STRATEGY_LAZY, min_match=4, hash_log=15, chain_log=15,
                                                  window_log=17, search_log=3)
        raw = zstandard.ZstdCompressionDict(dictionary + langid.PAD, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        one = zstandard.ZstdCompressor(compression_params=how, dict_data=raw)
        size[name] = sum(len(one.compress(data[i:i + langid.BLOCK_BYTES] + langid.PAD)) for i in range(0, len(data), langid.BLOCK_BYTES))
    best, second = sorted(size, key=lambda name: (size[name], name))[:2]
    return best, min(1.0, size[second] / size[best] - 1)


def test_language_id_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in docs}
    dictionaries = plain_dictionaries([(r.text, r.lang) for r in docs if not held[r.doc_id]])
    got = {r.doc_id: r for r in langid.op2_language_id(spark, SF).collect()}
    assert len(got) == len(docs)
    for r in docs:
        want = plain_prediction(r.text, dictionaries)
        assert (got[r.doc_id].held_out, got[r.doc_id].lang_pred) == (held[r.doc_id], want[0])
        assert abs(got[r.doc_id].score - want[1]) < 1e-12
    right = [got[r.doc_id].lang_pred == r.lang for r in docs if held[r.doc_id] and r.lang]
    assert sum(right) >= 0.9 * len(right)


def test_bpe_beside_columns_of_its_own_names(spark):
    rows = [(1, "one two  three", b"x", "y", 3, "h"), (2, None, None, None, None, None), (3, "é𝄞 ", b"", "", 0, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, tokens binary, decoded string, starts int, n_tokens string")
    plain = df.select("doc_id", "text")
    assert sorted(bpe.token_digests(df).collect()) == sorted(bpe.token_digests(plain).collect())


def test_neighbours_beside_columns_of_their_own_names(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)], "k", 1, [1], "l", 2.0) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, key string, v int, ids array<int>, list string, score double")
    asked = F.col("vec_id") % 20 == 0
    wide, slim = (sorted(tuple(r) for r in ann.nearest_neighbours(d, asked).collect())
                  for d in (df, df.select("vec_id", "embedding")))
    assert wide == slim and len(wide) == 3 * 20
