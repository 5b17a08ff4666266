"""The registered queries of this subpackage and, where SQL can express them,
their DuckDB equivalents."""

from __future__ import annotations

from . import ann, bpe, chat, collocations, exact_dedup, fim, langid, line_dedup, lm, mixing, simhash, urlfilter, warc

QUERIES = {
    "op1_simhash_dedup": simhash.op1_simhash_dedup,
    "op2_language_id": langid.op2_language_id,
    "op3_warc": warc.op3_warc,
    "op4_mixing": mixing.op4_mixing,
    "op5_nearest_neighbours": ann.op5_nearest_neighbours,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_chat_format": chat.op7_chat_format,
    "op8_url_filter": urlfilter.op8_url_filter,
    "op9_byte_bpe": bpe.op9_byte_bpe,
    "op10_lm_scoring": lm.op10_lm_scoring,
    "op11_fim": fim.op11_fim,
    "op12_line_dedup": line_dedup.op12_line_dedup,
    "op13_collocations": collocations.op13_collocations,
}

ORACLES = {
    "op3_warc": warc.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op7_chat_format": chat.ORACLE,
    "op8_url_filter": urlfilter.ORACLE,
    "op11_fim": fim.ORACLE,
    "op12_line_dedup": line_dedup.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
