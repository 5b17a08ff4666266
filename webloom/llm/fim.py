"""Fill-in-middle transformation with a Fenwick tree over fixed text blocks.

A text is a sequence of units: a run of ASCII letters, or any other single code
point.  Two hashes of the row's id choose two cuts between units; two more choose
the form: ``plain`` (the text as it is), ``psm`` (prefix, suffix, middle) or
``spm`` (suffix, prefix, middle), each part behind its mark.

The UTF-8 bytes of a text are read in blocks of ``BLOCK``.  A Fenwick tree holds
how many units and code points start in each block; a binary-lifting descent
finds the block in which a cut's unit starts and the code points before it, and
only that block is read again to locate the boundary.  Beside its bytes, a text
takes one read window and two counts a block, so very long texts stay cheap.  The
Python side sees text and hashes and returns three numbers; the parts are put
together, and taken apart again by :func:`restored`, on the JVM.

Marks are found again whatever the parts hold: a text with a mark in it stays
plain, and no mark can arise where a part meets a mark, as marks start with their
only ``<`` and end with their only ``>``.

Defined cases: null text is empty; an empty text is plain; a null id is hashed as
an empty one; rows that repeat an id get the same hashes; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table

# The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

SEED = 1
FIM_SHARE = 90                 # percent of the texts that are cut
SPM_SHARE = 20                 # percent of those that get the form spm
BLOCK = 4096                   # bytes of a block
WINDOW = 256 * BLOCK           # bytes that are looked at together while counting

_LETTER = np.zeros(256, bool)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = True


def starts(data: np.ndarray, at: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the bytes ``at`` to ``end`` start a unit, and which a code point."""
    part = data[at:end]
    points = (part & 0xC0) != 0x80
    letter = _LETTER[part]
    units = points.copy()
    units[1:] &= ~(letter[1:] & letter[:-1])
    if at and letter[0] and _LETTER[data[at - 1]]:
        units[0] = False
    return units, points


class BlockTree:
    """Fenwick tree of one text: node i holds the units and the code points that
    start in the ``i & -i`` blocks up to the i-th."""

    def __init__(self, data: np.ndarray, block: int = BLOCK, window: int = WINDOW):
        self.data, self.block = data, block
        counts: list[list[np.ndarray]] = [[], []]
        for at in range(0, len(data), window):
            masks = starts(data, at, min(at + window, len(data)))
            edges = np.arange(0, len(masks[0]), block)
            for out, mask in zip(counts, masks):
                out.append(np.add.reduceat(mask, edges, dtype=np.int64))
        sums = [np.concatenate([np.zeros(1, np.int64), *c]).cumsum() for c in counts]
        node = np.arange(len(sums[0]))
        self.units, self.points = (s - s[node - (node & -node)] for s in sums)
        self.n_units, self.n_points = (int(s[-1]) for s in sums)

    def code_points_before(self, unit: int) -> int:
        """Code points before the unit with this number (from 0); of the whole
        text if there are no more units."""
        if unit >= self.n_units:
            return self.n_points
        at, points, last = 0, 0, len(self.units) - 1
        step = 1 << last.bit_length()
        while step := step >> 1:
            if at + step <= last and self.units[at + step] <= unit:
                at += step
                unit -= int(self.units[at])
                points += int(self.points[at])
        units, in_block = starts(self.data, at * self.block, min((at + 1) * self.block, len(self.data)))
        return points + int(np.count_nonzero(in_block[:np.flatnonzero(units)[unit]]))


def cut_places(data: np.ndarray, h1: int, h2: int, block: int = BLOCK) -> tuple[int, int, int]:
    """Units of a text, and the code points before its first and second cut."""
    tree = BlockTree(data, block)
    a, b = sorted((h1 % (tree.n_units + 1), h2 % (tree.n_units + 1)))
    return tree.n_units, tree.code_points_before(a), tree.code_points_before(b)


def _cuts(text: Column, h1: Column, h2: Column, block: int) -> Column:
    @F.arrow_udf("n long, first long, second long")
    def work(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
        rows = (cut_places(np.frombuffer(t.as_buffer(), np.uint8), x, y, block)
                for t, x, y in zip(text, h1.to_pylist(), h2.to_pylist()))
        out = np.array(list(rows), np.int64).reshape(-1, 3)
        return pa.StructArray.from_arrays([pa.array(out[:, i]) for i in range(3)], names=["n", "first", "second"])

    return work(text, h1, h2)


def _hash(key: Column, i: int) -> Column:
    """The i-th 8-digit group of the key's SHA-256 as a number."""
    return F.conv(F.substring(F.sha2(key.cast("binary"), 256), 8 * i + 1, 8), 16, 10).cast("long")


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
                   fim_share: int = FIM_SHARE, spm_share: int = SPM_SHARE, block: int = BLOCK) -> DataFrame:
    """Every row's ``(<id_col>, n, form, prefix_chars, middle_chars, output)``:
    its units, the form, the code points of prefix and middle (null if plain), and
    the transformed text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = df.select(F.col(id_col).alias("id"), text.alias("text"), *(_hash(key, i).alias(f"h{i + 1}") for i in range(4)))
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= fim_share)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_share, "spm").otherwise("psm")
    rows = rows.select("id", "text", form.alias("form"), _cuts(F.col("text"), F.col("h1"), F.col("h2"), block).alias("cut"))
    first, second = F.col("cut.first").cast("int"), F.col("cut.second").cast("int")
    prefix = F.concat(F.lit(PREFIX), F.substring("text", F.lit(1), first))
    middle = F.concat(F.lit(MIDDLE), F.substring("text", first + 1, second - first))
    suffix = F.concat(F.lit(SUFFIX), F.substring("text", second + 1, F.length("text")))
    cut = F.col("form") != "plain"
    return rows.select(
        F.col("id").alias(id_col), F.col("cut.n").alias("n"), "form",
        F.when(cut, F.col("cut.first")).alias("prefix_chars"),
        F.when(cut, F.col("cut.second") - F.col("cut.first")).alias("middle_chars"),
        F.when(F.col("form") == "psm", F.concat(prefix, suffix, middle))
        .when(F.col("form") == "spm", F.concat(suffix, prefix, middle)).otherwise(F.col("text")).alias("output"))


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The original text of an output, by its form and the marks alone."""
    out, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    p, s, m = (F.locate(mark, out) for mark in (PREFIX, SUFFIX, MIDDLE))

    def after(mark: Column, end: Column) -> Column:
        return F.substring(out, mark + 3, end - mark - 3)

    middle = F.substring(out, m + 3, F.length(out))
    return F.when(form == "psm", F.concat(after(p, s), middle, after(s, m))).when(
        form == "spm", F.concat(after(p, m), middle, after(s, p))).otherwise(out)


# -- query -------------------------------------------------------------------------

ORACLE = """
with t as (select doc_id, coalesce(text, '') as text, sha256('1:' || doc_id) as h from documents),
u as (select doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') as w,
    cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
    cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4 from t),
c as (select *, len(w) as n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) as a,
    greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90
        then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from u),
p as (select *, array_to_string(w[1:a], '') as pre, array_to_string(w[a + 1:b], '') as mid,
    array_to_string(w[b + 1:], '') as suf from c)
select doc_id, cast(n as bigint) as n, form,
    case when form <> 'plain' then cast(length(pre) as bigint) end as prefix_chars,
    case when form <> 'plain' then cast(length(mid) as bigint) end as middle_chars,
    sha256(case form when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
        when 'spm' then '<S>' || suf || '<P>' || pre || '<M>' || mid else text end) as output_sha256,
    sha256(text) as restored_sha256
from p"""


def op11_fim(spark: SparkSession, sf: str) -> DataFrame:
    out = fill_in_middle(table(spark, sf, "documents"))
    digests = {"output_sha256": F.col("output"), "restored_sha256": restored()}
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      *(F.sha2(c.cast("binary"), 256).alias(name) for name, c in digests.items()))
