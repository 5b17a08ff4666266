"""Boilerplate-line trimming (#33) and Markdown record parsing (#32).

Line trimming is a per-document job and a document is one row, so it runs on
each row's own array of lines: no shuffle, no key, and rows with equal keys
stay apart.  How often a line occurs is read from the sorted array, where equal
lines are neighbours, so the cost of a document is that of sorting its lines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_words, py_lstrip, py_strip

# Python's str.splitlines() boundaries.
LINE_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
# Trimming thresholds.
MIN_WORDS = 3
MAX_REPEATS = 3


def _bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def split_lines(c: Column) -> Column:
    """``str.splitlines()`` as an array (no trailing empty element)."""
    parts = F.split(c, LINE_BREAKS, -1)
    n = F.size(parts)
    return F.when(c == "", F.array().cast("array<string>")).otherwise(
        F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, n - 1)).otherwise(parts))


def raw_lines(c: Column) -> Column:
    """Lines for the functions below, which skip blank ones: a trailing empty
    element does no harm and a null text has no line."""
    return F.split(F.coalesce(c, F.lit("")), LINE_BREAKS, -1)


def filled_lines(raw: Column) -> Column:
    """Raw lines -> ``array<struct<pos, line>>`` of the stripped non-blank ones."""
    placed = F.transform(F.transform(raw, py_strip),
                         lambda line, i: F.struct(i.alias("pos"), line.alias("line")))
    return F.filter(placed, lambda x: x["line"] != "")


def long_lines(raw: Column) -> Column:
    """The non-blank lines of at least ``MIN_WORDS`` words."""
    return F.filter(filled_lines(raw), lambda x: has_words(x["line"], MIN_WORDS))


def rare_lines(raw: Column) -> Column:
    """Long lines whose lower-case form occurs at most ``MAX_REPEATS`` times.

    Among the sorted lines, one belongs to a longer run if some window of
    ``MAX_REPEATS + 1`` neighbours that holds it starts and ends alike.  Short
    lines can't share a form with long ones, so they are dropped first."""
    keyed = F.array_sort(F.transform(long_lines(raw), lambda x: F.struct(
        F.lower(x["line"]).alias("norm"), x["pos"].alias("pos"), x["line"].alias("line"))))

    def in_long_run(s: Column, i: Column) -> Column:
        windows = [F.coalesce(F.get(s, i - k)["norm"] == F.get(s, i - k + MAX_REPEATS)["norm"], F.lit(False))
                   for k in range(MAX_REPEATS + 1)]
        return reduce(lambda a, b: a | b, windows)

    rare = _bound(keyed, lambda s: F.filter(s, lambda x, i: ~in_long_run(s, i)))
    return F.array_sort(F.transform(rare, lambda x: F.struct(x["pos"].alias("pos"), x["line"].alias("line"))))


def kept_lines(raw: Column) -> Column:
    """Rare lines that differ from the kept line before them.  Equal neighbours
    form runs, so the last kept line always equals the last rare one."""
    return _bound(rare_lines(raw), lambda s: F.filter(
        s, lambda x, i: (i == 0) | (x["line"] != F.get(s, i - 1)["line"])))


def line_counts(raw: Column) -> Column:
    """``array<struct<line, n>>``: occurrences of each lower-case line.  The
    lengths of runs are differences between the places where they end."""
    norms = F.array_sort(F.transform(filled_lines(raw), lambda x: F.lower(x["line"])))
    ends = _bound(norms, lambda s: F.filter(
        F.transform(s, lambda x, i: F.struct(x.alias("line"), i.alias("at"),
                                             F.coalesce(F.get(s, i + 1) != x, F.lit(True)).alias("last"))),
        lambda e: e["last"]))
    return _bound(ends, lambda r: F.transform(r, lambda e, k: F.struct(
        e["line"].alias("line"),
        (e["at"] - F.coalesce(F.get(r, k - 1)["at"], F.lit(-1))).cast("long").alias("n"))))


def trimmed(raw: Column) -> Column:
    """The text left of raw lines: strip them; drop blank ones, ones under
    three words, ones whose lower-case form occurs more than three times, and
    ones equal to the kept line before; join the rest with newlines."""
    return F.array_join(F.transform(kept_lines(raw), lambda x: x["line"]), "\n")


def trim_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text",
                        out: str = "text", carry=()) -> DataFrame:
    """Per row: ``(key, *carry, out)`` with the trimmed text (see :func:`trimmed`).
    A null text becomes an empty one; repeated keys stay separate rows."""
    return docs.select(key, *carry, trimmed(raw_lines(F.col(text))).alias(out))


def explode_lines(docs: DataFrame, lines, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line that ``lines`` (one of the functions above) returns."""
    return docs.select(key, F.inline(lines(raw_lines(F.col(text)))))


def line_frequency(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Occurrences of each stripped, lower-cased non-blank line per document."""
    return explode_lines(docs, line_counts, key, text)


# ---------------------------------------------------------------------------
# Markdown records (#32, #32a)
# ---------------------------------------------------------------------------

def _field(lines: Column, prefix: str) -> Column:
    # only the head of each line is lower-cased: the prefix is ASCII and ends
    # in ':' so stripping the right end cannot change the test
    hit = F.try_element_at(F.filter(lines, lambda l: F.lower(F.substring(py_lstrip(l), 1, len(prefix))) == prefix),
                           F.lit(1))
    val = F.regexp_extract(hit, r"(?s)^[^:]*:(.*)$", 1)
    return F.coalesce(py_strip(val), F.lit(""))


def url_from_markdown(md) -> Column:
    md = F.col(md) if isinstance(md, str) else md
    return _field(split_lines(md), "url:")


def parse_markdown(docs: DataFrame, key: str = "doc_id", text: str = "markdown") -> DataFrame:
    """Markdown documents -> ``(key, url, title, description, content)``.

    Header fields come from the first line (anywhere) starting with
    ``url:`` / ``page title:`` / ``meta description:`` after stripping and
    lower-casing; the content is every line after the first ``---`` line,
    trimmed like :func:`trim_repeated_lines`."""
    d = docs.withColumn("_lines", split_lines(F.coalesce(F.col(text), F.lit(""))))
    d = d.withColumn("_at", F.array_position(F.transform("_lines", py_strip), "---").cast("int"))
    lines, at = F.col("_lines"), F.col("_at")
    body = F.when(at > 0, F.slice(lines, at + 1, F.size(lines))).otherwise(F.array().cast("array<string>"))
    return d.select(
        key,
        _field(lines, "url:").alias("url"),
        _field(lines, "page title:").alias("title"),
        _field(lines, "meta description:").alias("description"),
        trimmed(body).alias("content"))
