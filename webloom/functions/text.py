"""Text Column functions that reproduce Python's notion of whitespace."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python treats these as whitespace (str.isspace / re \s); Java's Unicode
# \s (``(?U)``) covers all of them except the four information separators.
PY_SPACE = r"(?U)[\s\x1c-\x1f]"
# The same set as explicit characters, derived from str.isspace, for btrim.
PY_SPACE_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_whitespace(c) -> Column:
    """Every run of (Unicode) whitespace becomes one space."""
    return F.regexp_replace(_c(c), PY_SPACE + "+", " ")


def py_strip(c) -> Column:
    """``str.strip()``: remove leading and trailing Unicode whitespace."""
    return F.btrim(_c(c), F.lit(PY_SPACE_CHARS))


def py_lstrip(c) -> Column:
    return F.ltrim(_c(c), F.lit(PY_SPACE_CHARS))


def has_words(stripped, n: int) -> Column:
    """A stripped line holds at least ``n`` whitespace-separated words
    (anchored, so the match stops after the first ``n`` words)."""
    word, gap = r"[^\s\x1c-\x1f]+", r"[\s\x1c-\x1f]+"
    pat = "(?U)^" + gap.join([word] * n)
    return _c(stripped).rlike(pat)


def clean_text(c) -> Column:
    """Collapse whitespace and strip; empty text gets the fixed notice."""
    t = F.trim(collapse_whitespace(c))
    return F.when(t == "", F.lit(NO_CONTENT)).otherwise(t)


# Placeholders used by the Markdown layout.
NO_TITLE = "No Title"
NO_CONTENT = "No content extracted from page"
