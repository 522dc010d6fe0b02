"""Tokenisation Column expressions.

The word-count jobs split a document on *exactly one* space: empty tokens
(from leading, trailing or repeated spaces, or an empty line) are words,
case and punctuation are kept.  Spark's ``split`` with limit -1 keeps
trailing empty strings, so it matches Python's ``str.split(' ')``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separators of the original jobs.
WORD_SEPARATOR = " "
LINE_SEPARATOR = "\n"


def words(text: Column | str) -> Column:
    """Array of tokens of ``text`` split on single spaces, empties kept."""
    c = F.col(text) if isinstance(text, str) else text
    return F.split(c, WORD_SEPARATOR, -1)


def lines(text: Column | str) -> Column:
    """Array of lines of ``text`` split on newline, empties kept."""
    c = F.col(text) if isinstance(text, str) else text
    return F.split(c, LINE_SEPARATOR, -1)
