"""Keyword matching on names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: words are runs of letters and digits.
WORD_BREAK = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-case words of a text, without empty ones."""
    return F.array_remove(F.split(F.lower(text), WORD_BREAK), "")


def has_all_words(text: Column, keyword: Column) -> Column:
    """True when every word of ``keyword`` is among the words of ``text``.

    A keyword without any word matches nothing.
    """
    wanted = words(keyword)
    return (F.size(wanted) > 0) & (F.size(F.array_except(wanted, words(text))) == 0)
