"""Native word splitting shared by the licence scan and the decontamination.

A word is a run of characters outside ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` once
A-Z are lower-cased: digits, ASCII letters and every character above ASCII.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Separators of the text as it stands: A-Z are word characters before they are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def split_words(text: Column) -> Column:
    """Words in their original case, with one empty string before them.

    A leading separator is added, so element 0 is always empty and word ``i``
    (from 0) stands at ``i + 1``.  A text that ends in a separator has one more
    empty string at the end; ``word_count`` leaves it out.
    """
    return F.split(F.concat(F.lit(" "), F.coalesce(text, F.lit(""))), SEPARATORS, -1)


def word_count(words: Column) -> Column:
    size = F.size(words)
    return (size - 1 - F.when(F.element_at(words, -1) == "", 1).otherwise(0)).cast("long")


def lower_ascii(word: Column) -> Column:
    """Lower-case A-Z alone: ``lower`` where every character is ASCII, else ``translate``."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(
        F.translate(word, UPPER, UPPER.lower())
    )
