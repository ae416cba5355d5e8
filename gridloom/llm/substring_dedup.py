"""Substring dedup by level-wise doubling.

Windows of a quarter of the wanted length come first; only those that more
than one document has are extended to twice that length, and again, until no
candidates survive or the wanted length is reached (see repeats.py for how a
level deals its windows out). With n = 50 the lengths are 12, 25 and 50 words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridloom.llm.repeats import remove_repeats


def doubling(n: int, shortest: int = 12) -> tuple[int, ...]:
    """Lengths up to n, each twice the one before (one more where n is odd), the first at least `shortest` if n is."""
    levels = [n]
    while levels[0] // 2 >= shortest:
        levels.insert(0, levels[0] // 2)
    return tuple(levels)


def dedup_words(docs: DataFrame, n: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Removes each word covered by a window of n words that also starts in a document with a smaller key.

    Words are runs of other characters than space and tab to carriage return.
    Returns id, n_units, n_removed, n_spans, spans (start, end in words) and
    kept (the words that stay, joined by one space) per row. A null text has
    no words; a null key takes no part and loses nothing; repeated rows get
    the same result; an empty table gives none; other columns are left out.
    """
    return remove_repeats(docs, key, text, "words", n, doubling(n))
