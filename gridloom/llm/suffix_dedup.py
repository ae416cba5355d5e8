"""Suffix-array dedup by bucket-pointer refinement, with buckets in place of a sorted suffix array.

A suffix starts at every byte. Suffixes are first put in buckets by their first
q bytes. A bucket of depth d is refined by sorting its suffixes on the bucket
identifiers that they have d bytes (or as many as are wanted) later; what is
equal in both has the next depth. The identifiers of that depth are made once
for each place and used again by all suffixes that need them at a later offset,
so that the depth doubles: q, 2q and so on up to n. Suffixes in one bucket of
depth n begin with the same n bytes.

Two things differ from a suffix sorter in memory. Identifiers are hashes of the
two they are made of, not ranks, so that all tasks agree on them and nothing is
numbered anew; and at the depths before the last only those suffixes are sorted
that each n-byte string chooses by the smallest identifier in it (repeats.py),
which loses no n-byte match. Buckets of one document alone are not refined.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame

from gridloom.llm import hashing
from gridloom.llm.repeats import Chunk, Plan, remove_repeats


def depths(q: int, n: int) -> tuple[int, ...]:
    """Depths from q up to n, none more than twice the one before."""
    found = [q]
    while found[-1] < n:
        found.append(min(n, 2 * found[-1]))
    return tuple(found)


def refined(bucket: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Identifiers of the buckets that pairs of identifiers make."""
    return hashing.mix(bucket * np.uint64(3) + hashing.mix(later, 21), 23)


def bucket_pointers(plan: Plan, level: int, chunk: Chunk) -> np.ndarray:
    """Identifier of the bucket of each suffix at the depth of a level: of q bytes at first, then of the pointers of the depth before at its begin and later."""
    pointers = hashing.mix(chunk.roll.every(plan.levels[0]))
    for depth, deeper in pairwise(plan.levels[: level + 1]):
        offset = deeper - depth
        pointers = refined(pointers[: max(0, len(pointers) - offset)], pointers[offset:])
    return pointers


def dedup_bytes(docs: DataFrame, n: int = 50, q: int = 16, key: str = "doc_id", text: str = "text", carry: list[str] | None = None, whole: bool = False) -> DataFrame:
    """Removes each byte covered by an n-byte string that also starts in a document with a smaller key.

    Texts are UTF-8 bytes; matches never cross documents. Returns id, n_units,
    n_removed, n_spans, spans (start, end in bytes) and kept (binary, the bytes
    that stay; with `whole` a string without the characters that lose a byte)
    per row, and the columns that carry names as carried_0 and so on. A null
    text has no bytes; a null key takes no part and loses nothing; repeated rows
    get the same result; an empty table gives none; other columns are left out.
    """
    return remove_repeats(docs, key, text, "bytes", n, depths(q, n), bucket_pointers, carry, whole)
