"""Periodic runs of words by power-of-two naming.

After Karp, Miller and Rosenberg each stretch of 2^k words gets a name, made of
the names of its halves, so that two stretches have one name exactly if they
are equal. The common extension of two places is found by going down the
levels: where the names agree, both places move on by that power of two.

A run of period q and length at least max(12, 2 q) has, q words apart, two equal
stretches of four words, and one of them begins on a grid whose step depends on q
alone. Only grid places with such a pair are extended, left and right.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridloom.llm import hashing
from gridloom.llm.common import SPACE, batches_of, bounded_batches, buffers, release

#: Words that a run has at least; a seed is four words, so this must be 8 or more.
LEAST = 12
_SEED = 4
#: Grid places, and bytes of text, that are looked at together.
_CHUNK, _PIECE = 1 << 19, 1 << 20
_EMPTY = hashlib.sha256(b"").hexdigest()


def word_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, the same for equal words."""
    if not len(starts):
        return np.zeros(0, np.int64)
    offsets = np.append(0, np.cumsum(ends - starts))
    body = data[~SPACE[data]]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(body))])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def planted(n: int, key: int) -> np.ndarray:
    """Which original word stands at each place of document `key` with n words: one document in ten repeats its tail."""
    h = zlib.crc32(str(key).encode())
    own = np.arange(n)
    if h % 10 or not n:
        return own
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    own[a:] = a + (own[a:] - a) % p
    return own


def seeds(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, place and period of all grid places whose four words stand again a period later. first: n + 1 places where documents begin."""
    size = np.diff(first)
    half = np.where(size >= LEAST, size // 2, 0)
    ends = np.cumsum(half)
    found: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 3]
    for lo in range(0, int(ends[-1]) if len(ends) else 0, _CHUNK):  # numbers of (document, period)
        pair = np.arange(lo, min(lo + _CHUNK, int(ends[-1])))
        doc = np.searchsorted(ends, pair, "right")
        period = pair - (ends[doc] - half[doc]) + 1
        step = np.maximum(period, LEAST - period) - _SEED + 1
        count = (size[doc] - period - _SEED) // step + 1
        offsets = np.append(0, np.cumsum(count))
        for i, j in batches_of(offsets, _CHUNK):
            own = np.repeat(np.arange(i, j), count[i:j])
            place = first[doc[own]] + (np.arange(offsets[i], offsets[j]) - offsets[own]) * step[own]
            for k in range(_SEED):
                same = names[place + k] == names[place + k + period[own]]
                own, place = own[same], place[same]
            if len(own):
                found.append((doc[own], place, period[own]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def levels(names: np.ndarray, longest: int) -> list[np.ndarray]:
    """Names of all stretches of 1, 2, 4 and so on words, up to `longest` or to where no two are equal."""
    out, size = [names], 1
    while 2 * size <= min(longest, len(names)):
        low = out[-1]
        distinct, named = np.unique(low[:-size] * (int(low.max()) + 1) + low[size:], return_inverse=True)
        out.append(named)
        size *= 2
        if len(distinct) == len(named):
            break
    return out


def extend(named: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
    """How many words from places a on equal those from b on; or with `back` those before them."""
    got = np.zeros(len(a), np.int64)
    for k in range(len(named) - 1, -1, -1):
        names, size = named[k], 1 << k
        x, y = (a - got - size, b - got - size) if back else (a + got, b + got)
        fits = (x >= 0) & (y < len(names))
        x, y = np.where(fits, x, 0), np.where(fits, y, 0)
        got += np.where(fits & (names[x] == names[y]), size, 0)
    return got


def runs(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, start in it, length and period of all runs, by document, start and period."""
    doc, place, period = seeds(names, first)
    if not len(doc):
        return doc, doc, doc, doc
    # names are made for documents with seeds only, put together
    own = np.unique(doc)
    size = np.diff(first)[own]
    begin = np.append(0, np.cumsum(size))
    at = np.repeat(first[own] - begin[:-1], size) + np.arange(begin[-1])
    row = np.searchsorted(own, doc)
    named = levels(names[at], int(size.max()))
    found = []
    for i in range(0, len(doc), _CHUNK):
        r, q = row[i : i + _CHUNK], period[i : i + _CHUNK]
        x = place[i : i + _CHUNK] - first[doc[i : i + _CHUNK]] + begin[r]
        left = np.minimum(extend(named, x, x + q, True), x - begin[r])
        right = np.minimum(extend(named, x, x + q, False), begin[r + 1] - x - q)
        start, length = x - left, left + right + q
        good = length >= np.maximum(LEAST, 2 * q)
        found.append(np.unique(np.stack([r, start, length, q])[:, good], axis=1))
    # a stretch that is found with several periods has the smallest
    r, start, length, q = np.unique(np.concatenate(found, axis=1), axis=1)
    fresh = np.ones(len(r), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    r, start, length, q = r[fresh], start[fresh], length[fresh], q[fresh]
    order = np.lexsort((q, start))
    r, start, length, q = r[order], start[order], length[order], q[order]
    return own[r], start - begin[r], length, q


SCHEMA = "id bigint, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, n_kept bigint, runs_sha256 string, collapsed_sha256 string"
_OUT = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in SCHEMA.split(", ")])


def _piece(ids: list, data: np.ndarray, off: np.ndarray, plant: bool) -> list[tuple]:
    starts, ends, first = hashing.word_bounds(data, off)
    names, view = word_names(data, starts, ends), data.tobytes()
    source = [planted(int(b - a), i) if plant and i is not None else np.arange(b - a) for i, a, b in zip(ids, first, first[1:], strict=False)]
    if plant and len(names):
        names = names[np.concatenate(source) + np.repeat(first[:-1], np.diff(first))]
    doc, start, length, period = runs(names, first)
    cut = np.searchsorted(doc, np.arange(len(ids) + 1))
    out = []
    for d, key in enumerate(ids):
        own = slice(cut[d], cut[d + 1])
        s, m, q = start[own], length[own], period[own]
        words = view[off[d] : off[d + 1]].split()
        n, kept, best, told = len(words), source[d], (None,) * 4, _EMPTY
        if len(s):
            depth = np.zeros(n + 1, np.int64)
            np.add.at(depth, s + q, 1)
            np.add.at(depth, s + m, -1)
            kept = kept[np.cumsum(depth[:-1]) == 0]
            k = np.lexsort((q, s, -m))[0]
            best = (int(s[k]), int(m[k]), int(q[k]), int(1000 * m[k] // q[k]))
            told = hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in zip(s, m, q, strict=True)).encode()).hexdigest()
        out.append((key, n, len(s), *best, len(kept), told, hashlib.sha256(b" ".join([words[i] for i in kept])).hexdigest()))
    return out


def collapse(docs: DataFrame, key: str = "doc_id", text: str = "text", plant: bool = False) -> DataFrame:
    """Runs of each text, and what is left when each run keeps its first period only.

    A run is a stretch of words with smallest period q, at least max(12, 2 q) long,
    that can't be extended. Returns id, n_words, n_runs; start, length, period and
    1000 * length / period of the longest run (ties: smallest start, then period;
    null without runs); n_kept; digests of all runs and of the kept words. With
    `plant` one document in ten, by the checksum of its id, first has its tail
    made periodic.

    Null and empty texts have no words and no runs; a null id is never planted;
    repeated rows each count; an empty table gives no rows; further columns are
    not looked at. A task holds some documents, one at least, and for each word
    of those with seeds one number for each level.
    """
    bounded_batches(docs.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for part in parts:
            ids = part.column(0).to_pylist()
            data, off, _ = buffers(part.column(1))
            for i, j in batches_of(off, _PIECE):
                rows = _piece(ids[i:j], data[off[i] : off[j]], off[i : j + 1] - off[i], plant)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _OUT, strict=True)], schema=_OUT)

    return docs.select(docs[key].cast("long").alias("id"), docs[text].cast("string").alias("text")).mapInArrow(run, SCHEMA)
