"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are short and documents long, so the share of an item's shingles that a
document holds is what counts, not likeness. Items are parted by size, in
powers of two. Each part has a signature length: the sketch of an item is its
smallest shingles in a random order, one more than an item of the part's size
can miss at the wanted containment. A document that holds enough of an item
therefore holds a shingle of its sketch, whatever the document's length; no
true pair is lost. Pairs found so are verified on the exact shingles.

Only the sketches' hashes go to all tasks, four million of them at a time: those
of some hundred megabytes of items, so that documents are read once but for
benchmarks larger than that. Documents that hold one are joined to its items.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm import blobs, hashing
from gridloom.llm.common import batches_of, bounded_batches, buffers, checkpointed, fresh, small

#: Sketch hashes in one broadcast block, and how they are packed.
BLOCK_GRAMS, _SKETCH = 4 << 20, ["<i8", "u1", "<u8"]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TABLE = _LOWER.tobytes()


def item_shingles(text: bytes, size: int, least: int = 1) -> tuple[int, list[bytes]]:
    """Words in a shingle, and the distinct shingles of an item; one with fewer words is a single shingle, one with fewer than `least` has none."""
    words = text.translate(_TABLE).split()
    size = min(size, len(words)) if len(words) >= least else 0
    return size, sorted({b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}) if size else []


def needed(n: int, share: float) -> int:
    """The fewest of n shingles that reach the share."""
    return max(1, math.ceil(share * n - 1e-9))


def signature_length(n: int, share: float) -> int:
    """For an item of n shingles: what the largest item of its part (a power of two) may miss, and one more."""
    top = (1 << n.bit_length()) - 1
    return min(n, top - needed(top, share) + 1)


def sketches(items: DataFrame, size: int, share: float, least: int) -> DataFrame:
    """blob: uid of the item, words in a shingle and hash of each sketch shingle of items (uid, text) of at least `least` words, packed for each batch."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            uid, width, gram = [], [], []
            for i, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                k, shingles = item_shingles(text.as_buffer().to_pybytes(), size, least)
                if shingles:
                    own = gram_hashes(shingles, k)
                    own = own[np.argsort(hashing.mix(own, 11))][: signature_length(len(shingles), share)]
                    uid.append(np.full(len(own), i, np.int64))
                    width.append(np.full(len(own), k, "u1"))
                    gram.append(own)
            if uid:
                yield pa.RecordBatch.from_arrays([pa.array([blobs.pack([np.concatenate(x) for x in (uid, width, gram)])], pa.binary())], ["blob"])

    return items.select("uid", F.col("text").cast("binary")).mapInArrow(run, "blob binary")


def gram_hashes(shingles: list[bytes], width: int) -> np.ndarray:
    """The hash that each shingle has wherever it stands in a text."""
    data = np.frombuffer(b" ".join(shingles), np.uint8)
    starts, ends, _ = hashing.word_bounds(data, np.array([0, len(data)]))
    return hashing.mix(hashing.Rolling(hashing.word_units(data, starts, ends)).every(width))[::width]


class Block:
    """Sketch hashes of some items, sorted, by words in a shingle."""

    def __init__(self, uid: np.ndarray, width: np.ndarray, gram: np.ndarray) -> None:
        self.sketch = {}
        for k in np.unique(width).tolist():
            own = np.flatnonzero(width == k)
            own = own[np.argsort(gram[own], kind="stable")]
            self.sketch[k] = gram[own], uid[own]

    def found(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, set[int]]:
        """Items of which each row holds a shingle of the sketch."""
        data = _LOWER[data]
        starts, ends, counts = hashing.word_bounds(data, offsets)
        pairs: dict[int, set[int]] = {}
        if not len(starts):
            return pairs
        roll = hashing.Rolling(hashing.word_units(data, starts, ends))
        for width, (grams, owner) in self.sketch.items():
            mine = hashing.mix(roll.every(width))
            low = np.searchsorted(grams, mine)
            for i in np.flatnonzero(grams[np.minimum(low, len(grams) - 1)] == mine).tolist():
                row = int(np.searchsorted(counts, i, "right") - 1)
                if i + width <= counts[row + 1]:
                    high = np.searchsorted(grams, mine[i], "right")
                    pairs.setdefault(row, set()).update(owner[low[i] : high].tolist())
        return pairs


_FOUND = "id bigint, item bigint, n_shingles bigint, n_shared bigint, containment double"


def contained(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", size: int = 5, share: float = 0.8, least: int = 1) -> DataFrame:
    """id, item, n_shingles, n_shared, containment: items of which a document holds at least `share` of the distinct shingles.

    Words are lower-cased in A-Z; a shingle is `size` words, or all words of an
    item that has fewer. Items of fewer than `least` words are not looked for.
    Null and empty texts hold nothing and are never found; a null key passes
    into the result; repeated rows of either table each give pairs; empty
    tables give none; other columns are left out.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(docs[key].cast("long").alias("id"), docs[text].cast("string").alias("text"))
    own = items.select(items[item_key].cast("long").alias("item"), items[item_text].cast("string").alias("text")).where("text IS NOT NULL").withColumn("uid", F.xxhash64("text"))
    own = checkpointed(own)
    found, held = [], []

    def block() -> None:
        shared = spark.sparkContext.broadcast(Block(*(np.concatenate([h[c] for h in held]) for c in range(3))) if held else Block(*(np.zeros(0, t) for t in _SKETCH)))  # of BLOCK_GRAMS hashes and those of one batch at most

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                data, off, _ = buffers(part.column(1))
                for i, j in batches_of(off, 1 << 20):
                    hits = shared.value.found(data[off[i] : off[j]], off[i : j + 1] - off[i])
                    if hits:
                        take = pa.array([i + r for r in hits], pa.int64())
                        yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), pa.array([sorted(x) for x in hits.values()], pa.list_(pa.int64()))], ["id", "text", "uids"])

        found.append(rows.mapInArrow(run, "id bigint, text string, uids array<bigint>"))
        held.clear()

    for r in sketches(own.dropDuplicates(["uid"]), size, share, least).toLocalIterator():
        held.append(blobs.unpack(r["blob"], _SKETCH))
        if sum(len(h[0]) for h in held) >= BLOCK_GRAMS:
            block()
    if held or not found:
        block()
    pairs = checkpointed(reduce(DataFrame.unionAll, found)).select("id", "text", F.explode("uids").alias("uid"))  # documents that hold a sketch's shingle; a task then has one Python worker at a time
    both = pairs.join(small(own.select("uid", "item", F.col("text").alias("wanted"))), "uid").select("id", "text", "item", "wanted")

    def verify(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out, before, known = [], None, {}
            for r, (said, wanted) in enumerate(zip(part.column(1), part.column(3), strict=True)):
                said = said.as_buffer().to_pybytes()
                if said != before:
                    before, known, words = said, {}, said.translate(_TABLE).split()
                k, shingles = item_shingles(wanted.as_buffer().to_pybytes(), size, least)
                if k not in known:
                    known[k] = {b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)}
                shared = sum(x in known[k] for x in shingles)
                if shingles and shared >= needed(len(shingles), share):
                    out.append((r, len(shingles), shared, shared / len(shingles)))
            take = pa.array([o[0] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(2).take(take), *(pa.array([o[k] for o in out], t) for k, t in ((1, pa.int64()), (2, pa.int64()), (3, pa.float64())))], ["id", "item", "n_shingles", "n_shared", "containment"])

    return both.mapInArrow(verify, _FOUND)


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", **how) -> DataFrame:
    """Rows of docs whose key has no contained item, in all their columns; rows with a null key stay."""
    (name,) = fresh(docs, "hit")
    hit = contained(docs, items, key, **how).select(F.col("id").alias(name)).where(F.col(name).isNotNull()).distinct()
    return docs.join(small(hit), docs[key] == F.col(name), "left_anti")
