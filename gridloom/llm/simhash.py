"""SimHash near-dedup with pigeonring filtering.

A 64-bit fingerprint is a ring of k + 1 segments, k being the most bits in
which linked fingerprints differ. Whenever two differ in at most k bits, some
segment starts a chain along which, for each length l, the first l segments
together differ in at most l * k / (k + 1) bits: the first segment in none,
the first two in at most one, and so on. Fingerprints are therefore dealt out
by a segment and its successor, once as they are and once for each bit of the
successor that can be set: what meets there keeps the first two budgets.
Longer chains are checked in the bucket, the whole distance last.

Only distinct fingerprints are dealt out. A bucket does not list all its
links, but a forest with the same components, and components are joined by
alternating large and small stars on tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm import blobs, hashing
from gridloom.llm.common import SMALL_BYTES, bounded_batches, buffers, checkpointed, few, parts_for, tidy

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Buckets of up to so many fingerprints are compared pair by pair.
SMALL = 32
#: Bytes of keys and fingerprints that one bucket gathers.
BUCKET_BYTES = 16 << 20


def shingle_hashes(raw: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of `size` words, A-Z lower-cased, joined by spaces; fewer words are one run."""
    words = raw.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.append(0, ends[:-size]).tolist()
    ends = (ends[size - 1 :] - 1).tolist()
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, ends, strict=True)), np.uint64, len(ends))


def simhash(hashes: np.ndarray) -> int:
    """Each bit that more than half of the hashes set."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[i : i + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4) -> DataFrame:
    """id, fp (the 64 bits as a signed number) of each row; no words give zero."""

    @tidy
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            data, off, _ = buffers(part.column(1))
            view = data.tobytes()
            found = np.array([simhash(shingle_hashes(view[off[k] : off[k + 1]], size)) for k in range(len(off) - 1)], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    rows = docs.select(docs[key].cast("long").alias("id"), docs[text].cast("string").alias("text"))
    return rows.mapInArrow(run, "id bigint, fp bigint")


# links


def segments(k: int) -> list[tuple[int, int]]:
    """First bit and width of each of the k + 1 segments, the wider ones first."""
    each, more = divmod(64, k + 1)
    widths = [each + 1] * more + [each] * (k + 1 - more)
    return [(sum(widths[:s]), w) for s, w in enumerate(widths)]


def _mask(first: int, width: int) -> np.uint64:
    return np.uint64(((1 << width) - 1) << first)


def chain_keys(fps: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per start segment: the segment, keys, places in fps, and whether a key is the fingerprint's own."""
    parts = segments(k)
    for s, (first, width) in enumerate(parts):
        after, span = parts[(s + 1) % len(parts)]
        own = fps & (_mask(first, width) | _mask(after, span))
        keys, rows = [own], [np.arange(len(fps))]
        for bit in range(after, after + span):
            clear = np.flatnonzero(fps & np.uint64(1 << bit) == 0)
            keys.append(own[clear] | np.uint64(1 << bit))
            rows.append(clear)
        yield s, np.concatenate(keys), np.concatenate(rows), np.concatenate([np.full(len(r), j == 0) for j, r in enumerate(rows)])


def viable(diff: np.ndarray, s: int, k: int) -> np.ndarray:
    """Whether the chain from segment s keeps every budget and the whole distance is at most k."""
    parts, ok, total = segments(k), np.ones(len(diff), bool), np.zeros(len(diff), np.int64)
    for length in range(1, k + 2):
        total = total + np.bitwise_count(diff & _mask(*parts[(s + length - 1) % (k + 1)]))
        ok &= total * (k + 1) <= length * k
    return ok


def forest(fps: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between distinct fingerprints that join just those which any links of at most k bits join.

    Pivots take all within k bits. What two pivots took can only meet if they
    are within 3k; such pairs are compared until a link joins them.
    """
    free, pivots, left, right = np.ones(len(fps), bool), [], [], []
    owner = np.full(len(fps), -1)
    while free.any():
        p = int(np.argmax(free))
        near = np.flatnonzero(np.bitwise_count(fps ^ fps[p]) <= k)
        owner[near[free[near]]] = len(pivots)
        free[near] = False
        pivots.append(p)
        left.append(np.full(len(near), p))
        right.append(near)
    left, right = np.concatenate(left), np.concatenate(right)
    label = joined(left, right, len(fps))
    order = np.argsort(owner, kind="stable")
    cut = np.searchsorted(owner[order], np.arange(len(pivots) + 1))
    centre = fps[np.array(pivots)]
    more = []
    for a in range(len(pivots)):
        for b in np.flatnonzero(np.bitwise_count(centre[a + 1 :] ^ centre[a]) <= 3 * k) + a + 1:
            if label[pivots[a]] == label[pivots[b]]:
                continue
            x, y = order[cut[a] : cut[a + 1]], order[cut[b] : cut[b + 1]]
            for i in range(0, len(x), 512):
                hit = np.argwhere(np.bitwise_count(fps[x[i : i + 512], None] ^ fps[None, y]) <= k)
                if len(hit):
                    more.append((x[i + hit[0, 0]], y[hit[0, 1]]))
                    low, high = sorted((label[pivots[a]], label[pivots[b]]))
                    label[label == high] = low
                    break
    if more:
        left, right = np.append(left, [m[0] for m in more]), np.append(right, [m[1] for m in more])
    return left, right


def joined(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """The smallest place that links lead to, for each of n places."""
    label = np.arange(n)
    while True:
        new = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def bucket_links(key: np.ndarray, fp: np.ndarray, own: np.ndarray, s: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and the root each is linked to, over the keys of one segment."""
    order = np.lexsort((fp, key))
    key, fp, own = key[order], fp[order], own[order]
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(start, len(key)))
    has = np.maximum.reduceat(own.astype("u1"), start) > 0
    each = np.repeat(np.where(has, size, 0), size)
    nodes, code = np.unique(fp, return_inverse=True)
    left, right = [], []
    for step in range(1, min(SMALL, int(size.max()))):
        i = np.flatnonzero((key[step:] == key[:-step]) & (each[step:] <= SMALL) & (each[step:] > 1) & (own[step:] | own[:-step]))
        i = i[viable(fp[i] ^ fp[i + step], s, k)]
        left.append(code[i])
        right.append(code[i + step])
    for g in np.flatnonzero(has & (size > SMALL)):
        own_code = code[start[g] : start[g] + size[g]]
        a, b = forest(nodes[own_code], k)
        left.append(own_code[a])
        right.append(own_code[b])
    if not left:
        return nodes[:0], nodes[:0]
    label = joined(np.concatenate(left), np.concatenate(right), len(nodes))
    linked = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[linked], nodes[label[linked]]


def links(nodes: DataFrame, k: int = 4) -> DataFrame:
    """a, b: links between the distinct values of column fp that join what all links of at most k bits join."""
    if not 1 <= k <= 15:
        raise ValueError("k must be 1 to 15")
    # a fingerprint has k + 33 keys or so, of 17 bytes each
    slots = -(-parts_for(nodes.sparkSession, 17 * (k + 33) * nodes.count(), BUCKET_BYTES) // (k + 1))

    @tidy
    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            fps = part.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            rows = []
            for s, key, row, own in chain_keys(fps, k):
                slot = (hashing.mix(key, s + 1) % np.uint64(slots)).astype(np.int64)
                order = np.argsort(slot, kind="stable")
                cut = np.flatnonzero(np.append(True, slot[order][1:] != slot[order][:-1])) if len(order) else []
                for a, b in zip(cut, [*cut[1:], len(order)], strict=True) if len(order) else ():
                    o = order[a:b]
                    rows.append((int(slot[o[0]]) * (k + 1) + s, blobs.pack([key[o], fps[row[o]], own[o].astype("u1")])))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["slot", "blob"])

    @tidy
    def link(slot: tuple, rows: pa.Table) -> pa.Table:
        key, fp, own = blobs.unpack_all(rows.column("blob").to_pylist(), ["<u8", "<u8", "u1"])
        a, b = bucket_links(key, fp, own > 0, slot[0].as_py() % (k + 1), k)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return nodes.select("fp").mapInArrow(deal, "slot bigint, blob binary").groupBy("slot").applyInArrow(link, "a bigint, b bigint")


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """node, root: the smallest node that links lead to, for each node of a link (a, b), by alternating stars.

    Each round ends in a checkpoint; rounds go on until the links are the same.
    Few links go through few tasks, and their least neighbours are broadcast.
    """
    edges = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(limit):
        mark = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark["n"] == 0 or mark == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen, total = mark, 64 * mark["n"]  # both directions, 32 bytes each
        light = total <= SMALL_BYTES
        part = (lambda df, total=total: few(df, total)) if light else (lambda df: df)
        sent = F.broadcast if light else (lambda df: df)
        edges = part(edges)
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = part(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = part(both.join(sent(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        least = part(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(sent(least), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        edges = checkpointed(part(small.distinct()))
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, k: int = 4) -> DataFrame:
    """id, fp, component (the smallest id reachable over links of at most k bits, itself included) of each row.

    Empty and null texts have fingerprint zero, which links like any other. A
    null id is in its component but never the smallest; a component of null
    ids alone has a null id. Repeated rows are in one component.
    """
    bounded_batches(docs.sparkSession)
    rows = checkpointed(fingerprints(docs, key, text, size))
    nodes = rows.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(nodes, k)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(lowest, "root").select("fp", "component")
    return rows.join(named, "fp").select("id", "fp", "component")


def hexed(column: str) -> F.Column:
    """16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")
