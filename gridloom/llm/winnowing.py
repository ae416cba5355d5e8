"""Document fingerprints by winnowing.

Every run of k code points gets a rolling hash; of each window of w hashes the
smallest is marked, the rightmost of equals. Marks keep their positions. Two
texts that share w + k - 1 code points share a mark there, at the same place
of the shared run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm import blobs, hashing
from gridloom.llm.common import buffers, parts_for, text_bytes
from gridloom.llm.repeats import GROUP_BYTES, sampled

K, W = 16, 25
_PIECE = 1 << 20


def marks(text: str, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (43 bits) and positions of a text's marks, in order. A text shorter than k is one run; none has no mark."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    n = len(points)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k = min(k, n)
    hashes, places = [], []
    step = _PIECE - (k + w - 2)
    for at in range(0, max(1, n - k + 1), step):
        units = hashing.mix(points[at : at + _PIECE].astype(np.uint64), 3)
        if len(units) < k:
            break
        grams = hashing.mix(hashing.Rolling(units).every(k), 4)
        picked = np.unique(sampled(grams, min(w, len(grams))))
        hashes.append(grams[picked] >> np.uint64(21))
        places.append(picked + at)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return np.concatenate(hashes)[first], place


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared share of two texts' distinct mark hashes; 1 if neither has any."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def digest(hashes: np.ndarray, places: np.ndarray) -> str:
    """32 hex digits over all marks and their positions."""
    return xxhash.xxh3_128_hexdigest(hashes.astype("<u8").tobytes() + places.astype("<i8").tobytes())


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """id and marks (array of hash, position) of each row; null and empty texts have none; rows pass one for one."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [marks(t.as_py() or "", k, w) for t in part.column(1)]
            offsets = np.concatenate([[0], np.cumsum([len(h) for h, _ in found])]).astype(np.int32)
            flat = lambda i, t: pa.array(np.concatenate([f[i] for f in found]).astype(t) if found else np.zeros(0, t))
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([flat(0, np.int64), flat(1, np.int64)], ["hash", "position"]))
            yield pa.RecordBatch.from_arrays([part.column(0), listed], ["id", "marks"])

    rows = docs.select(docs[key].cast("long").alias("id"), docs[text].cast("string").alias("text"))
    return rows.mapInArrow(run, "id bigint, marks array<struct<hash:bigint,position:bigint>>")


def cut_points(ids: DataFrame, parts: int) -> np.ndarray:
    """Ids that occur in column id and part all ids into up to `parts` ranges, none of them empty. Nulls are in the first."""
    share = [p / parts for p in range(parts + 1)]
    found = ids.agg(F.percentile_approx("id", share, max(10_000, 10 * parts)).alias("q"), F.min("id").alias("least")).first()
    cuts = np.unique(np.array(found["q"] or [], np.int64))
    return cuts[cuts > found["least"]] if len(cuts) else cuts


def study(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """What an edit and the next document do to each row's marks.

    The next row is that with the next larger (id, text), null ids first; after
    the last comes the first. The edited text has its last floor(n / 2) code
    points replaced by the first as many of the next row's text. Returns id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint (digests of all
    marks), near_edited, near_next, n_marks. Null texts count as empty;
    repeated rows follow each other; an empty table gives no rows.

    Rows are dealt out by ranges of the id; each range also gets the row that
    the next range begins with, whose id is known from the cut points.
    """
    rows = docs.select(docs[key].cast("long").alias("id"), docs[text].cast("string").alias("text"))
    cuts = cut_points(rows.select("id"), parts_for(docs.sparkSession, text_bytes(rows), GROUP_BYTES))
    ranges = len(cuts) + 1
    shared = docs.sparkSession.sparkContext.broadcast(cuts)  # one number for each range

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = shared.value
        for part in parts:
            data, off, _ = buffers(part.column(1))
            has_id = part.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = part.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            slot = np.where(has_id, np.searchsorted(cuts, ids, "right"), 0)
            view, out = data.tobytes(), []

            def add(to: int, own: np.ndarray, head: int) -> None:
                body = b"".join(view[off[r] : off[r + 1]] for r in own)
                out.append((to, blobs.pack_text(ids[own], has_id[own] + 2 * head, np.diff(off)[own], body)))

            order = np.argsort(slot, kind="stable")
            start = np.flatnonzero(np.append(True, slot[order][1:] != slot[order][:-1])) if len(order) else []
            for a, b in zip(start, [*start[1:], len(order)], strict=True) if len(order) else ():
                own = order[a:b]
                at = int(slot[own[0]])
                add(at, own, 0)
                # only rows that may begin the range: its first id, or in the first range the least one here
                first = own[ids[own] == cuts[at - 1]] if at else own
                if len(first):
                    head = min(first, key=lambda r: (has_id[r], ids[r], view[off[r] : off[r + 1]]))
                    add((at - 1) % ranges, np.array([head]), 1)
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in out], pa.int64()), pa.array([b for _, b in out], pa.binary())], ["slot", "blob"])

    def run(slot: tuple, packed: pa.Table) -> pa.Table:
        own, heads = [], []
        for blob in packed.column("blob").to_pylist():
            ids, state, lengths, data = blobs.unpack_text(blob)
            off = np.append(0, np.cumsum(lengths))
            for r in range(len(ids)):
                (heads if state[r] & 2 else own).append((bool(state[r] & 1), int(ids[r]), data[off[r] : off[r + 1]].tobytes()))
        own.sort()
        texts = [t.decode() for *_, t in own] + [min(heads)[2].decode()]
        seen = [marks(t, k, w) for t in texts]
        cols: list[list] = [[] for _ in range(9)]
        for r, (has_id, i, _) in enumerate(own):
            text, after = texts[r], texts[r + 1]
            half = len(text) // 2
            edited = text[: len(text) - half] + after[:half]
            edited_marks = marks(edited, k, w)
            row = (i if has_id else None, len(text), hashlib.sha256(edited.encode()).hexdigest(), digest(*seen[r]), digest(*edited_marks), likeness(seen[r][0], edited_marks[0]), likeness(seen[r][0], seen[r + 1][0]), len(seen[r][0]), len(edited_marks[0]))
            for c, v in zip(cols, row, strict=True):
                c.append(v)
        return pa.table([pa.array(c, t) for c, t in zip(cols, _STUDY.types, strict=True)], schema=_STUDY)

    return rows.mapInArrow(deal, "slot bigint, blob binary").groupBy("slot").applyInArrow(run, "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_marks bigint, n_edited_marks bigint")


_STUDY = pa.schema([("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("n_marks", pa.int64()), ("n_edited_marks", pa.int64())])
