"""Repeated passages: which windows of n units also start in a document with a smaller id.

The work goes in levels. At the first, each window stands for its smallest
q-gram (ties to the right), so that windows with the same units pick the same
q-gram at the same place, and only these q-grams are dealt out by their hash.
Those of one document alone are done with. For the rest, the run of windows
that share a q-gram occurrence is compared as one block: a block that an
earlier document has too is wholly repeated, and the first bearer of each
block goes to the next, longer level. At the last level q is n and each window
left stands for itself.

No key gathers many rows: each map task sends one row for a key and block,
having settled its other bearers itself, and deals a q-gram with several
blocks out by block. Rows travel packed, a blob for each map task and bucket.
The text is dealt out by hash of the id, in groups of bounded bytes.

Blocks are told apart by 64 bits of hash and 32 or more of their q-gram's, windows by 96 or more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm import blobs, hashing
from gridloom.llm.common import batches_of, bounded_batches, buffers, parts_for, text_bytes, tidy

#: Units in a chunk; a longer document is its own chunk, up to CUT, and is cut with overlap beyond.
CHUNK, CUT = 1 << 18, 1 << 20
#: Text bytes in a group of documents, and text bytes behind the rows of a bucket.
GROUP_BYTES, BUCKET_BYTES = 8 << 20, 16 << 20
#: Text bytes whose runs a map task holds and settles at once.
BATCH_BYTES = 10 << 20

_ENTRY = ["<i8", "<i8", "<u4", "<u4", "u1", "<u8", "<u8"]  # id, lo, tag, hi - lo, flags, key, block
_ANSWER = _ENTRY[:5]
#: Of entries and answers: the block recurs in its document, which holds for each place of it.
AGAIN = 2
#: Of entries: other blocks are known to share the key.
MULTI = 1
#: Of answers: the windows are repeated; else they stay open for the next level.
REMOVED = 1
_TABLE = pa.schema([("slot", pa.int64()), ("blob", pa.binary())])


@dataclass(frozen=True)
class Plan:
    """kind: words or bytes. n: units in a window. levels: lengths of q, the last being n."""

    kind: str
    n: int
    levels: tuple[int, ...]
    groups: int
    buckets: int
    whole: bool = False  # of bytes: a character that loses a byte is not kept


class Chunk:
    """Some whole documents, or a piece of one, as hashed units."""

    def __init__(self, units: np.ndarray, offsets: np.ndarray, docs: np.ndarray, shift: int = 0) -> None:
        self.units, self.offsets, self.docs, self.shift = units, offsets, docs, shift
        self.roll = hashing.Rolling(units)

    def starts(self, n: int) -> np.ndarray:
        """Places where a window fits."""
        ok = np.ones(len(self.units) + 1, bool)
        for k in range(len(self.docs)):
            ok[max(self.offsets[k], self.offsets[k + 1] - n + 1) : self.offsets[k + 1]] = False
        ok[self.offsets[-1] :] = False
        return ok[:-1]


def _unit_arrays(plan: Plan, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if plan.kind == "bytes":
        return hashing.byte_units(data), offsets
    starts, ends, counts = hashing.word_bounds(data, offsets)
    return hashing.word_units(data, starts, ends), counts


def chunks(plan: Plan, data: np.ndarray, offsets: np.ndarray, use: np.ndarray) -> Iterator[Chunk]:
    """The documents marked in use. A document beyond CUT units comes in overlapping pieces."""
    for i, j in batches_of(offsets, CHUNK):
        units, counts = _unit_arrays(plan, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        live = use[i:j] & (np.diff(counts) >= plan.n)
        if not live.any():
            continue
        if len(units) > CUT:
            step = CUT - plan.n + 1
            for at in range(0, len(units) - plan.n + 1, step):
                piece = units[at : at + CUT]
                yield Chunk(piece, np.array([0, len(piece)]), np.array([i]), at)
            continue
        if not live.all():
            keep = np.repeat(live, np.diff(counts))
            units = units[keep]
            counts = np.concatenate([[0], np.cumsum(np.diff(counts)[live])])
        yield Chunk(units, counts, np.flatnonzero(live) + i)


def sampled(key: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest key among the next `width` ones from each place on, ties to the right."""
    n = len(key)
    place = np.uint64((1 << 21) - 1)
    low = (key & ~place) | (place - np.arange(n, dtype=np.uint64))
    span = 1
    while 2 * span <= width:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    rest = width - span
    if rest:
        low = np.minimum(low[: len(low) - rest], low[rest:])
    return (place - (low & place)).astype(np.int64)


def entries(plan: Plan, level: int, chunk: Chunk, candidates: np.ndarray, names: Callable | None) -> tuple[np.ndarray, ...]:
    """Key, block, row in docs, lo and hi - lo of each run of candidate windows, lo counted in its document.

    names gives the identifiers of a level at each place. At the last level a window has those of the level before at its begin and at its end.
    """
    n, q = plan.n, plan.levels[level]
    places = np.flatnonzero(candidates)
    if not len(places):
        return tuple(np.zeros(0, t) for t in ("u8", "u8", "i8", "i8", "i8"))
    if q < n:
        gram = names(plan, level, chunk) if names else hashing.mix(chunk.roll.every(q))
        picked = sampled(gram, n - q + 1)[places]
        new = np.ones(len(places), bool)
        new[1:] = (picked[1:] != picked[:-1]) | (places[1:] != places[:-1] + 1)
        first = np.flatnonzero(new)
        lo, hi, m = places[first], places[np.append(first[1:], len(places)) - 1], picked[first]
        key = gram[m]
        block = hashing.mix(hashing.mix(chunk.roll.at(lo, hi + n)) + ((m - lo) << 20).astype(np.uint64) + (hi - lo).astype(np.uint64))
    else:
        lo = hi = places
        if names and level:
            before, step = names(plan, level - 1, chunk), n - plan.levels[level - 1]
            key, block = before[places], before[places + step]
        else:
            key, block = hashing.mix(chunk.roll.at(lo, lo + n)), hashing.mix(hashing.second(chunk.units).at(lo, lo + n))
    k = np.searchsorted(chunk.offsets, lo, "right") - 1
    return key >> np.uint64(16), block, chunk.docs[k], lo - chunk.offsets[k] + chunk.shift, hi - lo


def _settle(key, block, ids, multi, last: bool):
    """Order by key, block and id; then, in that order: removed, open, first of its block and id, keys with several blocks."""
    order = np.lexsort((ids, block, key))
    key, block, ids, multi = key[order], block[order], ids[order], multi[order]
    n = len(key)
    new_key = np.ones(n, bool)
    new_key[1:] = key[1:] != key[:-1]
    new_block = new_key.copy()
    new_block[1:] |= block[1:] != block[:-1]
    block_no = np.cumsum(new_block) - 1
    removed = ids > ids[new_block][block_no]
    new_id = new_block.copy()
    new_id[1:] |= ids[1:] != ids[:-1]
    if last:
        return order, removed, np.zeros(n, bool), new_id, np.zeros(n, bool)
    key_no = np.cumsum(new_key) - 1
    blocks = np.bincount(key_no[new_block])
    lowest = np.minimum.reduceat(ids, np.flatnonzero(new_key))
    highest = np.maximum.reduceat(ids, np.flatnonzero(new_key))
    said = np.maximum.reduceat(multi.astype("u1"), np.flatnonzero(new_key)) > 0
    several = (said | (blocks > 1) & (lowest != highest))[key_no]
    return order, removed, several & ~removed, new_id, several


def _slots(rows: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table([pa.array([s for s, _ in rows], pa.int64()), pa.array([b for _, b in rows], pa.binary())], schema=_TABLE)


def group_of(ids: np.ndarray, groups: int) -> np.ndarray:
    return (hashing.mix(ids.astype(np.int64).view(np.uint64), 5) % np.uint64(groups)).astype(np.int64)


def _tags(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.array([xxhash.xxh32_intdigest(data[offsets[k] : offsets[k + 1]]) for k in range(len(offsets) - 1)], "u4")


def _dealt(slot: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """A blob for each slot. The first two columns, id and lo, are sorted and go as differences."""
    order = np.lexsort((columns[1], columns[0], slot))
    slot, columns = slot[order], [c[order] for c in columns]
    cuts = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else []
    for a, b in zip(cuts, [*cuts[1:], len(slot)], strict=True) if len(slot) else ():
        own = [c[a:b] for c in columns]
        yield int(slot[a]), blobs.pack([np.diff(own[0], prepend=0), np.diff(own[1], prepend=0), *own[2:]])


def _taken(packed: list[bytes], dtypes: list[str]) -> list[np.ndarray]:
    """The columns of several blobs."""
    parts = [blobs.unpack(b, dtypes) for b in packed]
    for p in parts:
        p[0], p[1] = np.cumsum(p[0]), np.cumsum(p[1])
    out = []
    for d in dtypes:
        out.append(np.concatenate([p.pop(0) for p in parts]) if parts else np.zeros(0, d))
    return out


def _merged(doc: np.ndarray, lo: np.ndarray, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same places in as few runs as can be; doc numbers the documents."""
    if not len(doc):
        return doc, lo, wide
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], (lo + wide)[order]
    step = int(hi.max()) + 3  # documents are kept apart
    end = np.maximum.accumulate(hi + doc * step)
    first = np.flatnonzero(np.append(True, lo[1:] + doc[1:] * step > end[:-1] + 1))
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], lo[first], end[last] - doc[last] * step - lo[first]


def _sent(plan: Plan, level: int, found: list[tuple[np.ndarray, ...]], ids: np.ndarray, tags: np.ndarray, alone: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """What a task sends of its runs: one row for a key and block to its bucket, what is settled here to its group.

    alone: documents in pieces, of which each run is told apart by its place.
    """
    if not found:
        return
    key, block, row, lo, wide = (np.concatenate(c) for c in zip(*found, strict=True))  # row is small and not negative
    if not len(key):
        return
    last = plan.levels[level] == plan.n
    doc, tag = ids[row], tags[row]
    order, removed, open_, new_id, several = _settle(key, block, doc, np.zeros(len(key), bool), last)
    key, block, doc, tag, lo, wide, row = (c[order] for c in (key, block, doc, tag, lo, wide, row))
    if removed.any():
        r, at, width = _merged(row[removed], lo[removed], wide[removed])
        yield from _dealt(plan.buckets + group_of(ids[r], plan.groups), [ids[r], at, tags[r], width.astype("u4"), np.full(len(r), REMOVED, "u1")])
    # rows with one id but other texts don't settle each other: each keeps its own first row
    new_tag = new_id.copy()
    new_tag[1:] |= tag[1:] != tag[:-1]
    send = ~removed & (new_tag | alone[row])
    again = np.zeros(len(key), bool)
    again[:-1] = ~new_tag[1:] & new_tag[:-1] & ~alone[row][:-1]
    flags = (again * AGAIN + several * MULTI).astype("u1")
    key_first = np.ones(len(key), bool)
    key_first[1:] = key[1:] != key[:-1]
    own = hashing.mix(key ^ hashing.mix(block)) >> np.uint64(16)
    key = np.where((several & ~key_first) | last, own, key)  # the first speaks for the key; the others go by block
    key, block, doc, tag, lo, wide, flags = (c[send] for c in (key, block, doc, tag, lo, wide, flags))
    # 32 bits of the key are left to tell keys of a bucket apart; keys taken for one only go to the next level together, as their blocks differ
    yield from _dealt((hashing.mix(key, 9) % np.uint64(plan.buckets)).astype(np.int64), [doc, lo, tag, wide.astype("u4"), flags, key & np.uint64((1 << 32) - 1), block])


def _reduced(plan: Plan, level: int) -> Callable:
    """Of a bucket: tells each group which of its runs are repeated and which stay open."""
    last = plan.levels[level] == plan.n

    @tidy
    def run(slot: tuple, rows: pa.Table) -> pa.Table:
        number = slot[0].as_py()
        packed = rows.column("blob").to_pylist()
        if number >= plan.buckets:  # settled before: on to its group
            return _slots([(number - plan.buckets, b) for b in packed])
        doc, lo, tag, wide, flags, key, block = _taken(packed, _ENTRY)
        order = np.argsort(key, kind="stable")
        near = key[order]
        tie = near[1:] == near[:-1]
        shared = np.append(tie, False) | np.append(False, tie)
        pick = order[shared if last else shared | (flags[order] & MULTI > 0)]
        if not len(pick):
            return _slots([])
        order, removed, stays, _, _ = _settle(key[pick], block[pick], doc[pick], flags[pick] & MULTI > 0, last)
        tell = removed | stays
        pick, removed = pick[order][tell], removed[tell]
        status = (removed * REMOVED + (flags[pick] & AGAIN)).astype("u1")
        return _slots(list(_dealt(group_of(doc[pick], plan.groups), [doc[pick], lo[pick], tag[pick], wide[pick], status])))

    return run


# documents, dealt out


def _packed_text(plan: Plan, part: pa.RecordBatch) -> Iterator[tuple[int, bytes, bytes | None]]:
    """A batch's documents as one blob for each group, and what they carry as another; documents without an id go by their text."""
    data, offsets, there = buffers(part.column(1))
    ids = part.column(0)
    has_id = ids.is_valid().to_numpy(zero_copy_only=False)
    ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
    slot = group_of(np.where(has_id, ids, _tags(data, offsets).astype(np.int64)), plan.groups)
    order = np.argsort(slot, kind="stable")
    cuts = np.flatnonzero(np.append(True, slot[order][1:] != slot[order][:-1])) if len(order) else []
    view = memoryview(data)
    beside = pa.RecordBatch.from_arrays(part.columns[2:], [f"carried_{k}" for k in range(part.num_columns - 2)]) if part.num_columns > 2 else None
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True) if len(order) else ():
        rows = order[a:b]
        body = b"".join(view[offsets[r] : offsets[r + 1]] for r in rows)
        extra = None if beside is None else _ipc(beside.take(pa.array(rows)))
        yield int(slot[rows[0]]), blobs.pack_text(ids[rows], has_id[rows] + 2 * there[rows], np.diff(offsets)[rows], body), extra


def _ipc(batch: pa.RecordBatch) -> bytes:
    """A batch of any types as bytes."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


class Group:
    """A group's documents. Rows with one id and text are one here, twin tells which."""

    def __init__(self, packed: list[bytes], extra: list[bytes] = ()) -> None:
        parts = [blobs.unpack_text(b) for b in packed]
        self.carried = pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in extra]) if len(extra) else None
        self.ids = np.concatenate([p[0] for p in parts])
        self.has_id = np.concatenate([p[1] for p in parts]) & 1 > 0
        lengths = np.concatenate([p[2] for p in parts])
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.data = np.frombuffer(b"".join(p[3] for p in parts), np.uint8)
        self.tags = _tags(self.data, self.offsets)
        order = np.lexsort((self.tags, self.ids, ~self.has_id))
        new = np.ones(len(order), bool)
        new[1:] = (self.ids[order][1:] != self.ids[order][:-1]) | (self.tags[order][1:] != self.tags[order][:-1])
        new[~self.has_id[order]] = True
        self.twin = np.empty(len(order), np.int64)
        self.twin[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        self.main = np.zeros(len(order), bool)
        self.main[order[new]] = True
        self.main &= self.has_id
        self._sorted = order[new & self.has_id[order]]

    def rows(self, ids: np.ndarray, tags: np.ndarray) -> np.ndarray:
        """The row of each document named by id and tag."""
        s = self._sorted
        named = lambda i, t: np.rec.fromarrays([i, t], names="i,t")
        both = np.concatenate([named(self.ids[s], self.tags[s]), named(ids, tags)])
        _, code = np.unique(both, return_inverse=True)
        at = np.full(code.max() + 1 if len(code) else 0, -1)
        at[code[: len(s)]] = s
        return at[code[len(s) :]]


def _again(chunk: Chunk, n: int, k: np.ndarray, lo: np.ndarray, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All other places of some runs in their documents: index of the run, place in the chunk, width."""
    out = []
    order = np.lexsort((wide, k))
    cut = np.flatnonzero(np.append(True, (k[order][1:] != k[order][:-1]) | (wide[order][1:] != wide[order][:-1])))
    for a, b in zip(cut, [*cut[1:], len(order)], strict=True):
        own = order[a:b]
        w = int(wide[own[0]])
        start, stop = chunk.offsets[k[own[0]]], chunk.offsets[k[own[0]] + 1] - (w + n) + 1
        places = np.arange(start, stop)
        value = chunk.roll.at(places, places + w + n)
        wanted, first = np.unique(chunk.roll.at(lo[own], lo[own] + w + n), return_index=True)
        at = np.minimum(np.searchsorted(wanted, value), len(wanted) - 1)
        hit = np.flatnonzero(wanted[at] == value)
        out.append((own[first[at[hit]]], places[hit], np.full(len(hit), w)))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _next_level(plan: Plan, level: int, names: Callable | None) -> Callable:
    """Of a group: takes the answers of the level before, sends the open windows' runs at this level."""

    @tidy
    def run(slot: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        number = slot[0].as_py()
        group = Group(left.column("blob").to_pylist())
        doc, lo, tag, wide, flags = _taken(right.column("blob").to_pylist(), _ANSWER)
        row = group.rows(doc, tag)
        order = np.argsort(row, kind="stable")
        row, lo, wide, flags = row[order], lo[order], wide[order].astype(np.int64), flags[order]
        use = np.zeros(len(group.ids), bool)
        use[row] = True
        out: list[tuple[int, bytes]] = []
        told = [(row, lo, wide)] if len(row) else []
        told = [tuple(c[flags & REMOVED > 0] for c in told[0])] if told else []
        found, pieces = [], np.zeros(len(group.ids), bool)
        for chunk in chunks(plan, group.data, group.offsets, use & group.main):
            a, b = np.searchsorted(row, [chunk.docs[0], chunk.docs[-1] + 1])
            k = np.searchsorted(chunk.docs, row[a:b])
            at, w, f = lo[a:b] - chunk.shift + chunk.offsets[k], wide[a:b], flags[a:b]
            piece = chunk.shift > 0 or len(chunk.units) == CUT
            pieces[chunk.docs[0]] |= piece
            if piece:  # runs of open windows are never longer than a window, so that each is in a piece
                inside = (at >= 0) & (at + w + plan.n <= len(chunk.units))
                k, at, w, f = k[inside], at[inside], w[inside], f[inside]
            more = f & AGAIN > 0
            if more.any():
                which, place, width = _again(chunk, plan.n, k[more], at[more], w[more])
                kk, ff = k[more][which], f[more][which]
                gone = ff & REMOVED > 0
                told.append((chunk.docs[kk[gone]], place[gone] - chunk.offsets[kk[gone]], width[gone]))
                k, at, w, f = np.append(k, kk), np.append(at, place), np.append(w, width), np.append(f, ff)
            stays = f & REMOVED == 0
            steps = np.zeros(len(chunk.units) + 1, np.int32)
            np.add.at(steps, at[stays], 1)
            np.add.at(steps, at[stays] + w[stays] + 1, -1)
            candidates = np.cumsum(steps[:-1]) > 0
            found.append(entries(plan, level, chunk, candidates, names))
        if told:
            r, at, w = _merged(*(np.concatenate(c) for c in zip(*told, strict=True)))
            if len(r):
                out += _dealt(np.full(len(r), plan.buckets + number), [group.ids[r], at, group.tags[r], w.astype("u4"), np.full(len(r), REMOVED, "u1")])
        out += _sent(plan, level, found, group.ids, group.tags, pieces)
        return _slots(out)

    return run


def _first_level(plan: Plan, names: Callable | None) -> Callable:
    @tidy
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            data, offsets, _ = buffers(part.column(1))
            has_id = part.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = part.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            for i, j in batches_of(offsets, BATCH_BYTES):
                own, off = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                found, pieces = [], np.zeros(j - i, bool)
                for chunk in chunks(plan, own, off, has_id[i:j]):
                    pieces[chunk.docs[0]] |= chunk.shift > 0 or len(chunk.units) == CUT
                    found.append(entries(plan, 0, chunk, chunk.starts(plan.n), names))
                yield from _slots(list(_sent(plan, 0, found, ids[i:j], _tags(own, off), pieces))).to_batches()

    return run


# the result


def _kept_words(data: np.ndarray, offsets: np.ndarray, gone: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the words that stay, joined by one space, and their offsets."""
    stay = np.flatnonzero(~gone)
    data = data.copy()
    steps = np.zeros(len(data) + 1, np.int8)
    steps[starts[stay]] = 1
    steps[ends[stay]] -= 1
    keep = np.cumsum(steps[:-1], dtype=np.int8) > 0
    doc = np.searchsorted(counts, stay, "right") - 1
    follows = stay[np.append(False, doc[1:] == doc[:-1])] if len(stay) else stay
    data[starts[follows] - 1] = 0x20
    keep[starts[follows] - 1] = True
    size = np.concatenate([[0], np.cumsum(keep)])[offsets]
    return data[keep], size


def _result(plan: Plan) -> Callable:
    @tidy
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        group = Group(left.column("blob").to_pylist(), left.column("extra").to_pylist() if "extra" in left.column_names else ())
        doc, lo, tag, wide, flags = _taken(right.column("blob").to_pylist(), _ANSWER)
        gone = flags & REMOVED > 0
        row, lo, wide, flags = group.rows(doc[gone], tag[gone]), lo[gone], wide[gone].astype(np.int64), flags[gone]
        order = np.argsort(row, kind="stable")
        row, lo, wide, flags = row[order], lo[order], wide[order], flags[order]
        told = [(row, lo, lo + wide + plan.n)]
        if (flags & AGAIN).any():
            use = np.zeros(len(group.ids), bool)
            use[row[flags & AGAIN > 0]] = True
            for chunk in chunks(plan, group.data, group.offsets, use):
                a, b = np.searchsorted(row, [chunk.docs[0], chunk.docs[-1] + 1])
                pick = np.flatnonzero((flags[a:b] & AGAIN > 0) & use[row[a:b]]) + a
                k = np.searchsorted(chunk.docs, row[pick])
                if len(pick):
                    which, place, width = _again(chunk, plan.n, k, lo[pick] + chunk.offsets[k], wide[pick])
                    k = k[which]
                    place = place - chunk.offsets[k]
                    told.append((chunk.docs[k], place, place + width + plan.n))
        row, lo, end = (np.concatenate(c) for c in zip(*told, strict=True))
        out = []
        by_row = np.argsort(row, kind="stable")
        row, lo, end = row[by_row], lo[by_row], end[by_row]
        for i, j in batches_of(group.offsets, CHUNK):
            data, offsets = group.data[group.offsets[i] : group.offsets[j]], group.offsets[i : j + 1] - group.offsets[i]
            if plan.kind == "words":
                starts, ends, counts = hashing.word_bounds(data, offsets)
            else:
                counts = offsets
            a, b = np.searchsorted(row, [i, j])
            shift = counts[row[a:b] - i] + (row[a:b] - i)  # a gap behind each document keeps runs apart
            s, e = lo[a:b] + shift, end[a:b] + shift
            o = np.argsort(s, kind="stable")
            s, e = s[o], np.maximum.accumulate(e[o]) if len(o) else e
            cut = np.flatnonzero(np.append(True, s[1:] > e[:-1])) if len(s) else np.zeros(0, np.int64)
            s, e = s[cut], e[np.append(cut[1:], len(e)) - 1] if len(cut) else e
            gaps = counts[:-1] + np.arange(j - i)
            r = np.searchsorted(gaps, s, "right") - 1
            s, e = s - r, e - r  # counted over the units of all documents here
            steps = np.zeros(counts[-1] + 1, np.int8)
            steps[s] += 1
            np.add.at(steps, e, -1)
            gone = np.cumsum(steps[:-1], dtype=np.int8) > 0
            if plan.kind == "words":
                kept, size = _kept_words(data, offsets, gone, starts, ends, counts)
            else:
                stay = ~gone
                if plan.whole and gone.any():
                    lead = np.flatnonzero(data & 0xC0 != 0x80)
                    stay = ~np.repeat(np.logical_or.reduceat(gone, lead), np.diff(np.append(lead, len(data))))
                kept, size = data[stay], np.concatenate([[0], np.cumsum(stay)])[offsets]
            removed = np.concatenate([[0], np.cumsum(gone)])[counts]
            spans = np.searchsorted(r, np.arange(j - i + 1))
            twin = group.twin[i:j]
            out.append((np.diff(counts), np.diff(removed), spans, s - counts[r], e - counts[r], kept, size, twin, i))
        return _rows(plan, group, out)

    return run


def _rows(plan: Plan, group: Group, out: list[tuple]) -> pa.Table:
    """One row for each input row; rows of one id and text take the result of the first."""
    n_units = np.concatenate([x[0] for x in out])
    n_removed = np.concatenate([x[1] for x in out])
    spans, base = [np.zeros(1, np.int64)], 0
    sizes, at = [np.zeros(1, np.int64)], 0
    for x in out:
        spans.append(x[2][1:] + base)
        base += len(x[3])
        sizes.append(x[6][1:] + at)
        at += len(x[5])
    spans, sizes = np.concatenate(spans), np.concatenate(sizes)
    struct = pa.StructArray.from_arrays([pa.array(np.concatenate([x[3] for x in out])), pa.array(np.concatenate([x[4] for x in out]))], ["start", "end"])
    listed = pa.ListArray.from_arrays(pa.array(spans, pa.int32()), struct)
    text = plan.kind == "words" or plan.whole
    kind = pa.large_string() if text else pa.large_binary()
    kept = pa.Array.from_buffers(kind, len(n_units), [None, pa.py_buffer(sizes.astype(np.int64).tobytes()), pa.py_buffer(b"".join(x[5].tobytes() for x in out))])
    ids = pa.array(group.ids, pa.int64(), mask=~group.has_id)
    rows = pa.table([ids, pa.array(n_units, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(np.diff(spans), pa.int64()), listed, kept.cast(pa.string() if text else pa.binary())], ["id", "n_units", "n_removed", "n_spans", "spans", "kept"])
    if (group.twin != np.arange(len(group.twin))).any():
        rows = rows.take(pa.array(group.twin))
    if group.carried is not None:
        for name in group.carried.column_names:
            rows = rows.append_column(name, group.carried.column(name))
    return rows


def remove_repeats(docs: DataFrame, key: str, text: str, kind: str, n: int, levels: tuple[int, ...], names: Callable | None = None, carry: list[str] | None = None, whole: bool = False) -> DataFrame:
    """Per row of docs: id, n_units, n_removed, n_spans, spans (start, end in units), kept (string for words, binary for bytes), and carried_0 and so on.

    whole: of bytes, kept is a string without the characters that lose a byte.
    carry names columns of any type to bring along from each row, so that no join need find the row again.

    A unit goes if a window of n units over it also starts in a document with
    a smaller id. A null text has no units. A row with a null id loses nothing
    and makes nothing go. Rows with one id don't make each other lose anything.
    """
    if levels[-1] != n or list(levels) != sorted(set(levels)):
        raise ValueError("levels must rise to n")
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(docs[key].cast("long").alias("id"), docs[text].cast("string").alias("text"))
    total = text_bytes(rows)
    plan = Plan(kind, n, tuple(levels), parts_for(spark, total, GROUP_BYTES), parts_for(spark, total, BUCKET_BYTES), whole)
    schema = "slot bigint, blob binary"

    @tidy
    def packed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = list(_packed_text(plan, part))
            columns = [pa.array([x[k] for x in found], t) for k, t in ((0, pa.int64()), (1, pa.binary()), (2, pa.binary()))]
            wide = part.num_columns > 2
            yield pa.RecordBatch.from_arrays(columns if wide else columns[:2], ["slot", "blob", "extra"][: 2 + wide])

    if carry is None:
        documents = rows.mapInArrow(packed, schema)
    else:
        beside = docs.select(docs[key].cast("long").alias("id"), docs[text].cast("string").alias("text"), *(F.col(f"`{c.replace('`', '``')}`").alias(f"carried_{k}") for k, c in enumerate(carry)))
        documents = beside.mapInArrow(packed, schema + ", extra binary")
    sent = rows.mapInArrow(_first_level(plan, names), schema)
    for level in range(len(levels)):
        answers = sent.groupBy("slot").applyInArrow(_reduced(plan, level), schema)
        if level + 1 < len(levels):
            sent = documents.groupBy("slot").cogroup(answers.groupBy("slot")).applyInArrow(_next_level(plan, level + 1, names), schema)
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    result = T.StructType([*(T.StructField(c, T.LongType()) for c in ("id", "n_units", "n_removed", "n_spans")), T.StructField("spans", T.ArrayType(span)), T.StructField("kept", T.StringType() if kind == "words" or whole else T.BinaryType())])
    for k, name in enumerate(carry or ()):
        result = result.add(f"carried_{k}", docs.schema[name].dataType)
    return documents.groupBy("slot").cogroup(answers.groupBy("slot")).applyInArrow(_result(plan), result)


def rest_of(column: str) -> F.Column:
    """SHA-256 of what is kept, in lower-case hex."""
    return F.sha2(F.col(column).cast("binary"), 256)
