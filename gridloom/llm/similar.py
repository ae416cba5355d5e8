"""Near duplicates by the exact Jaccard similarity of their shingles.

Two sets at a similarity of 4/5 or more share an element among the first fifth
of each, whichever order all sets have. Sets that share no such element are
never compared, and no pair that counts is lost. The order is that of the
elements' hashes, but for elements that many sets have, which come last: a
common passage brings no sets together that share nothing else.

What meets is compared by size and by parities, which differ in no more bits
than the sets differ in elements; last by the sets themselves, made again from
the texts. Only what can join two components is looked at:

1. Sets whose SimHash is within a few bits, found by pigeonring filtering.
2. Sets that meet at one of their very first elements, and then at any. A group
   of sets that meet gives a forest of its likely pairs, not all of them.
3. Where a likely pair turns out not to be similar, all that likely pairs lead
   to, as one cluster: there the sets themselves are compared, and only a forest
   of pairs found similar comes out, however many look alike and are not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm import blobs, hashing, simhash
from gridloom.llm.common import batches_of, bounded_batches, buffers, checkpointed, parts_for, small, tidy

#: Two sets are similar if 5 times their common elements are at least 4 times all of theirs.
PART, WHOLE = 4, 5
#: Bits of a set's parities at least, and bytes of them that are kept at most.
BITS, WIDE = 256, 1024
#: Bytes that one bucket gathers, the largest group whose pairs are taken step by step, and bytes of parities that are dealt out at once.
BUCKET, SMALL, DEALT = 8 << 20, 32, 8 << 20
#: Bytes that a set of a cluster takes beside its hashes, and sets that one is compared with at once.
BESIDE, AT_ONCE = 512, 256
#: An element is common if in some batch so many of its rows have it, and this share of them. So many of them are known at most: they only change the order.
COMMON_ROWS, COMMON_SHARE, COMMON_KEPT = 8, 1 / 64, 1 << 20
#: The very first elements.
FIRST = 8
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_COMMON = np.uint64(1 << 63)


def parities(hashes: np.ndarray) -> np.ndarray:
    """Whether an odd number of hashes falls to each of at least BITS places, one and more for each hash, packed."""
    places = max(BITS, 1 << max(0, len(hashes) - 1).bit_length())
    at = (hashing.mix(hashes, 5) % np.uint64(places)).astype(np.int64)
    return folded(np.packbits((np.bincount(at, minlength=places) & 1).astype(bool)), WIDE)


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """The parities over fewer places, `size` bytes of them."""
    while len(bits) > size:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def may_be(n: int, a: np.ndarray, m: int, b: np.ndarray) -> bool:
    """Whether sets of n and m elements with these parities may be similar."""
    size = min(len(a), len(b))
    apart = int(np.bitwise_count(folded(a, size) ^ folded(b, size)).sum(dtype=np.int64))
    return (WHOLE + PART) * apart <= (WHOLE - PART) * (n + m)


def prefix(n: int) -> int:
    """So many of the smallest of n hashes hold one that each similar set has among its own."""
    return n - -(-PART * n // WHOLE) + 1 if n else 0


def jaccard(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are similar."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return WHOLE * both >= PART * (len(a) + len(b) - both)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each run of `size` words of some documents, A-Z lower-cased, and the runs before each document; fewer words are one run."""
    starts, ends, counts = hashing.word_bounds(_LOWER[data], offsets)
    words = np.diff(counts)
    runs = np.where(words > size, words - size + 1, np.minimum(words, 1))
    before = np.concatenate([[0], np.cumsum(runs)])
    if not before[-1]:
        return np.zeros(0, np.uint64), before
    first = np.arange(before[-1]) - np.repeat(before[:-1] - counts[:-1], runs)
    width = np.repeat(np.minimum(words, size), runs)
    roll = hashing.Rolling(hashing.word_units(_LOWER[data], starts, ends))
    return hashing.mix(roll.at(first, first + width) + width.astype(np.uint64), 29), before


def ordered(hashes: np.ndarray, common: np.ndarray) -> np.ndarray:
    """A set as sorted numbers; those of common elements are the largest."""
    own = np.unique(hashes >> np.uint64(1))
    if not len(common):
        return own
    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
    return np.sort(np.where(common[at] == own, own | _COMMON, own))


def common_elements(docs: DataFrame, text: str, size: int) -> np.ndarray:
    """Elements that many sets have, sorted: at most COMMON_KEPT, those with most sets."""

    @tidy
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            data, off, _ = buffers(part.column(0))
            found, before = shingles(data, off, size)
            found >>= np.uint64(1)
            row = np.repeat(np.arange(part.num_rows), np.diff(before))
            order = np.lexsort((row, found))
            found, row = found[order], row[order]
            new = np.append(True, (found[1:] != found[:-1]) | (row[1:] != row[:-1])) if len(found) else np.zeros(0, bool)
            value, rows = np.unique(found[new], return_counts=True)
            often = rows >= max(COMMON_ROWS, COMMON_SHARE * part.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(value[often].view(np.int64)), pa.array(rows[often])], ["element", "rows"])

    found = docs.select(docs[text].cast("string").alias("text")).mapInArrow(run, "element bigint, rows bigint").groupBy("element").agg(F.sum("rows").alias("rows"))
    kept = found.orderBy(F.desc("rows"), "element").limit(COMMON_KEPT).select("element").toArrow()  # 8 MB at most
    return np.sort(kept.column(0).to_numpy().view(np.uint64))


_SETS = "sig bigint, fp bigint, n bigint, wide binary, tokens binary"


def sets(docs: DataFrame, common, text: str, size: int) -> DataFrame:
    """Other columns of docs, and sig (a hash of the set), fp (SimHash), n, wide (parities), tokens (the first fifth, sorted) of each row's shingles."""
    others = [c for c in docs.columns if c != text]

    @tidy
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            data, off, _ = buffers(part.column(len(others)))
            found, before = shingles(data, off, size)
            rows = []
            for k in range(part.num_rows):
                each = found[before[k] : before[k + 1]]
                own = ordered(each, common.value)
                rows.append((signature(own), simhash.simhash(each), len(own), parities(own).tobytes(), own[: prefix(len(own))].tobytes()))
            sig, fp = (np.array([r[c] for r in rows], np.uint64).view(np.int64) for c in (0, 1))
            columns = [pa.array(sig), pa.array(fp), pa.array([r[2] for r in rows], pa.int64()), *(pa.array([r[c] for r in rows], pa.binary()) for c in (3, 4))]
            yield pa.RecordBatch.from_arrays([*part.columns[: len(others)], *columns], [*others, "sig", "fp", "n", "wide", "tokens"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text)
    return docs.select(*others, text).mapInArrow(run, f"{kinds}, {_SETS}")


def signature(own: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(own.tobytes(), 7)


def _dealt(token: np.ndarray, slots: int, columns: list[np.ndarray]) -> pa.RecordBatch:
    """One blob of the columns for each slot of the tokens."""
    slot = (hashing.mix(token, 3) % np.uint64(slots)).astype(np.int64)
    order = np.argsort(slot, kind="stable")
    cut = np.flatnonzero(np.append(True, slot[order][1:] != slot[order][:-1])).tolist() if len(order) else []
    rows = [(int(slot[order[a]]), blobs.pack([c[order[a:b]] for c in columns])) for a, b in zip(cut, [*cut[1:], len(order)], strict=True)] if cut else []
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["slot", "blob"])


def shared(rows: DataFrame) -> DataFrame:
    """token, rank, sig: the first elements that several of the sets have, and which of its own a set counts them."""
    total = rows.agg(F.coalesce(F.sum(F.octet_length("tokens")), F.lit(0)).alias("n")).first()["n"]
    slots = parts_for(rows.sparkSession, 2 * int(total), BUCKET)

    @tidy
    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sig = part.column(0).to_numpy(zero_copy_only=False)
            data, off, _ = buffers(part.column(1))
            each = np.unique(sig, return_index=True)[1]
            counts = (np.diff(off) // 8)[each]
            take = [data[off[r] : off[r + 1]].view("<u8") for r in each.tolist()]
            token = np.concatenate(take) if take else np.zeros(0, np.uint64)
            rank = np.minimum(np.arange(len(token)) - np.repeat(np.cumsum(counts) - counts, counts), 255).astype("u1")
            yield _dealt(token, slots, [token, rank, np.repeat(sig[each], counts)])

    @tidy
    def meet(slot: tuple, found: pa.Table) -> pa.Table:
        token, rank, sig = blobs.unpack_all(found.column("blob").to_pylist(), ["<u8", "u1", "<i8"])
        order = np.lexsort((sig, token))
        token, rank, sig = token[order], rank[order], sig[order]
        new = np.append(True, (token[1:] != token[:-1]) | (sig[1:] != sig[:-1])) if len(token) else np.zeros(0, bool)
        token, rank, sig = token[new], rank[new], sig[new]
        same = token[1:] == token[:-1]
        several = np.append(same, False) | np.append(False, same) if len(token) else np.zeros(0, bool)
        return pa.table({"token": pa.array(token[several].view(np.int64)), "rank": pa.array(rank[several].astype("i4")), "sig": pa.array(sig[several])})

    return rows.select("sig", "tokens").mapInArrow(deal, "slot bigint, blob binary").groupBy("slot").applyInArrow(meet, "token bigint, rank int, sig bigint")


def close(token: np.ndarray, n: np.ndarray, label: np.ndarray, bits: np.ndarray, row: np.ndarray, joins: Callable[[int, np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs of one token and two labels whose sizes and parities (bits, by row) may be those of similar sets; token and n are sorted.

    All such pairs; or with `joins`, which tells of a row and others which will
    do, of each large group only so many that the others would join no more labels.
    """

    def fits(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        ok = np.flatnonzero((label[i] != label[j]) & (WHOLE * n[i] >= PART * n[j]))
        i, j = i[ok], j[ok]
        apart = np.bitwise_count(bits[row[i]] ^ bits[row[j]]).sum(axis=1, dtype=np.int64)
        return ok[(WHOLE + PART) * apart <= (WHOLE - PART) * (n[i] + n[j])]

    start = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, np.int64)
    count = np.diff(np.append(start, len(token)))
    each, left, right = np.repeat(count, count), [], []
    for step in range(1, min(SMALL, int(count.max(initial=0)))):
        i = np.flatnonzero((token[step:] == token[:-step]) & (each[step:] <= SMALL))
        ok = fits(i, i + step)
        left.append(i[ok])
        right.append(i[ok] + step)
    for g in np.flatnonzero(count > SMALL):
        a, b = int(start[g]), int(start[g] + count[g])
        root = label[a:b].copy()
        for x in range(a, b):
            j = np.arange(x + 1, a + int(np.searchsorted(n[a:b], WHOLE * n[x] // PART, "right")))
            j = j[root[j - a] != root[x - a]]
            j = j[fits(np.full(len(j), x), j)]
            if joins is not None:
                found, step = [], 1
                while len(j):
                    now, j, step = j[:step], j[step:], min(2 * step, AT_ONCE)
                    for y in now[joins(int(row[x]), row[now])].tolist():
                        if root[y - a] != root[x - a]:
                            found.append(y)
                            root[root == root[y - a]] = root[x - a]
                    j = j[root[j - a] != root[x - a]]
                j = np.array(found, np.int64)
            left.append(np.full(len(j), x))
            right.append(j)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def between(tokens: DataFrame, roots: DataFrame) -> DataFrame:
    """token, sig, label of the tokens that sets of several components have; roots are (node, root), a set without one is its own."""
    own = tokens.join(small(roots), tokens["sig"] == F.col("node"), "left").select("token", "sig", F.coalesce("root", "sig").alias("label"))
    own = checkpointed(own)
    mixed = own.groupBy("token").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("token")
    return checkpointed(own.join(mixed, "token", "left_semi"))


def _dealt_sets(slots: int):
    """Sets (sig, n, label, wide, tokens) to the slots of their tokens: a set's parities go to a slot once. No more than about DEALT bytes are made at once, however many slots there are."""

    @tidy
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sig, n, label = (part.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            data, off, _ = buffers(part.column(3))
            wide = [data[off[r] : off[r + 1]] for r in range(part.num_rows)]
            tokens, counts = part.column(4).flatten().to_numpy(zero_copy_only=False).view(np.uint64), part.column(4).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.append(0, np.cumsum(counts))
            for first, last in batches_of(np.append(0, np.cumsum(counts * (40 + np.diff(off)))), DEALT):
                token = tokens[ends[first] : ends[last]]
                row = np.repeat(np.arange(first, last), counts[first:last])
                slot = (hashing.mix(token, 3) % np.uint64(slots)).astype(np.int64)
                order = np.argsort(slot, kind="stable")
                cut = np.flatnonzero(np.append(True, slot[order][1:] != slot[order][:-1])).tolist() if len(order) else []
                out = []
                for x, y in zip(cut, [*cut[1:], len(order)], strict=True) if cut else ():
                    own, place = np.unique(row[order[x:y]], return_inverse=True)
                    sizes = np.array([len(wide[r]) for r in own.tolist()], np.int64)
                    out.append((int(slot[order[x]]), blobs.pack([token[order[x:y]], place.astype("<i8")]), blobs.pack([sig[own], n[own], label[own], sizes]), blobs.pack([np.concatenate([wide[r] for r in own.tolist()])])))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), *(pa.array([r[c] for r in out], pa.binary()) for c in (1, 2, 3))], ["slot", "tokens", "sets", "wide"])

    return run


def candidates(tokens: DataFrame, nodes: DataFrame) -> DataFrame:
    """a, b: pairs of sets that may be similar, of different labels, of tokens (token, sig, label) and nodes (sig, n, wide): a forest for each token."""
    held = tokens.groupBy("sig").count().join(nodes.select("sig", F.octet_length("wide").alias("size")), "sig")
    of = held.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("count") * (40 + F.col("size"))), F.lit(0)).alias("whole")).first()
    slots = max(parts_for(tokens.sparkSession, (40 + BITS // 8) * of["n"], BUCKET), parts_for(tokens.sparkSession, of["whole"], 3 * BUCKET))

    @tidy
    def meet(slot: tuple, found: pa.Table) -> pa.Table:
        sets_of = [blobs.unpack(x, ["<i8"] * 4) for x in found.column("sets").to_pylist()]
        before = np.cumsum([0, *(len(x[0]) for x in sets_of)])
        met = [blobs.unpack(x, ["<u8", "<i8"]) for x in found.column("tokens").to_pylist()]
        token, row = np.concatenate([x[0] for x in met]), np.concatenate([x[1] + k for x, k in zip(met, before[:-1], strict=True)])
        sig, n, label, sizes = (np.concatenate([x[c] for x in sets_of]) for c in range(4))
        data = np.concatenate([blobs.unpack(x, ["u1"])[0] for x in found.column("wide").to_pylist()])
        ends = np.cumsum(sizes)
        wide = [data[e - z : e] for e, z in zip(ends.tolist(), sizes.tolist(), strict=True)]
        bits = np.stack([folded(w, BITS // 8) for w in wide]).view("<u8")
        order = np.lexsort((sig[row], n[row], token))
        row = row[order]
        known: dict[tuple[int, int], bool] = {}

        def joins(x: int, y: int) -> bool:
            pair = (x, y) if x < y else (y, x)
            if pair not in known:
                known[pair] = may_be(n[x], wide[x], n[y], wide[y])
            return known[pair]

        i, j = close(token[order], n[row], label[row], bits, row, lambda x, ys: np.array([joins(x, y) for y in ys.tolist()], bool))
        pairs = np.unique(np.sort(np.stack([row[i], row[j]], axis=1), axis=1), axis=0).tolist()
        ok = np.array([p for p in pairs if joins(*p)], np.int64).reshape(-1, 2)
        a, b = sig[ok[:, 0]], sig[ok[:, 1]]
        return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    rows = tokens.groupBy("sig", "label").agg(F.collect_list("token").alias("tokens")).join(nodes.select("sig", "n", "wide"), "sig")
    return rows.select("sig", "n", "label", "wide", "tokens").mapInArrow(_dealt_sets(slots), "slot bigint, tokens binary, sets binary, wide binary").groupBy("slot").applyInArrow(meet, "a bigint, b bigint").distinct()


def remade(sigs: DataFrame, rows: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """sig, hashes of the sets that sigs (sig) name, each made again from one of its rows in docs (id, tag, text)."""

    @tidy
    def again(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            data, off, _ = buffers(part.column(1))
            found, before = shingles(data, off, size)
            own = [np.unique(found[before[k] : before[k + 1]] >> np.uint64(1)).tobytes() for k in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own, pa.binary())], ["sig", "hashes"])

    needed = small(sigs.distinct())
    one = small(rows.select("sig", "id", "tag").join(needed, "sig", "left_semi").groupBy("sig").agg(F.min(F.struct("id", "tag")).alias("r")).select("sig", F.col("r.id").alias("i"), F.col("r.tag").alias("t")))
    own = docs.join(one, docs["id"].eqNullSafe(F.col("i")) & (docs["tag"] == F.col("t"))).select("sig", "text")
    return own.mapInArrow(again, "sig bigint, hashes binary").dropDuplicates(["sig"])


def verified(pairs: DataFrame, rows: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar. Only sets of pairs are made again."""

    @tidy
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            (x, xo, _), (y, yo, _) = buffers(part.column(2)), buffers(part.column(3))
            ok = [jaccard(x[xo[k] : xo[k + 1]].view("<u8"), y[yo[k] : yo[k + 1]].view("<u8")) for k in range(part.num_rows)]
            yield part.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    own = remade(pairs.select(F.col("a").alias("sig")).union(pairs.select("b")), rows, docs, size)
    side = lambda a, x: own.select(F.col("sig").alias(a), F.col("hashes").alias(x))
    both = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y")
    return checkpointed(both.mapInArrow(run, "a bigint, b bigint"))


def forest(cluster: np.ndarray, label: np.ndarray, hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs of similar sets of one cluster and two labels, which join all labels that such pairs join."""
    n, wide = np.array([len(x) for x in hashes], np.int64), [parities(x) for x in hashes]
    bits = np.stack([folded(w, BITS // 8) for w in wide]).view("<u8")

    def joins(x: int, ys: np.ndarray) -> np.ndarray:
        theirs = np.concatenate([hashes[y] for y in ys.tolist()])
        at = np.minimum(np.searchsorted(hashes[x], theirs), n[x] - 1)
        both = np.add.reduceat((hashes[x][at] == theirs).astype(np.int64), np.cumsum(n[ys]) - n[ys])
        return WHOLE * both >= PART * (n[x] + n[ys] - both)

    row = np.lexsort((n, cluster))
    i, j = close(cluster[row], n[row], label[row], bits, row, joins)
    i, j = row[i], row[j]
    ok = np.array([may_be(n[x], wide[x], n[y], wide[y]) and jaccard(hashes[x], hashes[y]) for x, y in zip(i.tolist(), j.tolist(), strict=True)], bool)
    return i[ok], j[ok]


def clusters(failed: DataFrame, roots: DataFrame, nodes: DataFrame) -> DataFrame:
    """slot, sig, cluster, label: the sets that may still be similar to one of another component, dealt out so that any two of a cluster and two labels meet in a slot.

    A cluster is what components (roots: node, root) and likely pairs that failed
    lead to. It goes to one slot, with others, unless it takes more than BUCKET:
    then its blocks of about that size meet two by two. A component of several
    blocks has blocks of its own, which do not meet each other.
    """

    def named(found: DataFrame, to: str) -> DataFrame:
        return small(found.select(F.col("node").alias("sig"), F.col("root").alias(to)))

    likely = simhash.components(_links(roots).unionByName(failed))
    own = nodes.select("sig", (BESIDE + 8 * F.col("n")).alias("size")).join(named(likely, "cluster"), "sig", "left").join(named(roots, "label"), "sig", "left")
    own = checkpointed(own.select("sig", "size", F.coalesce("cluster", "sig").alias("cluster"), F.coalesce("label", "sig").alias("label")))
    mixed = own.groupBy("cluster").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("cluster")
    own = checkpointed(own.join(small(mixed), "cluster", "left_semi"))

    pure = F.col("size") > BUCKET
    labels = checkpointed(own.groupBy("cluster", "label").agg(F.sum("size").alias("size")).withColumn("pure", pure))
    loose = labels.where("NOT pure").groupBy("cluster").agg(F.sum("size").alias("loose"))
    parts = F.ceil(F.when(F.col("pure"), F.col("size")).otherwise(F.col("loose")) / BUCKET)
    labels = labels.join(loose, "cluster", "left").select("cluster", "label", "pure", parts.alias("parts"))
    part = F.pmod(F.when(F.col("pure"), F.xxhash64("sig")).otherwise(F.xxhash64("label")), "parts")
    block = F.struct("pure", F.when(F.col("pure"), F.col("label")).otherwise(F.lit(0)).alias("of"), part.alias("part"))
    own = checkpointed(own.join(small(labels), ["cluster", "label"]).select("sig", "size", "cluster", "label", block.alias("block")))

    blocks = checkpointed(own.select("cluster", "block").distinct())
    slots = parts_for(own.sparkSession, int(own.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]), BUCKET)
    alone = blocks.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.first("block").alias("block")).where("n = 1")
    alone = alone.select("cluster", "block", F.pmod(F.xxhash64("cluster"), F.lit(slots)).cast("long").alias("slot"))
    both = blocks.withColumnRenamed("block", "x").join(blocks.withColumnRenamed("block", "y"), "cluster").where("x < y AND NOT (x.pure AND y.pure AND x.of = y.of)")
    slot = -1 - F.pmod(F.xxhash64("cluster", "x", "y"), F.lit(1 << 62))
    both = both.select("cluster", F.explode(F.array("x", "y")).alias("block"), slot.alias("slot"))
    return own.join(small(alone.unionByName(both)), ["cluster", "block"]).select("slot", "sig", "cluster", "label")


def settled(failed: DataFrame, roots: DataFrame, nodes: DataFrame, rows: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """a, b: similar pairs that join what is still apart where likely pairs failed; a forest for each cluster or two blocks of it."""

    @tidy
    def meet(slot: tuple, found: pa.Table) -> pa.Table:
        sig, cluster, label = (found.column(c).to_numpy() for c in ("sig", "cluster", "label"))
        data, off, _ = buffers(found.column("hashes"))
        i, j = forest(cluster, label, [data[off[r] : off[r + 1]].view("<u8") for r in range(len(sig))])
        return pa.table({"a": pa.array(np.minimum(sig[i], sig[j])), "b": pa.array(np.maximum(sig[i], sig[j]))})

    dealt = checkpointed(clusters(failed, roots, nodes))
    own = dealt.join(remade(dealt.select("sig"), rows, docs, size), "sig")
    return checkpointed(own.groupBy("slot").applyInArrow(meet, "a bigint, b bigint").distinct())


def _links(roots: DataFrame) -> DataFrame:
    """The components found so far as links: each node and its root."""
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, k: int = 6, tag: F.Column | None = None) -> DataFrame:
    """id, tag, component (the smallest id reachable over pairs of similar texts, itself included), first of each row.

    Texts without words are alike and similar to no other. k: bits of SimHash
    within which sets are compared first, which changes no result. tag tells
    rows with one id apart, by default by their texts; first is true of the row
    with the smallest (id, tag) of its component, and of rows like it. A null id
    is in its component but never the smallest; one of null ids alone has a null
    id. An empty table gives none; other columns are left out.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(docs[key].cast("long").alias("id"), (F.xxhash64(docs[text].cast("string")) if tag is None else tag).alias("tag"), docs[text].cast("string").alias("text"))
    common = spark.sparkContext.broadcast(common_elements(docs, "text", size))  # 8 MB at most
    rows = checkpointed(sets(docs, common, "text", size))
    tokens = checkpointed(shared(rows))
    needed = small(tokens.select("sig").distinct())
    nodes = checkpointed(rows.join(needed, "sig", "left_semi").select("sig", "fp", "n", "wide").dropDuplicates(["sig"]))
    first = checkpointed(nodes.groupBy("fp").agg(F.min("sig").alias("rep")))
    far = simhash.links(first, k)
    far = far.join(first.select(F.col("fp").alias("a"), F.col("rep").alias("x")), "a").join(first.select(F.col("fp").alias("b"), F.col("rep").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    alike = nodes.join(first, "fp").where("sig <> rep").select(F.col("sig").alias("a"), F.col("rep").alias("b"))
    roots = simhash.components(verified(checkpointed(far.unionByName(alike)), rows, docs, size))
    for own in (tokens.where(F.col("rank") < FIRST), tokens):
        pairs = checkpointed(candidates(between(own, roots), nodes))
        found = verified(pairs, rows, docs, size)
        roots = simhash.components(_links(roots).unionByName(found))
    failed = checkpointed(pairs.join(found, ["a", "b"], "left_anti"))
    if not failed.isEmpty():
        roots = simhash.components(_links(roots).unionByName(settled(failed, roots, nodes, rows, docs, size)))
    own = F.struct(F.col("id").isNull().alias("none"), "id", "tag")
    least = rows.groupBy("sig").agg(F.min("id").alias("least"), F.min(own).alias("head"))
    rooted = checkpointed(least.join(roots, least["sig"] == roots["node"], "left").select("sig", "least", "head", F.coalesce("root", "sig").alias("root")))
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component"), F.min("head").alias("head"))
    named = rooted.select("sig", "root").join(lowest, "root").select("sig", "component", "head")
    return rows.select("id", "tag", "sig").join(named, "sig").select("id", "tag", "component", (own == F.col("head")).alias("first"))
