"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

The units are code points as they stand; runs of white space are one space.
N-grams of five are counted over all trusted documents but a held-out part. The
counts, their contexts and the lower orders are tables, joined in shards by
language and context: highest order by occurrence, lower orders by distinct
continuations, discounts from the counts of counts. They grow with the corpus
and are nowhere held whole.

Documents are dealt out in groups of bounded bytes. A group asks the shards of
the model for the distinct n-grams that it has, and gets back probabilities and
backoff weights of those that the model knows; so each document is scored
although no task sees more of the model than its own text needs.

A document is rejected where its perplexity lies beyond the low or the high
quantile of the held-out trusted documents of its language.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm import blobs, hashing
from gridloom.llm.common import batches_of, bounded_batches, buffers, checkpointed, small, text_bytes, tidy

ORDER = 5
#: Stands before each document, so that its first letters have contexts.
START = 2
#: Code points that are numbered at once; text bytes of a group.
WINDOW, GROUP_BYTES = 1 << 19, 8 << 20
#: Bytes of the model in a shard, shards at most that are made for the sake of parallel work, bytes of questions that a task answers.
SHARD_BYTES, SHARDS, ASKED_BYTES = 16 << 20, 64, 16 << 20
#: Names of n-grams that are gathered before they are made distinct.
MERGED = 1 << 20
#: Trusted documents that the model is made of, and those held out.
LEARNED, HELD = 1, 2
#: Of answers: the n-gram is known, and it is known as a context.
KNOWN, CONTEXT = 1, 2
#: Log probabilities travel in steps of 1 / STEP.
STEP = 2048.0
_PAIR = pa.schema([("slot", pa.int64()), ("blob", pa.binary())])


def points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of some texts, runs of white space as one space, and their offsets."""
    units = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    space = (units == 0x20) | (units >= 9) & (units <= 13)
    keep = np.ones(len(units), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    edge = offsets[1:-1]
    keep[edge[edge < len(units)]] = True
    kept = np.where(space, np.uint32(0x20), units)[keep]
    return kept, np.concatenate([[0], np.cumsum(keep, dtype=np.int32)])[offsets].astype(np.int64)


def led(units: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts with START marks before each and at the end, their offsets there, and which places are text.

    So the n-grams are the same in whatever order the texts come.
    """
    lead = (ORDER - 1) * np.arange(len(offsets))
    real = np.ones(len(units) + (ORDER - 1) * len(offsets), bool)
    real[((offsets + lead)[:, None] + np.arange(ORDER - 1)).ravel()] = False
    out = np.full(len(real), START, np.uint32)
    out[real] = units
    return out, offsets + lead + ORDER - 1, real


def numbered(key: np.ndarray, top: int) -> tuple[np.ndarray, int]:
    """Dense numbers of keys below `top`, and how many there are."""
    if top <= 1 << 22:
        seen = np.zeros(top, bool)
        seen[key] = True
        return (np.cumsum(seen, dtype=np.int32) - 1)[key], int(np.count_nonzero(seen))
    distinct, number = np.unique(key, return_inverse=True)
    return number.astype(np.int32), len(distinct)


class Grams:
    """The distinct n-grams of a window of units; each order numbers its own.

    number: that of the longest n-gram at each place from ORDER - 1 on. first: a
    place where an n-gram ends. suffix and context: its number without the first
    and without the last unit, one order lower.
    """

    def __init__(self, units: np.ndarray) -> None:
        self.units = units
        letter, letters = numbered(units, int(units.max()) + 1)
        number, count = letter, letters
        self.first, self.suffix, self.context = [], [], []
        for k in range(1, ORDER + 1):
            below = number
            if k > 1:
                number, count = numbered(below[:-1].astype(np.int64) * letters + letter[k - 1 :], count * letters)
            first = np.empty(count, np.int64)
            first[number] = np.arange(k - 1, len(units))
            self.first.append(first)
            self.suffix.append(below[first - (k - 2)] if k > 1 else np.zeros(count, np.int32))
            self.context.append(below[first - (k - 1)] if k > 1 else np.zeros(count, np.int32))
        self.number = number

    def hashes(self, salt: int) -> list[np.ndarray]:
        """48 bits for each n-gram, by order from 0."""
        roll = hashing.Rolling(hashing.mix(self.units.astype(np.uint64), 3))
        runs = [np.zeros(1, np.uint64), *(roll.at(f - k, f + 1) for k, f in enumerate(self.first))]
        return [_named(r, k, salt) for k, r in enumerate(runs)]

    def strings(self) -> pa.Array:
        """The longest n-grams."""
        cells = self.units[self.first[-1][:, None] + np.arange(1 - ORDER, 1)]
        wide = 1 + (cells > 0x7F) + (cells > 0x7FF) + (cells > 0xFFFF)
        ends = np.concatenate([[0], np.cumsum(wide.sum(axis=1))]).astype(np.int64)
        body = cells.astype("<u4").tobytes().decode("utf-32-le").encode()
        return pa.Array.from_buffers(pa.large_string(), len(cells), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(body)]).cast(pa.string())


def _named(run: np.ndarray, order: int, salt: int) -> np.ndarray:
    return hashing.mix(run + np.uint64(salt), order + 31) >> np.uint64(16)


def salt_of(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), 3)


def windows(units: np.ndarray) -> Iterator[tuple[int, Grams]]:
    """Where each window's new units begin, and its n-grams, with the units before them as contexts."""
    for at in range(ORDER - 1, len(units), WINDOW):
        yield at, Grams(units[at - ORDER + 1 : at + WINDOW])


def _by_language(column: pa.Array) -> Iterator[tuple[str, np.ndarray]]:
    coded = column.dictionary_encode()
    number = coded.indices.to_numpy(zero_copy_only=False)
    for k, name in enumerate(coded.dictionary.to_pylist()):
        yield name, np.flatnonzero(number == k)


# the model


def counts(rows: DataFrame) -> DataFrame:
    """lang, gram (ORDER code points), c over all rows with columns lang and text, none of them null."""

    @tidy
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for name, _, units, _, real in _streams(part.column(0), part.column(1).to_pylist()):
                for at, g in windows(units):
                    c = np.bincount(g.number[real[at : at + WINDOW]], minlength=len(g.first[-1]))
                    seen = pa.array(c > 0)
                    grams = g.strings().filter(seen)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), grams, pa.array(c).filter(seen)], ["lang", "gram", "c"])

    return rows.select("lang", "text").mapInArrow(run, "lang string, gram string, c bigint").groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def kneser_ney(c: DataFrame) -> DataFrame:
    """lang, ord, gram, p, g: p is the interpolated probability of an n-gram's last unit, or null; g the backoff weight of a context, or null.

    An n-gram that is a context too has two rows. The order 0 has the empty
    n-gram, whose p is that of a unit never seen. Discounts are the modified
    ones; where a language has no n-gram of some count from 1 to 4, they are
    0.5, 0.75 and 0.9.
    """
    orders, own = [], checkpointed(c)
    for k in range(ORDER, 0, -1):
        orders.append(own.select("lang", F.lit(k).alias("ord"), "gram", "c"))
        own = own.groupBy("lang", F.substring("gram", 2, ORDER).alias("gram")).agg(F.count(F.lit(1)).alias("c"))
    grams = checkpointed(reduce(DataFrame.unionAll, orders))
    n = [F.sum((F.col("c") == i).cast("double")).alias(f"n{i}") for i in (1, 2, 3, 4)]
    whole = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & (F.col("n4") > 0)
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    d = [F.when(whole, F.least(F.greatest(F.lit(i) - F.lit(i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}"), F.lit(0.001)), F.lit(i - 0.001))).otherwise(F.lit(v)).alias(f"d{i}") for i, v in ((1, 0.5), (2, 0.75), (3, 0.9))]
    stats = grams.groupBy("lang", "ord").agg(*n, F.count(F.lit(1)).alias("kinds"))
    discounts = small(stats.select("lang", "ord", *d))
    here = Window.partitionBy("lang", "ord", "ctx")  # at most one row for each code point that follows
    least = lambda i: F.sum(((F.col("c") == i) if i < 3 else (F.col("c") >= 3)).cast("double")).over(here)
    rows = grams.join(discounts, ["lang", "ord"]).withColumn("ctx", F.expr("left(gram, ord - 1)"))
    rows = rows.withColumn("total", F.sum("c").over(here).cast("double")).withColumn("g", (F.col("d1") * least(1) + F.col("d2") * least(2) + F.col("d3") * least(3)) / F.col("total"))
    cut = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    shares = checkpointed(rows.select("lang", "ord", "gram", "ctx", ((F.col("c") - cut) / F.col("total")).alias("share"), "g"))
    contexts = shares.groupBy("lang", "ord", "ctx").agg(F.max("g").alias("g"))
    below = stats.where("ord = 1").select("lang", F.lit("").alias("gram"), (1 / (F.col("kinds") + 1)).alias("p"))
    out = [below.select("lang", F.lit(0).alias("ord"), "gram", "p", F.lit(None).cast("double").alias("g"))]
    for k in range(1, ORDER + 1):
        lower = below.select("lang", F.col("gram").alias("rest"), F.col("p").alias("low"))
        at = shares.where(F.col("ord") == k).withColumn("rest", F.substring("gram", 2, ORDER))
        below = at.join(F.broadcast(lower) if k == 1 else lower, ["lang", "rest"]).select("lang", "gram", (F.col("share") + F.col("g") * F.col("low")).alias("p"))  # order 0 has a row for each language
        out.append(below.select("lang", F.lit(k).alias("ord"), "gram", "p", F.lit(None).cast("double").alias("g")))
    out.append(contexts.select("lang", F.col("ord") - 1, F.col("ctx").alias("gram"), F.lit(None).cast("double"), "g"))
    return reduce(DataFrame.unionAll, out)


def _steps(p: pa.Array) -> np.ndarray:
    return np.round(np.minimum(-np.log(np.maximum(p.to_numpy(zero_copy_only=False), 1e-14)), 31.9) * STEP).astype("<u2")


def _cuts(slot: np.ndarray) -> list[tuple[int, int]]:
    """Runs of equal values of a sorted array."""
    start = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])).tolist() if len(slot) else []
    return list(zip(start, [*start[1:], len(slot)], strict=True))


def _pairs(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], schema=_PAIR)


def shard_of(names: np.ndarray, shards: int) -> np.ndarray:
    return (hashing.mix(names, 41) % np.uint64(shards)).astype(np.int64)


# documents against the model


def _groups(rows: DataFrame) -> dict[str, tuple[int, int]]:
    """First group and how many of each language: a group has one language, so that its texts share their n-grams."""
    found = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).orderBy("lang").collect()  # a row for each language of trusted text
    counts = [max(1, -(-r["n"] // GROUP_BYTES)) for r in found]
    return {r["lang"]: (sum(counts[:k]), counts[k]) for k, r in enumerate(found)}


def _packed(groups):
    """Documents as one blob for each group and batch: id, state (1: has an id; 2 times the part), language, text."""

    @tidy
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            data, off, _ = buffers(part.column(3))
            names, noff, _ = buffers(part.column(1))
            has_id = part.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = part.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            role = part.column(2).to_numpy(zero_copy_only=False)
            view, nview = data.tobytes(), names.tobytes()
            tag = np.array([xxhash.xxh32_intdigest(view[off[r] : off[r + 1]]) for r in range(len(ids))], np.uint64)
            slot = (hashing.mix(ids.view(np.uint64) ^ hashing.mix(tag, 7), 5) >> np.uint64(1)).astype(np.int64)
            for name, own in _by_language(part.column(1)):
                first, count = groups.value[name]
                slot[own] = first + slot[own] % count
            order = np.argsort(slot, kind="stable")
            out = []
            for a, b in _cuts(slot[order]):
                own = order[a:b]
                lead = np.diff(noff)[own]
                body = b"".join(nview[noff[r] : noff[r + 1]] + view[off[r] : off[r + 1]] for r in own)
                whole = blobs.pack_text(ids[own], has_id[own] + 2 * role[own], lead + np.diff(off)[own], body, 6)
                out.append((int(slot[own[0]]), len(own).to_bytes(4, "little") + lead.astype("<i4").tobytes() + whole))
            yield _pairs(out)

    return run


def _unpacked(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array, list[str]]:
    ids, state, langs, texts = [], [], [], []
    for blob in packed:
        n = int.from_bytes(blob[:4], "little")
        lead = np.frombuffer(blob, "<i4", n, 4).tolist()
        i, s, lengths, data = blobs.unpack_text(blob[4 + 4 * n :])
        ids.append(i)
        state.append(s)
        ends = np.cumsum(lengths).tolist()
        for a, k, b in zip([0, *ends[:-1]], lead, ends, strict=True):
            langs.append(bytes(data[a : a + k]).decode("utf-8", "replace"))
            texts.append(bytes(data[a + k : b]).decode("utf-8", "replace"))
    return np.concatenate(ids), np.concatenate(state), pa.array(langs, pa.string()), texts


def _streams(langs: pa.Array, texts: list[str]) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of texts of one language, a window of them at a time or one that is longer: its name, rows, units led by marks, offsets there and which units are text."""
    for name, own in _by_language(langs):
        ends = np.cumsum([0, *(len(texts[r]) + ORDER - 1 for r in own.tolist())])
        for a, b in batches_of(ends, WINDOW):
            yield name, own[a:b], *led(*points([texts[r] for r in own[a:b].tolist()]))


def distinct(parts: Iterator[np.ndarray]) -> np.ndarray:
    """The distinct values of all parts, sorted; no more than about MERGED and twice as many are held."""
    known, more = np.zeros(0, np.uint64), []
    for part in parts:
        more.append(part)
        if sum(map(len, more)) > max(MERGED, len(known)):
            known, more = np.unique(np.concatenate([known, *more])), []
    return np.unique(np.concatenate([known, *more]))


def _asked(langs: pa.Array, texts: list[str], shards: int) -> tuple[np.ndarray, list[tuple[int, int]], np.ndarray]:
    """All names that a group asks for, by shard and in order; where each shard's begin and end; their shards."""
    names = distinct(h for name, _, units, _, _ in _streams(langs, texts) for _, g in windows(units) for h in g.hashes(salt_of(name)))
    slot = shard_of(names, shards)
    order = np.argsort(slot, kind="stable")
    return names[order], _cuts(slot[order]), slot[order]


def _questions(shards: int, salts: int):
    @tidy
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        group = key[0].as_py()
        _, _, langs, texts = _unpacked(rows.column("blob").to_pylist())
        names, cuts, slot = _asked(langs, texts, shards)
        out = [(int(slot[a]) * salts + group % salts, group.to_bytes(8, "little") + blobs.pack([np.diff(names[a:b], prepend=np.uint64(0))])) for a, b in cuts]
        return pa.Table.from_batches([_pairs(out)])

    return run


def _dealt_model(shards: int, salts: int):
    """The model's rows packed for each shard, and for each share of the groups that ask it."""

    @tidy
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            names = np.zeros(part.num_rows, np.uint64)
            order = part.column(1).to_numpy(zero_copy_only=False)
            texts = part.column(2).to_pylist()
            units = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
            ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
            runs = hashing.Rolling(hashing.mix(units.astype(np.uint64), 3)).at(np.append(0, ends[:-1]), ends) if len(texts) else np.zeros(0, np.uint64)
            for name, own in _by_language(part.column(0)):
                for k in np.unique(order[own]).tolist():
                    at = own[order[own] == k]
                    names[at] = _named(runs[at], k, salt_of(name))
            context = part.column(3).is_null().to_numpy(zero_copy_only=False)
            value = np.where(context, _steps(part.column(4).fill_null(1.0)), _steps(part.column(3).fill_null(1.0)))
            slot = shard_of(names, shards)
            by = np.argsort(slot, kind="stable")
            out = []
            for a, b in _cuts(slot[by]):
                o = by[a:b]
                blob = blobs.pack([names[o], context[o].astype("u1"), value[o]])
                out += [(int(slot[o[0]]) * salts + s, blob) for s in range(salts)]
            yield _pairs(out)

    return run


@tidy
def _answered(key: tuple, asked: pa.Table, model: pa.Table) -> pa.Table:
    names, context, value = blobs.unpack_all(model.column("blob").to_pylist(), ["<u8", "u1", "<u2"])
    sides = []
    for kind in (False, True):
        own = np.flatnonzero((context > 0) == kind)
        own = own[np.argsort(names[own], kind="stable")]
        sides.append((names[own], value[own]))
    out = []
    for each in asked.column("blob"):
        blob = each.as_py()
        wanted = np.cumsum(blobs.unpack(blob[8:], ["<u8"])[0], dtype=np.uint64)
        flags, values = np.zeros(len(wanted), "u1"), []
        for bit, (have, of) in zip((KNOWN, CONTEXT), sides, strict=True):
            at = np.minimum(np.searchsorted(have, wanted), max(len(have) - 1, 0))
            hit = have[at] == wanted if len(have) else np.zeros(len(wanted), bool)
            flags[hit] |= bit
            values.append(np.where(hit, of[at] if len(of) else 0, 0).astype("<u2"))
        out.append((int.from_bytes(blob[:8], "little"), key[0].as_py().to_bytes(8, "little") + blobs.pack([flags, *values])))
    return pa.Table.from_batches([_pairs(out)])


_SCORED = pa.schema([("id", pa.int64()), ("lang", pa.string()), ("part", pa.int32()), ("n", pa.int64()), ("nll", pa.float64())])


def _scored(shards: int, salts: int):
    @tidy
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _SCORED.empty_table()
        ids, state, langs, texts = _unpacked(left.column("blob").to_pylist())
        told = {int.from_bytes(b[:8], "little") // salts: b[8:] for b in right.column("blob").to_pylist()}
        names, cuts, slot = _asked(langs, texts, shards)
        flags, known, back = np.zeros(len(names), "u1"), np.zeros(len(names), "f4"), np.zeros(len(names), "f4")
        for a, b in cuts:
            if int(slot[a]) in told:
                f, x, y = blobs.unpack(told[int(slot[a])], ["u1", "<u2", "<u2"])
                flags[a:b], known[a:b], back[a:b] = f, x / -STEP, y / -STEP
        by_name = np.argsort(names)
        names, flags, known, back = names[by_name], flags[by_name], known[by_name], back[by_name]
        n, nll = np.zeros(len(ids), np.int64), np.zeros(len(ids))
        for name, own, units, offsets, real in _streams(langs, texts):  # made again, as the n-grams of all windows take several times the text
            for at, g in windows(units):
                score = weight = None
                for k, h in enumerate(g.hashes(salt_of(name))):
                    i = np.searchsorted(names, h)
                    if k:
                        score = np.where(flags[i] & KNOWN > 0, known[i], weight[g.context[k - 1]] + score[g.suffix[k - 1]])
                    else:
                        score = known[i]
                    weight = np.where(flags[i] & CONTEXT > 0, back[i], np.float32(0))
                here = real[at : at + WINDOW]
                sums = np.concatenate([[0.0], np.cumsum(np.where(here, score[g.number], 0.0), dtype=np.float64)])
                edge = np.clip(offsets - at, 0, len(here))
                nll[own] -= np.diff(sums[edge])
                n[own] += np.diff(np.concatenate([[0], np.cumsum(here)])[edge])
        return pa.table([pa.array(ids, mask=state & 1 == 0), langs, pa.array((state >> 1).astype("i4")), pa.array(n), pa.array(nll)], schema=_SCORED)

    return run


def scored(rows: DataFrame, model: DataFrame) -> DataFrame:
    """id, lang, part, n (code points), nll (negative log likelihood) of rows id, lang, part, text, all of whose languages the model has."""
    spark = rows.sparkSession
    model = checkpointed(model)
    total = text_bytes(rows)
    groups = spark.sparkContext.broadcast(_groups(rows))
    shards = max(-(-16 * model.count() // SHARD_BYTES), min(SHARDS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    salts = max(1, -(-total // (4 * shards * ASKED_BYTES)))  # questions take about a quarter of the text's bytes
    schema = "slot bigint, blob binary"
    documents = rows.select("id", "lang", "part", "text").mapInArrow(_packed(groups), schema)
    asked = documents.groupBy("slot").applyInArrow(_questions(shards, salts), schema)
    dealt = model.select("lang", "ord", "gram", "p", "g").mapInArrow(_dealt_model(shards, salts), schema)
    answers = asked.groupBy("slot").cogroup(dealt.groupBy("slot")).applyInArrow(_answered, schema)
    return documents.groupBy("slot").cogroup(answers.groupBy("slot")).applyInArrow(_scored(shards, salts), "id bigint, lang string, part int, n bigint, nll double")


def classify(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", low: float = 0.001, high: float = 0.999, prior: int = 50, fold: int = 5, row: str | None = None) -> DataFrame:
    """id, lang, n_chars, perplexity, steady, low, high, keep of each row.

    trusted has the keys of documents to learn from. One in `fold` of them, by a
    hash of the key, is held out: the model is made of the others. `steady` is
    the perplexity with `prior` more code points at the mean of the language's
    held-out text, which keeps short texts from chance. A row is kept where it is
    between its language's quantiles of it: `high` of the held-out documents,
    `low` of all trusted ones, as the model knows its own text, and copies of it,
    better. Each limit is moved away from the median by 2 / sqrt(n) of its
    distance, n documents saying little of a tail where they are few, and a
    language with fewer than 100 takes the wider of its own and of all languages'
    limits.

    row names a column of numbers that tells rows apart, to be the id in the
    result in place of the key. n_chars counts a run of white space as one. Null and empty texts have no
    perplexity and are kept; a null language is one of its own; rows of a
    language without trusted text, and all rows without any, have no perplexity
    and are kept. Repeated rows are judged alike; rows that share a key are
    judged each by its own text; other columns are left out.
    """
    bounded_batches(docs.sparkSession)
    ids = small(trusted.select(trusted[key].cast("long").alias("t")).where("t IS NOT NULL").distinct())
    rows = docs.select(docs[key].cast("long").alias("key"), docs[row or key].cast("long").alias("id"), F.coalesce(docs[lang].cast("string"), F.lit("")).alias("lang"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    rows = rows.join(ids, F.col("key") == F.col("t"), "left").select("id", "lang", "text", F.col("t").isNotNull().alias("trusted"), (F.pmod(F.xxhash64("key"), F.lit(fold)) == 0).alias("fold"))
    own = checkpointed(counts(rows.where("trusted AND NOT fold AND text <> ''")))
    known = small(own.select("lang").distinct().withColumn("model", F.lit(True)))
    rows = rows.join(known, "lang", "left").select("id", "lang", F.when(~F.col("trusted"), 0).when(F.col("fold"), HELD).otherwise(LEARNED).alias("part"), "text", F.col("model").isNotNull().alias("model"))
    judged = checkpointed(scored(rows.where("model"), kneser_ney(own)))
    limits = small(_limits(judged.where("part > 0 AND n > 0"), prior, low, high))
    steady = F.exp((F.col("nll") + F.col("mean") * prior) / (F.col("n") + prior))
    seen = judged.join(limits, "lang", "left").withColumn("steady", F.when(F.col("n") > 0, steady))
    keep = F.coalesce(F.col("steady").between(F.col("low"), F.col("high")), F.lit(True))
    out = seen.select("id", "lang", F.col("n").alias("n_chars"), F.when(F.col("n") > 0, F.exp(F.col("nll") / F.col("n"))).alias("perplexity"), "steady", "low", "high", keep.alias("keep"))
    none = F.lit(None).cast("double")
    plain = F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")
    rest = rows.where("NOT model").select("id", "lang", F.char_length(plain).cast("long").alias("n_chars"), none.alias("perplexity"), none.alias("steady"), none.alias("low"), none.alias("high"), F.lit(True).alias("keep"))
    return out.unionByName(rest)


def _limits(judged: DataFrame, prior: int, low: float, high: float) -> DataFrame:
    """lang, mean, low, high of trusted rows. The distance of a document is that of its steady log perplexity from its language's mean."""
    held = F.col("part") == HELD
    of = lambda c: F.sum(F.when(held, F.col(c)))
    means = small(judged.groupBy("lang").agg(F.coalesce(of("nll") / of("n"), F.sum("nll") / F.sum("n")).alias("mean")))  # n is not 0 here
    each = checkpointed(judged.join(means, "lang").select("lang", "mean", "part", ((F.col("nll") - F.col("mean") * F.col("n")) / (F.col("n") + prior)).alias("d")))

    def ends(by) -> DataFrame:
        own = F.when(held, F.col("d"))
        found = by.agg(F.count(own).alias("m"), F.percentile_approx(own, [0.5, high], 100_000).alias("q"), F.percentile_approx("d", low, 100_000).alias("least"))
        wide = F.when(F.col("m") > 0, 1 + 2 / F.sqrt(F.greatest("m", F.lit(1))))
        middle = F.col("q")[0]
        return found.withColumns({"a": middle + (F.least("least", middle) - middle) * wide, "b": middle + (F.col("q")[1] - middle) * wide})

    own = ends(each.groupBy("lang", "mean"))
    every = ends(each.groupBy()).select(F.col("a").alias("all_a"), F.col("b").alias("all_b"))
    few = F.col("m") < 100
    both = own.crossJoin(F.broadcast(every))  # one row
    a, b = F.when(few, F.least("a", "all_a")).otherwise(F.col("a")), F.when(few, F.greatest("b", "all_b")).otherwise(F.col("b"))
    return both.select("lang", "mean", F.exp(F.col("mean") + a).alias("low"), F.exp(F.col("mean") + b).alias("high"))
