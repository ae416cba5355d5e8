"""Toxicity by multiple-instance learning.

A document is a bag of sentences; only documents are labelled. Each sentence
gets the probability of a logistic model over its words and parts of words, and a
document is toxic unless none of its sentences is: one minus the product of
their complements (noisy-or), with one more factor, the leak, for labels that no
sentence explains. The weights are fitted on document labels alone; afterwards
the sentences that carry a document's score are known by theirs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm import hashing
from gridloom.llm.common import batches_of, bounded_batches, buffers, checkpointed, columns, fresh, release, small

#: Labelled documents that a model is fitted on, about; of more, those with the smallest hash of their id.
FIT_DOCS = 100_000
#: Features a model has at most, and documents a feature is in at least.
FEATURES, LEAST_DOCS = 2_048, 5
ROUNDS, DECAY = 30, 0.02
#: Bytes of text that are looked at together.
_PIECE = 1 << 20
#: A gradient is summed in whole numbers of 2^-24, so that the order of rows changes nothing.
_UNIT = float(1 << 24)
#: Bytes at the front and at the end of a word that are features besides the word itself.
FRONT, BACK = (3, 4, 5, 6, 7), (4, 5, 6)

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_STOP = np.zeros(256, bool)
_STOP[[0x0A, 0x21, 0x2E, 0x3F]] = True


@dataclass
class Model:
    """Feature hashes, ascending, with a weight each; the sentences' bias and the leak, both as log odds."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float
    leak: float


@dataclass
class Sentences:
    """Sentences of some documents: a document, and the first and last byte of its words, for each."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    word: np.ndarray  # sentence of each word


def split(data: np.ndarray, off: np.ndarray) -> tuple[Sentences, np.ndarray, np.ndarray, np.ndarray]:
    """Sentences, the folded bytes, and first and last byte of each word. Words are letters (any byte above ASCII is one); sentences end at . ! ? and line ends."""
    folded = _FOLD[data]
    starts, ends, first = hashing.word_bounds(folded, off)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    mark = np.searchsorted(np.flatnonzero(_STOP[data]), starts) + doc
    begins = np.append(True, mark[1:] != mark[:-1]) if len(mark) else np.zeros(0, bool)
    at = np.flatnonzero(begins)
    last = np.append(at[1:], len(mark))[: len(at)] - 1
    return Sentences(doc[at], starts[at], ends[last], np.cumsum(begins) - 1), folded, starts, ends


def features(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of one kind of feature at a time, with the words that have it: whole words, their fronts and their ends."""
    if not len(starts):
        return
    yield hashing.mix(hashing.word_units(folded, starts, ends), 101), np.arange(len(starts))
    roll = hashing.Rolling(hashing.byte_units(folded))
    size = ends - starts
    for salt, lengths in ((110, FRONT), (120, BACK)):
        for k in lengths:
            own = np.flatnonzero(size > k)
            a = starts[own] if salt == 110 else ends[own] - k
            yield hashing.mix(roll.at(a, a + k), salt + k), own


def in_fit(key: Column) -> Column:
    """Whether labels of a document may be learned from: the checksum of its id, modulo 5, is not 0."""
    return F.crc32(key.cast("string")) % 5 != 0


def training(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """id, hash and y of the documents to learn from, texts with several ids once, toxic if any of these is."""
    own = labels.select(labels[key].cast("long").alias("id"), labels[label].cast("int").alias("y")).where(F.col("id").isNotNull() & F.col("y").isNotNull() & in_fit(F.col("id")))
    known = checkpointed(own.groupBy("id").agg(F.max(F.when(F.col("y") > 0, 1).otherwise(0)).alias("y")))
    n = known.count()
    if n > FIT_DOCS:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * FIT_DOCS / n))
    rows = docs.select(docs[key].cast("long").alias("id"), F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit(""))).alias("hash"))
    return checkpointed(rows.join(small(known), "id").groupBy("hash").agg(F.min("id").alias("id"), F.max("y").alias("y")))


def _counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """hash, toxic and other documents that have a feature, for each piece of text."""
    release()
    for part in parts:
        y = part.column(0).to_numpy(zero_copy_only=False)
        data, off, _ = buffers(part.column(1))
        for i, j in batches_of(off, _PIECE):
            own, folded, starts, ends = split(data[off[i] : off[j]], off[i : j + 1] - off[i])
            doc = own.doc[own.word]
            for h, word in features(folded, starts, ends):
                each = np.unique(hashing.mix(h, 7) ^ hashing.mix(doc[word].astype(np.uint64), 8), return_index=True)[1]  # once in a document
                distinct, at = np.unique(h[each], return_inverse=True)
                toxic = np.bincount(at, y[i:j][doc[word[each]]], len(distinct)).astype(np.int64)
                rest = np.bincount(at, minlength=len(distinct)) - toxic
                yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(toxic), pa.array(rest)], ["hash", "toxic", "rest"])


def chosen(counts: DataFrame, toxic: int, rest: int) -> DataFrame:
    """hash and odds of the features that tell most of the label (log-likelihood ratio), FEATURES at most."""
    a, b = F.col("toxic").cast("double"), F.col("rest").cast("double")
    n, m = float(toxic), float(rest)
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    share = (a + b) / (n + m)
    gain = part(a, n * share) + part(b, m * share) + part(n - a, n * (1 - share)) + part(m - b, m * (1 - share))
    odds = F.log((a + 0.5) / (n + 1)) - F.log((b + 0.5) / (m + 1))
    return counts.where(F.col("toxic") + F.col("rest") >= LEAST_DOCS).select("hash", F.round(gain, 6).alias("gain"), odds.alias("odds")).where("gain > 3").orderBy(F.desc("gain"), "hash").limit(FEATURES)


def _hits(own: Sentences, folded: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sentence and number of each feature of the model that a sentence has, once for each."""
    seen = np.zeros(1 << 16, bool)
    seen[(hashes >> np.uint64(48)).astype(np.int64)] = True
    found = [np.zeros(0, np.int64)]
    for h, word in features(folded, starts, ends):
        may = np.flatnonzero(seen[(h >> np.uint64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(hashes, h[may]), len(hashes) - 1)
        good = hashes[at] == h[may]
        found.append(own.word[word[may[good]]] * len(hashes) + at[good])
    both = np.unique(np.concatenate(found))
    return both // max(1, len(hashes)), both % max(1, len(hashes))


def _bags(shared: Broadcast):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """y, the number of sentences, and which features which sentences have."""
        release()
        for part in parts:
            y = part.column(0).cast(pa.int64())
            data, off, _ = buffers(part.column(1))
            for i, j in batches_of(off, _PIECE):
                own, *words = split(data[off[i] : off[j]], off[i : j + 1] - off[i])
                sentence, feature = _hits(own, *words, shared.value.hashes)
                first = np.searchsorted(own.doc, np.arange(j - i + 1))
                cut = np.searchsorted(sentence, first)
                listed = lambda x, cut=cut: pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(x.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([y.slice(i, j - i), pa.array(np.diff(first)), listed(sentence - first[own.doc[sentence]]), listed(feature)], ["y", "n", "sentence", "feature"])

    return run


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def logistic(z: np.ndarray) -> np.ndarray:
    return np.exp(-softplus(-z))


def scores(model: Model, n: np.ndarray, doc: np.ndarray, sentence: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log odds of the sentences that have features, the number of each hit's sentence among them, and the log of the chance that a document is clean.

    n: sentences of each document. doc, sentence, feature: hits, by document and sentence.
    """
    begins = np.append(True, (doc[1:] != doc[:-1]) | (sentence[1:] != sentence[:-1])) if len(doc) else np.zeros(0, bool)
    row = np.cumsum(begins) - 1
    z = model.bias + np.bincount(row, model.weights[feature], int(begins.sum()))
    owner = doc[begins]
    plain = n - np.bincount(owner, minlength=len(n))
    clean = -softplus(np.array(model.leak)) - plain * softplus(np.array(model.bias)) - np.bincount(owner, softplus(z), len(n))
    return z, row, clean


def gradient(model: Model, y: np.ndarray, n: np.ndarray, doc: np.ndarray, sentence: np.ndarray, feature: np.ndarray) -> np.ndarray:
    """Sums of the log-likelihood's slope by weight, bias and leak, in whole units; the last number is the likelihood itself."""
    z, row, clean = scores(model, n, doc, sentence, feature)
    clean = np.minimum(clean, -1e-12)
    # the chance of a label grows with a log odds z by s(z) (1 - p) / p where it is toxic, and falls by s(z) else
    push = np.where(y > 0, np.exp(clean) / -np.expm1(clean), -1.0)
    owner = np.zeros(len(z), np.int64)
    owner[row] = doc
    slope = logistic(z) * push[owner]
    own = np.zeros(len(model.weights) + 3)
    unit = np.rint(slope * _UNIT)
    own[: len(model.weights)] = np.bincount(feature, unit[row], len(model.weights))
    plain = n - np.bincount(owner, minlength=len(n))
    own[-3] = unit.sum() + np.rint(plain * push * logistic(np.array(model.bias)) * _UNIT).sum()
    own[-2] = np.rint(push * logistic(np.array(model.leak)) * _UNIT).sum()
    own[-1] = np.rint(np.where(y > 0, np.log(-np.expm1(clean)), clean) * _UNIT).sum()
    return own.astype(np.int64)


def _sloped(shared: Broadcast):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        total = np.zeros(len(model.weights) + 3, np.int64)
        for part in parts:
            y, n = (part.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            size = part.column(2).value_lengths().to_numpy(zero_copy_only=False)
            flat = [part.column(k).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for k in (2, 3)]
            total += gradient(model, y, n, np.repeat(np.arange(len(y)), size), *flat)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["place", "total"])

    return run


def fit(bags: DataFrame, start: Model, rounds: int = ROUNDS) -> Model:
    """The model after some rounds of steps whose sizes grow while slopes keep their sign and halve where it turns (Rprop)."""
    sc = bags.sparkSession.sparkContext
    at = np.concatenate([start.weights, [start.bias, start.leak]])
    step, before = np.full(len(at), 0.4), np.zeros(len(at))
    model = start
    for _ in range(rounds):
        shared = sc.broadcast(model)
        total = np.zeros(len(at) + 1)
        for r in bags.mapInArrow(_sloped(shared), "place bigint, total bigint").groupBy("place").agg(F.sum("total").alias("total")).collect():  # a number for each feature
            total[r["place"]] = r["total"] / _UNIT
        shared.unpersist()
        slope = total[:-1].copy()
        slope[:-2] -= DECAY * at[:-2]
        turn = np.sign(slope) * np.sign(before)
        step = np.clip(np.where(turn > 0, step * 1.2, np.where(turn < 0, step * 0.5, step)), 1e-4, 2.0)
        slope[turn < 0] = 0
        at = np.clip(at + np.sign(slope) * step, -25.0, 25.0)
        before = slope
        model = replace(start, weights=at[:-2], bias=float(at[-2]), leak=float(at[-1]))
    return model


def trained(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rounds: int = ROUNDS) -> Model:
    """A model fitted on the labelled documents that are not held out.

    With labels of one kind, or none, there are no features and the leak alone
    gives every document their share.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    own = training(docs, labels, key, text, label)
    n = own.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("toxic")).first()
    share = min(max(n["toxic"] / n["n"], 1e-6), 1 - 1e-6) if n["n"] else 1e-6
    empty = Model(np.zeros(0, np.uint64), np.zeros(0), -25.0, float(np.log(share / (1 - share))))
    if not 0 < n["toxic"] < n["n"]:
        return empty
    rows = docs.select(docs[key].cast("long").alias("id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text")).join(small(own), ["id", "hash"]).select("y", "text")
    counts = rows.mapInArrow(_counted, "hash bigint, toxic bigint, rest bigint").groupBy("hash").agg(F.sum("toxic").alias("toxic"), F.sum("rest").alias("rest"))
    best = chosen(counts, n["toxic"], n["n"] - n["toxic"]).collect()  # FEATURES rows at most
    hashes = np.array([r["hash"] for r in best], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    odds = np.array([r["odds"] for r in best], float)[order]
    start = Model(hashes[order], np.clip(odds, -2.0, 2.0), -6.0, -4.0)
    bags = checkpointed(rows.mapInArrow(_bags(spark.sparkContext.broadcast(start)), "y bigint, n bigint, sentence array<int>, feature array<int>"))
    return fit(bags, start, rounds) if len(best) else empty


OUT = "score double, n_sentences bigint, worst_score double, worst_start bigint, worst_end bigint, n_offending bigint, offending array<struct<start:bigint,end:bigint,score:double>>"


def score(docs: DataFrame, model: Model, text: str = "text", worst: float = 0.5, drop: bool = False) -> DataFrame:
    """All columns of docs (with `drop` all but the text) with the score of each text and its sentences that reach `worst`.

    New columns (with underscores behind names that the table has): score,
    n_sentences, worst_score, worst_start and worst_end (code points; null
    without sentences), n_offending, and offending (start, end, score). Null and
    empty texts have no sentences, and the score of the leak; repeated rows each
    count; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES numbers
    names, kinds = zip(*(c.split(" ") for c in OUT.split(", ")), strict=True)
    names = fresh(docs, *names)
    place = docs.columns.index(text)
    kept = [k for k in range(len(docs.columns)) if not drop or k != place]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        m = shared.value
        for part in parts:
            data, off, _ = buffers(part.column(place))
            for i, j in batches_of(off, _PIECE):
                own = data[off[i] : off[j]]
                sents, *words = split(own, off[i : j + 1] - off[i])
                sentence, feature = _hits(sents, *words, m.hashes)
                first = np.searchsorted(sents.doc, np.arange(j - i + 1))
                z, row, clean = scores(m, np.diff(first), sents.doc[sentence], sentence, feature)
                each = np.full(len(sents.doc), m.bias)
                each[sentence] = z[row]
                top = np.lexsort((np.arange(len(each)), -each, sents.doc))[np.minimum(first[:-1], max(0, len(each) - 1))] if len(each) else np.zeros(j - i, np.int64)
                some = np.diff(first) > 0
                points = np.append(0, np.cumsum((own & 0xC0) != 0x80))
                begin = points[off[i:j] - off[i]]
                bad = np.flatnonzero(logistic(each) >= worst)
                cut = np.searchsorted(sents.doc[bad], np.arange(j - i + 1))
                spans = [points[x[bad]] - begin[sents.doc[bad]] for x in (sents.start, sents.end)]
                maybe = lambda x, some=some: pa.array(x, mask=~some)
                at = lambda x, top=top, some=some: x[top] if len(x) else np.zeros(len(some), x.dtype)
                new = [
                    pa.array(-np.expm1(clean)), pa.array(np.diff(first)), maybe(logistic(at(each))), maybe(points[at(sents.start)] - begin), maybe(points[at(sents.end)] - begin), pa.array(np.diff(cut)),
                    pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.StructArray.from_arrays([pa.array(spans[0]), pa.array(spans[1]), pa.array(logistic(each[bad]))], ["start", "end", "score"])),
                ]
                yield pa.RecordBatch.from_arrays([*(part.column(k).slice(i, j - i) for k in kept), *new], [*(part.schema.names[k] for k in kept), *names])

    own = columns(docs)
    schema = docs.select(*(own[k] for k in kept), *(F.lit(None).cast(k).alias(n) for n, k in zip(names, kinds, strict=True))).schema
    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """id, held_out, score, predicted and the sentences found, for every row of docs.

    Only labels of documents whose id has a checksum that 5 does not divide are
    learned from (held_out is false for these). A null id is not held out and has
    no label; several labels of one id count as toxic if any is; null labels are
    none; rows with one id share its label. Other columns are not looked at.
    """
    model = trained(docs, labels, key, text, label)
    found = score(docs.select(docs[key].cast("long").alias("id"), docs[text].cast("string").alias("text")), model, drop=True)
    held = F.coalesce(~in_fit(F.col("id")), F.lit(False))
    return found.select("id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "n_sentences", "worst_score", "worst_start", "worst_end", "n_offending")
