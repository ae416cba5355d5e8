"""Vectors compressed to codes: product quantization by whole numbers.

Vectors are cut into parts; the parts of one position have a codebook. In each
round every codebook goes to all tasks as a kd-tree, each part looks for its
nearest entry by branch and bound, and integer sums over all rows move the
entries. A node whose bound equals the best distance so far is still visited, so
that of entries equally near the one with the lowest index wins. As all numbers
are whole, neither the order of rows nor their partitions change a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import bounded_batches, checkpointed, small

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Entries in a leaf of a tree.
LEAF = 2
#: Rows that are searched together.
_ROWS = 1 << 14


@dataclass
class Node:
    """Entries below a node, and the box around them."""

    low: np.ndarray
    high: np.ndarray
    entries: np.ndarray  # their indices, ascending; in leaves only looked at
    sides: tuple[Node, Node] | None = None


def tree(book: np.ndarray, entries: np.ndarray | None = None) -> Node:
    """A kd-tree over some entries (rows of book): halves by the median of the widest dimension."""
    entries = np.arange(len(book)) if entries is None else entries
    own = book[entries]
    node = Node(own.min(axis=0), own.max(axis=0), np.sort(entries))
    if len(entries) > LEAF and (node.high > node.low).any():
        axis = int(np.argmax(node.high - node.low))
        order = entries[np.argsort(own[:, axis], kind="stable")]
        node.sides = (tree(book, order[: len(order) // 2]), tree(book, order[len(order) // 2 :]))
    return node


def _bound(node: Node, points: np.ndarray) -> np.ndarray:
    """The least squared distance that anything in the node's box can have."""
    gap = np.maximum(np.maximum(node.low - points, points - node.high), 0)
    return (gap * gap).sum(axis=1)


def nearest(root: Node, book: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry for each point (ties to the lower index), and its squared distance."""
    best = np.full(len(points), np.iinfo(np.int64).max)
    index = np.full(len(points), len(book))

    def visit(node: Node, rows: np.ndarray, bound: np.ndarray) -> None:
        near = bound <= best[rows]  # equal bounds too: a lower index may be there
        rows = rows[near]
        if not len(rows):
            return
        if node.sides is None:
            own = points[rows]
            for e in node.entries:
                gap = own - book[e]
                d = (gap * gap).sum(axis=1)
                better = (d < best[rows]) | (d == best[rows]) & (e < index[rows])
                best[rows[better]], index[rows[better]] = d[better], e
            return
        a, b = node.sides
        at_a, at_b = _bound(a, points[rows]), _bound(b, points[rows])
        left = at_a <= at_b
        for own, first, second, d1, d2 in ((left, a, b, at_a, at_b), (~left, b, a, at_b, at_a)):
            visit(first, rows[own], d1[own])
            visit(second, rows[own], d2[own])

    if len(points):
        visit(root, np.arange(len(points)), np.zeros(len(points), np.int64))
    return index, best


def _shape(vectors: DataFrame, parts: int) -> int:
    """Components in a vector: the length that most rows have (of equals the greatest), rounded down to whole parts."""
    found = vectors.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    return found["n"] if found and found["n"] % parts == 0 else 0


def _whole(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is there and finite throughout, with its components as whole numbers."""
    x = F.col(column)
    fine = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return vectors.where(F.coalesce(fine, F.lit(False))).withColumn("vector", F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long")))


def _matrix(part: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    """The batch's vectors, all of one width."""
    return part.column(part.schema.get_field_index(column)).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, width)


def _searched(books: list[np.ndarray], trees: list[Node], rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Part number, the rows' parts, indices and distances."""
    for p, own in enumerate(np.split(rows, len(books), axis=1)):
        yield p, own, *nearest(trees[p], books[p], own)


def _moved(rows: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: floors of means; entries that nothing is nearest to stay."""
    width = len(books) * books[0].shape[1]
    shared = rows.sparkSession.sparkContext.broadcast((books, [tree(b) for b in books]))  # as many numbers as a few vectors

    def sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, trees = shared.value
        total = np.zeros((len(books), len(books[0]), books[0].shape[1] + 1), np.int64)
        for part in parts:
            own = _matrix(part, "vector", width)
            for i in range(0, len(own), _ROWS):
                for p, x, index, _ in _searched(books, trees, own[i : i + _ROWS]):
                    np.add.at(total[p], index, np.hstack([np.ones((len(x), 1), np.int64), x]))
        p, e, k = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)) for a in (p, e, k, total[p, e, k])], ["part", "entry", "place", "total"])

    each = rows.select("vector").mapInArrow(sums, "part bigint, entry bigint, place bigint, total bigint")
    total = np.zeros((len(books), len(books[0]), books[0].shape[1] + 1), np.int64)
    for r in each.groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect():  # a number for each number of the codebooks
        total[r["part"], r["entry"], r["place"]] = r["total"]
    shared.unpersist()
    return [np.where(t[:, :1] > 0, t[:, 1:] // np.maximum(t[:, :1], 1), b) for t, b in zip(total, books, strict=True)]


def told(books: list[np.ndarray]) -> str:
    """SHA-256 of all numbers of the codebooks by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel()).encode()).hexdigest()


def compress(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Codes of all vectors by codebooks that all of them have trained.

    Rows whose vector is null or holds null or non-finite components are dropped.
    Codebooks begin as the parts of the vectors with the smallest ids (equal ids:
    the smaller vector first; null ids after all others); with fewer rows they have
    fewer entries. Returns id, label, code (two hex digits for each part), error
    (squared distances of all parts), label_error (errors of all rows of that label,
    null labels together) and codebooks_sha256. Repeated rows each count. A row
    whose vector has another length than most (or than whole parts allow) gets
    neither code nor error and moves no entry. Components beyond what squared
    distances can hold in 64 bits are an error. An empty table gives no rows;
    further columns are not looked at.

    The numbers of all codebooks are those of `entries` vectors; that is what tasks
    get and what the driver holds.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    own = vectors.select(vectors[key].cast("long").alias("id"), vectors[label].alias("label"), vectors[column].alias("vector"))
    rows = checkpointed(_whole(own, "vector"))
    width = _shape(rows, parts)
    fit = rows.where(F.size("vector") == width) if width else rows.limit(0)
    first = [r["vector"] for r in fit.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()]
    books = [np.array([v[p * width // parts : (p + 1) * width // parts] for v in first], np.int64) for p in range(parts)] if first else []
    if first:
        most = int(np.sqrt((1 << 62) / width)) // 2
        wild = fit.select(F.greatest(F.array_max("vector"), -F.array_min("vector")).alias("m")).agg(F.max("m").alias("m")).first()["m"]
        if wild > most:
            raise ValueError(f"a component of {wild} / {SCALE} is too large; up to {most} / {SCALE} distances fit 64 bits")
        for _ in range(rounds):
            books = _moved(fit, books)
    shared = spark.sparkContext.broadcast((books, [tree(b) for b in books]))

    def codes(parts_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, trees = shared.value
        for part in parts_:
            x = _matrix(part, "vector", width)
            index = np.zeros((len(x), len(books)), np.uint8)
            error = np.zeros(len(x), np.int64)
            for i in range(0, len(x), _ROWS):
                for p, _, at, d in _searched(books, trees, x[i : i + _ROWS]):
                    index[i : i + _ROWS, p] = at
                    error[i : i + _ROWS] += d
            code = [v.tobytes().hex() for v in index]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(code, pa.string()), pa.array(error)], ["id", "label", "code", "error"])

    kind = rows.schema["label"].dataType.simpleString()
    coded = fit.mapInArrow(codes, f"id bigint, label {kind}, code string, error bigint")
    odd = rows.where(F.size("vector") != width) if width else rows
    coded = checkpointed(coded.unionByName(odd.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))))
    by_label = small(coded.groupBy("label").agg(F.sum("error").alias("label_error"))).withColumnRenamed("label", "_label")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select("id", "label", "code", "error", "label_error", F.lit(told(books)).alias("codebooks_sha256"))


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same over table embeddings in DuckDB SQL, all distances written out."""
    steps = [
        "k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda c: floor(c::DOUBLE * 4096)::BIGINT) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)",
        f"p AS MATERIALIZED (SELECT vec_id, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x FROM k, range({parts}) r(p))",
        f"b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM p WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT {entries}))",
    ]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (SELECT vec_id, p, x, best.e AS e, best.d AS d FROM (
            SELECT p.vec_id, p.p, any_value(p.x) AS x, min({{'d': list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': b.e}}) AS best
            FROM p JOIN b{n} b ON p.p = b.p GROUP BY p.vec_id, p.p))""")
        if n < rounds:
            steps.append(f"""b{n + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{n} b LEFT JOIN (
                SELECT p, e, list(m ORDER BY i) AS x FROM (
                    SELECT p, e, i, floor(sum(x[i + 1])::DOUBLE / count(*))::BIGINT AS m FROM a{n}, LATERAL (SELECT unnest(range(len(x))) AS i) GROUP BY p, e, i) GROUP BY p, e) m USING (p, e))""")
    return f"""
    WITH {', '.join(steps)},
    c AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id),
    l AS (SELECT label, sum(error)::BIGINT AS label_error FROM c JOIN k USING (vec_id) GROUP BY label),
    s AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
    SELECT vec_id, code, error, label_error, codebooks_sha256 FROM c JOIN k USING (vec_id) JOIN l ON k.label IS NOT DISTINCT FROM l.label, s
    """
