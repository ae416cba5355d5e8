"""Vector codes against plain arithmetic and SQL."""

import hashlib
import math
import random

import numpy as np
import pytest

from gridloom.llm import codes
from gridloom.llm.queries import REGISTRY
from tests.llm.oracle import spark_rows, sql_rows


@pytest.mark.parametrize("seed", range(5))
def test_nearest_keeps_the_lower_of_ties(seed):
    rng = np.random.default_rng(seed)
    book = rng.integers(-2, 3, (16, 3)) if seed else np.zeros((16, 3), np.int64)
    points = rng.integers(-4, 5, (500, 3))
    d = ((points[:, None] - book[None]) ** 2).sum(axis=2)
    index, best = codes.nearest(codes.tree(book), book, points)
    assert (index == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()


def plain(rows):
    """rows: id, label, vector; the definition word for word, for vectors of one length."""
    kept = [(i, lab, [math.floor(4096 * c) for c in v]) for i, lab, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    w = len(kept[0][2]) // 8
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(v, p) for *_, v in kept[:16]] for p in range(8)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda p, v: min((dist(cut(v, p), b), e) for e, b in enumerate(books[p]))
    for _ in range(6):
        new = []
        for p in range(8):
            by = {}
            for *_, v in kept:
                by.setdefault(near(p, v)[1], []).append(cut(v, p))
            new.append([[sum(c) // len(by[e]) for c in zip(*by[e])] if e in by else b for e, b in enumerate(books[p])])
        books = new
    out = [(i, lab, "".join(f"{near(p, v)[1]:02x}" for p in range(8)), sum(near(p, v)[0] for p in range(8))) for i, lab, v in kept]
    by = {}
    for _, lab, _, e in out:
        by[lab] = by.get(lab, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, lab, c, e, by[lab], sha) for i, lab, c, e in out]


def test_rows_of_all_kinds(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, 1, 2]), [rng.uniform(-1, 1) for _ in range(16)]) for i in range(60)]
    rows += [(7, 1, rows[0][2])] * 3 + [(None, None, rows[3][2]), (90, 2, [0.0] * 16), (91, 2, [0.0] * 16), (-1, 3, None), (-2, 3, [None] + [0.5] * 15), (-3, 3, [float("nan")] + [0.5] * 15), (-4, 3, [float("-inf")] + [0.5] * 15)]
    df = spark.createDataFrame([(i, v, lab, "x") for i, lab, v in rows], "vec_id long, embedding array<double>, label int, code string").repartition(5)
    got = codes.compress(df)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(plain(rows), key=str)
    assert sorted(map(str, got.collect())) == sorted(map(str, codes.compress(df.repartition(2)).collect()))
    few = df.where("vec_id in (1, 2, 3)")
    assert sorted((tuple(r) for r in codes.compress(few).collect()), key=str) == sorted(plain([r for r in rows if r[0] in (1, 2, 3)]), key=str)
    assert codes.compress(df.limit(0)).count() == 0


def test_odd_lengths_get_no_code_and_large_numbers_are_refused(spark):
    rows = [(1, [0.5] * 8, 1), (2, [0.25] * 8, 1), (3, [0.5] * 5, 1), (4, [], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.id: (r.code, r.error, r.label_error) for r in codes.compress(df).collect()}
    assert got == {1: ("00" * 8, 0, 0), 2: ("01" * 8, 0, 0), 3: (None, None, 0), 4: (None, None, None)}
    assert {r.code for r in codes.compress(df.where("vec_id = 3")).collect()} == {None}
    with pytest.raises(ValueError, match="too large"):
        codes.compress(spark.createDataFrame([(1, [1e30] * 8, 1)], "vec_id long, embedding array<double>, label int"))


def test_query_against_sql(spark):
    want = sql_rows(REGISTRY.oracles["op12_vector_codes"])
    assert spark_rows(REGISTRY.queries["op12_vector_codes"](spark, "/root/testdata/sf0.001")) == want
