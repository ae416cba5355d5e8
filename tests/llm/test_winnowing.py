"""Winnowing against brute force, and its guarantee."""

import hashlib
import random

import numpy as np
import pytest

from gridloom.llm import winnowing
from gridloom.llm.queries import REGISTRY


def plain(text, k, w):
    """Places of the smallest hash of each window, rightmost of equals, from the gram hashes alone."""
    k = min(k, len(text))
    if not k:
        return []
    gram = [int(winnowing.marks(text[i : i + k], k, 1)[0][0]) for i in range(len(text) - k + 1)]
    width = min(w, len(gram))
    return sorted({max(range(i, i + width), key=lambda j: (-gram[j], j)) for i in range(len(gram) - width + 1)})


@pytest.mark.parametrize("seed", range(4))
def test_marks_equal_brute_force(seed):
    rng = random.Random(seed)
    for n in (0, 1, 5, 30, 300):
        text = "".join(rng.choice("abé日 ") for _ in range(n)) if seed else "ab" * (n // 2)
        hashes, places = winnowing.marks(text, 6, 9)
        assert places.tolist() == plain(text, 6, 9) and len(hashes) == len(places)


def test_shared_run_shares_a_mark(monkeypatch):
    rng = random.Random(1)
    t = lambda n: "".join(rng.choice("abcdef ") for _ in range(n))
    for _ in range(50):
        run = t(winnowing.K + winnowing.W - 1)
        a, b = t(90), t(40)
        x, y = winnowing.marks(a + run + t(50)), winnowing.marks(b + run + t(9))
        at = {(int(h), int(p) - len(a)) for h, p in zip(*x)} & {(int(h), int(p) - len(b)) for h, p in zip(*y)}
        assert any(0 <= p <= len(run) - winnowing.K for _, p in at)
    long = t(3000)
    whole = winnowing.marks(long)
    monkeypatch.setattr(winnowing, "_PIECE", 200)
    pieces = winnowing.marks(long)
    assert (whole[0] == pieces[0]).all() and (whole[1] == pieces[1]).all()


def check(rows, got):
    """Rows of study against the definition; rows sort by id, nulls first, then by text."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    want = []
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, e, n = (set(winnowing.marks(x)[0].tolist()) for x in (text, edited, after))
        near = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), winnowing.digest(*winnowing.marks(text)), winnowing.digest(*winnowing.marks(edited)), near(a, e), near(a, n)))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_rows_of_all_kinds(spark):
    rng = random.Random(3)
    t = lambda n: "".join(rng.choice("abcdéf 日") for _ in range(n))
    rows = [(rng.randint(-30, 300), t(rng.randint(0, 400))) for _ in range(80)] + [(None, t(90)), (None, None), (5, None), (5, "x"), (5, "x"), (400, "y" * 3000)]
    df = spark.createDataFrame([(i, x, 1) for i, x in rows], "doc_id long, text string, slot int").repartition(3)
    got = winnowing.study(df)
    check(rows, [tuple(r)[:7] for r in got.collect()])
    check([(1, "only one row")], [tuple(r)[:7] for r in winnowing.study(spark.createDataFrame([(1, "only one row")], "doc_id long, text string")).collect()])
    assert winnowing.study(df.limit(0)).count() == 0
    assert winnowing.cut_points(df.select(df.doc_id.alias("id")), 7).tolist() == sorted(set(winnowing.cut_points(df.select(df.doc_id.alias("id")), 7).tolist()))
    kept = {r.id: r.marks for r in winnowing.fingerprints(df.where("doc_id = 400")).collect()}
    assert np.array_equal([m.position for m in kept[400]], winnowing.marks("y" * 3000)[1])


def test_query_on_driver_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, [tuple(r)[:7] for r in REGISTRY.queries["op9_winnowing"](spark, sf).collect()])
