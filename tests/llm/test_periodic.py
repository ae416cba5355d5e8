"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from gridloom.llm import periodic
from gridloom.llm.queries import REGISTRY

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    """All (start, length, period) by trying every period."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - s
            if length >= max(12, 2 * q):
                out.setdefault((s, length), q)  # periods ascend: the first is the smallest
    return sorted(((s, m, q) for (s, m), q in out.items()), key=lambda r: (r[0], r[2]))


def plain(key, text, plant=True):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(key).encode())
    if plant and key is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (key, len(found), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4), sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    docs = []
    for _ in range(60):
        kind = rng.random()
        if kind < 0.4:
            words = [rng.choice("ab") for _ in range(rng.randint(0, 70))]
        elif kind < 0.7:
            word = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
            words = [rng.choice("abcd") for _ in range(rng.randint(0, 9))] + word * rng.randint(1, 9) + word[: rng.randint(0, len(word))] + [rng.choice("ab") for _ in range(rng.randint(0, 9))]
        else:
            words = ["x"] * rng.randint(0, 40) + ["y"] * rng.randint(0, 40)
        docs.append(words)
    names = np.array([ord(w) - 97 for words in docs for w in words], np.int64)
    first = np.append(0, np.cumsum([len(w) for w in docs]))
    got = [[] for _ in docs]
    for d, s, m, q in zip(*periodic.runs(names, first)):
        got[d].append((int(s), int(m), int(q)))
    assert got == [plain_runs(w) for w in docs]


def test_names_are_equal_for_equal_stretches():
    rng = np.random.default_rng(1)
    names = rng.integers(0, 2, 60)
    for k, level in enumerate(periodic.levels(names, 60)):
        size = 1 << k
        stretch = [tuple(names[i : i + size]) for i in range(len(names) - size + 1)]
        assert len(level) == len(stretch) and len(set(zip(level.tolist(), stretch))) == len(set(stretch)) == len(set(level.tolist()))


def test_rows_of_all_kinds(spark):
    rng = random.Random(2)
    rows = [(i + 100, " ".join(rng.choice(["ä", "b", "日本"]) for _ in range(rng.randint(0, 90)))) for i in range(120)]
    rows += [(None, "a " * 30), (None, None), (7, None), (7, ""), (7, " \t\n"), (8, "a\tb " * 9), (8, "a\tb " * 9), (20, "w " * 3000 + "v"), (30, " ".join(f"w{i % 701}" for i in range(3000)))]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, start int").repartition(3)
    got = [(r.id, *(r[c] for c in COLUMNS)) for r in periodic.collapse(df, plant=True).collect()]
    assert sorted(got, key=str) == sorted((plain(*r) for r in rows), key=str)
    assert {(r.id, r.n_runs) for r in periodic.collapse(df).where("id = 20").collect()} == {(20, 1)}
    assert periodic.collapse(df.limit(0)).count() == 0


def test_small_chunks_change_nothing(monkeypatch):
    rng = np.random.default_rng(3)
    names, first = rng.integers(0, 2, 900), np.array([0, 0, 400, 411, 900])
    want = periodic.runs(names, first)
    monkeypatch.setattr(periodic, "_CHUNK", 37)
    assert all((a == b).all() for a, b in zip(want, periodic.runs(names, first)))


def test_query_on_driver_table(spark):
    """Whole table; brute force tries each period of texts up to 1,500 words."""
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in REGISTRY.queries["op13_periodic"](spark, sf).collect()}
    assert got.keys() == rows.keys()
    short = [i for i, t in rows.items() if len(WORD.findall(t or "")) <= 1500]
    assert len(short) > 0.8 * len(rows) and sum(got[i].n_runs > 0 for i in short) > 10
    for i in short:
        assert (i, *(got[i][c] for c in COLUMNS)) == plain(i, rows[i])
