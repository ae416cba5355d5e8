"""Substring and suffix dedup against brute force."""

import hashlib
import random
import re

import pytest

from gridloom.llm import repeats
from gridloom.llm.queries import REGISTRY
from gridloom.llm.substring_dedup import dedup_words, doubling
from gridloom.llm.suffix_dedup import bucket_pointers, dedup_bytes, depths

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, kind, n):
    """id, n_units, n_removed, n_spans, kept of each row, from the definition."""
    units = []
    for key, text in rows:
        raw = (text or "").encode()
        units.append(WORD.findall(raw) if kind == "words" else [raw[i : i + 1] for i in range(len(raw))])
    first = {}
    window = lambda u, i: b"\0".join(u[i : i + n]) if kind == "words" else b"".join(u[i : i + n])
    for (key, _), u in zip(rows, units):
        for i in range(len(u) - n + 1) if key is not None else ():
            w = window(u, i)
            first[w] = min(first.get(w, key), key)
    out = []
    for (key, _), u in zip(rows, units):
        gone = [False] * len(u)
        for i in range(len(u) - n + 1) if key is not None else ():
            if first[window(u, i)] < key:
                gone[i : i + n] = [True] * n
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = (b" " if kind == "words" else b"").join(x for x, g in zip(u, gone) if not g)
        out.append((key, len(u), sum(gone), spans, kept))
    return sorted(out, key=str)


def spark_rows(spark, rows, kind, n):
    df = spark.createDataFrame([(k, t, "x", 0) for k, t in rows], "doc_id long, text string, kept string, id int").repartition(3)
    found = dedup_words(df, n) if kind == "words" else dedup_bytes(df, n, q=min(16, n // 3))
    out = []
    for r in found.collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_removed and len(r.spans) == r.n_spans
        kept = r.kept.encode() if kind == "words" else bytes(r.kept)
        out.append((r.id, r.n_units, r.n_removed, r.n_spans, kept))
    return sorted(out, key=str)


def made(seed, words):
    """Documents that share passages, near copies, runs of one word, odd spaces and other scripts."""
    rng = random.Random(seed)
    vocab = ["a", "bb", "été", "日本", "w" * 40] + [f"t{i}" for i in range(words)]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", " ", "\n", "\t ", "\x0b"]) for _ in range(n))
    parts = [text(rng.randint(5, 90)) for _ in range(12)]
    rows = []
    for _ in range(60):
        t = "".join(rng.choice([rng.choice(parts), text(rng.randint(0, 60)), "la " * rng.randint(0, 90)]) for _ in range(rng.randint(0, 5)))
        if rng.random() < 0.3 and rows:
            t = rng.choice(rows)[1] or ""
            if t and rng.random() < 0.7:
                k = rng.randrange(len(t))
                t = t[:k] + rng.choice(["X", " ", ""]) + t[k + 1 :]
        rows.append((rng.randint(-40, 200), t))
    return rows + [(None, parts[0] * 3), (None, None), (7, None), (8, ""), rows[0], rows[1], (rows[2][0], "other text " + parts[1])]


@pytest.mark.parametrize("kind,n,seed,words", [("words", 50, 1, 500), ("words", 50, 2, 3), ("words", 13, 3, 20), ("bytes", 50, 4, 500), ("bytes", 50, 5, 2), ("bytes", 20, 6, 30)])
def test_equals_brute_force(spark, kind, n, seed, words):
    rows = made(seed, words)
    assert spark_rows(spark, rows, kind, n) == brute(rows, kind, n)


@pytest.mark.parametrize("kind", ["words", "bytes"])
def test_documents_in_pieces(spark, kind, monkeypatch):
    """Long documents are cut into overlapping pieces."""
    monkeypatch.setattr(repeats, "CHUNK", 64)
    monkeypatch.setattr(repeats, "CUT", 128)
    rows = made(9, 40)
    plan = repeats.Plan(kind, 20, (5, 10, 20), 1, 1)
    import numpy as np

    data = np.frombuffer(b"".join((t or "").encode() for _, t in rows), np.uint8)
    off = np.concatenate([[0], np.cumsum([len((t or "").encode()) for _, t in rows])])
    seen = sum(int(c.starts(20).sum()) for c in repeats.chunks(plan, data, off, np.ones(len(rows), bool)))
    sizes = [len(WORD.findall((t or "").encode())) if kind == "words" else len((t or "").encode()) for _, t in rows]
    assert seen == sum(max(0, s - 19) for s in sizes)


def test_empty_table_and_levels(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_words(empty).count() == 0 and dedup_bytes(empty).count() == 0
    assert doubling(50) == (12, 25, 50) and depths(16, 50) == (16, 32, 50) and depths(6, 100) == (6, 12, 24, 48, 96, 100)
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted((r.id, r.n_units, r.kept) for r in dedup_words(blank).collect()) == [(1, 0, ""), (2, 0, "")]


@pytest.mark.parametrize("kind", ["words", "bytes"])
def test_very_long_text(spark, kind):
    """A text of more units than are hashed at once, with repeats across the cuts."""
    rng = random.Random(11)
    long = " ".join(f"{rng.randrange(10**5):x}" for _ in range((1 << 20) + 9000 if kind == "words" else 230_000))
    assert len(long) > 1 << 20
    around = (1 << 20) * (len(long) // (1 << 20)) if kind == "bytes" else len(" ".join(long.split()[: 1 << 20]))
    rows = [(5, long), (3, long[around - 400 : around + 400]), (4, long[:700] + " end"), (9, long[-900:]), (1, "short")]
    assert spark_rows(spark, rows, kind, 50) == brute(rows, kind, 50)


def test_pointers_tell_strings_apart(spark):
    """Equal identifiers at every depth for equal bytes, and for no others."""
    import numpy as np

    data = np.frombuffer(b"abcabcabd" * 40 + b"xyz" * 30, np.uint8)
    chunk = repeats.Chunk(repeats.hashing.byte_units(data), np.array([0, len(data)]), np.array([0]))
    plan = repeats.Plan("bytes", 50, depths(16, 50), 1, 1)
    for level, depth in enumerate(plan.levels):
        found = bucket_pointers(plan, level, chunk)
        raw = data.tobytes()
        texts = [raw[i : i + depth] for i in range(len(raw) - depth + 1)]
        assert len(found) == len(texts) and len(set(zip(found.tolist(), texts))) == len(set(texts)) == len(set(found.tolist()))


@pytest.mark.parametrize("name,kind", [("op1_substring_dedup", "words"), ("op3_suffix_dedup", "bytes")])
def test_query_on_driver_table(spark, name, kind):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    size = "n_words" if kind == "words" else "n_bytes"
    got = sorted(((r.doc_id, r[size], r.n_removed, r.kept_sha256) for r in REGISTRY.queries[name](spark, sf).collect()), key=str)
    assert got == sorted(((k, n, g, hashlib.sha256(x).hexdigest()) for k, n, g, _, x in brute(rows, kind, 50)), key=str)
