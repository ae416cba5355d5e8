"""Chat formatting: exact round trip, trees against plain recursion, the query against its SQL."""

import random

import pytest
from pyspark.sql import functions as F

from gridloom.llm import chat_trees
from gridloom.llm.queries import REGISTRY
from tests.llm.oracle import spark_rows, sql_rows

TREE = "conv long, node long, parent long, role string, text string, score double"
NASTY = ["\\", "\\\\l", "<turn>### user: x</turn>\n", "#", "\\h<", "a\\", "\\### Assistant: </turn> ok", "", "é日\U0001f600\n\n", "\\c:\\n", None, "x" * 9000]


def plain_paths(rows):
    """Per conversation the (score, nodes) of each root-to-leaf path."""
    out = {}
    for c in {r[0] for r in rows}:
        own = {r[1]: r for r in rows if r[0] == c}
        answered = {r[2] for r in own.values()}
        for leaf in own.values():
            way, at = [], leaf
            while at is not None and len(way) <= len(own):
                way.append(at)
                at = own.get(at[2])
            if leaf[1] not in answered and len(way) <= len(own):
                out.setdefault(c, []).append((round(sum(r[5] or 0 for r in way), 6), [r[1] for r in reversed(way)]))
    return {c: sorted(p, key=lambda x: (-x[0], x[1][-1])) for c, p in out.items()}


@pytest.mark.parametrize("seed,top", [(1, None), (2, 2)])
def test_trees_equal_plain_recursion(spark, seed, top):
    rng, rows = random.Random(seed), []
    for c in range(8):
        n = rng.choice([1, 3, 20, 70])
        for i in range(n):
            parent = None if i == 0 else i - 1 if c % 2 and rng.random() < 0.9 else rng.randrange(i)
            rows.append((c, i, 999 if rng.random() < 0.03 else parent, rng.choice(["user", "assistant"]), rng.choice(NASTY), float(rng.randrange(9))))
    rows += [(50, 0, None, "user", "q", None), (50, 1, 2, "user", "circle", 1.0), (50, 2, 1, "user", "circle", 1.0), (50, 3, 2, "user", "below", 1.0)]
    made = chat_trees.formatted(spark.createDataFrame(rows, TREE).repartition(3), top).cache()
    got = {}
    for r in chat_trees.paths(spark.createDataFrame(rows, TREE), top).collect():
        got.setdefault((r.conv, r.branch), []).append((r.pos, r.node, round(r.score, 6)))
    want = {(c, b + 1): p for c, ps in plain_paths(rows).items() for b, p in enumerate(ps[:top])}
    assert {k: (v[0][2], [n for _, n, _ in sorted(v)]) for k, v in got.items()} == want
    own = {(r[0], r[1]): r for r in rows}
    back = chat_trees.read_back(made).collect()
    assert len(back) == len(want)
    for r in back:
        nodes = [own[r.conv, n] for n in want[r.conv, r.branch][1]]
        assert r.roles == [x[3] for x in nodes] and r.texts == [x[4] or "" for x in nodes]
        assert r.learned == [x[4] or "" for x in nodes if x[3] == "assistant"]


def test_escapes_round_trip(spark):
    rows = [(t, t + x) for t in NASTY if t is not None for x in ("", "\\", "<", "l")]
    df = spark.createDataFrame(rows, "a string, b string").select("b", chat_trees.unescaped(chat_trees.escaped(F.col("b"))).alias("back"), chat_trees.unescaped(chat_trees.escaped(F.col("b"), role=True)).alias("role"), chat_trees.escaped(F.col("b")).alias("e"))
    for r in df.collect():
        assert r.back == r.role == r.b and "<" not in r.e


def test_rows_of_all_kinds(spark):
    rows = [(None, 0, "user", "a", 1), (None, 1, "assistant", None, 1), (1, None, None, "n", 1), (1, 3, "a: b\n", "x", 1), (1, 3, "a: b\n", "x", 1), (1, 3, "assistant", "tie", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node int")
    back = sorted(chat_trees.read_back(chat_trees.formatted(chat_trees.line_of_turns(df))).collect(), key=str)
    assert [(r.conv, r.roles, r.texts, r.learned) for r in back] == [(1, ["", "a: b\n", "a: b\n", "assistant"], ["n", "x", "x", "tie"], ["tie"]), (None, ["user", "assistant"], ["a", ""], [""])]
    assert chat_trees.formatted(chat_trees.line_of_turns(df.limit(0))).count() == 0
    twice = [(1, 0, None, "user", "q", 0.0), (1, 1, 0, "assistant", "a", 0.0), (1, 1, 0, "assistant", "a", 0.0)]
    assert [r.texts for r in chat_trees.read_back(chat_trees.formatted(spark.createDataFrame(twice, TREE))).collect()] == [["q", "a"]] * 2


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    df = REGISTRY.queries["op8_chat_trees"](spark, sf)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    assert spark_rows(df) == sql_rows(REGISTRY.oracles["op8_chat_trees"])
