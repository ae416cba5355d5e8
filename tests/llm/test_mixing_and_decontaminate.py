"""Mixing and decontamination against their SQL, plain versions and odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from gridloom.llm import decontaminate, mixing
from gridloom.llm.queries import REGISTRY
from tests.llm.oracle import spark_rows, sql_rows


@pytest.mark.parametrize("name", ["op5_mixing", "op6_decontaminate"])
def test_query_equals_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    df = REGISTRY.queries[name](spark, sf)
    assert name != "op5_mixing" or "Python" not in df._jdf.queryExecution().executedPlan().toString()
    assert spark_rows(df) == sql_rows(REGISTRY.oracles[name])


TARGETS = {"source": {"s0": 0.5, "s1": 0.1, "gone": 0.3, "*": 0.4}, "lang": {"l0": 1, "l1": 2, "l2": 1}}


def test_raking_meets_given_targets(spark):
    """Named values get their shares, what is not named the rest by tokens, absent values nothing; a dimension without targets stays."""
    rng = random.Random(1)
    rows = [(f"s{i % 5}", f"l{j}", f"t{k}", rng.randint(1, 5000)) for i in range(5) for j in range(3) for k in range(4)] + [("s1", "l1", "t1", 0)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    held = mixing.probabilities(mixing.fitted(cells, TARGETS), least=0.0)
    shares = {(r.dimension, r.value): r for r in mixing.report(held).collect()}
    total = sum(r[3] for r in rows)
    tokens = lambda d, v: sum(r[3] for r in rows if r[d] == v)
    rest = total - tokens(0, "s0") - tokens(0, "s1")
    want = {("source", "s0"): 0.5, ("source", "s1"): 0.1, **{("source", f"s{i}"): 0.4 * tokens(0, f"s{i}") / rest for i in (2, 3, 4)}}
    want |= {("lang", "l0"): 0.25, ("lang", "l1"): 0.5, ("lang", "l2"): 0.25, **{("topic", f"t{k}"): tokens(2, f"t{k}") / total for k in range(4)}}
    assert set(want) == set(shares)
    for k, share in want.items():
        assert shares[k].wanted == pytest.approx(share, abs=1e-9) and shares[k].expected == pytest.approx(share, abs=2e-6)
    assert held.agg(F.max("p")).first()[0] == pytest.approx(1, abs=1e-6)  # the tightest cell keeps all
    less = mixing.probabilities(mixing.fitted(cells, TARGETS), 0.05, least=0.0)
    assert less.agg(F.sum(F.col("p") * F.col("tokens")) / F.sum("tokens")).first()[0] == pytest.approx(0.05, abs=1e-5)


def test_targets_that_cells_cannot_meet(spark):
    """Rounds end; what is wanted of a source that has one language only is left as near as can be."""
    cells = spark.createDataFrame([("a", "x", "t", 10), ("b", "y", "t", 10)], "source string, lang string, topic string, tokens long")
    found = mixing.fitted(cells, {"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.1, "y": 0.9}}, rounds=12).collect()
    assert sum(r.w for r in found) == pytest.approx(1) and all(0 <= r.w <= 1 for r in found)


def test_a_scarce_cell_does_not_take_the_corpus_along(spark):
    """Two words of one language that is to have an eighth: it keeps both, the rest meets its targets among itself, and the gap is told."""
    rows = [(f"s{i % 4}", "en" if i % 3 else "fr", f"t{i // 4 % 2}", 1000 + 37 * i) for i in range(24)] + [("s0", "es", "t0", 2)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    wanted = {"source": {"s0": 0.4, "*": 0.6}, "lang": {"es": 0.12, "*": 0.88}}
    total = sum(r[3] for r in rows)
    tight = mixing.probabilities(mixing.fitted(cells, wanted), least=0.0)
    assert tight.agg(F.sum(F.col("p") * F.col("tokens"))).first()[0] < 30  # as exact shares would have it
    held = mixing.probabilities(mixing.fitted(cells, wanted), least=0.3)
    assert held.agg(F.sum(F.col("p") * F.col("tokens"))).first()[0] == pytest.approx(0.3 * total, rel=0.15)
    got = {(r.dimension, r.value): r for r in mixing.report(held).collect()}
    assert held.where("lang = 'es'").first().p > 0.9 and got["lang", "es"].expected < 0.001 < got["lang", "es"].wanted
    assert got["source", "s0"].expected == pytest.approx(0.4, abs=0.02)
    assert held.where("p > 0").count() == held.count()
    with pytest.raises(ValueError, match="lang 'es' would have 0.00"):
        mixing.probabilities(mixing.fitted(cells, wanted), least=0.3, most_off=0.05)
    assert mixing.probabilities(mixing.fitted(cells.where("lang <> 'es'"), wanted), least=0.3, most_off=1e-6).count() == cells.where("lang <> 'es'").dropDuplicates(["source", "lang", "topic"]).count()


def test_small_probabilities_are_not_rounded_away(spark):
    cells = spark.createDataFrame([("a", "x", "t", 3), ("b", "x", "t", 30_000_000)], "source string, lang string, topic string, tokens long")
    found = {r.source: r.p for r in mixing.probabilities(mixing.fitted(cells, {"source": {"a": 0.5, "b": 0.5}}), least=0.0).collect()}
    assert found == {"a": pytest.approx(1), "b": pytest.approx(1e-7)}


def test_powers_of_present_shares(spark):
    cells = spark.createDataFrame([("a", "x", "t", 100), ("b", "x", "t", 900), ("b", "y", "t", 8000)], "source string, lang string, topic string, tokens long")
    got = {(r.dimension, r.value): r.wanted for r in mixing.report(mixing.probabilities(mixing.fitted(cells, {"source": 0.5, "lang": 0, "topic": 1.0}))).collect()}
    assert got["source", "a"] == pytest.approx(10 / (10 + 8900**0.5)) and got["lang", "x"] == got["lang", "y"] == 0.5 and got["topic", "t"] == 1


def test_no_python_on_the_way(spark):
    """Given shares reach the plan as literals: neither plan has rows made by Python."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (mixing.mix(docs, TARGETS), mixing.sample(docs, TARGETS)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ExistingRDD[value" not in plan
    given = mixing.wanted(docs.select(F.col("source"), F.lit(1).alias("tokens")), "source", {"source": {"src1": 0.5, "*": 0.5}})
    assert "ExistingRDD" not in given._jdf.queryExecution().analyzed().toString()


def test_mix_and_sample_agree_on_odd_rows(spark):
    rows = [(i, f"word {i} " * (i % 30), "en" if i % 3 else None, f"s{i % 4}", "x") for i in range(300)] + [(None, "no id", "en", "s1", "x"), (None, None, None, None, "x"), (7, "", "en", "s1", "x"), (8, rows_text := "again and again", "en", "s1", "x"), (8, rows_text, "en", "s1", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, p string").repartition(3)
    mixed, kept = mixing.mix(docs, TARGETS, budget=0.5), mixing.sample(docs, TARGETS, budget=0.5)
    assert mixed.count() == len(rows) and kept.columns == docs.columns
    assert sorted(str(r.id) for r in mixed.where("kept").collect()) == sorted(str(r.doc_id) for r in kept.collect())
    assert {r.id: r.kept for r in mixed.where("tokens = 0").collect()}[7] is True
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.sample(docs.limit(0)).count() == 0


def plain_pairs(docs, items, size=5, share=0.8):
    split = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
    out = []
    for i, t in docs:
        for j, x in items:
            w, k = split(x), min(size, len(split(x)))
            own = {b" ".join(w[a : a + k]) for a in range(len(w) - k + 1)} if k else set()
            d = split(t)
            both = len(own & {b" ".join(d[a : a + k]) for a in range(len(d) - k + 1)})
            if own and both >= share * len(own) - 1e-9:
                out.append((i, j, len(own), both))
    return sorted(out, key=str)


def test_contained_equals_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    word = lambda: rng.choice(["a", "b", "Été", "日本", "x1"] + [f"w{i}" for i in range(40)])
    some = lambda n: " ".join(word() for _ in range(n))
    items = [(i, some(rng.choice([1, 3, 5, 6, 12, 40, 41, 90]))) for i in range(40)] + [(40, None), (41, ""), (42, "a b a b a b a b a b"), (0, "other text under the same id of an item")]
    docs = [(i, some(rng.randint(0, 200))) for i in range(30)]
    for i in range(30, 110):
        t = (items[rng.randrange(40)][1] or "").split()
        for _ in range(rng.randint(0, 2)):
            t[rng.randrange(len(t))] = "changed"
        docs.append((i, f"{some(rng.randint(0, 300))}\n{' '.join(t).upper()}\t{some(rng.randint(0, 50))}"))
    docs += [(None, items[5][1]), (5, None), (5, ""), docs[40]]
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item long").repartition(3)
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, id long")
    want = plain_pairs(docs, items)
    got = lambda: sorted(((r.id, r.item, r.n_shingles, r.n_shared) for r in decontaminate.contained(d, b).collect()), key=str)
    assert got() == want and len(want) > 30
    monkeypatch.setattr(decontaminate, "BLOCK_GRAMS", 1)  # several blocks of items
    assert got() == want
    left = decontaminate.clean(d, b)
    assert sorted((str(r.doc_id) for r in left.collect())) == sorted(str(i) for i, _ in docs if i is None or i not in {w[0] for w in want})
    assert left.columns == d.columns
    assert decontaminate.contained(d.limit(0), b).count() == decontaminate.contained(d, b.limit(0)).count() == 0
    assert decontaminate.clean(d, b.limit(0)).count() == len(docs)


def test_signatures_lose_nothing():
    for n in range(1, 400):
        k = decontaminate.signature_length(n, 0.8)
        assert k >= n - decontaminate.needed(n, 0.8) + 1 or k == n
