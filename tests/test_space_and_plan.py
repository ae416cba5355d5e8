"""Spaces and plans against golden values and plain enumeration."""

from itertools import product

import pytest
from pyspark.sql import functions as F

from gridloom.functions import hashing
from gridloom.plans import plan as plans
from gridloom.plans import space as spaces

TINY = {
    "axes": {
        "capability": ["qa", "coding", "ask"], "mode": ["none", "persona"], "conv": ["single", "clarify", "tool"], "fmt": ["prose", "code"], "ic": ["clean", "missing"], "am": ["direct", "ask_first"],
        "language": ["en", "de"], "knowledge": {"science": {"physics": ["optics", "heat"], "life": ["cells"]}, "arts": {"music": ["scales", "choirs"]}}, "style": ["plain", "warm"], "difficulty": ["low", "mid", "high"], "context": ["short", "long"], "visual": {"a": ["maps"], "b": ["plants", "tools"]},
    },
    "restricted": ["capability", "mode", "conv", "fmt", "ic", "am"],
    "free": ["language", "knowledge", "style", "difficulty", "context"],
    "gated": "visual",
    "pairs": [
        {"id": "R1", "from": "mode", "to": "capability", "rules": [["none", ["*"]], ["persona", ["qa", "ask"]]]},
        {"id": "R2", "from": "capability", "to": "conv", "rules": [["qa", ["single", "clarify"]], ["coding", ["single", "tool"]], ["ask", ["clarify"]]]},
        {"id": "R3", "from": "capability", "to": "fmt", "rules": [["qa", ["prose"]], ["coding", ["code"]], ["ask", ["prose"]]]},
        {"id": "R4a", "from": "capability", "to": "am", "rules": [["qa", ["direct"]], ["coding", ["direct"]], ["ask", ["ask_first"]]]},
        {"id": "R4b", "from": "ic", "to": "am", "rules": [["clean", ["*"]], ["missing", ["ask_first"]]]},
    ],
    "modality": {"must": ["qa"], "may": ["coding"], "text_only": ["ask"]},
    "turns": {"single": 1, "clarify": 2, "tool": "multi"},
}


@pytest.fixture(scope="module")
def tiny(spark):
    space = spaces.parse(TINY)
    frames = spaces.to_frames(spark, space)
    return space, frames, spaces.units(spaces.legal_blocks(frames), frames).cache()


def test_blocks_equal_plain_enumeration(tiny):
    space, frames, units = tiny
    allowed = {p.name: dict(p.rules) for p in space.pairs}
    axes = {p.name: (p.source, p.to) for p in space.pairs}
    want = []
    for values in product(*(space.axes[a] for a in space.restricted)):
        own = dict(zip(space.restricted, values))
        if all(own[t] in allowed[n][own[s]] for n, (s, t) in axes.items()):
            want.append(values)
    rows = [tuple(r) for r in units.orderBy("unit_index").collect()]
    assert [r[2:] for r in rows if r[1] == "text"] == want and len(want) == 10
    assert [r[2:] for r in rows if r[1] == "image"] == want[:6] and [r[0] for r in rows] == list(range(16))
    assert spaces.counts(space) == {"raw": 144, "free": 120}
    assert [tuple(r) for r in spaces.unsolvable(spaces.legal_blocks(frames), frames, "capability", "ic").collect()] == [("qa", "missing"), ("coding", "missing")]
    assert [spaces.turn_count(space.turns[c]) for c in ("single", "clarify", "tool")] == [1, 3, 7]


def test_exact_mode_golden_values(spark, tiny):
    order = plans.cycle_order_exact(spark, 16, 2, 7, "tiny").collect()
    at = {(r.cycle, r.position): r.unit_index for r in order}
    assert [at[0, p] for p in range(16)] == [3, 10, 7, 13, 11, 2, 5, 6, 14, 8, 4, 0, 12, 15, 9, 1]
    assert [at[1, p] for p in range(16)] == [12, 8, 14, 6, 7, 3, 13, 9, 4, 1, 10, 2, 0, 15, 5, 11]
    assert hashing.run_key("tiny", 7) == "5dd1667a"
    axes = [("language", (0, 1)), ("style", (0, 1)), ("difficulty", (0, 1, 2)), ("context", (0, 1))]
    rows = plans.free_draws_exact(plans.indices(spark, 4, 16), [(n, [str(v) for v in vs]) for n, vs in axes], 7, "tiny").orderBy("plan_index").collect()
    assert [tuple(int(r[n]) for n, _ in axes) for r in rows] == [(0, 0, 2, 0), (1, 0, 1, 1), (1, 0, 1, 0), (0, 0, 0, 0)]
    first = plans.free_draws_exact(plans.indices(spark, 1, 16), [("language", ()), ("style", ("a", "b"))], 7, "tiny").first()
    assert first.language == "English" and first.style == "ab"[__import__("random").Random(hashing.seed_number(7, "tiny", "free", 0)).randrange(2)]


def test_published_vectors():
    fp = "807cd068076f0b2bea7eb5d3eccdecac927b3521fa7034e599456bb3553ad36f"
    assert hashing.run_key(fp, 7360) == "f384795e"
    order = hashing.shuffled(1826, 7360, fp, "cycle", 0)
    assert [u for u in order if u < 935][:4] == [560, 440, 765, 635] and [u for u in order if u >= 935][:4] == [1523, 979, 1602, 1356]
    assert [hashing.picture_offset(7360, d, 10) + 1 for d in ("clothing", "indoor_scenes", "outdoor_scenes", "urban_scenes")] == [6, 5, 1, 10]


@pytest.mark.parametrize("exact", [True, False])
def test_prefix_rounds_and_leaves(spark, tiny, exact):
    _, _, units = tiny
    order = plans.cycle_order_exact(spark, 16, 3, 7, "tiny") if exact else plans.cycle_order_sql(units, 3, 7, "tiny")
    make = lambda n: {r.plan_index: (r.unit_index, r.cycle) for r in plans.with_units(plans.indices(spark, n, 16), order, units).collect()}
    long, short = make(40), make(9)
    assert all(long[i] == short[i] for i in range(9)) and len(long) == 40
    assert sorted(long[i][0] for i in range(16)) == list(range(16)) and [long[i][1] for i in (0, 15, 16, 39)] == [0, 0, 1, 2]
    assert plans.rounds(40, 16) == (2, 8, 3)
    smoke = plans.first_of_each(order, units, 4, 4).orderBy("plan_index").collect()
    assert [r.modality for r in smoke] == ["text"] * 4 + ["image"] * 4


def test_digest_and_ids(spark):
    rows = spark.createDataFrame([(0, "a", [("x", "1")], 1), (1, "b", [("x", "2")], 3)], "plan_index long, id string, coordinate array<struct<k:string,v:string>>, n_turns int")
    one = hashing.plan_digest(rows, ["fp", 7])
    assert one == hashing.plan_digest(rows.repartition(2), ["fp", 7]) != hashing.plan_digest(rows, ["fp", 8])
    ids = spark.createDataFrame([(3, 99999), (3, 100000)], "c long, p long")
    assert ids.where("p < 100000").select(hashing.row_id(F.lit("k"), F.col("c"), F.col("p"))).first()[0] == "k-c00003p99999"
    with pytest.raises(Exception, match="five digits"):
        ids.select(hashing.row_id(F.lit("k"), F.col("c"), F.col("p"))).collect()
    assert hashing.fingerprint({"b": 1, "a": "é"}) == hashing.fingerprint({"a": "é", "b": 1})


@pytest.mark.parametrize(
    "change,message",
    [
        ({"axes": None}, "axes: expected dict"), ({"more": 1}, "more: expected nothing"), ({"free": ["language"]}, "restricted or free"),
        ({"pairs": [{"id": "R", "from": "ic", "to": "am", "rules": [["clean", ["direct"]]]}]}, "no rule for"),
        ({"pairs": [{"id": "R", "from": "ic", "to": "am", "rules": [["clean", ["*", "direct"]], ["missing", ["*"]]]}]}, "stands alone"),
        ({"pairs": [{"id": "R", "from": "ic", "to": "am", "rules": [["odd", ["*"]]]}]}, "no value of ic"),
    ],
)
def test_documents_refused(change, message):
    with pytest.raises(spaces.SpaceError, match=message):
        spaces.parse({k: v for k, v in {**TINY, **change}.items() if v is not None})


def test_files_and_last_rule(tmp_path):
    with pytest.raises(spaces.SpaceError, match="no such file"):
        spaces.load(str(tmp_path / "none.json"))
    (tmp_path / "bad.json").write_text("{")
    with pytest.raises(spaces.SpaceError, match="bad JSON at 1:2"):
        spaces.load(str(tmp_path / "bad.json"))
    again = {**TINY, "pairs": [*TINY["pairs"][:4], {"id": "R4b", "from": "ic", "to": "am", "rules": [["clean", ["*"]], ["missing", ["*"]], ["missing", ["ask_first", "ask_first"]]]}]}
    assert dict(spaces.parse(again).pairs[4].rules)["missing"] == ("ask_first",)
    for bad in (0, True, 1.5, -1, "x"):
        with pytest.raises(ValueError):
            plans.require_count(bad)
    for bad in ((0, 0), (1,), (1, 99), [1, 1], (True, 1)):
        with pytest.raises(ValueError):
            plans.require_subset(bad, (5, 5))


@pytest.mark.parametrize("change,said", [({"pairs": [{"from": "a"}]}, "pairs.0.id: expected str (received: nothing)"), ({"pairs": ["x"]}, "pairs.0: expected dict"), ({"modality": {"must": "x"}}, "modality.must"), ({"turns": {"x": 0}}, "turns.x"), ({"restricted": [1]}, "restricted.0: expected str")])
def test_what_is_wrong_inside_is_said(change, said):
    with pytest.raises(spaces.SpaceError) as e:
        spaces.parse({**TINY, **change})
    assert said in str(e.value)
