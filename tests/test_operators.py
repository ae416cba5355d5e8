"""Gates, banks, pictures, attempts, wording, configuration and generation on small rows."""

import json

import pytest
from pyspark.sql import functions as F

from gridloom.functions import wording
from gridloom.operators import attempts, bank, images, readout, records
from gridloom.queries.banks import Echo
from gridloom.sources import config
from gridloom.streaming import generate

NAMES = {"u": "user", "a": "assistant", "s": "system", "x": "robot"}
GOOD = ("u", "uau", "uauau", "su", "suau", "suauau")
BAD = {"uaua": "ends on assistant", "uauu": "user at 3 in place of assistant", "": "empty", "a": "assistant at 0 in place of system or user", "us": "system at 1 in place of assistant", "uasu": "system at 2 in place of user", "ssu": "system at 1 in place of user", "s": "ends on system", "sa": "assistant at 1 in place of user", "suu": "user at 2 in place of assistant", "ux": "robot at 1 in place of assistant", "x": "robot at 0 in place of system or user"}


def test_shapes(spark):
    df = spark.createDataFrame([(c, [NAMES[x] for x in c]) for c in (*GOOD, *BAD)], "c string, roles array<string>")
    for r in df.select("c", records.shape_ok(records.shape_code(F.col("roles"))).alias("ok"), records.shape_reason(F.col("roles")).alias("why")).collect():
        assert r.ok == (r.c in GOOD) == (r.why is None)
        assert r.c in GOOD or BAD[r.c] == r.why


def test_append_order_and_rewrite(spark, tmp_path):
    rows = [("a", 1, True, True, True), ("a", 2, True, True, True), ("b", 3, False, False, True), ("c", 4, True, False, False), ("d", 5, True, True, False), ("e", 6, True, True, True), ("f", 7, False, True, True), ("f", 8, True, True, True)]
    df = spark.createDataFrame(rows, "id string, n int, shape_ok boolean, source_ok boolean, images_ok boolean")
    got = {r.n: r.outcome for r in bank.append_outcomes(df, spark.createDataFrame([("e",)], "id string"), ["n"]).collect()}
    assert got == {1: records.APPENDED, 2: records.DUPLICATE, 3: records.BAD_SHAPE, 4: records.BAD_SOURCE, 5: records.BAD_IMAGES, 6: records.DUPLICATE, 7: records.BAD_SHAPE, 8: records.APPENDED}
    with pytest.raises(bank.BankError, match="4 records refused.*b .*c .*d .*f "):
        bank.rewrite(df.withColumn("line", F.lit("x")), str(tmp_path / "b"), "line", ["n"])
    good = df.where("shape_ok AND source_ok AND images_ok").withColumn("line", F.format_string('{"id":"%s","n":%d}', "id", "n"))
    assert bank.rewrite(good, str(tmp_path / "b"), "line", ["n"]) == 1
    back = bank.read_lines(spark, str(tmp_path / "b"), "id string, n int")
    assert sorted((r.id, r.n) for r in bank.whole(back).collect()) == [("a", 1), ("e", 6), ("f", 8)]


def test_damaged_lines_and_resume(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id":"a","lang":"en"}\n\n{"id":"b","messages":[{"role"{"id":"c"}\n7\n{"id":"d","lang":null}\n')
    found = bank.read_lines(spark, str(tmp_path / "x.jsonl"), "id string, lang string").collect()
    assert [r.id for r in found if r[bank.DAMAGED] is None] == ["a", "d"] and len(found) == 4
    plan = spark.createDataFrame([("a", "en"), ("d", "de"), ("z", "fr")], "id string, lang string")
    own = spark.createDataFrame([("a", "en"), ("d", None), ("q", "es")], "id string, lang string")
    assert [r.id for r in bank.missing(plan, own).collect()] == ["z"] and [r.id for r in bank.foreign(plan, own).collect()] == ["q"]
    assert [r.id for r in bank.mismatched(plan, own, ["lang"]).collect()] == ["d"]
    with pytest.raises(bank.BankError, match="1 records outside the plan, first q; 1 records with another coordinate, first d"):
        bank.guard(plan, own, ["lang"])
    bank.guard(plan, own.where("id = 'a'"), ["lang"])


def test_record_json_and_parts(spark):
    row = spark.createDataFrame([("i", [("system", [("text", "s", None)]), ("user", [("image_url", None, "data:x"), ("text", "q", None)])], ["/r/images/d/p.png"], "answer", "  ")], "id string, messages array<struct<role:string,content:array<struct<type:string,text:string,image:string>>>>, images array<string>, answer string, reasoning string")
    new = records.rewrite_parts(F.col("messages"), F.col("images"))
    meta = F.create_map(F.lit("language"), F.lit("en"), F.lit("visual_domain"), F.lit(None).cast("string"))
    line = json.loads(row.select(records.record_json(F.col("id"), F.lit("multi"), new, F.col("answer"), F.col("reasoning"), meta, F.lit("m"), F.lit("t"))).first()[0])
    assert line["anchor_meta"] == {"language": "en"} and line["targets"][0]["output"] == {"content": "answer", "reasoning": None}
    assert line["messages"][1]["content"][0] == {"type": "image", "text": None, "image": "images/d/p.png"} and len(line["messages"]) == 2
    types = spark.createDataFrame([(["text"],), (["text", "image"],)], "t array<string>")
    assert [r[0] for r in types.select(records.data_source(F.col("t"))).collect()] == ["text", "multi"]


def test_pictures(spark, tmp_path):
    for name in ("b.PNG", "a.jpg", "notes.txt", "raw.nef"):
        (tmp_path / name).write_bytes(b"x" * 90)
    found = images.listing(spark, str(tmp_path))
    assert sorted(r.path.rpartition("/")[2] for r in found.collect()) == ["a.jpg", "b.PNG", "raw.nef"]
    uri = spark.read.format("binaryFile").load(str(tmp_path / "a.jpg")).select(images.data_uri(F.col("path"), F.col("content"))).first()[0]
    assert uri.startswith("data:image/jpeg;base64,") and "\n" not in uri and "\r" not in uri
    files = spark.createDataFrame([("v", f"p{i}") for i in range(5)], "domain string, picture string")
    own = images.numbered(files, "domain", "picture", "picture")
    pool = images.numbered(files.select("picture"), None, "picture", "picture")
    domains = spark.createDataFrame([("v",), ("plants",)], "domain string")
    got = {(r.domain, r.cycle): (r.picture, r.fallback) for r in images.picks(domains, own, pool, 6, F.lit(2)).collect()}
    assert [got["v", c][0] for c in range(6)] == ["p2", "p3", "p4", "p0", "p1", "p2"] and got["plants", 0] == ("p2", True) and not got["v", 0][1]
    none = images.picks(domains, own.limit(0), pool.limit(0), 1, F.lit(2)).collect()
    assert [(r.picture, r.fallback) for r in none] == [(None, False)] * 2
    turns = spark.createDataFrame([("long", 3, 0, "user"), ("long", 3, 1, "assistant"), ("long", 3, 2, "user"), ("x", 1, 0, "user"), ("y", 1, 0, "user")], "spec string, n_turns int, turn int, role string")
    two = images.numbered(files.limit(2).select("picture"), None, "picture", "picture")
    assert sorted((r.spec, r.turn, r.picture) for r in images.allocate(turns, two, 1).collect()) == [("long", 0, "p0"), ("x", 0, "p0"), ("y", 0, "p1")]


def test_streaks(spark):
    def run(codes, threshold):
        df = spark.createDataFrame([("k", i, c) for i, c in enumerate(codes)], "k string, i int, c string")
        r = attempts.streaks(df, "k", ["i"], F.col("c") == "+", F.col("c").isin("t", "c"), threshold).first()
        return r.cooldowns, r.streak

    assert run("ttt", 3) == (1, 0) and run("cc", 2) == (1, 0) and run("tttttt", 3) == (2, 0)
    assert run("+ee", 2) == (0, 0) and run("eee", 1) == (0, 0) and run("tt+t", 3) == (0, 1) and run("ttet", 3) == (1, 0)


def test_streamed_answers(spark):
    d = lambda **k: "data: " + json.dumps({"choices": [{"delta": k.get("delta", {}), "finish_reason": k.get("finish")}]})
    lines = [("a", [d(delta={"reasoning": "think "}), d(delta={"reasoning_content": "more"}), d(delta={"content": "Six "}), ": ping", "data: {bad", d(delta={"content": "times"}, finish="stop"), "data: [DONE]", d(delta={"content": "late"})]), ("b", [d(delta={"reasoning": "only"}, finish="length")]), ("c", [d(finish="other")])]
    df = spark.createDataFrame([(k, i, x) for k, xs in lines for i, x in enumerate(xs)], "k string, i int, line string")
    got = attempts.assembled(df, "k", "i", "line").withColumn("v", attempts.verdict(F.col("content"), F.col("finish")))
    assert {r.k: (r.content, r.reasoning, r.finish, r.v) for r in got.collect()} == {"a": ("Six times", "think more", "stop", "ok"), "b": ("", "only", "length", "empty"), "c": ("", "", "other", "empty")}
    assert attempts.reasoning_stats(got).first().asDict() == {"responses": 3, "reasoning_responses": 2, "reasoning_chars": 14, "reasoning_only": 1, "empty": 2, "truncated_empty": 1}


def test_wording(spark):
    with pytest.raises(wording.WordingError, match="unknown fields"):
        wording.validated_template("{name}", "t")
    for bad in ("", "{", "  "):
        with pytest.raises(wording.WordingError):
            wording.validated_template(bad, "t")
    for bad in ("none", "../x", "", "a.b"):
        with pytest.raises(wording.WordingError):
            wording.mode_file(bad)
    df = spark.createDataFrame([("日本語", "{capability}"), (None, None)], "l string, k string")
    text = wording.rendered(wording.validated_template(" {language} {{x}} {domain} {capability} ", "t"), {"language": F.col("l"), "knowledge_domain": F.col("k")})
    assert [r[0] for r in df.select(text).collect()] == ["日本語 {x} {capability} qa", "English {x} general qa"]
    own = wording.validated_sentences({"values": {"a": " A. ", "b": "B."}}, "difficulty", ["a", "b"])
    clause = wording.requirement({"difficulty": own}, {"difficulty": F.col("v")})
    values = spark.createDataFrame([("a",), (None,)], "v string")
    assert [r[0] for r in values.select(clause).collect()] == ["Requirements: A.", ""]
    with pytest.raises(Exception, match="no sentence for c"):
        spark.createDataFrame([("c",)], "v string").select(clause).collect()
    for bad in ([], {"values": {}}, {"values": {"a": "A."}}, {"values": {"a": "A.", "b": " "}}):
        with pytest.raises(wording.WordingError):
            wording.validated_sentences(bad, "difficulty", ["a", "b"])


def test_configuration(tmp_path):
    schema = {"run": {"count": int, "seed": int, "thinking": bool}, "llm": {"api_key": str, "first_token_timeout": int}}
    (tmp_path / "a.toml").write_text('[run]\ncount = 5\n[llm]\napi_key = "k"\nfirst_token_timeout = 3\n')
    (tmp_path / "b.toml").write_text('[run]\nseed = 9\n[llm]\napi_key = ""\n')
    got = config.load(str(tmp_path / "a.toml"), schema, str(tmp_path / "b.toml"))
    assert got == {"run": {"count": 5, "seed": 9, "thinking": None}, "llm": {"api_key": None, "first_token_timeout": 3}}
    for text in ("[run]\nmore = 1\n", "[run]\ncount = true\n", '[run]\nthinking = "yes"\n'):
        (tmp_path / "c.toml").write_text(text)
        with pytest.raises(config.ConfigError):
            config.load(str(tmp_path / "c.toml"), schema)
    import tomllib

    assert tomllib.loads(config.snapshot({"llm": {"api_key": "k", "base": None, "n": 1, "on": True}})) == {"llm": {"api_key": config.REDACTED, "base": "", "n": 1, "on": True}}
    assert config.redacted({"tokens": [1], "list": [{"hf_token": "x", "password": ""}]}) == {"tokens": [1], "list": [{"hf_token": config.REDACTED, "password": ""}]}
    assert config.seed_of(3) == 3 and 0 <= config.seed_of(None) < 2**32


def test_readout(spark):
    rows = [("text", "k1", "c1", None), ("text", "k1", "c9", None), ("image", "k1", "c2", "v1"), ("text", "k1", "c1", None), ("video", "k1", "c1", None)]
    df = spark.createDataFrame(rows, "modality string, k string, c string, v string")
    r = readout.structure(df, 16, ["c"], ["k", "c"], "k", ["modality", "k", "c", "v"], "v").first()
    assert (r.total, r.text_entries, r.image_entries, r.text_blocks, r.image_blocks, r.leaves, r.visual_leaves, r.distinct_coordinates) == (5, 3, 1, 2, 1, 1, 1, 4)
    assert (r.coverage, r.density, r.whole_rounds, r.last_round) == (4 / 16, 5 / 16, 0, 5)
    found = readout.checks(df.agg(F.count(F.lit(1)).alias("n")), [("a", F.col("n"), F.lit(4), ">="), ("b", F.col("n"), F.lit(4), "=="), ("c", F.col("n"), F.lit(None), "==")])
    assert readout.mismatch(found).first().asDict() == {"within_rule": False, "message": "b 5, expected == 4"}
    assert "MISMATCH" in readout.markdown(r.asDict(), [x.asDict() for x in found.collect()])


def test_generation_and_streaming_append(spark, tmp_path):
    specs = spark.createDataFrame([(str(i), 2 * (i % 3) + 1, "s" if i % 2 else None, "x" * i) for i in range(60)], "id string, n_turns int, system string, ask string")
    got = {r.id: r for r in generate.generate(specs, Echo, 3).collect()}
    for i in range(60):
        try:
            want = generate.one(Echo(), 2 * (i % 3) + 1, "s" if i % 2 else None, "x" * i)
            assert (got[str(i)].roles, got[str(i)].contents, got[str(i)].answer) == want and got[str(i)].reason is None
        except Exception as e:  # noqa: BLE001
            assert got[str(i)].reason == generate.reason_of(e)
    assert {"timeout", "transport_error", "empty_content"} <= {r.reason for r in got.values()}
    (tmp_path / "in").mkdir()
    lines = lambda ids: "\n".join(json.dumps({"id": i, "line": f"l{i}"}) for i in ids)
    for k, ids in enumerate((["a", "b", "a"], ["b", "c"])):
        (tmp_path / "in" / f"{k}.json").write_text(lines(ids))
        stream = spark.readStream.schema("id string, line string").json(str(tmp_path / "in"))
        generate.append_stream(stream, str(tmp_path / "bank"), str(tmp_path / "ck")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "bank")).collect()) == ["a", "b", "c"]


class Flaky:
    """Fails as its script says: t and c speak of the server, e of the model, . is an answer."""

    def __init__(self, script):
        self.script = iter(script)

    def chat(self, system, user):
        kind = next(self.script)
        if kind in "tc":
            raise TimeoutError if kind == "t" else ConnectionError
        return "" if kind == "e" else "an answer of some length"


def test_cooldown_after_a_streak():
    pd = pytest.importorskip("pandas")
    for script, waits in (("ttt..", 1), ("tt..tt", 0), ("tetct", 1), ("tcttct", 2)):
        slept = []
        rows = pd.DataFrame([(str(i), 1, None, "ask") for i in range(len(script) - script.count(".") // 2)], columns=["id", "n_turns", "system", "ask"])
        out = list(generate.rows(iter([rows]), Flaky(script), generate.Pressure(3, 9.0, slept.append)))[0]
        assert len(out) == len(rows) and slept == [9.0] * waits, script


def test_ids_are_read_on(spark, tmp_path):
    (tmp_path / "bank").mkdir()
    (tmp_path / "bank" / "a.txt").write_text('{"id":"x"}\n\n{"id":"y"\n{"id":"x"}\n')
    known = lambda: sorted(r.id for r in generate.known_ids(spark, f"{tmp_path}/bank", f"{tmp_path}/ids", f"{tmp_path}/ck").collect())
    assert known() == ["x"]
    before = len(list((tmp_path / "ids").glob("*.parquet")))
    (tmp_path / "bank" / "b.txt").write_text('{"id":"z"}\n{"other":1}')
    assert known() == ["x", "z"] == known() and len(list((tmp_path / "ids").glob("*.parquet"))) > before


def test_sentences_from_files(spark, tmp_path):
    axes = {"difficulty": ["low", "high"], "response_style": ["plain"], "language": ["English"]}
    (tmp_path / "difficulty.json").write_text(json.dumps({"values": {"low": "Keep it easy.", "high": " Keep it hard. "}}))
    assert wording.read_sentences(spark, str(tmp_path), axes) == {"difficulty": {"low": "Keep it easy.", "high": "Keep it hard."}}
    (tmp_path / "language.json").write_text("{}")
    with pytest.raises(wording.WordingError, match="takes instructions"):
        wording.read_sentences(spark, str(tmp_path), axes)


def test_layers_of_configuration():
    assert config.merged({"a": {"b": 1, "c": {"d": 2}}, "x": 1}, {"a": {"c": {"e": 3}, "b": 4}, "y": {}}) == {"a": {"b": 4, "c": {"d": 2, "e": 3}}, "x": 1, "y": {}}
    assert config.merged({"a": {"b": 1}}, {"a": 5}) == {"a": 5} and config.merged({"a": 5}, {"a": {"b": 1}}) == {"a": {"b": 1}} == config.merged({"a": {"b": 1}}, {"a": {}})
    assert config.unset({"a": "", "b": {"c": "", "d": ["", "x"]}, "f": 0, "g": False}) == {"a": None, "b": {"c": None, "d": [None, "x"]}, "f": 0, "g": False}
