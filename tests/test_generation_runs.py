"""Shared cooldowns, a run from the command line against a server on this machine, and digests that do not depend on files or partitions."""

import hashlib
import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from gridloom import run
from gridloom.functions import hashing
from gridloom.operators import attempts, bank
from gridloom.sources.config import ConfigError
from gridloom.streaming import generate, rounds
from tests.test_run import Quiet
from tests.test_space_and_plan import TINY


def outcomes(spark, reasons):
    return spark.createDataFrame([(f"r{i:03}", float(i), r) for i, r in enumerate(reasons)], "id string, ended double, reason string").repartition(5)


def test_cooldowns_equal_a_count_in_order(spark):
    """The same as one counter that sees all outcomes in order, whatever the rounds are."""
    pattern = ["timeout", "timeout", None, "empty_content", "timeout", "transport_error", "timeout", "unexpected_error", "timeout", None, "timeout", "timeout", "timeout", "timeout"]
    slept, plain = [], []
    one = generate.Pressure(3, 5.0, plain.append)
    for r in pattern:
        one.after(r)
    shared = rounds.Cooling(3, 5.0, slept.append)
    for turn, part in enumerate((pattern[:6], pattern[6:7], pattern[7:])):
        shared(turn, outcomes(spark, part))
    assert (shared.cooldowns, shared.streak) == (len(plain), one.streak) == (2, 1) and sum(slept) == sum(plain)
    none = attempts.endpoint_streak(outcomes(spark, ["timeout"]).limit(0), ["ended", "id"], F.col("reason").isNull(), F.lit(False), 3, 2).first()
    assert (none.cooldowns, none.streak) == (0, 2)
    off = rounds.Cooling(0, 5.0, slept.append)
    off(0, outcomes(spark, ["timeout"] * 9))
    assert off.cooldowns == 0


@pytest.fixture
def server():
    """Answers every chat with how many parts its last message had."""
    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            said = body["messages"][-1]["content"]
            seen.append((self.headers.get("Authorization"), said))
            self.send_response(200)
            self.end_headers()
            text = f"{'picture' if isinstance(said, list) else 'text'} seen by the model"
            self.wfile.write(f"data: {json.dumps({'choices': [{'delta': {'content': text}, 'finish_reason': 'stop'}]})}\n\ndata: [DONE]\n\n".encode())

        def log_message(self, *a):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}/v1", seen
    s.shutdown()


def test_command_line_generates(spark, tmp_path, capsys, server):
    base, seen = server
    (tmp_path / "pics" / "any").mkdir(parents=True)
    (tmp_path / "pics" / "any" / "a.png").write_bytes(b"pixels")
    (tmp_path / "space.json").write_text(json.dumps(TINY))
    (tmp_path / "c.toml").write_text(
        f'[plan]\nspace = "{tmp_path}/space.json"\ncount = 20\nseed = 7\n[output]\ndirectory = "{tmp_path}/made"\n[images]\ndirectory = "file://{tmp_path}/pics"\n'
        f'[endpoint]\nbase = "{base}"\nmodel = "m"\napi_key = "open sesame"\ntoken_timeout = 5.0\n[run]\nconcurrency = 2\nin_flight = 3\n'
    )
    run.main(["--config", str(tmp_path / "c.toml"), "--smoke", "--generate"])
    made = json.loads((tmp_path / "made_smoke" / run.MANIFEST).read_text())
    assert made["records"] == 8 and made["smoke"] and made["missing"] == 0 and '"records": 8' in capsys.readouterr().out
    text = (tmp_path / "made_smoke" / "config.toml").read_text()
    assert "open sesame" not in text and "token_timeout = 5.0" in text and {a for a, _ in seen} == {"Bearer open sesame"}
    shown = [s for _, s in seen if isinstance(s, list)]
    assert bool(shown) == (made["pictures"]["rows"] > 0) and all(s[0]["image_url"]["url"] == "data:image/png;base64,cGl4ZWxz" for s in shown)
    (tmp_path / "bare.toml").write_text(f'[plan]\nspace = "{tmp_path}/space.json"\ncount = 4\n')
    with pytest.raises(ConfigError, match="lacks base, model"):
        run.main(["--config", str(tmp_path / "bare.toml"), "--generate"])


def test_a_changed_byte_ends_the_shortcut(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    context = run.build(spark, TINY, 4, 7)
    first = run.execute(spark, context, out, Quiet, 2)
    assert first["bank"]["records"] == 4 and set(first["tallies"]) == {"domain", "language", "capability", "system_prompt_mode", "data_source"}
    part = next(p for p in (tmp_path / "out" / run.BANK).glob("part-*") if p.stat().st_size)
    part.write_bytes(part.read_bytes().replace(b"characters", b"charactors", 1))
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    again = run.execute(spark, context, out, Quiet, 2)
    assert again["records"] == 4 and again["bank"]["digest"] != first["bank"]["digest"]


def test_bank_contents_in_any_order(spark):
    lines = spark.range(500).select((F.col("id") % 400).cast("string").alias("value"))
    a = bank.contents(lines).first()
    assert a == bank.contents(lines.orderBy(F.desc("value")).repartition(7)).first() and a["records"] == 500
    assert a["digest"] != bank.contents(lines.distinct()).first()["digest"]
    sums = [sum(int(hashlib.sha256(str(i % 400).encode()).hexdigest()[15 * k : 15 * k + 15], 16) for i in range(500)) for k in range(4)]
    assert a["digest"] == ":".join([bank.DIGEST, *map(str, sums)])
    assert bank.contents(lines.limit(0)).first()["digest"] == f"{bank.DIGEST}:0:0:0:0"


def test_tree_digest_by_plain_hashing(spark):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for n in (0, 1, 1024, 2500):
        level = [sha(f"row {i}") for i in range(n)]
        for _ in range(hashing.LEVELS):
            level = [sha("".join(level[i : i + 1024])) for i in range(0, len(level), 1024)]
        want = sha(f"{hashing.TREE}\nseed\n{n}\n{''.join(level)}")
        rows = spark.range(n).select("id", F.concat(F.lit("row "), F.col("id").cast("string")).alias("c"))
        for parts in (1, 6):
            got = hashing.tree_digest(rows.repartition(parts), "id", F.col("c"), "seed").first()
            assert (got.n, got.digest) == (n, want)
