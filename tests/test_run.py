"""Whole runs with a client that needs no network: resume, refusal, reruns."""

import json
import os

import pytest

from gridloom import run
from gridloom.operators import bank
from tests.test_space_and_plan import TINY


class Quiet:
    """Answers every call."""

    def chat(self, system, user, picture=None):
        return f"{system} about {len(user)} characters"


class Moody(Quiet):
    """Fails on some prompts."""

    def chat(self, system, user, picture=None):
        if '"fmt":"code"' in user:
            raise TimeoutError
        return super().chat(system, user)


def test_run_resume_and_refusal(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    context = run.build(spark, TINY, 20, 7)
    assert context.size == 16 and context.plan.select("id").distinct().count() == 20
    first = run.execute(spark, context, out, Moody, 2)
    assert 0 < first["missing"] == first["abandoned"]["timeout"] and not os.path.exists(tmp_path / "out" / run.PROGRESS)
    second = run.execute(spark, context, out, Quiet, 2)
    assert second["records"] == 20 and second["missing"] == 0 and sum(second["tallies"]["data_source"].values()) == 20
    own = run.read_bank(spark, out)
    assert own.count() == own.select("id").distinct().count() == 20
    stamp = (tmp_path / "out" / run.MANIFEST).stat().st_mtime_ns
    assert run.execute(spark, context, out, Quiet, 2) == second and (tmp_path / "out" / run.MANIFEST).stat().st_mtime_ns == stamp
    report = json.loads((tmp_path / "out" / "coverage.json").read_text())
    assert report["readout"]["total"] == 20 and all(r["ok"] for r in report["rules"]) and report["readout"]["whole_rounds"] == 1
    with pytest.raises(bank.BankError, match="outside the plan"):
        run.execute(spark, run.build(spark, TINY, 5, 8), out, Quiet, 2)
    longer = run.build(spark, TINY, 24, 7)
    assert run.execute(spark, longer, out, Quiet, 2)["records"] == 24  # a longer plan of the same seed goes on
    again = run.execute(spark, run.build(spark, TINY, 3, 8), out, Quiet, 2, overwrite=True)
    assert again["records"] == 3


def test_pictures_are_placed_once(spark, tmp_path):
    for d in ("a", "b"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "p.jpg").write_bytes(d.encode())
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path)).select("path", "content")
    placed = {r.path[-7]: r.placed for r in run.copy_pictures(files, f"file://{tmp_path}/out").collect()}
    assert placed["a"] == "p.jpg" != placed["b"] and (tmp_path / "out" / "images" / placed["b"]).read_bytes() == b"b"


def folders(tmp_path, domains):
    """A picture folder with two files for each domain."""
    for d in domains:
        (tmp_path / "pics" / d).mkdir(parents=True)
        for n in ("b.jpg", "a.png"):
            (tmp_path / "pics" / d / n).write_bytes(f"{d} {n}".encode())
    return f"file://{tmp_path}/pics"


def test_rows_with_pictures(spark, tmp_path):
    """Image rows name the picture that lies in the output; the next round takes the next file; domains without one use the pool."""
    context = run.build(spark, TINY, 20, 7)
    domains = context.space.axes[context.space.gated]
    root = folders(tmp_path, domains[:1])
    out = f"file://{tmp_path}/out"
    made = run.execute(spark, context, out, Quiet, 2, pictures=run.Pictures.read(spark, root))
    images = context.plan.where("modality = 'image'").count()
    assert made["outcomes"] == {"appended": 20} and made["pictures"]["rows"] == images > 0 and made["pictures"]["candidates"] == 2
    assert made["pictures"]["fallback_domains"] == sorted(domains[1:]) and made["tallies"]["data_source"] == {"multi": images, "text": 20 - images}
    by_round = spark.read.json(f"{out}/{run.ROUNDS}").collect()
    assert {(r.cycle, r.domain) for r in by_round} == {(c, d) for c in range(-(-20 // context.size)) for d in {x[0] for x in context.plan.where("modality = 'image'").select(context.space.gated).collect()}}
    assert sum(r.records for r in by_round) == images and all(r.candidates == 2 and r.served and r.fallback == (r.domain != domains[0]) for r in by_round)
    seen = set()
    for r in run.read_bank(spark, out).collect():
        meta = r.anchor_meta
        user = next(m.content for m in r.messages if m.role == "user")
        assert (meta["has_image"], meta["image_count"]) == (("true", "1") if r.data_source == "multi" else ("false", "0"))
        if r.data_source == "multi":
            parts = json.loads(user)
            assert [p["type"] for p in parts] == ["image", "text"] and parts[0]["image"].startswith(f"images/{meta[context.space.gated]}/")
            seen.add(parts[0]["image"])
    assert seen and all((tmp_path / "out" / p).read_bytes().startswith(domains[0].encode()) for p in seen)
    assert run.execute(spark, context, out, Quiet, 2, pictures=run.Pictures.read(spark, root)) == made


def test_no_picture_at_all(spark, tmp_path):
    context = run.build(spark, TINY, 20, 7)
    (tmp_path / "none").mkdir()
    none = spark.createDataFrame([], "domain string, path string")
    with pytest.raises(run.PictureError, match=r"no picture for \d+ domains:\n  - "):
        run.execute(spark, context, f"file://{tmp_path}/o1", Quiet, 2, pictures=run.Pictures(none, "pics"))
    assert not (tmp_path / "o1").exists()
    with pytest.warns(UserWarning, match="are not in the bank"):
        made = run.execute(spark, context, f"file://{tmp_path}/o2", Quiet, 2, pictures=run.Pictures(none, "pics", skip_missing=True))
    images = context.plan.where("modality = 'image'").count()
    assert made["records"] == 20 - images and made["pictures"]["skipped_rows"] == images


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "space.json").write_text(json.dumps(TINY))
    (tmp_path / "c.toml").write_text(f'[plan]\nspace = "{tmp_path}/space.json"\ncount = 4\nseed = 7\n[output]\ndirectory = "file://{tmp_path}/made/"\n')
    (tmp_path / "config.override.toml").write_text("[plan]\ncount = 16\n")
    run.main(["--config", str(tmp_path / "c.toml")])
    assert "| total | 16 |" in capsys.readouterr().out and "count = 16" in (tmp_path / "made" / "config.toml").read_text()
    (tmp_path / "other.toml").write_text("[plan]\ncount = 20\n")
    run.main(["--config", str(tmp_path / "c.toml"), "--override", str(tmp_path / "other.toml"), "--smoke"])
    assert "| total | 8 |" in capsys.readouterr().out and (tmp_path / "made_smoke" / "coverage.json").exists()
    with pytest.raises(FileNotFoundError):
        run.main(["--config", str(tmp_path / "c.toml"), "--override", "nowhere.toml"])
    (tmp_path / ".git").mkdir()
    (tmp_path / ".local").mkdir()
    (tmp_path / ".local" / "config.override.toml").write_text("")
    assert run.override_of(tmp_path / "c.toml", None).parent.name == ".local"


def test_pictures_that_no_record_names_are_deleted(spark, tmp_path):
    out = f"file://{tmp_path}/o"
    (tmp_path / "o" / "images" / "d").mkdir(parents=True)
    for n in ("a.jpg", "b.jpg", "c.jpg"):
        (tmp_path / "o" / "images" / "d" / n).write_bytes(b"x")
    line = {"id": "i", "data_source": "multi", "messages": [{"role": "user", "content": '[{"type":"image","image":"images/d/a.jpg"},{"type":"text","text":"t"}]'}], "anchor_meta": {}}
    (tmp_path / "o" / "bank").mkdir()
    (tmp_path / "o" / "bank" / "part.txt").write_text(json.dumps(line) + "\n")
    placed = spark.createDataFrame([("images/d/a.jpg",), ("images/d/b.jpg",), ("images/d/gone.jpg",)], "path string")
    assert run.prune(spark, out, placed) == 1
    assert sorted(os.listdir(tmp_path / "o" / "images" / "d")) == ["a.jpg", "c.jpg"]
