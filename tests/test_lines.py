"""Lines by ranges of bytes beside plain splitting, and ids read on after every kind of change to a file."""

import io
import os
import shutil

import pytest

from gridloom.operators import bank
from gridloom.sources import lines


def plain(data: bytes) -> list[bytes]:
    out = data.split(b"\n")
    return out if out[-1] else out[:-1]


@pytest.mark.parametrize("data", [b"", b"\n", b"\n\n", b"a", b"a\n", b"a\nbb\n\nccc", b"one long line without an end", "é\nü\n".encode(), b"\nx\n\n\ny\n"])
@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_ranges_hold_each_line_once(data, size):
    got, numbers = [], []
    for start in range(0, len(data), size):
        stop = min(start + size, len(data))
        own = list(lines.lines_in(io.BytesIO(data), start, stop, len(data)))
        assert lines.count_in(io.BytesIO(data), start, stop) == len(own)
        got += own
        numbers.append(len(own))
    assert [t for t, _, _ in got] == plain(data)
    assert all(data[:after].endswith(b"\n") for _, after, whole in got if whole)
    assert sum(not whole for _, _, whole in got) == (not data.endswith(b"\n") and bool(data))


def test_numbers_in_files_and_over_all(spark, tmp_path):
    texts = {"a b.jsonl": "{}\n\nbroken\n", "b.jsonl": "", "c.jsonl": "x\ny", "d/e.jsonl": '{"id": "1"}\n' * 50}
    for name, text in texts.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    for size in (1, 5, 1 << 20):
        rows = lines.numbered(spark, str(tmp_path), size).orderBy("line").collect()
        want = [(name, i, t) for name in sorted(texts) for i, t in enumerate(plain(texts[name].encode()))]
        assert [(r["path"].removeprefix(f"file:{tmp_path}/"), r["number"], r["value"].encode()) for r in rows] == want
        assert [r["line"] for r in rows] == list(range(len(want)))


def record(i) -> str:
    return f'{{"id": "r{i}"}}\n'


def test_ids_read_on(spark, tmp_path):
    own, state = tmp_path / "bank", tmp_path / "state"
    own.mkdir()
    a, b = own / "a.jsonl", own / "b.jsonl"

    def known():
        got = [r["id"] for r in lines.known_ids(spark, str(own), f"file://{state}", 16).collect()]
        assert len(got) == len(set(got))
        return set(got)

    def read_last():
        scan = lines.last_scan(f"file://{state}")
        return spark.read.parquet(f"file://{state}/ids/scan={scan}").count()

    assert known() == set()  # an empty folder
    a.write_text("".join(map(record, range(5))) + '{"id": 7}\n[1]\n\nbroken\n' + record(0))
    assert known() == {f"r{i}" for i in range(5)} and read_last() == 10
    assert known() == {f"r{i}" for i in range(5)} and read_last() == 0  # nothing new
    with a.open("a") as f:  # appended, and a half-written line
        f.write(record(5) + record(6)[:-4])
    assert known() == {f"r{i}" for i in range(6)} and read_last() == 2
    with a.open("a") as f:  # the line's end
        f.write(record(6)[-4:])
    assert known() == {f"r{i}" for i in range(7)} and read_last() == 1
    with a.open("a") as f:  # a whole record without a line's end counts, and counts once when it has gone on
        f.write(record(8)[:-1])
    b.write_text(record(20))
    assert known() == {f"r{i}" for i in (*range(7), 8, 20)} and read_last() == 2
    text = a.read_text()
    a.write_text(text.replace('"r3"', '"q3"'))  # as long as before, other bytes
    assert known() == {f"r{i}" for i in (0, 1, 2, 4, 5, 6, 8, 20)} | {"q3"} and read_last() == 13
    a.write_text(record(1))  # cut short
    assert known() == {"r1", "r20"}
    b.unlink()
    assert known() == {"r1"}
    a.write_text(record(1)[:-1] + " " + record(2))  # longer, and what was read no longer ends on a line's end
    assert known() == set()


def test_killed_scan_is_made_again(spark, tmp_path):
    own, state = tmp_path / "bank", tmp_path / "state"
    own.mkdir()
    (own / "a.jsonl").write_text(record(1))
    folder = f"file://{state}"
    lines.known_ids(spark, str(own), folder)
    with (own / "a.jsonl").open("a") as f:
        f.write(record(2))
    lines.known_ids(spark, str(own), folder)
    os.unlink(state / "files" / "scan=2" / "_SUCCESS")  # killed before the table of files was whole
    with (own / "a.jsonl").open("a") as f:
        f.write(record(3))
    assert lines.last_scan(folder) == 1
    assert {r["id"] for r in lines.ids_of(spark, folder, 1).collect()} == {"r1"}  # ids of the killed scan don't count
    assert {r["id"] for r in lines.known_ids(spark, str(own), folder).collect()} == {"r1", "r2", "r3"}
    shutil.rmtree(own)
    own.mkdir()
    assert lines.known_ids(spark, str(own), folder).count() == 0


def test_lines_glued_by_a_crash_are_damage(spark):
    good = ['{"id": "a"}', '{"id":"a","t":"]} {["}', "{}", ' {"id": "a"}\r', '{"id": 7}']
    bad = ['{"id": "a"} {"id": "b"}', '{"id": "a"}, {"id": "b"}', '{"id": "a"} ] [ {}', '{"id": "a"}} ', '{"id": "a"} x', '{"id": "a"},', '{"id": "a"', "[1]", "7"]
    rows = spark.createDataFrame([(v,) for v in (*good, *bad, "", "  ")] + [(None,)], "value string")
    assert {r["_damaged"] for r in bank.parse_lines(rows, "id string").where("_damaged IS NOT NULL").collect()} == set(bad)
    assert bank.whole(bank.parse_lines(rows, "id string")).count() == len(good)
    assert bank.unique_ids(rows).first().asDict() == {"records": len(good), "unique_ids": 1}
