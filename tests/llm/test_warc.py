"""WARC writer and reader: exact round trip, same bytes each time, rolling, damage."""

import base64
import hashlib
import json
import os

import numpy as np
import pyarrow as pa
import pytest

from gridloom.llm import warc
from gridloom.llm.queries import REGISTRY
from tests.llm.oracle import spark_rows, sql_rows

ROWS = [(5, "http://a/é x", "<p>one</p>", 1), (3, "u", "<p>one</p>", 1), (9, "u", "", 1), (8, None, None, 1), (2, "v", "two é", 1), (None, None, "<p>one</p>", 1), (None, "n", None, 1), (9, "u", "", 1), (7, "", "x" * 200_000, 1), (6, "w", "x" * 200_000, 1), (10**15, "far", "z", 1)]
SCHEMA = "page_id long, url string, html string, size int"


def folder(tmp_path, name):
    return f"file://{tmp_path}/{name}"


def want(rows, least=0):
    out = []
    for k, _, h, _ in rows:
        data = (h or "").encode()
        same = [i for i, _, x, _ in rows if i is not None and (x or "").encode() == data]
        first = min(same) if k is not None and len(data) >= least and min(same) < k else None
        out.append((k, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if first is None else "revisit", first))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, tmp_path, least):
    out = folder(tmp_path, "w")
    made = warc.write(spark.createDataFrame(ROWS, SCHEMA).repartition(3), out, least_revisit=least, shard_bytes=64, file_bytes=600)
    got = warc.read(spark, out)
    assert sorted(map(tuple, got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str) == want(ROWS, least)
    assert sorted(r.payload.decode() for r in got.where("record_type = 'response'").collect()) == sorted((h or "") for (k, _, h, _), w in zip(sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)), sorted(want(ROWS, least), key=lambda r: (r[0] is not None, r[0] or 0))) if w[3] == "response")
    assert made.agg({"records": "sum"}).first()[0] == len(ROWS)
    assert made.count() > 2 and not [f for f in os.listdir(tmp_path / "w") if ".tmp-" in f]


def test_same_rows_same_files(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for name, n in (("a", 1), ("b", 4)):
        warc.write(df.repartition(n), folder(tmp_path, name), shard_bytes=100)
    files = sorted(f for f in os.listdir(tmp_path / "a") if os.path.isfile(tmp_path / "a" / f))
    assert files == sorted(f for f in os.listdir(tmp_path / "b") if os.path.isfile(tmp_path / "b" / f))
    assert all((tmp_path / "a" / f).read_bytes() == (tmp_path / "b" / f).read_bytes() for f in files)
    assert json.loads((tmp_path / "a" / "MANIFEST.json").read_text())["records"] == len(ROWS)


def test_payloads_that_differ_late(spark, tmp_path):
    rows = [(1, "u", "x" * 70_000 + c, 1) for c in "cab"]
    for name, own in (("a", rows), ("b", rows[::-1])):
        warc.write(spark.createDataFrame(own, SCHEMA).coalesce(1), folder(tmp_path, name))
    name = next(f for f in os.listdir(tmp_path / "a") if f.endswith(".gz"))
    assert (tmp_path / "a" / name).read_bytes() == (tmp_path / "b" / name).read_bytes()


def test_damage_and_empty(spark, tmp_path):
    out = folder(tmp_path, "e")
    warc.write(spark.createDataFrame([], SCHEMA), out)
    assert warc.read(spark, out).count() == 0
    out = folder(tmp_path, "d")
    warc.write(spark.createDataFrame(ROWS[:2], SCHEMA), out)
    name = next(f for f in os.listdir(tmp_path / "d") if f.endswith(".gz"))
    with open(tmp_path / "d" / name, "ab") as f:
        f.write(b"x")
    with pytest.raises(Exception, match="not the file of the manifest"):
        warc.read(spark, out).count()


@pytest.mark.parametrize("keys", [range(0, 200_000, 2), [i % 70 * 10**12 + i // 70 for i in range(100_000)], [None] * 100_000, [5] * 100_000])
def test_no_shard_is_overfull(spark, keys):
    """Even keys, many dense clusters, no keys, one key: shards hold the target and less than a row more."""
    n = len(keys)
    rows = spark.createDataFrame(pa.table({"k": pa.array([k if k is not None else -(1 << 63) for k in keys], pa.int64()), "h": pa.array(np.arange(n) * 7919 % 100_003), "u": pa.array(np.zeros(n, np.int64)), "size": pa.array(np.full(n, 10))}))
    cuts = warc.cuts_of(rows.repartition(8), 500)
    found = rows.toArrow()
    slot = warc.shard_of(cuts, *(found.column(c).to_numpy() for c in ("k", "h", "u")))
    sizes = np.bincount(slot) * 10
    assert len(sizes) == 2000 and sizes.max() <= 510 and sizes.min() >= 490


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert spark_rows(REGISTRY.queries["op2_warc"](spark, sf)) == sql_rows(REGISTRY.oracles["op2_warc"])
