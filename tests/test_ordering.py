"""Global numbers: each once, in order, however Spark lays the ranges out."""

import pytest
from pyspark.sql import functions as F

from gridloom.operators import images, ordering

N = 1_000_000


@pytest.fixture(params=["default", "low"])
def sizes(spark, request):
    """Default sizes, and a low advisory size under which ranges are put together unevenly."""
    names = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    if request.param == "low":
        for k, v in names.items():
            spark.conf.set(k, v)
    yield request.param
    for k in names:
        spark.conf.unset(k)


def wide(spark, n):
    """Rows whose order and content have nothing to do with each other, one first part being a third of all."""
    key = F.xxhash64("id")
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.hex(key)).alias("name"), F.hex(F.xxhash64(key)).alias("tie"), F.sha2(F.col("id").cast("string"), 256).alias("load"), (F.col("id") % 7).alias("m"))


def test_every_number_once(spark, sizes):
    got = ordering.running(wide(spark, N), ["name", "tie"])
    r = got.agg(F.count("*").alias("n"), F.count_distinct("before").alias("d"), F.min("before").alias("lo"), F.max("before").alias("hi"), F.max("total").alias("t")).first()
    assert tuple(r) == (N, N, 0, N - 1, N)


def test_numbers_follow_the_order(spark, sizes):
    rows = ordering.running(wide(spark, 30_000), ["name", "tie"]).collect()
    assert [r.before for r in sorted(rows, key=lambda r: (r.name, r.tie))] == list(range(30_000))
    sums = sorted(ordering.running(wide(spark, 30_000), ["name", "tie"], "m").collect(), key=lambda r: (r.name, r.tie))
    at = 0
    for r in sums:
        assert r.before == at
        at += r.m
    assert {r.total for r in sums} == {at}


def test_pool_and_numbered(spark, sizes):
    files = spark.range(400_000).select(F.format_string("d%d/%s.jpg", F.col("id") % 9, F.hex(F.xxhash64("id"))).alias("path"))
    r = images.pool(files).agg(F.count("*"), F.count_distinct("slot"), F.max("slot"), F.max("n")).first()
    assert tuple(r) == (400_000, 400_000, 399_999, 400_000)
    r = images.numbered(files.withColumn("name", F.col("path")), None, "name", "path").agg(F.count("*"), F.count_distinct("slot"), F.max("slot")).first()
    assert tuple(r) == (400_000, 400_000, 399_999)


def test_numbers_within_groups(spark, sizes):
    rows = wide(spark, 20_000).withColumn("name", F.when(F.col("m") == 3, None).otherwise(F.col("name")))
    got = {}
    for r in images.numbered(rows, "name", "tie", "load").collect():
        got.setdefault(r.name, []).append((r.tie, r.slot, r.n))
    assert len(got[None]) > 2000 and len(got["hot"]) > 2000
    for own in got.values():
        assert [(s, n) for _, s, n in sorted(own)] == [(i, len(own)) for i in range(len(own))]


def test_nothing(spark):
    assert ordering.running(wide(spark, 5).limit(0), ["name"]).count() == 0
    assert [(r.before, r.total) for r in ordering.running(wide(spark, 1), ["name"], "m").collect()] == [(0, 0)]
