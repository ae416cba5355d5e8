"""The pipeline stage by stage against plain versions, on the driver's smallest tables and odd rows."""

import re

from pyspark.sql import functions as F

import corpus_pipeline as cp
from gridloom.llm import mixing
from tests.llm.test_mixing_and_decontaminate import plain_pairs
from tests.llm.test_repeats import brute
from tests.llm.test_similar import plain_removed

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_equal_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = cp.quality_filter(spark, docs, SF).cache()
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r.doc_id for r in kept.collect()}
    good = [i for i, own in labels.items() if own == (1, 0)]
    assert sum(i in left for i in good) >= 0.95 * len(good) and docs.count() > kept.count()

    near = cp.near_dedup(spark, kept, SF).cache()
    own = rows_of(kept)
    gone = plain_removed(own)
    assert gone and rows_of(near) == [(i, t) for i, t in own if i not in gone]

    cut = cp.repeated_bytes(spark, near, SF).cache()
    want = [(i, (k.decode() if not g else k.decode("utf-8", "ignore"))) for i, n, g, _, k in brute(rows_of(near), "bytes", 50) if n == 0 or g < n]
    got = rows_of(cut)
    assert [i for i, _ in got] == [i for i, _ in sorted(want, key=str)]
    strip = lambda t: re.sub("[^\x00-\x7f]", "", t)  # noqa: E731  a character cut in two goes whole
    assert [strip(t) for _, t in got] == [strip(t) for _, t in sorted(want, key=str)]
    assert all(r.n_chars == len(r.text) for r in cut.collect()) and cut.dtypes == docs.dtypes

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = cp.without_benchmark(spark, cut, SF).cache()
    hit = {i for i, *_ in plain_pairs(got, items)}
    assert hit and rows_of(clean) == [(i, t) for i, t in got if i not in hit]

    mixed = cp.mixture(spark, clean, SF)
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.id for r in mixing.mix(clean).where("kept").collect())
    assert sorted(r.doc_id for r in cp.run(spark, SF).collect()) == sorted(r.doc_id for r in mixed.collect())


def test_odd_rows_and_empty_table(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    long = "some words that stay the same in all of these rows, which are long enough " * 3
    rows = [(1, long, "en", "s", 9), (1, long, "en", "s", 9), (None, long + "x", None, None, None), (None, None, None, None, None), (3, "", "en", "s", 0), (4, None, "en", None, None), (5, "été " * 30, "fr", "s", 1), (6, "ete " * 30 + "été " * 30, "fr", "s", 1)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), schema)
    assert 1 in {r.doc_id for r in cp.near_dedup(spark, spark.createDataFrame(rows, schema), SF).collect()}
    assert sum(r.doc_id == 1 for r in cp.near_dedup(spark, spark.createDataFrame(rows, schema), SF).collect()) == 1
    for _, stage in cp.STAGES:
        assert stage(spark, spark.createDataFrame([], schema), SF).count() == 0


NAMES = ["key", "tag", "row", "null", "text_", "hit", "gone0", "gone1", "twice_key", "twice_tag", "source_", "topic", "tokens", "draw", "empty", "p", "id", "kept", "carried_0", "sig", "lang_"]


def test_other_columns_come_through_whatever_their_names_and_types(spark):
    """Every stage keeps columns named like its own, and values of all types to the last digit."""
    base = spark.read.parquet(f"{SF}/documents.parquet").limit(12)
    for name in NAMES:
        base = base.withColumn(name, F.concat(F.lit(f"{name} "), F.col("doc_id")))
    kinds = {"a time": "timestamp'2024-01-01 01:02:03.123456'", "decimal": "cast('12345678901234567890.123456789' as decimal(38,9))", "m.ap": "map(doc_id, array(1, null))", "bytes": "cast(text as binary)", "nan": "double('NaN')", "day": "date'0099-12-31'", "struct": "struct(1 as `a b`, null as c)"}
    docs = base.withColumns({k: F.expr(v) for k, v in kinds.items()})
    want = {r.doc_id: r for r in docs.drop("text", "n_chars").collect()}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name
        got = out.drop("text", "n_chars").collect()
        assert got and all(str(r) == str(want[r.doc_id]) for r in got), name


def test_rows_with_one_id_are_judged_by_their_own_texts(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    other = " ".join(f"other{i}" for i in range(80))
    rows = [(1, " ".join(f"w{i}" for i in range(80)), "en", "src1", 1), (2, "first of two " * 3 + "a", "en", "src1", 1), (2, other, "en", "src1", 1), (2, other, "fr", "src2", 1), (3, item, "en", "src1", 1), (3, "a clean text", "en", "src1", 1)]
    docs = spark.createDataFrame(rows, schema)
    near = [(r.doc_id, r.text) for r in cp.near_dedup(spark, docs, SF).collect()]
    assert sorted(near) == sorted({(r[0], r[1]) for r in rows})
    assert sorted((r.doc_id, r.text) for r in cp.without_benchmark(spark, docs, SF).collect()) == sorted((r[0], r[1]) for r in rows if r[1] != item)
