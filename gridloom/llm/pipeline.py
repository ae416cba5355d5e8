"""From raw documents to a training mixture: five stages, each a training-data operator.

Every stage works on all that the one before kept, and its decisions take
effect. All but the last return the columns of `documents`, and every other
column that the rows came with, whatever its name and type. A row is told from
others by its id and all its other columns: rows with one id but different
texts are each judged by their own. Rows without an id are known by their text.
An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import decontaminate, mixing, quality, similar, suffix_dedup
from gridloom.llm.common import checkpointed, columns, fresh, small
from gridloom.session import table

#: Bits within which fingerprints of five-word shingles are compared before all others; what counts is a similarity of 0.8.
NEAR_BITS = 6


def _keyed(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """docs with two more columns, and their names: the id, or for rows without one a hash of the text, above usual ids; and a hash of the other columns."""
    key, tag = fresh(docs, "key", "tag")
    body = F.coalesce(F.col("text"), F.lit(""))
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(1 << 62) + F.abs(F.xxhash64(body) % (1 << 60)))
    others = [c for name, c in zip(docs.columns, columns(docs), strict=True) if name not in ("doc_id", "text")]
    return docs.withColumns({key: number, tag: F.xxhash64("text", F.to_json(F.struct(*others)) if others else F.lit(0))}), key, tag


def _without(rows: DataFrame, gone: DataFrame, *names: str) -> DataFrame:
    """Rows that gone (with as many columns) does not name."""
    marks = fresh(rows, *(f"gone{k}" for k in range(len(names))))
    gone = small(gone.toDF(*marks).distinct())
    same = [F.col(a) == F.col(b) for a, b in zip(names, marks, strict=True)]
    return rows.join(gone, same, "left_anti")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose perplexity under the trusted text of their language is too high or too low. Empty texts stay."""
    rows, key, tag = _keyed(docs)
    (row,) = fresh(rows, "row")
    rows = rows.withColumn(row, F.xxhash64(key, tag))
    trusted = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select(F.col("doc_id").alias(key))
    judged = quality.classify(rows, trusted, key=key, row=row)
    return _without(rows, judged.where("NOT keep").select("id"), row).select(*columns(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that share 0.8 of their five-word shingles the one with the smallest id stays.

    Of rows with the same smallest id, but different texts or other columns, the
    one with the smallest hash stays; of rows alike in every column one.
    """
    rows, key, tag = _keyed(docs)
    found = checkpointed(similar.near_duplicates(rows, key=key, size=5, k=NEAR_BITS, tag=F.col(tag)).select("id", "tag", "first"))
    kept = _without(rows, found.where("NOT first").select("id", "tag"), key, tag)
    a, b = fresh(kept, "twice_key", "twice_tag")
    twice = small(found.where("first").groupBy("id", "tag").count().where("count > 1").select(F.col("id").alias(a), F.col("tag").alias(b)))
    marked = kept.join(twice, (F.col(key) == F.col(a)) & (F.col(tag) == F.col(b)), "left")
    again = marked.where(F.col(a).isNotNull()).dropDuplicates([key, tag])  # only rows that recur are dealt out
    return marked.where(F.col(a).isNull()).unionByName(again).select(*columns(docs))


def repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts strings of 50 bytes and more that an earlier document has too; documents cut to nothing go.

    A character that loses some of its bytes goes whole. n_chars is counted
    anew. A null text stays null.
    """
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    (null,) = fresh(docs, "null")
    found = suffix_dedup.dedup_bytes(docs.withColumn(null, F.col("text").isNull()), carry=[*others, null], whole=True).where("n_units = 0 OR n_removed < n_units")
    text = F.when(F.col(f"carried_{len(others)}"), F.lit(None)).otherwise(F.col("kept"))
    made = {c: F.col(f"carried_{k}") for k, c in enumerate(others)} | {"text": text}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.coalesce(F.length(text), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return found.select(*(made[c].alias(c) for c in docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item of five words or more."""
    rows, key, tag = _keyed(docs)
    (row,) = fresh(rows, "row")
    rows = rows.withColumn(row, F.xxhash64(key, tag))
    hit = decontaminate.contained(rows, table(spark, sf_dir, "benchmark"), key=row, least=5).select("id")
    return _without(rows, hit, row).select(*columns(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents so that sources, languages and topics have their wanted shares of tokens."""
    return mixing.sample(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("simhash near-dedup", near_dedup),
    ("suffix-array dedup", repeated_bytes),
    ("benchmark decontamination", without_benchmark),
    ("mixing", mixture),
]

#: The stages can't be said in SQL: perplexities and shingle hashes need functions that DuckDB lacks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written to the checkpoint folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
