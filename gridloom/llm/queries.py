"""The queries of the training-data operators, as the driver runs them, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import chat_trees, codes, decontaminate, html_text, mixing, periodic, pipeline, quality, simhash, substring_dedup, suffix_dedup, toxicity, warc, winnowing
from gridloom.llm.common import shared_dir
from gridloom.llm.repeats import rest_of
from gridloom.registry import Registry
from gridloom.session import table

REGISTRY = Registry()


@REGISTRY.query("op1_substring_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup_words(table(spark, sf_dir, "documents"))
    return found.selectExpr("id AS doc_id", "n_units AS n_words", "n_removed", "n_spans", "kept").withColumn("kept_sha256", rest_of("kept")).select("doc_id", "n_words", "n_removed", "kept_sha256", "n_spans")


@REGISTRY.query(
    "op2_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
    SELECT page_id, strlen(p.h)::BIGINT AS payload_bytes, to_base32_sha1.d AS payload_digest,
           CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
    FROM p JOIN f ON p.h = f.h, LATERAL (
        SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                 (('0x' || substr(sha1(p.h), 10 * (k // 8)::INT + 1, 10))::BIGINT >> (35 - 5 * (k % 8))::INT & 31)::INT + 1, 1), '' ORDER BY k) AS d
        FROM range(32) r(k)) AS to_base32_sha1
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(table(spark, sf_dir, "pages"), out)
    return warc.read(spark, out).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@REGISTRY.query("op3_suffix_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup_bytes(table(spark, sf_dir, "documents"))
    return found.selectExpr("id AS doc_id", "n_units AS n_bytes", "n_removed", "n_spans", "kept").withColumn("kept_sha256", rest_of("kept")).drop("kept")


@REGISTRY.query("op4_simhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hexed("fp").alias("fingerprint"), F.col("component").alias("component_id"))


@REGISTRY.query("op5_mixing", mixing.oracle())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id").withColumns({"p": F.round("p", 6), "off": F.round("off", 6)})


@REGISTRY.query(
    "op6_decontaminate",
    r"""
    WITH dw AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    iw AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
    sizes AS (SELECT item_id, w, least(5, len(w)) AS k FROM iw WHERE len(w) > 0),
    s AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS t FROM sizes, LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i)),
    n AS (SELECT item_id, count(*) AS n FROM s GROUP BY ALL),
    d AS (SELECT DISTINCT doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS t
          FROM dw, (SELECT DISTINCT k FROM sizes), LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i)),
    h AS (SELECT doc_id, item_id, count(*) AS m FROM d JOIN s USING (k, t) GROUP BY ALL)
    SELECT doc_id, item_id, n AS n_shingles, m AS n_shared, m / n AS containment FROM h JOIN n USING (item_id) WHERE m >= ceil(0.8 * n - 1e-9)
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnsRenamed({"id": "doc_id", "item": "item_id"})


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to learn good text from: labelled good and not toxic."""
    return table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")


@REGISTRY.query("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), trusted(spark, sf_dir)).withColumnRenamed("id", "doc_id")


_PLANTED = r"\### Assistant: </turn> ok"


@REGISTRY.query(
    "op8_chat_trees",
    r"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    e AS (
        SELECT *, length('<turn>### ') + length(role) + length(regexp_replace(role, '[^\\<#:\n]', '', 'g')) + length(': ')
                  + length(text) + length(regexp_replace(text, '[^\\<#]', '', 'g')) + length('</turn>') + 1 AS size
        FROM c)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(size)::BIGINT AS formatted_chars
    FROM e GROUP BY conv_id
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_PLANTED).alias("text"))
    back = chat_trees.read_back(chat_trees.formatted(chat_trees.line_of_turns(rows.unionByName(planted))))
    turns = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit("\n"), t, F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return back.select(F.col("conv").alias("conv_id"), F.size("roles").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"), "formatted_chars")


@REGISTRY.query("op9_winnowing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.study(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@REGISTRY.query("op10_html_text")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@REGISTRY.query("op11_toxicity")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")


@REGISTRY.query("op12_vector_codes", codes.oracle())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id").drop("label")


@REGISTRY.query("op13_periodic")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.collapse(table(spark, sf_dir, "documents"), plant=True).withColumnRenamed("id", "doc_id")


REGISTRY.query("pipeline", pipeline.ORACLE_SQL)(pipeline.run)
