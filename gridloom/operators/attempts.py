"""Attempts at endpoints: failure classes, streaks with cooldowns, streamed answers and their verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.ordering import running

# Failure classes and, of them, those that speak of an unstable server.
EMPTY, TIMEOUT, TRANSPORT, UNEXPECTED = "empty_content", "timeout", "transport_error", "unexpected_error"
UNSTABLE = (TIMEOUT, TRANSPORT)
DONE = "[DONE]"
CHUNK = "choices array<struct<delta:struct<role:string,content:string,reasoning:string,reasoning_content:string>,finish_reason:string>>"


def failure_class(error: Column) -> Column:
    """The class of an error by its kind's name."""
    return F.when(error == "empty", EMPTY).when(error.isin("first_token_timeout", "token_timeout", "timeout"), TIMEOUT).when(error.isin("connect", "read", "protocol"), TRANSPORT).when(error.isNotNull(), UNEXPECTED)


def backoff(attempt: Column) -> Column:
    """Seconds before another try."""
    return F.least(F.pow(F.lit(2.0), attempt), F.lit(30.0))


def streaks(rows: DataFrame, key: str, order: list[str], success: Column, server: Column, threshold: int) -> DataFrame:
    """key, cooldowns, streak: runs of server failures without a success between them; each `threshold` of them is a cooldown.

    Outcomes that are neither do not touch the streak. `streak` is what is left at the end.
    """
    island = F.sum(success.cast("int")).over(Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    runs = rows.withColumn("_island", island).groupBy(key, "_island").agg(F.sum(server.cast("int")).alias("n"))
    return runs.groupBy(key).agg(F.sum(F.floor(F.col("n") / threshold)).cast("long").alias("cooldowns"), F.max_by(F.col("n") % threshold, "_island").cast("long").alias("streak"))


def endpoint_streak(rows: DataFrame, order: list[str], success: Column, server: Column, threshold: int, carried: int = 0) -> DataFrame:
    """One row, cooldowns and streak: the same for all rows as one endpoint's, in this order and over all tasks; `carried` failures came before them."""
    marked = rows.select(*order, F.coalesce(success, F.lit(False)).cast("long").alias("_ok"), F.coalesce(server, F.lit(False)).cast("long").alias("_bad"))
    island = running(marked, order, "_ok").withColumn("_island", F.col("before") + F.col("_ok"))
    runs = island.groupBy("_island").agg(F.sum("_bad").alias("n")).unionAll(rows.sparkSession.range(1).select(F.lit(0).cast("long"), F.lit(carried).cast("long")))
    whole = runs.groupBy("_island").agg(F.sum("n").alias("n"))
    return whole.agg(F.sum(F.floor(F.col("n") / threshold)).cast("long").alias("cooldowns"), F.max_by(F.col("n") % threshold, "_island").cast("long").alias("streak"))


def assembled(lines: DataFrame, key: str, seq: str, line: str) -> DataFrame:
    """key, content, reasoning, finish: streamed lines put together in order, up to the end mark; other and damaged lines do not count."""
    data = lines.where(F.col(line).startswith("data:")).withColumn("_d", F.trim(F.substring(line, 6, 1 << 30)))
    end = F.max((F.col("_d") == DONE).cast("int")).over(Window.partitionBy(key).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0))
    chunk = F.get(F.from_json("_d", CHUNK)["choices"], F.lit(0))
    own = data.withColumn("_end", end).where("_end = 0").select(key, seq, chunk["delta"].alias("d"), chunk["finish_reason"].alias("f"))
    own = own.select(key, seq, F.col("d.content").alias("c"), F.coalesce("d.reasoning", "d.reasoning_content").alias("r"), "f")
    text = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(seq, c)))), lambda x: x[c]), "")
    return own.groupBy(key).agg(text("c").alias("content"), text("r").alias("reasoning"), F.max_by("f", F.when(F.col("f").isNotNull(), F.col(seq))).alias("finish"))


def verdict(content: Column, finish: Column) -> Column:
    """What becomes of an answer: empty (not tried again), truncated (tried again), odd finish (kept), ok."""
    return F.when(content == "", "empty").when(finish == "length", "truncated").when(finish.isNotNull() & (finish != "stop"), "odd_finish").otherwise("ok")


def reasoning_stats(answers: DataFrame) -> DataFrame:
    """One row of counts over answers with content, reasoning and finish."""
    empty, thought = F.col("content") == "", F.col("reasoning") != ""
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return answers.agg(F.count(F.lit(1)).alias("responses"), n(thought).alias("reasoning_responses"), n(F.length("reasoning")).alias("reasoning_chars"), n(thought & empty).alias("reasoning_only"), n(empty).alias("empty"), n(empty & (F.coalesce("finish", F.lit("")) == "length")).alias("truncated_empty"))
