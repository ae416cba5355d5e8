"""Generation of rows through an injected client, and the streaming append of what comes back."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import attempts, bank, records

GENERATED = "id string, roles array<string>, contents array<string>, answer string, reason string"


class EmptyAnswer(Exception):
    """The model gave nothing usable."""


class ShortAnswer(Exception):
    """The answer is below the least length."""


class Client(Protocol):
    """What generation needs of an endpoint: text for a prompt."""

    def chat(self, system: str, user: str, picture: str | None = None) -> str: ...


def reason_of(error: Exception) -> str:
    """The failure class of an exception."""
    if isinstance(error, EmptyAnswer | ShortAnswer):
        return "empty_content" if isinstance(error, EmptyAnswer) else "answer_too_short"
    if isinstance(error, TimeoutError):
        return "timeout"
    return "transport_error" if isinstance(error, ConnectionError) else "unexpected_error"


def one(client: Client, n_turns: int, system: str | None, ask: str) -> tuple[list[str], list[str], str]:
    """Roles and contents of a conversation of n_turns turns, and its answer; any failure abandons the row."""
    roles, contents = (["system"], [system]) if system else ([], [])
    for i in range(n_turns):
        role = "assistant" if i % 2 else "user"
        text = client.chat(f"{role} turn", "\n".join([ask, *contents])).strip()
        if not text:
            raise EmptyAnswer(role)
        roles.append(role)
        contents.append(text)
    answer = client.chat("answer", "\n".join(contents)).strip()
    if len(answer) < records.LEAST_ANSWER:
        raise ShortAnswer
    return roles, contents, answer


class Pressure:
    """Waits `cooldown` seconds after each `most` server failures without a success between them; 0 never waits."""

    def __init__(self, most: int, cooldown: float, sleep: Callable[[float], None] = time.sleep) -> None:
        self.most, self.cooldown, self.sleep, self.streak = most, cooldown, sleep, 0

    def after(self, reason: str | None) -> None:
        """Counts a row's end: null is a success; failures that say nothing of the server leave the streak as it is."""
        if reason is None:
            self.streak = 0
        elif reason in attempts.UNSTABLE:
            self.streak += 1
            if self.most and self.streak == self.most:
                self.sleep(self.cooldown)
                self.streak = 0


def rows(parts: Iterator[pd.DataFrame], own: Client, pressure: Pressure) -> Iterator[pd.DataFrame]:
    """One partition's conversations, in order."""
    for part in parts:
        out = []
        for r in part.itertuples():
            try:
                out.append((r.id, *one(own, int(r.n_turns), r.system, r.ask), None))
            except Exception as e:  # noqa: BLE001  each row fails by itself, and says why
                out.append((r.id, None, None, None, reason_of(e)))
            pressure.after(out[-1][-1])
        yield pd.DataFrame(out, columns=["id", "roles", "contents", "answer", "reason"])


def generate(specs: DataFrame, client: Callable[[], Client], concurrency: int, most_failures: int = 0, cooldown: float = 60.0) -> DataFrame:
    """specs (id, n_turns, system, ask) as conversations or reasons why not; `concurrency` partitions call their own client and cool down by themselves."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from rows(parts, client(), Pressure(most_failures, cooldown))

    return specs.select("id", "n_turns", "system", "ask").repartition(concurrency).mapInPandas(run, GENERATED)


def append_stream(records_stream: DataFrame, bank_path: str, checkpoint: str, arrival: Sequence[str] = ("line",)):
    """Appends a stream of rows (id, line) to a bank of Parquet files, each id once, of a batch the first by `arrival`; starts the query and returns it.

    A batch that runs twice after a failure writes nothing the second time, as its ids are known.
    """

    def append(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = bank.first_wins(batch, "id", arrival)
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(bank_path)
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            rows = rows.join(spark.read.schema("id string, line string").parquet(bank_path).select("id"), "id", "left_anti")
        rows.select("id", "line").write.mode("append").parquet(bank_path)

    return records_stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def known_ids(spark: SparkSession, bank_folder: str, ids_path: str, checkpoint: str) -> DataFrame:
    """id: the string ids of a bank of JSON lines, read on from where the last call ended.

    Files that the checkpoint has seen are not read again; ids are kept as a table.
    """
    found = bank.whole(bank.parse_lines(spark.readStream.text(bank_folder), "id string")).select("id").where("id IS NOT NULL")
    found.writeStream.format("parquet").option("path", ids_path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("id string").parquet(ids_path).distinct()


def windowed_counts(events: DataFrame, ts: str, key: str, width: str, late: str) -> DataFrame:
    """Counts by time window and key of a stream or table, rows up to `late` behind the newest taken in."""
    return events.withColumn("_t", F.col(ts).cast("timestamp")).withWatermark("_t", late).groupBy(F.window("_t", width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")
