"""Generation in rounds of turns: turn t of all open conversations is one table, asked, guarded and written.

A lost executor repeats requests of one turn at most. A row that fails leaves
with its reason; a row whose turns are all there is asked for its answer and
leaves with that. The history that a row has is what the written table says, so
the guard between two turns looks at what will be kept, not at what a client
believes.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators import attempts, messages, records
from gridloom.session import checkpointed
from gridloom.streaming.generate import Client, EmptyAnswer, reason_of

TURNS, ANSWERED = "id string, text string, reason string, ended double", "id string, roles array<string>, contents array<string>, answer string, reason string"
SHORT, LONG = "answer_too_short", "answer_too_long"


def opened(specs: DataFrame) -> DataFrame:
    """specs (id, n_turns, system, ask; picture if there is one) as conversations without a turn; a system text is their first message."""
    picture = F.col("picture") if "picture" in specs.columns else F.lit(None).cast("string")
    lead = lambda value: F.when(F.col("system").isNotNull(), F.array(value)).otherwise(F.array().cast("array<string>"))
    return specs.select(F.col("id").cast("string").alias("id"), F.col("n_turns").cast("int").alias("n_turns"), "ask", picture.alias("picture"), lead(F.lit("system")).alias("roles"), lead(F.col("system")).alias("contents"))


def request(turn: Column) -> tuple[Column, Column]:
    """System and user text of the request for a turn (from 0), or for the answer behind the last."""
    answer = turn >= F.col("n_turns")
    system = F.when(answer, "answer").otherwise(F.concat(role_of(turn), F.lit(" turn")))
    said = F.array_join("contents", "\n")
    return system, F.when(answer, said).otherwise(F.concat_ws("\n", "ask", F.when(F.size("contents") > 0, said)))


def role_of(turn: Column) -> Column:
    return F.when(turn % 2 == 0, "user").otherwise("assistant")


def _one(client: Client, system: str, user: str, picture: str | None) -> tuple[str | None, str | None, float]:
    try:
        text = (client.chat(system, user, picture) if picture else client.chat(system, user)).strip()
        if not text:
            raise EmptyAnswer(system)
        return text, None, time.time()
    except Exception as e:  # noqa: BLE001  each row fails by itself, and says why
        return None, reason_of(e), time.time()


def asked(requests: DataFrame, client: Callable[[], Client], tasks: int, in_flight: int = 1) -> DataFrame:
    """id, text, reason, ended (seconds) of requests (id, system, user, picture): `tasks` partitions, each with a client of its own and so many requests at a time.

    Rows come out as they complete; no more than `in_flight` wait for an answer in a task.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = client()
        with ThreadPoolExecutor(in_flight) as pool:
            open_: dict = {}

            def done(limit: int) -> Iterator[pd.DataFrame]:
                while len(open_) > limit:
                    ready = wait(open_, return_when=FIRST_COMPLETED).done
                    yield pd.DataFrame([(open_.pop(f), *f.result()) for f in ready], columns=["id", "text", "reason", "ended"])

            for part in parts:
                for r in part.itertuples():
                    yield from done(in_flight - 1)
                    open_[pool.submit(_one, own, r.system, r.user, None if pd.isna(r.picture) else r.picture)] = r.id
            yield from done(0)

    return requests.select("id", "system", "user", "picture").repartition(tasks).mapInPandas(run, TURNS)


def step(rows: DataFrame, turn: int, client: Callable[[], Client], tasks: int, in_flight: int = 1, least: int = records.LEAST_ANSWER, most: int | None = None) -> DataFrame:
    """rows of opened() behind one more turn, with answer and reason; both null where the conversation goes on.

    A picture goes with the request for the first user message and with all
    behind it, as the history holds it.
    """
    system, user = request(F.lit(turn))
    replies = asked(rows.select("id", system.alias("system"), user.alias("user"), "picture"), client, tasks, in_flight)
    both = rows.join(replies, "id")
    answering = F.lit(turn) >= F.col("n_turns")
    grown = lambda c, value: F.when(answering | F.col("reason").isNotNull(), F.col(c)).otherwise(F.concat(c, F.array(value)))
    said = both.select("id", "n_turns", "ask", "picture", grown("roles", role_of(F.lit(turn))).alias("roles"), grown("contents", F.col("text")).alias("contents"), F.when(answering, F.col("text")).alias("answer"), "reason", "ended", answering.alias("_answering"))
    spec = F.transform(F.sequence(F.lit(0), F.greatest(F.col("n_turns"), F.lit(1)) - 1), lambda i: role_of(i))
    stopped = F.when(F.col("_answering"), _length(F.col("answer"), least, most)).otherwise(messages.guard(spec, F.col("roles"), F.lit(turn)))
    reason = F.coalesce("reason", stopped)
    return said.withColumn("reason", reason).withColumn("answer", F.when(F.col("reason").isNull(), F.col("answer"))).drop("_answering")


def _length(answer: Column, least: int, most: int | None) -> Column:
    n = F.length(answer)
    return F.when(n < least, SHORT).when(n > most, LONG) if most is not None else F.when(n < least, SHORT)


class Cooling:
    """Waits between rounds for a server that fails: `cooldown` seconds for each `most` failures of its kind without a success between them.

    The streak belongs to the endpoint: outcomes of all tasks count in the order
    in which they ended, and what is left of a streak goes on in the next round.
    Failures that say nothing of the server leave it as it is; 0 never waits.
    """

    def __init__(self, most: int, cooldown: float, sleep: Callable[[float], None] = time.sleep) -> None:
        self.most, self.cooldown, self.sleep, self.streak, self.cooldowns = most, cooldown, sleep, 0, 0

    def __call__(self, turn: int, now: DataFrame) -> None:
        if not self.most:
            return
        found = attempts.endpoint_streak(now.select("id", "ended", "reason"), ["ended", "id"], F.col("reason").isNull(), F.col("reason").isin(*attempts.UNSTABLE), self.most, self.streak).first()
        self.streak, self.cooldowns = found["streak"], self.cooldowns + found["cooldowns"]
        if found["cooldowns"]:
            self.sleep(self.cooldown * found["cooldowns"])


def converse(specs: DataFrame, client: Callable[[], Client], tasks: int = 4, in_flight: int = 1, pause: Callable[[int, DataFrame], None] | None = None, least: int = records.LEAST_ANSWER, most: int | None = None) -> DataFrame:
    """Conversations of specs (id, n_turns, system, ask, picture), or the reason why not; ids differ.

    Each round's table is written before the next one asks. `pause` sees the
    number of a round and its table, and may wait before the next one. Rows
    without a turn are asked for an answer at once.
    """
    open_, out, turn = checkpointed(opened(specs)), [], 0
    while not open_.isEmpty():
        now = checkpointed(step(open_, turn, client, tasks, in_flight, least, most))
        if pause is not None:
            pause(turn, now)
        ended = F.col("answer").isNotNull() | F.col("reason").isNotNull()
        out.append(now.where(ended))
        open_, turn = now.where(~ended).drop("answer", "reason", "ended"), turn + 1
    if not out:
        return specs.sparkSession.createDataFrame([], ANSWERED)
    kept = lambda c: F.when(F.col("reason").isNull(), F.col(c)).alias(c)
    return reduce(DataFrame.unionAll, out).select("id", kept("roles"), kept("contents"), "answer", "reason")
