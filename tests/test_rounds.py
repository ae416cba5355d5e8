"""Generation in rounds of turns beside plain recursion over one conversation."""

import glob
import os
import uuid

import pytest

from gridloom.operators import messages
from gridloom.streaming import generate, rounds

SPECS = "id string, n_turns int, system string, ask string, picture string"


class Plain:
    """Answers by what it is asked."""

    def chat(self, system, user, picture=None):
        if "silent" in user and system == "assistant turn":
            return "  "
        if "broken" in user and "user turn" in user:
            raise ConnectionError
        if "brief" in user and system == "answer":
            return "no"
        return f"{system} {len(user)} {picture}" + (" brief" if "brief" in user else "")


def alone(client, n_turns, system, ask, picture):
    """Roles, contents and answer of one row by recursion."""

    def grow(roles, contents):
        turn = len(roles) - (roles[:1] == ["system"])
        more = (picture,) if picture else ()
        if turn == n_turns:
            return roles, contents, client.chat("answer", "\n".join(contents), *more).strip()
        role = "assistant" if turn % 2 else "user"
        text = client.chat(f"{role} turn", "\n".join([ask, *contents]), *more).strip()
        if not text:
            raise generate.EmptyAnswer
        return grow([*roles, role], [*contents, text])

    try:
        roles, contents, answer = grow(["system"] if system else [], [system] if system else [])
        return (roles, contents, answer, None) if len(answer) >= 8 else (None, None, None, rounds.SHORT)
    except Exception as e:  # noqa: BLE001
        return None, None, None, generate.reason_of(e)


@pytest.mark.parametrize("in_flight", [1, 3])
def test_equals_plain_recursion(spark, in_flight):
    asks = ["tell me", "silent", "broken", "brief"]
    rows = [(f"r{i}", 2 * (i % 3) + 1, "be kind" if i % 2 else None, asks[i % 4] + " é\n" * (i % 2), f"pic{i}" if i % 5 == 0 else None) for i in range(40)]
    made = rounds.converse(spark.createDataFrame(rows, SPECS), Plain, 3, in_flight)
    got = {r.id: (r.roles, r.contents, r.answer, r.reason) for r in made.collect()}
    assert len(got) == made.count() == 40
    assert got == {r[0]: alone(Plain(), *r[1:]) for r in rows}
    assert {v[3] for v in got.values()} == {None, "empty_content", "transport_error", rounds.SHORT}


def test_each_turn_is_asked_once(spark, tmp_path):
    """Tables are written once, so that looking at them again asks nobody; a row that failed is asked no more."""
    folder = str(tmp_path)

    class Counting(Plain):
        def chat(self, system, user, picture=None):
            with open(os.path.join(folder, f"{system.split()[0]}-{uuid.uuid4().hex}"), "w"):
                pass
            return super().chat(system, user, picture)

    seen = []
    rows = [(f"r{i}", 3, None, "silent" if i < 4 else "tell", None) for i in range(10)]
    made = rounds.converse(spark.createDataFrame(rows, SPECS), Counting, 2, pause=lambda turn, now: seen.append((turn, now.count())))
    assert made.count() == 10 and made.where("reason IS NULL").count() == 6
    count = lambda kind: len(glob.glob(f"{folder}/{kind}-*"))
    assert (count("user"), count("assistant"), count("answer")) == (10 + 6, 10, 6)
    assert seen == [(0, 10), (1, 10), (2, 6), (3, 6)]


def test_no_rows_and_no_turns(spark):
    none = spark.createDataFrame([], SPECS)
    assert rounds.converse(none, Plain).columns == ["id", "roles", "contents", "answer", "reason"] and rounds.converse(none, Plain).isEmpty()
    got = rounds.converse(spark.createDataFrame([("a", 0, "be kind", "tell", None)], SPECS), Plain).first()
    assert (got.roles, got.contents, got.reason) == (["system"], ["be kind"], None) and got.answer.startswith("answer")


def test_limits_of_an_answer(spark):
    rows = [("a", 1, None, "brief", None), ("b", 1, None, "tell", None)]
    got = {r.id: r.reason for r in rounds.converse(spark.createDataFrame(rows, SPECS), Plain, least=1, most=10).collect()}
    assert got == {"a": None, "b": rounds.LONG}


def test_guard_stops_what_does_not_fit_its_plan(spark):
    """An even number of turns ends on an assistant: the guard gives the row up behind its last turn."""
    got = rounds.converse(spark.createDataFrame([("a", 2, None, "tell", None), ("b", 1, None, "tell", None)], SPECS), Plain).collect()
    assert {r.id: r.reason for r in got} == {"a": messages.ROLE_MISMATCH, "b": None}
