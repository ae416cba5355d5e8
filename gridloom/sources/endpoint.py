"""A chat endpoint: streamed requests with two timers, tries again where that can help, and a table of requests asked in tasks.

Only the standard library's HTTP is used. Timers are those of the socket: one
for the first line, one for each later line; a server that stalls is let go by
closing the connection.
"""

from __future__ import annotations

import base64
import http.client
import json
import time
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from urllib.parse import urlsplit

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame

from gridloom.operators.attempts import DONE
from gridloom.operators.images import MEDIA
from gridloom.sources.config import ConfigError
from gridloom.streaming.generate import EmptyAnswer

# The path of chats, and what a limit of tokens leaves as the reason of an answer's end.
PATH, CUT_OFF, WHOLE = "/chat/completions", "length", "stop"
ASKED = "id string, success boolean, content string, reasoning string, error string"


class Truncated(RuntimeError):
    """The answer ran into the limit of tokens."""


class Refused(ConnectionError):
    """The endpoint answered with an error."""


@dataclass(frozen=True)
class Endpoint:
    """Where and how to ask. Seconds: to connect, to the first line, to each later line. retries: tries after the first."""

    base: str
    model: str
    key: str | None = None
    temperature: float = 0.7
    most_tokens: int | None = None
    thinking: bool = False
    connect: float = 10.0
    first_token: float = 120.0
    token: float = 60.0
    retries: int = 3
    retry_on_timeout: bool = False

    def __post_init__(self) -> None:
        if not isinstance(self.thinking, bool):
            raise TypeError(f"thinking: expected True or False (received: {self.thinking!r})")

    @property
    def address(self) -> str:
        return self.base.rstrip("/") + PATH

    def body(self, messages: list[dict], temperature: float | None = None) -> dict:
        """The request; the thinking switch is always said, the limit of tokens only if there is one."""
        limit = {} if self.most_tokens is None else {"max_tokens": self.most_tokens}
        return {"model": self.model, "messages": messages, "temperature": self.temperature if temperature is None else temperature, "stream": True, **limit, "chat_template_kwargs": {"enable_thinking": self.thinking}}


def from_config(section: Mapping, name: str) -> Endpoint:
    """The endpoint of a configuration's table; what it lacks is named with the table."""
    if lacking := [f for f in ("base", "model") if section.get(f) is None]:
        raise ConfigError(f"[{name}] lacks {', '.join(lacking)}: set it in the configuration or in the file over it")
    return Endpoint(**{k: v for k, v in section.items() if v is not None})


def lines(endpoint: Endpoint, body: Mapping) -> Iterator[str]:
    """The lines that the endpoint streams back. A stall beyond a timer is a TimeoutError."""
    at = urlsplit(endpoint.address)
    kind = http.client.HTTPSConnection if at.scheme == "https" else http.client.HTTPConnection
    link = kind(at.hostname, at.port, timeout=endpoint.connect)
    try:
        link.connect()
        link.sock.settimeout(endpoint.first_token)
        head = {"Content-Type": "application/json", "Accept": "text/event-stream"} | ({"Authorization": f"Bearer {endpoint.key}"} if endpoint.key else {})
        link.request("POST", at.path + (f"?{at.query}" if at.query else ""), json.dumps(body), head)
        sock = link.sock
        answer = link.getresponse()
        if answer.status != 200:
            raise Refused(f"status {answer.status}: {answer.read(500).decode(errors='replace')}")
        while line := answer.readline():
            if line.startswith(b"data:"):
                sock.settimeout(endpoint.token)
            yield line.decode("utf-8", "replace").rstrip("\r\n")
    finally:
        link.close()


def assembled(stream: Iterable[str]) -> tuple[str, str | None, str | None]:
    """Content, reasoning and why the answer ended, from streamed lines up to the end mark; damaged lines do not count."""
    content, thought, finish = [], [], None
    for line in stream:
        if not line.startswith("data:"):
            continue
        data = line[5:].strip()
        if data == DONE:
            break
        try:
            choice = json.loads(data)["choices"][0]
        except (ValueError, LookupError, TypeError):
            continue
        delta = choice.get("delta") or {}
        content.append(delta.get("content") or "")
        thought.append(delta.get("reasoning") or delta.get("reasoning_content") or "")
        finish = choice.get("finish_reason") or finish
    return "".join(content), "".join(thought).strip() or None, finish


def picture_address(picture: str) -> str:
    """What a request names a picture by: an address as it is, a file (path or URI, any file system) with its bytes inline."""
    if picture.startswith(("data:", "http://", "https://")):
        return picture
    kind = MEDIA.get(picture.rpartition(".")[2].lower())
    if kind is None:
        raise ValueError(f"no media type for {picture}")
    store, path = fs.FileSystem.from_uri(picture if "://" in picture or picture.startswith("/") else picture.replace(":/", ":///", 1))
    with store.open_input_stream(path, compression=None) as f:
        return f"data:{kind};base64,{base64.b64encode(f.read()).decode()}"


class Chat:
    """A client for generation: `chat` gives the answer's text, `ask` its reasoning too."""

    def __init__(self, endpoint: Endpoint, send: Callable[[Endpoint, Mapping], Iterable[str]] = lines, sleep: Callable[[float], None] = time.sleep) -> None:
        self.endpoint, self.send, self.sleep = endpoint, send, sleep

    def chat(self, system: str, user: str, picture: str | None = None) -> str:
        said = user if picture is None else [{"type": "image_url", "image_url": {"url": picture_address(picture)}}, {"type": "text", "text": user}]
        return self.ask(([{"role": "system", "content": system}] if system else []) + [{"role": "user", "content": said}])[0]

    def ask(self, messages: list[dict], temperature: float | None = None) -> tuple[str, str | None]:
        """Content and reasoning. An empty answer is not asked for again, as the same request would end alike; neither is one after a stall, unless that is wanted."""
        body = self.endpoint.body(messages, temperature)
        for attempt in range(self.endpoint.retries + 1):
            try:
                return self._once(body)
            except EmptyAnswer:
                raise
            except TimeoutError as e:
                if not self.endpoint.retry_on_timeout:
                    raise
                last: Exception = e
            except (OSError, http.client.HTTPException, Truncated) as e:
                last = e
            if attempt < self.endpoint.retries:
                self.sleep(min(2.0**attempt, 30.0))
        kind = type(last) if isinstance(last, TimeoutError | Truncated) else ConnectionError
        raise kind(f"no answer after {self.endpoint.retries + 1} tries: {last}") from last

    def _once(self, body: Mapping) -> tuple[str, str | None]:
        content, thought, finish = assembled(self.send(self.endpoint, body))
        if not content.strip():
            raise EmptyAnswer(f"nothing but {len(thought or '')} characters of reasoning, ended by {finish}")
        if finish == CUT_OFF:
            raise Truncated("cut off by the limit of tokens")
        return content.strip(), thought


def ask_all(requests: DataFrame, client: Callable[[], Chat], concurrency: int) -> DataFrame:
    """id, success, content, reasoning, error of requests (id, messages: array of struct<role, content>); each fails by itself.

    `concurrency` partitions ask at a time, each with a client of its own.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = client()
        for part in parts:
            out = []
            for r in part.itertuples():
                try:
                    out.append((r.id, True, *own.ask([{"role": m["role"], "content": m["content"]} for m in r.messages]), None))
                except Exception as e:  # noqa: BLE001  one bad request leaves the others alone
                    out.append((r.id, False, "", None, str(e) or type(e).__name__))
            yield pd.DataFrame(out, columns=["id", "success", "content", "reasoning", "error"])

    return requests.select("id", "messages").repartition(concurrency, "id").mapInPandas(run, ASKED)
