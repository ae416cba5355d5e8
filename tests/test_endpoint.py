"""The chat client against a server on this machine, and requests asked from a table."""

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from gridloom.sources import endpoint as ep
from gridloom.sources.config import ConfigError
from gridloom.streaming.generate import EmptyAnswer


def chunk(content=None, reasoning=None, finish=None):
    return "data: " + json.dumps({"choices": [{"delta": {"content": content, "reasoning": reasoning}, "finish_reason": finish}]})


@pytest.fixture
def server():
    """Plays the scripts in order, one for each request: lines, numbers (seconds to wait) or an error status."""
    seen, scripts = [], []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            seen.append((self.path, self.headers.get("Authorization"), json.loads(self.rfile.read(int(self.headers["Content-Length"])))))
            script = scripts.pop(0) if len(scripts) > 1 else scripts[0]
            self.send_response(script if isinstance(script, int) else 200)
            self.end_headers()
            for step in script if isinstance(script, list) else ():
                if isinstance(step, float):
                    time.sleep(step)
                else:
                    self.wfile.write(f"{step}\n\n".encode())
                    self.wfile.flush()

        def log_message(self, *a):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}/v1/", seen, scripts
    s.shutdown()


def client(base, waits=None, **how):
    return ep.Chat(ep.Endpoint(base, "m", key="k", **how), sleep=(waits if waits is not None else []).append)


def test_streamed_answer(server):
    base, seen, scripts = server
    scripts.append([": ping", chunk(reasoning="so "), chunk(reasoning="on"), "data: {broken", chunk("Hel"), chunk("lo ", finish="stop"), "data: [DONE]", chunk("never")])
    assert client(base, most_tokens=9).ask([{"role": "user", "content": "hi"}], 0.0) == ("Hello", "so on")
    path, key, body = seen[0]
    assert path == "/v1/chat/completions" and key == "Bearer k"
    assert body == {"model": "m", "messages": [{"role": "user", "content": "hi"}], "temperature": 0.0, "stream": True, "max_tokens": 9, "chat_template_kwargs": {"enable_thinking": False}}


def test_what_is_tried_again(server):
    base, seen, scripts = server
    good, cut, empty = [chunk("fine", finish="stop")], [chunk("half", finish="length")], [chunk(reasoning="hm", finish="length")]
    scripts += [500, cut, good]
    waits = []
    assert client(base, waits).chat("s", "u") == "fine" and waits == [1.0, 2.0] and len(seen) == 3
    scripts[:] = [empty]
    with pytest.raises(EmptyAnswer):
        client(base).chat("", "u")
    assert len(seen) == 4
    scripts[:] = [cut]
    with pytest.raises(ep.Truncated):
        client(base, retries=1).chat("", "u")
    scripts[:] = [503]
    with pytest.raises(ConnectionError, match="2 tries"):
        client(base, retries=1).chat("", "u")


@pytest.mark.parametrize("script", [[1.5, chunk("late")], [chunk("a"), 1.5, chunk("b")]])
def test_stalls(server, script):
    base, seen, scripts = server
    scripts += [script]
    began = time.monotonic()
    with pytest.raises(TimeoutError):
        client(base, first_token=0.3, token=0.3).chat("", "u")
    assert len(seen) == 1 and time.monotonic() - began < 1.4
    waits = []
    with pytest.raises(TimeoutError, match="2 tries"):
        client(base, waits, first_token=0.2, token=0.2, retries=1, retry_on_timeout=True).chat("", "u")
    assert waits == [1.0]


def test_endpoint_from_config():
    with pytest.raises(ConfigError, match=r"\[target\] lacks base, model"):
        ep.from_config({"base": None}, "target")
    assert ep.from_config({"base": "http://h//", "model": "m", "key": None}, "t").address == "http://h/chat/completions"
    with pytest.raises(TypeError):
        ep.Endpoint("b", "m", thinking=None)


class Canned(ep.Chat):
    def __init__(self):
        super().__init__(ep.Endpoint("x", "m"), send=lambda e, body: [chunk(body["messages"][-1]["content"], finish="stop")])


def test_requests_fail_by_themselves(spark):
    rows = [("a", [("user", "one")]), ("b", [("user", "  ")]), ("c", [("system", "s"), ("user", "two")])]
    df = spark.createDataFrame(rows, "id string, messages array<struct<role:string,content:string>>")
    got = {r.id: (r.success, r.content, r.error is None) for r in ep.ask_all(df, Canned, 2).collect()}
    assert got == {"a": (True, "one", True), "b": (False, "", False), "c": (True, "two", True)}
