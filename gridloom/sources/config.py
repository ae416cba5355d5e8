"""Run configuration: TOML with overrides, a closed schema, redacted snapshots."""

from __future__ import annotations

import random
import re
import tomllib
from collections.abc import Iterator, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mark a key as secret, and words that mark it as a duration.
SECRET_WORDS = ("api_key", "apikey", "key", "token", "secret", "password", "passwd", "bearer", "credential", "auth")
DURATION_WORDS = ("timeout", "timeouts")
REDACTED = "***REDACTED***"


class ConfigError(ValueError):
    """A configuration that cannot be used."""


Path = tuple[str, ...]


def leaves(document: Mapping, at: Path = ()) -> Iterator[tuple[Path, object]]:
    """Where each value of a nested table stands, and the value; an empty table is a value."""
    for k, v in document.items():
        if isinstance(v, Mapping) and v:
            yield from leaves(v, (*at, k))
        else:
            yield (*at, k), v


def tree(values: Mapping[Path, object]) -> dict:
    """The nested table of such places and values."""
    out: dict = {}
    for path, v in values.items():
        reduce(lambda table, k: table.setdefault(k, {}), path[:-1], out)[path[-1]] = v
    return out


def merged(base: Mapping, *over: Mapping) -> dict:
    """All layers laid on each other: the last value of a place counts, and clears what stood above or below it, but for tables it adds to."""
    found: dict[Path, object] = {}
    for layer in (base, *over):
        for path, v in leaves(layer):
            gone = [p for p in found if p == path or p[: len(path)] == path and v != {} or path[: len(p)] == p]
            for p in gone:
                del found[p]
            if v != {} or not any(p[: len(path)] == path for p in found):
                found[path] = v
    return tree(found)


def unset(document: Mapping) -> dict:
    """The table with None in place of every empty string."""
    blank = lambda v: [blank(x) for x in v] if isinstance(v, list) else unset(v) if isinstance(v, Mapping) else v or None if isinstance(v, str) else v
    return tree({path: blank(v) for path, v in leaves(document)})


def checked(config: Mapping, schema: Mapping, at: str = "") -> dict:
    """The config if it has just the fields of the schema; types by name, tables by nesting."""
    for k in config:
        if k not in schema:
            raise ConfigError(f"{at}{k}: not a field")
    out = {}
    for k, kind in schema.items():
        v = config.get(k)
        if isinstance(kind, Mapping):
            out[k] = checked(v or {}, kind, f"{at}{k}.")
        elif v is not None and (not isinstance(v, kind) or isinstance(v, bool) and kind is not bool):
            raise ConfigError(f"{at}{k}: expected {kind.__name__} (received: {v!r})")
        else:
            out[k] = v
    return out


def load(base: str, schema: Mapping, override: str | None = None) -> dict:
    """A checked configuration from a TOML file and an optional second one over it."""
    layers = []
    for path in filter(None, (base, override)):
        with open(path, "rb") as f:
            layers.append(tomllib.load(f))
    return checked(unset(merged(*layers)), schema)


def seed_of(configured: int | None) -> int:
    """The configured seed, or 32 bits from the system."""
    return random.SystemRandom().getrandbits(32) if configured is None else configured


# What splits a key into words, and what in the split key speaks of a secret or of a duration; Python and Spark read all three alike.
_BREAK = r"(?<=[a-z0-9])(?=[A-Z])|[^a-zA-Z0-9]+"
_SECRET = rf"(^|_)({'|'.join(SECRET_WORDS)})(_|$)"
_DURATION = rf"(^|_)({'|'.join(DURATION_WORDS)})(_|$)"
#: Secret words as they look run together.
_JOINED = tuple(w.replace("_", "") for w in SECRET_WORDS)


def is_secret(key: object) -> bool:
    """Whether a word of the key, or all of them run together, names a secret; durations never do."""
    if not isinstance(key, str):
        return False
    split = re.sub(_BREAK, "_", key).lower()
    return not re.search(_DURATION, split) and (bool(re.search(_SECRET, split)) or split.replace("_", "") in _JOINED)


def is_secret_column(key: Column) -> Column:
    """The same for a column of keys."""
    split = F.lower(F.regexp_replace(key, _BREAK, "_"))
    return ~split.rlike(_DURATION) & (split.rlike(_SECRET) | F.replace(split, F.lit("_"), F.lit("")).isin(*_JOINED))


def redacted(value: object, key: object = None) -> object:
    """Secret values replaced at any depth; None and empty strings stay."""
    if isinstance(value, Mapping):
        return {k: redacted(v, k) for k, v in value.items()}
    if isinstance(value, list):
        return [redacted(v, key) for v in value]
    return REDACTED if is_secret(key) and value not in (None, "") else value


def snapshot(config: Mapping) -> str:
    """A redacted configuration as TOML; None becomes an empty string."""
    flat, tables = [], []
    for k, v in redacted(config).items():
        (tables if isinstance(v, Mapping) else flat).append((k, v))
    lines = [f"{k} = {_toml(v)}" for k, v in flat]
    for name, own in tables:
        lines += ["", f"[{name}]", *(f"{k} = {_toml(v)}" for k, v in own.items() if not isinstance(v, Mapping))]
        lines += [x for k, v in own.items() if isinstance(v, Mapping) for x in ["", f"[{name}.{k}]", *(f"{a} = {_toml(b)}" for a, b in v.items())]]
    return "\n".join(lines).strip() + "\n"


def _toml(value: object) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, list):
        return "[" + ", ".join(map(_toml, value)) + "]"
    return str(value) if isinstance(value, int | float) else '"' + str(value or "").replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n") + '"'
