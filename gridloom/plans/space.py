"""A coordinate space: axes, pair tables and the legal blocks they leave.

A space document is validated on the driver, as it is small, and becomes
frames. Enumeration is a chain of equi-joins on shared axes, which never
builds the raw product unless no pair table joins two axes.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WILDCARD = "*"
TEXT, IMAGE = "text", "image"


class SpaceError(ValueError):
    """A space document that does not hold together."""


@dataclass(frozen=True)
class PairTable:
    """Which values of `to` go with each value of `source`. rules: (value, allowed values or just the wildcard)."""

    name: str
    source: str
    to: str
    rules: tuple[tuple[str, tuple[str, ...]], ...]


@dataclass(frozen=True)
class Space:
    """axes: ordered values by name. restricted: axes of a block in order. free: axes drawn at random or by rotation."""

    axes: dict[str, tuple[str, ...]]
    restricted: tuple[str, ...]
    free: tuple[str, ...]
    gated: str
    pairs: tuple[PairTable, ...]
    image_capable: tuple[str, ...]
    turns: dict[str, int | str] = field(default_factory=dict)

    @property
    def capability(self) -> str:
        return self.restricted[0]


_FIELDS = {"axes": dict, "restricted": list, "free": list, "gated": str, "pairs": list, "modality": dict, "turns": dict}


def axis_values(spec: object, name: str) -> tuple[str, ...]:
    """Values in order of a flat list, of groups one after the other, or of a tree's leaves depth first."""
    if isinstance(spec, list):
        return tuple(spec)
    if isinstance(spec, dict):
        return tuple(v for part in spec.values() for v in axis_values(part, name))
    raise SpaceError(f"axes.{name}: expected list or object (received: {type(spec).__name__})")


def parse(document: object, source: str = "document") -> Space:
    """A validated space. Every problem found is in the message as `field: expected X (received: Y)`."""
    if not isinstance(document, dict):
        raise SpaceError(f"{source}: expected object (received: {type(document).__name__})")
    problems = [f"{k}: expected {t.__name__} (received: {type(document[k]).__name__ if k in document else 'nothing'})" for k, t in _FIELDS.items() if not isinstance(document.get(k), t)]
    problems += [] if problems else list(_inner(document))
    problems += [f"{k}: expected nothing (received: {type(document[k]).__name__})" for k in document if k not in _FIELDS]
    if problems:
        raise SpaceError(f"{source}: " + "; ".join(problems))
    axes = {n: axis_values(s, n) for n, s in document["axes"].items()}
    for name, values in axes.items():
        if not all(isinstance(v, str) for v in values) or len(set(values)) != len(values):
            raise SpaceError(f"axes.{name}: expected distinct strings (received: {list(values)})")
    restricted, free, gated = tuple(document["restricted"]), tuple(document["free"]), document["gated"]
    if set(axes) - set(restricted) - set(free) != {gated} or set(restricted) & set(free):
        raise SpaceError("axes: expected each in restricted or free, but for the gated one")
    capable = tuple(dict.fromkeys(document["modality"].get("must", []) + document["modality"].get("may", [])))
    pairs = tuple(_pair(p, axes) for p in document["pairs"])
    return Space(axes, restricted, free, gated, pairs, capable, dict(document["turns"]))


_PAIR = {"id": str, "from": str, "to": str, "rules": list}


def _inner(document: dict) -> Iterator[str]:
    """What is wrong in the lists and tables of a document that has all its fields."""
    kind = lambda v: type(v).__name__
    for where in ("restricted", "free"):
        yield from (f"{where}.{i}: expected str (received: {kind(v)})" for i, v in enumerate(document[where]) if not isinstance(v, str))
    for i, pair in enumerate(document["pairs"]):
        at = f"pairs.{i}"
        if not isinstance(pair, dict):
            yield f"{at}: expected dict (received: {kind(pair)})"
            continue
        yield from (f"{at}.{k}: expected {t.__name__} (received: {kind(pair[k]) if k in pair else 'nothing'})" for k, t in _PAIR.items() if not isinstance(pair.get(k), t))
        yield from (f"{at}.{k}: expected an axis (received: {pair[k]})" for k in ("from", "to") if isinstance(pair.get(k), str) and pair[k] not in document["axes"])
        for j, rule in enumerate(pair["rules"] if isinstance(pair.get("rules"), list) else ()):
            if not (isinstance(rule, list | tuple) and len(rule) == 2 and isinstance(rule[0], str) and isinstance(rule[1], list | tuple) and all(isinstance(v, str) for v in rule[1])):
                yield f"{at}.rules.{j}: expected a value and a list of values (received: {rule!r})"
    for k, v in document["modality"].items():
        if k not in ("must", "may", "text_only") or not isinstance(v, list) or not all(isinstance(x, str) for x in v):
            yield f"modality.{k}: expected must, may or text_only with a list of values (received: {v!r})"
    for k, v in document["turns"].items():
        if v != "multi" and (isinstance(v, bool) or not isinstance(v, int) or v < 1):
            yield f"turns.{k}: expected a count from 1 or multi (received: {v!r})"


def role_errors(declared: DataFrame, restricted: DataFrame, free: DataFrame, gated: str) -> DataFrame:
    """problem, axis of frames with column axis: axes without a role, roles of unknown axes, axes with two roles."""
    roles = restricted.select("axis").unionAll(free.select("axis"))
    out = {"without a role": declared.select("axis").where(F.col("axis") != gated).exceptAll(roles), "unknown": roles.join(declared, "axis", "left_anti"), "two roles": restricted.select("axis").intersect(free.select("axis"))}
    return reduce(DataFrame.unionAll, (df.distinct().select(F.lit(name).alias("problem"), "axis") for name, df in out.items()))


def _pair(raw: dict, axes: dict[str, tuple[str, ...]]) -> PairTable:
    """A pair table with wildcards written out; the last of several rules for one value counts."""
    name, source, to = raw["id"], raw["from"], raw["to"]
    rules: dict[str, tuple[str, ...]] = {}
    for value, allowed in raw["rules"]:
        if value not in axes[source]:
            raise SpaceError(f"{name}: {value} is no value of {source}")
        if WILDCARD in allowed and list(allowed) != [WILDCARD]:
            raise SpaceError(f"{name}: the wildcard stands alone")
        wanted = axes[to] if list(allowed) == [WILDCARD] else tuple(dict.fromkeys(allowed))
        if unknown := [v for v in wanted if v not in axes[to]]:
            raise SpaceError(f"{name}: {unknown[0]} is no value of {to}")
        rules[value] = wanted
    if missing := [v for v in axes[source] if v not in rules]:
        raise SpaceError(f"{name}: no rule for {missing}")
    return PairTable(name, source, to, tuple(rules.items()))


def load(path: str) -> Space:
    """A space from a JSON file; a missing file, bad JSON and another value than an object are different errors."""
    try:
        with open(path, encoding="utf-8") as f:
            document = json.load(f)
    except FileNotFoundError as e:
        raise SpaceError(f"{path}: no such file") from e
    except json.JSONDecodeError as e:
        raise SpaceError(f"{path}: bad JSON at {e.lineno}:{e.colno}") from e
    return parse(document, path)


@dataclass
class Frames:
    """A space as frames: values by axis (pos, value), pairs (source value, to value) by table."""

    values: dict[str, DataFrame]
    pairs: list[tuple[str, str, DataFrame]]
    restricted: tuple[str, ...]
    image_capable: DataFrame


def to_frames(spark: SparkSession, space: Space) -> Frames:
    values = {a: spark.createDataFrame([(i, v) for i, v in enumerate(vs)], "pos int, value string") for a, vs in space.axes.items()}
    pairs = [(p.source, p.to, spark.createDataFrame([(v, t) for v, ts in p.rules for t in ts], f"`{p.source}` string, `{p.to}` string")) for p in space.pairs]
    return Frames(values, pairs, space.restricted, spark.createDataFrame([(v,) for v in space.image_capable], f"`{space.capability}` string"))


def legal_blocks(frames: Frames) -> DataFrame:
    """All legal combinations of the restricted axes: the natural join of the pair tables, axes without one crossed in."""
    left = list(frames.pairs)
    blocks, have = None, set()
    while left:
        at = next((k for k, (a, b, _) in enumerate(left) if {a, b} & have), 0)
        a, b, pair = left.pop(at)
        shared = [x for x in (a, b) if x in have]
        blocks = pair if blocks is None else blocks.join(pair, shared) if shared else blocks.crossJoin(pair)
        have |= {a, b}
    for axis in frames.restricted:
        if axis not in have:
            own = frames.values[axis].select(F.col("value").alias(axis))
            blocks = own if blocks is None else blocks.crossJoin(own)
    return blocks.select(*frames.restricted).distinct()


def positioned(blocks: DataFrame, frames: Frames) -> DataFrame:
    """Blocks with the position of each value, pos_<axis>."""
    for axis in frames.restricted:
        blocks = blocks.join(frames.values[axis].select(F.col("value").alias(axis), F.col("pos").alias(f"pos_{axis}")), axis)
    return blocks


def units(blocks: DataFrame, frames: Frames) -> DataFrame:
    """unit_index, modality and block: text units in axis order, then image units of the image-capable blocks."""
    own = positioned(blocks, frames)
    image = own.join(frames.image_capable, frames.restricted[0], "left_semi")
    both = own.withColumn("modality", F.lit(TEXT)).unionByName(image.withColumn("modality", F.lit(IMAGE)))
    order = Window.orderBy(F.col("modality") == IMAGE, *(f"pos_{a}" for a in frames.restricted))
    return both.select((F.row_number().over(order) - 1).cast("long").alias("unit_index"), "modality", *frames.restricted)


def expanded(rules: DataFrame, values: DataFrame) -> DataFrame:
    """source, to: pair rules (pos, source, allowed: array) written out; the last rule of a source counts, just the wildcard means all values."""
    last = rules.groupBy("source").agg(F.max_by("allowed", "pos").alias("allowed"))
    every = values.agg(F.collect_list("value").alias("every"))  # one row; an axis has a few values
    allowed = F.when(F.col("allowed") == F.array(F.lit(WILDCARD)), F.col("every")).otherwise(F.array_distinct("allowed"))
    return last.crossJoin(every).select("source", F.explode(allowed).alias("to"))


def rule_errors(rules: DataFrame, sources: DataFrame, values: DataFrame) -> DataFrame:
    """problem, value: rules of unknown sources, unknown allowed values, sources without a rule."""
    told = rules.select(F.explode("allowed").alias("value")).where(F.col("value") != WILDCARD)
    out = [
        rules.select(F.col("source").alias("value")).join(sources, "value", "left_anti").withColumn("problem", F.lit("unknown source")),
        told.join(values, "value", "left_anti").withColumn("problem", F.lit("unknown value")),
        sources.select("value").join(rules.select(F.col("source").alias("value")), "value", "left_anti").withColumn("problem", F.lit("no rule")),
    ]
    return reduce(DataFrame.unionByName, (x.select("problem", "value") for x in out)).distinct()


def unsolvable(blocks: DataFrame, frames: Frames, a: str, b: str) -> DataFrame:
    """Pairs of values of two axes that no legal block has, in axis order."""
    every = frames.values[a].select(F.col("value").alias(a), F.col("pos").alias("pa")).crossJoin(frames.values[b].select(F.col("value").alias(b), F.col("pos").alias("pb")))
    return every.join(blocks.select(a, b).distinct(), [a, b], "left_anti").orderBy("pa", "pb").select(a, b)


def counts(space: Space) -> dict[str, int]:
    """Sizes that follow from the axes alone: of the raw product and of the free one."""
    size = lambda axes: reduce(lambda n, a: n * len(space.axes[a]), axes, 1)
    return {"raw": size(space.restricted), "free": size(space.free)}


def turn_count(declared: int | str) -> int:
    """2n - 1 turns for n exchanges; `multi` is four."""
    n = 4 if declared == "multi" else declared
    if isinstance(n, bool) or not isinstance(n, int) or n < 1:
        raise SpaceError(f"turns: expected a count from 1 or multi (received: {declared!r})")
    return 2 * n - 1
