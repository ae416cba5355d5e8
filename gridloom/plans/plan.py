"""Plans: the first N coordinates of seeded rounds over all units, the same whatever N is."""

from __future__ import annotations

import random
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions import hashing
from gridloom.plans.space import IMAGE, TEXT


def require_count(count: object) -> int:
    """A whole number from 1."""
    if isinstance(count, bool) or not isinstance(count, int) or count < 1:
        raise ValueError(f"count: expected a whole number from 1 (received: {count!r})")
    return count


def require_subset(per_modality: object, available: tuple[int, int]) -> tuple[int, int]:
    """Text and image rows wanted: two whole numbers from 0, not both 0, none beyond what there is."""
    ok = isinstance(per_modality, tuple) and len(per_modality) == 2 and all(isinstance(n, int) and not isinstance(n, bool) and n >= 0 for n in per_modality)
    if not ok or not any(per_modality) or any(n > a for n, a in zip(per_modality, available, strict=True)):
        raise ValueError(f"per modality: expected two counts up to {available}, not both 0 (received: {per_modality!r})")
    return per_modality


def require_either(count: object, per_modality: object) -> None:
    """Just one of a count and a subset by modality."""
    if (count is None) == (per_modality is None):
        raise ValueError("plan: expected a count or counts by modality, not both")


def cycle_order_sql(units: DataFrame, cycles: int, seed: int, fp: str) -> DataFrame:
    """cycle, position, unit_index: each round orders the units by a hash."""
    rounds = units.sparkSession.range(cycles).select(F.col("id").alias("cycle"))
    key = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.lit(fp), F.col("cycle").cast("string"), F.col("unit_index").cast("string")), 256)
    order = Window.partitionBy("cycle").orderBy("key", "unit_index")
    both = rounds.crossJoin(units.select("unit_index")).withColumn("key", key)  # each round has every unit
    return both.select("cycle", (F.row_number().over(order) - 1).cast("long").alias("position"), "unit_index")


def cycle_order_exact(spark: SparkSession, size: int, cycles: int, seed: int, fp: str) -> DataFrame:
    """The same by the Mersenne Twister; rounds are made in parallel."""

    def run(parts):
        for part in parts:
            for c in part["cycle"]:
                order = hashing.shuffled(size, seed, fp, "cycle", int(c))
                yield pd.DataFrame({"cycle": int(c), "position": range(size), "unit_index": order})

    return spark.range(cycles).select(F.col("id").alias("cycle")).mapInPandas(run, "cycle bigint, position bigint, unit_index bigint")


def indices(spark: SparkSession, count: int, size: int) -> DataFrame:
    """plan_index, cycle, position of each row of a plan."""
    i = F.col("id")
    return spark.range(require_count(count)).select(i.alias("plan_index"), F.floor(i / size).cast("long").alias("cycle"), F.pmod(i, F.lit(size)).alias("position"))


def rotation(unit: Column, cycle: Column, size: int) -> Column:
    """Which of `size` leaves a unit has in a round: the next one each round."""
    return F.pmod(unit + cycle, F.lit(size))


def with_units(plan: DataFrame, order: DataFrame, units: DataFrame) -> DataFrame:
    """Plan indices with their units, joined by round and position."""
    return plan.join(order, ["cycle", "position"]).join(units, "unit_index")


def free_draws_exact(plan: DataFrame, axes: Sequence[tuple[str, Sequence[str]]], seed: int, fp: str, default_first: str | None = "English") -> DataFrame:
    """Adds a drawn value for each axis; row i draws from its own generator, so N does not matter.

    The first axis without values gets its default and uses no draw.
    """
    names = [n for n, _ in axes]

    def run(parts):
        for part in parts:
            out = []
            for i in part["plan_index"]:
                g = random.Random(hashing.seed_number(seed, fp, "free", int(i)))
                out.append([v[g.randrange(len(v))] if v else default_first for _, v in axes])
            yield part.assign(**{n: [o[k] for o in out] for k, n in enumerate(names)})

    return plan.mapInPandas(run, T.StructType([*plan.schema.fields, *(T.StructField(n, T.StringType()) for n in names)]))


def free_draw_sql(index: Column, axis: str, size: int, seed: int, fp: str) -> Column:
    """A drawn position of an axis by hash."""
    return F.pmod(hashing.sha_number(F.concat(F.lit(f'["{seed}","{fp}","{axis}","'), index.cast("string"), F.lit('"]'))), F.lit(size))


def first_of_each(order: DataFrame, units: DataFrame, text: int, image: int) -> DataFrame:
    """A smoke plan: the first units of each modality in the first round, text before image, numbered anew."""
    rows = order.where("cycle = 0").join(units, "unit_index")
    rank = F.row_number().over(Window.partitionBy("modality").orderBy("position"))
    kept = rows.withColumn("rank", rank).where(F.when(F.col("modality") == TEXT, F.col("rank") <= text).otherwise(F.col("rank") <= image))
    number = F.row_number().over(Window.orderBy(F.col("modality") == IMAGE, "rank")) - 1  # at most text + image rows
    return kept.withColumn("plan_index", number.cast("long")).drop("rank")


def turns(n: Column) -> Column:
    """The turn list of a row: users and assistants in turn, the last one final."""
    return F.transform(F.sequence(F.lit(0), n.cast("int") - 1), lambda i: F.struct(i.alias("turn_index"), F.when(i % 2 == 0, "user").otherwise("assistant").alias("role"), (i == n.cast("int") - 1).alias("is_final")))


def coordinate(columns: Sequence[str]) -> Column:
    """Axis and value pairs; an axis without a value is absent."""
    pairs = F.map_filter(F.create_map(*(x for c in columns for x in (F.lit(c), F.col(c)))), lambda k, v: v.isNotNull())
    return F.array_sort(F.map_entries(pairs))


def rounds(count: int, size: int) -> tuple[int, int, int]:
    """Whole rounds of a plan, rows of the last one, and rounds begun."""
    return count // size, count % size, -(-count // size)
