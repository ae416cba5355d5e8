"""Coverage, density and diversity of a plan, and the rules it is held to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.plans.space import IMAGE, TEXT


def tuple_of(columns: Sequence[str]) -> Column:
    """A struct, which counts as a value even where members are null."""
    return F.struct(*columns)


def structure(plan: DataFrame, units: int, block: Sequence[str], signature: Sequence[str], leaf: str, coordinate: Sequence[str], visual: str | None = None) -> DataFrame:
    """One row: rows, rows and distinct blocks, signatures and leaves by modality, distinct coordinates, coverage, density."""
    by = lambda m, c: F.count_distinct(F.when(F.col("modality") == m, c))
    out = [F.count(F.lit(1)).alias("total")]
    for m in (TEXT, IMAGE):
        out += [F.count(F.when(F.col("modality") == m, 1)).alias(f"{m}_entries"), by(m, tuple_of(block)).alias(f"{m}_blocks"), by(m, tuple_of(signature)).alias(f"{m}_signatures")]
    out += [F.count_distinct(leaf).alias("leaves"), F.count_distinct(tuple_of(coordinate)).alias("distinct_coordinates")]
    if visual:
        out.append(F.count_distinct(visual).alias("visual_leaves"))
    row = plan.agg(*out)
    return row.withColumns({"coverage": F.least(F.col("distinct_coordinates"), F.lit(units)) / F.lit(units), "density": F.col("total") / F.lit(units), "whole_rounds": F.floor(F.col("total") / units).cast("long"), "last_round": F.col("total") % units})


def checks(row: DataFrame, rules: Sequence[tuple[str, Column, Column, str]]) -> DataFrame:
    """label, measured, expected, relation, ok of each rule with an expectation."""
    made = F.array(*(F.struct(F.lit(n).alias("label"), m.cast("long").alias("measured"), e.cast("long").alias("expected"), F.lit(r).alias("relation")) for n, m, e, r in rules))
    found = row.select(F.explode(made).alias("c")).select("c.*").where("expected IS NOT NULL")
    return found.withColumn("ok", F.when(F.col("relation") == ">=", F.col("measured") >= F.col("expected")).otherwise(F.col("measured") == F.col("expected")))


def mismatch(found: DataFrame) -> DataFrame:
    """One row: whether all rules hold, and a message of those that do not."""
    text = F.concat("label", F.lit(" "), F.col("measured").cast("string"), F.lit(", expected "), "relation", F.lit(" "), F.col("expected").cast("string"))
    return found.agg(F.bool_and("ok").alias("within_rule"), F.array_join(F.array_sort(F.collect_list(F.when(~F.col("ok"), text))), "; ").alias("message"))


def markdown(row: dict, rules: Sequence[dict]) -> str:
    """The readout as a page: measures, then rules."""
    lines = ["# Coverage", "", "| measure | value |", "|---|---|", *(f"| {k} | {v} |" for k, v in row.items()), "", "| rule | measured | expected | status |", "|---|---|---|---|"]
    return "\n".join([*lines, *(f"| {r['label']} | {r['measured']} | {r['relation']} {r['expected']} | {'ok' if r['ok'] else 'MISMATCH'} |" for r in rules)]) + "\n"
