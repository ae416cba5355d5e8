"""The record bank: reading with damaged lines aside, gated appends, resume checks and tallies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators import records

DAMAGED = "_damaged"


class BankError(ValueError):
    """A bank that cannot be taken or written."""


def read_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Records of JSON lines with column _damaged, the raw text of a line that does not parse; blank lines are left out."""
    return parse_lines(spark.read.text(path), schema)


def one_object(line: Column) -> Column:
    """Whether a line is one JSON object with nothing behind it; never null.

    Spark's JSON functions stop behind the first value, so two records that a
    crash has put on one line would pass for the first. In an array such a line
    is no single element, in an object no single member. NaN is no JSON.
    """
    within = lambda a, b: F.concat(F.lit(a), line, F.lit(b))
    single = (F.json_array_length(within("[", "]")) == 1) & F.try_parse_json(within('{"v":', "}")).isNotNull()
    return F.coalesce(F.ltrim(line).startswith("{") & single, F.lit(False))


def parse_lines(lines: DataFrame, schema: str | T.StructType, column: str = "value") -> DataFrame:
    """Records of a column of JSON lines, whatever is no single object in _damaged."""
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*kind.fields, T.StructField(DAMAGED, T.StringType())])
    parsed = F.from_json(column, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": DAMAGED})
    rest = [c for c in lines.columns if c != column]
    odd = ~one_object(F.col(column))  # another JSON value than an object is damage too
    return lines.where(F.trim(column) != "").select(*rest, F.when(odd, F.lit(None)).otherwise(parsed).alias("r"), F.when(odd, F.col(column)).alias("odd")).select(*rest, *(F.col(f"r.{f.name}") for f in kind.fields), F.coalesce("odd", f"r.{DAMAGED}").alias(DAMAGED))


def whole(bank: DataFrame) -> DataFrame:
    return bank.where(F.col(DAMAGED).isNull()).drop(DAMAGED)


def _spread(key: str, arrival: Sequence[str]) -> Column:
    """Deals rows with a null key out over tasks, as they don't meet anyway."""
    return F.when(F.col(key).isNull(), F.xxhash64(*arrival))


def first_wins(rows: DataFrame, key: str, arrival: Sequence[str]) -> DataFrame:
    """The first row of each key in order of arrival. Rows with a null key are each their own."""
    rank = F.row_number().over(Window.partitionBy(key, _spread(key, arrival)).orderBy(*arrival))
    return rows.withColumn("_rank", F.when(F.col(key).isNull(), 1).otherwise(rank)).where("_rank = 1").drop("_rank")


def append_outcomes(candidates: DataFrame, bank_ids: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """candidates (id, shape_ok, source_ok, images_ok) with `outcome`; the first failing gate counts.

    An id is a duplicate if the bank has it or an earlier candidate that passed every gate. Rows with a null id are each their own.
    """
    clean = F.col("shape_ok") & F.col("source_ok") & F.col("images_ok")
    earlier = F.sum(F.when(F.col("id").isNotNull(), clean.cast("int"))).over(Window.partitionBy("id", _spread("id", arrival)).orderBy(*arrival).rowsBetween(Window.unboundedPreceding, -1))
    known = candidates.withColumn("_before", F.coalesce(earlier, F.lit(0))).join(bank_ids.select("id").distinct().withColumn("_in", F.lit(True)), "id", "left")
    outcome = records.append_outcome(F.col("shape_ok"), F.col("source_ok"), F.col("images_ok"), F.col("_in").isNotNull() | (F.col("_before") > 0))
    return known.withColumn("outcome", outcome).drop("_before", "_in")


def rewrite(rows: DataFrame, path: str, line: str, arrival: Sequence[str]) -> int:
    """Overwrites a bank with all rows (id, shape_ok, source_ok, images_ok and the JSON line), first of equal ids; returns how many were dropped.

    Any row that a gate refuses stops the write, all such ids named.
    """
    bad = offenders(rows).orderBy("id")
    if n := bad.count():
        bad.write.mode("overwrite").json(f"{path}.refused")  # all of them, however many
        first = [f"{r['id']} ({r['outcome']})" for r in bad.limit(20).collect()]
        raise BankError(f"{n} records refused, all named in {path}.refused: {', '.join(first)}")
    kept = first_wins(rows, "id", arrival)
    kept.select(F.col(line).alias("value")).write.mode("overwrite").text(path)
    return rows.count() - kept.count()


# resume


def missing(plan: DataFrame, bank: DataFrame) -> DataFrame:
    """Planned rows that the bank lacks."""
    return plan.join(bank.select("id").distinct(), "id", "left_anti")


def foreign(plan: DataFrame, bank: DataFrame) -> DataFrame:
    """Bank rows outside the plan."""
    return bank.join(plan.select("id").distinct(), "id", "left_anti")


def mismatched(plan: DataFrame, bank: DataFrame, axes: Sequence[str]) -> DataFrame:
    """Rows of one id whose coordinates differ on any axis; a value on one side only is a difference."""
    differ = reduce(lambda a, b: a | b, (~F.col(f"p.{a}").cast("string").eqNullSafe(F.col(f"b.{a}").cast("string")) for a in axes))
    return plan.alias("p").join(bank.alias("b"), "id").where(differ).select("id").distinct()


def owned(plan: DataFrame, bank: DataFrame, pending: DataFrame) -> DataFrame:
    """Planned rows that are in the bank or pending."""
    return plan.join(bank.select("id").union(pending.select("id")).distinct(), "id", "left_semi")


def guard(plan: DataFrame, bank: DataFrame, axes: Sequence[str]) -> None:
    """Refuses a bank that belongs to another plan."""
    found = []
    for name, rows in (("outside the plan", foreign(plan, bank)), ("with another coordinate", mismatched(plan, bank, axes))):
        r = rows.agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).first()
        if r["n"]:
            found.append(f"{r['n']} records {name}, first {r['first']}")
    if found:
        raise BankError("; ".join(found))


def missing_message(rows: DataFrame, label: str, limit: int = 20) -> DataFrame:
    """One row: how many rows are missing, and the first ones' labels."""
    first = rows.orderBy(label).limit(limit).agg(F.array_join(F.array_sort(F.collect_list(label)), ", ").alias("listed"))
    return rows.agg(F.count(F.lit(1)).alias("n")).crossJoin(first)  # one row each


DIGEST = "sum-sha256/v1"


def contents(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row, records and digest: the same for the same lines in any order and number of files, another one for any other lines.

    Four sums of 60 bits of each line's SHA-256: sums of parts add up, so one pass with a partial sum in each task is enough.
    """
    h = F.sha2(F.col(column), 256)
    piece = lambda i: F.coalesce(F.sum(F.conv(F.substring(h, 15 * i + 1, 15), 16, 10).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string")
    return lines.agg(F.count(F.lit(1)).alias("records"), F.concat_ws(":", F.lit(DIGEST), *(piece(i) for i in range(4))).alias("digest"))


# tallies


def tallies(rows: DataFrame, dimensions: Sequence[str], unknown: str = "unknown") -> DataFrame:
    """dimension, value, n: counts by each dimension in one pass over grouping sets."""
    known = rows.select(*(F.coalesce(F.col(d).cast("string"), F.lit(unknown)).alias(d) for d in dimensions))
    sets = known.groupingSets([[F.col(d)] for d in dimensions], *(F.col(d) for d in dimensions)).agg(F.count(F.lit(1)).alias("n"), *(F.grouping(d).alias(f"g_{d}") for d in dimensions))
    name = reduce(lambda e, d: F.when(F.col(f"g_{d}") == 0, d).otherwise(e), dimensions, F.lit(None))
    return sets.select(name.alias("dimension"), F.coalesce(*dimensions).alias("value"), "n")


def breakdown(meta: Column, source: Column, unknown: str = "unknown") -> dict[str, Column]:
    """The five dimensions of a record by its coordinate (a map): domain and capability have a second axis to fall back to."""
    first = lambda *axes: F.coalesce(*(meta[a] for a in axes), F.lit(unknown))
    return {"domain": first("knowledge_domain", "visual_domain"), "language": first("language"), "capability": first("capability", "question_type"), "system_prompt_mode": first("system_prompt_mode"), "data_source": F.coalesce(source, F.lit(unknown))}


def string_id(line: Column) -> Column:
    """The id of a JSON line that is an object, null where it is no string."""
    value = F.try_parse_json(line)
    return F.when(one_object(line) & (F.schema_of_variant(F.try_variant_get(value, "$.id", "variant")) == "STRING"), F.try_variant_get(value, "$.id", "string"))


def unique_ids(lines: DataFrame, column: str = "value") -> DataFrame:
    """records, unique_ids: objects among JSON lines, and distinct ids among them that are strings."""
    own = lines.where(one_object(F.col(column))).select(string_id(F.col(column)).alias("id"))
    return own.agg(F.count(F.lit(1)).alias("records"), F.count_distinct("id").alias("unique_ids"))


def numbered_damage(lines: DataFrame, column: str = "value") -> DataFrame:
    """lines (path, number, value) that are no JSON object, with their length; blank lines are none."""
    own = parse_lines(lines, "id string", column)
    return own.where(F.col(DAMAGED).isNotNull()).select("path", "number", F.length(DAMAGED).alias("length"), F.col(DAMAGED).alias("line"))


def short_run(planned: DataFrame, own: DataFrame, abandoned: DataFrame) -> DataFrame:
    """One row: planned, written, short, and reason=n of what was abandoned; no row if nothing is short."""
    n = planned.agg(F.count(F.lit(1)).alias("planned")).crossJoin(own.agg(F.count_distinct("id").alias("written")))  # one row each
    text = abandoned.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).agg(F.array_join(F.array_sort(F.collect_list(F.concat("reason", F.lit("="), F.col("n").cast("string")))), ", ").alias("reasons"))
    return n.withColumn("short", F.col("planned") - F.col("written")).crossJoin(text).where("short > 0")


def offenders(rows: DataFrame) -> DataFrame:
    """id, outcome of rows (id, shape_ok, source_ok, images_ok) that some gate refuses."""
    bad = records.append_outcome(F.col("shape_ok"), F.col("source_ok"), F.col("images_ok"), F.lit(False))
    return rows.select("id", bad.alias("outcome")).where(F.col("outcome") != records.APPENDED)


IDENTITY = "plan_identity struct<algorithm:string,version:variant,sampling:variant,ontology_sha256:variant,seed:variant,count:variant,unit_total:variant,plan_size:variant,digest:variant>"


def identity(document: Column, algorithm: str) -> Column:
    """The plan identity in a manifest's or progress record's JSON, null where there is none of this algorithm.

    Records of the first version have only algorithm, version, size and digest;
    what they lack is empty or 0.
    """
    p = F.from_json(document, IDENTITY)["plan_identity"]
    whole = lambda c: F.when(F.schema_of_variant(c) == "BIGINT", F.try_variant_get(c, "$", "bigint"))
    text = lambda c: F.when(F.schema_of_variant(c) == "STRING", F.try_variant_get(c, "$", "string"))
    size, version, digest = whole(p["plan_size"]), whole(p["version"]), text(p["digest"])
    ok = (p["algorithm"] == algorithm) & size.isNotNull() & version.isNotNull() & (digest != "")
    known = F.struct(version.alias("version"), F.coalesce(text(p["sampling"]), F.lit("")).alias("sampling"), F.coalesce(text(p["ontology_sha256"]), F.lit("")).alias("ontology_sha256"), F.coalesce(whole(p["seed"]), F.lit(0)).alias("seed"), whole(p["count"]).alias("count"), F.coalesce(whole(p["unit_total"]), F.lit(0)).alias("unit_total"), size.alias("plan_size"), digest.alias("digest"))
    return F.when(ok, known)


def counter_delta(before: DataFrame, after: DataFrame, key: str, count: str) -> DataFrame:
    """after minus before over all keys of either, a missing one being 0; zeros are left out."""
    both = before.select(key, F.col(count).alias("a")).join(after.select(key, F.col(count).alias("b")), key, "full")
    return both.select(key, (F.coalesce("b", F.lit(0)) - F.coalesce("a", F.lit(0))).alias("delta")).where("delta <> 0")
