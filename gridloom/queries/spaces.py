"""Spaces, plans and readouts over axes drawn from customers, orders and line items."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions import hashing
from gridloom.operators import readout
from gridloom.plans import plan as plans
from gridloom.plans import space as spaces
from gridloom.registry import Registry
from gridloom.session import table

SEED, FP, CYCLES = 7, "tables", 4
BLOCK = ("segment", "priority", "flag", "status")
IMAGE_SEGMENTS = 3

# The axes: distinct values in order. The pair tables: pairs at least as frequent as the mean pair.
_SQL = """
WITH o AS (SELECT o_orderkey, o_orderpriority AS priority, c_mktsegment AS segment FROM orders JOIN customer ON o_custkey = c_custkey),
l AS (SELECT l_orderkey, l_returnflag AS flag, l_linestatus AS status FROM lineitem),
v_segment AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS pos FROM (SELECT DISTINCT segment AS value FROM o)),
v_priority AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS pos FROM (SELECT DISTINCT priority AS value FROM o)),
v_flag AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS pos FROM (SELECT DISTINCT flag AS value FROM l)),
v_status AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS pos FROM (SELECT DISTINCT status AS value FROM l)),
c_sp AS (SELECT segment, priority, count(*) AS n FROM o GROUP BY ALL),
p_sp AS (SELECT segment, priority FROM c_sp WHERE n * (SELECT count(*) FROM c_sp) >= (SELECT sum(n) FROM c_sp)),
c_pf AS (SELECT priority, flag, count(*) AS n FROM o JOIN l ON o_orderkey = l_orderkey GROUP BY ALL),
p_pf AS (SELECT priority, flag FROM c_pf WHERE n * (SELECT count(*) FROM c_pf) >= (SELECT sum(n) FROM c_pf)),
p_fs AS (SELECT DISTINCT flag, status FROM l),
blocks AS (SELECT segment, priority, flag, status FROM p_sp JOIN p_pf USING (priority) JOIN p_fs USING (flag)),
positioned AS (SELECT b.*, s.pos AS a, p.pos AS b, f.pos AS c, t.pos AS d FROM blocks b JOIN v_segment s ON b.segment = s.value JOIN v_priority p ON b.priority = p.value JOIN v_flag f ON b.flag = f.value JOIN v_status t ON b.status = t.value),
units AS (SELECT row_number() OVER (ORDER BY image, a, b, c, d) - 1 AS unit_index, CASE WHEN image THEN 'image' ELSE 'text' END AS modality, segment, priority, flag, status
          FROM (SELECT *, false AS image FROM positioned UNION ALL SELECT *, true FROM positioned WHERE a < 3)),
ordered AS (SELECT cycle, row_number() OVER (PARTITION BY cycle ORDER BY sha256('7:tables:' || cycle || ':' || unit_index), unit_index) - 1 AS position, unit_index FROM units, range(4) r(cycle)),
size AS (SELECT count(*) AS u FROM units),
nations AS (SELECT n_name AS leaf, row_number() OVER (ORDER BY n_nationkey) - 1 AS pos FROM nation),
plan AS (SELECT cycle * u + position AS plan_index, cycle, position, unit_index, modality, segment, priority, flag, status,
                (unit_index + cycle) % 25 AS leaf_pos,
                ('0x' || substr(sha256('["7","tables","language","' || (cycle * u + position) || '"]'), 1, 8))::BIGINT % 4 AS language,
                ('0x' || substr(sha256('["7","tables","style","' || (cycle * u + position) || '"]'), 1, 8))::BIGINT % 7 AS style
         FROM ordered JOIN units USING (unit_index), size)
"""


def frames(spark: SparkSession, sf_dir: str) -> spaces.Frames:
    """The space of the tables. Its axes have a few values by contract, so its frames are small."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("priority")).join(cust, F.col("o_custkey") == F.col("c_custkey"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"))

    def values(rows: DataFrame, axis: str) -> DataFrame:
        distinct = rows.select(F.col(axis).alias("value")).distinct()
        return distinct.select((F.row_number().over(Window.orderBy("value")) - 1).alias("pos"), "value")

    def frequent(rows: DataFrame, a: str, b: str) -> DataFrame:
        n = rows.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
        mean = n.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("s"))
        return n.crossJoin(F.broadcast(mean)).where(F.col("n") * F.col("k") >= F.col("s")).select(a, b)  # one row

    both = o.join(li, F.col("o_orderkey") == F.col("l_orderkey"))
    vocab = {"segment": values(cust.join(o.select("o_custkey"), F.col("c_custkey") == F.col("o_custkey"), "left_semi"), "segment"), "priority": values(o, "priority"), "flag": values(li, "flag"), "status": values(li, "status")}
    pairs = [("segment", "priority", frequent(o, "segment", "priority")), ("priority", "flag", frequent(both, "priority", "flag")), ("flag", "status", li.select("flag", "status").distinct())]
    capable = vocab["segment"].where(F.col("pos") < IMAGE_SEGMENTS).select(F.col("value").alias("segment"))
    return spaces.Frames(vocab, pairs, BLOCK, capable)


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The units of the tables' space, computed once for a query's several uses."""
    f = frames(spark, sf_dir)
    return spaces.units(spaces.legal_blocks(f), f).cache()


def whole_plan(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """All rows of the plan's rounds, and the units in a round."""
    own = units(spark, sf_dir)
    size = own.count()
    rows = plans.with_units(plans.indices(spark, CYCLES * size, size), plans.cycle_order_sql(own, CYCLES, SEED, FP), own)
    draw = lambda a, n: plans.free_draw_sql(F.col("plan_index"), a, n, SEED, FP)
    return rows.withColumns({"leaf_pos": plans.rotation(F.col("unit_index"), F.col("cycle"), 25), "language": draw("language", 4), "style": draw("style", 7)}), size


def register(reg: Registry) -> None:
    def q(name: str, tail: str):
        return reg.query(name, _SQL + tail)

    @q("axis_values", "SELECT 'segment' AS axis, pos, value FROM v_segment UNION ALL SELECT 'priority', pos, value FROM v_priority UNION ALL SELECT 'flag', pos, value FROM v_flag UNION ALL SELECT 'status', pos, value FROM v_status")
    def axis_values(spark, d):
        f = frames(spark, d)
        return reduce(DataFrame.unionAll, (v.select(F.lit(a).alias("axis"), F.col("pos").cast("long").alias("pos"), "value") for a, v in f.values.items()))

    @q("legal_blocks", "SELECT * FROM blocks")
    def legal_blocks(spark, d):
        return spaces.legal_blocks(frames(spark, d))

    @q("raw_vs_legal_counts", "SELECT (SELECT count(*) FROM v_segment) * (SELECT count(*) FROM v_priority) * (SELECT count(*) FROM v_flag) * (SELECT count(*) FROM v_status) AS raw, (SELECT count(*) FROM blocks) AS legal, (SELECT count(*) FROM units WHERE modality = 'image') AS image_legal, (SELECT count(*) FROM units) AS units")
    def raw_vs_legal(spark, d):
        f = frames(spark, d)
        sizes = reduce(DataFrame.unionAll, (v.agg(F.count(F.lit(1)).alias("n")) for v in f.values.values()))
        raw = sizes.agg(F.aggregate(F.collect_list("n"), F.lit(1).cast("long"), lambda a, n: a * n).alias("raw"))
        own = spaces.units(spaces.legal_blocks(f), f)
        n = own.agg(F.count(F.when(F.col("modality") == "text", 1)).alias("legal"), F.count(F.when(F.col("modality") == "image", 1)).alias("image_legal"), F.count(F.lit(1)).alias("units"))
        return raw.crossJoin(n)  # one row each

    @q("block_axis_distribution", "SELECT 'segment' AS axis, segment AS value, count(*) AS n FROM blocks GROUP BY ALL UNION ALL SELECT 'priority', priority, count(*) FROM blocks GROUP BY ALL UNION ALL SELECT 'flag', flag, count(*) FROM blocks GROUP BY ALL UNION ALL SELECT 'status', status, count(*) FROM blocks GROUP BY ALL")
    def distribution(spark, d):
        from gridloom.operators.bank import tallies

        return tallies(spaces.legal_blocks(frames(spark, d)), BLOCK).withColumnRenamed("dimension", "axis")

    @q("unsolvable_pairs", "SELECT s.value AS segment, f.value AS flag FROM v_segment s, v_flag f WHERE NOT EXISTS (SELECT 1 FROM blocks b WHERE b.segment = s.value AND b.flag = f.value)")
    def unsolvable(spark, d):
        f = frames(spark, d)
        return spaces.unsolvable(spaces.legal_blocks(f), f, "segment", "flag")

    @q("coverage_units", "SELECT * FROM units")
    def coverage_units(spark, d):
        return units(spark, d)

    @q("cycle_order", "SELECT * FROM ordered")
    def cycle_order(spark, d):
        return plans.cycle_order_sql(units(spark, d), CYCLES, SEED, FP)

    @q("plan_rotation", "SELECT plan_index, cycle, position, unit_index, leaf FROM plan JOIN nations ON leaf_pos = pos")
    def plan_rotation(spark, d):
        nation = table(spark, d, "nation")
        leaves = nation.select(F.col("n_name").alias("leaf"), (F.row_number().over(Window.orderBy("n_nationkey")) - 1).alias("leaf_pos"))
        return whole_plan(spark, d)[0].join(F.broadcast(leaves), "leaf_pos").select("plan_index", "cycle", "position", "unit_index", "leaf")  # 25 leaves

    @q("free_draws", "SELECT plan_index, language, style FROM plan")
    def free_draws(spark, d):
        return whole_plan(spark, d)[0].select("plan_index", "language", "style")

    @q("plan_prefix_check", ", short AS (SELECT position AS plan_index, 0 AS cycle, position, o.unit_index, u.modality, u.segment, u.priority, u.flag, u.status FROM (SELECT unit_index, row_number() OVER (ORDER BY sha256('7:tables:0:' || unit_index), unit_index) - 1 AS position FROM units) o JOIN units u USING (unit_index)), long AS (SELECT plan_index, cycle, position, unit_index, modality, segment, priority, flag, status FROM plan WHERE plan_index < (SELECT u FROM size)) SELECT (SELECT count(*) FROM ((FROM short EXCEPT FROM long) UNION ALL (FROM long EXCEPT FROM short))) AS rows_that_differ, (SELECT count(*) FROM short) AS shared_rows")
    def prefix_check(spark, d):
        """The plan of one round against the first rows of the plan of all rounds."""
        own = units(spark, d)
        size = own.count()
        order = plans.cycle_order_sql(own, CYCLES, SEED, FP)
        short = plans.with_units(plans.indices(spark, size, size), order, own)
        long = plans.with_units(plans.indices(spark, CYCLES * size, size), order, own).where(F.col("plan_index") < size)
        differ = short.exceptAll(long).unionAll(long.exceptAll(short)).agg(F.count(F.lit(1)).alias("rows_that_differ"))
        return differ.crossJoin(short.agg(F.count(F.lit(1)).alias("shared_rows")))  # one row each

    @q("smoke_topk", "SELECT row_number() OVER (ORDER BY modality = 'image', position) - 1 AS plan_index, unit_index, modality FROM (SELECT *, row_number() OVER (PARTITION BY modality ORDER BY position) AS k FROM plan WHERE cycle = 0) WHERE k <= 4")
    def smoke(spark, d):
        own = units(spark, d)
        return plans.first_of_each(plans.cycle_order_sql(own, 1, SEED, FP), own, 4, 4).select("plan_index", "unit_index", "modality")

    @q("anchor_ids", """SELECT plan_index, substr(sha256('["tables",7,"cycle-sha2/v1"]'), 1, 8) || printf('-c%05dp%05d', cycle, position) AS id FROM plan""")
    def ids(spark, d):
        key = hashing.run_key_column(FP, SEED, hashing.SQL)
        return whole_plan(spark, d)[0].select("plan_index", hashing.row_id(key, F.col("cycle"), F.col("position")).alias("id"))

    @q("plan_digest", """SELECT sha256('["tables",7]' || string_agg('["' || id || '",[["flag","' || flag || '"],["priority","' || priority || '"],["segment","' || segment || '"]],1]', '' ORDER BY plan_index)) AS digest FROM (SELECT *, substr(sha256('["tables",7,"cycle-sha2/v1"]'), 1, 8) || printf('-c%05dp%05d', cycle, position) AS id FROM plan)""")
    def digest(spark, d):
        key = hashing.run_key_column(FP, SEED, hashing.SQL)
        rows = whole_plan(spark, d)[0].select("plan_index", hashing.row_id(key, F.col("cycle"), F.col("position")).alias("id"), plans.coordinate(["segment", "priority", "flag"]).alias("coordinate"), F.lit(1).alias("n_turns"))
        return spark.createDataFrame([(hashing.plan_digest(rows, [FP, SEED]),)], "digest string")

    @q("block_labels", "SELECT unit_index, 'segment=' || segment || ', priority=' || priority || ', flag=' || flag || ', status=' || status AS label FROM units")
    def labels(spark, d):
        return units(spark, d).select("unit_index", F.array_join(F.array(*(F.concat(F.lit(f"{a}="), F.col(a)) for a in BLOCK)), ", ").alias("label"))

    @q("coordinate_json", """SELECT plan_index, '{"flag":"' || flag || '","priority":"' || priority || '","segment":"' || segment || '"' || CASE WHEN modality = 'image' THEN ',"visual":"' || status || '"' ELSE '' END || '}' AS coordinate FROM plan""")
    def coordinates(spark, d):
        rows = whole_plan(spark, d)[0].withColumn("visual", F.when(F.col("modality") == "image", F.col("status")))
        return rows.select("plan_index", F.to_json(F.map_from_entries(plans.coordinate(["segment", "priority", "flag", "visual"]))).alias("coordinate"))

    measures = """
    , s AS (SELECT count(*) AS total, count(*) FILTER (modality = 'text') AS text_entries, count(*) FILTER (modality = 'image') AS image_entries,
       count(DISTINCT (segment, priority, flag, status)) FILTER (modality = 'text') AS text_blocks, count(DISTINCT (segment, priority, flag, status)) FILTER (modality = 'image') AS image_blocks,
       count(DISTINCT (segment, priority, language, style)) FILTER (modality = 'text') AS text_signatures, count(DISTINCT (segment, priority, language, style)) FILTER (modality = 'image') AS image_signatures,
       count(DISTINCT leaf_pos) AS leaves, count(DISTINCT (modality, segment, priority, flag, status, leaf_pos, language, style)) AS distinct_coordinates FROM plan),
    readout AS (SELECT s.*, least(distinct_coordinates, u) / u AS coverage, total / u AS density, total // u AS whole_rounds, total % u AS last_round, u FROM s, size)
    """

    def read(spark, d):
        rows, size = whole_plan(spark, d)
        return readout.structure(rows, size, BLOCK, ("segment", "priority", "language", "style"), "leaf_pos", ("modality", *BLOCK, "leaf_pos", "language", "style")), size

    @q("structure_readout", measures + "SELECT * EXCLUDE (u) FROM readout")
    def structure(spark, d):
        return read(spark, d)[0]

    rules_sql = measures + """, rules AS (
      SELECT 'distinct coordinates' AS label, distinct_coordinates AS measured, least(u, total) AS expected, '>=' AS relation, distinct_coordinates >= least(u, total) AS ok FROM readout
      UNION ALL SELECT 'text blocks', text_blocks, (SELECT count(*) FROM blocks), '==', text_blocks = (SELECT count(*) FROM blocks) FROM readout
      UNION ALL SELECT 'leaves', leaves, 25, '>=', leaves >= 25 FROM readout
      UNION ALL SELECT 'rounds', whole_rounds, 5, '==', whole_rounds = 5 FROM readout)
    """

    def rules(spark, d):
        row, size = read(spark, d)
        text = units(spark, d).where("modality = 'text'").count()
        return readout.checks(row, [("distinct coordinates", F.col("distinct_coordinates"), F.least(F.lit(size), F.col("total")), ">="), ("text blocks", F.col("text_blocks"), F.lit(text), "=="), ("leaves", F.col("leaves"), F.lit(25), ">="), ("rounds", F.col("whole_rounds"), F.lit(5), "=="), ("not asked", F.col("total"), F.lit(None), "==")])

    @q("rule_checks", rules_sql + "SELECT * FROM rules")
    def rule_checks(spark, d):
        return rules(spark, d)

    @q("rule_mismatch", rules_sql + "SELECT bool_and(ok) AS within_rule, string_agg(label || ' ' || measured || ', expected ' || relation || ' ' || expected, '; ' ORDER BY label) FILTER (NOT ok) AS message FROM rules")
    def rule_mismatch(spark, d):
        return readout.mismatch(rules(spark, d))

    @reg.query("plan_exact")
    def plan_exact(spark, d):
        """The plan in the exact mode, tested against golden values."""
        own = units(spark, d)
        size = own.count()
        rows = plans.with_units(plans.indices(spark, CYCLES * size, size), plans.cycle_order_exact(spark, size, CYCLES, SEED, FP), own)
        return plans.free_draws_exact(rows.select("plan_index", "cycle", "position", "unit_index", "modality"), [("language", ("English", "Deutsch")), ("style", ("plain", "warm", "terse"))], SEED, FP)
