"""Requests, guards, pictures and run bookkeeping over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom import run as runs
from gridloom.functions import hashing
from gridloom.operators import attempts, bank, images, messages, records
from gridloom.operators.ordering import running
from gridloom.plans import space as spaces
from gridloom.registry import Registry
from gridloom.session import table
from gridloom.streaming import rounds

#: Pages as files: the host is the domain, pages whose address holds a digit 7 lie one folder deeper.
_FILES = "WITH f AS (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS domain, regexp_extract(url, '^https?://([^/]+)', 1) || CASE WHEN contains(url, '7') THEN '/deep/' ELSE '/' END || regexp_replace(url, '^.*/', '') || '_' || page_id || '.jpg' AS path FROM pages)"


def files(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages")
    domain = F.regexp_extract("url", r"^https?://([^/]+)", 1)
    return p.select("page_id", domain.alias("domain"), F.concat(domain, F.when(F.col("url").contains("7"), "/deep/").otherwise("/"), F.regexp_replace("url", "^.*/", ""), F.lit("_"), F.col("page_id").cast("string"), F.lit(".jpg")).alias("path"))


_SAID = "WITH m AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, CASE WHEN conv_id % 3 = 0 AND turn = 0 THEN 'data:image/png;base64,' || conv_id END AS picture FROM conversations)"
_JSON = """CASE WHEN picture IS NULL THEN '{"role":"user","content":' || to_json(text) || '}' ELSE '{"role":"user","content":[{"type":"image_url","image_url":{"url":"' || picture || '"}},{"type":"text","text":' || to_json(text) || '}]}' END"""


def said(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    return own.withColumn("picture", F.when((F.col("conv_id") % 3 == 0) & (F.col("turn") == 0), F.concat(F.lit("data:image/png;base64,"), F.col("conv_id").cast("string"))))


#: Rows of a plan with a domain that some lack: documents, the source standing for the domain.
_PLAN = "WITH p AS (SELECT doc_id AS id, lang AS language, CASE WHEN doc_id % 4 != 0 THEN source END AS visual_domain, CASE WHEN doc_id % 3 != 0 THEN 'topic ' || lang END AS knowledge_domain FROM documents), gone AS (SELECT DISTINCT visual_domain FROM p WHERE visual_domain LIKE 'src1%')"


def plan(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    i = F.col("doc_id")
    own = table(spark, d, "documents").select(i.alias("id"), F.col("lang").alias("language"), F.when(i % 4 != 0, F.col("source")).alias("visual_domain"), F.when(i % 3 != 0, F.concat(F.lit("topic "), "lang")).alias("knowledge_domain"))
    return own, own.where(F.col("visual_domain").startswith("src1")).select("visual_domain").distinct()


class Counting:
    """A client that says how long its request was."""

    def chat(self, system, user, picture=None):
        return f"{system} of {len(user)} characters"


def register(reg: Registry) -> None:
    q = reg.query

    @q("turn_rounds", """WITH RECURSIVE c AS (SELECT conv_id, count(*) AS k, coalesce(min({'t': turn, 'x': coalesce(text, '')}) FILTER (role = 'user').x, '') AS ask, min({'t': turn, 'x': coalesce(text, '')}) FILTER (role = 'system').x AS system FROM conversations GROUP BY conv_id),
      r AS (SELECT conv_id, 2 * (k % 3) + 1 AS n, 0 AS t, ask, system AS said FROM c UNION ALL SELECT conv_id, n, t + 1, ask, concat_ws(chr(10), said, CASE WHEN t % 2 = 0 THEN 'user' ELSE 'assistant' END || ' turn of ' || length(concat_ws(chr(10), ask, said)) || ' characters') FROM r WHERE t < n)
      SELECT conv_id::VARCHAR AS id, said, 'answer of ' || length(said) || ' characters' AS answer FROM r WHERE t = n""")
    def turn_rounds(spark, d):
        """Conversations that open like those of the table, made in rounds of turns."""
        first = lambda role: F.min(F.when(F.col("role") == role, F.struct("turn", F.coalesce("text", F.lit("")).alias("x"))))["x"]
        specs = table(spark, d, "conversations").groupBy(F.col("conv_id").alias("id")).agg((2 * (F.count(F.lit(1)) % 3) + 1).alias("n_turns"), first("system").alias("system"), F.coalesce(first("user"), F.lit("")).alias("ask"))
        made = rounds.converse(specs, Counting, spark.sparkContext.defaultParallelism, 2)
        return made.select("id", F.array_join("contents", "\n").alias("said"), "answer")

    @q("shared_backpressure", """WITH e AS (SELECT *, sum((event_type = 'purchase')::INT) OVER (ORDER BY ts, event_id) AS island FROM events), r AS (SELECT island, count(*) FILTER (event_type = 'error') AS n FROM e GROUP BY ALL)
      SELECT sum(n // 3)::BIGINT AS cooldowns, arg_max(n % 3, island) AS streak FROM r""")
    def shared(spark, d):
        """One endpoint's streak over the outcomes of all its users."""
        return attempts.endpoint_streak(table(spark, d, "events"), ["ts", "event_id"], F.col("event_type") == "purchase", F.col("event_type") == "error", 3)

    @q("tree_digest", """WITH l0 AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS i, sha256(o_orderkey || '|' || o_custkey || '|' || o_orderstatus) AS h FROM orders),
      """ + ", ".join(f"l{k} AS (SELECT i // 1024 AS i, sha256(string_agg(h, '' ORDER BY l{k - 1}.i)) AS h FROM l{k - 1} GROUP BY l{k - 1}.i // 1024)" for k in range(1, 5)) + """
      SELECT (SELECT count(*) FROM orders) AS n, sha256('tree-sha256/v1' || chr(10) || 'orders' || chr(10) || (SELECT count(*) FROM orders) || chr(10) || (SELECT h FROM l4)) AS digest""")
    def tree(spark, d):
        rows = running(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_orderkey"])
        return hashing.tree_digest(rows, "before", F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus"), "orders")

    @q("bank_contents", "SELECT count(*) AS records, concat_ws(':', 'sum-sha256/v1', " + ", ".join(f"coalesce(sum(('0x' || substr(sha256(text), {15 * i + 1}, 15))::BIGINT), 0)::VARCHAR" for i in range(4)) + ") AS digest FROM documents")
    def contents(spark, d):
        return bank.contents(table(spark, d, "documents"), "text")

    @q("multimodal_messages", _SAID + f" SELECT conv_id, turn, {_JSON} AS message FROM m WHERE role = 'user'")
    def multimodal(spark, d):
        return said(spark, d).where("role = 'user'").select("conv_id", "turn", messages.user_message(F.col("text"), F.col("picture")).alias("message"))

    @q("chat_payloads", _SAID + f""" SELECT conv_id, '{{"model":"m-1","messages":[' || string_agg({_JSON}, ',' ORDER BY turn, text) || '],"temperature":0.7,"stream":true' || CASE WHEN conv_id % 2 = 0 THEN ',"max_tokens":' || (conv_id % 512 + 1) ELSE '' END || ',"chat_template_kwargs":{{"enable_thinking":false}}}}' AS body FROM m WHERE role = 'user' GROUP BY conv_id""")
    def payloads(spark, d):
        own = said(spark, d).where("role = 'user'").select("conv_id", F.struct("turn", "text", messages.user_message(F.col("text"), F.col("picture")).alias("m")).alias("x"))
        each = own.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["m"]).alias("m"))
        return each.select("conv_id", messages.payload("m-1", F.col("m"), 0.7, False, F.when(F.col("conv_id") % 2 == 0, F.col("conv_id") % 512 + 1)).alias("body"))

    @q("endpoint_addresses", "SELECT page_id, rtrim(url || repeat('/', (page_id % 3)::INT), '/') || '/chat/completions' AS address FROM pages")
    def addresses(spark, d):
        return table(spark, d, "pages").select("page_id", messages.address(F.concat("url", F.expr("repeat('/', cast(page_id % 3 as int))"))).alias("address"))

    @q("one_shot_prompts", _PLAN + " SELECT id, 'Play a real user. Write one user message in ' || coalesce(language, 'English') || ' about ' || coalesce(knowledge_domain, 'general') || '; the task is qa, the style single_turn. Give the message only.' AS ask, 'Answer the user''s question with care.' AS answer FROM p")
    def one_shot(spark, d):
        own = plan(spark, d)[0]
        return own.select("id", messages.one_shot({"language": F.col("language"), "knowledge_domain": F.col("knowledge_domain")}).alias("p")).select("id", "p.*")

    @q("in_flight_guard", """WITH c AS (SELECT conv_id, turn, role, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n, list(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS h, first_value(role) OVER w AS r0 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
      s AS (SELECT conv_id, k - 1 AS turn_index, h, n - (r0 = 'system')::INT AS m, k - 1 - (r0 = 'system')::INT AS place, (r0 = 'system')::INT AS lead FROM c),
      e AS (SELECT *, list_transform(range(m), lambda i: CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END) AS spec, list_aggregate(list_transform(h, lambda r: CASE r WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END), 'string_agg', '') AS code FROM s WHERE place >= 0)
      SELECT conv_id, turn_index, CASE WHEN len(h) - lead != place + 1 THEN 'history_not_advanced' WHEN place = m - 1 AND (NOT regexp_full_match(code, 's?u(au)*') OR list_filter(h, lambda r: r != 'system') != spec) THEN 'role_mismatch' END AS reason FROM e""")
    def in_flight(spark, d):
        w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
        c = table(spark, d, "conversations").select("conv_id", (F.row_number().over(w) - 1).cast("long").alias("turn_index"), F.count(F.lit(1)).over(Window.partitionBy("conv_id")).alias("n"), F.collect_list("role").over(w).alias("h"))
        lead = F.when(F.get("h", F.lit(0)) == "system", 1).otherwise(0)
        spec = F.transform(F.sequence(F.lit(0), (F.col("n") - lead - 1).cast("int")), lambda i: F.when(i % 2 == 0, "user").otherwise("assistant"))
        at = (F.col("turn_index") - lead).cast("int")
        return c.where((at >= 0) & (F.col("n") > lead)).select("conv_id", "turn_index", messages.guard(spec, F.col("h"), at).alias("reason"))

    @q("prompt_signatures", _PLAN + """ SELECT language, knowledge_domain, visual_domain, count(*) AS n, '{"language":' || to_json(language) || ',"knowledge_domain":' || coalesce(to_json(knowledge_domain), 'null') || ',"capability":null,"conversation_type":null,"system_prompt_mode":null,"response_style":null,"output_format":null,"difficulty":null,"context_length":null,"input_condition":null,"answer_mode":null,"visual_domain":' || coalesce(to_json(visual_domain), 'null') || '}' AS signature FROM p GROUP BY ALL""")
    def signatures(spark, d):
        own = plan(spark, d)[0]
        s = messages.signature({a: F.col(a) for a in ("language", "knowledge_domain", "visual_domain")})
        return own.withColumn("s", s).groupBy("s", "language", "knowledge_domain", "visual_domain").agg(F.count(F.lit(1)).alias("n")).select("language", "knowledge_domain", "visual_domain", "n", F.to_json("s", {"ignoreNullFields": "false"}).alias("signature"))

    @q("effective_projection", _PLAN + " SELECT count(DISTINCT (language, visual_domain)) AS projections, count(DISTINCT (language, knowledge_domain, visual_domain)) AS signatures, count(*) AS n FROM p")
    def projection(spark, d):
        axes = messages.effective(["language", "kind", "visual_domain"])
        return plan(spark, d)[0].agg(F.count_distinct(F.struct(*axes)).alias("projections"), F.count_distinct(messages.signature({a: F.col(a) for a in ("language", "knowledge_domain", "visual_domain")})).alias("signatures"), F.count(F.lit(1)).alias("n"))

    @q("coordinate_labels", _PLAN + " SELECT id, concat_ws(', ', 'knowledge_domain=''' || knowledge_domain || '''', 'language=''' || language || '''', 'visual_domain=''' || visual_domain || '''') AS label FROM p")
    def labels(spark, d):
        return plan(spark, d)[0].select("id", messages.label({a: F.col(a) for a in ("language", "visual_domain", "knowledge_domain")}).alias("label"))

    @q("skip_unserved", _PLAN + " SELECT visual_domain, count(*) AS n FROM p WHERE visual_domain IS NULL OR visual_domain NOT IN (SELECT visual_domain FROM gone) GROUP BY ALL")
    def skipped(spark, d):
        return images.served(*plan(spark, d)).groupBy("visual_domain").agg(F.count(F.lit(1)).alias("n"))

    @q("missing_picture_refusal", _PLAN + ", e AS (SELECT visual_domain AS domain, count(*) AS n FROM p WHERE visual_domain IN (SELECT visual_domain FROM gone) GROUP BY ALL) SELECT 'pictures has no picture for ' || count(*) || ' domains:' || chr(10) || string_agg('  - ' || domain || ': no picture in pictures/' || domain || ' (' || n || ' rows)', chr(10) ORDER BY '  - ' || domain || ': no picture in pictures/' || domain || ' (' || n || ' rows)') || chr(10) || sum(n) || ' of 100 planned rows need one. Put in a file (gif, jpeg, jpg, png, webp) or let such rows be skipped.' AS message FROM e")
    def refused(spark, d):
        own, gone = plan(spark, d)
        return images.refusal(own.join(gone, "visual_domain", "left_semi").select(F.col("visual_domain").alias("domain"), "id"), "pictures", 100)

    @q("resolution_merge", _FILES + """, r AS (SELECT page_id % 4 AS cycle, domain, list(page_id ORDER BY page_id) AS missing, count(*) AS candidates, sum(page_id % 5) AS pool, bool_or(page_id % 50 = 0) AS fallback FROM f GROUP BY ALL)
      SELECT domain, array_to_string(flatten(list(missing ORDER BY cycle)), ',') AS missing, max(pool)::BIGINT AS pool, arg_max(candidates, cycle) AS candidates, bool_or(fallback) AS fallback, min(cycle) AS cycle FROM r GROUP BY domain""")
    def resolutions(spark, d):
        i = F.col("page_id")
        r = files(spark, d).groupBy((i % 4).alias("cycle"), "domain").agg(F.sort_array(F.collect_list(i)).alias("missing"), F.count(F.lit(1)).alias("candidates"), F.sum(i % 5).alias("pool"), F.bool_or(i % 50 == 0).alias("fallback"))
        return images.merged(r).withColumn("missing", F.array_join(F.transform("missing", lambda x: x.cast("string")), ","))

    @q("picture_subset", _FILES + " SELECT path FROM f ORDER BY sha256('7:' || path), path LIMIT 100")
    def subset(spark, d):
        return images.sample(files(spark, d).select("path"), 100, 7)

    @q("domain_children", _FILES + ", top AS (SELECT domain FROM f GROUP BY domain ORDER BY count(*) DESC, domain LIMIT 1) SELECT page_id, path FROM f WHERE NOT contains(path, '/deep/') AND domain = (SELECT domain FROM top)")
    def children(spark, d):
        own = files(spark, d)
        top = own.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "domain").first()
        return images.children(own, top["domain"] if top else "").select("page_id", "path")

    @q("pool_order", _FILES + " SELECT path, row_number() OVER (ORDER BY string_split(path, '/')) - 1 AS slot, count(*) OVER () AS n FROM f")
    def pool(spark, d):
        return images.pool(files(spark, d)).select("path", "slot", "n")

    @q("copy_targets", _FILES + r"""SELECT path, 'images/' || regexp_extract(path, '[^_/]*$') AS base, k, CASE WHEN k = 0 THEN 'images/' || name ELSE 'images/' || stem || '_' || k || '.jpg' END AS target FROM (
      SELECT path, name, regexp_replace(name, '\.jpg$', '') AS stem, row_number() OVER (PARTITION BY name ORDER BY path) - 1 + (name = 'p0.jpg')::INT AS k FROM (SELECT domain || '/' || page_id || '/p' || (page_id % 40) || '.jpg' AS path, 'p' || (page_id % 40) || '.jpg' AS name FROM f))""".replace("SELECT path, 'images/' || regexp_extract(path, '[^_/]*$') AS base, k,", " SELECT path,"))
    def targets(spark, d):
        own = files(spark, d).select(F.concat("domain", F.lit("/"), F.col("page_id").cast("string"), F.lit("/p"), (F.col("page_id") % 40).cast("string"), F.lit(".jpg")).alias("path"))
        taken = spark.range(1).select(F.lit("images/p0.jpg").alias("target"))
        return images.copy_targets(own, taken, force=True).select("path", "target")

    @q("relative_paths", r"SELECT page_id, CASE WHEN contains('/out/images/' || url, '/images/') THEN 'images/' || regexp_replace('/out/images/' || url, '^.*/images/', '') END AS path FROM pages")
    def relative(spark, d):
        return table(spark, d, "pages").select("page_id", records.relative_image(F.concat(F.lit("/out/images/"), "url")).alias("path"))

    @q("five_tallies", "WITH r AS (SELECT CASE WHEN doc_id % 3 = 0 THEN lang WHEN doc_id % 5 = 0 THEN 'seen ' || lang ELSE 'unknown' END AS domain, lang AS language, CASE WHEN doc_id % 2 = 0 THEN 'qa' WHEN doc_id % 7 = 0 THEN 'old' ELSE 'unknown' END AS capability, 'unknown' AS system_prompt_mode, coalesce(source, 'unknown') AS data_source FROM documents) " + " UNION ALL ".join(f"SELECT '{c}' AS dimension, {c} AS value, count(*) AS n FROM r GROUP BY ALL" for c in ("domain", "language", "capability", "system_prompt_mode", "data_source")))
    def five(spark, d):
        i = F.col("doc_id")
        meta = F.create_map(F.lit("knowledge_domain"), F.when(i % 3 == 0, F.col("lang")), F.lit("visual_domain"), F.when(i % 5 == 0, F.concat(F.lit("seen "), "lang")), F.lit("language"), F.col("lang"), F.lit("capability"), F.when(i % 2 == 0, "qa"), F.lit("question_type"), F.when(i % 7 == 0, "old"))
        own = table(spark, d, "documents").withColumn("meta", meta)
        parts = bank.breakdown(F.col("meta"), F.col("source"))
        return bank.tallies(own.select(*(c.alias(n) for n, c in parts.items())), list(parts))

    @q("short_run", "WITH a AS (SELECT CASE WHEN event_type = 'view' THEN 'timeout' ELSE 'empty_content' END AS reason, count(*) AS n FROM events WHERE event_type IN ('view', 'error') GROUP BY 1) SELECT (SELECT count(*) FROM documents) AS planned, (SELECT count(DISTINCT doc_id) FROM labels) AS written, (SELECT count(*) FROM documents) - (SELECT count(DISTINCT doc_id) FROM labels) AS short, (SELECT string_agg(reason || '=' || n, ', ' ORDER BY reason || '=' || n) FROM a) AS reasons")
    def short(spark, d):
        lost = table(spark, d, "events").where("event_type IN ('view', 'error')").select(F.when(F.col("event_type") == "view", "timeout").otherwise("empty_content").alias("reason"))
        return bank.short_run(table(spark, d, "documents"), table(spark, d, "labels").select(F.col("doc_id").alias("id")), lost)

    ids_sql = """WITH l AS (SELECT event_id, CASE WHEN event_id % 17 = 0 THEN '{"id": "x' WHEN event_id % 5 = 0 THEN '{"id": ' || user_id || '}' WHEN event_id % 7 = 0 THEN '{"other": 1}' ELSE '{"id": "u' || user_id || '"}' END AS value FROM events)"""

    def id_lines(spark, d):
        i, u = F.col("event_id"), F.col("user_id").cast("string")
        return table(spark, d, "events").select("event_id", F.when(i % 17 == 0, '{"id": "x').when(i % 5 == 0, F.concat(F.lit('{"id": '), u, F.lit("}"))).when(i % 7 == 0, '{"other": 1}').otherwise(F.concat(F.lit('{"id": "u'), u, F.lit('"}'))).alias("value"))

    @q("unique_string_ids", ids_sql + " SELECT count(*) FILTER (json_valid(value)) AS records, count(DISTINCT CASE WHEN json_valid(value) AND json_type(value, '$.id') = 'VARCHAR' THEN value->>'$.id' END) AS unique_ids FROM l")
    def unique(spark, d):
        return bank.unique_ids(id_lines(spark, d))

    @q("damage_report", ids_sql + " SELECT 'bank' AS path, event_id AS number, length(value) AS length, value AS line FROM l WHERE NOT json_valid(value)")
    def damage(spark, d):
        return bank.numbered_damage(id_lines(spark, d).select(F.lit("bank").alias("path"), F.col("event_id").alias("number"), "value")).withColumn("length", F.col("length").cast("long"))

    @q("rewrite_offenders", "SELECT doc_id AS id, CASE WHEN doc_id % 11 = 0 THEN 'invalid_shape_skipped' WHEN doc_id % 13 = 0 THEN 'invalid_data_source_skipped' ELSE 'invalid_image_bookkeeping_skipped' END AS outcome FROM documents WHERE doc_id % 11 = 0 OR doc_id % 13 = 0 OR doc_id % 17 = 0")
    def offenders(spark, d):
        i = F.col("doc_id")
        return bank.offenders(table(spark, d, "documents").select(i.alias("id"), (i % 11 != 0).alias("shape_ok"), (i % 13 != 0).alias("source_ok"), (i % 17 != 0).alias("images_ok")))

    @q("plan_identities", """WITH k AS (SELECT doc_id, doc_id % 6 AS v FROM documents)
      SELECT doc_id, CASE WHEN v IN (0, 1) THEN v + 1 END AS version, CASE v WHEN 0 THEN '' WHEN 1 THEN 'exact' END AS sampling, CASE v WHEN 0 THEN 0 WHEN 1 THEN 7 END::BIGINT AS seed, CASE WHEN v = 1 THEN doc_id END AS count, CASE WHEN v IN (0, 1) THEN doc_id + 10 END AS plan_size, CASE WHEN v IN (0, 1) THEN 'd' || doc_id END AS digest FROM k""")
    def identities(spark, d):
        i, v = F.col("doc_id").cast("string"), F.col("doc_id") % 6
        known = F.concat(F.lit('"algorithm":"a","plan_size":'), (F.col("doc_id") + 10).cast("string"), F.lit(',"digest":"d'), i, F.lit('"'))
        whole = lambda c: F.concat(F.lit('{"plan_identity":{'), c, F.lit("}}"))
        body = (
            F.when(v == 0, whole(F.concat(known, F.lit(',"version":1'))))
            .when(v == 1, whole(F.concat(known, F.lit(',"version":2,"sampling":"exact","seed":7,"count":'), i)))
            .when(v == 2, whole(F.concat(known, F.lit(',"version":"2"'))))
            .when(v == 3, whole(F.concat(F.lit('"algorithm":"b",'), F.regexp_replace(known, '^"algorithm":"a",', ""), F.lit(',"version":2'))))
            .when(v == 4, F.lit('{"status":"finished"}'))
            .otherwise(F.lit("not json"))
        )
        found = table(spark, d, "documents").select("doc_id", bank.identity(body, "a").alias("p"))
        return found.select("doc_id", *(F.col(f"p.{c}").alias(c) for c in ("version", "sampling", "seed", "count", "plan_size", "digest")))

    @q("run_folders", "SELECT doc_id, CASE WHEN ends_with(base, '_smoke') THEN base ELSE base || '_smoke' END AS folder FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'outputs/run_' || doc_id WHEN doc_id % 3 = 1 THEN source ELSE source || '_smoke' END AS base FROM documents)")
    def folders(spark, d):
        i = F.col("doc_id")
        named = F.when(i % 3 == 0, "").when(i % 3 == 1, F.concat("source", F.lit("/"))).otherwise(F.concat("source", F.lit("_smoke")))
        return table(spark, d, "documents").select("doc_id", runs.run_folder(named, i.cast("string"), True).alias("folder"))

    @q("seed_hashes", """SELECT o_orderkey, sha256('["7","tables","free","' || o_orderkey || '"]') AS hash FROM orders""")
    def seeds(spark, d):
        return table(spark, d, "orders").select("o_orderkey", hashing.seed_hash(F.lit(7), F.lit("tables"), F.lit("free"), F.col("o_orderkey")).alias("hash"))

    rules_sql = """WITH v AS (SELECT DISTINCT o_orderstatus AS value FROM orders), s AS (SELECT DISTINCT o_orderpriority AS value FROM orders),
      r AS (SELECT 0 AS pos, value AS source, ['*'] AS allowed FROM s UNION ALL SELECT 1, o_orderpriority, list(DISTINCT o_orderstatus) FROM orders WHERE o_orderpriority < '3' AND o_orderstatus != 'P' GROUP BY o_orderpriority UNION ALL SELECT 2, 'odd', ['F', 'none', '*'])"""

    def rules(spark, d):
        o = table(spark, d, "orders")
        v, s = o.select(F.col("o_orderstatus").alias("value")).distinct(), o.select(F.col("o_orderpriority").alias("value")).distinct()
        r = s.select(F.lit(0).alias("pos"), F.col("value").alias("source"), F.array(F.lit("*")).alias("allowed"))
        r = r.unionAll(o.where("o_orderpriority < '3' AND o_orderstatus <> 'P'").groupBy("o_orderpriority").agg(F.collect_set("o_orderstatus").alias("a")).select(F.lit(1), "o_orderpriority", "a"))
        return r.unionAll(spark.range(1).select(F.lit(2), F.lit("odd"), F.array(F.lit("F"), F.lit("none"), F.lit("*")))), s, v

    @q("wildcard_rules", rules_sql + " SELECT source, unnest(CASE WHEN a = ['*'] THEN (SELECT list(value) FROM v) ELSE list_distinct(a) END) AS \"to\" FROM (SELECT source, arg_max(allowed, pos) AS a FROM r WHERE source != 'odd' GROUP BY source)")
    def wildcards(spark, d):
        r, _, v = rules(spark, d)
        return spaces.expanded(r.where("source <> 'odd'"), v)

    @q("rule_errors", rules_sql + " SELECT DISTINCT 'unknown source' AS problem, source AS value FROM r WHERE source NOT IN (SELECT value FROM s) UNION ALL SELECT DISTINCT 'unknown value', a FROM (SELECT unnest(allowed) AS a FROM r) WHERE a != '*' AND a NOT IN (SELECT value FROM v) UNION ALL SELECT 'no rule', '9-NEW'")
    def rule_errors(spark, d):
        r, s, v = rules(spark, d)
        return spaces.rule_errors(r, s.unionAll(spark.range(1).select(F.lit("9-NEW"))), v)

    @q("role_errors", "WITH a AS (SELECT DISTINCT o_orderpriority AS axis FROM orders), r AS (SELECT axis FROM a WHERE axis < '3' UNION ALL SELECT 'odd'), f AS (SELECT axis FROM a WHERE axis > '2' AND axis < '4') SELECT 'without a role' AS problem, axis FROM a WHERE axis NOT IN (SELECT axis FROM r) AND axis NOT IN (SELECT axis FROM f) AND axis != '5-LOW' UNION ALL SELECT 'unknown', axis FROM r WHERE axis NOT IN (SELECT axis FROM a) UNION ALL SELECT 'two roles', axis FROM r WHERE axis IN (SELECT axis FROM f)")
    def role_errors(spark, d):
        axes = table(spark, d, "orders").select(F.col("o_orderpriority").alias("axis")).distinct()
        return spaces.role_errors(axes, axes.where("axis < '3'").unionAll(spark.range(1).select(F.lit("odd"))), axes.where("axis > '2' AND axis < '4'"), "5-LOW")

    @q("expected_roles", "SELECT conv_id, string_agg(CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END, ',' ORDER BY i) AS roles FROM (SELECT conv_id, unnest(range(2 * count(*) - 1)) AS i FROM conversations GROUP BY conv_id) GROUP BY conv_id")
    def expected(spark, d):
        from gridloom.plans import plan as plans

        rows = table(spark, d, "conversations").groupBy("conv_id").agg((2 * F.count(F.lit(1)) - 1).alias("k"))
        return rows.select("conv_id", F.array_join(F.transform(plans.turns(F.col("k")), lambda t: t["role"]), ",").alias("roles"))

    @q("spec_turns", "SELECT conv_id, regexp_full_match(string_agg(CASE role WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' WHEN 'system' THEN 's' ELSE 'x' END, '' ORDER BY turn), 'u(au)*') AS ok FROM conversations GROUP BY conv_id")
    def spec_turns(spark, d):
        rows = table(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]).alias("roles"))
        return rows.select("conv_id", records.turns_ok(records.shape_code(F.col("roles"))).alias("ok"))

    @q("record_lines", """SELECT doc_id, '{"id":"r' || doc_id || '","source":"gridloom","data_source":"text","schema_version":"5.0.0","messages":[{"role":"user","content":' || to_json(text) || '}],"targets":[{"id":"t0","output":{"content":' || to_json(source) || ',"reasoning":' || CASE WHEN doc_id % 2 = 0 THEN to_json(lang) ELSE 'null' END || '}}],"anchor_meta":{"lang":' || to_json(lang) || '},"input_generator_model":"a","teacher_id":"b"}' AS line FROM documents""")
    def lines(spark, d):
        own = table(spark, d, "documents")
        said_ = F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))
        meta = F.create_map(F.lit("lang"), F.col("lang"), F.lit("none"), F.lit(None).cast("string"))
        return own.select("doc_id", records.record_json(F.concat(F.lit("r"), F.col("doc_id").cast("string")), F.lit("text"), said_, F.col("source"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise(F.lit(" ")), meta, F.lit("a"), F.lit("b")).alias("line"))

    @q("picture_parts", """SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '[{"role":"system","content":[{"type":"text","text":"s"}]},' ELSE '[' END || '{"role":"user","content":[' || CASE WHEN page_id % 3 != 0 THEN '{"type":"image","image":"images/' || page_id || '.jpg"}' ELSE '{"type":"image_url","image":"data:x"}' END || ',{"type":"text","text":"t"}]}]' AS messages FROM pages""")
    def parts(spark, d):
        part = lambda kind, text, image: F.struct(F.lit(kind).alias("type"), F.lit(text).cast("string").alias("text"), F.lit(image).cast("string").alias("image"))
        message = lambda role, *own: F.struct(F.lit(role).alias("role"), F.array(*own).alias("content"))
        user = message("user", part("image_url", None, "data:x"), part("text", "t", None))
        both = F.when(F.col("page_id") % 2 == 0, F.array(message("system", part("text", "s", None)), user)).otherwise(F.array(user))
        owns = F.array(F.when(F.col("page_id") % 3 != 0, F.concat(F.lit("/run/images/"), F.col("page_id").cast("string"), F.lit(".jpg"))))
        return table(spark, d, "pages").select("page_id", F.to_json(records.rewrite_parts(both, owns)).alias("messages"))
