"""Records, banks, pictures, attempts and wording over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions import wording
from gridloom.operators import attempts, bank, images, records
from gridloom.plans import plan as plans
from gridloom.registry import Registry
from gridloom.session import shared_folder, table
from gridloom.sources import config
from gridloom.sources import lines as sources
from gridloom.streaming import generate

#: Wording of our own for two axes.
SENTENCES = {"response_style": {"1-URGENT": "Be brief.", "2-HIGH": "Be direct.", "3-MEDIUM": "Be friendly.", "4-NOT SPECIFIED": "Be neutral.", "5-LOW": "Take your time."}, "difficulty": {"O": "Keep it easy.", "F": "Keep it hard.", "P": "Mix both."}}
TEMPLATE = "Write for {language} readers who know {domain}; the task is {capability} {{exactly}}."
KEYS = ("api_key", "apiKey", "API-KEY", "max_tokens", "first_token_timeout", "clientSecret", "hf_token", "tokens", "apikey", "timeoutSecret", "author", "auth_mode", "keyboard", "DB_PASSWORD", "passwd", "bearer-x")


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, roles in turn order, texts in turn order."""
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text")))).alias("m"))
    return rows.select("conv_id", F.transform("m", lambda x: x["role"]).alias("roles"), F.transform("m", lambda x: x["text"]).alias("texts"))


_CODE = "CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END"
_CHATS = f"WITH c AS (SELECT conv_id, string_agg({_CODE}, '' ORDER BY turn) AS code, list(role ORDER BY turn) AS roles FROM conversations GROUP BY conv_id), b AS (SELECT *, regexp_replace(code, '^s', '') AS body FROM c)"
_PAGES = "WITH p AS (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS domain, regexp_replace(url, '^.*/', '') AS name, url, regexp_extract_all(html, '<p>') AS parts, regexp_extract_all(html, '<b>') AS bold FROM pages)"


def pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as stand-ins for pictures: the host is the folder, the rest the name; own: pages with bold text, of which some hosts have none."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("domain"), F.regexp_replace("url", "^.*/", "").alias("name"), F.col("url").alias("picture"), F.col("html").contains("<b>").alias("own"))


def sse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as streamed lines: one answer per user, a token for each event; some lines are damaged, the last ends the answer."""
    e = table(spark, sf_dir, "events").withColumn("seq", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("user_id")))
    delta = F.when(F.col("event_type") == "view", F.to_json(F.struct(F.col("event_type").alias("reasoning")))).otherwise(F.to_json(F.struct(F.concat(F.col("event_type"), F.lit(" ")).alias("content"))))
    finish = F.when(F.col("event_type") == "purchase", '"stop"').when(F.col("event_type") == "error", '"length"').otherwise("null")
    body = F.concat(F.lit('{"choices":[{"delta":'), delta, F.lit(',"finish_reason":'), finish, F.lit("}]}"))
    line = F.when(F.col("seq") % 13 == 0, ": ping").when(F.col("seq") % 11 == 0, F.lit("data: {broken")).when(F.col("seq") == F.col("n"), "data: [DONE]").otherwise(F.concat(F.lit("data: "), body))
    return e.select("user_id", "seq", line.alias("line"))


_SSE = """
WITH e AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq, count(*) OVER (PARTITION BY user_id) AS n FROM events),
k AS (SELECT * FROM e WHERE seq % 13 != 0 AND seq % 11 != 0 AND seq < n),
d AS (SELECT DISTINCT user_id FROM e WHERE seq % 13 != 0 AND (seq < n OR seq % 11 = 0)),
a AS (SELECT d.user_id, coalesce(string_agg(event_type || ' ', '' ORDER BY seq) FILTER (event_type != 'view'), '') AS content,
             coalesce(string_agg(event_type, '' ORDER BY seq) FILTER (event_type = 'view'), '') AS reasoning,
             arg_max(CASE event_type WHEN 'purchase' THEN 'stop' ELSE 'length' END, seq) FILTER (event_type IN ('purchase', 'error')) AS finish
      FROM d LEFT JOIN k USING (user_id) GROUP BY d.user_id)
"""


class Echo:
    """A client without a network: answers from the prompt's length, failing now and then in each way."""

    def chat(self, system: str, user: str) -> str:
        n = len(user)
        if n % 29 == 0:
            raise TimeoutError
        if n % 31 == 0:
            raise ConnectionError
        return "" if n % 37 == 0 else f"{system} of {n} characters"


def register(reg: Registry) -> None:
    q = reg.query

    @q("message_shape", _CHATS + " SELECT conv_id, code, regexp_full_match(code, 's?u(au)*') AS ok FROM c")
    def message_shape(spark, d):
        code = records.shape_code(F.col("roles"))
        return chats(spark, d).select("conv_id", code.alias("code"), records.shape_ok(code).alias("ok"))

    @q("shape_reasons", _CHATS + """
      , r AS (SELECT conv_id, code, roles, length(regexp_extract(code, '^s?(ua)*u?', 0)) AS fits FROM c)
      SELECT conv_id, CASE WHEN fits < length(code) THEN roles[fits + 1] || ' at ' || fits || ' in place of ' || CASE WHEN fits = 0 THEN 'system or user' WHEN substr(code, fits, 1) = 'u' THEN 'assistant' ELSE 'user' END
        WHEN code = '' THEN 'empty' WHEN NOT ends_with(code, 'u') THEN 'ends on ' || roles[-1] END AS reason FROM r""")
    def shape_reasons(spark, d):
        return chats(spark, d).select("conv_id", records.shape_reason(F.col("roles")).alias("reason"))

    @q("turn_counts", "SELECT role, CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 3 ELSE 7 END::BIGINT AS turns, count(*) AS n FROM conversations GROUP BY ALL")
    def turn_counts(spark, d):
        from gridloom.plans.space import turn_count

        n = F.when(F.col("role") == "system", turn_count(1)).when(F.col("role") == "user", turn_count(2)).otherwise(turn_count("multi"))
        return table(spark, d, "conversations").groupBy("role").agg(F.count(F.lit(1)).alias("n")).select("role", n.cast("long").alias("turns"), "n")

    @q("turn_arrays", "WITH n AS (SELECT conv_id, 2 * count(*) - 1 AS k FROM conversations GROUP BY ALL) SELECT conv_id, string_agg(i || (CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END) || (i = k - 1), ',' ORDER BY i) AS turns FROM n, LATERAL (SELECT unnest(range(k)) AS i) GROUP BY ALL")
    def turn_arrays(spark, d):
        rows = table(spark, d, "conversations").groupBy("conv_id").agg((2 * F.count(F.lit(1)) - 1).alias("k"))
        text = F.transform(plans.turns(F.col("k")), lambda t: F.concat(t["turn_index"].cast("string"), t["role"], t["is_final"].cast("string")))
        return rows.select("conv_id", F.array_join(text, ",").alias("turns"))

    outcomes_sql = _CHATS + """
      , k AS (SELECT 'r' || (conv_id % 97) AS id, conv_id, regexp_full_match(code, 's?u(au)*') AS shape, conv_id % 19 != 3 AS source, conv_id % 23 != 5 AS images FROM c),
      n AS (SELECT *, coalesce(sum((shape AND source AND images)::INT) OVER (PARTITION BY id ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k),
      o AS (SELECT conv_id, id, CASE WHEN NOT shape THEN 'invalid_shape_skipped' WHEN NOT source THEN 'invalid_data_source_skipped' WHEN NOT images THEN 'invalid_image_bookkeeping_skipped'
            WHEN before > 0 OR id IN (SELECT 'r' || doc_id FROM labels) THEN 'duplicate_skipped' ELSE 'appended' END AS outcome FROM n)"""

    def outcomes(spark, d):
        rows = chats(spark, d).select(F.concat(F.lit("r"), (F.col("conv_id") % 97).cast("string")).alias("id"), "conv_id", records.shape_ok(records.shape_code(F.col("roles"))).alias("shape_ok"), records.source_ok(F.when(F.col("conv_id") % 19 != 3, "text")).alias("source_ok"), records.images_ok(F.col("conv_id") % 23 == 5, F.lit(0)).alias("images_ok"))
        return bank.append_outcomes(rows, table(spark, d, "labels").select(F.concat(F.lit("r"), F.col("doc_id").cast("string")).alias("id")), ["conv_id"]).select("conv_id", "id", "outcome")

    @q("append_outcomes", outcomes_sql + " SELECT * FROM o")
    def append_outcomes(spark, d):
        return outcomes(spark, d)

    @q("outcome_counts", outcomes_sql + " SELECT outcome, count(*) AS n FROM o GROUP BY ALL")
    def outcome_counts(spark, d):
        return outcomes(spark, d).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))

    @q("dedup_first_wins", "SELECT min(doc_id) AS doc_id, sha256(text) AS sha FROM documents GROUP BY sha256(text)")
    def dedup(spark, d):
        rows = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))
        return bank.first_wins(rows, "sha", ["doc_id"])

    lines_sql = "WITH l AS (SELECT event_id, CASE WHEN event_id % 17 = 0 THEN substr(props, 1, length(props) - 1) WHEN event_id % 29 = 0 THEN '  ' WHEN event_id % 31 = 0 THEN '[1]' ELSE props END AS line FROM events)"

    def lines(spark, d):
        e, i = table(spark, d, "events"), F.col("event_id")
        return e.select("event_id", F.when(i % 17 == 0, F.expr("substr(props, 1, length(props) - 1)")).when(i % 29 == 0, "  ").when(i % 31 == 0, "[1]").otherwise(F.col("props")).alias("value"))

    @q("damaged_lines", lines_sql + " SELECT event_id, line FROM l WHERE trim(line) != '' AND (NOT json_valid(line) OR NOT starts_with(line, '{'))")
    def damaged(spark, d):
        return bank.parse_lines(lines(spark, d), "x string").where(F.col(bank.DAMAGED).isNotNull()).select("event_id", F.col(bank.DAMAGED).alias("line"))

    @q("bank_line_count", lines_sql + " SELECT count(*) FILTER (trim(line) != '' AND json_valid(line) AND starts_with(line, '{')) AS whole FROM l")
    def line_count(spark, d):
        return bank.whole(bank.parse_lines(lines(spark, d), "x string")).agg(F.count(F.lit(1)).alias("whole"))

    @q("bank_line_numbers", lines_sql + """, n AS (SELECT row_number() OVER (ORDER BY event_id) - 1 AS number, CASE WHEN event_id % 37 = 0 THEN props || props ELSE line END AS line FROM l JOIN events USING (event_id))
      SELECT number, length(line) AS length, line FROM n WHERE trim(line) != '' AND (NOT json_valid(line) OR NOT starts_with(line, '{'))""")
    def line_numbers(spark, d):
        """Damage in files written by the query, each line's number being its place over all files."""
        folder = f"{shared_folder(spark)}/bank-{uuid.uuid4().hex}"
        e = table(spark, d, "events").select("event_id", F.concat("props", "props").alias("glued"))
        own = lines(spark, d).join(e, "event_id").select("event_id", F.when(F.col("event_id") % 37 == 0, F.col("glued")).otherwise(F.col("value")).alias("value"))
        own.repartitionByRange("event_id").sortWithinPartitions("event_id").select("value").write.text(folder)
        found = sources.numbered(spark, folder).select("path", F.col("line").alias("number"), "value")
        return bank.numbered_damage(found).select("number", F.col("length").cast("long").alias("length"), "line")

    @q("bank_ids_read_on", "SELECT 'e' || event_id AS id FROM events WHERE event_id % 17 != 0")
    def ids_read_on(spark, d):
        """Ids of a bank that grows between two scans, lines cut short among them; the second reads new files only."""
        folder = f"{shared_folder(spark)}/bank-{uuid.uuid4().hex}"
        line = F.to_json(F.struct(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"), "event_type"))
        e = table(spark, d, "events").withColumn("value", F.when(F.col("event_id") % 17 == 0, F.expr("substr(props, 1, length(props) - 1)")).otherwise(line))
        first = F.col("event_type").eqNullSafe("purchase")
        for part in (first, ~first):
            e.where(part).select("value").write.mode("append").text(f"{folder}/lines")
            known = sources.known_ids(spark, f"{folder}/lines", f"{folder}/state")
        return known

    @q("bank_count_vs_unique", "SELECT count(*) AS records, count(DISTINCT l_orderkey) AS unique_ids FROM lineitem")
    def count_unique(spark, d):
        return table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("l_orderkey").alias("unique_ids"))

    def plan_and_bank(spark, d):
        docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang", "source")
        own = docs.where("id % 3 <> 0").select("id", F.when(F.col("id") % 7 != 0, F.col("lang")).alias("lang"), "source")
        return docs, own.unionByName(docs.select((F.col("id") + 10_000_000).alias("id"), "lang", "source").where("id % 5 = 0"))

    pb = "WITH p AS (SELECT doc_id AS id, lang, source FROM documents), b AS (SELECT id, CASE WHEN id % 7 != 0 THEN lang END AS lang, source FROM p WHERE id % 3 != 0 UNION ALL SELECT id + 10000000, lang, source FROM p WHERE (id + 10000000) % 5 = 0) "

    @q("resume_missing", pb + "SELECT id, lang, source FROM p WHERE id NOT IN (SELECT id FROM b)")
    def resume_missing(spark, d):
        return bank.missing(*plan_and_bank(spark, d))

    @q("resume_foreign", pb + "SELECT id, lang, source FROM b WHERE id NOT IN (SELECT id FROM p)")
    def resume_foreign(spark, d):
        return bank.foreign(*plan_and_bank(spark, d))

    @q("resume_mismatch", pb + "SELECT p.id FROM p JOIN b USING (id) WHERE p.lang IS DISTINCT FROM b.lang OR p.source IS DISTINCT FROM b.source")
    def resume_mismatch(spark, d):
        return bank.mismatched(*plan_and_bank(spark, d), ["lang", "source"])

    @q("pending_specs", pb + "SELECT source, count(*) AS pending FROM p WHERE id NOT IN (SELECT id FROM b) GROUP BY ALL")
    def pending(spark, d):
        return bank.missing(*plan_and_bank(spark, d)).groupBy("source").agg(F.count(F.lit(1)).alias("pending"))

    @q("effective_plan", pb + "SELECT p.* FROM p WHERE id IN (SELECT id FROM b) OR id IN (SELECT id FROM p WHERE id NOT IN (SELECT id FROM b) AND id % 2 = 0)")
    def effective(spark, d):
        plan, own = plan_and_bank(spark, d)
        return bank.owned(plan, own, bank.missing(plan, own).where("id % 2 = 0"))

    @q("missing_message", pb + ", m AS (SELECT 'id=' || lpad(id::VARCHAR, 9, '0') AS label FROM p WHERE id NOT IN (SELECT id FROM b)) SELECT (SELECT count(*) FROM m) AS n, (SELECT string_agg(label, ', ' ORDER BY label) FROM (SELECT label FROM m ORDER BY label LIMIT 20)) AS listed")
    def message(spark, d):
        rows = bank.missing(*plan_and_bank(spark, d)).select(F.format_string("id=%09d", "id").alias("label"))
        return bank.missing_message(rows, "label")

    @q("manifest_tallies", "WITH r AS (SELECT coalesce(lang, 'unknown') AS language, coalesce(source, 'unknown') AS data_source, coalesce(quality::VARCHAR, 'unknown') AS quality FROM documents LEFT JOIN labels USING (doc_id)) SELECT 'language' AS dimension, language AS value, count(*) AS n FROM r GROUP BY ALL UNION ALL SELECT 'data_source', data_source, count(*) FROM r GROUP BY ALL UNION ALL SELECT 'quality', quality, count(*) FROM r GROUP BY ALL")
    def tallies(spark, d):
        rows = table(spark, d, "documents").select("doc_id", F.col("lang").alias("language"), F.col("source").alias("data_source")).join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
        return bank.tallies(rows, ["language", "data_source", "quality"])

    @q("counter_delta", "WITH c AS (SELECT event_type, count(*) FILTER (event_id % 2 = 0) AS a, count(*) FILTER (event_id % 3 = 0 AND event_type != 'view') AS b FROM events GROUP BY ALL) SELECT event_type, b - a AS delta FROM c WHERE b != a")
    def delta(spark, d):
        e = table(spark, d, "events")
        n = lambda w: e.where(w).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
        return bank.counter_delta(n("event_id % 2 = 0"), n("event_id % 3 = 0 AND event_type <> 'view'"), "event_type", "n")

    @q("requirement_clause", "SELECT o_orderkey, 'Requirements: ' || CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SENTENCES["response_style"].items()) + " END || CASE o_orderstatus " + " ".join(f"WHEN '{k}' THEN ' {v}'" for k, v in SENTENCES["difficulty"].items()) + " END AS clause FROM orders")
    def requirement(spark, d):
        o = table(spark, d, "orders")
        return o.select("o_orderkey", wording.requirement(SENTENCES, {"response_style": F.col("o_orderpriority"), "difficulty": F.col("o_orderstatus")}).alias("clause"))

    @q("system_prompt_render", "SELECT doc_id, 'Write for ' || coalesce(lang, 'English') || ' readers who know ' || coalesce(source || '{x}', 'general') || '; the task is qa {exactly}.' AS prompt FROM documents")
    def render(spark, d):
        body = wording.validated_template(TEMPLATE, "template")
        rows = table(spark, d, "documents")
        return rows.select("doc_id", wording.rendered(body, {"language": F.col("lang"), "knowledge_domain": F.concat("source", F.lit("{x}"))}).alias("prompt"))

    @q("user_prompt", """WITH h AS (SELECT conv_id, string_agg(role || ': ' || coalesce(text, ''), chr(10) ORDER BY turn) AS h FROM conversations GROUP BY ALL)
      SELECT conv_id, 'You play a real user. Write a ' || CASE WHEN h IS NULL THEN '' ELSE 'follow-up ' END || 'user message in English on general that asks for qa, in a single_turn conversation. Give the message only.' AS system,
             CASE WHEN h IS NULL THEN 'Write the first user message.' ELSE 'So far:' || chr(10) || h || chr(10) || chr(10) || 'Write the next user message.' END AS user_text FROM h""")
    def user_prompt(spark, d):
        rows = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("content")))).alias("m"))
        asked = wording.user_prompt(F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))), {}, F.lit(""))
        return rows.select("conv_id", asked.alias("p")).select("conv_id", F.col("p.system").alias("system"), F.col("p.user").alias("user_text"))

    @q("routing_key", _PAGES + " SELECT page_id, CASE WHEN len(parts) > 6 THEN 'multi' ELSE 'text' END AS data_source FROM p")
    def routing(spark, d):
        rows = table(spark, d, "pages").select("page_id", F.transform(F.regexp_extract_all("html", F.lit("<p>"), F.lit(0)), lambda x, i: F.when(i >= 6, "image_url").otherwise("text")).alias("types"))
        return rows.select("page_id", records.data_source(F.col("types")).alias("data_source"))

    @q("image_bookkeeping", _PAGES + " SELECT page_id, len(parts)::BIGINT AS image_count, len(parts) > 0 AS has_image, (page_id % 5 = 0) = (len(parts) > 0) AS consistent FROM p")
    def bookkeeping(spark, d):
        rows = table(spark, d, "pages").select("page_id", F.regexp_count("html", F.lit("<p>")).cast("long").alias("image_count"))
        return rows.select("page_id", "image_count", (F.col("image_count") > 0).alias("has_image"), records.images_ok(F.col("page_id") % 5 == 0, F.col("image_count")).alias("consistent"))

    picks_sql = _PAGES + """
      , own AS (SELECT domain, url AS picture, row_number() OVER (PARTITION BY domain ORDER BY name, url) - 1 AS slot, count(*) OVER (PARTITION BY domain) AS n FROM p WHERE len(bold) > 0),
      pool AS (SELECT url AS picture, row_number() OVER (ORDER BY name, url) - 1 AS slot FROM p),
      want AS (SELECT domain, cycle, ('0x' || substr(sha256('7:' || domain), 1, 8))::BIGINT AS o FROM (SELECT DISTINCT domain FROM p), range(4) r(cycle)),
      k AS (SELECT w.*, c.n, (SELECT count(*) FROM pool) AS pn FROM want w LEFT JOIN (SELECT DISTINCT domain, n FROM own) c USING (domain)),
      picks AS (SELECT k.domain, k.cycle, CASE WHEN k.n IS NOT NULL THEN own.picture ELSE pool.picture END AS picture, k.n IS NULL AND pool.picture IS NOT NULL AS fallback
                FROM k LEFT JOIN own ON own.domain = k.domain AND own.slot = (o + cycle) % k.n LEFT JOIN pool ON k.n IS NULL AND pool.slot = (o + cycle) % pn)"""

    def picked(spark, d):
        from gridloom.functions.hashing import sha_number

        rows = pictures(spark, d)
        own = images.numbered(rows.where("own"), "domain", "name", "picture")
        pool = images.numbered(rows, None, "name", "picture")
        return images.picks(rows.select("domain").distinct(), own, pool, 4, sha_number(F.concat(F.lit("7:"), F.col("domain"))))

    @q("image_pick_rotation", picks_sql + " SELECT * FROM picks")
    def pick_rotation(spark, d):
        return picked(spark, d)

    @q("image_readout", picks_sql + " SELECT cycle, count(*) AS domains, count(picture) AS served, count(*) FILTER (fallback) AS fallbacks FROM picks GROUP BY ALL")
    def image_readout(spark, d):
        return picked(spark, d).groupBy("cycle").agg(F.count(F.lit(1)).alias("domains"), F.count("picture").alias("served"), F.sum(F.col("fallback").cast("long")).alias("fallbacks"))

    @q("image_rounds", picks_sql + """, r AS (SELECT page_id % 4 AS cycle, domain, count(*) AS records FROM p GROUP BY ALL), f AS (SELECT domain, count(*) AS n FROM own GROUP BY ALL)
      SELECT cycle, domain, coalesce(records, 0) AS records, CASE WHEN fallback THEN (SELECT count(*) FROM pool) ELSE coalesce(n, 0) END AS candidates, fallback, picture IS NOT NULL AS served
      FROM picks LEFT JOIN r USING (cycle, domain) LEFT JOIN f USING (domain)""")
    def image_rounds(spark, d):
        """Every page is a record of the round that its id says."""
        rows = pictures(spark, d)
        return images.round_readout(picked(spark, d), rows.select((F.col("page_id") % 4).alias("cycle"), "domain"), rows.where("own"), rows)

    @q("prune_candidates", picks_sql + " SELECT url AS path FROM p WHERE url NOT IN (SELECT picture FROM picks WHERE picture IS NOT NULL)")
    def prune(spark, d):
        return images.prunable(pictures(spark, d).select(F.col("picture").alias("path")), picked(spark, d).where("picture IS NOT NULL").select(F.col("picture").alias("path")))

    @q("image_allocation", """WITH t AS (SELECT conv_id, turn, count(*) OVER (PARTITION BY conv_id) AS n, role FROM conversations),
      u AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM t WHERE role = 'user'),
      g AS (SELECT *, row_number() OVER (ORDER BY n > 2, conv_id, turn) - 1 AS i FROM u WHERE k <= 2),
      pool AS (SELECT url AS picture, row_number() OVER (ORDER BY url) - 1 AS slot FROM pages)
      SELECT conv_id, turn, picture FROM g JOIN pool ON slot = i % (SELECT count(*) FROM pool)""")
    def allocation(spark, d):
        t = table(spark, d, "conversations").select(F.col("conv_id").alias("spec"), "turn", "role", F.count(F.lit(1)).over(Window.partitionBy("conv_id")).alias("n_turns"))
        pool = images.numbered(table(spark, d, "pages").select(F.col("url").alias("picture"), F.col("url").alias("name")), None, "name", "picture")
        return images.allocate(t, pool, 2).withColumnRenamed("spec", "conv_id")

    @q("failure_classes", "SELECT CASE event_type WHEN 'view' THEN 'timeout' WHEN 'click' THEN 'transport_error' WHEN 'error' THEN 'unexpected_error' ELSE 'empty_content' END AS reason, count(*) AS n, bool_or(event_type IN ('view', 'click')) AS unstable FROM events GROUP BY 1")
    def failures(spark, d):
        kind = F.col("event_type")
        error = F.when(kind == "view", "timeout").when(kind == "click", "connect").when(kind == "error", "other").otherwise("empty")
        rows = table(spark, d, "events").select(attempts.failure_class(error).alias("reason"))
        return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).withColumn("unstable", F.col("reason").isin(*attempts.UNSTABLE))

    @q("backpressure_islands", """WITH e AS (SELECT *, sum((event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events),
      r AS (SELECT user_id, island, count(*) FILTER (event_type = 'error') AS n FROM e GROUP BY ALL)
      SELECT user_id, sum(n // 3)::BIGINT AS cooldowns, arg_max(n % 3, island) AS streak FROM r GROUP BY user_id""")
    def islands(spark, d):
        e = table(spark, d, "events")
        return attempts.streaks(e, "user_id", ["ts", "event_id"], F.col("event_type") == "purchase", F.col("event_type") == "error", 3)

    @q("retry_backoff", "SELECT event_id % 9 AS attempt, least(pow(2, event_id % 9), 30.0)::DOUBLE AS seconds FROM events GROUP BY ALL")
    def backoff(spark, d):
        return table(spark, d, "events").select((F.col("event_id") % 9).alias("attempt")).distinct().withColumn("seconds", attempts.backoff(F.col("attempt")))

    @q("sse_assemble", _SSE + "SELECT user_id, content, reasoning, finish, CASE WHEN content = '' THEN 'empty' WHEN finish = 'length' THEN 'truncated' ELSE 'ok' END AS verdict FROM a")
    def assemble(spark, d):
        rows = attempts.assembled(sse(spark, d), "user_id", "seq", "line")
        return rows.withColumn("verdict", attempts.verdict(F.col("content"), F.col("finish")))

    @q("reasoning_stats", _SSE + "SELECT count(*) AS responses, count(*) FILTER (reasoning != '') AS reasoning_responses, sum(length(reasoning))::BIGINT AS reasoning_chars, count(*) FILTER (reasoning != '' AND content = '') AS reasoning_only, count(*) FILTER (content = '') AS empty, count(*) FILTER (content = '' AND finish = 'length') AS truncated_empty FROM a")
    def stats(spark, d):
        return attempts.reasoning_stats(attempts.assembled(sse(spark, d), "user_id", "seq", "line"))

    @q("redacted_config", r"SELECT key, NOT list_has_any(w, ['timeout', 'timeouts']) AND (list_has_any(w, ['api_key', 'apikey', 'key', 'token', 'secret', 'password', 'passwd', 'bearer', 'credential', 'auth']) OR array_to_string(w, '') IN ('apikey', 'key', 'token', 'secret', 'password', 'passwd', 'bearer', 'credential', 'auth')) AS secret FROM (SELECT key, list_filter(string_split_regex(lower(regexp_replace(key, '([a-z0-9])([A-Z])', '\1_\2', 'g')), '[^a-z0-9]+'), lambda x: x != '') AS w FROM (VALUES " + ", ".join(f"('{k}')" for k in KEYS) + ") t(key))")
    def redacted(spark, d):
        keys = spark.range(1).select(F.explode(F.array(*(F.lit(k) for k in KEYS))).alias("key"))
        return keys.select("key", config.is_secret_column(F.col("key")).alias("secret"))

    @q("answer_gate", r"SELECT 'd' || doc_id AS id, CASE WHEN n < 8 THEN 'answer_too_short' WHEN n > 4000 THEN 'answer_too_long' END AS refused FROM (SELECT doc_id, length(regexp_replace(text, '^[\s]+|[\s]+$', '', 'g')) AS n FROM documents UNION ALL SELECT -event_id, length(event_type) FROM events)")
    def gate(spark, d):
        said = table(spark, d, "documents").select("doc_id", "text").unionAll(table(spark, d, "events").select(-F.col("event_id"), "event_type"))
        return said.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), records.answer_gate(F.col("text"), 4000).alias("refused"))

    @reg.query("generate_fake")
    def generated(spark, d):
        """Conversations from a client without a network, or why not; tested against the client itself."""
        specs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), (2 * (F.col("doc_id") % 3) + 1).alias("n_turns"), F.when(F.col("doc_id") % 2 == 0, "Be kind.").alias("system"), F.col("source").alias("ask"))
        return generate.generate(specs, Echo, 4).select("id", F.array_join("roles", ",").alias("roles"), "answer", "reason")

    @reg.query("event_windows", "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
    def windows(spark, d):
        rows = generate.windowed_counts(table(spark, d, "events"), "ts", "event_type", "1 day", "1 hour")
        return rows.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")
