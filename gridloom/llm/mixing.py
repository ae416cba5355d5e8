"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only.

Documents are summed into cells of source, language and topic. The cells' token
weights are raked in turn to the wanted shares of each source, language and
topic until all of them are met. A cell's documents are then drawn with the
probability that turns its tokens into its raked weight. One factor serves all
cells, the largest that leaves no probability above 1 (or a smaller one that
meets a budget), so that the expected tokens have the raked shares exactly.

Where a scarce cell would make that factor so small that less than a stated share
of the tokens stayed, weights are raked again under a bound: no cell may give
more tokens than it has, and all together give that share. Scarce values then
stay below their targets, the others keep theirs as nearly as can be, and how far
each share is off comes with the result. A document's draw is a hash of its id
and the seed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import SMALL_BYTES, WORD, checkpointed, columns, few, fresh, small, table_bytes

DIMENSIONS = ("source", "lang", "topic")
#: In place of a value: all values without a share of their own.
REST = "*"
Targets = dict[str, dict[str, float] | float]
#: Wanted shares of tokens by value; what is not named shares the rest in proportion to its tokens. A number in place of shares
#: wants each value's present share to the power of it: 1 leaves shares as they are, 0 makes them equal.
TARGETS: Targets = {
    "source": 0.7,
    "lang": 0.7,
    "topic": {"prose": 0.893, "figures": 0.04, "legal": 0.025, "contact": 0.012, "symbols": 0.03},
}
#: Rounds at most, rounds between two looks at the shares, and how far a share may be off.
ROUNDS, LOOK, TOLERANCE = 60, 6, 1e-12
#: The share of all tokens that is kept at least, whatever cell is scarce, and rounds under that bound.
LEAST, BOUND_ROUNDS = 0.25, 24
SCALE = float(1 << 48)


def topic_of(text: Column) -> Column:
    """The first that a text shows: runs of symbols, mail or web addresses, licences, numbers of four digits; else prose."""
    contact = text.contains("@") & text.rlike("[A-Za-z0-9._]@[A-Za-z0-9]") | text.contains("http://") | text.contains("https://")
    legal = reduce(Column.__or__, (text.contains(w) for w in ("License", "license", "Licence", "licence", "Copyright", "copyright", "©")))
    return F.when(text.rlike("[#$%&*]{3}"), "symbols").when(contact, "contact").when(legal, "legal").when(text.rlike("[0-9]{4}"), "figures").otherwise("prose")


def draw(name: Column, seed: int) -> Column:
    """48 bits of a hash as a number from 0 to 1."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 12), 16, 10).cast("double") / SCALE


def _facts(docs: DataFrame, key: str, text: str, source: str, lang: str, seed: int) -> dict[str, Column]:
    """source, lang, topic, tokens, draw of each row."""
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    name = F.coalesce(docs[key].cast("string"), F.concat(F.lit("text "), body))
    return {"source": F.coalesce(docs[source].cast("string"), F.lit("")), "lang": F.coalesce(docs[lang].cast("string"), F.lit("")), "topic": topic_of(body), "tokens": F.regexp_count(body, F.lit(WORD)).cast("long"), "draw": draw(name, seed), "empty": ~body.rlike(WORD)}


def wanted(cells: DataFrame, d: str, targets: Targets) -> DataFrame:
    """d and t_<d>: the wanted share of each value that cells have; they sum to 1. Without targets the present ones."""
    have = cells.groupBy(d).agg(F.sum("tokens").cast("double").alias("have"))
    if isinstance(power := targets.get(d, 1.0), int | float):
        grown = F.pow("have", F.lit(float(power)))
        return have.crossJoin(F.broadcast(have.agg(F.sum(grown).alias("whole")))).select(d, (grown / F.col("whole")).alias(f"t_{d}"))  # one row
    shares = [F.struct(F.lit(v).alias("value"), F.lit(float(s)).alias("share")) for v, s in power.items() if v != REST]
    rest = float(power.get(REST, 0.0))
    given = cells.sparkSession.range(1).select(F.inline(F.array(*shares, F.struct(F.lit(REST).alias("value"), F.lit(None).cast("double").alias("share")))))
    named = have.join(given.where("share IS NOT NULL"), F.col(d) == F.col("value"), "left")
    sums = named.agg(F.sum(F.when(F.col("share").isNull(), F.col("have"))).alias("unnamed"), F.sum("share").alias("named"))
    whole = F.coalesce(F.col("named"), F.lit(0.0)) + F.when(F.col("unnamed").isNotNull(), F.lit(rest)).otherwise(0.0)
    share = F.coalesce(F.col("share"), F.try_divide(F.lit(rest) * F.col("have"), F.col("unnamed"))) / F.when(whole > 0, whole)
    return named.crossJoin(F.broadcast(sums)).select(d, F.coalesce(share, F.lit(0.0)).alias(f"t_{d}"))  # sums is one row


def fitted(cells: DataFrame, targets: Targets = TARGETS, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """cells (source, lang, topic, tokens) with wanted shares t_<dimension> and the raked weight w; weights sum to 1.

    A round fits every dimension once. It ends when every share is within
    `tolerance` of the wanted one, or after `rounds` where the cells can't meet
    all targets. Cells without a token go; a repeated cell counts as one.
    """
    cells = cells.where("tokens > 0").groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"))
    cells = checkpointed(cells)
    light = _light(cells)
    cells = light(cells)
    for d in DIMENSIONS:
        cells = cells.join(wanted(cells, d, targets), d)
    cells = checkpointed(light(cells.withColumn("w", F.col("tokens").cast("double"))))
    for done in range(0, rounds, LOOK):
        for _ in range(min(LOOK, rounds - done)):
            for d in DIMENSIONS:
                cells = light(cells.withColumn("w", F.coalesce(F.try_divide(F.col("w") * F.col(f"t_{d}"), F.sum("w").over(Window.partitionBy(d))), F.lit(0.0))))
        cells = checkpointed(cells)
        if _off(cells) <= tolerance:
            break
    return cells


def _light(cells: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """What keeps a table of as many cells in few tasks, if they take few bytes."""
    total = table_bytes(cells)
    return (lambda df: few(df, total)) if total <= SMALL_BYTES else (lambda df: df)


def _off(cells: DataFrame) -> float:
    """The most that a raked share is off."""
    each = (cells.groupBy(d).agg(F.abs(F.sum("w") - F.first(f"t_{d}")).alias("off")) for d in DIMENSIONS)
    return reduce(DataFrame.unionAll, (x.select("off") for x in each)).agg(F.coalesce(F.max("off"), F.lit(0.0)).alias("off")).first()["off"]


def bounded(cells: DataFrame, amount: float, rounds: int = BOUND_ROUNDS) -> DataFrame:
    """fitted() cells with w in tokens, `amount` together as far as may be: raked on while no cell exceeds the tokens it has."""
    light = _light(cells)
    cells = light(cells.withColumn("w", F.least(F.col("w") * amount, F.col("tokens").cast("double"))))
    for done in range(0, rounds, LOOK):
        for _ in range(min(LOOK, rounds - done)):
            for d in DIMENSIONS:
                grown = F.try_divide(F.col("w") * F.col(f"t_{d}") * amount, F.sum("w").over(Window.partitionBy(d)))
                cells = light(cells.withColumn("w", F.least(F.coalesce(grown, F.lit(0.0)), F.col("tokens").cast("double"))))
        cells = checkpointed(cells)
    return cells


def probabilities(cells: DataFrame, budget: float = 1.0, least: float = LEAST, most_off: float | None = None) -> DataFrame:
    """fitted() cells with p, the probability of their documents: as large as it can be without one above 1, and at most `budget` of all tokens.

    If that kept less than `least` of all tokens (or the budget, if that is
    less), the weights are bounded() by it. `most_off` refuses a result one of
    whose expected shares is further from the wanted one.
    """
    cells = checkpointed(cells)
    n = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("w"), F.lit(0.0)).alias("w"), F.min(F.try_divide("tokens", F.when(F.col("w") > 0, F.col("w")))).alias("tight")).first()
    if n["w"] > 0:
        factor = min(budget * n["tokens"] / n["w"], n["tight"])
        amount = min(budget, least) * n["tokens"]
        if factor * n["w"] >= amount:
            cells = cells.withColumn("w", F.col("w") * F.lit(factor))
        else:
            cells = bounded(cells, amount)
    cells = cells.withColumn("p", F.least(F.lit(1.0), F.col("w") / F.col("tokens")))
    if most_off is not None:
        worst = report(cells).orderBy(F.desc(F.abs(F.col("expected") - F.col("wanted"))), "dimension", "value").first()
        if worst and abs(worst["expected"] - worst["wanted"]) > most_off:
            raise ValueError(f"{worst['dimension']} {worst['value']!r} would have {worst['expected']:.6f} of the tokens in place of {worst['wanted']:.6f}")
    return cells


def report(cells: DataFrame) -> DataFrame:
    """dimension, value, present, wanted, expected: shares of tokens, of the input, as asked for, and as probabilities() cells will give."""
    out = []
    for d in DIMENSIONS:
        each = cells.groupBy(d).agg(F.sum("tokens").alias("n"), F.first(f"t_{d}").alias("wanted"), F.sum(F.col("p") * F.col("tokens")).alias("e"))
        sums = each.agg(F.sum("n").alias("all_n"), F.sum("e").alias("all_e"))
        out.append(each.crossJoin(F.broadcast(sums)).select(F.lit(d).alias("dimension"), F.col(d).alias("value"), (F.col("n") / F.col("all_n")).alias("present"), "wanted", F.coalesce(F.try_divide("e", "all_e"), F.lit(0.0)).alias("expected")))  # one row
    return reduce(DataFrame.unionAll, out)


def mix(docs: DataFrame, targets: Targets = TARGETS, budget: float = 1.0, seed: int = 7, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", rounds: int = ROUNDS, least: float = LEAST, most_off: float | None = None) -> DataFrame:
    """id, source, lang, topic, tokens, p, kept of each row; and off, the most by which an expected share misses the wanted one.

    A null source, language or text counts as the empty one. Rows without a
    token weigh nothing and are kept with probability 1; rows with a null key
    are drawn by their text; repeated rows are drawn alike; an empty table
    gives none; other columns are left out.
    """
    f = _facts(docs, key, text, source, lang, seed)
    own = checkpointed(docs.select(docs[key].alias("id"), *(f[c].alias(c) for c in (*DIMENSIONS, "tokens", "draw"))))
    cells = checkpointed(probabilities(fitted(own.select(*DIMENSIONS, "tokens"), targets, rounds), budget, least, most_off))
    off = report(cells).agg(F.coalesce(F.max(F.abs(F.col("expected") - F.col("wanted"))), F.lit(0.0)).alias("off"))
    found = own.join(small(cells.select(*DIMENSIONS, "p")), list(DIMENSIONS), "left").withColumn("p", F.when(F.col("tokens") > 0, F.col("p")).otherwise(F.lit(1.0)))
    return found.crossJoin(F.broadcast(off)).select("id", *DIMENSIONS, "tokens", "p", (F.col("draw") < F.col("p")).alias("kept"), "off")  # off is one row


def sample(docs: DataFrame, targets: Targets = TARGETS, budget: float = 1.0, seed: int = 7, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", rounds: int = ROUNDS, least: float = LEAST, most_off: float | None = None) -> DataFrame:
    """The rows of docs that mix() keeps, in all their columns, whatever their names.

    The cells go to the rows, so that texts are neither shuffled nor written. The
    rows are looked at twice for that: once to sum the cells, once to draw. Nulls,
    repeated rows and an empty table are as in mix().
    """
    f = _facts(docs, key, text, source, lang, seed)
    chances = probabilities(fitted(docs.select(*(f[c].alias(c) for c in (*DIMENSIONS, "tokens"))), targets, rounds), budget, least, most_off)
    names = fresh(docs, *DIMENSIONS, "p")
    chances = small(chances.select(*(F.col(c).alias(n) for c, n in zip((*DIMENSIONS, "p"), names, strict=True))))
    draws, empty = fresh(docs.select("*", *(F.lit(0).alias(n) for n in names)), "draw", "empty")
    rows = docs.select("*", *(f[c].alias(n) for c, n in zip(DIMENSIONS, names, strict=False)), f["draw"].alias(draws), f["empty"].alias(empty))
    found = rows.join(chances, names[:3], "left")
    return found.where(F.col(empty) | (F.col(draws) < F.col(names[3]))).select(*columns(docs))


def oracle(targets: Targets = TARGETS, budget: float = 1.0, seed: int = 7, rounds: int = 36, table: str = "documents", least: float = LEAST, bound_rounds: int = BOUND_ROUNDS) -> str:
    """The same in DuckDB's SQL, by a set number of rounds."""
    steps = [
        f"d AS (SELECT doc_id AS id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS body FROM {table})",
        "f AS (SELECT id, source, lang, CASE WHEN regexp_matches(body, '[#$%&*]{3}') THEN 'symbols' WHEN regexp_matches(body, '[A-Za-z0-9._]@[A-Za-z0-9]|https?://') THEN 'contact' WHEN regexp_matches(body, '[Ll]icen[sc]e|[Cc]opyright|©') THEN 'legal' WHEN regexp_matches(body, '[0-9]{4}') THEN 'figures' ELSE 'prose' END AS topic,"
        f" len(regexp_extract_all(body, '{WORD}'))::BIGINT AS tokens, ('0x' || substr(md5('{seed}:' || id), 1, 12))::BIGINT / {SCALE!r} AS draw FROM d)",
        "c AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM f GROUP BY ALL HAVING sum(tokens) > 0)",
    ]
    for d in DIMENSIONS:
        have = f"(SELECT {d}, sum(tokens)::DOUBLE AS have FROM c GROUP BY ALL)"
        if isinstance(power := targets.get(d, 1.0), int | float):
            steps.append(f"w_{d} AS MATERIALIZED (SELECT {d}, pow(have, {float(power)!r}) / sum(pow(have, {float(power)!r})) OVER () AS t_{d} FROM {have})")
            continue
        named = ", ".join(f"('{v}', {s!r}::DOUBLE)" for v, s in power.items() if v != REST)
        rest = power.get(REST, 0.0)
        steps.append(
            f"w_{d} AS MATERIALIZED (SELECT {d}, coalesce(share, {rest!r}::DOUBLE * have / unnamed) / (coalesce(named, 0) + CASE WHEN unnamed IS NULL THEN 0 ELSE {rest!r}::DOUBLE END) AS t_{d}"
            f" FROM (SELECT *, sum(have) FILTER (share IS NULL) OVER () AS unnamed, sum(share) OVER () AS named FROM {have} LEFT JOIN (VALUES {named}) v(value, share) ON {d} = value))"
        )
    steps.append("r0 AS MATERIALIZED (SELECT c.*, t_source, t_lang, t_topic, tokens::DOUBLE AS w FROM c JOIN w_source USING (source) JOIN w_lang USING (lang) JOIN w_topic USING (topic))")
    k = 0
    for _ in range(rounds):
        for d in DIMENSIONS:
            steps.append(f"r{k + 1} AS MATERIALIZED (SELECT * REPLACE (w * t_{d} / sum(w) OVER (PARTITION BY {d}) AS w) FROM r{k})")
            k += 1
    steps.append(f"k AS MATERIALIZED (SELECT least({budget!r} * sum(tokens) / sum(w), min(tokens / w)) AS factor, sum(w) AS w, {min(budget, least)!r} * sum(tokens) AS amount FROM r{k})")
    steps.append(f"b0 AS MATERIALIZED (SELECT r{k}.* REPLACE (least(r{k}.w * amount, tokens) AS w), amount FROM r{k}, k)")
    b = 0
    for _ in range(bound_rounds):
        for d in DIMENSIONS:
            steps.append(f"b{b + 1} AS MATERIALIZED (SELECT * REPLACE (least(w * t_{d} * amount / sum(w) OVER (PARTITION BY {d}), tokens) AS w) FROM b{b})")
            b += 1
    steps.append(f"p AS MATERIALIZED (SELECT r.source, r.lang, r.topic, r.tokens, r.t_source, r.t_lang, r.t_topic, least(1.0, CASE WHEN factor * k.w >= amount THEN r.w * factor ELSE b.w END / r.tokens) AS p FROM r{k} r JOIN (SELECT source, lang, topic, w FROM b{b}) b USING (source, lang, topic), k)")
    off = " UNION ALL ".join(f"SELECT abs(sum(p * tokens) / (SELECT sum(p * tokens) FROM p) - any_value(t_{d})) AS off FROM p GROUP BY {d}" for d in DIMENSIONS)
    return "WITH " + ",\n".join(steps) + f"\nSELECT id AS doc_id, f.source, f.lang, f.topic, f.tokens, round(CASE WHEN f.tokens > 0 THEN p ELSE 1.0::DOUBLE END, 6) AS p, draw < CASE WHEN f.tokens > 0 THEN p ELSE 1.0 END AS kept, round((SELECT max(off) FROM ({off})), 6) AS off FROM f LEFT JOIN p USING (source, lang, topic)"
