"""Reply trees to chat texts, with DataFrame functions only.

Rows are nodes of reply trees. Self-joins double the distance that each node
sees towards its root, so that trees of any depth need few rounds; they carry
the length and score of the way up. Leaves are ranked by the score of their
path; the ways of the chosen ones are halved by the same joins until they are
single nodes. Each path becomes one text: turns between marks, control strings
inside texts escaped, and the spans of assistant texts as its loss mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import checkpointed

#: The template: marks around a turn, its head, and what stands for characters that could look like marks.
OPEN, CLOSE, HEAD, AFTER_ROLE = "<turn>", "</turn>\n", "### ", ": "
ESCAPES = (("\\", "\\\\"), ("<", "\\l"), ("#", "\\h"), (":", "\\c"), ("\n", "\\n"))
_TEXT, _ROLE = ESCAPES[:3], ESCAPES
LOSS_ROLE = "assistant"


def escaped(text: Column, role: bool = False) -> Column:
    """No mark can be read in an escaped text; roles also lose colons and line feeds."""
    for plain, sign in _ROLE if role else _TEXT:
        text = F.replace(text, F.lit(plain), F.lit(sign))
    return text


def unescaped(text: Column) -> Column:
    """Takes escaped() back. Pairs of backslashes part the text, between them each sign is itself."""

    def signs(part: Column) -> Column:
        for plain, sign in ESCAPES[1:]:
            part = F.replace(part, F.lit(sign), F.lit(plain))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), signs), "\\")


def line_of_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations without branches as trees: conv, node, parent, role, text, score. Turns follow by turn, then role and text."""
    own = rows.select(rows[conv].alias("conv"), rows[turn].alias("turn"), rows[role].cast("string").alias("role"), rows[text].cast("string").alias("text"))
    node = F.row_number().over(Window.partitionBy("conv").orderBy("turn", "role", "text")).cast("long")
    return own.withColumn("node", node).select("conv", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.conv").eqNullSafe(F.col(f"{b}.conv"))


def _up(frame: DataFrame) -> DataFrame:
    """Nodes that others can answer."""
    return frame.where("dup = 0 AND node IS NOT NULL")


def paths(tree: DataFrame, top: int | None = None) -> DataFrame:
    """conv, leaf, leaf_dup, branch, n, score, pos, node, dup: the nodes of each chosen root-to-leaf path.

    tree has conv, node, parent, score. Branches of a conversation rank by the
    sum of their scores (null: 0), larger first, then by leaf; `top` keeps the
    first ones, None all. A parent that the conversation lacks makes a root.
    Rows with one node id in one conversation are leaves apart, but the first,
    which takes the answers. Rows on a circle of parents have no root and no path.
    """
    dup = F.row_number().over(Window.partitionBy("conv", "node").orderBy("parent", "role", "text")) - 1
    own = checkpointed(tree.withColumn("dup", dup).select("conv", "node", "dup", "parent", F.coalesce("score", F.lit(0.0)).alias("score")))
    known = _up(own).select("conv", "node").alias("p")
    hop = own.alias("o").join(known, _same("o", "p") & (F.col("o.parent") == F.col("p.node")), "left").select("o.conv", "o.node", "o.dup", F.col("p.node").alias("up"), F.lit(1).cast("long").alias("n"), "o.score")
    hops = [checkpointed(hop)]
    left = None  # nodes that don't see their root yet: fewer each round, until only those on or behind circles remain
    while True:
        before, left = left, hops[-1].where("up IS NOT NULL").count()
        if left in (0, before):
            break
        open_, known = hops[-1].where("up IS NOT NULL").alias("a"), _up(hops[-1]).alias("b")
        wider = open_.join(known, _same("a", "b") & (F.col("a.up") == F.col("b.node"))).select("a.conv", "a.node", "a.dup", "b.up", (F.col("a.n") + F.col("b.n")).alias("n"), (F.col("a.score") + F.col("b.score")).alias("score"))
        wider = wider.unionByName(hops[-1].where("up IS NULL"))  # those that see their root are done
        hops.append(checkpointed(wider))
    whole = hops[-1].where("up IS NULL").alias("w")
    answered = own.where("parent IS NOT NULL").select("conv", F.col("parent").alias("node"), F.lit(0).alias("dup")).distinct().alias("x")
    leaves = whole.join(answered, _same("w", "x") & (F.col("w.node") == F.col("x.node")) & (F.col("w.dup") == F.col("x.dup")), "left_anti")
    rank = F.row_number().over(Window.partitionBy("conv").orderBy(F.desc("score"), "leaf", "leaf_dup"))
    leaves = leaves.select("conv", F.col("node").alias("leaf"), F.col("dup").alias("leaf_dup"), "n", "score").withColumn("branch", rank)
    if top is not None:
        leaves = leaves.where(F.col("branch") <= top)
    part = leaves.withColumns({"node": F.col("leaf"), "dup": F.col("leaf_dup"), "len": F.col("n"), "base": F.lit(0).cast("long")})
    for k in range(len(hops) - 2, -1, -1):
        half = F.lit(1 << k).cast("long")
        jump = hops[k].select("conv", "node", "dup", "up").alias("j")
        a = part.alias("a").join(jump, _same("a", "j") & F.col("a.node").eqNullSafe(F.col("j.node")) & (F.col("a.dup") == F.col("j.dup")), "left")
        low = F.struct(F.col("a.node").alias("node"), F.col("a.dup").alias("dup"), half.alias("len"), (F.col("a.base") + F.col("a.len") - half).alias("base"))
        high = F.struct(F.col("j.up").alias("node"), F.lit(0).alias("dup"), (F.col("a.len") - half).alias("len"), F.col("a.base").alias("base"))
        same = F.struct(F.col("a.node").alias("node"), F.col("a.dup").alias("dup"), F.col("a.len").alias("len"), F.col("a.base").alias("base"))
        pieces = F.explode(F.when(F.col("a.len") > half, F.array(low, high)).otherwise(F.array(same))).alias("s")
        part = a.select("a.conv", "a.leaf", "a.leaf_dup", "a.branch", "a.n", "a.score", pieces).select("conv", "leaf", "leaf_dup", "branch", "n", "score", "s.*")
    return part.select("conv", "leaf", "leaf_dup", "branch", "n", "score", F.col("base").alias("pos"), "node", "dup")


def formatted(tree: DataFrame, top: int | None = None) -> DataFrame:
    """conv, branch, n, score, text, loss (array of start and length in code points) of each chosen path.

    tree has conv, node, parent, role, text, score. Null roles and texts are
    empty. Ranking, ties and odd rows are as in paths(); an empty table gives none.
    """
    dup = F.row_number().over(Window.partitionBy("conv", "node").orderBy("parent", "role", "text")) - 1
    said = tree.withColumn("dup", dup).select("conv", "node", "dup", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("body")).alias("t")
    way = paths(tree, top).alias("w")
    turns = way.join(said, _same("w", "t") & F.col("w.node").eqNullSafe(F.col("t.node")) & (F.col("w.dup") == F.col("t.dup"))).select("w.conv", "w.leaf", "w.leaf_dup", "w.branch", "w.n", "w.score", "w.pos", "t.role", escaped(F.col("t.body")).alias("body"))
    head = F.concat(F.lit(OPEN + HEAD), escaped(F.col("role"), role=True), F.lit(AFTER_ROLE))
    turns = turns.withColumn("head", head).withColumn("piece", F.concat("head", "body", F.lit(CLOSE)))
    before = Window.partitionBy("conv", "leaf", "leaf_dup", "branch").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("start", F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)) + F.length("head"))
    turn = F.struct("pos", "piece", (F.col("role") == LOSS_ROLE).alias("learn"), "start", F.length("body").cast("long").alias("length"))
    whole = turns.groupBy("conv", "leaf", "leaf_dup", "branch", "n", "score").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    loss = F.transform(F.filter("turns", lambda t: t["learn"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")))
    return whole.select("conv", "branch", "n", "score", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("text"), loss.alias("loss"))


def read_back(chats: DataFrame) -> DataFrame:
    """conv, branch, roles, texts, learned (the texts under the loss mask), formatted_chars, from text and loss alone."""
    turn = rf"{OPEN}{HEAD}([^:<]*){AFTER_ROLE}([^<]*){CLOSE}"
    plain = lambda k: F.transform(F.regexp_extract_all("text", F.lit(turn), F.lit(k)), unescaped)
    learned = F.transform("loss", lambda s: unescaped(F.substring(F.col("text"), s["start"].cast("int") + 1, s["length"].cast("int"))))
    return chats.select("conv", "branch", plain(1).alias("roles"), plain(2).alias("texts"), learned.alias("learned"), F.length("text").cast("long").alias("formatted_chars"))
