"""Seeds, identifiers and digests.

Two modes draw order from a seed. The exact mode seeds the Mersenne Twister of
Python's random module with a 256-bit hash; the sql mode orders by SHA-256 and
is relational throughout. The algorithm's name is part of the run key, so that
plans of the two modes never share ids.
"""

from __future__ import annotations

import hashlib
import json
import random
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The name of the digest by blocks, and how many rows or digests a block has.
TREE, FANOUT, LEVELS = "tree-sha256/v1", 1024, 4
# Names that enter the run key, and the largest five-digit field.
EXACT, SQL = "cycle-shuffle/v1", "cycle-sha2/v1"
FIVE_DIGITS = 99999


def canonical_json(document: object) -> str:
    """Sorted keys, ASCII only, no spaces."""
    return json.dumps(document, sort_keys=True, ensure_ascii=True, separators=(",", ":"))


def fingerprint(document: object) -> str:
    """SHA-256 of the canonical JSON of a space document."""
    return hashlib.sha256(canonical_json(document).encode()).hexdigest()


def seed_number(*parts: object) -> int:
    """A 256-bit number from the parts as strings."""
    text = json.dumps([str(p) for p in parts], separators=(",", ":"))
    return int.from_bytes(hashlib.sha256(text.encode()).digest(), "big")


def shuffled(size: int, *parts: object) -> list[int]:
    """0 to size - 1 in the order that the parts seed."""
    order = list(range(size))
    random.Random(seed_number(*parts)).shuffle(order)
    return order


def picture_offset(seed: int, domain: str, size: int) -> int:
    """Where a domain begins in its list of pictures."""
    return random.Random(int(hashlib.sha256(f"{seed}:{domain}".encode()).hexdigest(), 16)).randrange(size)


def run_key(fp: str, seed: int, algorithm: str = EXACT) -> str:
    """Eight hex digits that name a run; the seed enters as a number."""
    return hashlib.sha256(json.dumps([fp, seed, algorithm], separators=(",", ":")).encode()).hexdigest()[:8]


def run_key_column(fp: str, seed: int, algorithm: str) -> Column:
    return F.substring(F.sha2(F.lit(f'["{fp}",{seed},"{algorithm}"]'), 256), 1, 8)


def row_id(key: Column, cycle: Column, position: Column) -> Column:
    """<key>-cNNNNNpNNNNN; numbers beyond five digits are an error, as they would no longer sort."""
    text = F.format_string("%s-c%05dp%05d", key, cycle.cast("int"), position.cast("int"))
    return F.when((cycle > FIVE_DIGITS) | (position > FIVE_DIGITS), F.raise_error(F.lit("cycle or position beyond five digits"))).otherwise(text)


def seed_hash(*parts: Column) -> Column:
    """Hex digits of what seed_number makes of the parts; they must need no escape in JSON."""
    return F.sha2(F.concat(F.lit("["), F.concat_ws(",", *(F.concat(F.lit('"'), p.cast("string"), F.lit('"')) for p in parts)), F.lit("]")), 256)


def sha_number(text: Column) -> Column:
    """The first 32 bits of a SHA-256 as a number."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")


def plan_digest(rows: DataFrame, inputs: Iterable[object]) -> str:
    """SHA-256 over the inputs and the plan's rows (id, coordinate, n_turns) in plan order, a partition at a time."""
    total = hashlib.sha256(canonical_json(list(inputs)).encode())
    for r in rows.orderBy("plan_index").select("id", "coordinate", "n_turns").toLocalIterator():
        total.update(canonical_json([r["id"], [list(x) for x in r["coordinate"]], r["n_turns"]]).encode())
    return total.hexdigest()


def tree_digest(rows: DataFrame, index: str, content: Column, head: str = "") -> DataFrame:
    """One row, n and digest over rows numbered from 0 without a gap: blocks of 1024 are hashed in their tasks, then blocks of digests, four levels in all.

    It is the same for any partitioning, and no task holds more than one block; 2**40 rows fit.
    """
    own = rows.select(F.col(index).cast("long").alias("_i"), F.sha2(content, 256).alias("_h"), F.lit(1).cast("long").alias("_n"))
    for _ in range(LEVELS):
        block = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_h"))), lambda x: x["_h"]), "")
        own = own.groupBy(F.floor(F.col("_i") / FANOUT).cast("long").alias("_b")).agg(F.sha2(block, 256).alias("_h"), F.sum("_n").alias("_n")).select(F.col("_b").alias("_i"), "_h", "_n")
    top = own.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n"), F.coalesce(F.max("_h"), F.lit("")).alias("_h"))
    return top.select("n", F.sha2(F.concat(F.lit(f"{TREE}\n{head}\n"), F.col("n").cast("string"), F.lit("\n"), F.col("_h")), 256).alias("digest"))
