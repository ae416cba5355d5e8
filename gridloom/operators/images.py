"""Pictures: listing, the pick of each round, fallback to a pool, allocation to turns, pruning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.operators.ordering import running
from gridloom.session import checkpointed

# Suffixes of pictures, and the media types of those that can be sent inline.
WEB = ("jpg", "jpeg", "png", "gif", "webp")
OTHER = ("bmp", "tiff", "tif")
RAW = ("cr2", "nef", "arw", "dng", "orf", "rw2", "raf", "pef", "srw", "3fr", "erf", "mef", "mrw", "nrw", "ptx", "r3d", "rwl", "srf", "x3f")
MEDIA = {"jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png", "gif": "image/gif", "webp": "image/webp"}


def listing(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = WEB + OTHER + RAW) -> DataFrame:
    """path of each picture below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    return files.where(F.lower(F.element_at(F.split("path", r"\."), -1)).isin(*suffixes))


def data_uri(path: Column, content: Column) -> Column:
    """An inline picture; an unknown suffix is an error."""
    kind = F.create_map(*(F.lit(x) for kv in MEDIA.items() for x in kv))[F.lower(F.element_at(F.split(path, r"\."), -1))]
    return F.when(kind.isNull(), F.raise_error(F.concat(F.lit("no media type for "), path))).otherwise(F.concat(F.lit("data:"), kind, F.lit(";base64,"), F.regexp_replace(F.base64(content), r"[\r\n]", "")))


def numbered(files: DataFrame, group: str | None, name: str, tie: str) -> DataFrame:
    """files with slot (from 0) and n within each group, by name, then tie; the files of a group are spread over tasks like any others."""
    if group is None:
        return running(files, [name, tie]).withColumnsRenamed({"before": "slot", "total": "n"})
    own = checkpointed(running(files, [group, name, tie]).drop("total"))
    each = own.groupBy(group).agg(F.min("before").alias("_least"), F.count(F.lit(1)).alias("n")).withColumnRenamed(group, "_group")
    return own.join(each, F.col(group).eqNullSafe(F.col("_group"))).withColumn("slot", F.col("before") - F.col("_least")).select(*files.columns, "slot", "n")


def picks(domains: DataFrame, own: DataFrame, pool: DataFrame, cycles: int, offset: Column) -> DataFrame:
    """domain, cycle, picture, fallback: each round the next own picture, without one the next of the pool, else none.

    own: domain, picture, slot, n. pool: picture, slot, n, bounded by the files of one folder. offset: where a domain begins.
    """
    rounds = domains.sparkSession.range(cycles).select(F.col("id").alias("cycle"))
    counts = own.select("domain", F.col("n").alias("own_n")).distinct()
    size = pool.agg(F.coalesce(F.max("n"), F.lit(0)).alias("pool_n"))
    want = domains.select("domain").crossJoin(rounds).join(counts, "domain", "left").crossJoin(size)  # a row for each domain and round
    want = want.withColumn("at", F.when(F.col("own_n").isNotNull(), F.pmod(offset + F.col("cycle"), F.col("own_n"))).when(F.col("pool_n") > 0, F.pmod(offset + F.col("cycle"), F.col("pool_n"))))
    mine = want.join(own.select("domain", F.col("slot").alias("at"), F.col("picture").alias("own_picture")), ["domain", "at"], "left")
    both = mine.join(pool.select(F.col("slot").alias("at"), F.col("picture").alias("pool_picture")), "at", "left")
    back = F.col("own_n").isNull() & F.col("pool_picture").isNotNull()
    return both.select("domain", "cycle", F.when(F.col("own_n").isNotNull(), F.col("own_picture")).otherwise(F.col("pool_picture")).alias("picture"), back.alias("fallback"))


def round_readout(picked: DataFrame, used: DataFrame, own: DataFrame, pool: DataFrame) -> DataFrame:
    """cycle, domain, records, candidates, fallback, served of each round and domain of `picks`.

    used: cycle, domain of each record with a picture. own: domain of each file
    that a domain has. candidates are the files to pick from: a domain's own, or
    all of the pool where it falls back. A round and domain outside the picks is left out.
    """
    at = used.groupBy("cycle", "domain").agg(F.count(F.lit(1)).alias("records"))
    mine = own.groupBy("domain").agg(F.count(F.lit(1)).alias("own"))
    everything = pool.agg(F.count(F.lit(1)).alias("all"))
    both = picked.join(at, ["cycle", "domain"], "left").join(mine, "domain", "left").crossJoin(everything)  # one row
    return both.select("cycle", "domain", F.coalesce("records", F.lit(0)).alias("records"), F.when(F.col("fallback"), F.col("all")).otherwise(F.coalesce("own", F.lit(0))).alias("candidates"), "fallback", F.col("picture").isNotNull().alias("served"))


def allocate(turns: DataFrame, pool: DataFrame, most: int) -> DataFrame:
    """spec, turn, picture: earliest user turns get pictures, single-turn specs first, the pool over and over, `most` for a spec.

    turns: spec, n_turns, turn, role. pool: slot, picture, n.
    """
    users = turns.where("role = 'user'").withColumn("rank", F.row_number().over(Window.partitionBy("spec").orderBy("turn"))).where(F.col("rank") <= most)
    order = users.withColumn("long", F.col("n_turns") > 2)
    # the running number is global: counts of earlier specs plus the rank within the spec
    specs = order.groupBy("long", "spec").agg(F.count(F.lit(1)).alias("m"))
    starts = running(specs, ["long", "spec"], "m").select("spec", F.col("before").alias("start"))
    size = pool.agg(F.max("n").alias("size"))
    numbered_ = order.join(starts, "spec").crossJoin(size).withColumn("slot", F.pmod(F.col("start") + F.col("rank") - 1, F.col("size")))
    return numbered_.join(pool.select("slot", "picture"), "slot").select("spec", "turn", "picture")


def children(files: DataFrame, domain: str, path: str = "path") -> DataFrame:
    """Files right in one domain's folder, by name; paths are relative to the folder of all domains."""
    parts = F.split(path, "/")
    return files.where((F.size(parts) == 2) & (parts[0] == domain)).orderBy(parts[1])


def pool(files: DataFrame, path: str = "path") -> DataFrame:
    """All files with slot (from 0) and n, ordered by the parts of their paths."""
    return running(files.withColumn("_parts", F.split(path, "/")), ["_parts"]).drop("_parts").withColumnsRenamed({"before": "slot", "total": "n"})


def sample(files: DataFrame, count: int, seed: int, path: str = "path") -> DataFrame:
    """A subset that the seed draws; all files if there are no more than `count`."""
    return files.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), path), 256), path).limit(count)


def copy_targets(files: DataFrame, taken: DataFrame, force: bool = False, path: str = "path", folder: Column | None = None) -> DataFrame:
    """files with target, their place below images/, and reused.

    Without `force` a file whose place is taken (column target) is the one there.
    Else files of one name get _1, _2 and so on before the suffix, by path.
    """
    name = F.element_at(F.split(path, "/"), -1)
    place = F.concat(F.lit("images/"), name) if folder is None else F.concat(F.lit("images/"), folder, F.lit("/"), name)
    own = files.withColumn("target", place).join(taken.select("target").distinct().withColumn("_taken", F.lit(True)), "target", "left").withColumn("_taken", F.coalesce("_taken", F.lit(False)))
    reuse = F.col("_taken") & F.lit(not force)
    nth = F.row_number().over(Window.partitionBy("target").orderBy(path)) - 1 + F.when(F.col("_taken"), 1).otherwise(0)
    numbered_ = F.when(reuse | (nth == 0), F.col("target")).otherwise(F.regexp_replace("target", r"(\.[^./]*)?$", "")).cast("string")
    suffix = F.when(reuse | (nth == 0), "").otherwise(F.concat(F.lit("_"), nth.cast("string"), F.regexp_extract("target", r"(\.[^./]*)$", 1)))
    return own.withColumn("target", F.concat(numbered_, suffix)).withColumn("reused", reuse).drop("_taken")


def served(rows: DataFrame, missing: DataFrame, domain: str = "visual_domain") -> DataFrame:
    """Rows whose domain has a picture, and rows without a domain."""
    return rows.join(missing.select(domain).where(F.col(domain).isNotNull()).distinct(), domain, "left_anti")


def refusal(missing: DataFrame, root: str, planned: int, suffixes: tuple[str, ...] = WEB) -> DataFrame:
    """One row, message: what a run says that finds no picture for some domains. missing: domain, id."""
    each = missing.groupBy("domain").agg(F.count(F.lit(1)).alias("n"))
    line = F.concat(F.lit("  - "), "domain", F.lit(f": no picture in {root}/"), "domain", F.lit(" ("), F.col("n").cast("string"), F.lit(" rows)"))
    lines = F.array_join(F.array_sort(F.collect_list(line)), "\n")  # a line for each domain
    head = F.concat(F.lit(f"{root} has no picture for "), F.count(F.lit(1)).cast("string"), F.lit(" domains:\n"))
    tail = F.concat(F.lit("\n"), F.sum("n").cast("string"), F.lit(f" of {planned} planned rows need one. Put in a file ({', '.join(sorted(suffixes))}) or let such rows be skipped."))
    return each.agg(F.concat(head, lines, tail).alias("message"))


def merged(resolutions: DataFrame) -> DataFrame:
    """Rounds' resolutions (cycle, domain, missing ids, candidates, pool, fallback) as one row for each domain.

    Missing ids follow each other by round, the largest pool counts, the last
    round's candidates, and a fallback in any round.
    """
    ids = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("cycle", "missing"))), lambda x: x["missing"]))
    return resolutions.groupBy("domain").agg(ids.alias("missing"), F.max("pool").alias("pool"), F.max_by("candidates", "cycle").alias("candidates"), F.bool_or("fallback").alias("fallback"), F.min("cycle").alias("cycle"))


def prunable(placed: DataFrame, referenced: DataFrame, key: str = "path") -> DataFrame:
    """Pictures placed by this run that no final record refers to."""
    return placed.join(referenced.select(key).distinct(), key, "left_anti")
