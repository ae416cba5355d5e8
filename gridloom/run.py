"""A whole run: plan, resume, generate, append, manifest and readout.

Everything that can refuse a run is checked before the first write. Frames
carry the rows; sidecar files (manifest, readout, progress) are small JSON
documents written by the driver under a temporary name and renamed.
"""

from __future__ import annotations

import argparse
import json
import re
import uuid
import warnings
from pathlib import Path
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import hashing
from gridloom.operators import bank, images, readout, records
from gridloom.plans import plan as plans
from gridloom.plans import space as spaces
from gridloom.sources import config, endpoint
from gridloom.streaming import generate, rounds

MANIFEST, PROGRESS, COVERAGE, BANK, ROUNDS = "manifest.json", "progress.json", "coverage", "bank", "picture_rounds"
RECORD = "id string, data_source string, messages array<struct<role:string,content:string>>, anchor_meta map<string,string>"


class PictureError(ValueError):
    """A plan asks for pictures that are not there."""


@dataclass(frozen=True)
class Pictures:
    """Files of a picture folder (domain, path), where they lie, and what becomes of rows whose domain has none."""

    files: DataFrame
    root: str
    skip_missing: bool = False

    @staticmethod
    def read(spark: SparkSession, root: str, skip_missing: bool = False) -> Pictures:
        """All pictures below a folder, one folder in it for each domain."""
        found = images.listing(spark, root)
        base = fs.FileSystem.from_uri(root)[1].rstrip("/") + "/"
        below = F.regexp_replace("path", "^.*?" + re.escape(base), "")
        return Pictures(found.select(F.split(below, "/")[0].alias("domain"), "path"), root, skip_missing)


def resolved(context: Context, pictures: Pictures) -> DataFrame:
    """cycle, domain, picture, fallback of the plan's rounds and domains: the next own file each round, else the pool's."""
    gated = context.space.gated
    wanted = context.plan.where(F.col(gated).isNotNull()).select(F.col(gated).alias("domain")).distinct()
    files = pictures.files.select("domain", F.col("path").alias("picture"), F.element_at(F.split("path", "/"), -1).alias("name"))
    own = images.numbered(files, "domain", "name", "picture")
    offset = hashing.sha_number(F.concat(F.lit(f"{context.identity['seed']}:"), F.col("domain")))
    return images.picks(wanted, own, images.numbered(files, None, "name", "picture"), plans.rounds(context.count, context.size)[2], offset)


def with_pictures(context: Context, plan: DataFrame, pictures: Pictures | None) -> tuple[DataFrame, DataFrame | None]:
    """plan rows with picture, and the rows left out for want of one. Without a folder no row has a picture.

    Rows whose domain has no picture anywhere stop the run, or are skipped if that is wanted.
    """
    gated = context.space.gated
    if pictures is None:
        return plan.withColumn("picture", F.lit(None).cast("string")), None
    found = resolved(context, pictures)
    rows = plan.join(found.select("cycle", F.col("domain").alias(gated), "picture"), ["cycle", gated], "left")
    lacking = rows.where(F.col(gated).isNotNull() & F.col("picture").isNull()).select(F.col(gated).alias("domain"), "id")
    if lacking.isEmpty():
        return rows, None
    if not pictures.skip_missing:
        raise PictureError(images.refusal(lacking, pictures.root, context.count).first()["message"])
    return rows.where(F.col(gated).isNull() | F.col("picture").isNotNull()), lacking


def write_json(out: str, name: str, document: object) -> None:
    """A JSON file in the folder (a URI), whole or not at all."""
    write_text(out, name, json.dumps(document, indent=2, ensure_ascii=False) + "\n")


def write_text(out: str, name: str, text: str) -> None:
    store, folder = fs.FileSystem.from_uri(out)
    store.create_dir(folder, recursive=True)
    at = f"{folder}/{name}.tmp-{uuid.uuid4().hex}"
    with store.open_output_stream(at) as f:
        f.write(text.encode())
    store.move(at, f"{folder}/{name}")


def read_json(out: str, name: str) -> dict | None:
    """The document, or None where there is none that can be read."""
    store, folder = fs.FileSystem.from_uri(out)
    try:
        with store.open_input_stream(f"{folder}/{name}") as f:
            found = json.loads(f.read())
    except (FileNotFoundError, ValueError):
        return None
    return found if isinstance(found, dict) else None


SMOKE = "_smoke"


def run_folder(configured: Column, stamp: Column, smoke: bool) -> Column:
    """A run's folder: the configured one or a name with the time, marked once if it is a smoke run."""
    name = F.coalesce(F.when(configured != "", F.regexp_replace(configured, "/+$", "")), F.concat(F.lit("outputs/run_"), stamp))
    return F.when(F.lit(smoke) & ~name.endswith(SMOKE), F.concat(name, F.lit(SMOKE))).otherwise(name)


def remove(out: str, name: str) -> None:
    store, folder = fs.FileSystem.from_uri(out)
    if store.get_file_info(f"{folder}/{name}").type != fs.FileType.NotFound:
        store.delete_file(f"{folder}/{name}")


@dataclass
class Context:
    """A plan with what it was made from."""

    plan: DataFrame
    space: spaces.Space
    axes: tuple[str, ...]
    size: int
    count: int
    identity: dict


def build(spark: SparkSession, document: Mapping, count: int, seed: int, leaf: str = "knowledge") -> Context:
    """The plan of `count` rows in the exact mode: ids, coordinates, turn counts, identity."""
    space = spaces.parse(document)
    fp = hashing.fingerprint(document)
    frames = spaces.to_frames(spark, space)
    units = spaces.units(spaces.legal_blocks(frames), frames).cache()
    size = units.count()
    if not size:
        raise spaces.SpaceError("no legal block")
    cycles = -(-plans.require_count(count) // size)
    rows = plans.with_units(plans.indices(spark, count, size), plans.cycle_order_exact(spark, size, cycles, seed, fp), units)
    leaves, visual = space.axes[leaf], space.axes[space.gated]
    for axis, values, wanted in ((leaf, leaves, F.lit(True)), (space.gated, visual, F.col("modality") == spaces.IMAGE)):
        at = plans.rotation(F.col("unit_index"), F.col("cycle"), len(values)).cast("int")
        rows = rows.withColumn(axis, F.when(wanted, F.get(F.array(*(F.lit(v) for v in values)), at)))
    drawn = [(a, space.axes[a]) for a in space.free if a != leaf]
    rows = plans.free_draws_exact(rows, drawn, seed, fp)
    kind = next((a for a in space.restricted if set(space.turns) <= set(space.axes[a]) and space.turns), None)
    turns = F.lit(1)
    for value, declared in space.turns.items() if kind else ():
        turns = F.when(F.col(kind) == value, spaces.turn_count(declared)).otherwise(turns)
    axes = (*space.restricted, leaf, *(a for a, _ in drawn), space.gated)
    key = F.lit(hashing.run_key(fp, seed, hashing.EXACT))
    rows = rows.withColumn("n_turns", turns).withColumn("id", hashing.row_id(key, F.col("cycle"), F.col("position"))).withColumn("coordinate", plans.coordinate(axes))
    rows = rows.cache()
    digest = hashing.tree_digest(rows, "plan_index", F.to_json(F.struct("id", "coordinate", "n_turns")), hashing.canonical_json([fp, seed, count, hashing.EXACT])).first()["digest"]
    identity = {"space_sha256": fp, "seed": seed, "count": count, "algorithm": hashing.EXACT, "run_key": hashing.run_key(fp, seed), "plan_digest": f"{hashing.TREE}:{digest}"}
    return Context(rows, space, axes, size, count, identity)


def read_bank(spark: SparkSession, out: str) -> DataFrame:
    """Whole records of the run's bank, none if there is no bank yet."""
    store, folder = fs.FileSystem.from_uri(out)
    if store.get_file_info(f"{folder}/{BANK}").type == fs.FileType.NotFound:
        return spark.createDataFrame([], RECORD)
    return bank.whole(bank.read_lines(spark, f"{out}/{BANK}", RECORD))


def bank_contents(spark: SparkSession, out: str) -> dict:
    """Number and digest of all lines of the run's bank, damaged ones too."""
    store, folder = fs.FileSystem.from_uri(out)
    there = store.get_file_info(f"{folder}/{BANK}").type != fs.FileType.NotFound
    lines = spark.read.text(f"{out}/{BANK}") if there else spark.createDataFrame([], "value string")
    return bank.contents(lines).first().asDict()


def _coordinates(own: DataFrame, axes: tuple[str, ...]) -> DataFrame:
    return own.select("id", *(F.col("anchor_meta")[a].alias(a) for a in axes))


def execute(spark: SparkSession, context: Context, out: str, client: Callable[[], generate.Client], concurrency: int = 4, overwrite: bool = False, pictures: Pictures | None = None, smoke: bool = False, in_flight: int = 1, most_failures: int = 0, cooldown: float = 60.0, settings: Mapping | None = None) -> dict:
    """Generates what the bank in `out` lacks, appends it, and returns the manifest.

    A bank of another plan, and a plan whose pictures are not there, are refused
    before anything is written. A run with nothing left to do keeps a finished
    manifest of the same plan and the same bank, byte for byte, as it is. Turns
    are asked for in rounds, `in_flight` requests at a time in each of
    `concurrency` tasks, with a pause where the server fails. Every generated row passes the bank's
    gates or is counted by the one that refuses it. Pictures of the rows that
    are appended are copied to images/<domain>.
    """
    plan, axes = context.plan, context.axes
    before = read_bank(spark, out).limit(0) if overwrite else read_bank(spark, out)
    bank.guard(plan.select("id", *axes), _coordinates(before, axes), axes)
    pending, skipped = with_pictures(context, bank.missing(plan, before), pictures)
    pending = pending.cache()
    todo, had = pending.count(), before.select("id").distinct().count()
    if not todo:
        done = read_json(out, MANIFEST)
        if done and done.get("status") == "finished" and done.get("plan") == context.identity and done.get("records") == had and done.get("bank") == bank_contents(spark, out):
            return done
    if settings is not None:
        write_text(out, "config.toml", config.snapshot(settings))
    write_json(out, PROGRESS, {"plan": context.identity, "pending": todo, "counters_are_live": False})
    specs = pending.select("id", "n_turns", F.lit(None).cast("string").alias("system"), F.to_json(F.map_from_entries("coordinate")).alias("ask"), "picture")
    cooling = rounds.Cooling(most_failures, cooldown)
    made = rounds.converse(specs, client, concurrency, in_flight, cooling)
    gated = None
    try:
        rows = made.where("reason IS NULL").join(pending.select("id", "coordinate", "picture", F.col(context.space.gated).alias("domain")), "id")
        files = rows.where("picture IS NOT NULL").select("domain", F.col("picture").alias("path")).distinct()
        placed = images.copy_targets(files, spark.createDataFrame([], "target string"), folder=F.col("domain")).select("domain", F.col("path").alias("picture"), F.col("target").alias("placed"))
        rows = rows.join(placed, ["domain", "picture"], "left")
        first = F.array_position("roles", "user") - 1  # the turn that shows the picture
        parts = lambda text: F.concat(F.lit("["), F.to_json(F.struct(F.lit("image").alias("type"), F.col("placed").alias("image"))), F.lit(","), F.to_json(F.struct(F.lit("text").alias("type"), text.alias("text"))), F.lit("]"))
        content = lambda x, i: F.when(F.col("placed").isNotNull() & (i == first), parts(x["contents"])).otherwise(x["contents"])
        messages = F.transform(F.arrays_zip("roles", "contents"), lambda x, i: F.struct(x["roles"].alias("role"), content(x, i).alias("content")))
        has = F.col("placed").isNotNull()
        source = F.when(has, records.MULTI_SOURCE).otherwise(records.TEXT_SOURCE)
        meta = F.map_concat(F.map_from_entries("coordinate"), F.create_map(F.lit("has_image"), has.cast("string"), F.lit("image_count"), has.cast("int").cast("string")))
        line = records.record_json(F.col("id"), source, messages, F.col("answer"), F.lit(None).cast("string"), meta, F.lit("client"), F.lit("client"))
        gates = rows.select("id", "domain", "picture", "placed", line.alias("value"), records.shape_ok(records.shape_code(F.col("roles"))).alias("shape_ok"), records.source_ok(source).alias("source_ok"), records.images_ok(has, has.cast("int")).alias("images_ok"))
        gated = bank.append_outcomes(gates, before, ["value"]).persist()
        gated.where(F.col("outcome") == records.APPENDED).select("value").write.mode("overwrite" if overwrite else "append").text(f"{out}/{BANK}")
        copy_placed(spark, gated.where((F.col("outcome") == records.APPENDED) & F.col("placed").isNotNull()).select("picture", "placed").distinct(), out)
        tally = lambda df, c: {r[c]: r["n"] for r in df.groupBy(c).agg(F.count(F.lit(1)).alias("n")).collect()}  # noqa: E731  a row for each class
        reasons, outcomes = tally(made.where("reason IS NOT NULL"), "reason"), tally(gated, "outcome")
    finally:
        if gated is not None:
            gated.unpersist()
    after = read_bank(spark, out)
    document = manifest(context, after, reasons) | {"outcomes": dict(sorted(outcomes.items())), "bank": bank_contents(spark, out)} | ({"cooldowns": cooling.cooldowns} if most_failures else {}) | ({"smoke": True} if smoke else {})
    if pictures is not None:
        document["pictures"] = picture_readout(context, after, pictures, skipped)
        picture_rounds(context, after, pictures).write.mode("overwrite").json(f"{out}/{ROUNDS}")  # a row for each round and domain
    pending.unpersist()
    if document["missing"]:
        warnings.warn(f"{document['missing']} of {context.count} planned rows are not in the bank: {reasons or 'nothing was abandoned'}", stacklevel=2)
    write_json(out, MANIFEST, document)
    row, found = coverage(context, bank.owned(plan, after, pending.limit(0)))
    write_json(out, f"{COVERAGE}.json", {"readout": row, "rules": found})
    write_text(out, f"{COVERAGE}.md", readout.markdown(row, found))
    remove(out, PROGRESS)
    return document


def manifest(context: Context, own: DataFrame, reasons: Mapping[str, int]) -> dict:
    """Tallies of the bank, the plan's identity, coverage and what was abandoned."""
    parts = bank.breakdown(F.col("anchor_meta"), F.col("data_source"))
    flat = own.select("id", *(c.alias(name) for name, c in parts.items())).cache()
    tallies: dict[str, dict[str, int]] = {}
    for r in bank.tallies(flat, list(parts)).orderBy("dimension", "value").collect():  # a row for each value of small axes
        tallies.setdefault(r["dimension"], {})[r["value"]] = r["n"]
    n = flat.select("id").distinct().count()
    flat.unpersist()
    whole, rest, begun = plans.rounds(context.count, context.size)
    out = {"status": "finished", "plan": context.identity, "records": n, "missing": context.count - n, "tallies": tallies, "units": context.size, "density": context.count / context.size, "rounds": {"whole": whole, "rest": rest, "begun": begun}}
    return out | ({"abandoned": dict(sorted(reasons.items()))} if reasons else {})


def coverage(context: Context, plan: DataFrame) -> tuple[dict, list[dict]]:
    """The readout of the owned plan and its rules."""
    leaf = next(a for a in context.axes if a not in context.space.restricted)
    found = readout.structure(plan, context.size, context.space.restricted, context.axes, leaf, ("modality", *context.axes), context.space.gated)
    rules = readout.checks(found, [("distinct coordinates", F.col("distinct_coordinates"), F.least(F.lit(context.size), F.lit(context.count)), ">="), ("rows", F.col("total"), F.lit(context.count), "==")])
    return found.first().asDict(), [r.asDict() for r in rules.collect()]


def picture_readout(context: Context, own: DataFrame, pictures: Pictures, skipped: DataFrame | None) -> dict:
    """Over the whole bank: rows with a picture, files at hand, rounds and domains served from the pool, and rows skipped."""
    found = resolved(context, pictures)
    used = own.where(F.col("anchor_meta")["has_image"] == "true").select("id").join(context.plan.select("id", "cycle", F.col(context.space.gated).alias("domain")), "id")
    both = used.join(found, ["cycle", "domain"])
    n = both.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.col("fallback").cast("long")), F.lit(0)).alias("fallback_rows"), F.sort_array(F.collect_set(F.when(F.col("fallback"), F.col("domain")))).alias("fallback_domains")).first()
    out = n.asDict() | {"candidates": pictures.files.count()}
    if skipped is not None:
        out |= skipped.agg(F.count(F.lit(1)).alias("skipped_rows"), F.sort_array(F.collect_set("domain")).alias("skipped_domains")).first().asDict()
    return out


def picture_rounds(context: Context, own: DataFrame, pictures: Pictures) -> DataFrame:
    """What each round and domain of the plan had to pick from, and how many records of the bank it gave a picture."""
    used = own.where(F.col("anchor_meta")["has_image"] == "true").select("id").join(context.plan.select("id", "cycle", F.col(context.space.gated).alias("domain")), "id")
    return images.round_readout(resolved(context, pictures), used.select("cycle", "domain"), pictures.files, pictures.files)


def referenced(own: DataFrame) -> DataFrame:
    """path of every picture that the bank's messages name, from images/ on."""
    named = F.flatten(F.transform("messages", lambda m: F.regexp_extract_all(m["content"], F.lit(r'"image":"([^"]*)"'), F.lit(1))))
    return own.select(F.explode(named).alias("path")).select(records.relative_image(F.col("path")).alias("path")).distinct()


def prune(spark: SparkSession, out: str, placed: DataFrame) -> int:
    """Deletes pictures (path, below `out`) that this run placed and no record of the bank names; returns how many."""
    gone = images.prunable(placed, referenced(read_bank(spark, out)))

    def drop(parts):
        store, folder = fs.FileSystem.from_uri(out)
        for part in parts:
            there = [p for p in part["path"] if store.get_file_info(f"{folder}/{p}").type == fs.FileType.File]
            for p in there:
                store.delete_file(f"{folder}/{p}")
            yield part[part["path"].isin(there)]

    return gone.select("path").distinct().mapInPandas(drop, "path string").count()


def copy_placed(spark: SparkSession, files: DataFrame, out: str) -> None:
    """Copies files (picture, placed) below `out`, in tasks; each appears whole or not at all."""

    def place(parts):
        store, folder = fs.FileSystem.from_uri(out)
        for part in parts:
            for source, target in zip(part["picture"], part["placed"], strict=True):
                origin, path = fs.FileSystem.from_uri(source if "://" in source or source.startswith("/") else source.replace(":/", ":///", 1))
                store.create_dir(f"{folder}/{target}".rpartition("/")[0], recursive=True)
                at = f"{folder}/{target}.tmp-{uuid.uuid4().hex}"
                with origin.open_input_stream(path, compression=None) as a, store.open_output_stream(at, compression=None) as b:
                    while piece := a.read(1 << 20):
                        b.write(piece)
                store.move(at, f"{folder}/{target}")
            yield part[["placed"]]

    files.mapInPandas(place, "placed string").write.format("noop").mode("overwrite").save()


def copy_pictures(files: DataFrame, out: str) -> DataFrame:
    """Copies pictures (path, content) into out/images and returns path, placed; equal names get a hash of their source."""
    named = files.withColumn("name", F.element_at(F.split("path", "/"), -1))
    same = images.numbered(named, "name", "path", "path")
    target = F.when(F.col("slot") == 0, F.col("name")).otherwise(F.concat(F.substring(F.sha2("path", 256), 1, 8), F.lit("_"), F.col("name")))

    def place(parts):
        store, folder = fs.FileSystem.from_uri(out)
        store.create_dir(f"{folder}/images", recursive=True)
        for part in parts:
            for name, content in zip(part["placed"], part["content"], strict=True):
                at = f"{folder}/images/{name}.tmp-{uuid.uuid4().hex}"
                with store.open_output_stream(at) as f:
                    f.write(content)
                store.move(at, f"{folder}/images/{name}")
            yield part[["path", "placed"]]

    return same.select("path", "content", target.alias("placed")).mapInPandas(place, "path string, placed string")


SETTINGS = {"plan": {"space": str, "count": int, "seed": int, "leaf": str}, "output": {"directory": str}, "images": {"directory": str, "skip_missing": bool}, "run": {"concurrency": int, "in_flight": int, "most_failures": int, "cooldown_seconds": float, "overwrite": bool}}
SETTINGS["endpoint"] = {"base": str, "model": str, "api_key": str, "temperature": float, "thinking": bool, "most_tokens": int, "connect_timeout": float, "first_token_timeout": float, "token_timeout": float, "retries": int, "retry_on_timeout": bool}
#: Fields of an endpoint that go by another name in the configuration.
NAMES = {"api_key": "key", "connect_timeout": "connect", "first_token_timeout": "first_token", "token_timeout": "token"}


def override_of(base: Path, explicit: str | None) -> Path | None:
    """The file over a configuration: the one named, which must be there; else .local/config.override.toml of the checkout; else the one beside the configuration."""
    if explicit is not None:
        found = Path(explicit).expanduser()
        if not found.is_file():
            raise FileNotFoundError(f"no such file over the configuration: {explicit}")
        return found
    folder = base.resolve().parent
    checkout = next((p for p in (folder, *folder.parents) if (p / ".git").exists() or (p / "pyproject.toml").is_file()), None)
    tiers = ([checkout / ".local"] if checkout else []) + [folder]
    return next((p / "config.override.toml" for p in tiers if (p / "config.override.toml").is_file()), None)


def main(argv: list[str] | None = None) -> None:
    """Prints the readout of a plan, and makes its rows if that is wanted: python -m gridloom.run --config FILE [--override FILE] [--image-dir FOLDER] [--smoke] [--generate]."""
    parser = argparse.ArgumentParser(description="Plan a coordinate space, read it out, and generate its rows.")
    parser.add_argument("--config", type=Path, required=True)
    parser.add_argument("--override")
    parser.add_argument("--image-dir")
    parser.add_argument("--smoke", action="store_true")
    parser.add_argument("--generate", action="store_true")
    args = parser.parse_args(argv)
    over = override_of(args.config, args.override)
    settings = config.load(str(args.config), SETTINGS, str(over) if over else None)
    own, asked = settings["plan"], settings["endpoint"]
    where = endpoint.from_config({NAMES.get(k, k): v for k, v in asked.items()}, "endpoint") if args.generate else None  # refused before anything is planned
    spaces.load(own["space"])
    with open(own["space"], encoding="utf-8") as f:
        document = json.load(f)
    spark = SparkSession.builder.getOrCreate()
    context = build(spark, document, min(own["count"], 8) if args.smoke else own["count"], config.seed_of(own["seed"]), own["leaf"] or "knowledge")
    folder = args.image_dir or settings["images"]["directory"]
    pictures = Pictures.read(spark, folder, bool(settings["images"]["skip_missing"])) if folder else None
    plan, _ = with_pictures(context, context.plan, pictures)
    row, rules = coverage(context, plan)
    print(readout.markdown(row, rules))
    if settings["output"]["directory"] or args.generate:
        stamp = F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")
        out = spark.range(1).select(run_folder(F.lit(settings["output"]["directory"] or ""), stamp, args.smoke).alias("f")).first()["f"]
        out = out if "://" in out else Path(out).resolve().as_uri()
        if where is None:
            write_text(out, "config.toml", config.snapshot(settings))
            write_json(out, f"{COVERAGE}.json", {"readout": row, "rules": rules})
            return
        how = {name: v for name, v in (("concurrency", settings["run"]["concurrency"]), ("in_flight", settings["run"]["in_flight"]), ("most_failures", settings["run"]["most_failures"]), ("cooldown", settings["run"]["cooldown_seconds"]), ("overwrite", settings["run"]["overwrite"])) if v is not None}
        print(json.dumps(execute(spark, context, out, lambda: endpoint.Chat(where), pictures=pictures, smoke=args.smoke, settings=settings, **how), indent=2))


if __name__ == "__main__":
    main()
