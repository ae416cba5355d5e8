"""Banks of JSON lines by ranges of bytes: lines with their numbers, and ids read on from where the last scan ended.

A line belongs to the range that holds its first byte, so ranges of one large
file are read by different tasks. Files are read as long as the listing says
they are; what is appended meanwhile is for the next scan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.operators import bank, ordering
from gridloom.session import checkpointed

RANGE = 64 << 20  #: bytes of a file that a task reads at a time
CHUNK = 4 << 20  #: bytes read, and bytes of lines handed on, at once
EDGE = 64 << 10  #: bytes at either end of what a scan has read by which the next one knows the file again
STATE = "path string, offset bigint, lines bigint, edges string, since bigint"
IDS = "path string, number bigint, next bigint, whole boolean, id string"


def _opened(path: str):
    """A file by the path that Spark lists."""
    store, own = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    return store.open_input_file(own)


def files(spark: SparkSession, folder: str) -> DataFrame:
    """path, length of all files below a folder; their contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")


def pieces(found: DataFrame, size: int = RANGE) -> DataFrame:
    """Ranges [start, stop) of files (path, length, offset, lines) from the offset on, dealt out over tasks."""
    steps = F.sequence(F.col("offset"), F.col("length") - 1, F.lit(size).cast("long"))
    out = found.where("offset < length").select("path", "length", "offset", "lines", F.explode(steps).alias("start"))
    out = out.withColumn("stop", F.least(F.col("start") + size, F.col("length")))
    return _dealt(out, out.count())


def _dealt(ranges: DataFrame, n: int) -> DataFrame:
    """A stated number of partitions, as Spark would put so few bytes into one."""
    return ranges.repartition(max(1, min(n, 16 * ranges.sparkSession.sparkContext.defaultParallelism)))


def count_in(f, start: int, stop: int) -> int:
    """How many lines begin in [start, stop)."""
    at, n = max(start - 1, 0), int(start == 0)
    f.seek(at)
    while at < stop - 1 and (part := f.read(min(CHUNK, stop - 1 - at))):
        n += part.count(b"\n")
        at += len(part)
    return n


def lines_in(f, start: int, stop: int, length: int) -> Iterator[tuple[bytes, int, bool]]:
    """Lines that begin in [start, stop), each with the offset behind it and whether its end is there."""
    base, held, seen, partial = max(start - 1, 0), bytearray(), 0, start > 0
    f.seek(base)
    while base < stop:
        cut = held.find(b"\n", seen)
        if cut < 0:
            seen = len(held)
            part = f.read(min(CHUNK, length - base - seen))
            if part:
                held += part
                continue
            if held and not partial:
                yield bytes(held), base + len(held), False
            return
        if not partial:
            yield bytes(held[:cut]), base + cut + 1, True
        partial, base, seen = False, base + cut + 1, 0
        del held[: cut + 1]


def _count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        counts = []
        for r in part.itertuples():
            with _opened(r.path) as f:
                counts.append(count_in(f, r.start, r.stop))
        yield part.assign(held=counts)


def _read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["path", "number", "line", "next", "whole", "value"]
    for part in parts:
        for r in part.itertuples():
            out, size = [], 0
            with _opened(r.path) as f:
                for i, (text, after, whole) in enumerate(lines_in(f, r.start, r.stop, r.length)):
                    out.append((r.path, r.first + i, r.before + i, after, whole, text.decode(errors="replace")))
                    size += len(text) + 64
                    if size >= CHUNK:
                        yield pd.DataFrame(out, columns=columns)
                        out, size = [], 0
            if out:
                yield pd.DataFrame(out, columns=columns)


def read(ranges: DataFrame) -> DataFrame:
    """path, number, line, next, whole, value of the lines in ranges, as `pieces` makes them.

    number counts from 0 in the file, line over all ranges in order of path and
    place; next is the offset behind the line; whole is false for a last line
    without an end. Newlines are counted first, and sums of the counts tell
    each range its first number, so that tasks read on their own.
    """
    own = "path string, length bigint, offset bigint, lines bigint, start bigint, stop bigint"
    counted = ordering.running(ranges.mapInPandas(_count, f"{own}, held bigint"), ["path", "start"], "held")
    first = F.col("lines") + F.col("before") - F.min("before").over(Window.partitionBy("path"))
    placed = checkpointed(counted.select("path", "length", "start", "stop", first.alias("first"), F.col("before").cast("long").alias("before")))
    return _dealt(placed, placed.count()).mapInPandas(_read, "path string, number bigint, line bigint, next bigint, whole boolean, value string")


def numbered(spark: SparkSession, folder: str, size: int = RANGE) -> DataFrame:
    """All lines below a folder with their numbers, blank ones too; see `read`."""
    whole = files(spark, folder).select("path", "length", F.lit(0).cast("long").alias("offset"), F.lit(0).cast("long").alias("lines"))
    return read(pieces(whole, size))


# ids, read on


def edges_of(f, offset: int) -> str | None:
    """Digest of both ends of the first `offset` bytes; null where they don't end on a line's end."""
    head = f.read(min(EDGE, offset))
    f.seek(max(0, offset - EDGE))
    tail = f.read(min(EDGE, offset))
    return hashlib.sha256(head + tail).hexdigest() if tail.endswith(b"\n") else None


def _prove(scan: int):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for r in part.itertuples():
                same = False
                if pd.notna(r.offset) and 0 < r.offset <= r.length:
                    with _opened(r.path) as f:
                        same = edges_of(f, int(r.offset)) == r.edges
                out.append((r.path, r.length, int(r.offset), int(r.lines), int(r.since)) if same else (r.path, r.length, 0, 0, scan))
            yield pd.DataFrame(out, columns=["path", "length", "offset", "lines", "since"])

    return run


def _edges(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        found = []
        for r in part.itertuples():
            with _opened(r.path) as f:
                found.append(edges_of(f, r.offset) if r.offset else None)
        yield part.assign(edges=found)[["path", "offset", "lines", "edges", "since"]]


def last_scan(state: str) -> int:
    """The newest scan that was finished, 0 if none was."""
    store, base = fs.FileSystem.from_uri(state)
    found = [i.path for i in store.get_file_info(fs.FileSelector(f"{base}/files", allow_not_found=True)) if "scan=" in i.base_name]
    done = store.get_file_info([f"{p}/_SUCCESS" for p in found]) if found else []
    return max((int(p.rpartition("=")[2]) for p, i in zip(found, done, strict=True) if i.type == fs.FileType.File), default=0)


def known_ids(spark: SparkSession, folder: str, state: str, size: int = RANGE) -> DataFrame:
    """id: distinct string ids of the records below a folder; only what was appended since the last call is read.

    `state` is a folder of tables: for each file how far it was read, and the
    ids found. A file is read on where it is at least as long as then, and what
    was read ends on a line's end and has the same EDGE bytes at both ends;
    otherwise it is read anew and its earlier ids don't count. Ids of files
    that are gone don't count either. A last line without an end counts, and is
    read again next time. A scan counts once its table of files is there,
    so one that was killed is made again under the same number.
    """
    last = last_scan(state)
    scan = last + 1
    old = spark.read.schema(STATE).parquet(f"{state}/files/scan={last}") if last else spark.createDataFrame([], STATE)
    both = files(spark, folder).join(old, "path", "left")
    now = checkpointed(both.mapInPandas(_prove(scan), "path string, length bigint, offset bigint, lines bigint, since bigint"))
    fresh = read(pieces(now, size)).select("path", "number", "next", "whole", bank.string_id(F.col("value")).alias("id"))
    fresh.write.mode("overwrite").parquet(f"{state}/ids/scan={scan}")
    ends = spark.read.schema(IDS).parquet(f"{state}/ids/scan={scan}").where("whole").groupBy("path").agg(F.max("next").alias("end"), (F.max("number") + 1).alias("n"))
    moved = now.join(ends, "path", "left").select("path", F.coalesce("end", "offset").alias("offset"), F.coalesce("n", "lines").alias("lines"), "since")
    moved.mapInPandas(_edges, STATE).write.mode("overwrite").parquet(f"{state}/files/scan={scan}")
    return ids_of(spark, state, scan)


def ids_of(spark: SparkSession, state: str, scan: int) -> DataFrame:
    """id: what is known after a scan, without looking at the files."""
    found = spark.read.schema(f"{IDS}, scan bigint").parquet(f"{state}/ids").where(F.col("scan") <= scan)
    valid = spark.read.schema(STATE).parquet(f"{state}/files/scan={scan}").select("path", "since")
    kept = found.join(valid, "path").where((F.col("scan") >= F.col("since")) & (F.col("whole") | (F.col("scan") == scan)))
    return kept.where("id IS NOT NULL").select("id").distinct()
