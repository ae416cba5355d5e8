"""What the training-data operators share: shared folders, Arrow buffers, sizes."""

from __future__ import annotations

import ctypes
import functools
import inspect
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Space and the five ASCII control characters from tab to carriage return part words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: The same as a regular expression for Spark and DuckDB.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where the session names none, a local master gets a folder of its own; a
    cluster is refused, as no machine-local folder would be shared there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        found = spark.sparkContext.getCheckpointDir()
    if found is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="gridloom-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


#: Rows and bytes of text in one Arrow batch between Spark and Python.
BATCH_ROWS, BATCH_TEXT = 2_500, 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to what a small executor can hold twice over, whole documents being large rows.

    Plans run later than they are made, so the setting stays; every operator that sends texts makes it, so that all behave alike whichever came first.
    """
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_TEXT)):
        name = f"spark.sql.execution.arrow.{name}"
        now = str(spark.conf.get(name)).lower().removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))


def release() -> None:
    """Gives memory that is no longer used back to the system: Python workers live on between tasks, and so would what one of them once held."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable) -> Callable:
    """run, over batches or a group, with release() before and after it: an idle worker holds nothing while others of its executor work."""
    if inspect.isgeneratorfunction(run):

        def own(*args):
            release()
            try:
                yield from run(*args)
            finally:
                release()

    else:

        def own(*args):
            release()
            try:
                return run(*args)
            finally:
                release()

    own = functools.wraps(run)(own)
    own.__signature__ = inspect.signature(run)  # Spark tells by it whether to give the key
    return own


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of text in all rows: sizes groups so that each fits a task."""
    return df.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0)).alias("n")).first()["n"]


def parts_for(spark: SparkSession, total: int, each: int) -> int:
    """How many groups of about `each` bytes hold `total`, at least one for each shuffle partition."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // each), 1)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, n + 1 offsets and validity of a string or binary column, without copying the bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    n = len(column)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, bool)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    valid = np.ones(n, bool) if column.null_count == 0 else column.is_valid().to_numpy(zero_copy_only=False)
    return raw[off[0] : off[-1]], off - off[0], valid


def batches_of(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold about `limit` units together; a longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


#: Bytes of a table that is sent to all executors, where it takes several times as many of the heap.
SMALL_BYTES = 16 << 20


def table_bytes(df: DataFrame) -> int:
    """About how many bytes the rows take: 16 for a row, 8 for a value, and the lengths of strings."""
    size = F.lit(16 + 8 * len(df.columns))
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType | T.BinaryType):
            size = size + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
    return df.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0)).alias("n")).first()["n"]


#: Bytes of a small table that one task reads.
PART_BYTES = 1 << 20


def few(df: DataFrame, total: int) -> DataFrame:
    """A table of `total` bytes in as many partitions as they need, one for each core at least: small tables cost few tasks and files, whatever the number of shuffle partitions."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-total // PART_BYTES)))


def small(df: DataFrame) -> DataFrame:
    """The table, marked for broadcast if its rows are found to take few bytes; else Spark shuffles it."""
    df = checkpointed(df)
    total = table_bytes(df)
    return F.broadcast(few(df, total)) if total <= SMALL_BYTES else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores behind it until the table has no such column, in whatever case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def columns(df: DataFrame, *more: str) -> list[F.Column]:
    """All columns, whatever characters their names have."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in (*df.columns, *more)]
