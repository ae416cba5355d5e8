"""Numbers and sums along a global order of rows, without a task that holds them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.session import checkpointed


def ranged(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows sorted over all partitions, each with _part, the number of its range, and _row, its number in it; written once.

    Two shuffles into ranges draw their own samples and need not agree, so
    whatever looks at ranges more than once has to read one written table.
    """
    own = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    inside = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # the lower bits count the rows of a partition
    return checkpointed(own.withColumn("_part", F.spark_partition_id()).withColumn("_row", inside))


def firsts(own: DataFrame, amount: str | None = None) -> DataFrame:
    """_part, _first, total of a ranged table: what all earlier ranges hold, and all together; a row for each range."""
    each = F.col(amount) if amount else F.lit(1)
    sums = own.groupBy("_part").agg(F.coalesce(F.sum(each), F.lit(0)).alias("_m"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return sums.select("_part", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_first"), F.sum("_m").over(everything).alias("total"))


def running(rows: DataFrame, order: list[str], amount: str | None = None) -> DataFrame:
    """rows with before, the sum of the column (or count) over all rows that come first in this order, and total, that of all.

    The ranges' sums, one row for each range, go to every task; rows move once.
    Rows alike in the whole order come in an arbitrary order among themselves.
    """
    own = ranged(rows, order)
    both = own.join(F.broadcast(firsts(own, amount)), "_part")  # as many rows as ranges
    if amount is None:
        inside = F.col("_row")
    else:
        inside = F.coalesce(F.sum(amount).over(Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return both.withColumn("before", F.col("_first") + inside).drop("_part", "_row", "_first")
