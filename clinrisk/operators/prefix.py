"""Running sums, minima and maxima over rows of any number, without a one-task window.

The rows are range-partitioned by (group, order), and written once with the
number of their partition.  A second, small table holds the totals of every
(group, partition); its running totals are what is carried into a partition, joined back
to the rows, which are then scanned inside their partition only.  A group that
holds most rows spans many partitions; no literal, list or count goes through
the driver.  Ranks, medians, the area under a curve and the next admission all come from here.

A plain running count (``running_count``: ids) needs no scan: a row's place in its
sorted partition is known as the partition is written, and only the partitions' sizes
are summed up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinrisk.session import default_parallelism, remove_path, scratch_path

_PART, _AT = "__part", "__at"
#: Rows of a range partition: more rows make more partitions, not larger sorts.
ROWS_A_PARTITION = 1_000_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions_for(rows: int, spark: SparkSession) -> int:
    """Partitions of a shuffle of so many rows: the session's number, or more."""
    return max(default_parallelism(spark), -(-rows // ROWS_A_PARTITION))


#: Associative kinds of a scan: the aggregate, and how two totals join.
_KINDS = {"sum": (F.sum, lambda a, b: a + b), "min": (F.min, F.least), "max": (F.max, F.greatest)}


def prefix_scan(df: DataFrame, group: list[str], order: list[str | Column], scans: dict[str, tuple[str, Column]],
                once: bool = True) -> DataFrame:
    """Adds, for every ``name: (kind, value)`` in ``scans``, the ``kind`` (sum,
    min, max) of ``value`` over the rows before this one in its group: 0 or
    NULL for the first.  (group, order) must identify a row for a defined
    result; group columns are never null.

    Range partitioning samples its input, so the input is stored first unless
    it already is a projection of a stored table (``once=False``)."""
    spark = df.sparkSession
    copy = scratch_path(spark, "prefix-input") if once else None
    if copy:
        df.write.parquet(copy)
    base = spark.read.schema(df.schema).parquet(copy) if copy else df
    n = partitions_for(base.count(), spark) if copy else default_parallelism(spark)
    ranged = base.repartitionByRange(n, *group, *order).withColumn(_PART, F.spark_partition_id())
    ranged = stored(ranged, "prefix-ranged")
    if copy:
        remove_path(spark, copy)
    totals = ranged.groupBy(*group, _PART).agg(*[_KINDS[kind][0](v).alias(f"__t_{k}") for k, (kind, v) in scans.items()])
    earlier = Window.partitionBy(*group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*group, _PART, *[_KINDS[kind][0](f"__t_{k}").over(earlier).alias(f"__o_{k}") for k, (kind, _) in scans.items()])
    here = Window.partitionBy(*group, _PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(carried, [*group, _PART])
    for k, (kind, v) in scans.items():
        aggregate, join = _KINDS[kind]
        before, inside = F.col(f"__o_{k}"), aggregate(v).over(here)
        if kind == "sum":
            before, inside = F.coalesce(before, F.lit(0)), F.coalesce(inside, F.lit(0))
        out = out.withColumn(k, join(before, inside))
    return out.drop(_PART, *[f"__o_{k}" for k in scans])


def prefix_sums(df: DataFrame, group: list[str], order: list[str | Column], sums: dict[str, Column],
                once: bool = True) -> DataFrame:
    """``prefix_scan`` of sums."""
    return prefix_scan(df, group, order, {k: ("sum", v) for k, v in sums.items()}, once)


def running_count(df: DataFrame, order: list[str | Column], name: str, once: bool = True,
                  expand: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Adds ``name``, the number of rows before this one in ``order``.  The rows are shuffled and
    written once; the sizes of the partitions, one row each, are all that is joined to them.

    ``expand`` may turn a row into several, in their order (an ``explode``), once the rows are sorted:
    the count is that of the new rows.  ``once``: as for ``prefix_scan``."""
    spark = df.sparkSession
    copy = scratch_path(spark, "prefix-input") if once else None
    if copy:
        df.write.parquet(copy)
    base = spark.read.schema(df.schema).parquet(copy) if copy else df
    placed = base.repartitionByRange(partitions_for(base.count(), spark), *order).sortWithinPartitions(*order)
    # The number of a row: its partition's in the upper 31 bits, its place there in the lower 33.
    placed = stored((expand(placed) if expand else placed).withColumn(_AT, F.monotonically_increasing_id()), "prefix-ranged")
    if copy:
        remove_path(spark, copy)
    part = F.shiftright(_AT, 33)
    sizes = placed.groupBy(part.alias(_PART)).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)      # a row a partition
    sizes = sizes.select(_PART, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__o"))
    out = placed.withColumn(_PART, part).join(F.broadcast(sizes), _PART)
    place = F.col(_AT).bitwiseAND(F.lit((1 << 33) - 1))
    return out.withColumn(name, F.col("__o") + place).drop(_PART, _AT, "__o")
