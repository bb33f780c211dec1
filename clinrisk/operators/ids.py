"""Dense surrogate ids (1..n in a given order)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinrisk.operators.prefix import running_count


def dense_ids(df: DataFrame, order_cols: list[str | Column], id_col: str, start: int | Column = 1,
              once: bool = True) -> DataFrame:
    """Add ``id_col`` = position of the row in ``order_cols`` order, from
    ``start``: a running count over range partitions (``running_count``).  The order columns must
    identify a row."""
    first = F.lit(start) if isinstance(start, int) else start
    numbered = running_count(df, order_cols, "__before", once=once)
    return numbered.withColumn(id_col, (first + F.col("__before")).cast("bigint")).drop("__before")
