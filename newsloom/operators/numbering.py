"""Dense arrival numbers without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import stage

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row's place in its low bits


def with_position(df: DataFrame, *order: str | Column, name: str = "position") -> DataFrame:
    """Number the rows 0, 1, 2, ... in the given (total) order.

    The rows are range-sorted, each task numbers its own, and the result is staged, so
    the numbers are fixed from then on. The tasks' row counts - one small row per task -
    then give every task its first number.
    """
    ranked = stage(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    task = F.shiftright("_id", _LOCAL_BITS)
    # As many rows as the sort had tasks.
    sizes = ranked.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_rows"))
    first = sizes.select(
        "_task",
        (F.sum("_rows").over(Window.orderBy("_task")) - F.col("_rows")).alias("_first"),
    )
    return (
        ranked.withColumn("_task", task)
        .join(F.broadcast(first), "_task")
        .withColumn(name, F.col("_first") + F.col("_id").bitwiseAND((1 << _LOCAL_BITS) - 1))
        .drop("_id", "_task", "_first")
    )
