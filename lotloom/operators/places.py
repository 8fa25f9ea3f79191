"""Gapless places in an order, without one task for all rows or for a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotloom.session import Scratch


def numbered(rows: DataFrame, order: list[Column], name: str = "place", within: str | None = None) -> DataFrame:
    """``rows`` with ``name``: 1, 2, ... in ``order``, within each value of the column ``within`` or over all rows.

    Rows are sorted by ranges, and a row's place is its place in its range plus the rows of its group in the ranges
    before; only these counts, one row a range and group, meet in a window. Rows equal in ``order`` are numbered in any
    order and may lie in several ranges, so that no value is one task's work. Null is a group like others.
    """
    scratch = Scratch(rows.sparkSession, "places")
    group = F.lit(0) if within is None else F.xxhash64(within)  # groups with one hash are told apart by the order below
    own = scratch.write(rows.withColumns({"_group": group, "_tie": F.monotonically_increasing_id()}), "tied")
    by = [F.col("_group"), *([F.col(within)] if within else []), *order, F.col("_tie")]
    part = {"_part": F.spark_partition_id(), "_pos": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}
    placed = scratch.write(own.repartitionByRange(*by).sortWithinPartitions(*by).withColumns(part), "sorted")
    keys = ["_group", *([within] if within else [])]
    counts = placed.groupBy("_part", *keys).agg(F.count("*").alias("_n"), F.min("_pos").alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in ("_part", *keys)]
    found = placed.alias("r").join(counts.alias("c"), [*same])
    return found.select(*(F.col(f"r.{c}") for c in rows.columns), (F.col("c._before") + F.col("r._pos") - F.col("c._first") + 1).alias(name))
