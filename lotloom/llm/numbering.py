"""Gapless numbers within groups of any size, without one task for a group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotloom.session import small_table


def gapless(df: DataFrame, group: str, counts: dict[int, int], order: list[str], name: str) -> DataFrame:
    """``df`` with ``name``: 0, 1, ... within each value of ``group`` (long).

    ``counts`` holds the rows of each value; it must be of bounded size. A group is split by
    a hash of ``order`` into cells of bounded size; rows are numbered within a cell, and
    the sizes of the cells before are added. Rows that are equal in ``order`` get
    different numbers in any order.
    """
    cell = min(max(sum(counts.values()) // 1000, 64), 1_000_000)
    split = small_table(df.sparkSession, [(n, -(-c // cell)) for n, c in counts.items()], f"{group} long, cells int")
    celled = df.join(F.broadcast(split), group).withColumn("cell", F.pmod(F.xxhash64(*order), F.col("cells"))).drop("cells")
    sizes = celled.groupBy(group, "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy(group).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(group, "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    nth = F.row_number().over(Window.partitionBy(group, "cell").orderBy(*order))
    return celled.withColumn("nth", nth).join(sizes, [group, "cell"]).withColumn(name, F.col("earlier") + F.col("nth") - 1).drop("cell", "nth", "earlier")
