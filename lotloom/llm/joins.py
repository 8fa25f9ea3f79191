"""Joins on keys that may be hot, and names that clash with nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes up to which the right side of a join is broadcast.
BROADCAST_BYTES = 4 << 20
#: Rows of one key that go to one task.
HOT_ROWS = 50_000


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, with underscores in front until they differ from all columns, whatever their case."""
    taken, out = {c.lower() for c in columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def attach(left: DataFrame, right: DataFrame, on: list[str], spread: list[str], how: str = "left", row_bytes: int = 64) -> DataFrame:
    """``left`` joined with ``right``, which has one row a key and is cheap to read; ``how``: left, inner, left_semi or left_anti.

    A right side of at most BROADCAST_BYTES (its rows times ``row_bytes``) is broadcast. Beyond that both
    sides are shuffled; a key of more than HOT_ROWS rows on the left is dealt, by a hash
    of the columns ``spread``, to several tasks, each of which gets the right row.
    Rows whose key holds a null have no partner.
    """
    most = BROADCAST_BYTES // row_bytes
    if right.limit(most + 1).count() <= most:
        return left.join(F.broadcast(right), on, how)
    salt, salts = unused([*left.columns, *right.columns], "salt", "salts")
    hot = left.groupBy(*on).agg(F.ceil(F.count("*") / HOT_ROWS).cast("int").alias(salts)).where(F.col(salts) > 1)
    if hot.isEmpty():
        return left.join(right, on, how)
    dealt = left.join(hot, on, "left").withColumn(salt, F.coalesce(F.pmod(F.xxhash64(*spread), F.col(salts)), F.lit(0)).cast("int")).drop(salts)
    each = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(salts), F.lit(1)) - 1)).alias(salt)
    copies = right.join(hot, on, "left").select(*right.columns, each)
    return dealt.join(copies, [*on, salt], how).drop(salt)
