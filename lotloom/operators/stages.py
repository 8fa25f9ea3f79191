"""Work that is done once for each different content."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotloom.operators.store import Store


def once(store: Store, name: str, version: str, rows: DataFrame, inputs: tuple[str, ...], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` with the column ``name`` that ``work`` adds, which may depend on the columns ``inputs`` only.

    Results are kept in the store by a digest of these columns and ``version``. Only contents without a
    result are worked on, each once, however many rows bear them; then results join back to all rows. Another
    version does everything anew and leaves the results of the old one. Where all is known, ``work`` isn't even called.
    """
    base = store.head()
    written = F.to_json(F.struct(*(F.col(c) for c in inputs)), {"ignoreNullFields": "false"})
    keyed = rows.withColumn("_digest", F.sha2(written.cast("binary"), 256))
    results = store.read(name, base)
    known = None if results is None else results.where(F.col("version") == version).select("_digest", name)
    fresh = (keyed if known is None else keyed.join(known.select("_digest"), "_digest", "left_anti")).select("_digest", *inputs).dropDuplicates(["_digest"])
    if not fresh.isEmpty():
        store.commit({name: work(fresh).select("_digest", F.lit(version).alias("version"), name)}, base, f"{name} {version}")
        known = store.read(name).where(F.col("version") == version).select("_digest", name)  # type: ignore[union-attr]
    if known is None:
        known = work(fresh).select("_digest", name).limit(0)
    return keyed.join(known, "_digest", "left").drop("_digest")
