"""Tables that change together: what a run writes counts as a whole or not at all.

Rows of a commit are Parquet files in folders of their own. A manifest, a small JSON file that appears by one
rename, names these folders and makes them count, so a run that dies halfway leaves nothing that
readers see. Readers take the rows of all manifests, or of those up to an earlier commit. Rows bear
the number of their ``commit``, by which Spark leaves out folders that a reader doesn't ask for.

Two writers that start from one commit can't both follow it: the second one's rename fails, and it
has to look again at what is stored. A commit with a ``key`` (a stream's batch) happens once, however often it is tried.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotloom.operators import ledger

MANIFEST = "commit long, what string, key string, tables map<string,string>"


class Conflict(RuntimeError):
    """Another writer was first."""


class Store:
    """Tables below ``path``, a folder that all machines share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _hadoop(self, where: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def commits(self) -> list[dict]:
        """The manifests in order; one a commit, so a list for the driver."""
        fs, path = self._hadoop(f"{self.path}/commits")
        if not fs.exists(path):
            return []
        found = self.spark.read.schema(MANIFEST).option("pathGlobFilter", "*.json").json(f"{self.path}/commits").collect()
        return sorted((r.asDict() for r in found), key=lambda m: m["commit"])

    def head(self) -> int:
        """The number of the newest commit, 0 before the first."""
        return max((m["commit"] for m in self.commits()), default=0)

    def read(self, table: str, as_of: int | None = None, after: int = 0) -> DataFrame | None:
        """Rows of a table from the commits behind ``after`` up to ``as_of``, with their ``commit``; None if these wrote none."""
        folders = [f"{self.path}/{m['tables'][table]}" for m in self.commits() if table in m["tables"] and m["commit"] > after and (as_of is None or m["commit"] <= as_of)]
        return self.spark.read.option("basePath", f"{self.path}/{table}").parquet(*folders).drop("try") if folders else None

    def commit(self, tables: dict[str, DataFrame], base: int, what: str, key: str | None = None) -> int:
        """Add rows to tables as the commit that follows ``base``; its number. With a known ``key`` nothing is written."""
        known = [m["commit"] for m in self.commits() if key is not None and m["key"] == key]
        if known:
            return known[0]
        number, attempt = base + 1, f"t{uuid.uuid4().hex}"
        folders = {name: f"{name}/commit={number}/try={attempt}" for name in tables}
        for name, rows in tables.items():
            rows.drop("commit").write.parquet(f"{self.path}/{folders[name]}")
        self._publish(number, {"commit": number, "what": what, "key": key, "tables": folders})
        return number

    def _publish(self, number: int, manifest: dict) -> None:
        fs, draft = self._hadoop(f"{self.path}/commits/.{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = gateway.new_array(kind, 1)
        options[0] = kind.NONE  # an existing file isn't replaced
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            files.rename(draft, self._hadoop(f"{self.path}/commits/{number:012d}.json")[1], options)
        except Py4JJavaError as e:
            fs.delete(draft, False)
            if "FileAlreadyExists" in str(e.java_exception):
                raise Conflict(f"commit {number} is another writer's") from None
            raise


def records(store: Store, as_of: int | None = None) -> DataFrame | None:
    """The current version of each record, or that at an earlier commit."""
    log = store.read("log", as_of)
    return None if log is None else ledger.record_versions(log)


def parts(store: Store, table: str, id_: str, as_of: int | None = None) -> DataFrame | None:
    """Lots or verdicts that the records of a commit point to: those written under a record's ``parts_version``."""
    rows, now = store.read(table, as_of), records(store, as_of)
    if rows is None or now is None:
        return None
    pointed = now.select(F.col("id").alias(id_), F.col("parts_version").alias("version"))
    return rows.join(pointed, [id_, "version"], "left_semi")


def saved(store: Store, incoming: DataFrame, lots: DataFrame, verdicts: DataFrame | None, now: Column, what: str = "run", key: str | None = None, base: int | None = None) -> int:
    """Store records with the lots and verdicts that replace their older ones; the commit's number.

    ``incoming`` (id, exchange, file_name, ...) gets versions that follow the stored ones, under the
    stored id where the file is known; lots (processing_log_id) and verdicts (id) of the incoming ids go with them.
    """
    base = store.head() if base is None else base
    old = records(store, base)
    fresh = ledger.latest(incoming, ["exchange", "file_name"]).withColumn("_own", F.col("id"))
    own = {c: F.col(f"_new_{c}") for c in ("error_message", "finalized_at") if c in incoming.columns}  # what the new version says, not the old one
    fresh = fresh.withColumns({f"_new_{c}": F.col(c) for c in own})
    fresh = ledger.upserted(fresh.limit(0).withColumn("version", F.lit(0)) if old is None else old, fresh, now)
    fresh = fresh.withColumns({**own, "parts_version": F.col("version")}).drop(*(f"_new_{c}" for c in own))
    ids = fresh.select(F.col("_own"), F.col("id").alias("_id"), "version")

    def owned(rows: DataFrame, name: str) -> DataFrame:
        return rows.drop("version").join(ids, rows[name] == F.col("_own")).withColumn(name, F.col("_id")).drop("_own", "_id")

    tables = {"lots": owned(lots, "processing_log_id"), "log": fresh.drop("_own")}
    if verdicts is not None:
        tables["verdicts"] = owned(verdicts, "id")
    return store.commit(tables, base, what, key)


def changed(store: Store, rows: DataFrame, what: str, base: int) -> int:
    """Store new versions of records that keep their lots and verdicts (``ledger.moved`` and its like)."""
    return store.commit({"log": rows}, base, what)


def rolled_back(store: Store, chosen: Column, as_of: int, now: Column) -> int:
    """Put the chosen records back to what they were at an earlier commit, lots and verdicts included; how many that are.

    They get new versions that point to the lots and verdicts of that time; nothing is copied or removed.
    A record that wasn't there then becomes NEW and points to none.
    """
    base = store.head()
    if base == 0:
        return 0
    today = records(store, base).where(chosen)  # type: ignore[union-attr]
    then = records(store, as_of)
    keys = ["exchange", "file_name"]
    next_ = today.select(*keys, F.col("id").alias("_id"), (F.col("version") + 1).alias("_v"), F.col("parts_version").alias("_p"), F.struct(*today.columns).alias("_today"))
    then = today.limit(0) if then is None else then
    old = then.select(*keys, F.struct(*(F.col(c) if c in then.columns else F.lit(None).cast(today.schema[c].dataType).alias(c) for c in today.columns)).alias("_then"))
    both = next_.join(old, keys, "left")
    back = F.coalesce("_then", "_today")
    out = both.select(*(back[c].alias(c) for c in today.columns), "_v", "_then")
    gone = F.col("_then").isNull()
    rows = out.withColumns({
        "version": F.col("_v"), "updated_at": now, "status": F.when(gone, "NEW").otherwise(F.col("status")), "parts_version": F.when(~gone, F.col("parts_version")),
        **{c: F.when(~gone, F.col(c)) for c in ("finalized_at", "validation_results", "failed_rules") if c in today.columns},
    }).drop("_v", "_then")
    n = rows.count()
    if n:
        store.commit({"log": rows}, base, f"roll back to {as_of}")
    return n
