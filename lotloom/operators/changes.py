"""The feed of unlock events kept by what changes between commits of the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotloom.operators import calendar
from lotloom.operators import master as issuers
from lotloom.operators.store import Store, parts, records

_MASTER = "bse_script_code string, nse_symbol string, company_name string, ipo_name string, post_issue_shares bigint"


def _events(ledger: Store, commit: int, symbols: DataFrame) -> DataFrame | None:
    """Events of some symbols at a commit, without the issuer's columns, which aren't the ledger's."""
    log, lots = records(ledger, commit), parts(ledger, "lots", "processing_log_id", commit)
    if log is None or lots is None:
        return None
    own = log.join(symbols, "unique_symbol", "left_semi")
    none = ledger.spark.createDataFrame([], _MASTER)
    return calendar.unlock_events(own, lots.join(own.select(F.col("id").alias("processing_log_id")), "processing_log_id", "left_semi"), none).drop("company_name")


def event_changes(ledger: Store, after: int, upto: int) -> DataFrame | None:
    """Events that came (change 1, or how many equal ones) and went (-1) between two commits; None if none of them wrote records.

    Only symbols with a record in these commits are looked at, on both sides: a symbol's events depend on
    its newest record alone, so no other symbol's can have changed.
    """
    log = ledger.read("log", upto, after)
    if log is None:
        return None
    symbols = log.select("unique_symbol").distinct()
    sides = [side.withColumn("change", F.lit(sign)) for sign, commit in ((-1, after), (1, upto)) if (side := _events(ledger, commit, symbols)) is not None]
    if not sides:
        return None
    both = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
    return both.groupBy(*(c for c in both.columns if c != "change")).agg(F.sum("change").alias("change")).where("change <> 0")


def covered(feed: Store) -> int:
    """The commit of the ledger that the feed has come to."""
    return max((int(m["key"]) for m in feed.commits()), default=0)


def update(feed: Store, ledger: Store) -> int:
    """Bring the feed up to the ledger's newest commit; the commit it has come to. A repeated update adds nothing."""
    after, upto = covered(feed), ledger.head()
    if upto > after:
        delta = event_changes(ledger, after, upto)
        feed.commit({} if delta is None else {"events": delta}, feed.head(), f"ledger {after + 1} to {upto}", str(upto))
    return upto


def events(feed: Store, master: DataFrame, as_of: int | None = None) -> DataFrame | None:
    """The events of the feed now or at an earlier commit of it, with the issuers' names; None before the first."""
    deltas = feed.read("events", as_of)
    if deltas is None:
        return None
    own = [c for c in deltas.columns if c not in ("change", "commit")]
    left = deltas.groupBy(*own).agg(F.sum("change").alias("change")).where("change > 0")
    return issuers.with_master(left, master).select(*own, F.coalesce("company_name", "ipo_name").alias("company_name"))


def since(feed: Store, after: int) -> DataFrame | None:
    """What came and went in the feed behind one of its commits, net; a reader that applies it to what it has is up to date. Reads the later deltas only."""
    deltas = feed.read("events", after=after)
    return None if deltas is None else deltas.groupBy(*(c for c in deltas.columns if c not in ("change", "commit"))).agg(F.sum("change").alias("change")).where("change <> 0")
