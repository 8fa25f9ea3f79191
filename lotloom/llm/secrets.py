"""Secret scans over an incremental blob ledger (operator 9). DataFrame operations only.

Each version of each document is a row; its text is a blob named by SHA-256. The ledger
holds the (blob, rule version) pairs scanned so far and their findings. A scan takes the
blobs that the ledger lacks, each once however many documents hold it, appends to the
ledger, and joins the findings of all blobs back to the documents.

Regular expressions give matches but no places. So matches and the pieces between them
(``split`` by the same pattern) become rows, and places are running sums over the rows of a
blob: work grows in proportion to the text, whatever the number of matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotloom.llm.joins import BROADCAST_BYTES, attach, unused
from lotloom.session import Scratch, small_table

#: Bytes of a digest, an id and what a hash table adds to them.
ROW_BYTES = 96
#: Code points of a block in which secrets are masked.
BLOCK = 4096
RULE_VERSION = "1"
#: Fixed patterns: kind, pattern, group whose length counts, least length.
RULES = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
#: Of a run that is one match, only long ones matter; these patterns match the same long runs and no short ones.
LONG = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}


SPANS = "array<struct<start:int,rank:int,kind:string,last:int>>"


def _parts(text: Column, rank: int) -> Column:
    """Matches of a rule in order: code points before the match (from the last one's end), of the match, whether it counts."""
    kind, pattern, group, least = RULES[rank]
    pattern = LONG.get(kind, pattern)
    size = lambda g: F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(g)), F.length)
    gaps = F.transform(F.split(text, pattern, -1), F.length)  # one more than matches: what follows the last has no size
    parts = F.arrays_zip(gaps.alias("gap"), size(0).alias("size"), (size(group) if group else size(0)).alias("counts"))
    return F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), F.lit(least).alias("least"), F.when(text.rlike(pattern), parts).alias("parts"))


def find(texts: DataFrame) -> DataFrame:
    """Spans of each blob of ``texts`` (blob, text), by start, then rule; blobs without any are left out. Rows that repeat count once."""
    rules = texts.select("blob", F.explode(F.array(*(_parts(F.col("text"), i) for i in range(len(RULES))))).alias("r")).where("r.parts is not null")
    rows = rules.select("blob", "r.rank", "r.kind", "r.least", F.posexplode("r.parts").alias("at", "m")).where("m.size is not null")
    rows = rows.dropDuplicates(["blob", "rank", "at"])
    end = F.sum(F.col("m.gap") + F.col("m.size")).over(Window.partitionBy("blob", "rank").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)).cast("int")
    kept = rows.withColumn("last", end).where("m.counts >= least")
    span = F.struct((F.col("last") - F.col("m.size")).alias("start"), "rank", "kind", "last")
    return kept.groupBy("blob").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def scan(spark: SparkSession, docs: DataFrame, ledger: str | None = None, rule_version: str = RULE_VERSION, version: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text) as doc_id, blob, spans (start, rank, kind, last).

    ``ledger`` is a folder of three tables that grows with each scan: scanned, findings, and paths, which says for each
    ``version`` of the table what blob each document was (``history`` joins them). A version is one above the newest where
    none is given; one that is scanned again replaces its paths. Without a folder a new ledger in the shared folder is used. A null text is the empty
    blob. Rows that repeat, or share a text, have the same spans. Null ids stay null;
    further columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(spark, "secrets")
    ledger = ledger or scratch.path("ledger")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    blob = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    version = 1 + _newest(spark, ledger) if version is None else version
    docs.select("doc_id", blob.alias("blob")).write.mode("overwrite").parquet(f"{ledger}/paths/version={version}")
    paths = spark.read.schema("doc_id long, blob binary").parquet(f"{ledger}/paths/version={version}")
    owners = paths.groupBy("blob").agg(F.min("doc_id").alias("owner"))
    known = _ledger(spark, ledger, "scanned", "blob binary, rule_version string").where(F.col("rule_version") == rule_version).select("blob").distinct()
    unseen = scratch.write(owners.join(known, "blob", "left_anti"), "unseen")
    n, total = unseen.count(), paths.count()
    if n:
        texts = _of_owners(docs.withColumn("blob", blob), paths, unseen, n, total)
        find(texts).withColumn("rule_version", F.lit(rule_version)).write.mode("append").parquet(f"{ledger}/findings")
        unseen.select("blob", F.lit(rule_version).alias("rule_version")).write.mode("append").parquet(f"{ledger}/scanned")
    return _with_findings(spark, paths, ledger, rule_version, scratch).select("doc_id", "blob", "spans")


def _with_findings(spark: SparkSession, paths: DataFrame, ledger: str, rule_version: str, scratch: Scratch) -> DataFrame:
    """Paths (doc_id, blob, ...) with the spans of their blobs; none is an empty array."""
    findings = _ledger(spark, ledger, "findings", f"blob binary, spans {SPANS}, rule_version string")
    # two scans at once may both have found a blob
    findings = scratch.write(findings.where(F.col("rule_version") == rule_version).groupBy("blob").agg(F.min("spans").alias("spans")), "found")
    spans = findings.agg(F.coalesce(F.avg(F.size("spans")), F.lit(0.0))).first()[0]
    found = attach(paths, findings, ["blob"], ["doc_id"], "left", ROW_BYTES + int(48 * spans))
    return found.withColumn("spans", F.coalesce("spans", F.array().cast(SPANS)))


def _newest(spark: SparkSession, ledger: str) -> int:
    """The newest version whose paths the ledger holds, 0 if there is none: from the names of its folders, one a version."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ledger}/paths")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return max((int(s.getPath().getName().removeprefix("version=")) for s in fs.listStatus(path) if s.isDirectory()), default=0) if fs.exists(path) else 0


def history(spark: SparkSession, ledger: str, rule_version: str = RULE_VERSION) -> DataFrame:
    """All paths of all versions with the findings of their blobs: doc_id, version, blob, spans.

    A secret that a later version of a document no longer has still shows under the version that had it. Blobs that
    these rules haven't scanned have a null ``spans``; a ledger without scans gives no rows.
    """
    scanned = _ledger(spark, ledger, "scanned", "blob binary, rule_version string").where(F.col("rule_version") == rule_version).select("blob", F.lit(True).alias("seen")).distinct()
    paths = _ledger(spark, ledger, "paths", "doc_id long, blob binary, version int")
    scratch = Scratch(spark, "history")
    known = attach(paths, scratch.write(scanned, "seen"), ["blob"], ["doc_id", "version"], "left", ROW_BYTES)
    found = _with_findings(spark, known, ledger, rule_version, scratch)
    return found.select("doc_id", "version", "blob", F.when(F.col("seen"), F.col("spans")).alias("spans"))


def _of_owners(texts: DataFrame, paths: DataFrame, unseen: DataFrame, n: int, total: int) -> DataFrame:
    """(blob, text) of the owners of the n unseen blobs, of ``total`` rows in all."""
    same = lambda a, b: (a["blob"] == b["blob"]) & a["doc_id"].eqNullSafe(b["doc_id"])
    few = BROADCAST_BYTES // ROW_BYTES
    wanted = unseen.select(F.col("owner").alias("doc_id"), "blob")
    if n == total:
        chosen = texts
    elif total - n <= few < n:  # what to leave is less than what to take
        others = paths.distinct().alias("p").join(unseen.alias("u"), (F.col("p.blob") == F.col("u.blob")) & F.col("p.doc_id").eqNullSafe(F.col("u.owner")), "left_anti").select("doc_id", "blob")
        chosen = texts.join(F.broadcast(others), same(texts, others), "left_anti")
    else:
        chosen = texts.join(F.broadcast(wanted) if n <= few else wanted.hint("shuffle_hash"), same(texts, wanted), "left_semi")
    return chosen.select("blob", "text")


def _ledger(spark: SparkSession, ledger: str, name: str, schema: str) -> DataFrame:
    """A table of the ledger; empty before the first scan."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ledger}/{name}")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return small_table(spark, [], schema)
    return spark.read.schema(schema).parquet(f"{ledger}/{name}")


def summary(found: DataFrame) -> DataFrame:
    """Counts by kind and the digest of each document's spans."""
    text = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["last"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(kind) for kind, *_ in RULES), F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))


def redact(texts: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``texts`` (blob, text, spans; one row a blob) as (blob, text), each run of overlapping spans replaced by ``mark``.

    Texts are cut into blocks of BLOCK code points and spans into their parts in each, so
    the work is in proportion to the text and its spans. A null text is the empty one; without spans a text stays.
    """
    whole = F.coalesce("text", F.lit(""))
    blocks = texts.select("blob", F.posexplode_outer(F.regexp_extract_all(whole, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))).alias("k", "block"))
    by_start = Window.partitionBy("blob").orderBy("s.start", "s.last").rowsBetween(Window.unboundedPreceding, -1)
    runs = texts.select("blob", F.explode("spans").alias("s")).select("blob", "s.start", "s.last", F.coalesce(F.max("s.last").over(by_start), F.lit(0)).alias("done"))
    runs = runs.select("blob", (F.col("start") >= F.col("done")).alias("fresh"), F.greatest("start", "done").alias("start"), "last").where("start < last")
    block_of = lambda c: F.floor(c / BLOCK).cast("int")
    cuts = runs.withColumn("k", F.explode(F.sequence(block_of(F.col("start")), block_of(F.col("last") - 1))))
    low = F.col("k") * BLOCK
    cut = F.struct((F.greatest("start", low) - low).alias("a"), (F.least("last", low + BLOCK) - low).alias("b"), (F.col("fresh") & (F.col("start") >= low)).alias("marks"))
    cuts = cuts.groupBy("blob", "k").agg(F.sort_array(F.collect_list(cut)).alias("cuts"))  # at most BLOCK of them

    def step(acc: Column, c: Column) -> Column:
        gap = F.substring(F.col("block"), acc["at"] + 1, c["a"] - acc["at"])
        return F.struct(c["b"].alias("at"), F.concat(acc["out"], gap, F.when(c["marks"], mark).otherwise("")).alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col("block"), acc["at"] + 1, F.lit(BLOCK)))
    masked = F.when(F.col("cuts").isNull(), F.col("block")).otherwise(F.aggregate("cuts", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, rest))
    done = blocks.join(cuts, ["blob", "k"], "left").select("blob", "k", masked.alias("block"))
    return done.groupBy("blob").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "block"))), lambda b: b["block"]), "").alias("text"))


def mask(spark: SparkSession, docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """``docs`` (doc_id, text) with all secrets in ``text`` masked; n_chars, if there, follows the text.

    Columns keep their names and order. Null and empty texts, repeated rows and rows without
    secrets stay as they are; an empty table stays empty.
    """
    scratch = Scratch(spark, "mask")
    hits = scan(spark, docs, ledger).where(F.size("spans") > 0).select("blob", "spans").dropDuplicates(["blob"])
    key, new = unused(docs.columns, "blob", "masked")
    hits = scratch.write(hits.withColumnRenamed("blob", key), "hits")
    marked = docs.withColumn(key, F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)))
    names = hits.select(key)
    dirty = scratch.write(attach(marked, names, [key], ["doc_id"], "left_semi", ROW_BYTES), "dirty")
    texts = dirty.select(F.col(key), F.col("text").cast("string").alias("text")).dropDuplicates([key]).join(hits, key).withColumnRenamed(key, "blob")
    masked = scratch.write(redact(texts).select(F.col("blob").alias(key), F.col("text").alias(new)), "masked")
    mean = masked.agg(F.coalesce(F.avg(F.octet_length(new)), F.lit(0.0))).first()[0]
    values = {"text": F.col(new).cast(docs.schema["text"].dataType)}
    if "n_chars" in docs.columns:
        values["n_chars"] = F.length(new).cast(docs.schema["n_chars"].dataType)
    joined = attach(dirty, masked, [key], ["doc_id"], "inner", ROW_BYTES + int(mean))
    done = joined.select(*(values.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))
    return attach(marked, names, [key], ["doc_id"], "left_anti", ROW_BYTES).select(*(f"`{c}`" for c in docs.columns)).unionAll(done)
