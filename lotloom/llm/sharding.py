"""Sharding by a k-d tree of weighted medians (operator 4). DataFrame operations only.

Every document has three coordinates of metadata: size (logarithm), and the places of its source and its language
among all names in order. The
tree starts with all documents and the number of shards; a node of m shards is split along its
widest dimension where the bytes below reach floor(m / 2) parts of m, until a node is one
shard. Its target is the mean of all shards' bytes. Within equal coordinates a hash of the
content decides; it is a dimension of its own only where no metadata has any width.

Split points are found without sorting: bytes are summed by BINS intervals of the key
(coordinate, then content hash), the interval that holds the point is divided again, and
so on until it weighs next to nothing. All nodes of a level share one pass, and only
the sums (at most shards * BINS rows) reach the driver.

What is split are units, not rows: documents of equal text are one unit, so they share a
shard. Those whose bytes exceed TOLERANCE of a shard are several units, which follow each
other in every key, so that only a split point among them parts them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotloom.llm.joins import attach
from lotloom.llm.numbering import gapless
from lotloom.operators.places import numbered
from lotloom.session import Scratch, small_table

BINS_LOG = 12
#: Bits of a coordinate, and of the content hash and the chunk below it in a key.
COORDINATE, HASH, CHUNK = 20, 28, 14
BELOW = HASH + CHUNK
#: Share of a shard's mean bytes that a unit, and the error of a split point, may have.
TOLERANCE = 0.0025
DIMENSIONS = ("size", "source", "lang", "content")  # the last only where the others have no width


def _with_place(units: DataFrame, rows: DataFrame, column: str, scratch: Scratch) -> DataFrame:
    """``units`` with the place of a name among all different names of ``rows`` in order, as a share of 2**COORDINATE.

    So a node is as wide in names as the part of all names that lies between its first and its last one.
    """
    names = scratch.write(rows.select(column).distinct(), f"{column}-names")
    n = max(names.count(), 1)
    at = F.floor((F.col("place") - 1) * (1 << COORDINATE) / n).alias(f"{column}_at")
    places = scratch.write(numbered(names, [F.col(column)]).select(column, at), f"{column}-places")
    return attach(units, places, [column], ["group", "chunk"], "left", 96)


def _coordinates(units: DataFrame) -> DataFrame:
    """group, chunk, bytes, the coordinates as an array, and what follows them in a key."""
    top = 1 << COORDINATE
    size = F.least(F.floor(F.log2(F.col("size").cast("double")) / 40 * top), F.lit(top - 1))
    content = F.pmod(F.xxhash64("group"), F.lit(1 << HASH))
    below = F.shiftleft(content, CHUNK) + F.col("chunk")
    coordinates = F.array(*(c.cast("long") for c in (size, F.col("source_at"), F.col("lang_at"), F.shiftright(content, HASH - COORDINATE))))
    return units.select("group", "chunk", "bytes", coordinates.alias("at"), below.alias("below"))


#: A unit's key in the dimension of its node; ``d`` counts from 0.
KEY = f"(shiftleft(at[d], {BELOW}) + below)"


class _Node:
    """A node of the tree: its shards, and its split once found."""

    def __init__(self, first: int, shards: int) -> None:
        self.first, self.shards = first, shards
        self.dimension = self.cut = None


def grow(spark: SparkSession, units: DataFrame, shards: int, tolerance: float, scratch: Scratch) -> DataFrame:
    """``units`` (coordinates, bytes) with the column node: their shard. Each level is written, so plans stay short."""
    units = scratch.write(units.withColumn("node", F.lit(0)), "level-0")
    level, depth = [_Node(0, shards)], 0
    while nodes := [n for n in level if n.shards > 1]:
        spread = [f(F.col("at")[i]).alias(f"{f.__name__}_{i}") for i in range(len(DIMENSIONS)) for f in (F.min, F.max)]
        facts = {r["node"]: r for r in units.groupBy("node").agg(F.sum("bytes").alias("bytes"), *spread).collect()}
        # for each node: it, the interval that holds its split point, bytes below that, bytes wanted below
        live = {}
        for n in nodes:
            if r := facts.get(n.first):
                width = [r[f"max_{i}"] - r[f"min_{i}"] for i in range(len(DIMENSIONS))]
                n.dimension = max(range(len(DIMENSIONS) - 1), key=width.__getitem__)
                if not width[n.dimension]:
                    n.dimension = len(DIMENSIONS) - 1
                ends = r[f"min_{n.dimension}"] << BELOW, (r[f"max_{n.dimension}"] + 1) << BELOW
                live[n.first] = (n, *ends, 0, r["bytes"] * (n.shards // 2) / n.shards)
            else:
                n.dimension, n.cut = 0, 0
        while live:
            steps = {first: max(0, (hi - lo - 1).bit_length() - BINS_LOG) for first, (_, lo, hi, _, _) in live.items()}
            rows = [(first, n.dimension, lo, hi, steps[first]) for first, (n, lo, hi, _, _) in live.items()]
            looked = F.broadcast(small_table(spark, rows, "node int, d int, lo long, hi long, shift int"))  # at most ``shards`` rows
            inside = units.join(looked, "node").where(f"{KEY} >= lo and {KEY} < hi")
            sums: dict[int, dict[int, int]] = {}
            for r in inside.groupBy("node", F.expr(f"shiftright({KEY} - lo, shift)").alias("bin")).agg(F.sum("bytes").alias("bytes")).collect():
                sums.setdefault(r["node"], {})[r["bin"]] = r["bytes"]
            for first in [*live]:
                n, lo, hi, below, target = live[first]
                width = 1 << steps[first]
                for b, weight in sorted(sums[first].items()):
                    if below + weight >= target:
                        break
                    below += weight
                start, end = lo + b * width, min(lo + (b + 1) * width, hi)
                if weight <= tolerance or width == 1:
                    n.cut = end if below + weight - target <= target - below else start
                    del live[first]
                else:
                    live[first] = (n, start, end, below, target)
        splits = F.broadcast(small_table(spark, [(n.first, n.dimension, n.cut, n.first + n.shards // 2) for n in nodes], "node int, d int, cut long, above int"))
        units = units.join(splits, "node", "left").withColumn("node", F.expr(f"case when {KEY} >= cut then above else node end")).drop("d", "cut", "above")
        depth += 1
        units = scratch.write(units, f"level-{depth}")
        scratch.drop(f"level-{depth - 1}")
        level = [part for n in level for part in ([_Node(n.first, n.shards // 2), _Node(n.first + n.shards // 2, n.shards - n.shards // 2)] if n.shards > 1 else [n])]
    return units


def shard(spark: SparkSession, docs: DataFrame, shards: int = 24, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).

    Size is the UTF-8 bytes of the text and 8; a null text has none. Shards are near equal in
    bytes; equal texts share a shard unless their bytes exceed ``tolerance`` of a
    shard's mean; those lie next to each other. Null source or lang are an empty string,
    a null doc_id stays null; rows that repeat get slots of their own. Columns other than
    doc_id, text, source and lang are ignored, and source and lang may be missing. An empty table gives no rows.
    """
    scratch = Scratch(spark, "sharding")
    extra = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in docs.columns else F.lit("").alias(c) for c in ("source", "lang")]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("group"), *extra)
    rows = scratch.write(rows, "rows")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("n")).first()
    most = max(1.0, total["bytes"] / shards * tolerance)
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.min("source").alias("source"), F.min("lang").alias("lang"))
    # each of these weighs more than ``most``, so there are fewer than shards / tolerance
    chunks = F.least(F.ceil(F.col("bytes") / most), F.col("n"), F.lit(1 << CHUNK)).cast("int").alias("chunks")
    hot = F.broadcast(groups.where((F.col("bytes") > most) & (F.col("n") > 1)).select("group", chunks, F.col("source").alias("s"), F.col("lang").alias("l")))
    chunk = F.coalesce(F.pmod(F.xxhash64("doc_id", "source", "lang"), F.col("chunks")), F.lit(0)).cast("int")
    dealt = rows.join(hot, "group", "left").withColumns({"chunk": chunk, "source": F.coalesce("s", "source"), "lang": F.coalesce("l", "lang")})
    facts = [F.sum("size").alias("bytes"), F.max("size").alias("size"), F.min("source").alias("source"), F.min("lang").alias("lang")]
    units = dealt.groupBy("group", "chunk").agg(*facts)
    for name in ("source", "lang"):
        units = _with_place(units, rows, name, scratch)
    units = _coordinates(units)
    placed = grow(spark, units, shards, most, scratch).select("group", "chunk", F.col("node").alias("shard"))
    out = scratch.write(dealt.join(placed, ["group", "chunk"]).select("doc_id", "size", "text_crc32", "shard"), "sharded")
    counts = {r["shard"]: r["n"] for r in out.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    slotted = gapless(out.withColumn("place", F.col("shard").cast("long")), "place", counts, ["doc_id", "text_crc32", "size"], "slot")
    return slotted.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
