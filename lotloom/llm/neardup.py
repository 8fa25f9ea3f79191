"""MinHash near-duplicate detection with odd sketches (operator 6).

Every text gets the set of its distinct five-word shingles, MinHash samples of that
set, band keys of the samples, and an odd sketch: the samples folded into a parity
bitmap, whose XOR population count between two texts estimates their similarity.

1. Texts with equal sets collapse into one class, named by its smallest doc_id.
2. Classes that share a band key are candidates. A bucket never emits all its pairs:
   first each class is paired with the smallest first member of its buckets, then, in
   buckets that hold several components, with the first member of each.
3. Pairs whose sketches agree well enough are confirmed on full shingle sets, and the
   links are closed to components.
4. Buckets that still hold several components compare members across components in blocks
   of bounded size: first by their sketches, which leaves the members with a likely partner whose
   first common band is this one, then these with their full sets. A block tests the likeliest pairs first, joins
   components as it finds links, and emits only those.
5. Components come from large-star / small-star rounds over written edge tables.

Shingles are hashes of 64 bits: that two different ones of n in the corpus share a hash has
a chance of about n * n / 3.7e19, and a link changes only if such a pair meets in two texts at the threshold.

Bands and sketches may lose a link (see BANDS, LEAST_ESTIMATE). With ``exact`` they give way to
prefixes: sets are sorted by hash, and two sets at the threshold share a value
among the first size - ceil(percent * size / 100) + 1 of each, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotloom.llm.joins import attach
from lotloom.llm.textvec import BLANK, Words, mix, slices
from lotloom.session import Scratch, small_batches

SHINGLE = 5
#: A pair at similarity 0.75 shares none of the bands with probability 2.5e-7.
BANDS, ROWS = 40, 4
SKETCH_BITS = 1024
#: Sketch estimates below this end a candidate; a true 0.75 lies five deviations above.
LEAST_ESTIMATE = 0.57
#: Members of one block in the comparison across components, and bytes of their sets.
BLOCK, BLOCK_BYTES = 2048, 8 << 20
#: Ids (8 bytes each) up to which a set of them is broadcast; more are shuffled.
BROADCAST_IDS = 100_000
#: Pairs of one leader whose sets meet in one task.
LEADER_PAIRS = 4096

_RNG = np.random.default_rng(8128)
_XOR = _RNG.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
_MUL = _RNG.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_PLACE = _RNG.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)

SIGNATURE = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>"


def minhash(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Samples (rows x BANDS * ROWS) of the non-empty sets ``values[at[i]:at[i + 1]]``."""
    v = (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(at) - 1, BANDS * ROWS), np.uint32)
    for i in range(BANDS * ROWS):
        out[:, i] = np.minimum.reduceat((v ^ _XOR[i]) * _MUL[i], at[:-1])
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the samples, as rows of 64-bit words."""
    n = len(samples)
    bit = mix(samples.astype(np.uint64) * _PLACE + _PLACE[::-1]) % np.uint64(SKETCH_BITS)
    at = bit.astype(np.int64) + np.arange(n)[:, None] * SKETCH_BITS
    odd = (np.bincount(at.ravel(), minlength=n * SKETCH_BITS) & 1).astype(np.uint8).reshape(n, SKETCH_BITS)
    return np.packbits(odd, axis=1, bitorder="little").view(np.int64)


def estimate(differing):
    """Similarity for a number of differing sketch bits (numpy values)."""
    inside = np.maximum(1 - 2 * differing / SKETCH_BITS, 1e-9)
    return 1 + np.log(inside) * SKETCH_BITS / 2 / (2 * BANDS * ROWS)


#: Differing bits at which the estimate falls to LEAST_ESTIMATE.
MOST_BITS = int(max(x for x in range(SKETCH_BITS // 2) if estimate(x) >= LEAST_ESTIMATE))


def _lists(table: np.ndarray) -> pa.Array:
    n, k = table.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(table.ravel()))


def _prefixes(values: np.ndarray, at: np.ndarray, percent: int) -> pa.Array:
    """The least values of each sorted set among which two sets at the threshold must agree."""
    n = np.diff(at)
    take = np.where(n > 0, n + (-percent * n) // 100 + 1, 0)
    flat = values[np.repeat(at[:-1] - (np.cumsum(take) - take), take) + np.arange(take.sum())]
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(take)).astype(np.int32)), pa.array(flat.view(np.int64)))


def _signatures(percent: int, exact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, col = batch.column(0), batch.column(1)
            for a, b in slices(col):
                values, at = Words(col.slice(a, b - a), BLANK).shingles(SHINGLE)
                n = np.diff(at)
                full = np.flatnonzero(n)
                bands = np.zeros((b - a, BANDS), np.int64)
                sketch = np.zeros((b - a, SKETCH_BITS // 64), np.int64)
                sums = np.zeros((2, b - a), np.uint64)
                if len(full):
                    starts = at[:-1][full]
                    if not exact:
                        samples = minhash(values, np.append(starts, len(values)))
                        key = (samples.astype(np.uint64) * _PLACE).reshape(len(full), BANDS, ROWS).sum(2, dtype=np.uint64)
                        bands[full] = mix(key + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                        sketch[full] = odd_sketch(samples)
                    sums[0, full] = np.add.reduceat(values, starts)
                    sums[1, full] = np.add.reduceat(mix(values ^ np.uint64(0x5851F42D4C957F2D)), starts)
                keys = _prefixes(values, at, percent) if exact else _lists(bands)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a).cast(pa.int64()), pa.array(n), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), keys, _lists(sketch)],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch"],
                )

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, col = batch.column(0), batch.column(1)
        for a, b in slices(col):
            values, at = Words(col.slice(a, b - a), BLANK).shingles(SHINGLE)
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays([ids.slice(a, b - a).cast(pa.int64()), lists], names=["id", "shingles"])


def _only(df: DataFrame, ids: DataFrame, n: int, on: str) -> DataFrame:
    """Rows of df whose ``on`` is among the n distinct values of ``ids.id``."""
    side = F.broadcast(ids) if n <= BROADCAST_IDS else ids.hint("shuffle_hash")
    return df.join(side, df[on] == side["id"], "left_semi")


def components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """Smallest reachable node for each node of undirected ``edges`` (a, b): columns node, component.

    Alternates large-star and small-star until the edges no longer change. Every round
    is written to the shared folder; a node's minimum is aggregated map-side and joined
    back, so no neighbourhood is ever collected.
    """
    big, small = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    now = scratch.write(edges.where("a <> b").select(big, small).distinct(), f"{label}-0")
    mark, k = None, 0
    while True:
        total = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if mark == (total["n"], total["x"]) or not total["n"]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark, k = (total["n"], total["x"]), k + 1
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # the hub of a component is the key of all its edges; minima are broadcast while they are few, else hubs are dealt
        least = scratch.write(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"{label}-least")
        large = attach(both.where("v > u"), least, ["u"], ["v"], "inner", 24).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        large = scratch.write(large, f"{label}-large")
        least = scratch.write(large.groupBy("u").agg(F.min("v").alias("m")), f"{label}-below")
        joined = attach(large, least, ["u"], ["v"], "inner", 24)
        star = joined.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = scratch.write(star.select("e.*").where("u > v").distinct(), f"{label}-{k}")


def _differing(x: str, y: str):
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, n: s + n)


def _confirm(docs: DataFrame, pairs: DataFrame, scratch: Scratch, label: str, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) with 100 * intersection >= percent * union of full shingle sets."""
    pairs = scratch.write(pairs, f"{label}-pairs")
    sets = _texts_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), scratch, label)
    firsts, seconds = (sets.select(F.col("id").alias(k), F.col("shingles").alias(f"s{k}")) for k in "ab")
    hot = pairs.groupBy("a").agg(F.ceil(F.count("*") / LEADER_PAIRS).cast("int").alias("salts")).where("salts > 1")
    hot = scratch.write(hot, f"{label}-hot")
    if hot.isEmpty():
        both = pairs.join(seconds, "b").join(firsts, "a")
    else:  # a leader's pairs are dealt before sets join them, and its set goes to each of its parts
        dealt = pairs.join(hot, "a", "left").select("a", "b", F.coalesce(F.pmod(F.xxhash64("b"), F.col("salts")), F.lit(0)).cast("int").alias("salt"))
        copies = firsts.join(hot, "a", "left").select("a", "sa", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
        both = dealt.join(seconds, "b").join(copies, ["a", "salt"])
    n, size = F.size(F.array_intersect("sa", "sb")), F.size("sa") + F.size("sb")
    links = scratch.write(both.where(100 * n >= percent * (size - n)).select("a", "b").distinct(), f"{label}-links")
    scratch.drop(f"{label}-sets", f"{label}-ids")
    return links


def _texts_sets(docs: DataFrame, ids: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """Full shingle sets (id, shingles) of the documents whose ids are given."""
    ids = scratch.write(ids, f"{label}-ids")
    return scratch.write(_only(docs, ids, ids.count(), "doc_id").mapInArrow(_sets, "id long, shingles array<long>"), f"{label}-sets")


def _rows_of(col: pa.Array) -> list[np.ndarray]:
    """Rows of a list column as unsigned arrays."""
    flat, at = col.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.asarray(col.offsets)
    at = at - at[0]
    return [flat[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


class _Block:
    """A meeting of two blocks, or of one with itself, of a bucket's members."""

    def __init__(self, group: pa.Table, percent: int) -> None:
        side = group.column("side").to_numpy()
        self.left, self.right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        self.one = not len(self.right)
        if self.one:
            self.right = self.left
        self.ids, self.component, self.size = (group.column(c).to_numpy() for c in ("rep", "component", "n_shingles"))
        self.sketch, self.percent = np.stack(_rows_of(group.column("sketch").combine_chunks())), percent
        bands = _rows_of(group.column("bands").combine_chunks())
        self.key = np.uint64(group.column("key")[0].as_py() & 0xFFFFFFFFFFFFFFFF)
        self.bands = np.stack(bands) if len({len(b) for b in bands}) == 1 else None

    def likely(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Members of other components that may link with member i and are to be looked at here, and in how many sketch bits each differs."""
        js = self.right[self.component[self.right] != self.component[i]]
        js = js[js > i] if self.one else js
        lo, hi = np.minimum(self.size[js], self.size[i]), np.maximum(self.size[js], self.size[i])
        js = js[100 * lo >= self.percent * hi]
        differ = np.bitwise_count(self.sketch[js] ^ self.sketch[i]).sum(1)
        js, differ = js[differ <= MOST_BITS], differ[differ <= MOST_BITS]
        if self.bands is not None and len(js):  # pairs that share several bands are looked at in the first of these
            first = self.bands[i][(self.bands[js] == self.bands[i]).argmax(1)] == self.key
            js, differ = js[first], differ[first]
        return js, differ


def _partnered(group: pa.Table, percent: int) -> pa.RecordBatch:
    """The rows of a meeting whose members have a likely partner there in another component."""
    block = _Block(group, percent)
    hit = np.zeros(len(block.ids), bool)
    for i in block.left.tolist():
        js, _ = block.likely(i)
        hit[js] = True
        hit[i] |= len(js) > 0
    kept, names = np.flatnonzero(hit), ["key", "i", "j", "side", "rep"]
    return pa.RecordBatch.from_arrays([pa.array(group.column(c).to_numpy()[kept]) for c in names], names=names)


def _links(group: pa.Table, percent: int) -> pa.RecordBatch:
    """Links between components of a meeting, enough to join what it can join."""
    block = _Block(group, percent)
    sets = _rows_of(group.column("shingles").combine_chunks())
    found: list[tuple[int, int, int]] = []
    for i in block.left.tolist():
        js, differ = block.likely(i)
        found += zip(differ.tolist(), [i] * len(js), js.tolist())
    root: dict[int, int] = {}

    def top(c: int) -> int:
        while root.get(c, c) != c:
            c = root[c]
        return c

    out = []
    for _, i, j in sorted(found):
        p, q = top(int(block.component[i])), top(int(block.component[j]))
        if p != q:
            x, y = sets[i], sets[j]
            n = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
            if 100 * n >= percent * (len(x) + len(y) - n):
                root[max(p, q)] = min(p, q)
                out.append((int(block.ids[i]), int(block.ids[j])))
    return _pairs(out)


def _meetings(judge, percent: int):
    """``judge`` over each group of rows sorted by key, i, j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        now = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            marks = np.stack([batch.column(c).to_numpy() for c in ("key", "i", "j")], 1)
            cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1).tolist(), len(marks)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if tuple(marks[a]) != now and held:
                    yield judge(pa.concat_tables(held), percent)
                    held = []
                now = tuple(marks[a])
                held.append(table.slice(a, b - a))
        if held:
            yield judge(pa.concat_tables(held), percent)

    return run


def _pairs(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a = np.array(links, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(a.min(1) if len(a) else a[:, 0]), pa.array(a.max(1) if len(a) else a[:, 0])], names=["a", "b"])


def near_duplicates(spark: SparkSession, docs: DataFrame, percent: int = 75, exact: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Words are runs of anything but ASCII white space after lower-casing A-Z; a text's set
    holds its distinct five-word shingles, or the whole sequence if it has fewer words.
    Texts link if 100 * intersection >= percent * union. ``component_id`` is the smallest
    doc_id reachable over links; ``kept`` marks the row that bears that id. ``exact`` finds
    candidates by prefixes of the sets, at a quarter of their size, instead of bands and sketches.

    Null and empty texts have no set: n_shingles 0, linked with nothing, kept. Rows that
    share a doc_id count as one document; a null doc_id has a null component of its own
    and is kept. Further columns are ignored. An empty table gives an empty result.
    """
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scratch = Scratch(spark, "neardup")
    sigs = scratch.write(docs.mapInArrow(_signatures(percent, exact), SIGNATURE), "signatures")
    with_set = sigs.where("n_shingles > 0 and doc_id is not null")
    classes = scratch.write(with_set.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "classes")
    reps = with_set.join(classes.select(F.col("rep").alias("id")).distinct().hint("shuffle_hash"), F.col("doc_id") == F.col("id"), "left_semi")
    # rows that share a doc_id and have several texts stand for one document: one of its sets is enough to be found, all are linked
    reps = scratch.write(reps.select(F.col("doc_id").alias("rep"), "n_shingles", "bands", "sketch"), "representatives")

    rows = reps.select("rep", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.min("rep").alias("lead"), F.max("rep").alias("last")).where("lead < last").select("key", "lead")
    shared = scratch.write(shared, "shared")
    buckets = scratch.write(attach(rows, shared, ["key"], ["rep"], "inner", 32), "buckets")
    sketches = reps.select("rep", "sketch")

    def agree(pairs: DataFrame, label: str) -> DataFrame:
        """Those of the pairs (a, b) whose sketches do; many may share one a."""
        if exact:
            return pairs.distinct()
        pairs = scratch.write(pairs.join(sketches.select(F.col("rep").alias("b"), F.col("sketch").alias("y")), "b"), f"{label}-agree")
        firsts = scratch.write(sketches.join(pairs.select(F.col("a").alias("rep")).distinct(), "rep").select(F.col("rep").alias("a"), F.col("sketch").alias("x")).dropDuplicates(["a"]), f"{label}-firsts")
        both = attach(pairs, firsts, ["a"], ["b"], "inner", SKETCH_BITS // 8 + 64)
        return both.where(_differing("x", "y") <= MOST_BITS).select("a", "b").distinct()

    def labelled(rows: DataFrame, found: DataFrame, of: str, name: str, spread: str) -> DataFrame:
        side = found.select(F.col("node").alias(of), F.col("component").alias(name))
        return attach(rows, side, [of], [spread], "left", 32).withColumn(name, F.coalesce(name, of))

    # each class with one other: the smallest first member of its buckets
    star = buckets.where("rep <> lead").groupBy("rep").agg(F.min("lead").alias("a")).select("a", F.col("rep").alias("b"))
    links = _confirm(docs, agree(star, "first"), scratch, "first", percent)
    found = components(links, scratch, "first-components")
    # with the first member of each of its buckets that lies in another component
    star = buckets.where("rep <> lead").select("lead", "rep").distinct()
    star = labelled(labelled(star, found, "rep", "p", "lead"), found, "lead", "q", "rep").where("p <> q").select(F.col("lead").alias("a"), F.col("rep").alias("b"))
    more = _confirm(docs, agree(star, "star"), scratch, "star", percent)
    if not more.isEmpty():
        links = links.unionByName(more)
        found = components(links, scratch, "star-components")
    # all others across components
    sized = labelled(buckets, found, "rep", "component", "key").join(reps.select("rep", "n_shingles").dropDuplicates(["rep"]), "rep")
    mixed = sized.groupBy("key").agg(F.min("component").alias("p"), F.max("component").alias("q"), F.count("*").alias("n"), F.sum("n_shingles").alias("m")).where("p <> q and n > 2")
    mixed = scratch.write(mixed.select("key", F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("m") * 8 / BLOCK_BYTES)).cast("int").alias("blocks")), "mixed")
    if not mixed.isEmpty():
        members = scratch.write(attach(sized.select("key", "rep", "component"), mixed, ["key"], ["rep"], "inner", 32), "members")

        # a block meets itself and every later one; each meeting is a group of at most two blocks
        own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
        to = lambda o: F.struct(F.least("own", o).alias("i"), F.greatest("own", o).alias("j"), (F.col("own") > o).cast("int").alias("side"))
        met = members.withColumn("own", own).withColumn("m", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), to))).select("key", "m.*", "rep")
        of_rep = members.select("rep", "component").distinct()

        def dealt(rows: DataFrame, *sides: DataFrame) -> DataFrame:
            for side in (of_rep, *sides):
                rows = rows.join(side, "rep")
            return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

        about = reps.select("rep", "n_shingles", "sketch", "bands").dropDuplicates(["rep"])
        if not exact:
            met = scratch.write(dealt(met, about).mapInArrow(_meetings(_partnered, percent), "key long, i int, j int, side int, rep long"), "likely")
        sets = _texts_sets(docs, met.select(F.col("rep").alias("id")).distinct(), scratch, "rest").select(F.col("id").alias("rep"), "shingles")
        more = scratch.write(dealt(met, about, sets).mapInArrow(_meetings(_links, percent), "a long, b long").distinct(), "rest-links")
        if not more.isEmpty():
            found = components(links.unionByName(more), scratch, "rest-components")
        scratch.drop("rest-sets", "members", "likely")

    scratch.drop("buckets", "shared", "first-agree", "star-agree")
    # only classes of several rows, or linked ones, tell a row more than it knows itself
    named = classes.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").where("n > 1 or component is not null")
    named = scratch.write(named.select("set_a", "set_b", F.coalesce("component", "rep").alias("component")), "named")
    members = sigs.select("doc_id", "n_shingles", "set_a", "set_b", F.when(F.col("n_shingles") > 0, F.lit(1)).alias("full"))
    out = attach(members, named.withColumn("full", F.lit(1)), ["set_a", "set_b", "full"], ["doc_id"], "left", 64)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
