"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns; brute force on small tables."""

import collections
import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lotloom.llm import chat, decontaminate, joins, neardup, packing, quality, secrets, sharding, textvec, topk, toxicity, warc
from lotloom.llm.queries import vocabulary

DOCS = "doc_id long, text string, lang string, source string"


def words_of(n, seed, vocab=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocab)}" for _ in range(n)]


def odd_docs(spark, *more):
    long = " ".join(words_of(20000, 9, 5000))
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, "one", "en", None), (4, "one", "en", None), (None, "one two three", "xx", "b"), (5, long, "en", "a"), (6, "\U0001f600 ünï — x", "fr", "c"), *more]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    for name in ("score", "spans", "hits", "items", "n_words", "rep", "blob", "id", "component_id", "length", "cell"):
        df = df.withColumn(name, F.lit("x"))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)


# 1


def brute_top(vectors, queries, k):
    ints = {i: np.floor(64 * np.array(v, float)).astype(int) for i, v in vectors.items()}
    out = {}
    for q in queries:
        ranked = sorted(((-int(ints[q] @ ints[v]), v) for v in ints if v != q))[:k]
        out[q] = [(v, -s) for s, v in ranked]
    return out


@pytest.mark.parametrize("scale", [1.0, 1e4])
def test_top_k_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 40)
    monkeypatch.setattr(topk, "STRIPE", 2)
    monkeypatch.setattr(topk, "SEEDS", 50)
    r = np.random.default_rng(1)
    base = (r.normal(size=(150, 20)) * scale).tolist()
    base[40:90] = [base[0]] * 50  # ties
    vectors = dict(enumerate(base))
    rows = [*vectors.items(), (900, None), (901, [None] * 20), (902, [float("nan")] * 20), (903, [float("inf")] + [0.0] * 19), (None, base[1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = collections.defaultdict(list)
    for x in topk.top_k(spark, frame, F.col("vec_id") % 20 == 0, k=7).orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["vec_id"], x["score"]))
    assert dict(got) == brute_top(vectors, [i for i in vectors if i % 20 == 0], 7)


def test_top_k_few(spark):
    kind = "vec_id long, embedding array<float>"
    assert topk.top_k(spark, spark.createDataFrame([], kind), F.lit(True)).count() == 0
    assert topk.top_k(spark, spark.createDataFrame([(0, [1.0])], kind), F.lit(True)).count() == 0
    two = topk.top_k(spark, spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.5]), (2, [1.0])], kind), F.lit(True)).orderBy("query_id").collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in two] == [(0, 1, 4096), (1, 0, 4096)]


def test_top_k_repeats_and_large_values(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.5, 2.0]), (0, [0.5, 2.0]), (1, [1.0, 1.0]), (2, [1e30, 0.0]), (3, [-1e30, 1e18]), (4, [1.0, 2.0]), (4, [1.0, 2.0])]
    got = topk.top_k(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=3).collect()
    # vector 0 is (32, 128) in steps of a 64th; 2 and 3 saturate
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(0, 1, 2, 2**63 - 1), (0, 2, 3, 2**63 - 1), (0, 3, 4, 18432)]


def test_search_beyond_floating_point():
    q, x = np.array([[2**30, 1]]), np.array([[2**30, 1], [2**30, 2], [1, 1]])
    (ids, scores), = topk.search(q, np.array([9]), x, np.array([0, 1, 2]), 2)
    assert ids.tolist() == [1, 0] and [int(s) for s in scores] == [2**60 + 2, 2**60 + 1]


# 2


def brute_hits(text, items):
    rule = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    low = lambda t: rule.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    words, hit, names = low(text), set(), set()
    for item, t in items:
        own = low(t)
        n = min(10, len(own))
        wins = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1) if n else ():
            if tuple(words[i : i + n]) in wins:
                hit |= set(range(i, i + n))
                names.add(str(item))
    return len(words), len(hit), sorted(names)


def test_decontamination_brute_force(spark, monkeypatch):
    items = [(1, " ".join(words_of(30, 1))), (2, "Short ITEM, here"), (10, " ".join(words_of(12, 2))), (3, None), (4, ""), (5, "same same same same same same same same same same same"), (2, "Short ITEM, here")]
    a, b = words_of(30, 1), words_of(12, 2)
    docs = [
        (20, " ".join(words_of(50, 3) + a[5:17] + words_of(20, 4))), (21, " ".join(a[5:14])), (22, "x short; item HERE y " + " ".join(b)), (23, "same " * 40), (24, " ".join(a + b)), (25, "short item"), (26, "é" + " ".join(b) + "É"),
    ]
    frame = odd_docs(spark, *((i, t, "en", "a") for i, t in docs))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (joins.BROADCAST_BYTES, 0):  # small sides are broadcast, or nothing is and hot keys are dealt
        monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(joins, "HOT_ROWS", 3)
        found = decontaminate.contamination(spark, clashing(frame), bench)
        got = sorted((r["doc_id"] or -1, r["n_words"], r["n_hit"], r["items_sha256"]) for r in decontaminate.summary(found).collect())
        want = [(r["doc_id"] or -1, *brute_hits(r["text"], items)) for r in frame.collect()]
        assert got == sorted((i, n, h, hashlib.sha256(",".join(names).encode()).hexdigest()) for i, n, h, names in want)
        clean = decontaminate.without_overlaps(spark, clashing(frame), bench)
        assert clean.columns == clashing(frame).columns
        assert sorted(r["doc_id"] or -1 for r in clean.collect()) == sorted(i for i, _, h, _ in want if not h)
    assert decontaminate.contamination(spark, frame, bench.limit(0)).where("size(items) > 0").count() == 0
    assert decontaminate.contamination(spark, empty(spark), bench).count() == 0


# 3


def test_marginals_brute_force():
    r = np.random.default_rng(2)
    score, first = r.normal(size=11) * 3, np.zeros(11, bool)
    first[[0, 4, 5]] = True
    trans, start = r.normal(size=(2, 2)), 0.3
    trans[0, 0] = 0
    got, fwd, _ = toxicity.marginals(score, first, start, trans)
    texts = type("Texts", (), {"count": np.array([4, 1, 0, 6]), "first": np.array([0, 4, 5, 5, 11])})
    totals = toxicity.log_totals(texts, fwd, first, trans)
    assert totals[2] == 0
    for a, b in ((0, 4), (4, 5), (5, 11)):
        n, total, part = b - a, 0.0, np.zeros(b - a)
        for k in range(2**n):
            s = [(k >> i) & 1 for i in range(n)]
            w = np.exp(start * s[0] + sum(score[a + i] * s[i] for i in range(n)) + sum(trans[s[i], s[i + 1]] for i in range(n - 1)))
            total += w
            part += w * np.array(s)
        assert np.allclose(got[a:b], part / total)
        # the path of zeros weighs 1, so a text has no toxic token with probability 1 / Z
        assert np.isclose(totals[{0: 0, 4: 1, 5: 3}[a]], np.log(total))


def test_training_lowers_the_bag_loss():
    """The fitted chain's loss, by enumeration of all paths, is below that of the chain it starts from."""
    texts = ["a b c", "b c vile", "c a", "vile a", "a vile b", "b b", "c vile c", "a c b a"]
    labels = [int("vile" in t) for t in texts]
    fitted = toxicity.train(texts, labels)
    begun = toxicity.train(texts, labels, rounds=0)

    def loss(m):
        out = 0.0
        for t, y in zip(texts, labels):
            words = textvec.Words(pa.array([t]), textvec.ALNUM)
            ids, _ = toxicity.features(words)
            score = sum(m.weights[k][ids[k]] for k in range(toxicity.PLACES)) + m.bias
            n, total = len(score), 0.0
            for k in range(2**n):
                s = [(k >> i) & 1 for i in range(n)]
                total += np.exp(m.start * s[0] + sum(score[i] * s[i] for i in range(n)) + sum(m.trans[s[i], s[i + 1]] for i in range(n - 1)))
            assert np.isclose(toxicity.judged(m, words)[0][0], 1 - 1 / total)
            out -= np.log(1 - 1 / total if y else 1 / total)
        return out

    assert loss(fitted) < 0.2 * loss(begun)
    assert toxicity.train(texts, [0] * 8).prior is not None and toxicity.train([], []).prior is not None


def test_toxicity(spark):
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = words_of(40, 1000 + i)
        if bad:
            text[i % 40] = ("vile", "nasty")[i % 8 // 4]
        rows.append((i + 100, " ".join(text), "en", "a"))
        labels.append((i + 100, int(bad)))
    labels += [(1, 1), (100, None), (99999, 1)]
    frame = clashing(odd_docs(spark, *rows))
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score_toxicity(spark, frame, known).collect()
    assert len(got) == frame.count() and all(0 <= r["score"] <= 1 for r in got)
    right = [((r["doc_id"] - 100) % 4 == 0) == (r["score"] >= 0.5) for r in got if (r["doc_id"] or 0) >= 100]
    assert sum(right) >= 0.97 * len(right)
    for r in got:
        if (r["doc_id"] or 0) >= 100 and r["score"] >= 0.5:
            assert any(r["text"][s["first"] : s["last"]] in ("vile", "nasty") for s in r["spans"])
    prior = toxicity.score_toxicity(spark, frame, known.limit(0)).select("score").distinct().count()
    assert prior == 1 and toxicity.score_toxicity(spark, empty(spark), known).count() == 0


# 4


def _check_tree(frame, got):
    """The upper split parts sizes, or sources or languages by name: along one of these, all of the first shards lie at or below the others."""
    facts = {(r["doc_id"], zlib.crc32((r["text"] or "").encode())): (len((r["text"] or "").encode()) + 8, *(r[c] or "" for c in ("source", "lang"))) for r in frame.collect()}
    sides = [[facts[r["doc_id"], r["text_crc32"]] for r in got if (r["shard"] < 12) == low and r["text_crc32"] != zlib.crc32(b"the same text again")] for low in (True, False)]
    assert any(max(x[d] for x in sides[0]) <= min(x[d] for x in sides[1]) for d in range(3))


def test_small_tree_brute_force(spark):
    """Splits of a tiny table, found by sorting: bytes as near to half as a cut between units allows, along the widest dimension."""
    from lotloom.session import Scratch

    r = random.Random(14)
    rows = [(i, 0, r.randrange(20, 400), [r.randrange(1 << 20), r.randrange(1 << 18), r.randrange(1 << 10), i], i) for i in range(300)]
    units = spark.createDataFrame(rows, "group long, chunk int, bytes long, at array<long>, below long")
    got = {x["group"]: x["node"] for x in sharding.grow(spark, units, 4, 0.5, Scratch(spark, "t")).collect()}

    def split(rows, first, shards):
        if shards == 1:
            return {x[0]: first for x in rows}
        width = [max(x[3][d] for x in rows) - min(x[3][d] for x in rows) for d in range(3)]
        d = width.index(max(width))
        rows = sorted(rows, key=lambda x: (x[3][d], x[4]))
        target, sums = sum(x[2] for x in rows) * (shards // 2) / shards, np.cumsum([0, *(x[2] for x in rows)])
        cut = int(np.abs(sums - target).argmin())
        return split(rows[:cut], first, shards // 2) | split(rows[cut:], first + shards // 2, shards - shards // 2)

    assert got == split(rows, 0, 4)


def test_sharding(spark):
    r = random.Random(4)
    rows = [(i, " ".join(words_of(r.randrange(1, 60), i)), r.choice(["en", "de"]), f"s{min(r.randrange(12), 4)}") for i in range(100, 3000)] + [(i, "the same text again", "en", "s0") for i in range(5000, 6500)]
    frame = clashing(spark.createDataFrame([*rows, (1, None, None, None), (None, "x", "en", "s"), (7, "dup", "en", "s"), (7, "dup", "en", "s")], DOCS))
    got = sharding.shard(spark, frame).collect()
    assert len(got) == frame.count() and {r["law"] for r in got} == {"bytes"} and all(r["grown_shard"] is None for r in got)
    texts = collections.Counter((r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in frame.collect())
    assert texts == collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got)
    total, slots, groups = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    for x in got:
        total[x["shard"]] += x["size"]
        slots[x["shard"]].append(x["slot"])
        groups[x["text_crc32"]].add(x["shard"])
    assert set(total) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(total.values()) - min(total.values()) < 0.05 * sum(total.values()) / 24
    assert sum(len(s) > 1 for s in groups.values()) <= 23
    _check_tree(frame, got)
    again = sorted((r["doc_id"] or -1, r["shard"]) for r in sharding.shard(spark, frame.repartition(5)).collect())
    assert again == sorted((r["doc_id"] or -1, r["shard"]) for r in got)
    assert sharding.shard(spark, empty(spark)).count() == 0
    assert sharding.shard(spark, spark.createDataFrame([(1, "x")], "doc_id long, text string")).count() == 1


# 5


def test_warc_magic_in_payloads(spark, tmp_path):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    html = ["<p>" + inner * 3 + "tail WARC/1.1\r\n", None, "", "short", "short", "y" * 200, "y" * 200, "y" * 200, "ü" * 80, "ü" * 80, "WARC/1.1\r\nContent-Length: 9999999\r\n\r\n" + "z" * 120, "big" * 200000]
    rows = [(i, f"http://x/{i}\r\nContent-Length: 7" if i == 3 else None, h) for i, h in enumerate(html)] + [(None, None, "y" * 200), (5, "u", "y" * 200)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).coalesce(1)
    path = str(tmp_path / "w")
    warc.write_archives(spark, frame, path, archive_bytes=20000)
    got = warc.read_archives(spark, path).collect()
    files = [f.read_bytes() for f in (tmp_path / "w").glob("part-*")]
    assert all(len(f) <= 20000 or f.count(b"WARC-Record-ID") == 1 for f in files)
    ids = {m for f in files for m in re.findall(rb"WARC-Record-ID: (<[^>]*>)", f)}
    assert {m for f in files for m in re.findall(rb"WARC-Refers-To: (<[^>]*>)", f)} <= ids
    assert len(got) == len(rows) and all(r["sound"] for r in got)
    first = {}
    for i, _, h in sorted((r for r in rows if r[0] is not None and len((r[2] or "").encode()) >= 100), key=lambda r: r[0]):
        first.setdefault(h, i)
    want = collections.Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        original = first.get(h) if len(data) >= 100 else None
        again = original is not None and i != original
        want[(i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", original if again else None)] += 1
    assert want == collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got)
    assert {bytes(r["payload"]).decode() for r in got if r["record_type"] == "response"} == {h or "" for h in html}
    assert warc.archive_pages(spark, frame.limit(0)).count() == 0


def test_chain_breaks():
    good = b"WARC/1.1\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    kept = lambda data: [r["sound"] for r in warc.parse("a", data)]
    assert kept(good * 3) == [True] * 3
    assert kept(good + good[:-3]) == [True, False]
    assert kept(b"junk" + good) == [] and kept(b"") == []
    assert kept(b"WARC/1.1\r\n" * 3) == [] and kept(b"WARC/1.1\r\ncontent-length: " + b"9" * 40 + b"\r\n\r\n") == [False]


@pytest.mark.parametrize("filler", [b"WARC/1.1\r\n", b"WARC/1.1\r\nX: 1\r\n", b"WARC/1.1\r\n\r\n", b"WARC/1.1\r\nContent-Length: 3\r\n\r\n", b"\r\n", b"\r\nContent-Length: 1"])
def test_hostile_payloads_take_linear_time(filler):
    payload = filler * (1_000_000 // len(filler))
    data = b"WARC/1.1\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload + b"\r\n\r\n"
    began = time.perf_counter()
    rows = list(warc.parse("a", data, payloads=False))
    assert [(r["payload_bytes"], r["sound"]) for r in rows] == [(len(payload), True)] and time.perf_counter() - began < 2


# 6


def brute_components(rows):
    def shingles(t):
        w = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    sets = {i: shingles(t) for i, t in rows}
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            n = len(sets[i] & sets[j])
            if n and 100 * n >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("block, exact, limit", [(2048, False, 1 << 24), (7, False, 1 << 24), (7, False, 0), (9, True, 1 << 24)])
def test_near_duplicates_brute_force(spark, monkeypatch, block, exact, limit):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(joins, "HOT_ROWS", 10)
    r, rows = random.Random(6), []
    for g in range(6):
        base = words_of(120, g, 100000)
        for k in range(14):  # copies of growing distance: chains, stragglers, exact ones
            copy = list(base)
            for _ in range(r.randrange(0, 9)):
                copy[r.randrange(len(copy))] = f"n{r.randrange(10**6)}"
            rows.append((1000 + len(rows), " ".join(copy)))
        rows.append((1000 + len(rows), "\n".join(base).upper()))
    for n in (8, 10):
        rows += [(2000 + 2 * n + k, t) for k, t in enumerate(thue_morse(n))]
    rows += [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  B"), (6, "a b c"), (7, " ".join(words_of(20000, 77, 9000)))]
    frame = clashing(spark.createDataFrame([(*x, "en", "s") for x in rows], DOCS).drop("component_id"))
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in neardup.near_duplicates(spark, frame.repartition(5), exact=exact).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_edges(spark):
    got = neardup.near_duplicates(spark, odd_docs(spark)).collect()
    assert len(got) == odd_docs(spark).count()
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, True)]
    assert neardup.near_duplicates(spark, empty(spark)).count() == 0


def test_components(spark):
    from lotloom.session import Scratch

    r = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 40)] + [(r.randrange(2000, 2050), r.randrange(2000, 2050)) for _ in range(40)] + [(5, 5)]
    got = {x["node"]: x["component"] for x in neardup.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"), "t").collect()}
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {n: c for n, c in label.items() if n != c}


def test_estimate_follows_similarity():
    r = np.random.default_rng(3)
    whole = r.integers(0, 2**64, 2000, dtype=np.uint64)
    for overlap in (0.75, 0.9):
        n = int(2000 * overlap * 2 / (1 + overlap)) // 2
        a, b = np.sort(whole[: n + (2000 - n) // 2]), np.sort(np.concatenate([whole[:n], whole[n + (2000 - n) // 2 :]]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        sketches = [neardup.odd_sketch(neardup.minhash(x, np.array([0, len(x)]))).view(np.uint64) for x in (a, b)]
        assert abs(float(neardup.estimate(int(np.bitwise_count(sketches[0] ^ sketches[1]).sum()))) - true) < 0.15


# 7


def test_chat(spark):
    texts = [None, "", "\\", "</s>", "[INST] x [/INST]", "\\</s>\\\\[ROLE]", "<", "<</s>", "<s><<SYS>>", "ü\U0001f600\n"]
    rows = [(c, t, role, texts[(c + t) % len(texts)]) for c in range(30) for t, role in enumerate(["system", "user", "assistant", "tool", None, "[ROLE]\\"][: c % 6 + 1])]
    rows += [(None, 1, "user", "x"), (50, None, "user", "b"), (50, 1, "assistant", "a"), (50, 1, "assistant", "a")] + [(60, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(300)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    got = {r["conv_id"]: r for r in chat.format_conversations(spark, frame).collect()}
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns = [x[1:] for x in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        g = got[c]
        assert g["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (g["n_turns"], g["loss_chars"], g["loss_sha256"]) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert "".join(g["formatted"][s["first"] : s["last"]] for s in g["spans"]) == g["formatted"] and g["formatted_chars"] == len(g["formatted"])
    assert chat.format_conversations(spark, frame.limit(0)).count() == 0


def test_rewritten_history_is_found():
    turns = [("user", "a"), ("assistant", "b"), ("user", "c")]
    last_only = lambda ts: "".join(t.upper() if i == len(ts) - 1 else t for i, (_, t) in enumerate(ts))
    assert chat.locate(last_only, turns)[2] is True
    # only some long prefixes are written otherwise; what came before and after agrees
    between = lambda ts: ("*" if 40 <= len(ts) <= 50 else "") + "".join(t for _, t in ts)
    assert chat.locate(between, turns * 14)[2] is True and chat.locate(between, turns * 33)[2] is True
    at_the_end = lambda ts: ("*" if len(ts) == 299 else "") + "".join(t for _, t in ts)
    assert chat.locate(at_the_end, turns * 100)[2] is True and chat.locate(at_the_end, turns * 99)[2] is False
    numbered = lambda ts: "^" + "".join(f"{i}{t}" for i, (_, t) in enumerate(ts))
    out, spans, bad = chat.locate(numbered, turns * 40)
    assert not bad and "".join(out[a:b] for a, b in spans) == out[1:]


# 8


def test_packing(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    special = "<|ENDOFTEXT|> <|endoftext|>x İstanbul ﬁne don't WE'RE 12ab naïve ΑΣ \x1c\x85x a\u0301b …—“q” nb\xa0sp hello, World!? 가"
    frame = clashing(odd_docs(spark, (30, special, "en", "a"), *((40 + i, t, "en", "a") for i, t in enumerate(thue_morse(10))), *((100 + i, " ".join(words_of(random.Random(i).randrange(1, 900), i)), "en", "a") for i in range(150))))
    got = packing.pack(spark, frame, vocabulary()).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    total = 0
    for r in {(x["doc_id"], x["text"]) for x in frame.collect()}:
        ids = np.array([*t.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        copies = 2 if r[0] == 4 else 1
        want = [(k, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
        assert sorted((x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in by[r[0]]) == sorted(want * copies)
        total += len(ids) * copies
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(bins) <= -(-total // 4096) + 1
    assert packing.pack(spark, empty(spark), vocabulary()).count() == 0


def test_ids_of_colliding_words(monkeypatch):
    """Words that share a hash keep their own ids, within a slice and across slices."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(textvec.Words, "_hashes", lambda self: (self.end - self.start).astype(np.uint64) % np.uint64(3))
    t = Tokenizer.from_file(vocabulary())
    ids = packing._Ids(t)
    for texts in (["one two three six", "a bc one"], ["two one", None, "seven eight two a"], ["nine ten " * 3]):
        flat, at = packing.tokens(ids, pa.array(texts, pa.string()))
        assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_fullest_brute_force():
    r = random.Random(11)
    for _ in range(60):
        counts = {r.randrange(1, 30): r.randrange(1, 4) for _ in range(r.randrange(1, 6))}
        room, sums = r.randrange(1, 60), {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        best = packing.fullest(counts, room)
        assert sum(n * k for n, k in best.items()) == max(s for s in sums if s <= room) and all(counts[n] >= k for n, k in best.items())


def test_plan_uses_every_piece():
    counts = {4096: 3, 3000: 10, 1096: 4, 700: 9, 5: 1000}
    used = collections.Counter()
    for times, bin_ in packing.plan(counts):
        assert sum(n * k for n, k in bin_.items()) <= 4096
        used.update({n: k * times for n, k in bin_.items()})
    assert used == counts


# 9


def brute_secrets(text):
    t, found = text or "", []
    for rank, (kind, pattern, group, least) in enumerate(secrets.RULES):
        for m in re.finditer(pattern, t):
            if len(m[group]) >= least:
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(found)]


def test_secrets(spark, tmp_path):
    r = random.Random(12)
    parts = ["password", "PASSWD =", " token: ", "secret=", "api_key:'", "apikey=\"", "abcdef0123456789", "AKIA", "ABCDEFGH12345678", "é😀", "=", ":", " ", "x", "\n", "deadbeefdeadbeef", "Zz/+_.-", "token=secret=abcdefghijklmnop", "password=token:abcdefghijklmnop"]
    docs = [(i, "".join(r.choice(parts) for _ in range(r.randrange(1, 40))), "en", "a") for i in range(100, 400)]
    frame = clashing(odd_docs(spark, *docs, (900, docs[0][1], "en", "b")))
    ledger = str(tmp_path / "ledger")
    for _ in range(2):  # the second scan finds all in the ledger
        got = collections.Counter((x["doc_id"], x["spans"]) for x in secrets.summary(secrets.scan(spark, frame, ledger)).collect())
        assert got == collections.Counter((x["doc_id"], ",".join(brute_secrets(x["text"]))) for x in frame.collect())
    texts = {x["text"] or "" for x in frame.collect()}
    assert spark.read.parquet(f"{ledger}/scanned").count() == len(texts)
    secrets.scan(spark, frame, ledger, rule_version="2").count()
    assert spark.read.parquet(f"{ledger}/scanned").count() == 2 * len(texts)
    assert secrets.scan(spark, empty(spark)).count() == 0


def brute_mask(text):
    """Runs of overlapping spans become one mark each."""
    spans = sorted((int(a), int(b)) for a, b in (s.split(":")[1:] for s in brute_secrets(text)))
    out, at = "", 0
    for a, b in spans:
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:]


def test_masking(spark, monkeypatch):
    r = random.Random(13)
    parts = ["password=", "deadbeefdeadbeefapi_key=", "abcdef0123456789", "AKIA" + "A1" * 9, "é😀", " ", "x\n", "Zz/+_.-" * 3, "token: secretsecretsecret"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randrange(1, 30))), "en", "a") for i in range(100, 300)]
    frame = clashing(odd_docs(spark, *rows, (100, rows[0][1], "en", "b"))).withColumn("n_chars", F.lit(-1))
    want = collections.Counter((x["doc_id"], None if x["text"] is None else brute_mask(x["text"])) for x in frame.collect())
    for block in (4096, 7):
        monkeypatch.setattr(secrets, "BLOCK", block)
        got = secrets.mask(spark, frame)
        assert got.columns == frame.columns
        rows = got.collect()
        assert collections.Counter((x["doc_id"], x["text"]) for x in rows) == want and all(x["blob"] == "x" for x in rows)
        assert all(x["n_chars"] == len(x["text"]) for x in rows if "[SECRET]" in (x["text"] or ""))
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "HOT_ROWS", 1)
    assert collections.Counter((x["doc_id"], x["text"]) for x in secrets.mask(spark, frame).collect()) == want
    assert secrets.mask(spark, frame.limit(0)).count() == 0


def test_many_secrets_in_one_text(spark):
    text = "token=abcdefghijkl " * 60000
    began = time.monotonic()
    docs = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert [len(r["spans"]) for r in secrets.scan(spark, docs).collect()] == [60000] * 2
    assert {r["text"] for r in secrets.mask(spark, docs).collect()} == {"[SECRET] " * 60000}
    assert time.monotonic() - began < 60


def test_attach(spark, monkeypatch):
    left = spark.createDataFrame([(i % 3 if i % 7 else None, i, 9) for i in range(200)], "k long, v long, salt long")
    right = spark.createDataFrame([(0, "a"), (2, "b"), (None, "c")], "k long, w string")
    for limit in (1 << 20, 0):
        monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(joins, "HOT_ROWS", 20)
        for how in ("left", "inner", "left_semi", "left_anti"):
            got, want = joins.attach(left, right, ["k"], ["v"], how), left.join(right, ["k"], how)
            assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


# 10


def test_quality(spark):
    good = [(i, ". ".join(" ".join(words_of(9, i * 50 + k, 90)[:4] + ["of", "it", "a", "so"]) for k in range(12)) + ".", "en", "a") for i in range(100, 220)]
    bad = [(i, " ".join(["spam"] * 80) if i % 2 else " ".join(w + "###$$$" for w in words_of(60, i)), "en", "a") for i in range(300, 340)]
    frame = clashing(odd_docs(spark, *good, *bad))
    got = {r["doc_id"]: r["score"] for r in quality.score_quality(spark, frame).collect()}
    assert sum(got[i] >= 0.5 for i, *_ in good) >= 118 and sum(got[i] < 0.5 for i, *_ in bad) >= 38
    assert got[2] < 0.5 and got[1] < 0.5
    assert quality.score_quality(spark, empty(spark)).count() == 0


def test_votes_recover_classes():
    r = np.random.default_rng(5)
    y = r.random(5000) < 0.8
    rates = np.array([[0.1, 0.3, 0.6], [0.1, 0.002, 0.898]])
    votes = np.stack([[r.choice(3, p=rates[int(v)]) for v in y] for _ in range(10)], 1)
    patterns, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post, _ = quality.fit_votes(patterns, counts.astype(float))
    assert ((post[which.ravel()] >= 0.5) == y).mean() > 0.95


def test_votes_against_likelihood():
    """The posterior is Bayes' rule over the rates, and no feasible change of rates raises the penalised likelihood."""
    r = np.random.default_rng(6)
    y = r.random(4000) < 0.7
    true = np.array([[0.1, 0.5, 0.4], [0.1, 0.001, 0.899]])
    votes = np.stack([[r.choice(3, p=true[int(v)]) for v in y] for _ in range(4)], 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    post, rates = quality.fit_votes(patterns, counts.astype(float), rounds=2000)
    share = ((counts * post).sum() + 1) / (counts.sum() + 2)

    def weights(rates, share):
        return np.array([[s * np.prod([rates[c, k, v] for k, v in enumerate(p)]) for p in patterns] for c, s in ((0, 1 - share), (1, share))])

    def loss(rates, share):
        own = np.log(rates) * quality.PRIOR[:, None] * quality.PRIOR_VOTES
        return -(counts * np.log(weights(rates, share).sum(0))).sum() - own.sum() - np.log(share) - np.log(1 - share)

    w = weights(rates, share)
    assert np.allclose(post, w[1] / w.sum(0), atol=1e-6)
    assert np.allclose(rates.sum(2), 1) and rates[1, :, quality.BAD].max() <= quality.MOST_FALSE + 1e-12
    for _ in range(50):
        other = rates * np.exp(r.normal(size=rates.shape) * 0.02)
        other /= other.sum(2, keepdims=True)
        other[1] *= ((1 - rates[1, :, quality.BAD]) / (1 - other[1, :, quality.BAD]))[:, None]
        other[1, :, quality.BAD] = rates[1, :, quality.BAD]
        assert loss(other, share) > loss(rates, share) - 1e-6
    assert [a["figure"] for a in quality.accuracies(rates)] == [n for _, n, *_ in quality.LABELLERS[:4]]


# Words


def thue_morse(n):
    """Two texts of 2 ** n letters that polynomial hashes modulo 2 ** 64 can't tell apart."""
    bits = "".join("ab"[i.bit_count() % 2] for i in range(2**n))
    return bits, bits.translate(str.maketrans("ab", "ba"))


def test_regular_words_differ():
    words = textvec.Words(pa.array([" ".join(x for n in range(5, 14) for x in thue_morse(n))]), textvec.BLANK)
    assert len(set(words.hash.tolist())) == 18


def test_words_and_shingles_brute_force():
    texts = ["", "a", "A b  c\n\td é", " x", "The the THE", None, "\U0001f600 y", "q" * 3000, " ".join(words_of(300, 1))]
    words = textvec.Words(pa.array(texts, pa.string()), textvec.BLANK)
    want = [[w.lower() if w.isascii() else w for w in re.findall("[^\x20\x09-\x0d]+", t or "")] for t in texts]
    assert words.count.tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    names = collections.defaultdict(set)
    for w, h in zip(flat, words.hash.tolist()):
        names[h].add(w)
    assert len(names) == len(set(flat)) and all(len(s) == 1 for s in names.values())
    places = np.arange(len(flat))
    for shift in (0, 1, 7):
        assert words.same(places, np.roll(places, shift)).tolist() == [a == flat[b] for a, b in zip(flat, np.roll(places, shift))]
    assert [int(h).to_bytes(8, "little") for h in words.head(4)] == [w.encode()[:4].ljust(8, b"\0") for w in flat]
    values, at = words.shingles(5)
    sizes = [len({tuple(w[i : i + 5]) for i in range(len(w) - 4)}) if len(w) >= 5 else int(bool(w)) for w in want]
    assert np.diff(at).tolist() == sizes


# The pipeline


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    bench = " ".join(words_of(20, 500))
    docs, labels = [], []
    for i in range(300):
        text = words_of(60, 2000 + i)
        if i % 5 == 0:
            text[3] = "vile"
        docs.append((i, " ".join(text), "en", "s", 0))
        labels.append((i, int(i % 5 == 0)))
    docs += [(1001, docs[1][1] + " more", "en", "s", 0), (1002, "z " + bench, "en", "s", 0), (1003, "plain words token=abcdefghijkl end", "en", "s", 34), (1004, None, "en", "s", None)]
    write = lambda rows, kind, name: spark.createDataFrame(rows, kind).write.parquet(str(tmp_path / f"{name}.parquet"))
    write(docs, DOCS + ", n_chars long", "documents")
    write(labels, "doc_id long, toxic int", "labels")
    write([(1, bench)], "item_id long, text string", "benchmark")
    frame, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = {r["doc_id"]: r for r in frame.collect()}
    assert sum(i in kept["toxicity"] for i in range(0, 300, 5)) <= 3 and sum(i in kept["toxicity"] for i in range(300) if i % 5) >= 235
    assert 1 in kept["near duplicates"] and 1001 not in kept["near duplicates"]
    assert 1002 not in kept["decontamination"] and set(kept["near duplicates"]) - set(kept["decontamination"]) == {1002}
    assert (kept["secrets"][1003]["text"], kept["secrets"][1003]["n_chars"]) == ("plain words [SECRET] end", 24)
    assert kept["secrets"][1004]["text"] is None
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(kept["secrets"])


def test_stages_keep_any_columns(spark, tmp_path):
    """Clashing names, nulls, repeated rows and empty tables in every stage."""
    import corpus_pipeline

    bench = " ".join(words_of(20, 500))
    write = lambda rows, kind, name: spark.createDataFrame(rows, kind).write.parquet(str(tmp_path / f"{name}.parquet"))
    write([(i, i % 2) for i in range(10)], "doc_id long, toxic int", "labels")
    write([(1, bench)], "item_id long, text string", "benchmark")
    text = " ".join(words_of(50, 1))
    frame = clashing(odd_docs(spark, (20, text, "en", "a"), (20, text, "en", "a"), (21, text + " more", "en", "a"), (22, bench, "en", "a"), (23, "token=abcdefghijkl", "en", "a")))
    for name in ("key", "salt", "masked", "kept", "N_chars", "Score", "_key", "text_"):
        frame = frame.withColumn(name, F.lit("x")) if name.lower() not in [c.lower() for c in frame.columns] else frame
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, frame, str(tmp_path))
        assert got.columns == frame.columns
        assert all(r[c] == "x" for r in got.collect() for c in frame.columns[4:] if c != "N_chars")
        assert stage(spark, frame.limit(0), str(tmp_path)).count() == 0
    ids = lambda df: collections.Counter(r["doc_id"] for r in df.collect())
    copies = ids(corpus_pipeline.drop_copies(spark, frame, str(tmp_path)))
    assert copies[20] == 2 and copies[21] == 0 and copies[None] == 1 and copies[1] == copies[2] == 1
    assert ids(corpus_pipeline.pack(spark, frame, str(tmp_path)))[20] == 2


def test_secrets_of_earlier_versions(spark, tmp_path):
    """A text changes between versions: its old secret shows under the old version, its new blob alone is scanned."""
    ledger, key = str(tmp_path / "ledger"), "password = abcdefghijkl"
    first = [(1, key), (2, "clean"), (3, None), (3, None), (None, key)]
    second = [(1, "gone"), (2, "clean"), (3, key)]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string").withColumn("version", F.lit("x"))
    assert secrets.history(spark, ledger).count() == 0
    secrets.scan(spark, frame(first), ledger)
    secrets.scan(spark, frame(second), ledger)
    assert spark.read.parquet(f"{ledger}/scanned").count() == 4  # the key, clean, empty, gone
    shown = lambda: collections.Counter((r["doc_id"], r["version"], len(r["spans"])) for r in secrets.history(spark, ledger).collect())
    want = collections.Counter({(1, 1, 1): 1, (2, 1, 0): 1, (3, 1, 0): 2, (None, 1, 1): 1, (1, 2, 0): 1, (2, 2, 0): 1, (3, 2, 1): 1})
    assert shown() == want
    secrets.scan(spark, frame(second), ledger, version=2)  # again: no other rows
    assert shown() == want
    assert all(r["spans"] is None for r in secrets.history(spark, ledger, rule_version="2").collect())


@pytest.mark.parametrize("percent", [75])
def test_near_duplicates_of_one_leader(spark, monkeypatch, percent):
    """The pairs and the edges of a leader of many near copies are dealt to several tasks, and the result stays the same."""
    base = words_of(40, 3, 1000)
    rows = [(i, " ".join([*base, f"x{i}"])) for i in range(600)] + [(1000 + i, " ".join(words_of(30, 100 + i, 5000))) for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(spark, frame).collect())
    assert sum(not k for *_, k in want) == 599
    monkeypatch.setattr(neardup, "LEADER_PAIRS", 20)
    monkeypatch.setattr(joins, "HOT_ROWS", 20)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 64)
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(spark, frame).collect()) == want


def test_shards_follow_names_in_order(spark):
    """Names far more numerous than sizes and languages are what a tree splits by, in their order and not by their hashes."""
    rows = [(i, f"text {i:04d}", "en", f"site{i // 10:03d}") for i in range(1000)]
    got = {r["doc_id"]: r["shard"] for r in sharding.shard(spark, spark.createDataFrame(rows, DOCS), 4).collect()}
    assert [got[i] for i in range(1000)] == sorted(got.values())
    sizes = collections.Counter(got.values())
    assert len(sizes) == 4 and max(sizes.values()) - min(sizes.values()) <= 10
