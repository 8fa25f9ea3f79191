"""Repair of conversations, resampling and byte-level BPE: brute force, the tokenizers library, edges."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lotloom.llm import bpe, repair, resample
from lotloom.llm.queries import vocabulary

TURNS = "conv_id long, turn long, role string, text string"
PATH = vocabulary("byte_bpe_50k.json")


# 11


def brute_repair(rows):
    """(cost, audit, repaired turns) of rows (role, text, must go, cut) over all strings of edits with up to two insertions at a place."""
    best = None
    for ops in itertools.product("KRD", repeat=len(rows)):
        if any(lost and op != "D" for op, (_, _, lost, _) in zip(ops, rows)):
            continue
        for puts in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * n + op for n, op in zip(puts, ops)) + "I" * puts[-1]
            cost = sum({"K": 0, "R": 2, "D": 3}[op] + (cut and op != "D") for op, (_, _, _, cut) in zip(ops, rows)) + 2 * sum(puts)
            if best is not None and (cost, audit) >= best[:2]:
                continue
            for said in itertools.product("ua", repeat=audit.count("I") + audit.count("R")):
                free, left, out = iter(said), iter(rows), []
                for edit in audit:
                    role, text, *_ = ("", "") if edit == "I" else next(left)
                    if edit != "D":
                        role = {"u": "user", "a": "assistant"}[next(free)] if edit in "IR" else role
                        out.append((role, text))
                if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in out)):
                    best = cost, audit, out
    return best


def digest(turns):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


def faults(turns):
    """Rows (role, text, must go, cut) and the numbers of each fault."""
    seen, out, counts = set(), [], Counter()
    for role, text in turns:
        seen_before = (role, text) in seen
        seen.add((role, text))
        visible = re.sub("[ \t-\r]", "", text)
        fault = "blank" if not visible else "duplicate" if seen_before else "" if visible[-1] in ".!?" else "truncated"
        counts[fault] += 1
        out.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    return out, counts


def test_repair_brute_force(spark):
    r = random.Random(5)
    convs = {i: [(r.choice(["user", "assistant", "system", "user", "assistant", "tool", ""]), r.choice(["Yes.", "No", "", " \n", "Well!", "x\v", "b."])) for _ in range(r.randrange(1, 4))] for i in range(60)}
    convs |= {100 + i: list(zip(roles, ["One.", "Two.", "Three."])) for i, roles in enumerate(itertools.product(["user", "assistant", "system"], repeat=3))}
    rows = [(c, t, *turn) for c, turns in convs.items() for t, turn in enumerate(turns)]
    r.shuffle(rows)
    got = {x["conv_id"]: x for x in repair.repair_figures(spark, spark.createDataFrame(rows, TURNS)).collect()}
    put = defaultdict(list)
    for x in sorted(repair.repaired_turns(spark, spark.createDataFrame(rows, TURNS)).collect(), key=lambda x: x["place"]):
        put[x["conv_id"]].append(x)
    for c, turns in convs.items():
        own, counts = faults(turns)
        cost, audit, out = brute_repair(own)
        x = got[c]
        assert (x["cost"], x["audit"], x["repaired_sha256"]) == (cost, audit, digest(out)), turns
        assert (x["blank"], x["duplicate"], x["truncated"]) == (counts["blank"], counts["duplicate"], counts["truncated"])
        assert "".join(y["edit"] for y in put[c]) == audit and [(y["role"], y["text"]) for y in put[c] if y["edit"] != "D"] == out


def test_repair_settles_early():
    """Of a long conversation only rows that aren't settled are held, though faults leave ties open for a while."""
    r, most = random.Random(2), 0
    conversation = repair._Conversation(1)
    for i in range(20_000):
        role = r.choice(["user", "assistant"]) if i % 7 == 0 else ("user", "assistant")[i % 2]
        for _ in conversation.add(i, role, f"turn {i}.", r.choice([0, 0, 0, 0, 1, 3])):
            pass
        most = max(most, len(conversation.waiting))
    list(conversation.finish())
    assert most < 200 and len(conversation.audit) >= 20_000


def test_survivor_ties_beyond_what_is_open():
    """Dropped and settled ways give the same string as keeping every way to every state."""
    r = random.Random(8)
    for _ in range(300):
        rows = [(r.choice("suax"), r.random() < 0.2, int(r.random() < 0.3)) for _ in range(r.randrange(0, 25))]
        ways = {repair.START: (0, "")}
        for initial, lost, extra in rows:
            found = []
            for state, (cost, audit) in ways.items():
                found.append((state, cost + 3, audit + "D"))
                for said in "sua" if not lost else "":
                    edit = "K" if said == initial else "R"
                    if state in repair._BEFORE[said] and (said != "s" or edit == "K"):
                        n = repair._BEFORE[said][state]
                        found.append((repair._AFTER[said], cost + 2 * n + 2 * (edit == "R") + extra, audit + "I" * n + edit))
            ways = {s: min(w[1:] for w in found if w[0] == s) for s in {w[0] for w in found}}
        want = min((cost + 2 * repair._CLOSING[s], audit + "I" * repair._CLOSING[s]) for s, (cost, audit) in ways.items())
        survivors, audit = repair.Survivors(), []
        for row in rows:
            audit += survivors.step(*row)
        cost, rest, tail = survivors.finish()
        assert (cost, "".join(audit + rest) + tail) == want


def test_repair_edges(spark):
    rows = [(None, None, None, None), (None, None, "user", "Hi."), (1, None, "user", "A."), (1, 3, "assistant", "B."), (1, 3, "assistant", "B."), (1, 9, "user", "A."), (2, 1, "user", "x" * 200_000)]
    got = {x["conv_id"]: x for x in repair.repair_figures(spark, spark.createDataFrame(rows, TURNS).withColumns({"Fault": F.lit("x"), "own": F.lit(1)})).collect()}
    assert (got[1]["gaps"], got[1]["duplicate"], got[1]["audit"]) == (5, 2, "KKDD")
    assert (got[None]["gaps"], got[None]["blank"], got[None]["audit"], got[None]["illegal"]) == (0, 1, "DKI", 1)
    assert (got[2]["truncated"], got[2]["cost"], got[2]["audit"]) == (1, 3, "D")
    assert repair.repair_figures(spark, spark.createDataFrame([], TURNS)).count() == 0
    assert repair.repaired_turns(spark, spark.createDataFrame([], TURNS)).count() == 0


def test_damage(spark):
    rows = [(i, t, "assistant", "A b. C!") for i in range(40) for t in range(5)] + [(None, None, None, None)]
    got = Counter((x["conv_id"], x["turn"], x["role"], x["text"]) for x in repair.damaged(spark.createDataFrame(rows, TURNS)).collect())
    want = Counter()
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text, role = {1: "", 2: "A b C" if text else " "}.get(kind, text or " "), "user" if kind == 4 else role or " "
        want[c, t, role, text] += {0: 0, 3: 2}.get(kind, 1)
    assert got == +want


def test_repair_in_parts_of_any_size(spark):
    """A conversation that spans many batches."""
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}.") for t in range(5000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "300")
    try:
        x = repair.repair_figures(spark, spark.createDataFrame(rows, TURNS)).first()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    assert x["audit"] == "K" * 5000 and x["cost"] == 0 and x["repaired_sha256"] == digest([(r, t) for _, _, r, t in rows])


# 12


def brute_resample(docs, target, share, max_n, buckets, least):
    def runs(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(runs(text)[1])
    for text in target:
        t.update(runs(text)[1])
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (s.total() + buckets) / ((s[b] + 1.0) * (t.total() + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in docs:
        n, own = runs(text)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, n, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is not None, x[0] or 0))
    return out, [(x[4], x[0]) for x in order[: share * len(order) // 100]]


@pytest.mark.parametrize("max_n,buckets", [(1, 10_000), (3, 64)])
def test_resample_brute_force(spark, max_n, buckets):
    r = random.Random(max_n)
    words = ["Ab", "c-d", "ünï", "x1", "中文", "the", "THE", "_", "q.r", "\x00z", "İ"]
    docs = [(i, " ".join(r.choice(words) for _ in range(r.randrange(0, 60)))) for i in range(400)]
    docs += [(7, docs[7][1])] * 30 + [(None, None), (None, "a b"), (500, ""), (501, " - "), (502, "the ab " * 40_000)]
    target = [" ".join(r.choice(words[:5]) for _ in range(30)) for _ in range(20)] + [None, ""]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"weight": F.lit("x"), "rank": F.lit(1), "_in": F.lit(0)}).repartition(7)
    got = resample.resample(spark, df, spark.createDataFrame([(t,) for t in target], "text string"), 25, max_n, buckets, 20).collect()
    rows, drawn = brute_resample(docs, target, 25, max_n, buckets, 20)
    assert Counter((x["doc_id"], x["n_words"], x["n_features"], x["weight"], x["score"]) for x in got) == Counter(rows)
    ranks = sorted((x["rank"], x["score"], x["doc_id"]) for x in got if x["rank"] is not None)
    assert [x[0] for x in ranks] == list(range(1, len(drawn) + 1)) and [x[1:] for x in ranks] == drawn


def test_resample_edges(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resample.resample(spark, none, none).count() == 0
    docs = spark.createDataFrame([(1, "a " * 30), (2, None)], "doc_id long, text string")
    got = {x["doc_id"]: x for x in resample.resample(spark, docs, none, share=100).collect()}
    assert got[1]["rank"] == 1 and got[2]["rank"] is None and (got[2]["weight"], got[2]["n_features"]) == (0, 0)
    with pytest.raises(ValueError):
        resample.resample(spark, docs, none, buckets=1 << 30)


# 13


def library_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def own_ids(texts, limit=bpe.PART_BYTES):
    out = []
    for a, b, ids, at in bpe.encode_column(bpe.vocabulary_of(PATH), pa.array(texts, pa.string()), limit):
        out += [ids[at[i] : at[i + 1]].tolist() for i in range(b - a)]
    return out


MARKS = [*"abcdeéßñ  \n\t'''srtvelmd.,!?0123٣ⅷ  　中文字😀́<|>_-\x00\x1c\x85", "'s", "'re", "'ll", "<|endoftext|>", " \n", "  ", "'S"]


@pytest.mark.parametrize("size,n,limit", [(60, 4000, 1 << 21), (3000, 10, 500), (9, 4000, 64)])
def test_bpe_random_texts(size, n, limit):
    r = random.Random(size)
    texts = ["".join(r.choice(MARKS) for _ in range(r.randrange(size + 1))) for _ in range(n)]
    assert own_ids(texts, limit) == library_ids(texts)


def test_bpe_words_that_fail_the_check():
    """Random letters often fail greedy matching, in short words and in ones long enough for the heap."""
    r = random.Random(4)
    texts = ["".join(r.choice("etaoinshr") for _ in range(r.randrange(1, 14))) for _ in range(5000)]
    texts += ["".join(r.choice("etaoinshr=") for _ in range(6000)), "a" * 5000, "ab" * 999, "=-" * 3000, "0" * 1000, " " * 700, "é" * 77]
    texts += ["a" * n for n in range(1, 120)]
    assert own_ids(texts) == library_ids(texts)


def test_bpe_pairs_are_checked_exactly():
    """A pair is compatible if merging its bytes gives it back."""
    v, r = bpe.vocabulary_of(PATH), np.random.default_rng(1)
    a, b = r.integers(0, 50256, (2, 4000))
    texts = [v.bytes[v.begin[i] : v.begin[i] + v.size[i]].tobytes() + v.bytes[v.begin[j] : v.begin[j] + v.size[j]].tobytes() for i, j in zip(a.tolist(), b.tolist())]
    want = [v.merged_long(t) == [i, j] for t, i, j in zip(texts, a.tolist(), b.tolist())]
    assert v.compatible(a, b).tolist() == want and 0 < sum(want) < len(want)


def test_bpe_one_word_of_a_megabyte():
    r = random.Random(6)
    text = "".join(r.choice("abcdefgh") for _ in range(1 << 20))
    assert own_ids([text]) == library_ids([text])


def test_bpe_round_trip(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "one two"), (4, "it's <|endoftext|> here\n\n  x"), (4, "it's <|endoftext|> here\n\n  x"), (5, "😀 ünï 中文 " * 4000), (6, "word " * 600_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit("x"), "n_tokens": F.lit(0)})
    coded = bpe.encode(spark, docs, PATH)
    got = bpe.decode(spark, coded, PATH)
    assert Counter((x["doc_id"], x["text"]) for x in got.collect()) == Counter((i, t or "") for i, t in rows)
    figures = {x["doc_id"]: x for x in bpe.summary(got).collect()}
    for (i, t), ids in zip(rows, library_ids([t or "" for _, t in rows])):
        x = figures[i]
        assert (x["n_tokens"], x["ids_sha256"], x["decoded_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(spark, bpe.encode(spark, none, PATH), PATH).count() == 0


def test_bpe_decodes_any_ids(spark):
    coded = spark.createDataFrame([(1, [50256, 0, -1, 99999]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert {x["doc_id"]: x["text"] for x in bpe.decode(spark, coded, PATH).collect()} == {1: "<|endoftext|>!", 2: None, 3: ""}


def test_bpe_query_on_the_table(spark):
    from lotloom.llm.queries import op13_bpe
    from lotloom.session import table

    docs = {x["doc_id"]: x["text"] or "" for x in table(spark, "/root/testdata/sf0.001", "documents").collect()}
    ids = dict(zip(docs, library_ids(list(docs.values()))))
    got = op13_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs)
    for x in got:
        assert x["n_tokens"] == len(ids[x["doc_id"]]) and x["ids_sha256"] == hashlib.sha256(",".join(map(str, ids[x["doc_id"]])).encode()).hexdigest()
        assert x["decoded_sha256"] == hashlib.sha256(docs[x["doc_id"]].encode()).hexdigest()
