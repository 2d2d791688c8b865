"""The audit of filters, the mix of sources and the repair of conversations against plain loops."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from motionframe.llm import audit, conversations, mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, source string, mask int, n int, s string, held int, target string, id string"
LABELS = "doc_id bigint, quality int, toxic int, part string"
TURNS = "conv_id bigint, turn bigint, role string, text string, _k int, place int"


def corpus(seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice(["a", "B", "word", "Ünï", "x#y", "ok", "t" * 70]) for _ in range(rng.choice([0, 1, 3, 150, 210, 400]))) for _ in range(25)]
    pool += ["", None, "\x1c\x85 one", " ".join(f"w{i}" for i in range(260)), "ABC " * 300, "a|b"]
    rows = [(rng.choice([None, *range(60)]), rng.choice(pool), rng.choice(["s1", "s2", "", None, "é"]), 1, 2, "x", 3, "y", "z") for _ in range(90)]
    return [*rows, rows[0], rows[1], rows[1]]


def audited(rows, labels):
    first = {}
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    docs = []
    for i, t, part, *_ in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > first.get(t, i)}
        mine = [x for x in labels if i is not None and x[0] == i]
        docs.append((part or "", {k for k, v in fails.items() if v}, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out, shapley = {}, Counter()
    for part in {d[0] for d in docs}:
        for order in itertools.permutations("ABCDE"):
            here = [d for d in docs if d[0] == part]
            whole = here
            for step, f in enumerate(order, 1):
                gone = [d for d in here if f in d[1]]
                left = [d for d in here if f not in d[1]]
                fail = [d for d in whole if f in d[1]]
                out[part, "".join(order), step] = [len(left), len(gone), len(fail) - len(gone), sum(d[1] == {f} for d in whole), sum(d[2] for d in gone), sum(d[3] for d in gone)]
                shapley[part, f] += len(gone)
                here = left
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("seed", [0, 1])
def test_audit_against_plain_loops(spark, seed):
    rows = corpus(seed)
    rng = random.Random(seed)
    labels = [(rng.choice([None, *range(70)]), rng.choice([0, 1, None]), rng.choice([0, 1, None]), "x") for _ in range(60)]
    got = audit.audit(spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(labels, LABELS)).collect()
    want = audited(rows, labels)
    assert len(got) == len(want)
    assert {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got} == want


def test_audit_of_nothing_and_of_other_filters(spark):
    none = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], LABELS)
    assert audit.audit(none, labels).collect() == []
    docs = spark.createDataFrame([(1, "a b", "s", 1, 1, "", 1, "", ""), (2, "a", "s", 1, 1, "", 1, "", "")], DOCS)
    got = audit.audit(docs, labels, filters=lambda t, w: {"x": F.size(w) < 2, "y": t.contains("b")}, copies=None).collect()
    assert {(r.filter_order, r.step): (r.kept, r.removed, r.shapley) for r in got} == {("xy", 1): (1, 1, 2), ("xy", 2): (0, 1, 2), ("yx", 1): (1, 1, 2), ("yx", 2): (0, 1, 2)}
    with pytest.raises(ValueError):
        audit.interactions(audit.cells(docs, labels), "AA")


def test_audit_of_a_long_text_and_of_many_copies(spark):
    long = "word " * 2_500_000
    docs = spark.range(3000).select("id", F.when(F.col("id") == 7, F.lit(long)).otherwise(F.lit("the same A")).alias("text"), F.lit("s").alias("source")).withColumnRenamed("id", "doc_id")
    row = audit.audit(docs, spark.createDataFrame([(5, 1, 1, "")], LABELS)).where("filter_order = 'EABCD'").collect()
    got = {r.step: r for r in row}
    assert (got[1].removed, got[1].kept, got[1].good_lost) == (2998, 2, 1) and got[2].removed == 1 and got[3].removed == 1 and got[5].kept == 0


def mixed(rows, weights, share, most):
    """Targets by filling the sources step by step, and what is taken by going through each source in order."""
    size = [len(WORD.findall(r[1] or "")) for r in rows]
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(z for z, r in zip(size, rows, strict=True) if r[2] == s) for s in sources}
    w = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    target, free = {}, set(sources)
    while free:
        level = (share * sum(total.values()) - sum(target.values())) / sum(w[s] for s in free)
        full = {s for s in free if w[s] * level >= most * total[s]}
        if not full:
            target |= {s: w[s] * level for s in free}
            break
        target |= {s: most * total[s] for s in full}
        free -= full
    out = []
    for s in sources:
        mine = sorted((hashlib.md5(f"{'' if r[0] is None else r[0]}|{r[1] or ''}".encode()).hexdigest()[:15], i) for i, r in enumerate(rows) if r[2] == s)
        whole = int(target[s] // total[s]) if total[s] else 0
        room = target[s] - whole * total[s]
        for _, i in mine:
            out.append((rows[i][0], size[i], total[s], round(target[s], 6), size[i] * (whole + (2 * room >= size[i] and size[i] > 0))))
            room -= size[i]
    return sorted(out, key=str)


@pytest.mark.parametrize(("seed", "share", "most"), [(0, 1.5, 2.0), (1, 0.4, 1.0), (2, 2.9, 3.0), (3, 0.0, 2.0)])
def test_mix_against_plain_loops(spark, seed, share, most):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(docs.repartition(3), share=share, most=most)
    flat = lambda df: sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect()), key=str)
    assert flat(got) == mixed(rows, (5, 2, 1), share, most) == flat(mixing.mix(docs.repartition(7), share=share, most=most))


def test_mix_splits_many_rows_of_one_key(spark):
    """Repeated rows have one hash: the next bits tell them apart, and the sum comes out right."""
    docs = spark.range(4000).select(F.when(F.col("id") < 3000, F.lit(1)).otherwise(F.col("id")).cast("bigint").alias("doc_id"), F.lit("four words in it").alias("text"), F.lit("s").alias("source"), F.lit(1).alias("held"))
    got = mixing.mix(docs, share=0.5, most=1.0, carry=("held",))
    r = got.agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.count("*").alias("n"), F.max("repeats").alias("most")).first()
    assert (r.taken, r.target, r.n, r.most) == (8000, 8000.0, 4000, 1)
    assert got.columns == ["doc_id", "size", "source_size", "target", "repeats", "taken", "held"]


def test_mix_carries_columns_and_takes_empty_tables(spark):
    rows = corpus(5)
    got = mixing.mix(spark.createDataFrame(rows, DOCS).withColumn("a`b", F.lit(1)), carry=("text", "n", "a`b")).collect()
    assert Counter(r.text for r in got) == Counter(r[1] for r in rows) and {r.n for r in got} == {2}
    assert mixing.mix(spark.createDataFrame([], DOCS)).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(spark.createDataFrame([], DOCS), share=3.0)


def broken(rows):
    """The contract's faults, and rows by conversation."""
    out = {}
    for conv, turn, role, text, *_ in rows:
        mine = out.setdefault(conv, [])
        show = lambda x: " " if x is None else str(x)
        kind, role, text = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20, show(role), show(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {k: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:])) for k, v in out.items()}


def told(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {r[0] for r in rows} - {None}
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    counts = Counter(faults)
    return faults, (max(turns) - min(turns) + 1 - len(turns) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"], sum(p not in ("su", "ua", "au") for p in pairs))


def cheapest(rows, faults):
    """All edits with up to as many inserts as could be of use, by Dijkstra's search over (row, initials so far as a state)."""
    import heapq

    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, i, state, text = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, letters, text
        follow = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        for x in follow.replace("s", ""):
            name = {"u": "user", "a": "assistant"}[x]
            heapq.heappush(heap, (cost + 5, letters + "I", i, x, (*text, f"{name}:")))
            if i < len(rows) and faults[i] in ("", "truncated"):
                heapq.heappush(heap, (cost + 1 + 5 * (faults[i] == "truncated"), letters + "R", i + 1, x, (*text, f"{name}:{rows[i][2]}")))
        if i < len(rows):
            heapq.heappush(heap, (cost + 2, letters + "D", i + 1, state, text))
            if faults[i] in ("", "truncated") and rows[i][1][:1] in tuple(follow):
                heapq.heappush(heap, (cost + 5 * (faults[i] == "truncated"), letters + "K", i + 1, rows[i][1][:1], (*text, f"{rows[i][1]}:{rows[i][2]}")))
    raise AssertionError


def talk(seed, convs=60, most=14):
    rng = random.Random(seed)
    texts = ["yes.", "no", "why?", "", " \n", "a. ", None, "x\x1c", "same.", "long " * 20 + "!"]
    rows = []
    for c in [None, *range(convs)]:
        n = rng.randint(1, most) if c != 5 else 300
        for k in range(n):
            turn = rng.choice([k, k, k, k + 1, None]) if c is None or c % 3 else k
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "usr"]) if c is None or c % 2 else ("system" if k == 0 and c % 4 else "user" if k % 2 else "assistant")
            rows.append((c, turn, role, rng.choice(texts) if rng.random() < 0.7 else f"{rng.random()}.", 1, 2))
    return rows


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_repair_against_a_search(spark, seed):
    rows = talk(seed)
    got = {r.conv_id: r for r in conversations.report(conversations.damaged(spark.createDataFrame(rows, TURNS).repartition(3))).collect()}
    want = broken(rows)
    assert got.keys() == want.keys()
    for conv, mine in want.items():
        faults, tally = told(mine)
        cost, letters, text = cheapest(mine, faults)
        r = got[conv]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal) == tally
        assert (r.cost, r.audit, r.repaired_sha256) == (cost, letters, hashlib.sha256("\n".join(text).encode()).hexdigest())


def test_repaired_rows_and_conversations_without_rows(spark):
    rows = [(1, 0, "user", "hi."), (1, 1, "user", "hi."), (1, 2, "user", "cut off"), (2, 0, "assistant", "first."), (3, 0, "user", "gone.")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").withColumn("present", F.col("conv_id") != 3)
    got = sorted((r.conv_id, r.place, r.edit, r.role, r.text) for r in conversations.repaired(df).collect())
    assert got == [(1, 0, "D", "user", "hi."), (1, 1, "D", "", ""), (1, 2, "D", "user", "cut off"), (2, 0, "D", "assistant", "first.")]
    none = conversations.report(df.where("conv_id = 3")).collect()[0]
    assert (none.gaps, none.cost, none.audit, none.repaired_sha256) == (0, 0, "", hashlib.sha256(b"").hexdigest())
    assert conversations.report(df.where("false")).collect() == [] and conversations.repaired(df.where("false")).collect() == []


def test_repair_of_a_hot_conversation_keeps_little(spark):
    """A conversation of many rows: what is open stays short, and the result is that of the whole search."""
    rows = [(k, ["user", "assistant"][k % 2] if k % 11 else "tool", f"{k}." if k % 7 else "") for k in range(20_000)]
    repair, letters, deepest = conversations.Repair(), "", 0
    for turn, role, text in rows:
        letters += "".join(x[0] for x in repair.row(turn, role, text))
        deepest = max(deepest, len(repair.open))
    letters += "".join(x[0] for x in repair.end())
    faults, _ = told(rows)
    assert (repair.cost, letters) == cheapest(rows, faults)[:2] and deepest <= 2 * conversations.EVERY
    df = spark.createDataFrame([(9, *r) for r in rows], "conv_id int, turn int, role string, text string")
    assert conversations.report(df).collect()[0].audit == letters
