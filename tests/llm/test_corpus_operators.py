"""Operators that compare documents, or learn from them, against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from motionframe.llm import neardup, neighbours, quality, substrings, urls
from motionframe.llm.frames import table
from motionframe.llm.queries_scores import RULES, fold

SF = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, id string, v int"


def corpus(seed=0, n=60):
    """Texts of a few words with shared passages, copies and near copies, empty ones and nulls."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passage, base = text(40), text(120)
    rows = []
    for i in range(n):
        kind = i % 6
        words = text(rng.randint(0, 60))
        if kind == 0:
            words = words + passage[rng.randint(0, 20) :] + text(5)
        if kind == 1:
            words = base[:]
            words[rng.randrange(120)] = "changed"
        if kind == 2:
            words = base[10:] if i % 4 else base[:]
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words), "x", i))
    rng.shuffle(rows)
    return [*rows, (n, None, "x", 1), (n + 1, "", None, 1), (n + 2, " \n", "x", 1), (n + 3, "four words of text", "x", 1), (n + 4, "FOUR words of text", "x", 1), (None, " ".join(base), "x", 1), (1, " ".join(base), "other", 1)]


def removed(rows):
    first = {}
    cut = [(i, t, (t or "").encode().split()) for i, t, *_ in rows]
    for i, _, w in cut:
        for k in range(len(w) - 12 if i is not None else 0):
            run = tuple(w[k : k + 13])
            first[run] = min(first.get(run, i), i)
    out = []
    for i, t, w in cut:
        gone = set()
        for k in range(len(w) - 12 if i is not None else 0):
            if first[tuple(w[k : k + 13])] < i:
                gone |= set(range(k, k + 13))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [0, 1])
def test_substrings_against_brute_force(spark, seed):
    rows = corpus(seed)
    got = substrings.remove(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=str) == removed(rows)


def test_substrings_keep_columns_and_untouched_texts(spark):
    rows = [(1, "a  b\nc", "keep", 1), (2, None, "null", 2)]
    got = substrings.remove(spark.createDataFrame(rows, DOCS), carry=("id", "v"), untouched=True).collect()
    assert {(r.doc_id, r.kept, r.id, r.v) for r in got} == {(1, "a  b\nc", "keep", 1), (2, None, "null", 2)}
    assert substrings.remove(spark.createDataFrame([], DOCS)).collect() == []


def groups(rows, percent):
    sets = {}
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        s = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(s)
    known = [i for i in sets if i is not None]
    root = {i: i for i in known}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in known:
        for b in known:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in known}


@pytest.mark.parametrize("percent", [50, 80, 85])
def test_near_duplicates_against_brute_force(spark, percent):
    rows = corpus(2, 90)
    got = neardup.near_duplicates(spark.createDataFrame(rows, DOCS), percent).collect()
    assert len(got) == len(rows)
    wanted = groups(rows, percent)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    assert next(r for r in got if r.doc_id is None).component_id is None
    assert {r.n_shingles for r in got if r.doc_id in (90, 91, 92)} == {0}


def twins(n=12):
    """Two words that every polynomial hash modulo 2**64 takes for one."""
    one = "a"
    for _ in range(n):
        one += one.translate(str.maketrans("ab", "ba"))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_words_that_polynomial_hashes_take_for_one(spark):
    one, other = twins()
    rest = [f"w{i}" for i in range(20)]
    docs = spark.createDataFrame([(1, " ".join([*rest[:6], one, *rest[6:12]])), (2, " ".join([*rest[:6], other, *rest[6:12]])), (3, f"{one} x"), (4, f"{other} x")], "doc_id bigint, text string")
    assert {r.doc_id: r.n_removed for r in substrings.remove(docs).collect()} == dict.fromkeys((1, 2, 3, 4), 0)
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 100).collect()} == {k: k for k in (1, 2, 3, 4)}


def plain_paths(edges, cut):
    """The edges (tail, head, first document) of each path of a graph, by walking; nodes in cut end paths."""
    out, into = {}, {}
    for t, h, d in edges:
        out.setdefault(t, []).append((t, h, d))
        into.setdefault(h, []).append((t, h, d))
    inner = lambda n: len(out.get(n, [])) == 1 == len(into.get(n, [])) and out[n][0][2] == into[n][0][2] and n not in cut
    found = []
    for e in edges:
        if inner(e[0]):
            continue
        path = [e]
        while inner(path[-1][1]):
            path.append(out[path[-1][1]][0])
        found.append(path)
    return found


def test_paths_against_a_plain_graph(spark):
    rng = random.Random(3)
    # a few long paths, that branch and meet, numbered so that neighbours in the graph aren't neighbours in the document
    edges = {(n, n + 1, 1 + n // 40) for n in range(200)} | {(rng.randrange(200), 300 + k, 1) for k in range(6)} | {(320 + k, rng.randrange(200), 2) for k in range(6)}
    ring = [(900, 901, 1), (901, 902, 1), (902, 900, 1)]
    places = {e: k for k, e in enumerate(sorted(edges | set(ring), key=lambda e: e[0] if e[0] % 9 else rng.random() * 999))}
    cut = {17, 55, 56, 130}  # where other texts have the edge before than have the one after
    rows = [(t, 1000 * t + h, h, d, places[t, h, d], t + 5000 * (t in cut), h) for t, h, d in places]
    got = substrings.compacted(spark.createDataFrame(rows, "tail bigint, check bigint, head bigint, first_id bigint, at bigint, here bigint, next bigint")).collect()
    paths = {}
    for r in got:
        if r.tail < 900:
            paths.setdefault(r.path, []).append((r.offset, (r.tail, r.check - 1000 * r.tail, r.first_id)))
    assert sorted([e for _, e in sorted(p)] for p in paths.values()) == sorted(plain_paths(sorted(edges), cut))
    assert all([o for o, _ in sorted(p)] == list(range(len(p))) for p in paths.values())
    assert len(got) == len(rows)


def test_a_path_in_a_text_is_one_row(spark):
    """Six texts share 60 words, one of them has 20 of these only, and one has them twice: rows of the join are counted."""
    rng = random.Random(8)
    word = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    shared = word(60)
    texts = [[*word(15), *shared, *word(15)] for _ in range(6)] + [[*word(9), *shared[20:40], *word(9)], [*shared, *word(3), *shared]]
    rows = [(i, " ".join(t), "", 0) for i, t in enumerate(texts)]
    got = substrings.spans(spark.createDataFrame(rows, DOCS).repartition(4)).collect()
    # the short one parts the 48 windows into 20, 8 and 20
    assert sorted((r.id, r.start, r.n_windows) for r in got) == sorted([(i, 15 + at, n) for i in range(1, 6) for at, n in ((0, 20), (20, 8), (28, 20))] + [(6, 9, 8)] + [(7, base + at, n) for base in (0, 63) for at, n in ((0, 20), (20, 8), (28, 20))])
    assert len({r.path for r in got}) == 3 and {r.first_id for r in got} == {0}
    assert {r.first_place for r in got} == {15, 35, 43}
    assert sorted(tuple(r) for r in substrings.remove(spark.createDataFrame(rows, DOCS)).collect()) == removed(rows)


@pytest.mark.parametrize("seed", [5, 6])
def test_texts_that_go_round_and_rows_of_one_id(spark, seed):
    """Few words, so that windows repeat within a text, and many texts of one id, some of them twice."""
    rng = random.Random(seed)
    loop = [f"v{i}" for i in range(rng.choice([3, 16]))]
    rows = []
    for i in range(60):
        at = rng.randrange(len(loop))
        part = ((loop[at:] + loop) * 9)[: rng.choice([5, 13, 14, 40, 44])]
        rows.append((i % 20, " ".join([*[f"x{rng.randrange(99)}" for _ in range(rng.randrange(3))], *part, *[f"y{rng.randrange(3)}"] * rng.choice([0, 1, 30])]), "", 0))
    rows += rows[:7]
    got = substrings.remove(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    assert sorted((tuple(r) for r in got), key=str) == removed(rows)


def test_what_is_left_keeps_its_white_space(spark):
    run = " ".join(f"p{i}" for i in range(14))
    docs = spark.createDataFrame([(1, f"a\n\nb {run} z"), (2, f" c\td\n\n{run}\ne  f\n"), (3, f"{run}\tx"), (4, f"y\n{run} ")], "doc_id bigint, text string")
    got = {r.doc_id: r.kept for r in substrings.remove(docs, untouched=True).collect()}
    assert got == {1: f"a\n\nb {run} z", 2: " c\td\n\ne  f\n", 3: "x", 4: "y"}


def test_many_texts_alike_but_not_enough_make_few_candidates(spark, monkeypatch):
    """Texts with some words of one base changed: pairs are from 50 to 90 % alike, and most of them must not be listed."""
    counts = {}

    def candidates(n):
        rng = random.Random(n)
        base = [f"b{i}" for i in range(100)]
        rows = [(0, " ".join(base))]
        for i in range(1, n):
            words = base[:]
            for k in rng.sample(range(100), rng.randint(1, 5)):
                words[k] = f"x{i}-{k}"
            rows.append((i, " ".join(words)))
        made, real = [], neardup.possible

        def counted(*a):
            made.append(real(*a).count())
            return real(*a)

        monkeypatch.setattr(neardup, "possible", counted)
        got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 80).collect()
        monkeypatch.setattr(neardup, "possible", real)
        counts[n] = sum(made)
        return rows, got

    rows, got = candidates(150)
    assert {r.doc_id: r.component_id for r in got} == components_of(rows, 80)
    candidates(300)
    assert counts[300] <= 2 * counts[150] + 300


def components_of(rows, percent):
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t in rows for w in [t.split()]}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def test_near_duplicates_through_a_middle_text(spark):
    """Copies that resemble a common origin, but not each other, are found through it in any order of ids."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(40):
        words = base[:]
        if i != 23:
            for k in rng.sample(range(300), 5):
                words[k] = f"x{i}_{k}"
        rows.append((i, " ".join(words), "x", 1))
    got = neardup.near_duplicates(spark.createDataFrame(rows, DOCS), 80).collect()
    assert {r.doc_id: r.component_id for r in got} == groups(rows, 80)


def test_near_duplicates_of_nothing(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


def test_near_duplicate_stage_keeps_repeated_rows_once(spark):
    text, other = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, text, "en", "w", 9), (1, text, "de", "w", 9), (1, text, "de", "w", 9), (2, text, "de", "w", 9), (1, other, "en", "w", 9), (3, None, None, "w", 0), (3, None, None, "w", 0), (4, "single", "en", "w", 6), (None, text, "en", "w", 9), (None, text, "en", "w", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = [tuple(r) for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted([rows[1], rows[4], rows[5], rows[7], rows[8], rows[9]], key=str)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 50)] + [(100, 101)], "a bigint, b bigint")
    got = {r.id: r.component for r in neardup.components(edges).collect()}
    assert all(got[i] == 1 for i in range(2, 51)) and got[101] == 100


def test_quality_on_held_out_labels(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality.train(docs, labels.where(fold("doc_id") != 1))
    rows = quality.score(docs.select("doc_id", "text"), model).join(labels.where(fold("doc_id") == 1), "doc_id").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows)
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([[a > b for b in bad] for a in good]) > 0.98


@pytest.mark.parametrize("n_bad", [1, 2, 7, 8, 48, 49, 50, 105, 161, 217, 840])
@pytest.mark.parametrize("n_good", [1, 30, 49, 300, 2000])
def test_all_rows_of_both_labels_meet(n_good, n_bad):
    pairs = quality.meetings(n_good, n_bad, 8)
    for side, n in ((0, n_good), (1, n_bad)):
        assert np.bincount(np.concatenate([p[side] for p in pairs]), minlength=n).min() >= 8


def test_quality_edges(spark):
    rows = [(1, None, "x", 1), (2, "", "x", 1), (3, "word " * 50000, None, 1), (None, "a b c", "x", 1), (4, "###", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string, v int")
    for labelled, wanted in (([], 1), ([(1, 1), (4, 1)], 1), ([(3, 0), (4, 0)], 0)):
        labels = spark.createDataFrame(labelled, "doc_id bigint, quality int")
        got = quality.score(docs, quality.train(docs, labels)).collect()
        assert {r.predicted for r in got} == {wanted} and all(0 <= r.score <= 1 for r in got)
    mixed = spark.createDataFrame([(3, 1), (4, 0), (4, None), (None, 1), (2, 7)], "doc_id bigint, quality int")
    got = {r.doc_id: r for r in quality.score(docs, quality.train(docs, mixed)).collect()}
    assert got[3].predicted == 1 and got[4].predicted == 0 and got[1].score == got[2].score
    assert quality.score(docs.limit(0), quality.train(docs, mixed)).collect() == []


def judged(rows, labels, p):
    """templates and verdicts by plain loops"""
    import math
    import re

    pages = []
    for i, url in rows:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        seg = path.removeprefix("/").split("/") if path else []
        pages.append({"id": i, "host": host, "path": path, "seg": seg, "t": "", "bad": labels.get(i)})
    for level in range(p.depth):
        child = {}
        for x in pages:
            if level < len(x["seg"]):
                c = child.setdefault((x["host"], x["t"], x["seg"][level]), [0, 0, 0])
                c[0] += 1
                c[1] += x["bad"] is not None
                c[2] += x["bad"] or 0
        keep = set()
        for (h, t, s), (n, m, b) in child.items():
            all_m = sum(v[1] for k, v in child.items() if k[:2] == (h, t))
            all_b = sum(v[2] for k, v in child.items() if k[:2] == (h, t))
            if n >= p.min_support and m >= p.min_labelled and all_m > m:
                rate = all_b / all_m
                error = math.sqrt(rate * (1 - rate) * (1 / m + 1 / (all_m - m)))
                if error and abs(b / m - (all_b - b) / (all_m - m)) / error >= p.min_z:
                    keep.add((h, t, s))
        for x in pages:
            if level < len(x["seg"]):
                x["t"] += "/" + (x["seg"][level] if (x["host"], x["t"], x["seg"][level]) in keep else "*")
    for x in pages:
        x["t"] += "/*" if len(x["seg"]) > p.depth else ""
    total = [x["bad"] for x in pages if x["bad"] is not None]
    prior = 1 - sum(total) / len(total) if total else 1.0
    out = {}
    for x in pages:
        mine = [y["bad"] for y in pages if (y["host"], y["t"]) == (x["host"], x["t"]) and y["bad"] is not None]
        purity = (len(mine) - sum(mine) + p.prior_weight * prior) / (len(mine) + p.prior_weight)
        fits = [r for r in RULES if (x["host"] == r.host or x["host"].endswith("." + r.host)) and x["path"].startswith(r.path)]
        rule = max(fits, key=lambda r: len(r.text), default=None)
        out[x["id"]] = (x["host"], x["path"], rule and rule.text, rule.verdict if rule else "block" if purity < p.min_purity else "allow", x["t"])
    return out


def test_urls_against_plain_loops(spark):
    rng = random.Random(5)
    p = urls.TreeParams(min_support=4, min_labelled=3, depth=3)
    rows, labels = [], {}
    for i in range(600):
        kind = rng.choice(["news", "spam", "shop"])
        rows.append((i, f"https://{rng.choice(['A', 'b'])}.example.{rng.choice(['net', 'com', 'org'])}/{rng.choice(['en', 'fr', 'de', 'es'])}/{kind}/{rng.randrange(999)}" + rng.choice(["", "?q=1", "/x/y", "#t"])))
        if rng.random() < 0.5:
            labels[i] = int(rng.random() < (0.9 if kind == "spam" else 0.1))
    rows += [(600, None), (601, ""), (602, "no scheme/en"), (603, "http://HOST.example.org"), (604, "http://example.org/en/1?x"), (605, "http://notexample.org/es/"), (606, "x://a\nb/c"), (607, "http://u:p@c.com:80/de/")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, host string, bad int")
    found = spark.createDataFrame([*labels.items(), (1, None), (2, 5), (None, 1)], "page_id bigint, bad int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.template) for r in urls.judge(frame, found, RULES, p).collect()}
    assert got == judged(rows, labels, p)
    assert any('spam' in t for *_, t in got.values())
    assert urls.judge(frame.limit(0), found, RULES).collect() == []


def test_urls_that_part_deep_and_branches_that_are_alike(spark):
    rows, labels = [], {}

    def add(url, n, bad):
        for k in range(n):
            labels[len(rows)] = int(k < bad)
            rows.append((len(rows), url % k))

    for part, bad in (("good", 0), ("bad", 40)):
        add(f"http://deep.net/2024/01/02/a/b/c/{part}/%d/x", 40, bad)
    for part, bad in (("p", 10), ("q", 11), ("r", 0), ("s", 1)):
        add(f"http://flat.net/{part}/%d", 20, bad)
    add("http://flat.net/t/%d", 8, 5)
    pages, found = spark.createDataFrame(rows, "page_id bigint, url string"), spark.createDataFrame([*labels.items()], "page_id bigint, bad int")
    got = urls.judge(pages, found, []).collect()
    deep = {(r.template, r.verdict) for r in got if r.host == "deep.net"}
    assert {v for t, v in deep if "/good/" in t} == {"allow"} and {v for t, v in deep if "/bad/" in t} == {"block"} and len(deep) == 2
    purity = {r.template.split("/")[1]: round(r.purity, 9) for r in got if r.host == "flat.net"}
    prior = 1 - sum(labels.values()) / len(labels)
    smooth = lambda good, n: round((good + 10 * prior) / (n + 10), 9)
    assert purity == {"p": smooth(19, 40), "q": smooth(19, 40), "r": smooth(39, 40), "s": smooth(39, 40), "*": smooth(3, 8)}


def exact(rows, queries, k):
    out = {}
    for i, q in queries:
        scores = [(-sum(a * b for a, b in zip(q, v)), j) for j, v in rows if j != i]
        out[i] = [j for _, j in sorted(scores)[:k]]
    return out


def test_neighbours_of_few_vectors_are_exact(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(round(x, 3)) for x in rng.normal(size=8) * (1 + i % 3)]) for i in range(60)]
    rows += [(100 + i, rows[7][1]) for i in range(30)]
    odd = [(200, None), (201, [0.0] * 8), (202, [float("nan")] + [1.0] * 7), (203, [None] + [1.0] * 7), (204, [float("inf")] * 8), (None, [1.0] * 8), (205, [])]
    base = spark.createDataFrame([(*r, "x", 1) for r in rows + odd], "vec_id bigint, embedding array<double>, id string, rank int")
    got = neighbours.nearest(base, base.where("vec_id % 7 = 0 or vec_id is null"), k=20).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found == exact(rows, [r for r in rows if r[0] % 7 == 0], 20)
    assert neighbours.nearest(base.limit(0), base).collect() == []
    one = base.where("vec_id = 3")
    assert neighbours.nearest(one, one).collect() == []


@pytest.mark.parametrize("longest", [1, 30_000])
def test_neighbours_recall_on_a_graph_of_many_blocks(spark, longest):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 24))
    x[17] *= longest
    base = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    p = neighbours.Params(block=300)
    got = neighbours.nearest(base, base.where("vec_id % 20 = 0"), 20, p).collect()
    assert len(got) == 150 * 20
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
        assert abs(r.score - x[r.query_id] @ x[r.vec_id]) <= 1e-9 * longest
    hits = 0
    for i, mine in found.items():
        s = x @ x[i]
        s[i] = -np.inf
        hits += len(mine & set(np.argsort(-s)[:20].tolist()))
    assert hits >= 0.9 * len(got)


def test_neighbours_of_odd_vectors(spark):
    rows = [(1, [1e200, 0.0]), (2, [1.0]), (3, [-1.0, 2.0, 0.0]), (4, [1e-200, 1e-200]), (2, [3.0, 1.0]), (5, [1.0])]
    base = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = neighbours.nearest(base, base.where("vec_id = 5"), 20).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 1e200), (2, 3.0), (2, 1.0), (4, 1e-200), (3, -1.0)]
