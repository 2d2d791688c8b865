import random

import pytest

from motionframe.llm import urls
from motionframe.llm.frames import spread_join, written
from motionframe.llm.queries_scores import op7_url_filter
from motionframe.llm.urls import Rule


def fitting(rules, host, path):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)  # the first of equal length


def test_rules_as_a_table_against_a_loop(spark):
    rng = random.Random(3)
    ends = ["org", "a.org", "b.a.org", "com", "x.com", "", "net.", "ü.net"]
    rules = [Rule(rng.choice(["allow", "block"]), rng.choice(ends), rng.choice(["", "/", "/e", "/en/", "/en/1", "//", "/é"])) for _ in range(40)]
    rules += [Rule("block", "a.org", "/same"), Rule("allow", "a.org", "/same"), Rule("allow", "com", "/xy"), Rule("block", "x.com", "")]
    hosts = [*ends, "c.b.a.org", "aorg", "org.a", "..", ".org", "a.org.", "1.2.3.4.5.6.7.8.9.x.com", "x" * 5000 + ".com", "." * 5000 + "org"]
    paths = ["", "/", "/e", "/en", "/en/", "/en/12", "//x", "/é/", "/same/1", "/xyz", "/" + "y" * 5000]
    frame = spark.createDataFrame([(h, p, 1) for h in hosts for p in paths], "host string, path string, n int")
    for some in (rules, rules[:1], []):
        got = {(r.host, r.path): (r.rule, r.verdict) for r in urls.ruled(frame, urls.rule_table(spark, some)).collect()}
        assert len(got) == len(hosts) * len(paths)
        for (h, p), found in got.items():
            r = fitting(some, h, p)
            assert found == ((r.text, r.verdict) if r else (None, None)), (h[:20], p[:20])
    assert urls.ruled(frame.limit(0), urls.rule_table(spark, rules)).collect() == []


def test_many_rules_are_looked_up(spark):
    rules = spark.range(100_000).selectExpr("cast(id as int) place", "if(id % 2 = 0, 'block', 'allow') verdict", "concat('h', id, '.net') host", "if(id % 3 = 0, '/p', '') path")
    frame = spark.range(500).selectExpr("concat('www.h', id * 199, '.net') host", "'/p/q' path")
    got = {r.host: (r.rule, r.verdict) for r in urls.ruled(frame, rules).collect()}
    assert got == {f"www.h{i}.net": (f"h{i}.net" + ("/p" if i % 3 == 0 else ""), "block" if i % 2 == 0 else "allow") for i in range(0, 500 * 199, 199)}


@pytest.mark.parametrize("shares", [{"spam": 0.9, "news": 0.1}, {"spam": 0.25, "news": 0.25}])
def test_a_threshold_is_taken_only_if_it_beats_a_constant(spark, shares):
    rng = random.Random(11)
    rows = [(i, f"http://h{i % 3}.net/{kind}/{i}") for i in range(3000) for kind in [rng.choice([*shares])]]
    labels = [(i, int(rng.random() < next(s for k, s in shares.items() if k in url))) for i, url in rows]
    pages, found = spark.createDataFrame(rows + [(7, "http://h1.net/news/7")] * 5, "page_id bigint, url string"), spark.createDataFrame(labels, "page_id bigint, bad int")
    got = urls.judge(pages, found, [], urls.TreeParams(min_purity=None)).collect()
    assert len(got) == 3005
    differ = shares["spam"] != shares["news"]
    assert {("spam" in r.path, r.verdict) for r in got} == ({(True, "block"), (False, "allow")} if differ else {(True, "allow"), (False, "allow")})
    of = urls.held_out(pages, found).orderBy("threshold").collect()
    best = max(2 * r.bad - r.blocked for r in of)
    assert (best > 300) == differ
    assert of[-1].blocked == sum((__import__("zlib").crc32(str(i).encode()) % 3 == 1) * (6 if i == 7 else 1) for i, _ in rows)


def test_no_labels_and_no_pages(spark):
    pages, none = spark.createDataFrame([(1, None), (None, "http://a.b/c"), (None, "http://a.b/c")], "page_id bigint, url string"), spark.createDataFrame([], "page_id bigint, bad int")
    p = urls.TreeParams(min_purity=None)
    assert sorted((r.page_id or 0, r.host, r.verdict, r.purity) for r in urls.judge(pages, none, [], p).collect()) == [(0, "a.b", "allow", 1.0), (0, "a.b", "allow", 1.0), (1, "", "allow", 1.0)]
    assert urls.judge(pages.limit(0), none, [Rule("block", "b", "")], p).collect() == []


def test_what_grows_with_pages_and_labels_is_not_broadcast(spark, tmp_path):
    """Repetitive rows take far less of a file than of the driver's memory, so Spark would broadcast them."""
    keys = written(spark.range(20_000).selectExpr("id", "repeat('same', 100) text"))
    joined = spread_join(spark.range(20_000), keys, ["id"], ["id"])
    assert joined.where("text is not null").count() == 20_000 and "BroadcastHashJoin" not in joined._jdf.queryExecution().toString()

    spark.range(300).selectExpr("id page_id", "concat('http://a.example.net/', if(id % 2 = 0, 'x', 'y'), '/', id) url").write.parquet(f"{tmp_path}/pages.parquet")
    spark.range(300).selectExpr("id doc_id", "cast(id % 2 as int) quality", "0 toxic").write.parquet(f"{tmp_path}/labels.parquet")
    out = op7_url_filter(spark, str(tmp_path))
    assert {(r.page_id, r.verdict) for r in out.collect()} == {(i, "block" if i % 2 == 0 else "allow") for i in range(300)}
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().toString()
