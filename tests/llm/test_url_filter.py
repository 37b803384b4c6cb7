import re

from pyspark.sql import functions as F

from ramure.llm.url_filter import host_of, judge_urls, match_rules, mine_rules, path_of, url_tokens


def rows_of(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns(
        {name: F.lit("own") for name in ("row", "tokens", "host", "path", "rule", "known", "verdict")})


def test_hosts_and_paths(spark):
    urls = ["HTTP://WWW.Example.COM/A/b?x=1#y", "https://a.b", "a.b/c", "", None, "x://h?q/r", "x://h#f?g", "://host/p", "a://b://c/d", "x:///p", "ä://É.Ö/ß\n/q?"]
    rows = rows_of(spark, urls).select("page_id", host_of(F.col("url")), path_of(F.col("url"))).collect()
    assert [tuple(row)[1:] for row in sorted(rows)] == [
        ("www.example.com", "/A/b"), ("a.b", ""), ("", ""), ("", ""), ("", ""), ("h", ""), ("h", ""), ("host", "/p"), ("b:", "//c/d"), ("", "/p"),
        ("É.Ö", "/ß\n/q")]


def test_longest_rule_wins_and_defaults(spark):
    urls = ["http://a.net/x", "http://example.net/en/1", "http://m.example.net/en/", "http://notexample.net/en/", "http://example.com/de/1",
            "http://x.example.com/de/", "http://example.com/de", "http://z.org/fr/1", "http://z.org/en", "http://net", "http://net/", None, None]
    found = {row["page_id"]: (row["rule"], row["verdict"]) for row in judge_urls(rows_of(spark, urls)).collect()}
    assert [found[n] for n in range(13)] == [
        ("net/", "block"), ("example.net/en/", "allow"), ("example.net/en/", "allow"), ("net/", "block"), ("example.com/de/", "block"),
        ("example.com/de/", "block"), (None, "allow"), ("org/fr/", "allow"), (None, "allow"), (None, "allow"), ("net/", "block"), (None, "allow"),
        (None, "allow")]
    assert judge_urls(rows_of(spark, urls).limit(0)).count() == 0


def test_tokens(spark):
    row = rows_of(spark, ["http://www.free-bets.example.com/en/12-x/?a=1&b=#t"]).select(url_tokens(F.col("url"), host_of(F.col("url")), path_of(F.col("url")))).first()
    assert sorted(row[0]) == ["label:example", "label:free-bets", "label:www", "part:bets", "part:free", "query:a=1", "query:b=", "segment:0-x",
                              "segment:en", "top:com"]


def test_mined_rules_and_their_index(spark):
    baskets = [(["a", "b"], "block")] * 30 + [(["a"], "allow")] * 30 + [(["b"], "allow")] * 30 + [(["c", "d"], "block")] * 20 + [(["e"], "block")] * 3
    labelled = spark.createDataFrame(baskets, "tokens array<string>, verdict string")
    rules = mine_rules(labelled, support=0.05, confidence=0.8)
    mined = {(tuple(row["tokens"]), row["verdict"]): row["confidence"] for row in rules.collect()}
    assert mined == {(("a", "b"), "block"): 1.0, (("c",), "block"): 1.0, (("d",), "block"): 1.0}  # c and d together gain nothing
    urls = spark.createDataFrame([(1, ["a", "b", "x"]), (2, ["a"]), (3, ["d"]), (4, []), (5, ["e"])], "row long, tokens array<string>")
    assert {row["row"]: row["verdict"] for row in match_rules(urls, rules).collect()} == {1: "block", 3: "block"}
    assert mine_rules(labelled.limit(0)).count() == 0


def test_urls_without_a_rule_follow_mined_ones(spark):
    urls = [f"http://spam-{n % 3}.net/casino/{n}" for n in range(40)] + [f"http://m.example.net/en/{n}" for n in range(40)] + [
        "http://other.com/casino/7", "http://other.com/en/7"]
    found = {row["page_id"]: row["verdict"] for row in judge_urls(rows_of(spark, urls)).collect()}
    assert found[80] == "block" and found[81] == "allow"


def test_no_python_in_the_plan(spark):
    plan = judge_urls(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)
