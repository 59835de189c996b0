import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lexmill.llm import queries, url_filter
from lexmill.llm.url_filter import Rule

SF_DIR = "/root/testdata/sf0.01"
ODD = [
    None,
    "",
    "no scheme here",
    "http://",
    "HTTP://WWW.Example.COM/en/x?q#f",
    "https://a.example.com/en",
    "https://a.example.com/en/",
    "https://example.com?/en/",
    "https://xexample.com/en/1",
    "https://shop.net/es/#x",
    "https://net/fr/1",
    "https://shop.net/FR/1",
    "ftp://É.net/es/a?b",
    "x://b.com/\nline",
    "https://user@example.com:80/en/1",
    "://com/",
]


def plain(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        stop = min((rest.index(c, end) for c in "?#" if c in rest[end:]), default=len(rest))
        path = rest[end:stop]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return host, path, best


@pytest.fixture(scope="module")
def model(spark):
    return url_filter.train(url_filter.labelled_urls(spark))


def test_query_matches_plain_rules(spark):
    urls = {r["page_id"]: r["url"] for r in queries.table(spark, SF_DIR, "pages").collect()}
    rows = queries.op5_url_filter(spark, SF_DIR).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(urls)
    for r in rows:
        host, path, rule = plain(urls[r["page_id"]], queries.URL_RULES)
        assert (r["host"], r["path"]) == (host, path)
        assert r["rule"] == (rule and rule.host + rule.path)
        assert r["verdict"] == (rule.verdict if rule else "block" if r["score"] >= 0.5 else "allow")
    by_model = [r for r in rows if r["rule"] is None]
    is_unwanted = lambda r: any(w in r["host"] for w in ("casino", "ads-", "spam", "adult", "pills", "free-bets"))
    wanted = [r for r in by_model if not is_unwanted(r)]
    unwanted = [r for r in by_model if is_unwanted(r)]
    print(f"pages: {sum(r['verdict'] == 'block' for r in unwanted)} of {len(unwanted)} unwanted blocked, {sum(r['verdict'] == 'allow' for r in wanted)} of {len(wanted)} others allowed")
    assert sum(r["verdict"] == "allow" for r in wanted) > 0.95 * len(wanted)
    assert sum(r["verdict"] == "block" for r in unwanted) > 0.6 * len(unwanted)


def test_odd_urls(spark, model):
    pages = spark.createDataFrame([(i, u, 1, "x") for i, u in enumerate(ODD)] + [(3, ODD[5], 2, "y"), (None, None, None, None)], "page_id long, url string, score int, host string")
    rows = url_filter.judge(pages, queries.URL_RULES, model).collect()
    assert len(rows) == len(ODD) + 2
    for r, url in zip(sorted(rows, key=lambda r: (r["page_id"] is None, r["page_id"] or 0, r["path"])), [*ODD[:3], ODD[3], ODD[5], *ODD[4:], None]):
        host, path, rule = plain(url, queries.URL_RULES)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule.host + rule.path), url
        assert r["verdict"] in ("allow", "block")
    assert url_filter.judge(pages.limit(0), queries.URL_RULES, model).count() == 0


def test_model_on_unseen_urls(spark, model):
    unwanted = ["https://www.mega-casino.org/en/1", "http://poker-win.net/x", "https://cheap-pills-shop.org/a", "https://adult-video.net/1", "http://m.ads-tracker.org/de/9"]
    wanted = ["https://www.science-museum.org/en/1", "http://village-theatre.net/x", "https://garden-weather.org/a", "https://m.history-journal.net/1", "http://orchestra.org/de/9"]
    pages = spark.createDataFrame(list(enumerate(unwanted + wanted)), "page_id long, url string")
    rows = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, [], model).collect()}
    # the labels share no host word with the pages any more: "cheap-pills-shop" stays just under the limit
    assert sum(rows[i] == "block" for i in range(5)) >= 4 and [rows[i] for i in range(5, 10)] == ["allow"] * 5


def test_first_of_equal_rules_and_limit(spark, model):
    pages = spark.createDataFrame([(1, "https://a.org/x")], "page_id long, url string")
    rules = [Rule("block", "org", "/"), Rule("allow", "org", "/")]
    assert url_filter.judge(pages, rules, model).first()["verdict"] == "block"


def test_rules_as_a_table(spark, model):
    """A table of rules, or a long list, decides like the expression."""
    rules = [*queries.URL_RULES, Rule("block", "b.com", "/"), Rule("allow", "", "/zz")]
    rules += [Rule("block", f"host{i}.org", "/x/" * (i % 3)) for i in range(600)]
    urls = [*ODD, "http://a.host7.org/x/1", "http://host8.org/x/x/1", "http://host9.org/", "http://nothost9.org/x/", "http:///zz"]
    pages = spark.createDataFrame([*enumerate(urls), (3, urls[4])], "page_id long, url string")
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    for given in (rules, table):
        found = url_filter.judge(pages, given, model).collect()
        assert len(found) == len(urls) + 1
        for r in found:
            url = urls[4] if r["page_id"] == 3 and r["host"] else urls[r["page_id"]]
            _, _, rule = plain(url, [x for x in rules if x.host])
            if r["host"]:
                assert r["rule"] == (rule and rule.host + rule.path), url
                assert rule is None or r["verdict"] == rule.verdict


def test_after_an_observed_query(spark):
    """A session that has observed a query, or built an index, can still judge."""
    observed = Observation()
    spark.range(3).observe(observed, F.count("*").alias("n")).collect()
    assert observed.get["n"] == 3
    again = url_filter.train(url_filter.labelled_urls(spark))
    assert url_filter.judge(queries.table(spark, SF_DIR, "pages"), queries.URL_RULES, again).groupBy("verdict").count().count() == 2


def test_held_out_words(spark):
    """Every fifth word of both lists is kept from training; README has the rates."""
    new = [[w for i, w in enumerate(words) if i % 5 == 4] for words in (url_filter.UNWANTED, url_filter.WANTED)]
    known = [[w for i, w in enumerate(words) if i % 5 != 4] for words in (url_filter.UNWANTED, url_filter.WANTED)]
    other = url_filter.train(url_filter.labelled(spark, *known))
    held_out = url_filter.labelled(spark, *new).withColumnRenamed("label", "page_id")
    rates = {
        (r["page_id"], r["verdict"]): r["count"]
        for r in url_filter.judge(held_out.where(F.col("url").rlike("|".join(new[0] + new[1]))), [], other).groupBy("page_id", "verdict").count().collect()
    }
    block = rates.get((1.0, "block"), 0) / (len(new[0]) * len(url_filter.TAILS))
    allow = rates.get((0.0, "allow"), 0) / (len(new[1]) * len(url_filter.TAILS))
    print(f"held-out words: {block:.2f} of the unwanted blocked, {allow:.2f} of the wanted allowed")
    assert block > 0.4 and allow > 0.7


def test_no_python_on_the_main_path(spark, model):
    plan = url_filter.judge(queries.table(spark, SF_DIR, "pages"), queries.URL_RULES, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
