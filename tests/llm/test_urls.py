"""URL rules against DuckDB and a plain loop over all rules."""

import random
import re

import pytest

import __spark_entry__ as entry
from millrace.llm import urls

PAGES = "page_id long, url string"
ODD = [
    (1, "http://a.example.org/es/1"), (2, "HTTP://A.EXAMPLE.ORG/ES/1"), (3, "http://example.org/en/1"), (4, "http://example.org/en/123?q#f"), (5, "http://notexample.org/en/1"),
    (6, "http://x.com/de/"), (7, "http://com/fr/x"), (8, "http://x.net/cart/checkout"), (9, None), (10, ""), (11, "no scheme/here"), (12, "http://"), (13, "http:///x/"),
    (14, "http://user@b.org:80/x"), (15, "a://b.org?x://c.com/de/"), (16, "x http://cheap-pills.net/"), (17, "http://bücher.example.org/es/ü"), (18, "http://a.net/" + "long/" * 50_000 + "wp-login.php"),
    (19, "http://casino.net/tag/x/page/2"), (20, "http://a.com/de#/fr/"), (20, "http://a.com/de#/fr/"), (None, "http://b.org/\n"),
]


def plain(url, rules):
    found = re.match(urls.ADDRESS, url or "")
    host, path = (found[1].translate(str.maketrans(urls.UPPER, urls.LOWER)), found[2]) if found else ("", "")
    hits = [(-r, n, v) for r, n, v, p, _ in rules if re.search(p.replace(r"\z", r"\Z"), host + path)]
    best = min(hits, default=(None, None, "allow"))
    return host, path, best[1], best[2]


RULES = [urls.address_rule(*r) for r in urls.ADDRESS_RULES] + [urls.pattern_rule(*r) for r in urls.PATTERN_RULES]


@pytest.fixture(params=["travelling", "joined"])
def index(request, monkeypatch):
    if request.param == "joined":
        monkeypatch.setattr(urls, "INDEX_CHARS", -1)
        monkeypatch.setattr(urls, "HOT_ONE_IN", 5)


def check(spark, rows, rules):
    made = urls.judge_urls(spark.createDataFrame(rows, PAGES), urls.rule_table(spark, rules)).collect()
    want = sorted(((i, u, *plain(u, rules)) for i, u in rows), key=str)
    assert sorted(((r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in made), key=str) == want
    return made


def test_odd_urls(spark, index):
    check(spark, ODD, RULES)


def test_many_rules_against_a_loop(spark, index):
    rng = random.Random(5)
    words = ["ab", "cd", "ef", "gh", "ij"]
    some = lambda n, by: by.join(rng.choice(words) for _ in range(n))
    rules = list({r[1]: r for r in (urls.address_rule(some(rng.randint(1, 2), "."), "/" + some(rng.randint(0, 2), "/"), rng.choice(["allow", "block"])) for _ in range(60))}.values())
    rows = [(i, f"http://{some(rng.randint(1, 3), '.')}/{some(rng.randint(0, 4), '/')}") for i in range(400)] + [(i, "http://ab.cd/ef") for i in range(200)]
    made = check(spark, rows, rules)
    assert sum(r.n_candidates for r in made) < len(rules) * len(rows)  # the index leaves rules out


def test_rarest_token_is_the_index_entry(spark):
    pages = urls.with_address(spark.createDataFrame([(i, f"http://a{i}.example.org/{'rare' if i == 3 else 'often'}/") for i in range(9)], PAGES))
    rules = urls.rule_table(spark, [urls.pattern_rule("both", "x", ["often", "rare"], "block"), urls.pattern_rule("none", "x", [], "block"), urls.pattern_rule("unseen", "x", ["often", "never"], "block")])
    assert {r.name: (r.token, r.n) for r in urls.rare_tokens(pages, rules).collect()} == {"both": ("rare", 1), "none": ("", 0), "unseen": ("never", 0)}


def test_no_pages_no_rules_and_clashing_names(spark, index):
    rules = urls.rule_table(spark, RULES)
    clash = spark.createDataFrame([(1, "http://x.com/de/", "h", "p", "k")], "page_id long, url string, host string, rank string, kept string")
    assert urls.judge_urls(clash.where("false"), rules).count() == 0
    row = urls.judge_urls(clash, rules).first()
    assert (row.host, row.rule, row.verdict, row.kept) == ("x.com", "com/de/", "block", "k")
    assert urls.judge_urls(clash, rules.where("false")).first().verdict == "allow"
    assert urls.keep_allowed(clash, rules).count() == 0
    assert urls.keep_allowed(clash.withColumn("url", urls.F.lit("http://x.com/fr/")), rules).first().host == "h"


def test_query_is_native_and_moves_no_page(spark):
    plan = entry.queries()["op11_url_filter"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop", "ExistingRDD"))
    main = plan[plan.index("== Physical Plan =="):].split("Subqueries")[0]
    assert "Exchange" not in main.split("Subquery")[0]
