"""Judging URLs by pattern rules that are indexed by their rarest literal token, with built-in expressions only.

A rule is a regular expression over a URL's address (lower-cased host, then path) together with literal tokens that
every address it matches has whole. Of these, the token that fewest URLs have becomes the rule's index entry. The
tokens of a URL fetch the rules indexed under them, and only the expressions of those rules run.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Indexes up to this many characters travel with the tasks; larger ones meet the tokens of the URLs in a join.
INDEX_CHARS = 8_000_000
#: Buckets of a travelling index for each token in it.
BUCKETS_A_TOKEN = 2
#: In that join, a token or address of more than one in so many rows is hot: there are few of them, and each is split over SALTS parts.
HOT_ONE_IN, SALTS = 1_000, 64

# Address rules (host, path, verdict), and further patterns (name, pattern, whole tokens of every match, verdict).
ADDRESS_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
PATTERN_RULES = [
    ("pill shop", r"^[^/]*cheap-pills\.", ["cheap", "pills"], "block"),
    ("link farm", r"^[^/]*(spam|link)-farm\.", ["farm"], "block"),
    ("casino", r"^([^/]*[.-])?casino[.-]", ["casino"], "block"),
    ("betting", r"^[^/]*\.(bet|poker|casino)(/|\z)", [], "block"),
    ("advert server", r"^(ads|adserver|doubleclick)\.", [], "block"),
    ("log-in page", r"/(wp-)?login\.(php|aspx?|html?)\z", ["login"], "block"),
    ("server script", r"/cgi-bin/", ["cgi", "bin"], "block"),
    ("shopping cart", r"/cart/checkout(/|\z)", ["cart", "checkout"], "block"),
    ("program file", r"\.(exe|msi|dmg|apk)\z", [], "block"),
    ("archive page", r"/tag/[^/]+/page/[0-9]+/?\z", ["tag", "page"], "block"),
    ("print view", r"/print/[0-9]+(\.html)?\z", ["print"], "block"),
]


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def with_address(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with host and path of the URL, both empty for null or where ``://`` is missing."""
    given = F.coalesce(F.col(url), F.lit(""))
    return pages.withColumns({"host": ascii_lower(F.regexp_extract(given, ADDRESS, 1)), "path": F.regexp_extract(given, ADDRESS, 2)})


def tokens(address: Column) -> Column:
    """Distinct tokens of an address; the empty one stands for rules without any."""
    return F.array_union(F.array(F.lit("")), F.split(ascii_lower(address), BREAKS))


def address_rule(host: str, path: str, verdict: str) -> tuple[int, str, str, str, list[str]]:
    """A rule for a host with its subdomains and for paths with this beginning; of those that fit, the longest wins."""
    closed = host + path.rpartition("/")[0]  # what follows the last slash may go on
    words = [w for w in re.split(BREAKS, closed.translate(str.maketrans(UPPER, LOWER))) if w]
    return len(host + path), host + path, verdict, rf"^([^/]*\.)?{re.escape(host)}{re.escape(path)}", words


def pattern_rule(name: str, pattern: str, words: list[str], verdict: str) -> tuple[int, str, str, str, list[str]]:
    """A rule by any expression; ``words`` are tokens that each address it matches has whole (none: it runs on every URL)."""
    return 0, name, verdict, pattern, words


def rule_table(spark: SparkSession, rules: Sequence[tuple[int, str, str, str, list[str]]]) -> DataFrame:
    """rank, name, verdict, pattern, words: of the rules that match, the highest rank wins, then the smallest name."""
    made = [F.struct(F.lit(r).alias("rank"), F.lit(n).alias("name"), F.lit(v).alias("verdict"), F.lit(p).alias("pattern"),
                     F.array(*[F.lit(w) for w in words]).cast("array<string>").alias("words")) for r, n, v, p, words in rules]
    return spark.range(1).select(F.inline(F.array(*made)))


def rare_tokens(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``rules`` with ``token``, the one of their words that fewest of all URLs have, and ``n``, how many have it."""
    wanted = rules.select(F.explode("words").alias("token")).distinct()
    seen = pages.select(F.explode(tokens(F.concat("host", "path"))).alias("token")).join(wanted, "token", "left_semi").groupBy("token").count()
    choice = rules.select("*", F.explode_outer("words").alias("token")).join(seen, "token", "left").select(
        "rank", "name", "verdict", "pattern", F.struct(F.coalesce("count", F.lit(0)).alias("n"), F.coalesce("token", F.lit("")).alias("token")).alias("choice"))
    return choice.groupBy("rank", "name", "verdict", "pattern").agg(F.min("choice").alias("choice")).select("rank", "name", "verdict", "pattern", "choice.*")


def winner() -> Column:
    """A rule as a value; of those that match, the least wins."""
    return F.struct((-F.col("rank")).alias("rank"), "name", "verdict", "pattern")


#: A travelling index: buckets by hash of the token, each with its tokens and their rules.
INDEX = "array<array<struct<token:string,rules:array<struct<rank:int,name:string,verdict:string,pattern:string>>>>>"


def travelling_index(rules: DataFrame, n_tokens: int) -> Column:
    """The index as one constant of bounded size."""
    spark, buckets = rules.sparkSession, max(1, BUCKETS_A_TOKEN * n_tokens)
    entries = rules.groupBy("token").agg(F.collect_list(winner()).alias("rules")).withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(buckets)))
    by_bucket = entries.groupBy("bucket").agg(F.collect_list(F.struct("token", "rules")).alias("entries"))
    full = spark.range(buckets).withColumnRenamed("id", "bucket").join(by_bucket, "bucket", "left")
    rows = F.array_sort(F.collect_list(F.struct("bucket", "entries")))
    text = full.agg(F.to_json(F.transform(rows, lambda r: F.coalesce(r["entries"], F.array())))).first()[0]
    return F.from_json(F.lit(text), INDEX)


def look_up(rows: DataFrame, index: Column, n_tokens: int) -> DataFrame:
    """``rows`` with the winning rule and the number of rules that ran, without moving any row."""
    address, buckets = F.concat("host", "path"), F.lit(max(1, BUCKETS_A_TOKEN * n_tokens))

    def fetched(token: Column) -> Column:
        bucket = F.get(index, F.pmod(F.xxhash64(token), buckets).cast("int"))
        return F.flatten(F.transform(F.filter(bucket, lambda e: e["token"] == token), lambda e: e["rules"]))

    rows = rows.withColumn("__candidates", F.flatten(F.transform(tokens(address), fetched)))
    best = F.array_min(F.filter("__candidates", lambda r: F.regexp_like(address, r["pattern"])))
    return rows.withColumns({"__best": best, "n_candidates": F.size("__candidates")}).drop("__candidates")


def meet(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """The same for rules of any number: tokens of the distinct addresses meet the rules in a join split at hot tokens."""
    distinct = materialize(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("__rows")), "addresses")
    address = F.concat("host", "path")
    # n counts every row of a token, so hot rules are those that many fetch
    hot = F.lit(distinct.agg(F.coalesce(F.sum("__rows"), F.lit(0))).first()[0] // HOT_ONE_IN)
    wide = rules.withColumn("salt", F.explode(F.when((F.col("n") > hot) | (F.col("token") == ""), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    hot_tokens = rules.where((F.col("n") > hot) | (F.col("token") == "")).select("token").distinct().withColumn("__hot", F.lit(True))
    asked = distinct.select("host", "path", F.explode(tokens(address)).alias("token"))
    # an address has few tokens, so at most some thousand tokens can be in one of a thousand rows
    asked = asked.join(F.broadcast(hot_tokens), "token", "left").withColumn("salt", F.when(F.col("__hot"), F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int")).otherwise(0))
    fetched = asked.join(wide, ["token", "salt"]).withColumn("__hit", F.when(F.regexp_like(address, F.col("pattern")), winner()))
    judged = materialize(distinct.join(fetched.groupBy("host", "path").agg(F.min("__hit").alias("__best"), F.count(F.lit(1)).cast("int").alias("n_candidates")), ["host", "path"], "left"), "judged-addresses")
    judged = judged.withColumn("n_candidates", F.coalesce("n_candidates", F.lit(0)))
    often = judged.where(F.col("__rows") > hot).drop("__rows")  # fewer than HOT_ONE_IN rows
    many, few = rows.join(F.broadcast(often), ["host", "path"]), rows.join(F.broadcast(often), ["host", "path"], "left_anti")
    return many.unionByName(few.join(judged.drop("__rows"), ["host", "path"]))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule, rank, verdict and n_candidates (the expressions that ran for the URL).

    ``rules`` as from :func:`rule_table`. Where no rule matches, rule and rank are null and the verdict is
    ``default``. A null URL and one without ``://`` have an empty host and path; very long URLs are read whole;
    repeated rows are judged alike; an empty table gives no rows, and without rules all get the default. Of matching
    rules the highest rank wins, then the smallest name, verdict and pattern. Input columns named like the added
    ones are replaced.

    Counting the tokens of the rules over all URLs is one combinable pass over the URL column. While the index is
    at most ``INDEX_CHARS`` characters (summed first), rows stay where they are and nothing is shuffled.
    """
    rows = with_address(pages.drop("host", "path", "rule", "rank", "verdict", "n_candidates", "__best", "__candidates"), url)
    rules = materialize(rare_tokens(rows.select("host", "path"), rules), "url-rules")
    size, n_tokens = rules.agg(F.coalesce(F.sum(F.length(F.concat("name", "verdict", "pattern", "token")) + 16), F.lit(0)), F.count_distinct("token")).first()
    judged = look_up(rows, travelling_index(rules, n_tokens), n_tokens) if size <= INDEX_CHARS else meet(rows, rules)
    return judged.withColumns({"rule": F.col("__best.name"), "rank": -F.col("__best.rank"), "verdict": F.coalesce("__best.verdict", F.lit(default))}).drop("__best")


def default_rules(spark: SparkSession) -> DataFrame:
    return rule_table(spark, [address_rule(*r) for r in ADDRESS_RULES] + [pattern_rule(*r) for r in PATTERN_RULES])


def keep_allowed(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """The rows of ``pages`` that no blocking rule wins, with their own columns (those named as :func:`judge_urls` adds included)."""
    judged = judge_urls(pages.select(F.struct("*").alias("__row"), F.col(url).alias("__url")), rules, "__url", default)
    return judged.where("verdict <> 'block'").select("__row.*")


def _oracle() -> str:
    longest = sorted(ADDRESS_RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for h, p, v in longest]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for c, n, _ in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits) + " END"
    pattern = "CASE " + " ".join(f"WHEN regexp_matches(host || path, '{p}') THEN '{n}'" for n, p, _, _ in sorted(PATTERN_RULES)) + " END"
    told = "CASE pattern " + " ".join(f"WHEN '{n}' THEN '{v}'" for n, _, _, v in PATTERN_RULES) + " END"
    return f"""
WITH cut AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{ADDRESS}', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(coalesce(url, ''), '{ADDRESS}', 2) AS path FROM pages),
judged AS (SELECT page_id, host, path, {rule} AS rule, {verdict} AS ruled, {pattern} AS pattern FROM cut)
SELECT page_id, host, path, rule, coalesce(ruled, {told}, 'allow') AS verdict, CASE WHEN rule IS NULL THEN pattern END AS pattern FROM judged"""


ORACLE_SQL = _oracle()
