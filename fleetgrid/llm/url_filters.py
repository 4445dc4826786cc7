r"""URL rules found through their rarest literal token.

Every rule becomes a regular expression over host and path.  Its literal
tokens are the alphanumeric runs that any fitting url must contain whole; the
one that is rarest among the urls at hand becomes the rule's index key.  A
url's tokens fetch candidate rules by an equi-join, and only those candidates
run their expression.  A rule without a literal token is keyed by the empty
token, which every url has.

Urls are judged once each, so a url that makes up a third of all rows costs
one judgement, and the rows are matched with their judgement by a join that
the engine may split.

Defined cases: null urls and urls without ``://`` have empty host and path and
match only rules that fit those; equal lengths are decided by the rule's text;
no rule gives ``default``; other columns are never looked at; no rules or no
urls are fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .tables import ascii_lower, table

RULE_SCHEMA = "host string, path string, verdict string"
SEPARATORS = "[^A-Za-z0-9]+"


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1)


def quoted(literal: Column) -> Column:
    """The literal as a regular expression."""
    return F.regexp_replace(literal, r"([^A-Za-z0-9/])", r"\\$1")


def rule_patterns(rules: DataFrame) -> DataFrame:
    """rule, verdict, length, pattern and the literal tokens of each rule."""
    host, path = F.coalesce("host", F.lit("")), F.coalesce("path", F.lit(""))
    subdomain = F.when(host == "", F.lit("^[^/]*")).otherwise(F.lit(r"^(?:[^/]*\.)?"))
    # what follows the last separator may go on in the url, so it is no token
    whole = F.regexp_replace(F.concat(host, path), "[A-Za-z0-9]+$", "")
    whole = F.when(path == "", F.concat(host, F.lit(" "))).otherwise(whole)
    return rules.select(
        F.concat(host, path).alias("rule"), "verdict", F.char_length(F.concat(host, path)).alias("length"),
        F.concat(subdomain, quoted(host), F.when(path == "", F.lit("(?:/|$)")).otherwise(quoted(path))).alias("pattern"),
        F.array_remove(F.array_distinct(F.split(whole, SEPARATORS)), "").alias("tokens"))


def url_tokens(urls: DataFrame) -> DataFrame:
    """url, subject and one row per distinct token of host and path, the empty token included."""
    subject = F.concat(host_of(F.col("url")), path_of(F.col("url")))
    return urls.select("url", subject.alias("subject")).select(
        "url", "subject", F.explode(F.array_union(F.split("subject", SEPARATORS), F.array(F.lit("")))).alias("token"))


def rule_index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Each rule once, keyed by its rarest token among ``urls``."""
    patterns = rule_patterns(rules)
    wanted = patterns.select(F.explode("tokens").alias("token")).distinct()
    seen = url_tokens(urls).join(wanted, "token").groupBy("token").agg(F.count("*").alias("uses"))
    ranked = patterns.withColumn("token", F.explode_outer("tokens")).join(seen, "token", "left")
    chosen = F.min(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), F.coalesce("token", F.lit("")).alias("token")))
    return ranked.groupBy("rule", "verdict", "length", "pattern").agg(chosen.alias("best")).select(
        "rule", "verdict", "length", "pattern", F.col("best.token").alias("token"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict for every row of ``pages``; the longest fitting rule wins."""
    urls = pages.select(F.coalesce("url", F.lit("")).alias("url")).distinct()
    candidates = url_tokens(urls).join(rule_index(rules, urls), "token")
    fitting = candidates.filter(F.expr("subject RLIKE pattern"))
    best = fitting.groupBy("url").agg(F.max(F.struct("length", "rule", "verdict")).alias("best"))
    judged = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url")).join(best, "url", "left")
    return judged.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


#: The rules of the registered query, longest match first or not: order plays no part.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def judged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, RULE_SCHEMA))


SQL = r"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages
), rules(h, p, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits AS (
  SELECT page_id, host, path, h || p AS rule, rules.verdict AS verdict,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(h || p) DESC, h || p DESC) AS place
  FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
"""
