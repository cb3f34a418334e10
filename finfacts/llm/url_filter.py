"""URL filters: pattern rules indexed by their rarest literal token.

Only DataFrame functions. A rule names whole literal tokens that every matching URL
holds; it is filed under the one that the fewest URLs hold. The tokens of the distinct
URLs fetch the candidate rules by an equi-join, only those run their regular
expression, and the first rule by rank wins. Rules are a list or a table of any size, read
from lines of text with hosts, paths and wildcards; Spark picks every join.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from finfacts.llm.common import stored, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class UrlRule(NamedTuple):
    """``pattern`` is searched in host + path; every match holds all of ``tokens`` as whole tokens.

    The rule with the highest ``rank`` wins, ties by name. ``named`` rules show in the
    result by their name, others only by their verdict.
    """

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int
    named: bool


def domain_rule(verdict: str, host: str, path: str) -> UrlRule:
    """A rule for a host, its subdomains and the paths that start with ``path``; longest wins."""
    text = host + path
    whole = path if path.endswith("/") else path.rpartition("/")[0]
    tokens = tuple(t for t in re.split(r"[^a-z0-9]+", f"{host}/{whole}".lower()) if t)
    if not tokens:
        raise ValueError(f"the rule {text!r} has no literal token")
    return UrlRule(text, verdict, rf"^(?:[^/]*\.)?{_literal(text)}", tokens, 1000 + len(text), True)


def token_rule(verdict: str, *tokens: str) -> UrlRule:
    """A rule for hosts with a label that holds these tokens joined by dashes."""
    text = "-".join(tokens)
    return UrlRule(text, verdict, rf"^(?:[^/]*[^/a-z0-9])?{_literal(text)}(?:[^/a-z0-9]|/|$)",
                   tokens, len(tokens), False)


def _literal(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


# The rules that the query judges by, in order.
DOMAIN_RULES = (
    domain_rule("block", "net", "/"),
    domain_rule("allow", "example.net", "/en/"),
    domain_rule("block", "example.com", "/de/"),
    domain_rule("allow", "org", "/fr/"),
)

# Host labels of unwanted sites.
LABEL_RULES = (
    token_rule("block", "casino"),
    token_rule("block", "casino", "win"),
    token_rule("block", "spam"),
    token_rule("block", "spam", "farm"),
    token_rule("block", "free", "bets"),
    token_rule("block", "adult"),
    token_rule("block", "adult", "x"),
    token_rule("block", "porn"),
    token_rule("block", "xxx"),
    token_rule("block", "viagra"),
    token_rule("block", "malware"),
    token_rule("block", "phishing"),
)

RULES = (*DOMAIN_RULES, *LABEL_RULES)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty without ``://`` or for null."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _tokens(text: Column) -> Column:
    lowered = F.translate(text, UPPER, LOWER)
    return F.array_distinct(F.filter(F.split(lowered, "[^a-z0-9]+"), lambda t: t != ""))


RULE_FIELDS = "name string, verdict string, pattern string, tokens array<string>, rank int, named boolean"


def rules_table(spark: SparkSession, rules: Sequence[UrlRule]) -> DataFrame:
    """Listed rules as a table."""
    return spark.createDataFrame([(*r[:3], list(r.tokens), *r[4:]) for r in rules], RULE_FIELDS)


def read_rules(lines: DataFrame, column: str = "value") -> DataFrame:
    """A table of rules out of lines like ``block ads.example.com/banner/*.gif``.

    A line is a verdict, white space, a host and, from the first slash on, a path; a rule fits
    its host and all subdomains, and paths that start with its own (all without one). ``*`` stands for
    anything, in a host for anything but a slash. Longer rules win, each counted in its code
    points. Empty lines and those that begin with ``#`` are left out. Hosts are matched in
    lower case. A line of another form, or one in which no whole word is literal, is an error.
    """
    line = F.trim(F.regexp_replace(F.col(f"`{column}`"), r"\s+", " "))
    parts = lines.filter((line != "") & ~F.startswith(line, F.lit("#"))).select(
        line.alias("line"), F.split(line, " ").alias("p"))
    named = parts.select("line", F.col("p")[0].alias("verdict"), F.get("p", F.lit(1)).alias("given"),
                         F.size("p").alias("n"))
    split = named.select(
        "line", "verdict", "n", F.translate(F.regexp_extract("given", "^([^/]*)", 1), UPPER, LOWER).alias("host"),
        F.regexp_extract("given", "^[^/]*(.*)$", 1).alias("path"))
    name = F.concat("host", "path")
    literal = lambda text: F.regexp_replace(text, r"([\\.\[\]{}()+?^$|-])", r"\\$1")
    pattern = F.concat(
        F.lit(r"(?s)^(?:[^/]*\.)?"), F.replace(literal(F.col("host")), F.lit("*"), F.lit("[^/]*")),
        F.when(F.col("path") == "", F.lit("(?:/|$)")).otherwise(
            F.replace(literal(F.col("path")), F.lit("*"), F.lit(".*"))))
    # The last word of a path may go on in the URL, and words beside a wildcard may too.
    whole = F.when(F.endswith("path", F.lit("/")), F.col("path")).otherwise(
        F.regexp_extract("path", "^(.*/)", 1))
    words = F.split(F.translate(F.concat("host", F.lit("/"), whole), UPPER, LOWER), "[^a-z0-9*]+")
    tokens = F.array_distinct(F.filter(words, lambda t: (t != "") & ~F.contains(t, F.lit("*"))))
    fits = (F.col("n") == 2) & F.col("verdict").isin("allow", "block") & (F.size(tokens) > 0)
    checked = split.filter(F.when(fits, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("no URL rule: "), "line")).cast("boolean")))
    return checked.select(
        name.alias("name"), "verdict", pattern.alias("pattern"), tokens.alias("tokens"),
        (F.lit(1000) + F.length(name)).cast("int").alias("rank"), F.lit(True).alias("named"))


def _indexed(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Every rule under its token that the fewest URLs hold, ties by the token."""
    counts = tokens.groupBy("token").agg(F.count("*").alias("n"))
    held = rules.select("*", F.explode("tokens").alias("token")).join(counts, "token", "left")
    fields = [c for c in rules.columns if c != "tokens"]
    # Equal rules are one.
    return held.groupBy(*fields).agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)), "token")).getField("token").alias("token"))


def judge_urls(
    pages: DataFrame, rules: Sequence[UrlRule] | DataFrame = RULES, default: str = "allow", url: str = "url"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` is a list, or a table as of ``read_rules``; of two rules with one rank the later
    name wins, then the later verdict. ``rule`` is null where no named rule fits. A null, empty or malformed URL has an
    empty host and path and gets the default verdict, equal URLs the same verdict.
    Input columns with the names of the four results are replaced. The tokens of URLs that
    any rule asks for are stored once.
    """
    given = rules if isinstance(rules, DataFrame) else rules_table(pages.sparkSession, rules)
    added = ("host", "path", "rule", "verdict")
    host, path = url_parts(F.col(f"`{url}`"))
    split = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"),
        host.alias("host"), path.alias("path"),
    )
    places = split.select("host", "path").distinct()
    tokens = places.select(
        "host", "path", F.explode(_tokens(F.concat("host", F.lit("/"), "path"))).alias("token")
    )
    wanted = given.select(F.explode("tokens").alias("token")).distinct()
    tokens = stored(tokens.join(wanted, "token", "left_semi"))
    index = _indexed(given, tokens)
    fits = tokens.join(index, "token").filter(F.expr("concat(host, path) rlike pattern"))
    best = fits.groupBy("host", "path").agg(
        F.max_by(F.struct("name", "verdict", "named"), F.struct("rank", "name", "verdict")).alias("best")
    )
    judged = split.join(best, ["host", "path"], "left")
    kept = [F.col("row").getField(c).alias(c) for c in pages.columns if c not in added]
    return judged.select(
        *kept, "host", "path",
        F.when(F.col("best.named"), F.col("best.name")).alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), RULES) \
        .select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3)
    ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), ruled AS (
  SELECT *, CASE
    WHEN starts_with(path, '/de/') AND (host = 'example.com' OR host LIKE '%.example.com')
      THEN 'example.com/de/'
    WHEN starts_with(path, '/en/') AND (host = 'example.net' OR host LIKE '%.example.net')
      THEN 'example.net/en/'
    WHEN starts_with(path, '/fr/') AND (host = 'org' OR host LIKE '%.org') THEN 'org/fr/'
    WHEN starts_with(path, '/') AND (host = 'net' OR host LIKE '%.net') THEN 'net/'
    END AS rule FROM parts
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN regexp_matches(host, '(^|[^a-z0-9])(casino|spam|free-bets|adult|porn|xxx|viagra|malware|phishing)([^a-z0-9]|$)')
    THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
