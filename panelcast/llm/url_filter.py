"""URL verdicts from pattern rules indexed by their rarest literal token.

Every rule has literal tokens that a fitting URL must contain. The tokens are
counted over all URLs, each rule is filed under its rarest one, a URL fetches
the rules of its own tokens, and only those run their regular expression.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import ascii_lower

MAX_RULES = 100_000


@dataclass(frozen=True)
class Rule:
    """A regular expression over ``host + path`` (site rules) or the lower-cased URL."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    site: bool


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and all its subdomains where the path starts with ``path``."""
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
    # a token at the very end of the path may go on in the URL, so it is none
    tokens = re.findall(r"[a-z0-9]+", host.lower()) + re.findall(r"[a-z0-9]+(?=[^a-z0-9])", path.lower())
    return Rule(host + path, verdict, pattern, tuple(tokens), True)


def word_rule(verdict: str, word: str) -> Rule:
    """Fits a URL that has ``word`` between signs; a hyphen in it stands for itself."""
    return Rule(word, verdict, rf"(?:^|[^a-z0-9]){re.escape(word)}(?:[^a-z0-9]|$)",
                tuple(re.findall(r"[a-z0-9]+", word)), False)


#: The contract's rules (fixed values).
SITE_RULES = (
    site_rule("allow", "com", "/"),
    site_rule("block", "example.com", "/en/"),
    site_rule("allow", "www.example.com", "/en/"),
    site_rule("block", "net", "/es/"),
    site_rule("block", "net", "/fr/"),
)

#: The method's own: parts of URLs that lead to no running text, or to spam.
WORD_RULES = tuple(word_rule("block", w) for w in (
    "adserver", "doubleclick", "ads", "banner", "casino", "cart", "checkout", "login", "signin", "signup",
    "logout", "poker", "porn", "torrent", "viagra", "wp-admin", "wp-login", "xxx"))


def rule_index(urls: DataFrame, rules) -> list[tuple]:
    """(token, name, verdict, pattern, site) per rule, under its rarest token.

    ``urls`` has an array column ``tokens``; all rows are counted. The counts
    are one row per rule token at most. A rule without a token stands under the
    empty one, which every URL looks up.
    """
    known = sorted({t for r in rules for t in r.tokens})
    if len(rules) > MAX_RULES:
        wanted = urls.sparkSession.createDataFrame([(t,) for t in known], "t string")
        hits = urls.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count("*").alias("n")).join(wanted, "t")
    else:
        hits = urls.select(F.explode(F.array_intersect("tokens", F.array(*map(F.lit, known)).cast("array<string>"))).alias("t")) \
                   .groupBy("t").agg(F.count("*").alias("n"))
    times = {r["t"]: r["n"] for r in hits.collect()}
    return [(min(r.tokens, key=lambda t: (times.get(t, 0), t), default=""), r.name, r.verdict, r.pattern, r.site) for r in rules]


def url_verdicts(pages: DataFrame, rules=SITE_RULES + WORD_RULES, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict, pattern_rule for every page.

    ``rule`` is the longest fitting site rule (of equal lengths the first by
    name), or null; then the verdict comes from the other rules: the longest
    fitting one, named in ``pattern_rule``, or ``default``. A null URL or one
    without ``://`` has empty host and path and fits no site rule. Repeated
    rows get equal rows; an empty table gives an empty result; columns other
    than page_id and url are ignored; a null page_id keeps its row. URLs are
    judged once each: equal URLs are combined before the shuffle. Up to
    MAX_RULES rules are broadcast, more are joined by token. A rule without a
    literal token is tried on every URL.
    """
    spark = pages.sparkSession
    url = F.coalesce(F.col("url"), F.lit(""))
    rest = F.when(url.contains("://"), F.substring_index(F.expr("substring(coalesce(url, ''), locate('://', coalesce(url, '')) + 3)"), "#", 1)).otherwise(F.lit(""))
    out = (pages.select("page_id", url.alias("url"), rest.alias("rest"))
           .select("page_id", "url", ascii_lower(F.regexp_extract("rest", r"^([^/?]*)", 1)).alias("host"),
                   F.regexp_extract("rest", r"^[^/?]*([^?]*)", 1).alias("path")))
    distinct = (out.select("url", "host", "path").distinct()
                .withColumn("low", ascii_lower(F.col("url")))
                .withColumn("tokens", F.array_distinct(F.regexp_extract_all("low", F.lit("[a-z0-9]+"), F.lit(0)))))
    index = spark.createDataFrame(rule_index(distinct, rules),
                                  "token string, name string, verdict string, pattern string, site boolean")
    tokens = F.col("tokens") if all(r.tokens for r in rules) else F.array_union("tokens", F.array(F.lit("")))
    index = F.broadcast(index) if len(rules) <= MAX_RULES else index
    found = (distinct.select("url", "host", "path", "low", F.explode(tokens).alias("token"))
             .join(index, "token")
             .where(F.regexp(F.when(F.col("site"), F.concat("host", "path")).otherwise(F.col("low")), F.col("pattern"))))
    rank = F.struct((-F.length("name")).alias("n"), F.col("name"), F.col("verdict"))
    best = found.groupBy("url").agg(F.min(F.when(F.col("site"), rank)).alias("s"),
                                    F.min(F.when(~F.col("site"), rank)).alias("w"))
    return (out.join(best, "url", "left")
            .select("page_id", "host", "path", F.col("s.name").alias("rule"),
                    F.coalesce("s.verdict", "w.verdict", F.lit(default)).alias("verdict"),
                    F.when(F.col("s").isNull(), F.col("w.name")).alias("pattern_rule")))


def verdict_sql(rules=SITE_RULES + WORD_RULES, default: str = "allow") -> str:
    """The same verdicts as DuckDB SQL over ``pages``."""
    def text(x):
        return "'" + x.replace("'", "''") + "'"

    site = sorted((r for r in rules if r.site), key=lambda r: (-len(r.name), r.name))
    word = sorted((r for r in rules if not r.site), key=lambda r: (-len(r.name), r.name))

    def case(rs, subject, value):
        return "CASE " + " ".join(
            f"WHEN regexp_matches({subject}, {text(r.pattern)}) THEN {text(value(r))}" for r in rs) + " END"

    ascii_low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url,
                  CASE WHEN instr(coalesce(url, ''), '://') > 0
                       THEN split_part(substr(url, instr(url, '://') + 3), '#', 1) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, {ascii_low.format('url')} AS low,
             {ascii_low.format("regexp_extract(rest, '^([^/?]*)', 1)")} AS host,
             regexp_extract(rest, '^[^/?]*([^?]*)', 1) AS path FROM u),
r AS (SELECT *, {case(site, 'host || path', lambda r: r.name)} AS rule,
             {case(site, 'host || path', lambda r: r.verdict)} AS sv,
             {case(word, 'low', lambda r: r.name)} AS wn, {case(word, 'low', lambda r: r.verdict)} AS wv FROM h)
SELECT page_id, host, path, rule, coalesce(sv, wv, {text(default)}) AS verdict,
       CASE WHEN rule IS NULL THEN wn END AS pattern_rule FROM r"""
