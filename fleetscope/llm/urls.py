"""URL filters: pattern rules indexed by their rarest literal token (native).

A rule is a pattern. From its text come a regular expression and the literal
tokens (runs of A-Z, a-z, 0-9) that any fitting URL must hold as whole
tokens. Each rule is filed under the one of its tokens that is rarest in the
URLs at hand. The tokens of a URL fetch candidate rules by an equi-join, and
only those candidates run their regular expression. Rules without a whole
token are candidates for every URL.

Everything is DataFrame and SQL functions. Work grows with the number of
distinct URLs and their fetched candidates; a URL that makes up a third of
the rows is judged once. The rules are a list given by the caller: below
``BROADCAST_RULE_BYTES`` their index is broadcast, beyond it the join
shuffles and Spark splits hot tokens.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm.common import ascii_lower

#: Size of the rule texts up to which the index may be broadcast.
BROADCAST_RULE_BYTES = 4 << 20


@dataclass(frozen=True)
class UrlRule:
    """One rule. ``host_rule``: ``host/path`` that fits the host and all its
    subdomains and any path starting with the path; the longest one wins.
    Otherwise a pattern: literal text, ``*`` for any run of characters, ``^``
    for one separator or the end, a leading ``||`` for the start of the host
    or of one of its labels."""

    text: str
    verdict: str
    host_rule: bool = False

    @property
    def regex(self) -> str:
        if self.host_rule:
            return r"(?s)^(?:[^/?#]*\.)?" + re.escape(self.text)
        body = self.text.removeprefix("||")
        parts = {"*": ".*", "^": "(?:[^A-Za-z0-9_.%-]|$)"}
        inner = "".join(parts.get(c) or re.escape(c) for c in body)
        return r"(?s)^(?:[^/?#]*\.)?" + inner if self.text.startswith("||") else "(?s)" + inner

    @property
    def tokens(self) -> list[str]:
        """Lower-cased literal tokens that a fitting URL holds as whole tokens:
        bounded on both sides by a literal non-token character, a separator
        ``^`` or the start anchor."""
        anchored = self.host_rule or self.text.startswith("||")
        body = self.text if self.host_rule else self.text.removeprefix("||")
        found = set()
        for m in re.finditer(r"[A-Za-z0-9]+", body):
            left = body[m.start() - 1] if m.start() else ("." if anchored else "*")
            right = body[m.end()] if m.end() < len(body) else "*"
            if "*" not in (left, right):
                found.add(m[0].lower())
        return sorted(found)


#: The host rules of the production filter.
HOST_RULES = (
    UrlRule("org/", "allow", True),
    UrlRule("example.org/es/", "block", True),
    UrlRule("example.org/en/1", "block", True),
    UrlRule("com/fr/", "allow", True),
    UrlRule("com/de/", "block", True),
)
#: The pattern rules of the production filter: advertising and tracking hosts,
#: log-in and shopping pages, calendars and session links that trap crawlers.
PATTERN_RULES = (
    UrlRule("||ads.", "block"),
    UrlRule("||adserver.", "block"),
    UrlRule("||track.", "block"),
    UrlRule("||metrics.", "block"),
    UrlRule("/wp-login.php^", "block"),
    UrlRule("/wp-admin/", "block"),
    UrlRule("/cgi-bin/", "block"),
    UrlRule("/signin^", "block"),
    UrlRule("/login^", "block"),
    UrlRule("/logout^", "block"),
    UrlRule("/cart^", "block"),
    UrlRule("/checkout/", "block"),
    UrlRule("/calendar/*/day/", "block"),
    UrlRule("?sessionid=", "block"),
    UrlRule("&sessionid=", "block"),
    UrlRule("?replytocom=", "block"),
    UrlRule("utm_source=feed*utm_campaign=ads", "block"),
    UrlRule("/help/login^", "allow"),
)


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path, and host + all that follows it; empty for
    a null url or one without ``://``."""
    rest = F.when(F.contains(url, F.lit("://")),
                  F.substr(url, F.locate("://", url) + F.lit(3))).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    tail = F.regexp_extract(rest, r"(?s)^[^/?#]*(.*)$", 1)
    return host, path, F.concat(host, tail)


def _table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """The rules as rows, not as literals of the plan: a list of 80,000 is a table like any other."""
    return spark.createDataFrame(rows, schema)


def judge_urls(df: DataFrame, host_rules=HOST_RULES, patterns=PATTERN_RULES,
               default: str = "allow", url: str = "url") -> DataFrame:
    """Judge every row of ``df`` by its url; ``df`` keeps its rows and columns.

    Adds ``host``, ``path``, ``rule`` (text of the longest host rule that fits,
    ties: the smallest text; null if none), ``verdict`` (of that rule; else
    ``allow`` if an allowing pattern fits, else ``block`` if a blocking one
    does, else ``default``) and ``pattern`` (the pattern that decided, smallest
    text first; null if none). Columns of ``df`` with these names are replaced.
    A null url, or one without ``://``, has empty parts and the default. Empty
    tables give empty results; repeated rows are judged alike and all kept.
    """
    spark = df.sparkSession
    host, path, target = url_parts(F.col(url))
    added = ("host", "path", "rule", "verdict", "pattern")
    keep = [c for c in df.columns if c not in added]
    rows = df.select(*[F.col(c) for c in keep], host.alias("host"), path.alias("path"),
                     F.coalesce(target, F.lit("")).alias("__target"))
    rules = [*host_rules, *patterns]
    if not rules:
        return rows.drop("__target").select(
            "*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"),
            F.lit(None).cast("string").alias("pattern"))
    urls = rows.select("__target").where("__target != ''").distinct()
    tokens = urls.select("__target", F.explode(F.array_distinct(F.array_remove(
        F.split(ascii_lower(F.col("__target")), "[^a-z0-9]+"), ""))).alias("token"))

    table = _table(spark, [(i, r.text, r.verdict, r.host_rule, r.regex) for i, r in enumerate(rules)],
                   "id int, text string, verdict string, host_rule boolean, regex string")
    pairs = [(i, t) for i, r in enumerate(rules) for t in r.tokens]
    found = []
    if pairs:
        small = sum(len(r.regex) + len(r.text) for r in rules) <= BROADCAST_RULE_BYTES
        hint = F.broadcast if small else (lambda x: x)
        wanted = _table(spark, pairs, "id int, token string")
        counts = (tokens.join(hint(wanted.select("token").distinct()), "token", "left_semi")
                  .groupBy("token").agg(F.count("*").alias("n")))
        rarest = (wanted.join(hint(counts) if small else counts, "token", "left")
                  .groupBy("id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"),
                                                    "token")).alias("best"))
                  .select("id", F.col("best.token").alias("token")))
        index = table.join(hint(rarest), "id")
        found.append(tokens.join(hint(index), "token").drop("token"))
    if bare := [i for i, r in enumerate(rules) if not r.tokens]:
        # no whole token: the regular expression is tried on every URL
        fields = ("id", "text", "verdict", "host_rule", "regex")
        rest = F.array(*[F.struct(*[F.lit(v).alias(f) for f, v in zip(
            fields, (i, rules[i].text, rules[i].verdict, rules[i].host_rule, rules[i].regex))])
            for i in bare])
        found.append(urls.select("__target", F.inline(rest)))
    candidates = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    fits = candidates.where(F.expr("rlike(__target, regex)"))
    pattern = lambda v: F.min(F.when(~F.col("host_rule") & (F.col("verdict") == v), F.col("text")))
    judged = fits.groupBy("__target").agg(
        F.min(F.when(F.col("host_rule"), F.struct((-F.length("text")).alias("n"), "text",
                                                  "verdict"))).alias("best"),
        pattern("allow").alias("allowing"), pattern("block").alias("blocking"))
    method = (F.when(F.col("allowing").isNotNull(), "allow")
              .when(F.col("blocking").isNotNull(), "block").otherwise(default))
    return rows.join(judged, "__target", "left").select(
        *keep, "host", "path", F.col("best.text").alias("rule"),
        F.coalesce(F.col("best.verdict"), method).alias("verdict"),
        F.when(F.col("best").isNull(), F.coalesce("allowing", "blocking")).alias("pattern"))
