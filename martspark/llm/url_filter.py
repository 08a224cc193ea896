"""URL filters: pattern rules behind an index on their rarest literal token.

A rule is a pattern over ``host + path``.  Its literal tokens are the
alphanumeric runs that any matching URL must contain as whole tokens; it is
indexed under the one that fewest URLs of the corpus contain.  A URL's tokens
fetch its candidate rules, and only those run their regular expressions.
Each distinct (host, path) is judged once.

Pattern language: ``||host`` anchors at the host or one of its subdomains,
``|`` at the start; ``*`` is any text, ``^`` a separator or an end; everything
else is literal.  A rule with ``rank`` wins over those with a lower rank;
rules of equal rank: block wins.

The rules are a parameter: a list, or lines of a filter list (``parse_rules``: ``!`` opens
a comment, ``@@`` an exception, which wins over blocks; options after ``$`` that
name page types or parties are not judged here, and rules that need them are
left out).  Up to ``BROADCAST_RULES`` of them are broadcast, more are joined by shuffle.

Defined cases: a null URL or one without ``://`` has an empty host and path
and is judged as such; repeated rows are all returned; a URL that no rule
matches gets the default verdict; an empty table gives an empty result; other
columns are kept.
"""

from __future__ import annotations

import re
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martspark.llm.common import table

#: Rules whose index is broadcast (under 1 kB each, so under 100 MB).
BROADCAST_RULES = 100_000

# The rules of the query's contract, (verdict, rule).
SITE_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]

#: Patterns of the default list: gambling, pharma, spam and tracking sites.
SPAM_PATTERNS = [
    "^casino-win^", "^casino^", "^free-bets^", "^bets^", "^poker^",
    "^cheap-pills^", "^pills^", "^pharmacy^", "^viagra^",
    "^spam-farm^", "^link-farm^",
    "^ads-track^", "||ads.", "||track.", "||tracker.", "/ads/*", "^adserver^",
    "^adult^", "^xxx^", "^porn^",
]


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str
    verdict: str
    rank: int = 0

    def regex(self) -> str:
        p, head = self.pattern, ""
        if p.startswith("||"):
            p, head = p[2:], r"^(?:[^/]*\.)?"
        elif p.startswith("|"):
            p, head = p[1:], "^"
        special = {"*": "(?s:.*)", "^": r"(?:[^A-Za-z0-9]|^|$)"}
        return head + "".join(special.get(c) or re.escape(c) for c in p)

    def tokens(self) -> list[str]:
        """Alphanumeric runs with a literal separator or an anchor on both sides."""
        p = self.pattern
        anchored = p.startswith("|")
        p = p.lstrip("|")
        found = []
        for m in re.finditer(r"[A-Za-z0-9]+", p):
            left = anchored if m.start() == 0 else p[m.start() - 1] != "*"
            right = m.end() < len(p) and p[m.end()] != "*"
            if left and right:
                found.append(m[0])
        return found


def parse_rules(lines: list[str], rank: int = 0) -> list[Rule]:
    """Rules of a filter list, one per line; blank lines, comments and element rules
    (``##``) are no URL rules."""
    rules = []
    for line in lines:
        text = line.strip()
        if not text or text[0] in "![" or "##" in text or "#@#" in text:
            continue
        allow = text.startswith("@@")
        pattern, _, options = text.removeprefix("@@").partition("$")
        if pattern and not options:
            rules.append(Rule(text, pattern, "allow" if allow else "block", rank + allow))
    return rules


def read_rules(spark: SparkSession, path: str) -> list[Rule]:
    """The rules of a filter-list file in any store that Spark reads."""
    return parse_rules([r.value for r in spark.read.text(path).collect()])


def site_rules() -> list[Rule]:
    """The contract's rules: the longest that fits decides."""
    return [Rule(r, f"||{r}", v, len(r)) for v, r in SITE_RULES]


def spam_rules() -> list[Rule]:
    return [Rule(p, p, "block") for p in SPAM_PATTERNS]


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both '' without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def _tokens(target: Column) -> Column:
    return F.array_distinct(F.filter(F.split(target, "[^A-Za-z0-9]+"), lambda t: t != ""))


def _index(targets: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rules under their rarest token in ``targets`` ('' if they have none)."""
    spark = targets.sparkSession
    words = spark.createDataFrame([(t,) for t in sorted({t for r in rules for t in r.tokens()})],
                                  "token string")
    seen = (targets.select(F.explode(_tokens(F.concat("host", "path"))).alias("token"))
            .join(F.broadcast(words) if len(rules) <= BROADCAST_RULES else words, "token")
            .groupBy("token").count())
    count = dict(seen.collect())  # at most one row per token of the rules
    rows = [(min(r.tokens(), key=lambda t: (count.get(t, 0), t), default=""),
             r.name, r.regex(), r.verdict, r.rank) for r in rules]
    return spark.createDataFrame(
        rows, "token string, rule string, regex string, verdict string, rank int")


def judge(urls: DataFrame, rules: list[Rule], default: str = "allow",
          url_col: str = "url") -> DataFrame:
    """Input rows with host, path, rule and verdict (rule: null if none matched).

    Input columns of these names are replaced.
    """
    host, path = host_path(F.col(url_col))
    added = ("host", "path", "rule", "verdict")
    rest = [c for c in urls.columns if c not in added]
    rows = urls.select(*rest, host.alias("host"), path.alias("path"))
    targets = rows.select("host", "path").distinct()
    index = _index(targets, rules)
    tokens = targets.select("host", "path", F.explode(
        F.array_union(_tokens(F.concat("host", "path")), F.array(F.lit("")))).alias("token"))
    index = F.broadcast(index) if len(rules) <= BROADCAST_RULES else index
    best = F.max(F.struct("rank", F.col("verdict").alias("v"), "rule"))
    # 'block' > 'allow': block wins among equal ranks
    found = (tokens.join(index, "token")
             .where(F.expr("regexp_like(concat(host, path), regex)"))
             .groupBy("host", "path").agg(best.alias("__best")))
    return (rows.join(found, ["host", "path"], "left")
            .select(*rest, "host", "path", F.col("__best.rule").alias("rule"),
                    F.coalesce("__best.v", F.lit(default)).alias("verdict")))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge(pages, site_rules() + spam_rules())
    names = [r for _, r in SITE_RULES]
    return judged.select("page_id", "host", "path",
                         F.when(F.col("rule").isin(names), F.col("rule")).alias("rule"),
                         "verdict")


def _sql() -> str:
    """Every rule against every URL, without an index."""
    site = ", ".join(f"('{v}', '{r.split('/')[0]}', '{r[r.index('/'):]}')" for v, r in SITE_RULES)
    spam = ", ".join("('" + r.regex().replace("'", "''") + "')" for r in spam_rules())
    return f"""
WITH site(v, h, p) AS (VALUES {site}), spam(rx) AS (VALUES {spam}),
a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0
        THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h0 FROM a),
c AS (SELECT page_id, translate(h0, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
        regexp_extract(substr(rest, length(h0) + 1), '^[^?#]*') AS path FROM b),
u AS (SELECT DISTINCT host, path FROM c),
s AS (SELECT host, path, max(struct_pack(n := length(h || p), v := v, rule := h || p)) AS best
      FROM u JOIN site ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
      GROUP BY host, path),
m AS (SELECT DISTINCT host, path FROM u JOIN spam ON regexp_matches(host || path, rx))
SELECT page_id, c.host, c.path, best.rule AS rule,
       coalesce(best.v, CASE WHEN m.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN s USING (host, path) LEFT JOIN m ON m.host = c.host AND m.path = c.path
"""


SQL = _sql()
