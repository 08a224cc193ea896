"""Boilerplate lines by their frequency within a site.

Pages are grouped by host; a line is boilerplate where the share of the
host's pages that contain it exceeds ``ratio``, on hosts of at least
``min_pages`` pages.  Lines are counted by MD5, once per page, pre-aggregated
before the shuffle, so a hot host or line spreads over all tasks.

The boilerplate of a host is bounded: shares over ``ratio`` add up to at most
the mean number of lines per page, so a host has at most that mean divided by
``ratio`` such lines, however many pages it has.  That list travels to the
pages, whose text is shuffled once.

Defined cases: a null page has no lines; pages without a host keep all lines;
lines are compared after trimming and after runs of blanks become one space,
empty lines go; repeated rows are pages of their own; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martspark.llm.common import stored, table
from martspark.llm.url_filter import host_path

RATIO = 0.5
MIN_PAGES = 3

# Fixed values: (pattern, replacement) that turn HTML into lines, in this
# order.  Both Java's and RE2's regular expressions read them alike.
HTML_STEPS = [
    (r"(?is)<script\b.*?</script\s*>", " "),
    (r"(?is)<style\b.*?</style\s*>", " "),
    (r"(?s)<!--.*?-->", " "),
    (r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|title|head"
     r"|body|html|main|aside|form|blockquote|pre)\b[^<>]*>", "\n"),
    (r"<[A-Za-z/!][^<>]*>", ""),
]
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "),
            ("&amp;", "&")]


def html_text(html: Column) -> Column:
    """Visible text of a page, one block element a line."""
    c = F.coalesce(html, F.lit(""))
    for pattern, to in HTML_STEPS:
        c = F.regexp_replace(c, pattern, to)
    for entity, to in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(to))
    return c


def text_lines(text: Column) -> Column:
    """Trimmed, non-empty lines of a text."""
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\r\f]+", " "), "\n")
    return F.filter(F.transform(lines, lambda line: F.trim(line)), lambda line: line != "")


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line.cast("binary")))


def site_boilerplate(pages: DataFrame, ratio: float = RATIO,
                     min_pages: int = MIN_PAGES) -> DataFrame:
    """Per host the digests of its boilerplate lines, from (host, lines) rows."""
    sited = pages.where(F.col("host") != "")
    totals = (sited.groupBy("host").agg(F.count("*").alias("total"))
              .where(F.col("total") >= min_pages))
    counts = (sited.select("host", F.explode(F.array_distinct("lines")).alias("line"))
              .groupBy("host", _digest(F.col("line")).alias("digest"))
              .agg(F.count("*").alias("n")).where(F.col("n") > 1))
    return (counts.join(totals, "host").where(F.col("n") > F.lit(ratio) * F.col("total"))
            .groupBy("host").agg(F.collect_list("digest").alias("boilerplate")))


def drop_boilerplate(pages: DataFrame, ratio: float = RATIO,
                     min_pages: int = MIN_PAGES) -> DataFrame:
    """Replace ``lines`` by n_lines, n_dropped and text, in rows with ``host`` and ``lines``.

    Input columns of these names are replaced.
    """
    rest = [c for c in pages.columns if c not in ("host", "lines", "n_lines", "n_dropped", "text")]
    # stored, so that the join deals both sides by host and Spark can split a hot one
    drop = stored(site_boilerplate(pages.select("host", "lines"), ratio, min_pages), "boilerplate")
    kept = F.filter("lines", lambda line: ~F.array_contains(
        F.coalesce(F.col("__drop"), F.array().cast("array<binary>")), _digest(line)))
    return (pages.select("host", *rest, "lines")
            .join(drop.withColumnRenamed("boilerplate", "__drop"), "host", "left")
            .withColumn("__kept", kept)
            .select(*rest, "host", F.size("lines").alias("n_lines"),
                    (F.size("lines") - F.size("__kept")).alias("n_dropped"),
                    F.concat_ws("\n", "__kept").alias("text")))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        "page_id", host_path(F.col("url"))[0].alias("host"),
        text_lines(html_text(F.col("html"))).alias("lines"))
    return drop_boilerplate(pages).select("page_id", "host", "n_lines", "n_dropped", "text")


def _sql() -> str:
    text = "coalesce(html, '')"
    q = lambda s: s.replace("'", "''")
    for pattern, to in HTML_STEPS:
        text = f"regexp_replace({text}, '{q(pattern)}', '{to}', 'g')"
    for entity, to in ENTITIES:
        text = f"replace({text}, '{q(entity)}', '{q(to)}')"
    text = f"regexp_replace({text}, '[ \\t\\r\\f]+', ' ', 'g')"
    return f"""
WITH a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0
        THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest, {text} AS t FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        list_filter(list_transform(string_split(t, chr(10)), lambda l: trim(l)),
                    lambda l: l <> '') AS lines FROM a),
f AS (SELECT host, line, count(*) AS n
      FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM p) GROUP BY host, line),
h AS (SELECT host, count(*) AS total FROM p GROUP BY host HAVING count(*) >= {MIN_PAGES}),
d AS (SELECT host, list(line) AS bad FROM f JOIN h USING (host)
      WHERE n > 1 AND n > {RATIO} * total AND host <> '' GROUP BY host),
k AS (SELECT page_id, p.host, lines,
        list_filter(lines, lambda l: NOT coalesce(list_contains(bad, l), false)) AS kept
      FROM p LEFT JOIN d ON p.host = d.host)
SELECT page_id, host, CAST(len(lines) AS INTEGER) AS n_lines,
       CAST(len(lines) - len(kept) AS INTEGER) AS n_dropped,
       array_to_string(kept, chr(10)) AS text FROM k
"""


SQL = _sql()
