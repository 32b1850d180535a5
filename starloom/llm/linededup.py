"""Boilerplate lines by their frequency relative to the site.

Pages are grouped by host. A line's ratio is the number of the host's pages that
contain it over all the host's pages; lines above ``RATIO`` that stand on at
least ``MIN_PAGES`` pages of the host are boilerplate and are dropped from every
page of that host. DataFrame functions only.

A line is text between line feeds, compared without surrounding blanks; blank
lines are neither counted nor dropped. A line counts once per page. Each row is
a page: repeated rows count as often as they occur, and each is cleaned. Null
and empty texts count as pages of their host and stay as they are. Null hosts
form one host.

Lines travel as 64-bit hashes of (host, line) with a count per task, so a line
on a third of all pages costs one row per task. Hosts' totals meet their lines
over ``SALTS`` copies, so a host with a third of all pages is spread. The text
is shuffled once, by page.

*Documents.* A source is no site with a frame of its own, so the document stage
has its own bounds, ``DOC_RATIO`` and ``DOC_MIN``, and counts a text once however
many copies of it the source holds. Lines in fewer than ``DOC_MIN`` texts of a
source stay: two texts of a source that share lines are mostly near copies, and
cutting what they share would leave neither.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.scratch import stored, unused

RATIO = 0.3
MIN_PAGES = 5
SALTS = 32
#: The document stage's own bounds: share of a source's distinct texts, and least number of them.
DOC_RATIO = 0.005
DOC_MIN = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _hash(host: Column, line: Column) -> Column:
    return F.xxhash64(host, F.btrim(line))


def boilerplate(pages: DataFrame, host: str, text: str, ratio: float = RATIO, min_pages: int = MIN_PAGES,
                once: bool = False) -> DataFrame:
    """``h, n_pages, host_pages``: hash of (host, line) of each boilerplate line.
    With ``once`` a host's equal texts are one page."""
    p = pages.select(F.col(host).alias("host"), F.col(text).alias("text"))
    own = [F.xxhash64("text").alias("copy")] if once else []
    lines = p.select(
        "host", *own, F.explode(F.array_distinct(F.transform(_lines(F.col("text")), lambda x: F.btrim(x)))).alias("line")
    ).where("line <> ''")
    lines = lines.select(F.xxhash64("host", "line").alias("h"), F.xxhash64("host").alias("site"), *(["copy"] if once else []))
    sites = p.select(F.xxhash64("host").alias("site"), *own)
    if once:
        lines, sites = lines.distinct(), sites.distinct()
    often = (
        lines.groupBy("site", "h")
        .agg(F.count(F.lit(1)).alias("n_pages"))
        .where(F.col("n_pages") >= min_pages)
        .withColumn("salt", F.pmod(F.col("h"), F.lit(SALTS)))
    )
    totals = (
        sites.groupBy("site")
        .agg(F.count(F.lit(1)).alias("host_pages"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    )
    return often.join(totals, ["site", "salt"]).where(F.col("n_pages") > ratio * F.col("host_pages")).select(
        "h", "n_pages", "host_pages"
    )


def drop_boilerplate(pages: DataFrame, key: str, host: str, text: str, ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, dropped: str = "n_dropped", once: bool = False) -> DataFrame:
    """``pages`` with boilerplate lines cut from ``text`` and, in a new column
    ``dropped``, how many were cut. ``key`` identifies a page; pages sharing a key
    (or with none) are still cleaned by their own host's lines. With ``once`` a
    host's equal texts count as one page; all are cleaned."""
    if dropped in pages.columns:
        raise ValueError(f"column exists already: {dropped}")
    bad = boilerplate(pages, host, text, ratio, min_pages, once)
    row, own = unused(pages.columns, "_key", "_bad")
    # a line is bad for its host whoever asks, so a row is known by what it holds: rows
    # that share a key, or have none, are no group
    name = F.xxhash64(F.col(key), F.col(host), F.col(text))
    seen = pages.select(
        name.alias(row),
        F.explode(
            F.array_distinct(F.transform(_lines(F.col(text)), lambda x: _hash(F.col(host), x)))
        ).alias("h"),
    )
    # a page holds a bounded number of its own lines, so its list is bounded by its text
    hits = seen.join(bad.select("h"), "h", "left_semi").groupBy(row).agg(F.collect_set("h").alias(own))
    both = pages.join(hits, name == F.col(row), "left")
    lines = _lines(F.col(text))
    kept = F.filter(lines, lambda x: (F.btrim(x) == "") | ~F.array_contains(own, _hash(F.col(host), x)))
    gone = F.col(own).isNotNull()
    clean = F.when(gone, F.array_join(kept, "\n")).otherwise(F.col(text))
    n = F.when(gone, F.size(lines) - F.size(kept)).otherwise(F.lit(0))
    return both.select(
        *[clean.alias(c) if c == text else F.col(f"`{c}`") for c in pages.columns], n.cast("long").alias(dropped)
    )


# What stands for a line end: parts of a page that hold no text, and block tags.
# One pattern that begins with "<", so that a scan passes over the text quickly.
_BREAKS = (
    r"(?s)<(?:script[^>]*>.*?</script>|style[^>]*>.*?</style>|!--.*?-->"
    r"|/?(?:p|div|li|ul|ol|nav|h[1-6]|br|tr|td|table|article|footer|header|title|body|head|html)(?:\s[^>]*)?/?>)"
)


def page_lines(html: Column) -> Column:
    """The text of a page, one block element a line."""
    text = F.regexp_replace(html, _BREAKS, "\n")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    return F.regexp_replace(text, r"[ \t\r]*\n\s*", "\n")


def page_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1))


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All pages' text without their hosts' boilerplate lines."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", page_host(F.col("url")).alias("host"), page_lines(F.col("html")).alias("text")
    )
    # the text is read three times: cut it out of the markup once
    return drop_boilerplate(stored(pages, "page-lines"), "page_id", "host", "text").select(
        "page_id", "host", "n_dropped", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5")
    )


def stage_line_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without the lines on over ``DOC_RATIO`` of their
    source's distinct texts (``DOC_MIN`` at least), with ``n_chars`` of the text that
    stays. No document is dropped."""
    columns = docs.columns
    (dropped,) = unused(columns, "_dropped")
    clean = drop_boilerplate(docs, "doc_id", "source", "text", DOC_RATIO, DOC_MIN, dropped, once=True)
    n = F.when(F.col(dropped) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.select(*[n.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in columns])


SQL = rf"""
WITH t AS (
  SELECT page_id,
         lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)', 1)) AS host,
         regexp_replace(regexp_replace(regexp_replace(html,
           '{_BREAKS}', chr(10), 'g'), '<[^>]*>', '', 'g'), '[ \t\r]*\n\s*', chr(10), 'g') AS text
  FROM pages
), l AS (
  SELECT page_id, host, i, string_split(text, chr(10))[i] AS line
  FROM t, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(i)
), often AS (
  SELECT host, trim(line, ' ') AS line, count(DISTINCT page_id) AS n
  FROM l WHERE trim(line, ' ') <> '' GROUP BY ALL
), total AS (SELECT host, count(*) AS n FROM t GROUP BY host),
bad AS (
  SELECT o.host, o.line FROM often o JOIN total s USING (host)
  WHERE o.n >= {MIN_PAGES} AND o.n > {RATIO} * s.n
), marked AS (
  SELECT l.page_id, l.host, l.i, l.line, b.line IS NOT NULL AS cut
  FROM l LEFT JOIN bad b ON b.host = l.host AND b.line = trim(l.line, ' ')
), joined AS (
  SELECT page_id, any_value(host) AS host, count(*) FILTER (cut) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT cut), '') AS text
  FROM marked GROUP BY page_id
)
SELECT page_id, host, n_dropped::BIGINT AS n_dropped, length(text)::BIGINT AS n_chars, md5(text) AS text_md5
FROM joined
"""

__all__ = ["boilerplate", "drop_boilerplate", "page_lines", "page_host", "op2_line_dedup", "stage_line_dedup", "SQL"]
