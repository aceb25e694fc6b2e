"""Boilerplate lines of a site, in DataFrame functions only.

The lines of a page are the non-blank pieces of its HTML between tags and line
breaks.  For every host, the pages that contain a line are divided by the
host's pages; lines above the boilerplate ratio are dropped from the host's
pages.

Scale: a page counts a line once, lines travel as 16-byte digests and are
counted before the shuffle, so a line on every page of a hot host stays one
row per task.  A host has at most (lines per page / ratio) boilerplate lines,
so the list kept per host is bounded however many pages it has; pages meet it
in a join by host, whose skew handling splits a hot host.

Defined results: a null html has no lines; a page without a host in its url,
or of a host with fewer than ``min_pages`` pages, keeps all its lines; repeated
rows count as pages of their own; an empty table gives no rows; lines of any
length count whole; columns other than page_id, url and html are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
BREAK = r"<[^>]*>|\n"


def host_of(url: str = "url") -> Column:
    """Lower-cased host of a URL; null where it has none."""
    return F.nullif(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def lines_of(html: str = "html") -> Column:
    """The non-blank lines of a page, trimmed, in order."""
    pieces = F.transform(F.split(F.coalesce(F.col(html), F.lit("")), BREAK), lambda x: F.trim(x))
    return F.filter(pieces, lambda x: x != "")


def line_key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def boilerplate(pages: DataFrame, ratio: float = 0.5, min_pages: int = 3) -> DataFrame:
    """Rows (host, key, n_pages, host_pages): digests of the lines on more than ``ratio`` of a host's pages."""
    hosted = pages.select(host_of().alias("host"), lines_of().alias("lines")).where("host is not null")
    counts = hosted.select("host", F.explode(F.array_distinct("lines")).alias("line")).groupBy(
        "host", line_key(F.col("line")).alias("key")).agg(F.count("*").alias("n_pages"))
    totals = pages.select(host_of().alias("host")).where("host is not null").groupBy("host").agg(F.count("*").alias("host_pages"))
    common = counts.join(totals, "host")
    return common.where((F.col("host_pages") >= min_pages) & (F.col("n_pages") > ratio * F.col("host_pages")))


def without_boilerplate(pages: DataFrame, ratio: float = 0.5, min_pages: int = 3) -> DataFrame:
    """Rows (page_id, host, n_lines, n_dropped, kept_text): each page without its host's boilerplate lines."""
    listed = boilerplate(pages, ratio, min_pages).groupBy("host").agg(F.collect_list("key").alias("keys"))
    own = pages.select("page_id", host_of().alias("host"), lines_of().alias("lines"))
    joined = own.join(listed, "host", "left")
    kept = F.when(F.col("keys").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.array_contains(F.col("keys"), line_key(x))))
    out = joined.select("page_id", "host", F.size("lines").cast("bigint").alias("n_lines"), kept.alias("kept"))
    return out.select("page_id", "host", "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"),
                      F.concat_ws("\n", "kept").alias("kept_text"))


#: The same result in DuckDB SQL over ``pages``.
SQL = r"""
WITH own AS (
  SELECT page_id, row_number() OVER () AS row_no,
         nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
         list_filter(list_transform(regexp_split_to_array(coalesce(html, ''), '<[^>]*>|\n'), lambda x: trim(x)), lambda x: x <> '') AS lines
  FROM pages),
counts AS (
  SELECT host, line, count(*) AS n_pages FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM own WHERE host IS NOT NULL) GROUP BY ALL),
totals AS (SELECT host, count(*) AS host_pages FROM own WHERE host IS NOT NULL GROUP BY ALL),
common AS (SELECT host, list(line) AS dropped FROM counts JOIN totals USING (host)
  WHERE host_pages >= 3 AND n_pages > 0.5 * host_pages GROUP BY host),
kept AS (SELECT page_id, own.host, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(dropped, []::VARCHAR[]), x)) AS kept
  FROM own LEFT JOIN common ON own.host = common.host)
SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(kept))::BIGINT AS n_dropped,
       array_to_string(kept, chr(10)) AS kept_text FROM kept
"""
