"""Line dedup by site-relative frequency.

Documents are grouped by host (column `source`). The number of a host's pages that hold a line, divided by the number of
all its pages, is the line's ratio; lines whose ratio exceeds the threshold are boilerplate and are dropped from the pages
of that host. A line that only one page holds repeats nowhere and is never boilerplate, however few pages its host has.

Defined cases: lines are compared after removing surrounding spaces and are split at newlines only; blank lines are never
boilerplate; a line repeated within a page counts once; rows count as pages even if they repeat or lack an id; a null host
is a host of its own; a null text stays null and counts as a page without lines; a page all of whose lines go keeps an
empty text; an empty table gives an empty result; other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup_join, stored

#: A line goes if more than RATIO of its host's pages hold it, and at least MIN_PAGES pages do: one page alone repeats nothing.
RATIO = 0.1
MIN_PAGES = 2


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _host(col: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit(""))


def boilerplate(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, host: str = "source", text: str = "text") -> DataFrame:
    """One row per host that has any: __host, __bad (the hashes of its boilerplate lines, at most the lines of 1/ratio pages)."""
    pages = docs.select(_host(F.col(host)).alias("__host"), F.col(text).alias("__text"))
    totals = stored(pages.groupBy("__host").agg(F.count("*").alias("__pages")), "hosts")
    lines = pages.select("__host", F.explode(F.array_distinct(F.transform(_lines(F.col("__text")), lambda line: F.trim(line)))).alias("__line")).where("__line <> ''")
    counts = (
        lines.groupBy("__host", F.xxhash64("__line").alias("__h"))  # 64 bits are enough among the lines of one host
        .agg(F.count("*").alias("__n"))
        .where(F.col("__n") >= min_pages)
    )
    over = lookup_join(counts, totals, ["__host"], "inner", ["__h"]).where(F.col("__n") > F.col("__pages") * F.lit(ratio))
    return stored(over.groupBy("__host").agg(F.collect_set("__h").alias("__bad")), "boilerplate")


def marked(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, host: str = "source", text: str = "text") -> DataFrame:
    """Columns __doc (the whole row), __kept (its lines that stay, null for a null text) and __lines (how many it has)."""
    bad = boilerplate(docs, ratio, min_pages, host, text)
    rows = docs.select(F.struct("*").alias("__doc"), _host(F.col(host)).alias("__host"))
    rows = lookup_join(rows, bad, ["__host"], "left", ["__doc"])
    lines = _lines(F.col("__doc")[text])
    gone = lambda line: F.array_contains(F.col("__bad"), F.xxhash64(F.trim(line))) & (F.trim(line) != "")
    kept = F.when(F.col("__bad").isNull(), lines).otherwise(F.filter(lines, lambda line: ~gone(line)))
    return rows.select("__doc", kept.alias("__kept"), F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("__lines"))


def drop_boilerplate(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, host: str = "source", text: str = "text") -> DataFrame:
    """The documents in their own columns, with boilerplate lines taken out of the text."""
    done = marked(docs, ratio, min_pages, host, text)
    at = {c: F.col("__doc")[c] for c in docs.columns} | {text: F.array_join("__kept", "\n")}
    return done.select(*[v.alias(c) for c, v in at.items()])


def report(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, host: str = "source", text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, text (cleaned), n_lines, n_dropped of every document."""
    return marked(docs, ratio, min_pages, host, text).select(
        F.col("__doc")[key].alias("doc_id"),
        F.array_join("__kept", "\n").alias("text"),
        F.col("__lines").alias("n_lines"),
        (F.col("__lines") - F.coalesce(F.size("__kept"), F.lit(0))).alias("n_dropped"),
    )


ORACLE = f"""
WITH d AS (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents),
hosts AS (SELECT source, count(*) AS pages FROM d GROUP BY source),
seen AS (SELECT source, unnest(list_distinct(list_transform(ls, lambda x: trim(x)))) AS line FROM d),
bad AS (
  SELECT c.source, list(c.line) AS lines
  FROM (SELECT source, line, count(*) AS n FROM seen WHERE line <> '' GROUP BY source, line) c
  JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source
  WHERE c.n >= {MIN_PAGES} AND c.n > h.pages * CAST({RATIO} AS DOUBLE)
  GROUP BY c.source),
k AS (
  SELECT d.doc_id, d.ls, list_filter(d.ls, lambda x: NOT list_contains(coalesce(b.lines, []), trim(x))) AS kept
  FROM d LEFT JOIN bad b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, CASE WHEN ls IS NULL THEN NULL ELSE coalesce(array_to_string(kept, chr(10)), '') END AS text,
  coalesce(len(ls), 0) AS n_lines, coalesce(len(ls) - len(kept), 0) AS n_dropped
FROM k
"""
