"""Line dedup by site-relative frequency.

A line is boilerplate of a site if the share of the site's pages that have it is above a ratio
and at least ``min_pages`` pages have it. Counting shuffles one row per (site, line) and task,
since equal lines are combined within tasks first; the line itself is replaced by two independent
64-bit hashes. Boilerplate lines meet their pages in an ordinary shuffled join, which AQE splits
where one line is on very many pages; a page's text travels once, by page.

Defined cases: a page without site belongs to a site of its own name, null; null and empty
texts have no lines; lines are compared without the white space around them and blank ones are
never counted or dropped; a line counts once per page; repeated rows are pages of their own; lines and
texts may be of any length; an empty table gives no rows; helper columns take names that no input column has.
Everything is a native column expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import BLANKS, fresh
from cohortloom.operators.materialize import settle
from cohortloom.operators.sizing import broadcast_small

RATIO = 0.1
MIN_PAGES = 3


def host_of(url: Column) -> Column:
    """The lower-case host of a URL, '' if it has none; null stays null."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def html_lines(html: Column) -> Column:
    """What stands between tags, one array entry per line."""
    return F.split(F.regexp_replace(html, r"<[^>]*>", "\n"), "\n")


def text_lines(text: Column) -> Column:
    return F.split(text, "\n")


def _stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _hashes(line: Column) -> Column:
    return F.struct(F.xxhash64(_stripped(line)).alias("h1"), F.xxhash64(F.lit(1), _stripped(line)).alias("h2"))


def drop_boilerplate(
    pages: DataFrame, site: Column, lines: Column, ratio: float = RATIO, min_pages: int = MIN_PAGES,
    copies_count: bool = True,
) -> DataFrame:
    """``pages`` with a column lines: those that are not boilerplate of their site, in order.

    ``lines`` is an array of text. An input column named lines is replaced. Without ``copies_count``
    the pages of a site that have the same lines count as one page, so copies of a text do not
    make its own lines boilerplate.
    """
    others = [c for c in pages.columns if c.lower() != "lines"]
    row_1, row_2, body, gone = (fresh([*pages.columns, "lines"], name) for name in ("row_1", "row_2", "body", "gone"))
    key = [row_1, row_2]
    cleaned = F.coalesce(lines, F.array().cast("array<string>"))
    # Rows with equal contents are dealt with alike, so two hashes of the contents name a row.
    contents = F.to_json(F.struct(site.alias("s"), cleaned.alias("l")))
    rows = pages.select(
        F.xxhash64(contents).alias(row_1), F.xxhash64(F.lit(1), contents).alias(row_2),
        *(F.col(c) for c in others), cleaned.alias(body),
    )
    filled = F.array_distinct(F.transform(F.filter(cleaned, lambda x: F.length(_stripped(x)) > 0), _hashes))
    own = pages.select(
        F.xxhash64(contents).alias(row_1), F.xxhash64(F.lit(1), contents).alias(row_2), site.alias("site"), filled.alias("own")
    )
    # Lines are counted, and found again on their pages: they are taken apart once.
    seen = settle(own.select(*key, "site", F.explode("own").alias("h")).select(*key, "site", "h.h1", "h.h2"))
    counted, sites = seen, own.select(*key, "site")
    if not copies_count:
        counted, sites = counted.distinct(), sites.distinct()
    totals = sites.groupBy(F.col("site").alias("of")).agg(F.count(F.lit(1)).alias("total"))
    often = counted.groupBy("site", "h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages)
    bad = settle(
        often.join(totals, F.col("site").eqNullSafe(F.col("of")))
        .filter(F.col("n") > ratio * F.col("total"))
        .select("of", "h1", "h2")
    )
    hit = seen.join(broadcast_small(bad)[0], ["h1", "h2"]).filter(F.col("site").eqNullSafe(F.col("of")))
    # Written first: AQE can split the key that all copies of a page share only if neither side of the
    # join comes from an aggregation.
    dropped = settle(hit.groupBy(*key).agg(F.collect_set(F.struct("h1", "h2")).alias(gone)))
    joined = rows.join(dropped, key, "left")
    kept = F.filter(body, lambda x: ~F.array_contains(gone, _hashes(x)))
    return joined.select(*others, F.when(F.col(gone).isNull(), F.col(body)).otherwise(kept).alias("lines"))
