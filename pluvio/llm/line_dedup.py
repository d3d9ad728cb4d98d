"""Line dedup by site-relative frequency.

For every site, the number of its distinct pages that hold a line is divided by the number of its distinct
pages; a line above ``ratio`` on at least ``min_pages`` pages is boilerplate of that site and is dropped
from its pages. Pages of equal text count once, so a page that was crawled many times does not make its own
lines boilerplate.

Lines are compared without white space at their ends; blank lines always stay, kept lines stay as they are
and in order. A null site is a site of its own; a null text is no page and stays null; an empty text is a
page without lines. Other columns pass through, whatever their names; repeated rows stay, each. Very long texts are
taken whole. Without documents there are no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pluvio.llm.common import set_apart, stored
from pluvio.operators.joins import small_side

RATIO = 0.05
MIN_PAGES = 5
_EDGES = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    return F.md5(F.regexp_replace(line, _EDGES, ""))


EMPTY_KEY = "d41d8cd98f00b204e9800998ecf8427e"  # md5 of the empty text


def boilerplate(docs: DataFrame, site: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(site, keys): the md5 keys of each site's boilerplate lines, joined by commas.

    A site has at most (lines of a page) / ratio such lines, whatever its size.
    """
    pages = docs.filter("text is not null").select(F.col(site).alias("site"), F.md5("text").alias("page"), F.col("text"))
    totals = pages.select("site", "page").distinct().groupBy("site").agg(F.count(F.lit(1)).alias("total"))
    keys = F.array_distinct(F.transform(lines_of(F.col("text")), line_key))
    on_page = pages.select("site", "page", F.explode(keys).alias("key")).filter(F.col("key") != EMPTY_KEY).distinct()
    counts = on_page.groupBy("site", "key").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= min_pages)
    totals = totals.select(F.col("site").alias("_site"), "total")
    often = counts.join(small_side(totals), F.col("site").eqNullSafe(F.col("_site"))).filter(F.col("pages") > ratio * F.col("total"))
    return often.groupBy("site").agg(F.concat_ws(",", F.sort_array(F.collect_list("key"))).alias("keys"))


def drop_lines(docs: DataFrame, site: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES, counts: bool = True) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``. The texts are not shuffled while the keys are few.

    With ``counts`` the columns ``_lines`` and ``_dropped`` are added, in place of columns of these names.
    """
    found = stored(boilerplate(docs, site, ratio, min_pages), "boilerplate")
    found = found.select(F.col("site").alias("_site"), F.col("keys").alias("_keys"))
    shielded, own = set_apart(docs, "_site", "_keys", "_kept", "_lines", "_dropped")
    joined = shielded.join(small_side(found), shielded[site].eqNullSafe(F.col("_site")), "left")
    lines = lines_of(F.col("text"))
    kept = F.when(F.col("_keys").isNull(), lines).otherwise(F.filter(lines, lambda line: ~F.col("_keys").contains(line_key(line))))
    joined = joined.withColumn("_kept", kept).withColumn("_lines", F.coalesce(F.size(lines), F.lit(0)).cast("long"))
    dropped = F.col("_lines") - F.coalesce(F.size("_kept"), F.lit(0))
    text = F.when(F.col("text").isNotNull(), F.array_join("_kept", "\n"))
    columns = [text.alias("text") if c == "text" else column for c, column in zip(docs.columns, own) if not counts or c.lower() not in ("_lines", "_dropped")]
    if not counts:
        return joined.select(columns)
    return joined.select(*columns, F.when(F.col("text").isNull(), 0).otherwise(F.col("_lines")).cast("long").alias("_lines"),
                         F.when(F.col("text").isNull(), 0).otherwise(dropped).cast("long").alias("_dropped"))
