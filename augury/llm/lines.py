"""Boilerplate lines by their frequency within a site.

For each host the number of pages that contain a line, each page once, is divided by the host's number of pages; lines
above the ratio go. Lines are compared without surrounding blanks; blank lines are neither counted nor dropped. On a
host of one page every line is on all its pages, and goes.

Three parameters, all off unless asked for, serve corpora in which one host is a whole source: `distinct` counts equal
texts of a host once (copies of a page do not make its lines boilerplate), `least_pages` asks for a number of pages
besides the ratio, and `spare` leaves a page whole if nothing of it would stay.

A null host is a host of its own; a null text stays null and is no page; an empty text is a page without lines. Repeated
rows are pages of their own and all kept; ties do not matter: a line at the ratio stays. Very long texts are handled as
arrays of lines within one row. An empty table gives an empty result. Other columns pass through, whatever their names,
in the struct column `row`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augury.llm.common import remove, written

RATIO = 0.2
#: The ratio for whole sources of a corpus, which hold many sites: a line that one site repeats is on few of a
#: source's texts. At 0.1 one line of sf0.1 went; see the README for what goes at other ratios.
SOURCE_RATIO = 0.01


def _key(line: Column) -> Column:
    """Hash of a line; null for a blank one."""
    bare = F.btrim(line, F.lit(" \t\r"))
    return F.when(bare != "", F.xxhash64(bare))


def without_boilerplate(docs: DataFrame, host: Column, text: Column | str = "text", ratio: float = RATIO, distinct: bool = False, least_pages: int = 1, spare: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Columns row (the columns named in keep, all if that is not given), host, clean (text without boilerplate lines),
    n_lines, n_dropped (both of non-blank lines).

    The counts need the hashes of lines only, which are summed before they are shuffled. A text that is an expression is
    made, cut and hashed once and written; a column is cut again when its lines are dropped, which costs less than to
    write it.
    """
    made = not isinstance(text, str)
    text = text if made else F.col(text)
    lines = docs.select(F.struct(*(["*"] if keep is None else [F.col(f"`{c}`") for c in keep])).alias("row"), host.alias("host"), F.split(text, "\n").alias("lines"))
    pages = lines.select("row", "host", "lines", F.transform("lines", _key).alias("keys"))
    pages = written(pages, "pages") if made else pages
    found = pages.where("lines is not null").select("host", F.xxhash64("lines").alias("page"), F.array_distinct(F.filter("keys", lambda k: k.isNotNull())).alias("keys"))
    # A null line stands for the page itself, so that one pass counts pages and lines.
    each = found.select("host", "page", F.explode(F.array_append("keys", F.lit(None).cast("long"))).alias("line"))
    each = each.distinct() if distinct else each
    counts = written(each.groupBy("host", "line").agg(F.count("*").alias("n")), "lines")
    totals = counts.where("line is null").select(F.col("host").alias("h"), F.col("n").alias("total"))
    often = counts.where((F.col("n") >= least_pages) & F.col("line").isNotNull()).join(totals, F.col("host").eqNullSafe(F.col("h"))).where(F.col("n") > ratio * F.col("total"))
    # A host has at most (lines per page / ratio) of them, however many pages it has.
    lists = written(often.groupBy("host").agg(F.collect_list("line").alias("drop")).select(F.col("host").alias("h"), "drop"), "boilerplate")
    remove(counts)
    out = pages.join(lists, F.col("host").eqNullSafe(F.col("h")), "left")
    # Of a host's list only what the page has is held against its lines.
    out = out.withColumn("gone", F.coalesce(F.array_intersect("keys", "drop"), F.array().cast("array<bigint>")))
    lost = lambda k: k.isNotNull() & F.array_contains("gone", k)
    count = lambda test: F.size(F.filter("keys", test)).cast("long")
    out = out.withColumn("n_lines", F.coalesce(count(lambda k: k.isNotNull()), F.lit(0))).withColumn("n_dropped", F.coalesce(count(lost), F.lit(0)))
    if spare:
        out = out.withColumn("n_dropped", F.when(F.col("n_dropped") < F.col("n_lines"), F.col("n_dropped")).otherwise(F.lit(0).cast("long")))
    kept = F.filter("lines", lambda _, i: ~F.coalesce(lost(F.get("keys", i)), F.lit(False)))
    clean = F.array_join(F.when(F.col("n_dropped") > 0, kept).otherwise(F.col("lines")), "\n")
    return out.select("row", "host", clean.alias("clean"), "n_lines", "n_dropped")


#: Block elements of HTML that end a line: fixed values.
_BLOCKS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"


def page_text(html: Column) -> Column:
    """Visible text of a page, one line per block."""
    shown = F.regexp_replace(html, r"(?is)<(?:script\b.*?</script\s*>|style\b.*?</style\s*>|!--.*?-->)", "")
    return F.regexp_replace(F.regexp_replace(shown, rf"(?i)</?(?:{_BLOCKS})\b[^>]*>", "\n"), "<[^>]*>", "")


def page_host(url: Column) -> Column:
    """Host name of a URL in lower case; null if it has none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", F.lower(found))
