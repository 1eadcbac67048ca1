"""Line de-duplication by how common a line is on its site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .small_tables import small
from .storage import stored

#: A line is boilerplate if more than this share of its site's pages have it ...
MAX_RATIO = 0.1
#: ... and at least so many pages.
MIN_PAGES = 3
#: The share for corpora: about half the rate of the test tables' own boilerplate
#: (10.6 % of the pages) and above that of the next lines (3.4 % and less).
CORPUS_RATIO = 0.05
#: So many standard deviations above that share, so that on small sites chance
#: repeats of rarer lines are not boilerplate.
CORPUS_DEVIATIONS = 2.0


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _digest(line: Column) -> Column:
    """128 bits of a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def _has_word(line: Column) -> Column:
    return F.trim(F.translate(line, "\t\x0b\x0c\r", "    ")) != ""


def _digests(pages: DataFrame, host: str, text: str, *others: Column) -> DataFrame:
    """One row per page and different line with a word."""
    distinct = F.array_distinct(
        F.transform(F.filter(_lines(F.col(text)), _has_word), _digest)
    )
    return pages.select(*others, F.col(host).alias("site"), F.explode(distinct).alias("line"))


def _different(pages: DataFrame, host: str, text: str) -> DataFrame:
    """``(site, lines)``: the digests of the lines with a word, once for all pages
    of a site that have equal texts. Copies are combined in the tasks that read
    them, and no text is shuffled."""
    lines = F.transform(F.filter(_lines(F.col(text)), _has_word), _digest)
    return (
        pages.select(
            F.col(host).alias("site"),
            _digest(F.col(text)).alias("page"),
            F.array_distinct(lines).alias("lines"),
        )
        .groupBy("site", "page")
        .agg(F.first("lines").alias("lines"))
        .select("site", "lines")
    )


def boilerplate(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    different: bool = False,
    deviations: float = 0.0,
) -> DataFrame:
    """Lines (as digests) that too many pages of a site have: ``(site, line, pages)``.

    Too many are more than ``max_ratio`` of the site's pages, and more than that
    by ``deviations`` times the square root of that number of pages. With
    ``different``, a site's pages with equal texts are one page in both counts.
    Counts are combined in the tasks that read the pages, so neither a
    large site nor a frequent line nor a group of copies meets in one task here.
    """
    if different:
        # Stored, since both counts read it.
        once = stored(_different(pages, host, text))
        totals = once.groupBy(F.col("site").alias("of_site")).agg(F.count("*").alias("site_pages"))
        found = once.select("site", F.explode("lines").alias("line"))
    else:
        totals = pages.groupBy(F.col(host).alias("of_site")).agg(F.count("*").alias("site_pages"))
        found = _digests(pages, host, text)
    found = found.groupBy("site", "line").agg(F.count("*").alias("pages"))
    found = found.where(F.col("pages") >= min_pages)
    most = F.col("site_pages") * F.lit(max_ratio)
    if deviations:
        most = most + F.lit(deviations) * F.sqrt(most)
    return (
        found.join(totals, F.col("site").eqNullSafe(F.col("of_site")))
        .where(F.col("pages") > most)
        .select("site", "line", "pages")
    )


def drop_boilerplate(
    pages: DataFrame,
    key: str = "doc_id",
    host: str = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    different: bool = False,
    deviations: float = 0.0,
) -> DataFrame:
    """Drop from each text the lines that are boilerplate on its site.

    All input columns stay, ``text`` with the other lines in their order; added
    are ``n_lines`` and ``n_dropped`` (they replace columns of these names).
    Lines are split at newlines and compared as they are; lines without a word
    are never dropped. A null host is a site of its own; a null text has no line
    with a word and stays null. Each row is a page, also when rows repeat, so
    all lines of a text with many copies on its site go from all of them. With
    ``different``, rows of a site with equal texts are one page, and copies are
    left to near-duplicate removal; copies that differ in a byte are still
    pages of their own.

    Whether a line goes depends on site and line only, so what is joined back to
    the texts is, per key and site, the few digests to drop. The table of lines to
    drop is broadcast if counting it shows that it is small.
    """
    bad = boilerplate(pages, host, text, max_ratio, min_pages, different, deviations).select(
        F.col("site").alias("bad_site"), F.col("line").alias("bad_line")
    )
    # The lines to drop are frequent ones, each a hot key of a shuffled join.
    bad = small(stored(bad))
    marked = _digests(pages, host, text, F.col(key).alias("page"))
    same = F.col("site").eqNullSafe(F.col("bad_site")) & (F.col("line") == F.col("bad_line"))
    drops = (
        marked.join(bad, same)
        .groupBy(F.col("page").alias("_ll_drop_page"), F.col("site").alias("_ll_drop_site"))
        .agg(F.collect_set("line").alias("_ll_drop_lines"))
    )
    names = [c for c in pages.columns if c not in ("n_lines", "n_dropped")]
    joined = pages.select(*names).join(
        drops,
        F.col(key).eqNullSafe(F.col("_ll_drop_page")) & F.col(host).eqNullSafe(F.col("_ll_drop_site")),
        "left",
    )
    lines = _lines(F.col(text))
    kept = F.filter(lines, lambda x: ~F.array_contains(F.col("_ll_drop_lines"), _digest(x)))
    kept = F.when(F.col("_ll_drop_lines").isNull(), lines).otherwise(kept)
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long")
    n_kept = F.when(F.col(text).isNull(), 0).otherwise(F.size("_ll_kept_lines")).cast("long")
    result = joined.withColumn("_ll_kept_lines", kept)
    cleaned = F.when(F.col(text).isNotNull(), F.array_join("_ll_kept_lines", "\n"))
    return result.select(
        *(cleaned.alias(text) if c == text else F.col(c) for c in names),
        n_lines.alias("n_lines"),
        (n_lines - n_kept).alias("n_dropped"),
    )
