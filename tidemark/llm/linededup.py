"""Boilerplate lines by their frequency within a site.

A line's ratio is the number of the site's pages that hold it, over the number of the site's pages. Lines
over the ratio go from every page of the site. Defined cases:

- the ratio decides alone for every line that stands on more than one page (``min_pages``), however small the site;
- a page counts once for a line it repeats; a line that is dropped goes at every place;
- blank lines are never boilerplate; lines are equal if they are the same characters;
- a page without a site stays as it is, and so does one without text (it still counts as a page);
- a page whose lines are all boilerplate keeps an empty text;
- repeated rows are pages of their own; other columns, whatever their names, are passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import stash

MAX_PERCENT = 10  # of the site's pages
MIN_PAGES = 2  # a line that stands on one page only is repeated nowhere, whatever its ratio


def _key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(docs: DataFrame, site: str, text: str, max_percent: int, min_pages: int) -> DataFrame:
    """``site, keys``: the keys of each site's boilerplate lines.

    A site has fewer than ``100 * lines per page / max_percent`` of them, so its list is short whatever its size.
    """
    pages = docs.select(F.col(site).alias("site"), F.col(text).alias("text")).where("site IS NOT NULL")
    lines = pages.select("site", F.explode(F.array_distinct(F.transform(
        F.filter(_lines(F.col("text")), lambda line: F.trim(line) != ""), _key))).alias("key"))
    counts = lines.groupBy("site", "key").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    totals = pages.groupBy("site").agg(F.count("*").alias("pages"))
    return (counts.join(totals, "site").where(F.col("n") * 100 > F.col("pages") * max_percent)
            .groupBy("site").agg(F.collect_list("key").alias("keys")))


def drop_site_lines(docs: DataFrame, site: str = "source", text: str = "text", max_percent: int = MAX_PERCENT,
                    min_pages: int = MIN_PAGES) -> DataFrame:
    """``row`` (the page's columns), ``clean`` (its text without boilerplate), ``n_lines``, ``n_dropped``.

    The text is read twice and never shuffled unless the boilerplate table is too large for Spark to
    broadcast; then the join splits hot sites.
    """
    found = stash(boilerplate(docs, site, text, max_percent, min_pages), "boilerplate")
    pages = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    joined = pages.join(found, F.col(f"row.{site}") == F.col("site"), "left")
    lines = _lines(F.col(f"row.{text}"))
    stay = F.filter(lines, lambda line: ~F.array_contains(F.col("keys"), _key(line)))
    touched = F.col("keys").isNotNull() & F.col(f"row.{text}").isNotNull()
    kept = joined.select("row", F.when(touched, stay).otherwise(lines).alias("kept"), F.size(lines).alias("n_lines"))
    return kept.select(
        "row", F.array_join("kept", "\n").alias("clean"),
        F.when(F.col(f"row.{text}").isNull(), 0).otherwise(F.col("n_lines")).cast("long").alias("n_lines"),
        F.when(F.col(f"row.{text}").isNull(), 0).otherwise(F.col("n_lines") - F.size("kept")).cast("long").alias("n_dropped"))


def clean_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents with the same columns, boilerplate lines gone and ``n_chars`` (if there) counted again."""
    cleaned = drop_site_lines(docs, **options)
    text = options.get("text", "text")
    again = {text: F.col("clean"), "n_chars": F.when(F.col("clean").isNull(), F.col("row.n_chars")).otherwise(
        F.length("clean").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else None}
    return cleaned.select(*[(again[c] if c in again else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
