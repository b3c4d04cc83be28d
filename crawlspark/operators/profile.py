"""Profiles of pages and sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.functions import html as H
from crawlspark.functions.fixed import GOVERNMENT_SUFFIXES, SCRIPT_LIMIT, SCRIPT_SIGNS
from crawlspark.functions.text import clean_text
from crawlspark.functions.url import authority, ends_with_any, file_extension, is_valid
from crawlspark.operators.links import document_array
from crawlspark.operators.rules import LinkRule


def script_signs(html: Column) -> Column:
    """How often the signs of scripting occur in a page."""
    text = F.lower(html)
    total = F.lit(0)
    for sign in SCRIPT_SIGNS:
        missing = F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))
        total = total + F.floor(missing / len(sign)).cast("long")
    return total


def script_weight(
    pages: DataFrame, rules: list[LinkRule] | None = None, limit: int = SCRIPT_LIMIT, keep: tuple[str, ...] = ("url",)
) -> DataFrame:
    """Per page its columns ``keep``, script_signs, document_count, requires_browser.

    A page with much scripting and no document link probably builds its links
    in the browser. Counts come from the page's own row, so nothing is joined.
    """
    counted = pages.select(
        *keep,
        script_signs(F.col("html")).alias("script_signs"),
        F.size(document_array(rules)).cast("long").alias("document_count"),
    )
    return counted.withColumn(
        "requires_browser", (F.col("script_signs") > limit) & (F.col("document_count") == 0)
    )


def site_profile(urls: DataFrame, suffixes: list[str] | None = None) -> DataFrame:
    """Per site and file extension: urls, valid, invalid, government."""
    suffixes = GOVERNMENT_SUFFIXES if suffixes is None else suffixes
    site = authority(F.col("url"))
    shaped = urls.select(
        site.alias("site"),
        file_extension(F.col("url")).alias("extension"),
        F.coalesce(is_valid(F.col("url")), F.lit(False)).alias("valid"),
        ends_with_any(F.lower(site), suffixes).alias("government"),
    )
    return shaped.groupBy("site", "extension").agg(
        F.count("*").alias("urls"),
        F.count_if("valid").alias("valid"),
        F.count_if(~F.col("valid")).alias("invalid"),
        F.count_if("government").alias("government"),
    )


def page_text(pages: DataFrame) -> DataFrame:
    """Per page: title, text, text_length, both cleaned."""
    cleaned = pages.select(
        "url",
        clean_text(H.title_text(F.col("html"))).alias("title"),
        clean_text(H.visible_text(F.col("html"))).alias("text"),
    )
    return cleaned.withColumn("text_length", F.length("text").cast("long"))
