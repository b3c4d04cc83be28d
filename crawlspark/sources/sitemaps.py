"""Addresses listed in stored sitemaps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.functions.fixed import SITEMAP_LOCATIONS
from crawlspark.functions.text import strip
from crawlspark.functions.url import authority
from crawlspark.lineage import cut_lineage
from crawlspark.operators.lookup import join_lookup

_DOCUMENT = "url array<struct<loc:string>>, sitemap array<struct<loc:string>>"


def sitemap_roots(sitemaps: DataFrame) -> DataFrame:
    """Of each host the sitemap at the first location that answered, in the fixed order."""
    rank = F.coalesce(
        *[
            F.when(F.col("sitemap_url") == F.replace(F.lit(form), F.lit("{host}"), F.col("host")), F.lit(i))
            for i, form in enumerate(SITEMAP_LOCATIONS)
        ]
    )
    ranked = sitemaps.withColumn("rank", rank).where(F.col("rank").isNotNull())
    first = ranked.groupBy("host").agg(F.min("rank").alias("first_rank"))
    chosen = join_lookup(ranked, first, "host", "inner").where(F.col("rank") == F.col("first_rank"))
    return chosen.select("host", "sitemap_url", "xml")


def _parsed(sitemaps: DataFrame) -> DataFrame:
    """Sitemaps with their listed and nested addresses; a broken document lists nothing."""
    return sitemaps.select(
        "host",
        "sitemap_url",
        F.from_xml("xml", _DOCUMENT, {"mode": "PERMISSIVE", "ignoreNamespace": "true"}).alias("doc"),
    ).select(
        "host",
        "sitemap_url",
        F.col("doc.url.loc").alias("listed"),
        F.col("doc.sitemap.loc").alias("nested"),
    )


def sitemap_urls(sitemaps: DataFrame) -> DataFrame:
    """Addresses a host's sitemaps list for that host: host, url, distinct.

    ``sitemaps``: host, sitemap_url, xml. Nested indexes are followed level by
    level, however deep; one already opened for a host is not opened again, so
    the levels end.
    """
    stored = sitemaps.groupBy("sitemap_url").agg(F.min("xml").alias("xml"))
    levels = [cut_lineage(_parsed(sitemap_roots(sitemaps)), "sitemaps-0")]
    while not levels[-1].isEmpty():
        level = levels[-1]
        wanted = level.select("host", F.explode("nested").alias("sitemap_url")).select(
            "host", strip(F.col("sitemap_url")).alias("sitemap_url")
        ).distinct()
        opened = reduce(DataFrame.unionByName, levels).select("host", "sitemap_url")
        ahead = wanted.join(opened, ["host", "sitemap_url"], "left_anti").join(stored, "sitemap_url")
        levels.append(cut_lineage(_parsed(ahead.select("host", "sitemap_url", "xml")), f"sitemaps-{len(levels)}"))
    listed = reduce(DataFrame.unionByName, levels).select("host", F.explode("listed").alias("url"))
    return listed.where(authority(F.col("url")) == F.col("host")).distinct()
