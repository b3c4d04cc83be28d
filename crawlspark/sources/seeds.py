"""Departments and seeds, from Markdown lists or a YAML configuration."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark import schemas
from crawlspark.functions.fixed import (
    DEFAULT_MAX_DEPTH,
    DEFAULT_MAX_PAGES,
    MARKDOWN_HEADER,
    MARKDOWN_MAX_DEPTH,
    MARKDOWN_MAX_PAGES,
    MARKDOWN_URL,
)
from crawlspark.functions.text import strip
from crawlspark.operators.ordered import last_known, row_numbers


def read_markdown_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of Markdown files: file, line_no, line. A large file is read in splits, by as many tasks.

    A split's rows come in the order of the file and are numbered as they come;
    with the splits' offsets that orders all lines of a file.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
    )
    numbered = row_numbers(lines, "file", ["block", "row"], "line_no")
    return numbered.select("file", (F.col("line_no") - 1).alias("line_no"), "line")


def seeds_from_lines(lines: DataFrame) -> DataFrame:
    """Seeds of Markdown lines (file, line_no, line): dept_key, name, seed_ord, url.

    A header starts a department, and every address up to the next header is
    one of its seeds. A key that comes again in a file starts over; the seeds
    that further files give it are numbered on, in the order of the files, and an
    address counts once. Departments without an address have no row.
    """
    text = strip(F.col("line"))
    name = strip(F.regexp_extract(text, MARKDOWN_HEADER, 1))
    key = F.replace(F.regexp_replace(F.lower(name), r"(?U)[^\p{L}\p{N}_\s]", ""), F.lit(" "), F.lit("_"))
    marked = lines.select(
        "file",
        "line_no",
        F.when(name != "", F.struct("line_no", name.alias("name"), key.alias("dept_key"))).alias("header"),
        F.when(name == "", F.regexp_extract_all(text, F.lit(MARKDOWN_URL), F.lit(0))).alias("urls"),
    )
    # Over range partitions: the lines of one file are spread over many tasks.
    filled = last_known(marked, "file", ["line_no"], "header")
    found = filled.where(F.col("header").isNotNull()).select(
        "file",
        "line_no",
        F.col("header.line_no").alias("started"),
        F.col("header.dept_key").alias("dept_key"),
        F.col("header.name").alias("name"),
        F.posexplode_outer("urls").alias("pos", "url"),
    )
    latest = found.groupBy("file", "dept_key").agg(F.max("started").alias("started"))
    cleaned = (
        found.join(latest, ["file", "dept_key", "started"])
        .where(F.col("url").isNotNull())
        .withColumn("url", F.regexp_replace("url", r"[.,;]+$", ""))
    )
    first = cleaned.groupBy("dept_key", "url").agg(
        F.min(F.struct("file", "line_no", "pos")).alias("place"), F.min_by("name", F.struct("file", "line_no", "pos")).alias("name")
    )
    numbered = row_numbers(first, "dept_key", ["place"], "seed_ord")
    return numbered.select("dept_key", "name", (F.col("seed_ord") - 1).cast("int").alias("seed_ord"), "url")


def departments_of_seeds(
    seeds: DataFrame, max_depth: int = MARKDOWN_MAX_DEPTH, max_pages: int = MARKDOWN_MAX_PAGES
) -> DataFrame:
    """Department rows for seeds with a name: dept_key, name, max_depth, max_pages."""
    return seeds.groupBy("dept_key").agg(F.max("name").alias("name")).select(
        "dept_key", "name", F.lit(max_depth).alias("max_depth"), F.lit(max_pages).alias("max_pages")
    )


def load_yaml(path: str) -> dict[str, Any]:
    """Parsed configuration file; a small file, read by the driver."""
    import yaml

    with open(path, encoding="utf-8") as handle:
        data = yaml.safe_load(handle)
    if not data:
        raise ValueError("Configuration file is empty")
    return data


def departments_from_mapping(spark: SparkSession, config: dict[str, Any]) -> tuple[DataFrame, DataFrame]:
    """(departments, seeds) of a parsed configuration, with the default limits.

    Missing names and seeds come through as such; ``config_violations`` lists them.
    """
    if "departments" not in config:
        raise ValueError("Configuration must contain 'departments' section")
    entries = config["departments"] or {}
    for dept_key, entry in entries.items():
        if not isinstance(entry, dict):
            raise ValueError(f"Department '{dept_key}' configuration must be a dictionary")
    rows = [
        (
            dept_key,
            entry.get("name"),
            int(entry.get("max_depth", DEFAULT_MAX_DEPTH)),
            int(entry.get("max_pages", DEFAULT_MAX_PAGES)),
        )
        for dept_key, entry in entries.items()
    ]
    lists = [(dept_key, list(entry.get("seed_urls") or [])) for dept_key, entry in entries.items()]
    departments = spark.createDataFrame(rows, schemas.DEPARTMENTS)
    seeds = spark.createDataFrame(lists, "dept_key string, urls array<string>").select(
        "dept_key", F.posexplode("urls").alias("seed_ord", "url")
    )
    return departments, seeds
