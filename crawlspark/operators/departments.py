"""Selection of departments, and what was found for each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_departments(departments: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """Departments whose key or name is wanted; all if nothing is named."""
    if not wanted:
        return departments
    return departments.where(F.col("dept_key").isin(wanted) | F.col("name").isin(wanted))


def documents_found(visited: DataFrame, documents: DataFrame, *more: DataFrame) -> DataFrame:
    """Distinct documents per department: dept_key, target_url.

    ``visited``: dept_key, url of the pages looked at. ``documents``: page_url,
    target_url. ``more``: further (dept_key, target_url), such as search hits.
    """
    on_pages = (
        visited.select("dept_key", F.col("url").alias("page_url"))
        .distinct()
        .join(documents.select("page_url", "target_url"), "page_url")
        .select("dept_key", "target_url")
    )
    return reduce(DataFrame.unionByName, [m.select("dept_key", "target_url") for m in more], on_pages).distinct()
