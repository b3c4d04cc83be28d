"""File names and directories of stored documents."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlspark.functions.binding import let
from crawlspark.functions.fixed import (
    CONTROL_CHARACTERS,
    DEVICE_NAMES,
    FILE_NAME_LIMIT,
    PORTABLE_NAME_LIMIT,
    RESERVED_CHARACTERS,
)
from crawlspark.functions.url import authority, path, percent_decode

# Letters and digits of any script, underscore, white space and hyphen are kept.
_UNWANTED = r"(?U)[^\p{L}\p{N}_\s-]"


def dashed(text: Column) -> Column:
    """Unwanted characters dropped, runs of space and hyphen to one hyphen."""
    kept = F.regexp_replace(text, _UNWANTED, "")
    return F.regexp_replace(F.regexp_replace(kept, r"(?U)[-\s]+", "-"), r"^-+|-+$", "")


def file_name(url: Column, title: Column | None = None) -> Column:
    """Name under which a document is stored.

    Without any usable character the name is built from the URL's hash, so two
    runs agree on it.
    """
    def from_path(decoded: Column) -> Column:
        last = F.substring_index(decoded, "/", -1)
        domain = F.replace(authority(url), F.lit("www."), F.lit(""))
        parts = F.filter(F.split(decoded, "/"), lambda p: p != "")
        tail = F.when(F.size(parts) > 0, F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(2)), "-")).otherwise(
            F.lit("document")
        )
        return F.when(last != "", last).otherwise(F.concat(domain, F.lit("-"), tail))

    stem = F.regexp_replace(let(percent_decode(path(url)), from_path), r"(?s)^(\.*[^.].*)\.[^.]*$", "$1")
    source = stem if title is None else F.when(F.coalesce(title, F.lit("")) != "", title).otherwise(stem)
    clean = dashed(source)
    named = F.when(clean != "", clean).otherwise(F.concat(F.lit("document-"), F.md5(url)))
    return F.concat(F.substring(named, 1, FILE_NAME_LIMIT), F.lit(".pdf"))


def local_path(base: str, department: Column, name: Column, by_department: bool = True) -> Column:
    folder = [dashed(department)] if by_department else []
    return F.concat_ws("/", F.lit(str(PurePosixPath(base))), *folder, name)


def object_key(prefix: str | None, department: Column, name: Column, by_department: bool = True) -> Column:
    head = [F.lit(prefix.strip("/"))] if prefix else []
    folder = [dashed(department)] if by_department else []
    return F.concat_ws("/", *head, *folder, name)


def portable_name(name: Column) -> Column:
    """Name that every common file system accepts."""
    safe = F.regexp_replace(name, RESERVED_CHARACTERS, "_")
    safe = F.regexp_replace(safe, CONTROL_CHARACTERS, "")
    safe = F.regexp_replace(F.regexp_replace(safe, r"(?U)[_\s]+", "_"), r"^[ .]+|[ .]+$", "")

    def finish(text: Column) -> Column:
        device = F.upper(F.substring_index(text, ".", 1)).isin(DEVICE_NAMES)
        return let(F.when(device, F.concat(F.lit("_"), text)).otherwise(text), shorten)

    def shorten(text: Column) -> Column:
        extension = F.when(text.contains("."), F.substring_index(text, ".", -1)).otherwise(F.lit(""))
        stem = F.when(
            text.contains("."), F.substr(text, F.lit(1), F.length(text) - F.length(extension) - 1)
        ).otherwise(text)
        room = F.when(extension != "", F.lit(PORTABLE_NAME_LIMIT - 1) - F.length(extension)).otherwise(
            F.lit(PORTABLE_NAME_LIMIT)
        )
        cut = F.concat(
            F.substr(stem, F.lit(1), F.greatest(room, F.lit(0))),
            F.when(extension != "", F.concat(F.lit("."), extension)).otherwise(F.lit("")),
        )
        return F.when(F.length(text) > PORTABLE_NAME_LIMIT, cut).otherwise(text)

    done = let(safe, finish)
    return F.when(done.isin("", "_", "."), F.concat(F.lit("unnamed_file_"), F.md5(name))).otherwise(done)
