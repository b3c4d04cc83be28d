"""Text clean-up."""

from __future__ import annotations

import json
import re
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlspark.functions.fixed import TEXT_ENTITIES

_ENTITY = r"&(?:#(?:[0-9]++|[xX][0-9a-fA-F]++)|[a-zA-Z][a-zA-Z0-9]*+);"


def fill(template: str, **values: Column) -> Column:
    """Text of ``template`` with its braces filled; NULL if a value is NULL."""
    pieces = re.split(r"\{(\w+)\}", template)
    parts = [values[piece].cast("string") if i % 2 else F.lit(piece) for i, piece in enumerate(pieces)]
    return F.concat(*parts)


def strip(text: Column) -> Column:
    """Drop white space of any script at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _named_entities() -> Column:
    """Map from a name and its semicolon to its text: the table of the HTML standard, a constant of the plan."""
    names = {name: plain for name, plain in html5.items() if name.endswith(";")}
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def _code_point_text(entity: Column) -> Column:
    """Text of a numeric entity; what is no character becomes the replacement character."""
    hexadecimal = F.lower(F.substring(entity, 3, 1)) == "x"
    digits = F.regexp_extract(entity, r"&#[xX]?0*([0-9a-fA-F]*);", 1)
    point = F.when(F.length(digits) > 7, F.lit("0")).otherwise(
        F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits)
    )
    number = F.when(point == "", F.lit("0")).otherwise(point).cast("int")
    valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    safe = F.when(valid, number).otherwise(F.lit(0xFFFD))
    return F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")


def unescape_entities(text: Column) -> Column:
    """Text with its named and numeric entities decoded, each once; unknown names stay as written."""
    names = _named_entities()

    def plain(entity: Column) -> Column:
        name = F.substring(entity, F.lit(2), F.length(entity))
        return F.when(entity.startswith("&#"), _code_point_text(entity)).otherwise(
            F.coalesce(names[name], entity)
        )

    # The text between entities and the entities themselves, in turns.
    between = F.split(text, _ENTITY, -1)
    entities = F.transform(F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0)), plain)
    whole = F.array_join(F.transform(between, lambda part, i: F.concat(part, F.coalesce(F.get(entities, i), F.lit("")))), "")
    return F.when(F.regexp_like(text, F.lit(_ENTITY)), whole).otherwise(text)


def clean_text(text: Column) -> Column:
    """White-space runs to one space, then the fixed entities in their fixed order."""
    out = F.regexp_replace(strip(text), r"(?U)\s+", " ")
    for entity, plain in TEXT_ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(plain))
    return out
