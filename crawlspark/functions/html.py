"""HTML fragments as column expressions.

Pages are searched with possessive patterns: they never backtrack into an
attribute value and never recurse per character, so a long or broken page
costs time in proportion to its length.

Known limits: an unclosed comment or script is kept as text, and an anchor
that opens inside another anchor ends the outer one's text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlspark.functions.text import strip, unescape_entities

_NOISE = (
    r"(?is)<(?:!--.*?-->"
    r"|script(?=[\s/>])[^>]*+>.*?</script\s*+>"
    r"|style(?=[\s/>])[^>]*+>.*?</style\s*+>)"
)
# Attributes up to the closing bracket; a bracket inside a quoted value does not close.
_ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>"""
_VALUE = r"""("[^"]*+"|'[^']*+'|[^\s>]*+)"""
_OPEN_TAG = r"(?is)^<[a-z][^\s/>]*+" + _ATTRIBUTES


def without_noise(html: Column) -> Column:
    """Page without comments, scripts and styles."""
    return F.regexp_replace(html, _NOISE, "")


def elements(html: Column, tag: str, inner: bool = False, closing: str | None = None) -> Column:
    """Array of opening tags, with what follows up to the closing tag if ``inner``."""
    pattern = rf"(?is)<{tag}(?=[\s/>])" + _ATTRIBUTES
    if inner:
        stop = closing or rf"/?{tag}[\s>/]"
        pattern += rf"(?:[^<]++|<(?!{stop}))*+"
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(0))


def elements_with(html: Column, attribute: str) -> Column:
    """Array of opening tags of any name that mention ``attribute``."""
    pattern = r"(?is)<[a-z](?=[^\s>]*+[\s/])[^\s/>]*+" + _ATTRIBUTES
    found = F.regexp_extract_all(html, F.lit(pattern), F.lit(0))
    mentions = F.filter(found, lambda t: F.lower(t).contains(attribute))
    # Most pages do not mention it at all; the pattern finds that out faster than a lowered copy.
    return F.when(html.rlike(f"(?i){attribute}"), mentions).otherwise(F.array().cast("array<string>"))


def open_tag(element: Column) -> Column:
    return F.regexp_extract(element, _OPEN_TAG, 0)


def raw_attribute(tag: Column, name: str) -> Column:
    """Value of the first attribute ``name``, still in its quotes; empty if there is none."""
    pattern = (
        r"(?is)^<[a-z][^\s/>]*+"
        rf"(?:[\s/]*+(?!{name}[\s=/>])[^\s/>][^\s/>=]*+(?:\s*+=\s*+{_VALUE.replace('(', '(?:', 1)})?+)*+"
        rf"[\s/]*+{name}\s*+=\s*+{_VALUE}"
    )
    return F.regexp_extract(tag, pattern, 1)


def has_attribute(tag: Column, name: str) -> Column:
    """True if the tag carries ``name``, with or without a value."""
    pattern = (
        r"(?is)^<[a-z][^\s/>]*+"
        rf"(?:[\s/]*+(?!{name}[\s=/>])[^\s/>][^\s/>=]*+(?:\s*+=\s*+{_VALUE.replace('(', '(?:', 1)})?+)*+"
        rf"[\s/]*+{name}[\s=/>]"
    )
    return tag.rlike(pattern)


def attribute_value(raw: Column) -> Column:
    """Plain value of ``raw_attribute``; NULL if the attribute is missing."""
    quoted = raw.startswith('"') | raw.startswith("'")
    inside = F.when(quoted, F.substr(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)
    return F.when(raw != "", unescape_entities(inside))


def link_text(inner: Column) -> Column:
    """Text pieces between tags, each stripped, joined without a separator."""
    spaced = F.replace(inner, F.lit("&nbsp;"), F.lit(" "))
    joined = F.regexp_replace(spaced, r"(?U)\s*+<[^>]*+>\s*+", "")
    return unescape_entities(strip(joined))


def visible_text(html: Column) -> Column:
    """All text of a page; tags become a space."""
    return F.regexp_replace(without_noise(html), r"<[^>]*+>", " ")


def title_text(html: Column) -> Column:
    return F.regexp_extract(html, r"(?is)<title[^>]*+>([^<]*+)", 1)
