"""URL work as column expressions.

The built-in ``parse_url`` gives NULL for blanks and letters outside ASCII and
drops the port from HOST, so the parts are cut by pattern instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlspark.functions.binding import let

_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*+):"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _SCHEME, 1))


def authority(url: Column) -> Column:
    """Host with port as written; empty if the URL has none."""
    return F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*+:)?//([^/?#]*+)", 1)


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*+:)?(?://[^/?#]*+)?([^?#]*+)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*+\?([^#]*+)", 1)


def url_parts(url: Column) -> Column:
    """What a relative link needs to know of its base, as one struct.

    ``plain_folder`` is NULL unless the folder can be put before a link as it is.
    """
    def parts(cut: Column) -> Column:
        folder = F.regexp_extract(cut["path"], r"(?s)^(.*/)", 1)
        rooted = F.when(folder != "", folder).otherwise(F.lit("/"))
        plain = ~folder.contains("//") & ~folder.contains("/.")
        return F.struct(
            cut["url"].alias("url"),
            cut["scheme"].alias("scheme"),
            cut["authority"].alias("authority"),
            F.concat(cut["scheme"], F.lit("://"), cut["authority"]).alias("site"),
            cut["path"].alias("path"),
            rooted.alias("folder"),
            F.when(plain, rooted).alias("plain_folder"),
            cut["query"].alias("query"),
        )

    pieces = F.struct(
        url.alias("url"),
        scheme(url).alias("scheme"),
        authority(url).alias("authority"),
        path(url).alias("path"),
        query(url).alias("query"),
    )
    return let(pieces, parts)


def is_valid(url: Column) -> Column:
    return scheme(url).isin("http", "https") & (authority(url) != "")


def percent_decode(text: Column, plus_is_space: bool = False) -> Column:
    """Decode percent escapes; a percent sign that starts no escape stays."""
    kept = F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25")
    if not plus_is_space:
        kept = F.replace(kept, F.lit("+"), F.lit("%2B"))
    needed = text.contains("%") | text.contains("+") if plus_is_space else text.contains("%")
    return F.when(needed, F.try_url_decode(kept)).otherwise(text)


def _resolve_dots(joined: Column) -> Column:
    """Path without ``.`` and ``..`` segments."""
    def walk(parts: Column) -> Column:
        kept = F.aggregate(
            parts,
            F.array().cast("array<string>"),
            lambda done, part: F.when(
                part == "..",
                F.when(F.size(done) > 0, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done),
            )
            .when(part == ".", done)
            .otherwise(F.concat(done, F.array(part))),
        )
        ends_in_dots = F.element_at(parts, -1).isin(".", "..")
        whole = F.when(ends_in_dots, F.concat(kept, F.array(F.lit("")))).otherwise(kept)
        return F.array_join(whole, "/")

    has_dots = joined.rlike(r"(?:^|/)\.\.?(?:/|$)")
    return F.when(has_dots, let(F.split(joined, "/"), walk)).otherwise(joined)


def _rooted(joined: Column) -> Column:
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


# Links that need no work: from the root, whole, or from the page's folder.
_FROM_ROOT = r"^/(?:[^/?#;.\x00-\x20][^?#;\x00-\x20]*+)?$"
_WHOLE = r"^https?://[^/?#;\x00-\x20]++(?:/[^?#;\x00-\x20]*+)?(?:\?[^#\x00-\x20]++)?$"
_FROM_FOLDER = r"^[^/?#;:.\x00-\x20][^?#;:\x00-\x20]*+$"


def join_url(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` seen on the page with ``url_parts`` ``base``.

    The plain forms most links have are answered by one pattern each.
    """
    no_steps = ~href.contains("/.")
    return (
        F.when(href.rlike(_FROM_ROOT) & no_steps, F.concat(base["site"], href))
        .when(href.rlike(_WHOLE), href)
        .when(
            base["plain_folder"].isNotNull() & href.rlike(_FROM_FOLDER) & no_steps & ~href.contains("//"),
            F.concat(base["site"], base["plain_folder"], href),
        )
        .otherwise(_join_any(base, href))
    )


def _join_any(base: Column, href: Column) -> Column:
    site = base["site"]

    def no_empty_tail(text: Column) -> Column:
        # A bare "?" or "#" says nothing and is dropped.
        return F.regexp_replace(F.regexp_replace(text, r"^([^?#]*+)\?(?=#|$)", "$1"), r"^([^#]*+)#$", "$1")

    def relative(rest: Column) -> Column:
        # Parameters follow the first semicolon of the last segment and take no part in dot steps.
        own_path = F.regexp_extract(rest, r"^(?:[^?#]*/)?[^/;?#]*+", 0)
        params = F.regexp_extract(rest, r"^(?:[^?#]*/)?[^/;?#]*+(;[^/?#]*+)(?=[?#]|$)", 1)
        tail = F.regexp_extract(rest, r"(?s)[?#].*$", 0)

        def same_page(end: Column) -> Column:
            old_query = F.when(base["query"] != "", F.concat(F.lit("?"), base["query"])).otherwise(F.lit(""))
            return F.concat(
                site, base["path"], F.when(end.startswith("?"), end).otherwise(F.concat(old_query, end))
            )

        def below(step: Column) -> Column:
            merged = F.regexp_replace(F.concat(base["folder"], step), r"/{2,}", "/")
            full = F.when(step.startswith("/"), step).otherwise(merged)
            return F.concat(site, _rooted(let(full, _resolve_dots)))

        return let(
            F.struct(own_path.alias("path"), params.alias("params"), no_empty_tail(tail).alias("tail")),
            lambda part: F.when((part["path"] == "") & (part["params"] == ""), same_page(part["tail"])).otherwise(
                F.concat(below(part["path"]), part["params"], part["tail"])
            ),
        )

    def by_scheme(link: Column) -> Column:
        own, text = link["scheme"], link["text"]
        rest = F.when(own == "", text).otherwise(F.substr(text, F.length(own) + 2))
        names_host = rest.rlike(r"^//[^/?#]")
        # A bare semicolon at the end of the path is dropped, and so are two slashes that name no host.
        rest = F.regexp_replace(rest, r"^(?!//[^/?#]*;(?:[?#]|$))((?:[^?#]*/)?[^/;?#]*+);(?=[?#]|$)", "$1")
        rest = F.regexp_replace(rest, r"^//(?=[/?#]|$)", "")
        return (
            F.when(text == "", base["url"])
            .when((own != "") & (own != base["scheme"]), href)
            .otherwise(
                let(
                    F.struct(rest.alias("text"), names_host.alias("names_host")),
                    lambda r: F.when(
                        r["names_host"], F.concat(base["scheme"], F.lit(":"), no_empty_tail(r["text"]))
                    ).otherwise(relative(r["text"])),
                )
            )
        )

    tidy = F.regexp_replace(F.regexp_replace(href, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    return let(
        tidy,
        lambda text: let(F.struct(scheme(text).alias("scheme"), text.alias("text")), by_scheme),
    )


def file_extension(url: Column) -> Column:
    """What follows the last dot of the decoded path, in lower case; empty without a dot."""
    plain = percent_decode(path(url))
    return F.when(plain.contains("."), F.lower(F.substring_index(plain, ".", -1))).otherwise(F.lit(""))


def ends_with_any(text: Column, suffixes: list[str]) -> Column:
    hit = F.lit(False)
    for suffix in suffixes:
        hit = hit | text.endswith(suffix)
    return hit


def contains_any(text: Column, words: list[str]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word)
    return hit
