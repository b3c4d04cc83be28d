"""Search requests a site's own forms allow. Nothing is sent; the output is a plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.functions import html as H
from crawlspark.functions.binding import let
from crawlspark.functions.fixed import (
    SEARCH_INPUT_HINTS,
    SEARCH_INPUT_TYPES,
    SEARCH_TERM_LIMIT,
    SEARCH_TERMS,
)
from crawlspark.functions.url import contains_any, join_url, url_parts


def _inputs(form: Column) -> Column:
    raw = F.transform(
        H.elements(form, "input"),
        lambda t: F.struct(
            *[H.raw_attribute(t, name).alias(name) for name in ("type", "name", "value", "placeholder")]
        ),
    )
    return F.transform(
        raw,
        lambda r: F.struct(
            *[H.attribute_value(r[name]).alias(name) for name in ("type", "name", "value", "placeholder")]
        ),
    )


def _last_of_each_name(pairs: Column) -> Column:
    """Of pairs with the same name the last one; sorted by name, each is followed by the next of its name, if any."""
    placed = F.transform(pairs, lambda pair, i: F.struct(pair["name"].alias("name"), i.alias("place"), pair["value"].alias("value")))

    def kept(ordered: Column) -> Column:
        last = F.filter(ordered, lambda pair, i: ~F.get(ordered, i + 1)["name"].eqNullSafe(pair["name"]))
        return F.transform(last, lambda pair: F.struct(pair["name"].alias("name"), pair["value"].alias("value")))

    return let(F.array_sort(placed), kept)


def search_requests(
    pages: DataFrame,
    terms: list[str] | None = None,
    term_limit: int = SEARCH_TERM_LIMIT,
) -> DataFrame:
    """One row per page, search form and term: page_url, form_pos, term, method, form_url, params.

    A form counts if a text or search input has a search hint in its name or
    placeholder. Hidden inputs go along; the action is joined to the page.
    """
    terms = (SEARCH_TERMS if terms is None else terms)[:term_limit]

    def hinted(field: Column) -> Column:
        return contains_any(F.lower(F.coalesce(field["name"], F.lit(""))), SEARCH_INPUT_HINTS) | contains_any(
            F.lower(F.coalesce(field["placeholder"], F.lit(""))), SEARCH_INPUT_HINTS
        )

    def forms(page: Column) -> Column:
        found = F.transform(
            H.elements(page["html"], "form", inner=True, closing=r"/form[\s>]"),
            lambda f, pos: F.struct(pos.alias("pos"), H.open_tag(f).alias("tag"), _inputs(f).alias("inputs")),
        )
        read = F.transform(
            found,
            lambda f: F.struct(
                f["pos"].alias("pos"),
                H.raw_attribute(f["tag"], "action").alias("action"),
                H.raw_attribute(f["tag"], "method").alias("method"),
                F.filter(
                    f["inputs"], lambda i: F.coalesce(i["type"], F.lit("")).isin(SEARCH_INPUT_TYPES) & hinted(i)
                ).alias("search"),
                F.filter(
                    f["inputs"], lambda i: (i["type"] == "hidden") & (F.coalesce(i["name"], F.lit("")) != "")
                ).alias("hidden"),
            ),
        )
        usable = F.filter(read, lambda f: F.size(f["search"]) > 0)
        return F.transform(
            usable,
            lambda f: F.struct(
                f["pos"].alias("form_pos"),
                F.lower(F.coalesce(H.attribute_value(f["method"]), F.lit("get"))).alias("method"),
                join_url(page["base"], F.coalesce(H.attribute_value(f["action"]), F.lit(""))).alias("form_url"),
                f["search"].getItem(0)["name"].alias("search_name"),
                F.transform(
                    f["hidden"],
                    lambda i: F.struct(
                        i["name"].alias("name"), F.coalesce(i["value"], F.lit("")).alias("value")
                    ),
                ).alias("hidden"),
            ),
        )

    def params(form: Column, term: Column) -> Column:
        own = F.array(F.struct(form["search_name"].alias("name"), term.alias("value")))
        named = F.filter(own, lambda pair: F.coalesce(pair["name"], F.lit("")) != "")
        return F.map_from_entries(let(F.concat(form["hidden"], named), _last_of_each_name))

    page = F.struct(url_parts(F.col("url")).alias("base"), H.without_noise(F.col("html")).alias("html"))
    per_form = pages.select(F.col("url").alias("page_url"), F.explode(let(page, forms)).alias("form"))
    per_term = per_form.select("*", F.explode(F.array(*[F.lit(t) for t in terms])).alias("term"))
    return per_term.select(
        "page_url",
        F.col("form.form_pos").alias("form_pos"),
        "term",
        F.col("form.method").alias("method"),
        F.col("form.form_url").alias("form_url"),
        params(F.col("form"), F.col("term")).alias("params"),
    )


def request_address(form_url: Column, params: Column) -> Column:
    """Address that a planned request asks for: the form's, with its parameters by name, encoded."""
    pairs = F.transform(
        F.array_sort(F.map_entries(params)), lambda pair: F.concat(F.url_encode(pair["key"]), F.lit("="), F.url_encode(pair["value"]))
    )
    asked = F.array_join(pairs, "&")
    between = F.when(form_url.contains("?"), F.lit("&")).otherwise(F.lit("?"))
    return F.when(asked == "", form_url).otherwise(F.concat(form_url, between, asked))
