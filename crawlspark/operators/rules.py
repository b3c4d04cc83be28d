"""Link rules: which links count as documents, as data."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlspark.functions.binding import let
from crawlspark.functions.fixed import DOCUMENT_URL_PATTERNS, DOCUMENT_WORDS, WEB_PAGE_WORDS
from crawlspark.functions.url import contains_any


@dataclass(frozen=True)
class LinkRule:
    """One rule: ``kind`` is ``contains`` (on lower-cased text) or ``pattern`` (without case).

    A rule does not apply where the field holds one of the ``exclude`` words.
    """

    rule_ord: int
    field: str
    kind: str
    pattern: str
    exclude: list[str] = field(default_factory=list)


def document_rules() -> list[LinkRule]:
    """The fixed rules: file ending, then words of the link text, then URL forms."""
    rules = [LinkRule(1, "url", "contains", ".pdf")]
    for word in DOCUMENT_WORDS:
        rules.append(LinkRule(len(rules) + 1, "text", "contains", word, WEB_PAGE_WORDS))
    for pattern in DOCUMENT_URL_PATTERNS:
        rules.append(LinkRule(len(rules) + 1, "url", "pattern", pattern))
    return rules


def classify(url: Column, text: Column, rules: list[LinkRule]) -> Column:
    """``rule_ord`` of the first matching rule, NULL if none matches.

    Rules are a handful of parameters, so they become one CASE expression that
    stops at the first hit and needs no join. Neighbouring rules of one kind
    share a test that sends most links past all of them at once.
    """
    ordered = sorted(rules, key=lambda r: r.rule_ord)

    def decide(link: Column) -> Column:
        blocks = groupby(ordered, key=lambda r: (r.field, r.kind, tuple(r.exclude)))
        return F.coalesce(*[_block(link, *key, list(members)) for key, members in blocks])

    subject = F.struct(
        url.alias("url"),
        F.lower(url).alias("lower_url"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.lower(F.coalesce(text, F.lit(""))).alias("lower_text"),
    )
    return let(subject, decide) if rules else F.lit(None).cast("int")


def _block(link: Column, field: str, kind: str, exclude: tuple[str, ...], rules: list[LinkRule]) -> Column:
    lowered = link[f"lower_{field}"]
    if kind == "contains":
        hits = [lowered.contains(rule.pattern.lower()) for rule in rules]
        any_hit = contains_any(lowered, [rule.pattern.lower() for rule in rules])
    else:
        hits = [link[field].rlike(f"(?i){rule.pattern}") for rule in rules]
        any_hit = link[field].rlike("(?i)" + "|".join(f"(?:{rule.pattern})" for rule in rules))
    first = F.coalesce(*[F.when(hit, F.lit(rule.rule_ord)) for hit, rule in zip(hits, rules)])
    condition = any_hit & ~contains_any(lowered, list(exclude)) if exclude else any_hit
    return F.when(condition, first)
