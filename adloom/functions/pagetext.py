"""Facts printed in page text: quick-facts block, posted line, contacts, neighbourhoods, overview."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adloom.functions import vocab
from adloom.functions.text import grab, null_if_blank, strip_ws


def quick_facts(text: Column) -> Column:
    """Struct of the "LABEL, new line, value" block."""
    return F.struct(
        *[strip_ws(grab(text, rf"(?i){label}\s*\n\s*([^\n]+)")).alias(field) for field, label in vocab.QUICK_FACTS]
    )


_FACT_LINE = r"(^|\n)[ \t]*(" + "|".join(vocab.QUICK_FACT_LINES) + r")[ \t\r]*(\n|$)"


def strip_quick_facts(text: Column) -> Column:
    """The text above the first line that is a quick-facts label."""
    hit = text.rlike("(?i)" + _FACT_LINE)
    return F.when(hit, strip_ws(F.regexp_replace(text, "(?is)" + _FACT_LINE + ".*", ""))).otherwise(text)


def sane_or_null(c: Column, limit: int = 60) -> Column:
    return F.when(F.length(c) <= limit, null_if_blank(c))


def clean_area(c: Column) -> Column:
    return F.coalesce(grab(F.regexp_replace(c, r"[^\d.]", ""), "(.+)"), c)


def clean_deposit(c: Column) -> Column:
    return F.regexp_replace(c, r"^\$", "")


def posted_line(text: Column) -> Column:
    """`{posted_on, ad_id, posted_by}` of the line that names date, id and poster."""
    return F.struct(*[strip_ws(grab(text, pattern)).alias(field) for field, pattern in vocab.POSTED_LINE.items()])


def posted_by_rest_of_line(text: Column) -> Column:
    return strip_ws(grab(text, vocab.POSTED_BY_REST))


def neighborhood_names(text: Column, links: Column | None = None) -> Column:
    """Texts of neighbourhood links; without any, the names that the line of the page text lists, in order and each once."""
    trimmed = F.transform(F.split(grab(text, vocab.NEIGHBORHOOD_LINE), vocab.NEIGHBORHOOD_BREAK), strip_ws)
    listed = F.array_distinct(F.filter(F.coalesce(trimmed, F.array().cast("array<string>")), lambda x: x != ""))
    return listed if links is None else F.when(F.size(links) > 0, links).otherwise(listed)


def verified_credentials(items: Column, text: Column) -> Column:
    """Section items that say "verified"; without any, the distinct phrases of the text."""
    named = F.filter(items, lambda x: x.rlike("(?i)verified"))
    phrases = F.array_distinct(F.regexp_extract_all(text, F.lit(vocab.VERIFIED_PHRASE), F.lit(0)))
    return F.when(F.size(named) > 0, named).otherwise(phrases)


def contacts(text: Column, mask: bool = True) -> Column:
    """First phone number and e-mail address; as SHA-256 unless `mask` is off."""
    found = {f: F.regexp_substr(text, F.lit(p)) for f, p in (("phone", vocab.CONTACT_PHONE), ("email", vocab.CONTACT_EMAIL))}
    return F.struct(*[(F.sha2(v, 256) if mask else v).alias(f) for f, v in found.items()])


def overview_merge(from_json: Column, from_page: Column) -> Column:
    """The description to keep. The page has it with its line breaks, the JSON may have it whole: a printed text replaces a JSON text
    that is blank, and one without line breaks unless that costs more than three tenths of its length."""
    printed = null_if_blank(from_page)
    lines = lambda c: F.size(F.split(c, "\n"))
    reads_better = (lines(from_page) > 1) & (lines(from_json) == 1) & (F.length(from_page) >= 0.7 * F.length(from_json))
    return F.coalesce(F.when(F.coalesce(reads_better, F.lit(False)), printed), null_if_blank(from_json), printed, from_json)


def poster_merge(from_json: Column, from_page: Column) -> Column:
    return F.coalesce(null_if_blank(from_json), from_page)
