"""Free text to closed vocabularies. Column in, Column out, no shuffles and no Python at run time."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from adloom.functions import vocab
from adloom.functions.text import (
    grab, last_where, let, strip_ws, text_map,
)

MONEY = "decimal(12,2)"


def _like(c: Column, pattern: str) -> Column:
    return c.rlike(f"(?i){pattern}")


def _no_commas(c: Column) -> Column:
    return F.regexp_replace(c, ",", "")


def _number(c: Column) -> Column:
    return grab(_no_commas(c), r"(\d+(?:\.\d+)?)")


# ---- numbers and money ----------------------------------------------------------------------


def rent_mode(c: Column) -> Column:
    return (
        F.when(_like(c, "week"), "per_week")
        .when(_like(c, "day"), "per_day")
        .when(_like(c, "year"), "per_year")
        .otherwise("per_month")
    )


def rent_currency(c: Column) -> Column:
    return (
        F.when(F.contains(c, F.lit("₹")), "INR")
        .when(F.contains(c, F.lit("£")), "GBP")
        .when(F.contains(c, F.lit("€")), "EUR")
        .otherwise("USD")
    )


def parse_rent(c: Column) -> Column:
    """`{amount, currency, mode}`; NULL without a number."""
    return let(
        _number(c),
        lambda n: F.when(
            n.isNotNull(),
            F.struct(n.try_cast(MONEY).alias("amount"), rent_currency(c).alias("currency"), rent_mode(c).alias("mode")),
        ),
    )


def rent_from_text(c: Column) -> Column:
    """A rent phrase out of prose: heading and value, then "rent: $n", then "$n per month"."""
    money = r"\$[\d,]+(?:\.\d+)?"
    heading = grab(c, rf"(?i)expected\s+rent[:\s]*\r?\n\s*({money}(?:\s*/\s*\w+)?)")
    labelled = grab(c, rf"(?i)\brent[:\s]+\*?\s*({money}(?:\s*/?\s*(?:month|mo\.?|week|day|year|yr))?)")
    monthly = grab(c, rf"(?i)({money})(?:\s*(?:per|/)\s*month|\s*/\s*mo\.?)")
    return F.coalesce(heading, labelled, F.concat(monthly, F.lit(" /Month")))


def parse_baths(c: Column) -> Column:
    return F.regexp_substr(c, F.lit(r"\d+")).try_cast("int")


def parse_beds(c: Column) -> Column:
    return F.when(_like(c, "studio"), F.lit(0)).otherwise(parse_baths(c))


def parse_area(c: Column) -> Column:
    return _number(c).try_cast("double")


# ---- dates ----------------------------------------------------------------------------------


def posted_date(c: Column) -> Column:
    """Date written in one of the site's ways; NULL if none fits."""
    formats = [
        (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
        (r"^[A-Za-z]{4,} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
        (r"^[A-Za-z]{3} \d{1,2} \d{4}$", "MMM d yyyy"),
        (r"^[A-Za-z]{4,} \d{1,2} \d{4}$", "MMMM d yyyy"),
        (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
        (r"^\d{1,2} [A-Za-z]{4,} \d{4}$", "d MMMM yyyy"),
        (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    ]

    def read(t: Column) -> Column:
        # "May" is both its short and its long name
        parsed = [F.when(t.rlike(p), F.try_to_date(F.initcap(t), f)) for p, f in formats]
        iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.left(t, F.lit(10)), "yyyy-MM-dd"))
        return F.when(t.isNotNull(), F.coalesce(*parsed, iso))

    return let(F.regexp_replace(strip_ws(c), r"\s+", " "), read)


def add_one_year(d: Column) -> Column:
    return F.add_months(d, 12)


def format_date(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


# ---- lookups --------------------------------------------------------------------------------


def property_type(c: Column) -> Column:
    key = F.regexp_replace(F.lower(strip_ws(c)), r"\s+", " ")
    return F.try_element_at(text_map(vocab.PROPERTY_TYPES), key)


def match_option(c: Column, options: list[str]) -> Column:
    """The option equal to the text, else the longest option that contains it or is contained in it."""
    if not options:
        return F.lit(None).cast("string")
    # options are lower-cased here, once; of options with one lower-cased form the first counts, of options of one length too
    exact = text_map({o.lower(): o for o in reversed(options)})

    def longest(x: Column) -> Column:
        chain = F
        for o in sorted(options, key=len, reverse=True):
            chain = chain.when(F.contains(x, F.lit(o.lower())) | F.contains(F.lit(o.lower()), x), F.lit(o))
        return chain

    return let(F.lower(strip_ws(c)), lambda x: F.when(x != "", F.coalesce(F.try_element_at(exact, x), longest(x))))


def languages(items: Column) -> Column:
    """Known languages among an array of names, in input order."""
    return F.filter(F.transform(items, lambda x: match_option(x, vocab.LANGUAGES)), lambda x: x.isNotNull())


def slug_or_any(c: Column, table: Iterable[tuple[str, str]]) -> Column:
    s = F.lower(strip_ws(c))
    chain = F.when(c.isNull(), "Any")
    for slug, pattern in table:
        chain = chain.when(s.rlike(pattern), slug)
    return chain.otherwise("Any")


def first_slug(c: Column, table: Iterable[tuple[str, str]]) -> Column:
    """Slug of the first pattern that matches; NULL if none does. One `CASE`, stops at the first hit."""
    chain = None
    for slug, pattern in table:
        chain = F.when(_like(c, pattern), slug) if chain is None else chain.when(_like(c, pattern), slug)
    return chain


def slug_list(items: Column, table: Iterable[tuple[str, str]]) -> Column:
    """Distinct slugs of an array of labels, first seen first."""
    table = list(table)
    return F.array_distinct(F.filter(F.transform(items, lambda x: first_slug(x, table)), lambda s: s.isNotNull()))


def amenity_slugs(items: Column) -> Column:
    return slug_list(items, vocab.AMENITIES)


def utility_slugs(items: Column) -> Column:
    return slug_list(items, vocab.UTILITIES)


# ---- flags and enums ------------------------------------------------------------------------


def alcohol_flag(c: Column) -> Column:
    return F.when(_like(c, r"not?\s+allow|no\s+alc|prohibit|not\s+ok"), F.lit(False)).when(
        _like(c, r"allow|is\s+ok|\bok\b|yes|permit"), F.lit(True)
    )


def intent(ad_type: Column) -> Column:
    return F.when(_like(ad_type, "wanted"), "find").otherwise("list")


def category(intent_col: Column) -> Column:
    return F.when(intent_col == "find", "room").otherwise("property")


def role(intent_col: Column) -> Column:
    return F.when(intent_col == "find", "I am an individual").otherwise("I am the property owner")


def ad_status(c: Column) -> Column:
    return F.when(_like(c, "disable|inactive|false|expired|closed"), "disable").otherwise("active")


def expiry_status(c: Column) -> Column:
    return F.when(_like(c, "expir|true"), "expiry").otherwise("active")


def furnishing(c: Column) -> Column:
    return (
        F.when(_like(c, "semi"), "semi_furnished")
        .when(_like(c, "bed") & _like(c, "furnish"), "furnished_with_bed")
        .when(_like(c, "furnish"), "fully_furnished")
        .otherwise("unfurnished")
    )


def yes_no(c: Column, default: str = "Yes") -> Column:
    """Text or boolean text to Yes/No."""
    return F.when(_like(c, "^(yes|true$)"), "Yes").when(_like(c, "^(no|false$)"), "No").otherwise(default)


def gender_slug(c: Column) -> Column:
    return F.when(_like(c, "female"), "female_only").when(_like(c, "male"), "male_only").otherwise("any")


def seeker_gender(c: Column) -> Column:
    return F.when(_like(c, "female"), "female").when(_like(c, "male"), "male").otherwise("other")


def seeker_occupation(c: Column) -> Column:
    return F.when(_like(c, "student"), "student").when(_like(c, "professional"), "professional").otherwise("other")


def stay_type(*texts: Column) -> Column:
    raw = F.lower(F.concat_ws(" ", *texts))
    short = F.contains(raw, F.lit("short"))
    return F.struct(short.alias("short"), (F.contains(raw, F.lit("long")) | ~short).alias("long"))


def neighborhoods(*lists: Column) -> Column:
    """Union of name lists, first seen first: the first is primary, the others secondary."""
    parts = [F.filter(F.coalesce(x, F.array().cast("array<string>")), lambda s: (s != "") & (s != "not_found")) for x in lists]
    names = F.array_distinct(F.concat(*parts))
    return let(
        names,
        lambda a: F.struct(
            F.get(a, F.lit(0)).alias("primary"),
            F.slice(a, F.lit(2), F.greatest(F.size(a), F.lit(1))).alias("secondary"),
        ),
    )


def photo_choice(json_photos: Column, page_photos: Column) -> Column:
    own = F.filter(json_photos, lambda u: u.isNotNull() & (u != ""))
    other = F.filter(page_photos, lambda u: u.isNotNull() & (u != ""))
    return F.coalesce(F.when(F.size(own) > 0, own), other, F.array().cast("array<string>"))


def classify_items(items: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct with one field per rule: the last item whose first matching rule it is."""

    def last_of(tagged: Column, field: str) -> Column:
        return last_where(tagged, lambda t: t["field"] == field)["item"].alias(field)

    return let(
        F.transform(items, lambda x: F.struct(x.alias("item"), first_slug(x, rules).alias("field"))),
        lambda tagged: F.struct(*[last_of(tagged, field) for field, _ in rules]),
    )


# ---- retired document shape -----------------------------------------------------------------


def legacy_amenity_keys(keys: Column) -> Column:
    """Facts hidden in amenity keys: intent, area, bedrooms, date."""

    def last_hit(of: Column, pattern: str) -> Column:
        found = F.transform(of, lambda k: F.call_function("regexp_extract", k, F.lit(pattern), F.lit(1)))
        return F.try_element_at(F.filter(found, lambda v: v != ""), F.lit(-1))

    def intent(word: Column) -> Column:
        return F.when(word == "offered", "list").when(word == "wanted", "find")

    def day(text: Column) -> Column:
        month = F.initcap(F.left(grab(text, r"_([A-Za-z]+)_"), F.lit(3)))
        iso = F.concat_ws(" ", grab(text, r"^(\d+)_"), month, grab(text, r"_(\d{4})$"))
        return F.when(text.isNotNull(), F.try_to_date(iso, "d MMM yyyy"))

    # the keys, and what is found in them, are bound: every mention would derive them from the labels again
    return let(
        keys,
        lambda of: F.struct(
            let(F.lower(last_hit(of, "(?i)^ad_type.*(offered|wanted)")), intent).alias("intent"),
            last_hit(of, r"(?i)^area(\d+(?:\.\d+)?)_sqft$").try_cast("double").alias("square_feet"),
            last_hit(of, r"(?i)^bedrooms?[_\s](\d+)").try_cast("int").alias("beds"),
            let(last_hit(of, r"(?i)^available_from(\d{1,2}_[a-z]+_\d{4})$"), day).alias("available_from"),
        ),
    )
