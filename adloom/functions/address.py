"""Address text to structured parts, by the tables of patterns in `vocab`."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions import vocab
from adloom.functions.text import grab, let, strip_ws, text_map

PARTS = ["zip_code", "country", "country_code", "state_code", "state", "city", "county", "formatted_address"]


def state_name(code: Column) -> Column:
    return F.coalesce(F.try_element_at(text_map(vocab.US_STATES), code), code)


def _land(text: Column) -> Column:
    """`{country, country_code}` of the first keyword, in table order, that the text holds as a word; NULL without one."""
    rows = [
        F.when(text.rlike(rf"(?i)\b{word}\b"), F.struct(F.lit(name).alias("country"), F.lit(code).alias("country_code")))
        for word, name, code in vocab.COUNTRIES
    ]
    return F.coalesce(*rows)


def address_parts(address: Column) -> Column:
    """Struct of `PARTS`. The line of the address is city, state code, ZIP code and country, as far as there are two of them."""
    before, after = vocab.ADDRESS_CITY

    def read(text: Column) -> Column:
        return let(grab(text, vocab.ADDRESS_STATE_CODE), lambda code: let(_land(text), lambda land: told(text, code, land)))

    def told(text: Column, code: Column, land: Column) -> Column:
        found = {
            "zip_code": grab(text, vocab.ADDRESS_ZIP), "country": land["country"], "country_code": land["country_code"],
            "state_code": code, "state": state_name(code), "county": strip_ws(grab(text, vocab.ADDRESS_COUNTY)),
            "city": F.when(code.isNotNull(), strip_ws(grab(text, F.concat(F.lit(before), code, F.lit(after))))),
        }
        return let(F.struct(*[v.alias(f) for f, v in found.items()]), with_line)

    def with_line(p: Column) -> Column:
        known = F.array_compact(F.array(p["city"], p["state_code"], p["zip_code"], p["country"]))
        line = F.when(F.size(known) > 1, F.array_join(known, ", ")).alias("formatted_address")
        return F.struct(*[line if f == "formatted_address" else p[f].alias(f) for f in PARTS])

    spaced = reduce(lambda text, rule: F.regexp_replace(text, *rule), vocab.ADDRESS_GLUE, address)
    return let(spaced, read)


def with_parsed_address(df: DataFrame, source: str, out: str) -> DataFrame:
    """Adds struct column `out`, the parts of text column `source`."""
    return df.withColumn(out, address_parts(F.col(source)))
