"""Validation of nested documents against a JSON Schema, compiled to one column.

A schema is a plain dict. Every keyword becomes a check over the document's columns, so a document is validated by one projection. Members
that are NULL count as left out, unless the schema lets them be null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions import vocab

_KINDS = {
    "object": (T.StructType, T.MapType), "array": (T.ArrayType,), "string": (T.StringType, T.DateType, T.TimestampType), "boolean": (T.BooleanType,),
    "integer": (T.IntegralType,), "number": (T.NumericType,), "null": (T.NullType,),
}
_OUTSIDE = {"$defs", "$schema", "$id", "title", "description", "default", "examples", "example", "format"}


class Schema:
    """A compiled JSON Schema. Knows `$ref` into its own `$defs`, type, properties, required, items, enum, const, allOf, anyOf, oneOf, not, if/then/else."""

    def __init__(self, schema: dict):
        self.root = schema

    def violations(self, doc: Column, kind: T.DataType) -> Column:
        """Array `{path, rule}` of what is wrong with a document column of type `kind`, in the order of the schema."""
        none = F.array().cast("array<struct<path:string,rule:string>>")
        found = [F.when(bad, F.array(F.struct(F.lit(path).alias("path"), F.lit(rule).alias("rule")))).otherwise(none) for path, rule, bad in self._checks(self.root, doc, kind, "")]
        # short lists joined, not a filter over one: below a filter Spark would interpret all checks instead of compiling them
        return F.flatten(F.array(*found)) if found else none

    def valid(self, schema: dict, value: Column, kind: T.DataType) -> Column:
        bad = [b for _, _, b in self._checks(schema, value, kind, "")]
        out = F.lit(True)
        for b in bad:
            out = out & ~b
        return out

    def _breaks(self, spec: dict, kind: T.DataType, rule: str):
        """Whether an element of an array breaks a rule of its schema."""

        def broken(x: Column) -> Column:
            out = F.lit(False)
            for _, r, bad in self._checks(spec, x, kind, ""):
                out = out | bad if r == rule else out
            return out

        return broken

    def _resolved(self, schema: dict) -> dict:
        while "$ref" in schema:
            here = self.root
            for step in schema["$ref"].removeprefix("#/").split("/"):
                here = here[step]
            schema = here
        return schema

    def _checks(self, schema: dict, value: Column, kind: T.DataType, path: str):
        """(path, rule, violated) per check; `violated` is never NULL, and false where the value is left out."""
        schema = self._resolved(schema)
        unknown = set(schema) - _OUTSIDE - {"type", "properties", "required", "items", "enum", "const", "allOf", "anyOf", "oneOf", "not", "if", "then", "else"}
        if any(not k.startswith("x-") for k in unknown):
            raise ValueError(f"schema keywords not supported: {sorted(unknown)}")
        here, true = value.isNotNull(), F.lit(True)
        told = lambda rule, bad: (path, rule, here & F.coalesce(bad, F.lit(False)))
        if "type" in schema:
            names = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
            if not any(isinstance(kind, _KINDS[n]) for n in names):
                yield told("type", true)
                return
        if "enum" in schema:
            yield told("enum", ~value.cast("string").isin([str(x) for x in schema["enum"] if x is not None]))
        if "const" in schema:
            yield told("const", value.cast("string") != str(schema["const"]))
        members = {f.name: f.dataType for f in kind.fields} if isinstance(kind, T.StructType) else {}
        for name in schema.get("required", ()):
            spec = self._resolved(schema.get("properties", {}).get(name, {}))
            nullable = isinstance(spec.get("type"), list) and "null" in spec["type"]
            inner = f"{path}.{name}".lstrip(".")
            if name not in members:
                yield inner, "required", here
            elif not nullable:
                yield inner, "required", here & value[name].isNull()
        for name, spec in schema.get("properties", {}).items():
            if name in members:
                yield from self._checks(spec, value[name], members[name], f"{path}.{name}".lstrip("."))
        if "items" in schema and isinstance(kind, T.ArrayType):
            spec, inner = schema["items"], kind.elementType
            rules = dict.fromkeys(rule for _, rule, _ in self._checks(spec, F.lit(None).cast(inner), inner, path))
            for rule in rules:
                yield told(rule, F.exists(value, self._breaks(spec, inner, rule)))
        for part in schema.get("allOf", ()):
            yield from self._checks(part, value, kind, path)
        if "anyOf" in schema:
            yield told("anyOf", F.array_min(F.array(*[~self.valid(p, value, kind) for p in schema["anyOf"]])))
        if "oneOf" in schema:
            hits = sum((self.valid(p, value, kind).cast("int") for p in schema["oneOf"]), F.lit(0))
            yield told("oneOf", hits != 1)
        if "not" in schema:
            yield told("not", self.valid(schema["not"], value, kind))
        if "if" in schema:
            met = self.valid(schema["if"], value, kind)
            for branch, holds in (("then", met), ("else", ~met)):
                for inner, rule, bad in self._checks(schema.get(branch, {}), value, kind, path):
                    yield inner, rule, holds & bad


def _object(required: tuple[str, ...] = (), **properties) -> dict:
    return {"type": "object", **({"required": list(required)} if required else {}), "properties": properties}


def document_schema() -> dict:
    """The schema of `build_document`'s documents. A listed ad has property details and preferences, a wanted one room details and a seeker."""
    text, flag, number = {"type": "string"}, {"type": "boolean"}, {"type": "number"}
    maybe, maybe_number = {"type": ["string", "null"]}, {"type": ["number", "null"]}
    enum = lambda name: {"$ref": f"#/$defs/{name}"}
    many = lambda spec: {"type": "array", "items": spec}
    states = {k: enum(k) for k in ("status", "adexpirystatus", "intent", "category")}

    def only(intent: str, own: list[str], other: list[str]) -> dict:
        return {
            "if": {"properties": {"metadata": {"properties": {"intent": {"const": intent}}, "required": ["intent"]}}, "required": ["metadata"]},
            "then": {"required": own, "not": {"anyOf": [{"required": [name]} for name in other]}},
        }

    listed, wanted = ["property_details", "preferences"], ["room_details", "seeker"]
    properties = {
        "ad_id": text,
        "metadata": _object(
            ("status", "adexpirystatus", "adtimezone", "admetroarea", "adactivedate", "adexpirydate", "intent", "category", "role"),
            **states, adtimezone=text, admetroarea=maybe, adactivedate=maybe, adexpirydate=maybe, role=text,
        ),
        "user": _object(("uid", "display_name", "is_verified", "role"), uid=maybe, display_name=maybe, email=maybe, phone=maybe, is_verified=flag, role=text, business=maybe),
        "location": _object(
            **{f: maybe for f in ("display", "formatted_address", "street", "city", "locality", "sub_locality", "district", "state", "state_code", "country", "country_code", "metro_area", "zipcode")},
            lat=maybe_number, lng=maybe_number, show_on_map=flag,
        ),
        "details": _object(
            title=maybe, description=maybe,
            rent=_object(amount=number, currency=text, mode=enum("mode"), is_negotiable=flag, is_hidden=flag, utilities_included=flag, deposit=number),
            availability=_object(**{"from": maybe, "to": text, "stay_type": _object(short=flag, long=flag), "days_available": maybe}),
            amenities=many(enum("amenity")), utilities=many(enum("utility")), furnishing=enum("furnishing"), open_house=_object(date=text, start_time=text, end_time=text),
        ),
        "privacy": _object(**{f: flag for f in ("show_address_on_map", "hide_address_on_ad", "hide_phone_on_ad", "hide_email_on_ad", "on_whatsapp", "share_phone")}),
        "photos": many(text),
        "search": _object(**states, property_type=maybe, rent=number, beds=number, baths=number, state_code=maybe, country_code=maybe, zipcode=maybe),
        "property_details": _object(
            property_type=enum("property_type"), accommodation_type=text, square_feet=maybe_number, beds=maybe_number, baths=maybe_number, building_name=maybe, is_shared=flag,
        ),
        "room_details": _object(bath_type=text, bath_preference=text, gender_preference=enum("gender_preference"), accommodates=text, accommodation_type=text),
        "preferences": _object(
            **{f: enum(f) for f in ("occupation", "smoking", "pets", "vegetarian", "age_range", "preferred_gender")},
            couples_welcome=enum("yes_no"), alcohol_allowed=enum("yes_no"), languages=many(enum("language")),
        ),
        "seeker": _object(age=maybe_number, gender=enum("seeker_gender"), occupation=enum("seeker_occupation"), languages=many(enum("language"))),
    }
    return {
        **_object(("ad_id", "metadata", "user", "location", "details", "privacy", "photos", "search"), **properties),
        "allOf": [only("list", listed, wanted), only("find", wanted, listed)],
        "$defs": {name: {"type": "string", "enum": values} for name, values in vocab.ENUMS.items()},
    }
